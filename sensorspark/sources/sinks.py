"""Result files and fitted artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def prediction_table(
    df: DataFrame,
    classes: Sequence[str] = (),
    *,
    probabilities: str = "probabilities",
    embeddings: str | None = None,
    variates: Sequence[str] = (),
) -> DataFrame:
    """Prediction rows with ``p_<class>`` columns in alphabetical order and string booleans.

    ``embeddings`` names a map from variate to vector; each of ``variates`` becomes an
    ``embedding_<variate>`` column.  The other columns are unchanged by that choice.
    """
    drop = [c for c in (probabilities, embeddings) if c and c in df.columns]
    base = [c for c in df.columns if c not in drop]
    cols = [
        F.lower(F.col(c).cast("string")).alias(c) if df.schema[c].dataType.simpleString() == "boolean" else F.col(c)
        for c in base
    ]
    cols += [F.coalesce(F.col(probabilities)[c], F.lit(0.0)).alias(f"p_{c}") for c in sorted(classes)]
    if embeddings:
        cols += [F.col(embeddings)[v].alias(f"embedding_{v}") for v in variates]
    return df.select(*cols)


def write_predictions(table: DataFrame, path: str, *, format: str = "csv", source: str | None = None, mode: str = "error") -> None:
    """Write a prediction table; with ``source`` each input gets its own folder.

    CSV cannot hold vectors, so tables with embedding columns need Parquet.
    """
    if format == "csv" and any(f.dataType.simpleString().startswith("array") for f in table.schema):
        raise ValueError("embedding columns need format='parquet'")
    writer = table.write.mode(mode)
    if source:
        writer = writer.partitionBy(source)
    writer.option("header", "true").format(format).save(path)


def save_artifact(reference: DataFrame, params: dict, path: str, *, mode: str = "error") -> None:
    """A fitted classifier or detector: its reference table and one row of parameters."""
    reference.write.mode(mode).parquet(f"{path}/reference")
    row = reference.sparkSession.createDataFrame([tuple(params.values())], list(params))
    row.write.mode(mode).parquet(f"{path}/params")


def load_artifact(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The reference table and the parameters it was fitted with; scoring takes both from here."""
    params = spark.read.parquet(f"{path}/params").first()
    return spark.read.parquet(f"{path}/reference"), params.asDict()
