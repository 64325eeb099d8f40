"""Readers for sensor files, label sidecars, step documents and their references."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.columns import TIME_COLUMN_NAMES

STEP_SCHEMA = (
    "id string, results array<struct<step int, instruction string, frame_start double, frame_end double, "
    "timestamp_start double, timestamp_end double>>"
)
VERDICT_SCHEMA = (
    "id string, results array<struct<step int, status string, reason string, frame_start double, frame_end double, "
    "timestamp_start double, timestamp_end double>>"
)
FLOW_SCHEMA = (
    "time_utc timestamp, mac_a string, mac_b string, prot string, tran int, port_a int, port_b int, "
    "bytes_a long, bytes_b long, pkts_a long, pkts_b long"
)

SOURCE, ORDINAL = "source", "source_row"
MAX_HEADERS = 1000


def source_ordinal() -> Column:
    """A number that grows with the row's place in its file.

    The start of the row's split in bytes plus its index among the rows of the task: a
    row takes at least one byte, so the next split always starts higher.
    """
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start") + index


def _raw_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV files as strings with their source and row order; a column is found by its name in each file's own header."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(SOURCE), source_ordinal().alias(ORDINAL), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    # The header is the first line of a file; the lines of its first split are compared by place.
    headers = lines.filter("start = 0").groupBy(SOURCE).agg(F.min_by("value", ORDINAL).alias("header"))
    distinct = [r[0] for r in headers.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(distinct) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}")
    if len(distinct) <= 1:
        raw = spark.read.options(header="true", **options).csv(path)
        return raw.withColumns({SOURCE: F.col("_metadata.file_path"), ORDINAL: source_ordinal()})
    # Fields are read by position and named by the header of their file.
    width = max(len(next(csv.reader([h]))) for h in distinct)
    fields = ", ".join(f"c{i} string" for i in range(width))
    names: list[str] = []
    for h in sorted(distinct):
        names += [c for c in next(csv.reader([h])) if c not in names]
    parsed = lines.join(headers, SOURCE).filter(F.col("value") != F.col("header"))
    row, head = (F.array(*[F.from_csv(c, fields)[f"c{i}"] for i in range(width)]) for c in ("value", "header"))
    parsed = parsed.select(SOURCE, ORDINAL, row.alias("row"), head.alias("head"))
    at = [F.array_position("head", F.lit(c)).cast("int") for c in names]
    cells = [F.when(p > 0, F.try_element_at("row", F.nullif(p, F.lit(0)))).alias(c) for c, p in zip(names, at)]
    return parsed.select(*cells, SOURCE, ORDINAL)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def read_sensors(
    spark: SparkSession,
    path: str | list[str],
    *,
    channels: int | None = None,
    time_columns: Iterable[str] = TIME_COLUMN_NAMES,
    keep_time: bool = True,
) -> DataFrame:
    """Sensor CSVs as ``source, source_row, timestamp`` (whole seconds) and one double per channel.

    The time axis is the first column with a time name, else the first column.  A channel
    is a column whose first value is a number; ``channels`` caps them.  Files may have their
    columns in any order, and columns of their own.
    """
    raw = _raw_csv(spark, path)
    names = [c for c in raw.columns if c not in (SOURCE, ORDINAL)]
    known = {c.lower() for c in time_columns}
    time = next((c for c in names if c.strip().lower() in known), names[0])
    numbers = [c for c in names if c.strip().lower() not in known]
    first = raw.first()
    if first is None:
        raise ValueError(f"no rows in {path}")
    # A column that the first file lacks is judged by the first row that has it.
    shown = {c: first[c] for c in numbers if first[c] is not None}
    shown |= {c: r[0] for c in numbers if c not in shown and (r := raw.select(c).filter(F.col(f"`{c}`").isNotNull()).first())}
    chosen = [c for c in numbers if c in shown and _is_number(shown[c])][: channels or None]
    axis = [F.col(f"`{time}`").cast("double").cast("long").alias("timestamp")] if keep_time else []
    return raw.select(SOURCE, ORDINAL, *axis, *[F.col(f"`{c}`").cast("double").alias(c.strip()) for c in chosen])


def read_labels(
    spark: SparkSession, path: str | list[str], *, label_column: str = "label", needed: DataFrame | None = None
) -> DataFrame:
    """Label sidecars as ``source, timestamp, label``, one row per whole second.

    The label column is matched without case, else it is the last one.  Short rows are
    skipped; on repeated instants the last row wins.  ``needed`` keeps only its timestamps.
    """
    raw = _raw_csv(spark, path)
    names = [c for c in raw.columns if c not in (SOURCE, ORDINAL)]
    label = next((c for c in names if c.strip().lower() == label_column.lower()), names[-1])
    rows = raw.select(
        SOURCE,
        ORDINAL,
        F.col(f"`{names[0]}`").cast("double").cast("long").alias("timestamp"),
        F.trim(F.col(f"`{label}`")).alias("label"),
    ).filter(F.col("label").isNotNull() & F.col("timestamp").isNotNull())
    if needed is not None:
        rows = rows.join(needed.select("timestamp").distinct(), "timestamp", "left_semi")
    return rows.groupBy(SOURCE, "timestamp").agg(F.max_by("label", ORDINAL).alias("label"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Any CSV with a header as strings, with its source and row order."""
    return _raw_csv(spark, path)


def with_sidecars(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """All CSVs of a folder and their ``<stem>_labels.csv`` sidecars, keyed by the input's path.

    Inputs without a sidecar stay; the second value is None when no sidecar exists.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    paths = [r[0] for r in files.collect()]
    sidecars = sorted(p for p in paths if p.endswith("_labels.csv"))
    inputs = sorted(set(paths) - set(sidecars))
    sensors = read_sensors(spark, inputs)
    if not sidecars:
        return sensors, None
    labels = read_labels(spark, sidecars)
    return sensors, labels.withColumn(SOURCE, F.regexp_replace(SOURCE, r"_labels\.csv$", ".csv"))


def _documents(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias(SOURCE), F.trim("value").alias("body")
    )


def read_manuals(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Step documents, one row per step: an object, an array (its first element) or JSON lines.

    A document without steps keeps one row with NULL step columns.  Spark skips files of
    zero bytes, so those give no row; find them by joining the expected names.
    """
    docs = _documents(spark, path, STEP_SCHEMA)
    body = F.col("body")
    one = F.from_json(body, STEP_SCHEMA)
    many = F.element_at(F.from_json(body, f"array<struct<{STEP_SCHEMA}>>"), 1)
    lines = F.filter(F.split(body, "\n"), lambda x: F.trim(x) != "")
    first_line = F.from_json(F.try_element_at(lines, F.lit(1)), STEP_SCHEMA)
    whole = F.try_parse_json(body).isNotNull()
    record = F.when(whole & body.startswith("["), many).when(whole, one).otherwise(first_line)
    rows = docs.select(SOURCE, record.alias("r")).select(SOURCE, F.col("r.id").alias("id"), F.explode_outer("r.results").alias("s"))
    return rows.select(SOURCE, "id", "s.*")


def read_verdicts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Verdict records, one JSON object per line, as one row per verdict in reported order."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    record = F.from_json("value", VERDICT_SCHEMA)
    rows = lines.select(F.col("_metadata.file_path").alias(SOURCE), source_ordinal().alias(ORDINAL), record.alias("r"))
    out = rows.select(SOURCE, ORDINAL, F.col("r.id").alias("id"), F.posexplode_outer("r.results").alias("position", "s"))
    return out.select(SOURCE, ORDINAL, "id", "position", "s.*")


def read_intervals(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless ``step,start,end`` rows; only rows with exactly three fields count."""
    parts = F.split("value", ",")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias(SOURCE), parts.alias("p"))
    return rows.filter(F.size("p") == 3).select(
        SOURCE,
        F.trim(F.col("p")[0]).cast("int").alias("step"),
        F.trim(F.col("p")[1]).cast("double").alias("start"),
        F.trim(F.col("p")[2]).cast("double").alias("end"),
    )


def read_procedures(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Procedure texts, one step per line from 1; blank and ``#`` lines are dropped.

    A procedure without any step is an error.
    """
    lines = F.transform(F.split("body", "\r?\n"), lambda x: F.trim(x))
    steps = F.filter(lines, lambda x: (x != "") & ~x.startswith("#"))
    docs = _documents(spark, path, "").select(SOURCE, steps.alias("steps"))
    checked = F.when(F.size("steps") == 0, F.raise_error(F.concat(F.col(SOURCE), F.lit(" has no step lines"))).cast("array<string>"))
    out = docs.select(SOURCE, F.posexplode(F.coalesce(checked, F.col("steps"))).alias("n", "text"))
    return out.select(SOURCE, (F.col("n") + 1).alias("step_no"), "text")


def read_flows(spark: SparkSession, path: str | list[str], *, header: bool = True) -> DataFrame:
    """Pipe-separated flow logs."""
    return spark.read.schema(FLOW_SCHEMA).csv(path, sep="|", header=header)
