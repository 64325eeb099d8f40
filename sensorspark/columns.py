"""Column selection, missing-value normalisation and the time axis."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns never treated as sensors, and header names of a time axis.
METADATA_COLUMNS = ("block_id", "imputed")
DEFAULT_NON_SENSOR = ("machine_status",)
TIME_COLUMN_NAMES = ("timestamp", "time", "ts", "datetime", "date")

MICROS = 1_000_000


def sensor_columns(
    df: DataFrame,
    timestamp: str,
    keys: Sequence[str] = (),
    non_sensor: Iterable[str] = DEFAULT_NON_SENSOR,
) -> list[str]:
    """Numeric columns other than the time axis, the keys and the exclusions.

    Booleans are not numeric here, so a flag column never becomes a sensor.
    """
    skip = {timestamp, *keys, *METADATA_COLUMNS, *non_sensor}
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def drop_sensors(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop named columns; unknown names are ignored."""
    return df.drop(*names)


def join_on(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join a table of one row per key; a NULL key meets itself, and without keys ``right`` is one row."""
    keys = list(keys)
    if not keys:
        return left.join(F.broadcast(right), how=how)
    # A struct never is NULL.
    side = right.select(F.struct(*keys).alias("__on"), *[c for c in right.columns if c not in keys])
    return left.withColumn("__on", F.struct(*keys)).join(side, "__on", how).drop("__on")


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is NULL, or NaN in a floating column."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """NaN and NULL both mean missing; keep only NULL."""
    chosen = set(names) if names is not None else set(df.columns)
    floats = [
        f.name
        for f in df.schema.fields
        if f.name in chosen and isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats})


def micros(df: DataFrame, name: str) -> Column:
    """The time axis as integer microseconds.

    Instants count from the epoch; strings are parsed first and integer or float
    axes are read as seconds.
    """
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.StringType):
        return F.unix_micros(F.try_to_timestamp(c))
    if isinstance(kind, T.IntegralType):
        return c.cast("long") * MICROS
    return F.round(c.cast("double") * MICROS).cast("long")


def first_present(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate that is a column of ``df`` (output files vary by version)."""
    return next((c for c in candidates if c in df.columns), None)


def truthy(c: Column) -> Column:
    """String booleans ``true`` and ``1``; NULL counts as false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1"), F.lit(False))
