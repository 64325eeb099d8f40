"""Leakage and input-contract audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import MICROS, join_on, missing
from sensorspark.operators.profile import delta_counts
from sensorspark.plans.ranks import weighted_quantile


def _unpivot(df: DataFrame, sensors: Sequence[str], keep: dict[str, Column]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(s).alias("sensor"), missing(df, s).alias("gone"), F.col(s).cast("double").alias("x"))
            for s in sensors
        ]
    )
    return df.select(*[c.alias(n) for n, c in keep.items()], F.inline(entries))


def fault_leakage(
    df: DataFrame, sensors: Sequence[str], in_episode: Column, *, margin: float = 0.05, by: Sequence[str] = ()
) -> DataFrame:
    """Null and saturated-zero rates inside and outside fault episodes, per channel.

    ``suspect`` marks channels whose rates inside exceed those outside by more than
    ``margin``: they announce the fault by their absence.
    """
    long = _unpivot(df, sensors, {**{c: F.col(c) for c in by}, "__in": F.coalesce(in_episode, F.lit(False))})
    zero = (~F.col("gone") & (F.col("x") == 0)).cast("double")

    def rate(e: Column, inside: bool) -> Column:
        return F.avg(F.when(F.col("__in") if inside else ~F.col("__in"), e))

    gone = F.col("gone").cast("double")
    out = long.groupBy(*by, "sensor").agg(
        rate(gone, True).alias("null_inside"),
        rate(gone, False).alias("null_outside"),
        rate(zero, True).alias("zero_inside"),
        rate(zero, False).alias("zero_outside"),
    )
    excess = F.greatest(F.col("null_inside") - F.col("null_outside"), F.col("zero_inside") - F.col("zero_outside"))
    return out.withColumn("suspect", F.coalesce(excess > margin, F.lit(False)))


def shared_instants(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """How many distinct instants two data sets share; 0 for a clean train/test split."""
    shared = a.select(*on).distinct().join(b.select(*on), list(on), "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("n_shared"))


def assert_no_label(test: DataFrame, label: str = "label") -> None:
    """Test inputs must not carry the answer."""
    if label.lower() in (c.lower() for c in test.columns):
        raise ValueError(f"test input carries the label column {label!r}")


def input_contract(
    df: DataFrame, sensors: Sequence[str], by: Sequence[str] = (), *, mean_bound: float = 0.1, std_bound: float = 0.1
) -> DataFrame:
    """Mean and population deviation per sensor, and whether it looks z-scored."""
    long = _unpivot(df, sensors, {c: F.col(c) for c in by})
    out = long.groupBy(*by, "sensor").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count_if("gone").alias("n_missing")
    )
    scored = (F.abs(F.col("mean")) <= mean_bound) & (F.abs(F.col("std") - 1) <= std_bound)
    return out.withColumn("z_scored", scored)


def cadence(
    df: DataFrame, timestamp: str, by: Sequence[str] = (), *, tolerance: float = 0.05, share: float = 0.99
) -> DataFrame:
    """Whether the instants of each series come at a steady pace.

    ``on_pace`` is the share of steps within ``tolerance`` of the median step, and the series is
    ``regular`` when that is at least ``share``.  A series of one instant has no pace.
    """
    steps = delta_counts(df, timestamp, by).filter(F.col("delta_us").isNotNull())
    median = weighted_quantile(steps, by, "delta_us", "n_steps", 0.5, "median_us").drop("n")
    near = F.abs(F.col("delta_us") - F.col("median_us")) <= F.lit(tolerance) * F.col("median_us")
    out = join_on(steps, median, by).groupBy(*by, (F.col("median_us") / MICROS).alias("pace_s")).agg(
        F.sum("n_steps").alias("n_steps"), (F.sum(F.when(near, F.col("n_steps")).otherwise(0)) / F.sum("n_steps")).alias("on_pace")
    )
    return out.withColumn("regular", F.col("on_pace") >= share)


def drift(
    df: DataFrame, period: str, baseline: Column, features: str, by: Sequence[str] = ()
) -> DataFrame:
    """Distance of each period's mean vector to the baseline's mean vector."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    from sensorspark.functions.vectors import doubles, euclidean

    vector = array_to_vector(doubles(features))
    mean = vector_to_array(Summarizer.mean(vector))
    periods = df.groupBy(*by, period).agg(mean.alias("__m"), F.count(F.lit(1)).alias("n"))
    base = df.filter(baseline).groupBy(*by).agg(mean.alias("__b"))
    both = periods.join(base, list(by), "left") if by else periods.join(F.broadcast(base), how="left")
    return both.select(*by, period, "n", euclidean(F.col("__m"), F.col("__b")).alias("drift"))
