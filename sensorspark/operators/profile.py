"""Sampling and missing-data profile of sensor series; never changes its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.columns import MICROS, join_on, micros, missing
from sensorspark.plans.ranks import weighted_quantile
from sensorspark.plans.series import plan_layout, scan
from sensorspark.session import cut

AXIS = "__us"


def time_axis(df: DataFrame, timestamp: str, keys: Sequence[str] = ()) -> DataFrame:
    """Presence, type, time zone, coercibility and range of the time column, per series.

    Only instants have a zone, that of the session; clock times, text and numbers have none.
    """
    kind = df.schema[timestamp].dataType.simpleString() if timestamp in df.columns else None
    if kind is None:
        out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        return out.withColumns({"present": F.lit(False), "dtype": F.lit(None).cast("string"), "timezone": F.lit(None).cast("string")})
    us = micros(df, timestamp)
    rows = df.select(*keys, F.col(timestamp).isNotNull().alias("given"), us.alias(AXIS))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(True).alias("present"),
        F.lit(kind).alias("dtype"),
        (F.current_timezone() if kind == "timestamp" else F.lit(None).cast("string")).alias("timezone"),
        F.bool_and(~F.col("given") | F.col(AXIS).isNotNull()).alias("coercible"),
        F.min(AXIS).alias("min_us"),
        F.max(AXIS).alias("max_us"),
        ((F.max(AXIS) - F.min(AXIS)) / MICROS).alias("duration_s"),
    )


def sorted_in_source(df: DataFrame, timestamp: str, ordinal: str, keys: Sequence[str] = ()) -> DataFrame:
    """Whether time never falls in source order, where ``ordinal`` is that order."""
    rows = df.select(*keys, F.col(ordinal).cast("long").alias("__o"), micros(df, timestamp).alias(AXIS))
    lay = plan_layout(rows, keys, "__o", first_width=1 << 40)
    seen = scan(rows, lay, lag={"__prev": F.col(AXIS)})
    in_order = F.coalesce(F.col(AXIS) >= F.col("__prev"), F.lit(True))
    return seen.groupBy(*keys).agg(F.bool_and(in_order).alias("is_sorted"))


def _steps(df: DataFrame, timestamp: str, keys: Sequence[str]) -> DataFrame:
    """The instants of every series with the number of rows there, ``n``, and the step that leads there.

    Rows of one instant are counted before any row moves, so a burst is one row.
    """
    rows = df.select(*keys, micros(df, timestamp).alias(AXIS)).filter(F.col(AXIS).isNotNull())
    lay = plan_layout(rows, keys, AXIS)
    instants = rows.groupBy(*keys, AXIS).agg(F.count(F.lit(1)).alias("n"))
    seen = scan(instants, lay, lag={"starts_us": F.col(AXIS)})
    return seen.select(
        *keys, "starts_us", F.col(AXIS).alias("ends_us"), (F.col(AXIS) - F.col("starts_us")).alias("delta_us"), "n"
    )


def deltas(df: DataFrame, timestamp: str, keys: Sequence[str] = ()) -> DataFrame:
    """Steps between sorted unique instants: ``starts_us``, ``ends_us``, ``delta_us``."""
    return _steps(df, timestamp, keys).filter(F.col("starts_us").isNotNull()).drop("n")


def delta_counts(df: DataFrame, timestamp: str, keys: Sequence[str] = ()) -> DataFrame:
    """How often each step occurs: ``delta_us, n_steps, n_repeats``; the first instants have no step.

    ``n_repeats`` counts the rows beyond one at the instants behind the steps.  All figures of
    the steps follow from this table, which is written once; regular series have few steps.
    """
    steps = _steps(df, timestamp, keys)
    return cut(steps.groupBy(*keys, "delta_us").agg(F.count(F.lit(1)).alias("n_steps"), F.sum(F.col("n") - 1).alias("n_repeats")))


def sampling(
    df: DataFrame,
    timestamp: str,
    keys: Sequence[str] = (),
    *,
    expected_seconds: float = 60.0,
    gap_multiplier: float = 2.0,
) -> DataFrame:
    """Duplicates, sampling statistics and gap totals, one row per series.

    A gap is a step strictly above ``gap_multiplier`` times the median step.  A series
    with fewer than two instants has NULL sampling columns.
    """
    counted = delta_counts(df, timestamp, keys)
    steps = counted.filter(F.col("delta_us").isNotNull())
    rows = df.select(*keys, micros(df, timestamp).alias(AXIS))
    # Missing instants repeat each other: all but the first are duplicates.
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.greatest(F.lit(0), F.count_if(F.col(AXIS).isNull()) - 1).alias("__gone"),
        F.min(AXIS).alias("min_us"),
        F.max(AXIS).alias("max_us"),
    )
    repeats = counted.groupBy(*keys).agg(F.sum("n_repeats").alias("__repeats"))
    c, delta = F.col("n_steps"), F.col("delta_us")
    mean = (F.sum(c * delta) / F.sum(c)).alias("__mean")
    base = join_on(weighted_quantile(steps, keys, "delta_us", "n_steps", 0.5, "median_us"), steps.groupBy(*keys).agg(mean), keys)
    is_gap = delta > F.lit(gap_multiplier) * F.col("median_us")
    off = (delta - F.col("__mean")) / MICROS
    stats = join_on(steps, base, keys).groupBy(*keys, "median_us", "n").agg(
        (F.min("delta_us") / MICROS).alias("min_delta_s"),
        (F.max("delta_us") / MICROS).alias("max_delta_s"),
        F.sqrt(F.sum(c * off * off) / F.when(F.col("n") > 1, F.col("n") - 1)).alias("__sd"),
        F.coalesce(F.sum(F.when(is_gap, c)), F.lit(0).cast("long")).alias("gap_count"),
        F.coalesce(F.sum(F.when(is_gap, c * delta)) / MICROS, F.lit(0.0)).alias("gap_total_s"),
    )
    out = counts
    for part in (repeats, stats.drop("n")):
        out = join_on(out, part, keys, "left")
    return out.select(
        *keys,
        "n_rows",
        (F.col("__gone") + F.coalesce(F.col("__repeats"), F.lit(0))).alias("n_duplicates"),
        "min_us",
        "max_us",
        (F.col("median_us") / MICROS).alias("median_delta_s"),
        "min_delta_s",
        "max_delta_s",
        F.when(F.col("median_us") > 0, F.col("__sd") / (F.col("median_us") / MICROS)).alias("regularity_cv"),
        (F.col("median_us") == F.lit(expected_seconds * MICROS)).alias("matches_expected"),
        (F.col("median_us") * gap_multiplier / MICROS).alias("gap_threshold_s"),
        "gap_count",
        "gap_total_s",
    )


def top_gaps(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), *, gap_multiplier: float = 2.0, top_n: int = 5
) -> DataFrame:
    """The ``top_n`` largest gaps of each series, ``gap_rank`` 1 being the largest."""
    counted = delta_counts(df, timestamp, keys).filter(F.col("delta_us").isNotNull())
    median = weighted_quantile(counted, keys, "delta_us", "n_steps", 0.5, "median_us").drop("n")
    gaps = join_on(deltas(df, timestamp, keys), median, keys).filter(F.col("delta_us") > F.lit(gap_multiplier) * F.col("median_us"))
    # Spark keeps only the first top_n rows per group on the map side as well.
    w = Window.partitionBy(*keys).orderBy(F.col("delta_us").desc(), F.col("starts_us"))
    return (
        gaps.withColumn("gap_rank", F.row_number().over(w))
        .filter(F.col("gap_rank") <= top_n)
        .select(
            *keys,
            F.col("gap_rank").cast("long").alias("gap_rank"),
            "starts_us",
            "ends_us",
            (F.col("delta_us") / MICROS).alias("size_s"),
        )
    )


def nulls(
    df: DataFrame,
    timestamp: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Missing values per series and column, with the longest run in time order.

    The run a missing row lies in spans from the last present row to the next one,
    so its length is a difference of two positions and no run is ever grouped.
    """
    cols = list(columns) if columns is not None else [
        c for c in df.columns if c not in {timestamp, *keys, *ties}
    ]
    rows = df.select(
        *keys, *ties, micros(df, timestamp).alias(AXIS), *[missing(df, c).alias(c) for c in cols]
    )
    lay = plan_layout(rows, keys, AXIS, ties)
    present = {c: F.when(~F.col(c), F.lit(True)) for c in cols}
    seen = scan(
        rows,
        lay,
        size="__n",
        before={f"__b{i}": present[c] for i, c in enumerate(cols)},
        after={f"__a{i}": present[c] for i, c in enumerate(cols)},
    )
    aggs = []
    for i, c in enumerate(cols):
        run = F.coalesce(F.col(f"__a{i}")["at"], F.col("__n")) - F.coalesce(F.col(f"__b{i}")["at"], F.lit(-1)) - 1
        aggs += [
            F.count_if(F.col(c)).alias(f"__null{i}"),
            F.coalesce(F.max(F.when(F.col(c), run)), F.lit(0)).cast("long").alias(f"__run{i}"),
        ]
    wide = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    entries = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                    F.col(f"__null{i}").alias("n_null"),
                    F.col(f"__run{i}").alias("max_consecutive_null"),
                )
                for i, c in enumerate(cols)
            ]
        )
    )
    long = wide.select(*keys, "n_rows", entries.alias("e")).select(*keys, "n_rows", "e.*")
    pct = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows") * 100).otherwise(0.0)
    return long.withColumn("pct_null", pct)


def columns_with_nulls(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many columns of each series miss a value, and which, from the result of :func:`nulls`."""
    names = F.array_sort(F.collect_list(F.when(F.col("n_null") > 0, F.col("column"))))
    return profile.groupBy(*keys).agg(F.count_if(F.col("n_null") > 0).alias("n_columns"), names.alias("columns"))


def diagnose(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), *, expected_seconds: float = 60.0,
    gap_multiplier: float = 2.0, top_n: int = 5,
) -> dict[str, DataFrame]:
    """The whole report as small tables: ``axis, sampling, gaps, nulls, columns_with_nulls``; the input is unchanged.

    Without a usable time column only ``axis`` is there.
    """
    report = {"axis": time_axis(df, timestamp, keys)}
    if timestamp not in df.columns:
        return report
    if not report["axis"].filter(~F.col("coercible")).isEmpty():
        return report
    report["sampling"] = sampling(df, timestamp, keys, expected_seconds=expected_seconds, gap_multiplier=gap_multiplier)
    report["gaps"] = top_gaps(df, timestamp, keys, gap_multiplier=gap_multiplier, top_n=top_n)
    report["nulls"] = nulls(df, timestamp, keys)
    report["columns_with_nulls"] = columns_with_nulls(report["nulls"], keys)
    return report


def delta_histogram(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), *, bins: int = 50
) -> DataFrame:
    """Equal-width histogram of the steps; the last bin includes its upper edge."""
    steps = delta_counts(df, timestamp, keys).filter(F.col("delta_us").isNotNull())
    span = steps.groupBy(*keys).agg(F.min("delta_us").alias("__lo"), F.max("delta_us").alias("__hi"))
    both = join_on(steps, span, keys)
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    index = F.when(width > 0, F.least(F.floor((F.col("delta_us") - F.col("__lo")) / width), F.lit(bins - 1)))
    return (
        both.groupBy(*keys, F.coalesce(index, F.lit(0)).cast("long").alias("bin"), "__lo", "__hi")
        .agg(F.sum("n_steps").alias("n"))
        .select(
            *keys,
            "bin",
            ((F.col("__lo") + F.col("bin") * width) / MICROS).alias("from_s"),
            "n",
        )
    )


def missing_by_time(
    df: DataFrame, timestamp: str, columns: Sequence[str], keys: Sequence[str] = (), *, width: str = "1 day"
) -> DataFrame:
    """Share of missing values per time bucket and column, the data of a missingness map."""
    rows = df.withColumn("__w", F.window(F.col(timestamp).cast("timestamp"), width)["start"])
    wide = rows.groupBy(*keys, "__w").agg(
        *[F.avg(missing(df, c).cast("int")).alias(c) for c in columns]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rate")) for c in columns])
    return wide.select(
        *keys, F.unix_micros("__w").alias("bucket_us"), F.inline(entries)
    )
