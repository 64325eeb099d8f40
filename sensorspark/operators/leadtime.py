"""Run-to-failure scoring: sustained crossings, lead time and its breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import MICROS, join_on, micros, truthy
from sensorspark.operators.evaluate import binary
from sensorspark.operators.windows import positions
from sensorspark.plans.ranks import exact_quantile
from sensorspark.plans.series import explode_range, plan_layout, scan

AXIS = "__us"
SUSTAIN = 3


def sustained(
    flags: DataFrame, order: str, over: str, keys: Sequence[str] = (), sustain: int = SUSTAIN
) -> DataFrame:
    """Add ``streak``: how many rows up to this one are over the line without a miss."""
    lay = plan_layout(flags, keys, order, first_width=1 << 22)
    seen = scan(flags, lay, pos="__pos", upto={"__miss": F.when(~F.col(over), F.lit(True))})
    streak = F.col("__pos") - F.coalesce(F.col("__miss")["at"], F.lit(-1))
    return lay.detach(seen.withColumn("streak", streak)).drop("__pos", "__miss")


def first_sustained(
    flags: DataFrame, order: str, over: str, keys: Sequence[str] = (), sustain: int = SUSTAIN
) -> DataFrame:
    """The first row of the first streak of ``sustain`` crossings, per series."""
    runs = sustained(flags, order, over, keys, sustain).filter(F.col("streak") == sustain)
    # The order column counts snapshots without holes, so the streak began sustain - 1 earlier.
    return runs.groupBy(*keys).agg((F.min(order) - (sustain - 1)).alias("detected_at"))


def snapshots_over(
    output: DataFrame,
    labels: DataFrame,
    threshold: float,
    *,
    finish: str = "finish_timestamp",
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    snapshot: str = "snapshot_index",
    score: str = "anomaly_score",
) -> DataFrame:
    """One row per snapshot: ``over`` when any of its windows is above the threshold.

    Windows are assigned by position in time order: the number of windows per snapshot
    is the ratio of label rows to distinct snapshots, at least 1.
    """
    ratio = labels.groupBy(*keys).agg(
        F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / F.count_distinct(snapshot))).alias("__wps")
    )
    placed = positions(output, finish, keys, ties, pos="__pos", size="__n")
    sized = placed.join(ratio, list(keys), "left") if keys else placed.join(F.broadcast(ratio), how="left")
    index = F.floor(F.col("__pos") / F.coalesce(F.col("__wps"), F.lit(1)))
    high = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) > threshold
    return sized.groupBy(*keys, index.alias("snapshot")).agg(F.bool_or(high).alias("over"))


def snapshots_at(
    output: DataFrame,
    labels: DataFrame,
    threshold: float,
    *,
    finish: str = "finish_timestamp",
    window_end: str = "window_end_timestamp",
    keys: Sequence[str] = (),
    snapshot: str = "snapshot_index",
    score: str = "anomaly_score",
) -> DataFrame:
    """Like ``snapshots_over`` for labels that know when their windows end: windows are assigned by time.

    A window belongs to the snapshot of the label row with its end, the smallest if several have it;
    a window whose end no label row has belongs to none.  Snapshots without a window, between
    the first and the last label, are not over, so lost windows never move the others.  Both
    sides are reduced to instants before they meet.
    """
    number = F.col(snapshot).cast("long")
    known = labels.select(*keys, micros(labels, window_end).alias(AXIS), number.alias("snapshot")).filter(F.col("snapshot").isNotNull())
    known = known.groupBy(*keys, AXIS).agg(F.min("snapshot").alias("snapshot"))
    high = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) > threshold
    seen = output.select(*keys, micros(output, finish).alias(AXIS), high.alias("over")).groupBy(*keys, AXIS).agg(F.bool_or("over").alias("over"))
    met = join_on(known, seen, [*keys, AXIS]).groupBy(*keys, "snapshot").agg(F.bool_or("over").alias("over"))
    ends = known.groupBy(*keys).agg(F.min("snapshot").alias("__lo"), F.max("snapshot").alias("__hi"))
    every = explode_range(ends, "snapshot", F.col("__lo"), F.col("__hi")).select(*keys, "snapshot")
    blank = every.withColumn("over", F.lit(False))
    return met.unionByName(blank).groupBy(*keys, "snapshot").agg(F.bool_or("over").alias("over"))


def score_runs(
    output: DataFrame,
    labels: DataFrame,
    threshold: float,
    *,
    finish: str = "finish_timestamp",
    keys: Sequence[str] = (),
    snapshot: str = "snapshot_index",
    hours_to_end: str = "operating_hours_to_end",
    label_order: str = "window_end_timestamp",
    score: str = "anomaly_score",
    invalid: str = "invalid",
    sustain: int = SUSTAIN,
    ties: Sequence[str] = (),
    by_time: bool = False,
) -> DataFrame:
    """Lead time and crossing rate of each run.

    Windows are counted, not judged: a run to failure has no per-window truth, so there
    is no precision or recall.  Detection needs ``sustain`` consecutive snapshots over
    the line; the lead is the hours to the end of the record at the first of them.  Windows go
    to snapshots by their position, or by their end with ``by_time`` (``label_order`` then holds
    the end of the window of a label row); ``ties`` orders windows that end together.
    """
    s = F.col(score).cast("double")
    base = output.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(truthy(F.col(invalid))).alias("invalid"),
        F.max(s).alias("max_score"),
        F.count_if(F.coalesce(s > threshold, F.lit(False))).alias("crossings"),
        (F.count_if(F.coalesce(s > threshold, F.lit(False))) / F.count(s)).alias("crossing_rate"),
    )
    mid = exact_quantile(output.withColumn("__s", s), keys, "__s", 0.5, "median_score").drop("n")
    names = {"finish": finish, "keys": keys, "snapshot": snapshot, "score": score}
    if by_time:
        over = snapshots_at(output, labels, threshold, window_end=label_order, **names)
    else:
        over = snapshots_over(output, labels, threshold, ties=ties, **names)
    total = over.groupBy(*keys).agg(F.count(F.lit(1)).alias("snapshots"))
    first = first_sustained(over, "snapshot", "over", keys, sustain)
    hours = labels.groupBy(*keys, F.col(snapshot).cast("long").alias("detected_at")).agg(
        F.min_by(F.col(hours_to_end).cast("double"), label_order).alias("lead_hours")
    )
    hit = first.join(hours, [*keys, "detected_at"], "left")
    out = base
    for part in (mid, total, hit):
        out = out.join(part, list(keys), "left") if keys else out.join(F.broadcast(part), how="left")
    return out.withColumn("detected", F.col("detected_at").isNotNull())


def false_alarms(windows: DataFrame, threshold: float, by: Sequence[str] = (), score: str = "anomaly_score") -> DataFrame:
    """Crossing rate on assets that never failed, outside the reference region."""
    clean = windows.filter(~truthy(F.col("failed")) & ~truthy(F.col("in_reference")))
    return clean.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.count_if(F.col(score) > threshold).alias("n_crossings"),
        F.avg((F.col(score) > threshold).cast("double")).alias("crossing_rate"),
    )


def by_failure_mode(runs: DataFrame, mode: str, asset: str, held_out: Sequence[str] = ()) -> DataFrame:
    """Detection per failure mode and asset with subtotals; NULL marks a total row.

    ``held_out`` names the modes unseen when the configuration was chosen.
    """
    out = runs.rollup(mode, asset).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("detected")).alias("n_detected"),
        F.avg("lead_hours").alias("mean_lead_hours"),
        F.grouping_id().cast("long").alias("level"),
    )
    return out.withColumn("held_out", F.coalesce(F.col(mode).isin(*held_out), F.lit(False)) if held_out else F.lit(False))


def onset_sweep(
    windows: DataFrame, threshold: float, cuts: Sequence[float], *, hours_to_end: str = "operating_hours_to_end",
    score: str = "anomaly_score", by: Sequence[str] = (),
) -> DataFrame:
    """Window precision and recall at each candidate onset cut (hours before the end)."""
    rows = windows.select(
        *by,
        F.explode(F.array(*[F.lit(float(c)) for c in cuts])).alias("onset_cut_h"),
        F.col(hours_to_end).alias("__h"),
        (F.col(score) > threshold).alias("__p"),
    ).withColumn("__t", F.col("__h") <= F.col("onset_cut_h"))
    return binary(rows, "__t", "__p", True, [*by, "onset_cut_h"])


def onset_range(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall as ranges over the cuts, never a single number."""
    return sweep.groupBy(*by).agg(
        F.min("precision").alias("precision_low"),
        F.max("precision").alias("precision_high"),
        F.min("recall").alias("recall_low"),
        F.max("recall").alias("recall_high"),
    )


def operating_time(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), ties: Sequence[str] = (), *, stop_s: float
) -> DataFrame:
    """Add ``operating_us``: time since the first row with steps above ``stop_s`` counted as 0."""
    rows = df.withColumn(AXIS, micros(df, timestamp))
    lay = plan_layout(rows, keys, AXIS, ties)
    seen = scan(rows, lay, lag={"__pt": F.col(AXIS)})
    step = F.coalesce(F.col(AXIS) - F.col("__pt"), F.lit(0))
    running = F.when(step <= int(stop_s * MICROS), step).otherwise(F.lit(0).cast("long"))
    out = scan(seen.withColumn("__step", running), lay, total={"operating_us": F.col("__step")})
    return lay.detach(out).drop(AXIS, "__pt", "__step")
