"""Run outcomes from log rows, output sanity and missing runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import truthy

# Event types that end a run.
TERMINAL_EVENTS = ("pod.terminated", "job.completed", "job.failed", "job.canceled")


def _has(text: Column, *needles: str) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(n))
    return out


def failure_row() -> Column:
    """An error level or an explicit failing exit; the word "terminated" alone is no failure."""
    level = F.lower(F.coalesce(F.col("level"), F.lit("")))
    return level.isin("error", "critical") | _has(F.col("message"), "exit=1", "error (exit")


def success_row() -> Column:
    return _has(F.col("message"), "terminated successfully", "completed successfully")


def outcome_by_message(logs: DataFrame, run: str = "run_id") -> DataFrame:
    """Failed on any failure row, else completed on a success row, else running."""
    out = logs.groupBy(run).agg(F.bool_or(failure_row()).alias("__bad"), F.bool_or(success_row()).alias("__good"))
    return out.select(
        run,
        F.when(F.col("__bad"), "failed").when(F.col("__good"), "completed").otherwise("running").alias("outcome"),
    )


def outcome_by_event(
    logs: DataFrame, run: str = "run_id", *, tie: str = "id", deadline_us: int | None = None,
    overflow_phrase: str | None = "reasoning block",
) -> DataFrame:
    """The newest row must be terminal; then any ERROR means failed, else completed.

    A WARN with ``overflow_phrase`` means the output budget was spent before any answer.
    Without a terminal event the run is running, or timed out once its first row is older
    than ``deadline_us`` (an instant) allows.
    """
    overflow = F.lit(False)
    if overflow_phrase:
        overflow = (F.col("level") == "WARN") & F.contains(F.coalesce(F.col("message"), F.lit("")), F.lit(overflow_phrase))
    out = logs.groupBy(run).agg(
        F.max_by("event_type", F.struct("created_at", tie)).alias("__last"),
        F.bool_or(F.coalesce(F.col("level") == "ERROR", F.lit(False))).alias("__bad"),
        F.bool_or(F.coalesce(overflow, F.lit(False))).alias("__spent"),
        F.min(F.unix_micros(F.col("created_at").cast("timestamp"))).alias("__from"),
    )
    over = F.lit(False) if deadline_us is None else F.col("__from") <= deadline_us
    return out.select(
        run,
        F.when(
            F.coalesce(F.col("__last").isin(*TERMINAL_EVENTS), F.lit(False)),
            F.when(F.col("__bad"), "failed").when(F.col("__spent"), "empty-reasoning-overflow").otherwise("completed"),
        )
        .otherwise(F.when(over, "timeout").otherwise("running"))
        .alias("outcome"),
    )


def settle(outcomes: DataFrame, results: DataFrame, run: str = "run_id") -> DataFrame:
    """Results outrank the reported status: a run with results succeeded.

    A run reported as completed without any result is ``empty``.
    """
    counts = results.groupBy(run).agg(F.count(F.lit(1)).alias("n_results"))
    out = outcomes.join(counts, run, "left").withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    settled = (
        F.when(F.col("n_results") > 0, "succeeded")
        .when(F.col("outcome") == "completed", "empty")
        .otherwise(F.col("outcome"))
    )
    return out.withColumn("settled", settled)


def dropped_rows(logs: DataFrame, *, large: int = 10, message: str = "message") -> DataFrame:
    """Rows of logs that report "dropping N ... row(s)", with what the count suggests."""
    n = F.regexp_extract(message, r"(?i)dropping (\d+)\b", 1)
    out = logs.withColumn("dropped", F.when(n != "", n.cast("long"))).filter(F.col("dropped").isNotNull())
    return out.withColumn(
        "diagnosis",
        F.when(F.col("dropped") == 0, "never converged")
        .when(F.col("dropped") >= large, "repetition")
        .otherwise("cut after drafting"),
    )


def output_sanity(expected: DataFrame, output: DataFrame, run: str = "run_id", *, status: str | None = None) -> DataFrame:
    """Every expected run with its rows: none at all, all invalid, or all steps missing."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if "invalid" in output.columns:
        aggs.append(F.bool_and(truthy(F.col("invalid"))).alias("all_invalid"))
    if status:
        aggs.append(F.bool_and(F.upper(F.col(status)) == "MISSING").alias("all_missing"))
    out = expected.select(run).distinct().join(output.groupBy(run).agg(*aggs), run, "left")
    fills = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("all_invalid", "all_missing") if c in out.columns}
    out = out.withColumns({"n_rows": F.coalesce(F.col("n_rows"), F.lit(0).cast("long")), **fills})
    usable = F.col("n_rows") > 0
    for c in fills:
        usable = usable & ~F.col(c)
    return out.withColumn("usable", usable)


def missing_runs(expected: DataFrame, output: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected keys without any output row."""
    return expected.join(output.select(*on), list(on), "left_anti")
