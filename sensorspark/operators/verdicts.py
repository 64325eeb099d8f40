"""Per-step verdicts against expected outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.functions.text import labels_in_name

BROADCAST_BYTES = 32 << 20

# The statuses a verdict can have; only the first means "done correctly".
STATUSES = ("PASSED", "FAILED", "MISSING")


def collapse(rows: DataFrame, keys: Sequence[str], *, order: str, rule: str = "informative") -> DataFrame:
    """One verdict per step.

    ``informative`` prefers rows with times, then with a real reason, then the later row;
    ``last`` keeps the last row.  One combinable aggregate, so repeated rows of a step
    shrink before the shuffle.
    """
    if rule not in ("informative", "last"):
        raise ValueError(f"rule {rule!r} is neither 'informative' nor 'last'")
    others = [c for c in rows.columns if c not in (*keys, "step")]
    rank = [F.col(order).alias("o")]
    if rule == "informative":
        timed = F.col("timestamp_start").isNotNull() & F.col("timestamp_end").isNotNull()
        bare = F.regexp_replace(F.coalesce(F.col("reason"), F.lit("")), r"[\s.…]+", "") == ""
        rank = [timed.alias("t"), (~bare).alias("r"), *rank]
    best = rows.groupBy(*keys, "step").agg(F.max_by(F.struct(*others), F.struct(*rank)).alias("__r"))
    return best.select(*keys, "step", "__r.*")


def expected_from_names(names: DataFrame, keys: Sequence[str], *candidates: str) -> DataFrame:
    """Expected outcomes ``(keys, step_no, expected)`` from the first name that carries any."""
    usable = [F.when(F.size(labels_in_name(F.col(c))) > 0, labels_in_name(F.col(c))) for c in candidates]
    return names.select(*keys, F.explode(F.coalesce(*usable)).alias("step_no", "expected"))


def score(verdicts: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each expected step with its verdict; reported steps count from 0, expected ones from 1.

    A step that was never reported is wrong, whatever was expected of it.
    """
    got = verdicts.select(*keys, (F.col("step") + 1).alias("step_no"), F.upper("status").alias("status"))
    out = expected.join(got, [*keys, "step_no"], "left")
    right = (F.col("status") == "PASSED") == F.col("expected")
    return out.withColumns(
        {"correct": F.coalesce(right, F.lit(False)), "status": F.coalesce(F.col("status"), F.lit("NOT REPORTED"))}
    )


def summarise(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Correct steps per clip; ``one_sided`` marks label sets that are all pass."""
    return scored.groupBy(*keys).agg(
        F.count_if("correct").alias("correct"),
        F.count(F.lit(1)).alias("n_steps"),
        F.count_if(F.col("status") == "NOT REPORTED").alias("unreported"),
        F.bool_and("expected").alias("one_sided"),
    )


def status_split(verdicts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """PASSED, FAILED and MISSING stay apart; a MISSING row with times is malformed."""
    status = F.upper("status")
    timed = F.col("timestamp_start").isNotNull() | F.col("timestamp_end").isNotNull()
    return verdicts.groupBy(*keys).agg(
        *[F.count_if(status == s).alias(f"n_{s.lower()}") for s in STATUSES],
        F.count_if((status == "MISSING") & timed).alias("malformed"),
    )


def majority(calls: DataFrame, keys: Sequence[str], verdict: str = "status") -> DataFrame:
    """Most frequent verdict of repeated calls with its share; ties go to the smaller verdict."""
    counts = calls.groupBy(*keys, verdict).agg(F.count(F.lit(1)).alias("__c"))
    pick = F.struct((-F.col("__c")).alias("c"), F.col(verdict).alias("v"))
    return counts.groupBy(*keys).agg(
        F.min_by(verdict, pick).alias("verdict"),
        (F.max("__c") / F.sum("__c")).alias("agreement"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


def pair_procedures(videos: DataFrame, procedures: DataFrame, *, video: str, stem: str, default: str | None = None) -> DataFrame:
    """The procedure of each video: the longest stem its name contains, ties by name.

    A single procedure serves every video.  Containment is an equi join between the
    stems and the substrings of each name that have the length of some stem, so no
    video meets every procedure.  Without a match the video takes ``default`` or is dropped.
    """
    stems = procedures.select(F.col(stem).alias("__stem")).filter(F.length("__stem") > 0).distinct()
    shape = stems.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("__stem")).alias("bytes"),
        F.array_sort(F.collect_set(F.length("__stem"))).alias("lengths"), F.max("__stem").alias("any"),
    ).first()
    if shape["n"] == 1:
        return videos.withColumn("procedure", F.lit(shape["any"]))
    if shape["n"] and shape["bytes"] <= BROADCAST_BYTES:
        stems = F.broadcast(stems)
    sizes = F.array(*[F.lit(n) for n in shape["lengths"]]).cast("array<int>")
    names = videos.select(video).distinct()
    sized = names.withColumn("__n", F.explode(sizes)).filter(F.length(video) >= F.col("__n"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.length(video) - F.col("__n") + 1), lambda i: F.substring(F.col(video), i, F.col("__n"))
    )
    parts = sized.select(video, F.explode(F.array_distinct(cuts)).alias("__stem"))
    order = F.struct((-F.length("__stem")).alias("n"), F.col("__stem").alias("s"))
    chosen = parts.join(stems, "__stem").groupBy(video).agg(F.min_by("__stem", order).alias("procedure"))
    if default is None:
        return videos.join(chosen, video)
    out = videos.join(chosen, video, "left")
    return out.withColumn("procedure", F.coalesce("procedure", F.lit(default)))
