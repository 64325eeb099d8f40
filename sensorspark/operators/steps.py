"""Timestamped procedure steps: temporal matching, merging and document checks."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark.functions.intervals import iou
from sensorspark.functions.sweep import best_overlap
from sensorspark.functions.text import ends_mid_clause, is_advisory, jaccard, tokens
from sensorspark.operators.windows import positions
from sensorspark.plans.series import MAX_BROADCAST_CELLS, explode_range, plan_layout, scan
from sensorspark.session import cut

THRESHOLDS = (0.1, 0.3, 0.5)
# A bucket is crowded when it holds more pairs than this many for each of its intervals.
CROWDED = 64
# Intervals of one side that a task sweeps at once.
SWEPT_ROWS = 50_000
# Intervals of both sides that a task joins, where there are more than a few times as many.
JOINED_ROWS = 500_000


def hull(reference: DataFrame, keys: Sequence[str] = (), step: str = "step") -> DataFrame:
    """One interval per reference step: earliest start and latest end over annotators."""
    return reference.groupBy(*keys, step).agg(F.min("start").alias("start"), F.max("end").alias("end"))


def _spread(df: DataFrame, lo: str, hi: str, bucket: float) -> DataFrame:
    """One row per time bucket that an interval reaches; empty intervals overlap nothing."""
    first, last = F.floor(F.col(lo) / bucket), F.floor(F.col(hi) / bucket)
    return explode_range(df.filter(F.col(hi) > F.col(lo)), "__b", first, last)


def overlap_pairs(
    a: DataFrame, b: DataFrame, keys: Sequence[str], bucket: float, without: DataFrame | None = None, parts: int = 0
) -> DataFrame:
    """Overlapping pairs of ``a(a_start, a_end)`` and ``b(b_start, b_end)``, each exactly once.

    An equi join on time buckets of width ``bucket``; a pair is kept in the first bucket
    both reach.  Only overlapping pairs are produced, never all pairs of a key.  Buckets
    of ``without`` are left out, and a pair is then kept in every other bucket it shares.
    Buckets are dealt to ``parts`` tasks, or to as many as Spark sees fit.
    """
    left, right = _spread(a, "a_start", "a_end", bucket), _spread(b, "b_start", "b_end", bucket)
    if without is not None:
        left, right = (x.join(without, [*keys, "__b"], "left_anti") for x in (left, right))
    if parts:
        left, right = (x.repartition(parts, *keys, "__b") for x in (left, right))
    joined = left.join(right, [*keys, "__b"])
    met = (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    if without is None:
        met = met & (F.col("__b") == F.floor(F.greatest("a_start", "b_start") / bucket))
    return joined.filter(met).drop("__b")


def _crowded(a: DataFrame, b: DataFrame, keys: Sequence[str], bucket: float, crowded: int) -> tuple[DataFrame, int]:
    """``(keys, __b, __na, __nb)`` of the buckets with more than ``crowded`` pairs for each interval, and their number."""
    by = [*keys, "__b"]
    na = _spread(a, "a_start", "a_end", bucket).groupBy(*by).agg(F.count(F.lit(1)).alias("__na"))
    nb = _spread(b, "b_start", "b_end", bucket).groupBy(*by).agg(F.count(F.lit(1)).alias("__nb"))
    full = na.join(nb, by).filter(F.col("__na").cast("double") * F.col("__nb") > crowded * (F.col("__na") + F.col("__nb")))
    full = cut(full)
    return full, full.count()


def _swept(
    a: DataFrame, b: DataFrame, keys: Sequence[str], bucket: float, full: DataFrame, position: str, rows: int
) -> DataFrame:
    """``(keys, a_start, a_end, b_start, b_end)``: the best ``b`` of every ``a`` in the buckets of ``full``, by parts.

    Both sides of a bucket are dealt to parts of about ``rows`` intervals by hash, and each part of
    one meets each part of the other in a task that makes no pairs.
    """
    by = [*keys, "__b"]
    parts = {n: F.ceil(F.col(n) / F.lit(rows)) for n in ("__na", "__nb")}

    def dealt(df: DataFrame, lo: str, hi: str, own: str, other: str) -> DataFrame:
        out = _spread(df, lo, hi, bucket).join(full, by)
        home = F.pmod(F.xxhash64(lo, hi), parts[own])
        return out.withColumn("__home", home).withColumn("__met", F.explode(F.sequence(F.lit(0).cast("long"), parts[other] - 1)))

    left = dealt(a, "a_start", "a_end", "__na", "__nb").withColumnsRenamed({"__home": "__i", "__met": "__j"})
    right = dealt(b, "b_start", "b_end", "__nb", "__na").withColumnsRenamed({"__home": "__j", "__met": "__i"})
    spans = ["a_start", "a_end", "b_start", "b_end"]

    def sweep(key, own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        side = [others[c].to_numpy() for c in ("b_start", "b_end", "__p")]
        _, at = best_overlap(own["a_start"].to_numpy(), own["a_end"].to_numpy(), *side)
        met = at >= 0
        out = {c: own[c].to_numpy()[met] for c in ("a_start", "a_end")}
        out |= {c: others[c].to_numpy()[at[met]] for c in ("b_start", "b_end")}
        same = {k: pd.Series([v] * int(met.sum()), dtype=object) for k, v in zip(keys, key)}
        return pd.DataFrame({**same, **out})

    slot = [*by, "__i", "__j"]
    left = left.select(*slot, *[F.col(c).cast("double").alias(c) for c in spans[:2]])
    right = right.select(*slot, *[F.col(c).cast("double").alias(c) for c in spans[2:]], F.col("__c")[position].alias("__p"))
    kind = T.StructType([*[a.schema[k] for k in keys], *[T.StructField(c, T.DoubleType()) for c in spans]])
    return left.groupBy(*slot).cogroup(right.groupBy(*slot)).applyInPandas(sweep, kind)


def best_match(
    reference: DataFrame, candidates: DataFrame, keys: Sequence[str] = (), *, bucket: float = 60.0,
    position: str = "position", carry: Sequence[str] = (), crowded: int = CROWDED, swept_rows: int = SWEPT_ROWS,
) -> DataFrame:
    """Best temporal IoU of every reference interval, 0 and NULL when nothing overlaps.

    Ties go to the earliest candidate.  Copies of an interval are matched once: both
    sides are reduced to distinct spans first, and the best is combined before the shuffle.
    A bucket with few pairs is joined; in one with more than ``crowded`` for each interval the
    intervals are packed into blocks, and a block meets those whose bound on the IoU can win.
    """
    # Numbers are combined in a hash table, structs only after a sort.
    least = F.min_by(F.struct(position, *carry), position) if carry else F.struct(F.min(position).alias(position))
    spans = candidates.groupBy(*keys, F.col("start").alias("b_start"), F.col("end").alias("b_end")).agg(least.alias("__c"))
    asked = reference.select(*keys, F.col("start").alias("a_start"), F.col("end").alias("a_end")).distinct()
    full, n_full = _crowded(asked, spans, keys, bucket, crowded)
    value = iou(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"))
    side = F.broadcast(full) if n_full <= MAX_BROADCAST_CELLS else full
    without = side.select(*keys, "__b") if n_full else None
    rows = reference.count() + candidates.count()
    # Spark joins parts together until they hold many rows; here a task's rows do not grow with the tables.
    parts = -(-rows // JOINED_ROWS) if rows > 8 * JOINED_ROWS else 0
    # A maximum of numbers is kept in a hash table, one of structs sorts all pairs of a task. So the
    # pairs are met once for the maximum and once for those that reach it, which are few.
    top = overlap_pairs(asked, spans.drop("__c"), keys, bucket, without, parts).groupBy(*keys, "a_start", "a_end").agg(F.max(value).alias("__top"))
    aimed = cut(top)
    pairs = overlap_pairs(aimed, spans, keys, bucket, without, parts).filter(value == F.col("__top")).drop("__top")
    if n_full:
        won = _swept(asked, spans, keys, bucket, side, position, swept_rows)
        known = spans.select(*keys, *[F.col(c).cast("double").alias(c) for c in ("b_start", "b_end")], "__c")
        pairs = pairs.unionByName(won.join(known, [*keys, "b_start", "b_end"]))
    pairs = pairs.withColumn("iou", value)
    best = pairs.groupBy(*keys, "a_start", "a_end").agg(
        F.max_by(F.struct("iou", "__c"), F.struct("iou", (-F.col("__c")[position]).alias("p"))).alias("__m")
    )
    best = best.withColumnsRenamed({"a_start": "start", "a_end": "end"})
    out = reference.join(best, [*keys, "start", "end"], "left")
    return out.select(
        *reference.columns,
        F.coalesce(F.col("__m")["iou"], F.lit(0.0)).alias("iou"),
        F.col("__m")["__c"][position].alias(position),
        *[F.col("__m")["__c"][c].alias(c) for c in carry],
    )


def recall(matches: DataFrame, keys: Sequence[str] = (), thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Reference-step recall per IoU threshold and the mean IoU of matched steps.

    There is no precision: a predicted step without a reference is not necessarily wrong.
    """
    cuts = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    rows = matches.select(*keys, "iou", cuts)
    return rows.groupBy(*keys, "threshold").agg(
        F.count_if(F.col("iou") >= F.col("threshold")).alias("hits"),
        F.count(F.lit(1)).alias("n_reference"),
        F.avg((F.col("iou") >= F.col("threshold")).cast("double")).alias("recall"),
        F.avg(F.when(F.col("iou") > 0, F.col("iou"))).alias("mean_iou"),
    )


def score_manual(steps: DataFrame, reference: DataFrame, keys: Sequence[str] = (), *, bucket: float = 60.0) -> DataFrame:
    """Best match of each reference step among the predicted steps that are not cautions."""
    usable = steps.filter(~is_advisory(F.col("instruction"))).select(
        *keys,
        F.col("step").alias("position"),
        F.col("timestamp_start").alias("start"),
        F.col("timestamp_end").alias("end"),
        "instruction",
    )
    return best_match(hull(reference, keys), usable, keys, bucket=bucket, carry=["instruction"])


def _rare_words(sides: DataFrame, clip: str, similarity: float) -> DataFrame:
    """``(clip, id, h, word)``: the rarest words of each step, of which similar steps share at least one.

    Texts of ``n`` words that agree to ``similarity`` share ``similarity * n`` of them at least, so one is
    among the first ``n - ceil(similarity * n) + 1`` in any common order; here, rarest in the clip first.
    """
    said = sides.select(clip, "id", "h", F.explode("words").alias("word"))
    often = said.groupBy(clip, "word").agg(F.count(F.lit(1)).alias("n"))
    ranked = said.join(often, [clip, "word"]).groupBy(clip, "id", "h").agg(F.array_sort(F.collect_set(F.struct("n", "word"))).alias("ranked"))
    n = F.size("ranked")
    # A little room for products that are whole numbers but for their last bit.
    first = n - F.ceil(similarity * n - 1e-9).cast("int") + 1
    return ranked.select(clip, "id", "h", F.explode(F.slice("ranked", F.lit(1), first)["word"]).alias("word"))


def merge_chunks(
    steps: DataFrame, clip: str, *, chunk: str = "chunk", offset: str = "chunk_start", similarity: float = 0.6,
    bucket: float = 30.0, text: str = "instruction", crowded: int = CROWDED,
) -> DataFrame:
    """Chunk-local steps on one timeline, without the duplicates of the chunk overlap.

    A step is dropped only when a step of an earlier chunk overlaps it in time *and* has
    similar words; similarity alone would delete real repetitions.  Steps are renumbered
    from 0 in time order.  Steps meet in time buckets; where a bucket has more than ``crowded``
    pairs for each step, they meet under a rare word and a bucket, which costs a copy of the
    step for each rare word.  Words are fetched for the pairs that overlap.
    """
    if not 0 < similarity <= 1:
        raise ValueError(f"similarity must be above 0 and at most 1, got {similarity}")
    placed = steps.withColumns(
        {
            "start": F.col("timestamp_start") + F.col(offset),
            "end": F.col("timestamp_end") + F.col(offset),
            "__id": F.struct(F.col(chunk).alias("c"), F.col("step").alias("s")),
        }
    )
    # Steps that repeat a number are told apart by their text.
    sides = placed.select(clip, F.col("__id").alias("id"), F.xxhash64(text).alias("h"), "start", "end", tokens(F.col(text)).alias("words"))
    timed = sides.select(clip, "id", "h", "start", "end")

    def side(rows: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
        return rows.select(*by, F.struct("id", "h").alias(x), F.col("start").alias(f"{x}_start"), F.col("end").alias(f"{x}_end"))

    by = [clip]
    if _crowded(side(timed, "a", by), side(timed, "b", by), by, bucket, crowded)[1]:
        by = [clip, "word"]
        timed = timed.join(_rare_words(sides, clip, similarity), [clip, "id", "h"])
    met = overlap_pairs(side(timed, "a", by), side(timed, "b", by), by, bucket).filter(F.col("a")["id"]["c"] < F.col("b")["id"]["c"])
    said = sides.select(clip, F.struct("id", "h").alias("at"), "words").distinct()
    pairs = met.select(clip, "a", "b").distinct()
    for x in ("a", "b"):
        pairs = pairs.join(said.withColumnsRenamed({"at": x, "words": f"w{x}"}), [clip, x])
    twins = pairs.filter(jaccard(F.col("wa"), F.col("wb")) >= similarity).select(clip, F.col("b")["id"].alias("__id")).distinct()
    kept = placed.join(twins, [clip, "__id"], "left_anti").drop("__id", "step")
    return positions(kept, "start", [clip], [chunk], pos="step", size="__n").drop("__n", "timestamp_start", "timestamp_end", offset)


def coverage(steps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Steps, first and last second and the uncovered time between consecutive steps."""
    rows = steps.withColumn("__s", F.col("step").cast("long"))
    lay = plan_layout(rows, keys, "__s", first_width=1 << 20)
    seen = scan(rows, lay, lag={"__pe": F.col("timestamp_end")})
    gap = F.greatest(F.lit(0.0), F.col("timestamp_start") - F.col("__pe"))
    return seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.min("timestamp_start").alias("first_s"),
        F.max("timestamp_end").alias("last_s"),
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("gap_s"),
    )


def document_checks(steps: DataFrame, keys: Sequence[str], fps: float | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Step numbers run from 0 without holes, steps tile the timeline, frames match the rate."""
    rows = steps.withColumn("__s", F.col("step").cast("long"))
    lay = plan_layout(rows, keys, "__s", first_width=1 << 20)
    seen = scan(rows, lay, lag={"__pe": F.col("timestamp_end")})
    joins = F.abs(F.col("timestamp_start") - F.col("__pe")) <= tolerance
    aggs = [
        F.count(F.lit(1)).alias("n_steps"),
        ((F.min("step") == 0) & (F.max("step") + 1 == F.count(F.lit(1))) & (F.count_distinct("step") == F.count(F.lit(1)))).alias("numbered"),
        F.coalesce(F.bool_and(joins), F.lit(True)).alias("tiles"),
        ends_mid_clause(F.max_by("instruction", "step")).alias("truncated"),
    ]
    if fps is not None:
        on_rate = (F.abs(F.col("frame_start") - F.col("timestamp_start") * fps) <= 0.5) & (
            F.abs(F.col("frame_end") - F.col("timestamp_end") * fps) <= 0.5
        )
        aggs.append(F.bool_and(on_rate).alias("frames_match"))
    return seen.groupBy(*keys).agg(*aggs)
