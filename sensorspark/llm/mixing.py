"""Mixing sources to target weights with built-in functions only.

Every document gets a hash-random key.  The leading digits of the key cut each source into
ranges of equal width, which are sorted on their own; the sums of the ranges before one give
the offset of its running sums.  A source of any size is so sorted and summed in parallel,
and the documents are taken up to the exact word of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import SPACED_WORD, text_or_empty

WEIGHTS = (5, 2, 1)


def words(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(SPACED_WORD)).cast("long")


def targets(sources: DataFrame, share: float, most: int, weights=WEIGHTS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``; one row per source.

    Sources weigh ``weights`` in turn by code point, NULL last, and share ``share`` times all
    sizes.  No target exceeds ``most`` times its source; what is cut off is shared by weight
    among the others until none is above.  With the sources ordered by cap over weight, those
    that reach their cap come first, so one pass finds the level.
    """
    every = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    by_ratio = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.lit(share) * F.sum("source_size").over(every)
    level = (full - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum(
        "weight"
    ).over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    capped = ranked.withColumn("full", full).withColumn("capped", F.col("cap") <= F.col("weight") * level)
    fixed = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * (F.col("full") - fixed) / open_weight)
    return capped.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, weights=WEIGHTS, seed: str = "mix") -> DataFrame:
    """The columns of ``docs`` (``doc_id``, ``source`` and ``text`` are needed) and ``size``,
    ``source_size``, ``target`` and ``taken``, one row for each row.

    ``taken`` counts the words that the mix takes of the document, with repeats: whole epochs
    of the source, then documents in random order up to the exact word of the budget, so one
    document of a source may be taken in part.  The key depends on ``doc_id`` and ``seed``
    alone; rows with equal keys follow in order of ``doc_id``, size and text hash, so reruns
    agree.  A NULL source is a source of its own; sources without words get nothing.
    Columns of ``docs`` that are named like an added one are replaced.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c.lower() not in added]
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    source_key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    keyed = docs.select(
        F.struct(*kept).alias("row"),
        source_key.alias("source_key"),
        F.col("source").cast("string").alias("source"),
        key.alias("mix_key"),
        F.substring(key, 1, 3).alias("range"),
        F.col("doc_id").alias("tie"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        words().alias("size"),
    )
    ranges = keyed.groupBy("source_key", "source", "range").agg(F.sum("size").alias("range_size"))
    sources = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    goals = targets(sources, share, most, weights)
    goal_key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(F.lit(0))
    plan = (
        ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
        .select("source_key", "range", "offset")
        .join(goals.select(goal_key.alias("source_key"), "source_size", "target"), "source_key")
        .withColumn("epochs", epochs)
        .withColumn("left", budget - F.col("epochs") * F.col("source_size"))
    )
    order = Window.partitionBy("source_key", "range").orderBy("mix_key", "tie", "size", "text_hash")
    ahead = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("offset")
    part = F.least(F.greatest(F.col("left") - ahead, F.lit(0)), F.col("size"))
    return (
        keyed.join(plan, ["source_key", "range"])
        .withColumn("taken", F.col("epochs") * F.col("size") + part)
        .select("row.*", "size", "source_size", "target", "taken")
    )
