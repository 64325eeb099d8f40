"""Order MinHash fingerprints with built-in functions only.

The k-mers of a text (five words) are numbered by occurrence, so repeats count.  One hash
deals the numbered k-mers to bins; the smallest of each bin is selected; two bins make a
tuple, whose k-mers stand in the order they have in the text; and the tuple's hash is one
slot of the fingerprint.  Two texts agree in a slot if they share its k-mers and their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import numbered
from sensorspark.session import cut

SLOTS = 32
K = 5


def kmers(texts: DataFrame, k: int = K) -> DataFrame:
    """``texts`` with ``hashes``: of all runs of ``k`` words of ``text``; a shorter text with words is one run.

    Each step is a column of its own, so that it is computed once however often it is read.
    """
    run = rf"(?<!\S)(?=(\S++(?:\s++\S++){{{k - 1}}}))"
    found = texts.withColumn("found", F.regexp_extract_all("text", F.lit(run), F.lit(1)))
    whole = F.regexp_extract_all("text", F.lit(r"(?s)^\s*(\S.*)"), F.lit(1))
    runs = F.when(F.size("found") > 0, F.col("found")).otherwise(whole)
    return found.withColumn("hashes", F.transform(runs, lambda x: F.xxhash64(x))).drop("found")


def occurrences(hashes: Column) -> Column:
    """The hashes in text order, those of a k-mer that repeats hashed with its occurrence.

    Sorted by hash and place, equal k-mers are runs; each run numbers its own members, so the
    work is linear after the sort.  Texts without a repeat skip it.
    """
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def number(s: Column) -> Column:
        n = F.size(s)
        begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i)["h"] != F.get(s, i - 1)["h"]))
        ends = F.concat(F.slice(begins, 2, n), F.array(n))
        runs = F.zip_with(
            begins,
            ends,
            lambda a, b: F.transform(
                F.slice(s, a + 1, b - a),
                lambda x, j: F.struct(x["at"].alias("at"), F.when(j == 0, x["h"]).otherwise(F.xxhash64(x["h"], j)).alias("h")),
            ),
        )
        return F.flatten(runs)

    # One element, so that the sorted array is computed once and bound to a name.
    in_runs = F.flatten(F.transform(F.array(ordered), number))
    in_order = F.transform(F.sort_array(in_runs), lambda x: x["h"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(in_order)


def sketches(texts: DataFrame, by: list[str], k: int = K, slots: int = SLOTS) -> DataFrame:
    """``by`` and ``sketch`` (``slots`` hashes, NULL where no k-mer fell into either bin).

    ``texts`` has the columns ``by`` and ``text``; rows of one ``by`` are in one task.
    """
    bins = 2 * slots
    rows = kmers(texts, k).select(*by, F.posexplode_outer(occurrences(F.col("hashes"))).alias("at", "h"))
    # Rank in the high bits, place in the text in the low ones: the smallest is the selected k-mer.
    packed = F.shiftleft(F.shiftrightunsigned("h", 30), 29).bitwiseOR(F.col("at").cast("long"))
    rows = rows.select(*by, F.pmod("h", F.lit(bins)).alias("bin"), packed.alias("packed"))
    least = rows.groupBy(*by).agg(*[F.min(F.when(F.col("bin") == b, F.col("packed"))).alias(f"b{b}") for b in range(bins)])
    place = (1 << 29) - 1

    def slot(j: int) -> Column:
        x, y = F.col(f"b{2 * j}"), F.col(f"b{2 * j + 1}")
        first, second = F.shiftright(x, 29), F.shiftright(y, 29)
        in_order = F.coalesce(x.bitwiseAND(F.lit(place)) <= y.bitwiseAND(F.lit(place)), F.lit(True))
        return F.when(F.coalesce(x, y).isNotNull(), F.xxhash64(F.coalesce(first, F.lit(-1)), F.coalesce(second, F.lit(-1)), in_order))

    return least.select(*by, F.array(*[slot(j) for j in range(slots)]).alias("sketch"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those that either text fills; 1 for two texts without words."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False)).cast("int")))
    filled = F.filter(same, lambda s: s.isNotNull())
    total = F.aggregate(filled, F.lit(0), lambda acc, s: acc + s)
    return F.when(F.size(filled) == 0, F.lit(1.0)).otherwise(total / F.size(filled))


def as_text(sketch: Column) -> Column:
    """Eight hex digits a slot, dashes for an empty one."""
    return F.array_join(F.transform(sketch, lambda s: F.coalesce(F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), F.lit("--------"))), "")


def following(rows: DataFrame) -> DataFrame:
    """``(key, copy, doc_id, n_chars, next_key, next_copy)``: the next row in descending order, the first after the last.

    Only ids and lengths are range-partitioned; the rows on either side of a partition's
    edge meet through one row for each partition.
    """
    ids = rows.select("key", "copy", "doc_id", F.length("text").alias("n_chars"))
    dealt = cut(ids.repartitionByRange(F.col("key").desc(), F.col("copy").desc()).withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy(F.col("key").desc(), F.col("copy").desc())
    inner = dealt.withColumn("next", F.lead(F.struct("key", "copy")).over(order))
    edges = dealt.groupBy("part").agg(F.max(F.struct("key", "copy")).alias("head"))
    every = Window.partitionBy(F.lit(1)).orderBy("part")
    top = F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = edges.select("part", F.coalesce(F.lead("head").over(every), top).alias("beyond"))
    # Bounded: one row for each partition.
    joined = inner.join(F.broadcast(edges), "part").withColumn("next", F.coalesce("next", "beyond"))
    return joined.select("key", "copy", "doc_id", "n_chars", F.col("next.key").alias("next_key"), F.col("next.copy").alias("next_copy"))


def compare_edits(docs: DataFrame, k: int = K, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    One row for each row of ``docs``.  The edited text has its last ``floor(n_chars / 2)`` code
    points replaced by the first as many (or all) of the next document in descending order.
    """
    rows = numbered(docs)
    after = cut(following(rows))
    texts = rows.select("key", "copy", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    wanted = after.select(F.col("key").alias("for_key"), F.col("copy").alias("for_copy"), half.alias("half"), F.col("next_key").alias("key"), F.col("next_copy").alias("copy"))
    heads = texts.join(wanted, ["key", "copy"]).select(
        F.col("for_key").alias("key"), F.col("for_copy").alias("copy"), "half", F.expr("substring(text, 1, half)").alias("head")
    )
    both = texts.join(heads, ["key", "copy"])
    edited = "concat(substring(text, 1, length(text) - half), head)"
    sides = both.select("key", "copy", F.expr(f"inline(array(struct(0 as side, text as text), struct(1 as side, {edited} as text)))"))
    marked = sides.select("key", "copy", F.when(F.col("side") == 1, F.sha2("text", 256)).alias("sha"), "text")
    prints = sketches(marked, ["key", "copy", "sha"], k, slots)
    pairs = prints.groupBy("key", "copy").agg(
        F.max("sha").alias("edited_sha256"),
        F.max(F.when(F.col("sha").isNull(), F.col("sketch"))).alias("sketch"),
        F.max(F.when(F.col("sha").isNotNull(), F.col("sketch"))).alias("edited_sketch"),
    )
    pairs = cut(pairs)
    nexts = pairs.select(F.col("key").alias("next_key"), F.col("copy").alias("next_copy"), F.col("sketch").alias("next_sketch"))
    out = after.join(pairs, ["key", "copy"]).join(nexts, ["next_key", "next_copy"])
    return out.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
