"""SimHash near duplicates through deletion-variant signatures.

Fingerprints at distance ``d <= 3``, cut into two halves, differ by at most one bit in one
half.  Two halves that differ by at most one bit become equal when the right bit is made a
wildcard, so every fingerprint is indexed under its 2 x 32 halves with one wildcard each.
Fingerprints that meet under a key are compared as a whole.  Only distinct fingerprints are
indexed, and a key hands out a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import batches, gram_hashes, mix64, numbered, packed, release, text_or_empty, unpacked, utf8, word_hashes
from sensorspark.llm.components import components
from sensorspark.session import cut

MOST = 3


def fingerprint(text: bytes, n_words: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < n_words:
        shingles = [words]
    else:
        shingles = zip(*[words[i:] for i in range(n_words)])
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total, size = np.zeros(64, np.int64), 0
    hashes = np.fromiter((digest(join(s), 42) for s in shingles), np.uint64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        size += len(part)
    return int.from_bytes(np.packbits(total * 2 > size).tobytes(), "big")


def fingerprints(docs: DataFrame, n_words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint as a signed long) for every row of ``docs``.

    A-Z are lower-cased, words are runs without ASCII white space, a text with fewer words
    than a shingle is one shingle, and one without words has fingerprint zero.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                texts = part.column("text").cast(pa.large_binary())
                fp = np.array([fingerprint(x.as_py(), n_words) for x in texts], np.uint64)
                yield pa.record_batch({**{c: part.column(c) for c in keep}, "fp": pa.array(fp.view(np.int64))})

    source = docs.select(*keep, text_or_empty().alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInArrow(run, f"{kinds}, fp long")


def _forest(fp: np.ndarray, most: int) -> np.ndarray:
    """For each of some distinct fingerprints the index of its parent in a spanning forest.

    Breadth first: each fingerprint is compared once with those not reached yet, so memory
    stays linear however many fingerprints share a key.
    """
    parent = np.arange(len(fp))
    open_ = np.arange(len(fp))
    while len(open_):
        stack, open_ = [open_[0]], open_[1:]
        while stack and len(open_):
            x = stack.pop()
            near = np.bitwise_count(fp[open_] ^ fp[x]) <= most
            found = open_[near]
            parent[found] = x
            open_ = open_[~near]
            stack.extend(found.tolist())
    return parent


def _links(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each key; input is sorted by key."""
    held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def solve(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[begin, len(key)])
        a, b = [], []
        two = begin[size == 2]
        near = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= most
        a.append(fp[two][near])
        b.append(fp[two + 1][near])
        for s, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
            part = fp[s : s + n]
            parent = _forest(part.view(np.uint64), most)
            linked = parent != np.arange(n)
            a.append(part[parent[linked]])
            b.append(part[linked])
        a, b = np.concatenate(a), np.concatenate(b)
        if not len(a):
            return None
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    for batch in parts:
        key = np.concatenate([held_key, batch.column("key").to_numpy()])
        fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
        last = np.searchsorted(key, key[-1]) if len(key) else 0
        held_key, held_fp = key[last:], fp[last:]
        out = solve(key[:last], fp[:last])
        if out is not None:
            yield out
    out = solve(held_key, held_fp)
    if out is not None:
        yield out


def links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """``(a, b)``: links whose components are those of all pairs at distance ``most`` or less."""
    if most > 3:
        raise ValueError("two halves find distances up to 3")
    bit = F.expr("explode(sequence(0, 63))").alias("bit")
    # The wildcard bit is cleared in the half that holds it, the other half is dropped.
    value = F.expr(
        "case when bit < 32 then (fp & 4294967295L) & ~shiftleft(1L, bit) "
        "else shiftrightunsigned(fp, 32) & ~shiftleft(1L, bit - 32) end"
    )
    keys = distinct.select("fp", bit).select(
        F.shiftleft(F.col("bit").cast("long"), 32).bitwiseOR(value).alias("key"), "fp"
    )
    sorted_keys = keys.repartition("key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(lambda parts: _links(parts, most), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, most: int = MOST, n_words: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    Fingerprints link at ``most`` or fewer differing bits, those of empty texts like any
    other; ``component_id`` is the smallest ``doc_id`` that links reach, NULL ids left out.
    """
    prints = cut(fingerprints(docs, n_words))
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(prints.select("fp").distinct(), most))
    rooted = ids.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(label, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- similar texts -------------------------------------------------------------------------
#
# Sets of shingles that agree to ``t`` share ``t * n`` of the ``n`` of either, so in any common
# order of all shingles one of the first ``n - ceil(t * n) + 1`` of both is the same.  Texts meet
# under these first shingles; the order puts what many texts of a sample hold last.  Any order is
# exact, the sample only decides how many texts meet in vain.

# Texts whose shingles the order is learned from.
LEARNED = 4_000
# Bits of a parity sketch; sketches differ in no more bits than the sets have different members.
SKETCH = 2_048
# The same for pairs that are about to be verified, whose texts may be long.
WIDE_SKETCH = 16_384
# Texts of a shingle that are compared pair by pair at once; more are led by a few of them first.
FEW = 8
# Entries of a bucket, and texts of one side of a crowded shingle that a task compares.
ENTRIES = 250_000
CROWD = 20_000
# Texts whose numbers are broadcast to fetch them; more are fetched by a join.
MAX_BROADCAST = 200_000
MEETING = "key long, a long, b long, crowd boolean"


def _shingles(part: pa.RecordBatch, n_words: int) -> Iterator[np.ndarray]:
    """The set of shingles of each text, sorted."""
    h, _, _, word = word_hashes(*utf8(part.column("text")))
    for x, y in zip(word[:-1].tolist(), word[1:].tolist()):
        yield np.unique(gram_hashes(h[x:y], min(n_words, max(y - x, 1))))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    bounds = pa.array(np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32))
    return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([v.view(np.int64) for v in values])))


def sketch(own: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """Whether each of ``size`` classes of hashes has an odd number of members, as 64-bit words."""
    odd = np.bincount((own % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def first_shingles(own: np.ndarray, often: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The shingles of a set of which every set that agrees to ``similarity`` has one among its own."""
    if not len(own):
        return np.zeros(1, np.uint64)
    known, count = often
    rank = np.zeros(len(own), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        rank = np.where(known[at] == own, count[at], 0)
    # A little room for products that are whole numbers but for their last bit.
    most = len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1
    return own[np.lexsort((own, rank))[:most]]


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)


def _meetings(table: pa.Table, similarity: float) -> pa.Table:
    """Pairs of similar size that share a first shingle, and the shingles of more than ``FEW`` texts as they are."""
    e = unpacked(table, ["key", "id", "n"])
    o = np.lexsort((e["id"], e["key"]))
    key, ids, n = e["key"][o], e["id"][o], e["n"][o]
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[begin, len(key)])
    a, b = [ids[:0]], [ids[:0]]
    for m in range(2, FEW + 1):
        some = begin[size == m]
        for x in range(m):
            for y in range(x + 1, m):
                fit = some[_fit(n[some + x], n[some + y], similarity)]
                a.append(ids[fit + x])
                b.append(ids[fit + y])
    pairs = _pairs(np.concatenate(a), np.concatenate(b))
    many = np.repeat(size > FEW, size)
    return pa.table(
        {
            "key": pa.array(np.r_[np.zeros(len(pairs), np.int64), key[many]]),
            "a": pa.array(np.r_[pairs[:, 0], ids[many]]),
            "b": pa.array(np.r_[pairs[:, 1], ids[many]]),
            "crowd": pa.array(np.r_[np.zeros(len(pairs), bool), np.ones(many.sum(), bool)]),
        }
    )


def _fit(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9


def _alike(n: np.ndarray, bits: np.ndarray, i: int, some: np.ndarray, similarity: float) -> np.ndarray:
    """Those of ``some`` whose sizes and sketches allow that they agree with text ``i``."""
    some = some[_fit(n[some], n[i], similarity)]
    apart = np.bitwise_count(bits[some] ^ bits[i]).sum(axis=1, dtype=np.int64)
    return some[apart <= (1 - similarity) / (1 + similarity) * (n[some] + n[i]) + 1e-9]


def _led(table: pa.Table, similarity: float) -> pa.Table:
    """Each text of a crowded shingle with the first leader it may agree with; others lead themselves."""
    ids, n, bits, _ = _crowd(table)
    left, a, b = np.arange(len(ids)), [ids[:0]], [ids[:0]]
    while len(left) > 1:
        near = _alike(n, bits, left[0], left[1:], similarity)
        a.append(np.full(len(near), ids[left[0]]))
        b.append(ids[near])
        left = np.setdiff1d(left[1:], near, assume_unique=True)
    return _table(np.concatenate(a), np.concatenate(b))


def _across(table: pa.Table, similarity: float) -> pa.Table:
    """Pairs of texts of a crowded shingle that may agree and are not linked yet."""
    ids, n, bits, root = _crowd(table)
    group, at, size = np.unique(root, return_inverse=True, return_counts=True)
    a, b = [ids[:0]], [ids[:0]]
    # Of a pair with two roots one is not of the most frequent.
    for i in np.flatnonzero(at != size.argmax()).tolist():
        near = _alike(n, bits, i, np.flatnonzero(at != at[i]), similarity)
        a.append(np.full(len(near), ids[i]))
        b.append(ids[near])
    return _table(np.concatenate(a), np.concatenate(b))


def _crowd(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    column = {c: table.column(c).combine_chunks() for c in ("id", "n", "bits", "root")}
    ids, n, root = (column[c].to_numpy(zero_copy_only=False) for c in ("id", "n", "root"))
    o = np.argsort(ids)
    bits = column["bits"].flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
    return ids[o], n[o].astype(np.int64), bits[o], root[o]


def _table(a: np.ndarray, b: np.ndarray) -> pa.Table:
    pairs = _pairs(a, b)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _often(texts: DataFrame, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that three or more of ``texts`` hold, sorted, and how many."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                yield pa.record_batch({"gram": _lists(list(_shingles(part, n_words))).flatten()})

    grams = texts.select("text").mapInArrow(run, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 2").toArrow()
    known, count = grams.column("gram").to_numpy().view(np.uint64), grams.column("n").to_numpy()
    o = np.argsort(known)
    return known[o], count[o]


def similar_links(rows: DataFrame, nodes: DataFrame, similarity: float = 0.8, n_words: int = 5) -> DataFrame:
    """``(a, b)``: links that connect all nodes ``(id, key, copy)`` whose sets of word shingles agree to ``similarity``.

    Texts meet under their first shingles, which loses no pair; where few meet, all pairs of similar
    size are verified on the shingles of both whole texts, which ``rows`` holds by ``(key, copy)``.
    A shingle of many texts is led first: each text is verified with the first leader that its size
    and sketch allow.  Of those that are not connected then, all pairs that sizes and sketches allow
    are verified.
    """

    def prints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                sets = list(_shingles(part, n_words))
                yield pa.record_batch(
                    {
                        "id": part.column("id"),
                        "n": pa.array([len(s) for s in sets], pa.int32()),
                        "bits": _lists([sketch(s) for s in sets]),
                        "first": _lists([first_shingles(s, often.value, similarity) for s in sets]),
                    }
                )

    def entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            first = part.column("first")
            size = np.diff(first.offsets.to_numpy())
            key = first.flatten().to_numpy()
            bucket = (mix64(key.view(np.uint64)) % np.uint64(spread)).astype(np.int64)
            yield packed(bucket, {"key": key, **{c: np.repeat(part.column(c).to_numpy(), size) for c in ("id", "n")}})

    def shingles(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                sets = list(_shingles(part, n_words))
                yield pa.record_batch(
                    {
                        "id": part.column("id"),
                        "n": pa.array([len(s) for s in sets], pa.int32()),
                        "bits": _lists([sketch(s, WIDE_SKETCH) for s in sets]),
                        "grams": _lists(sets),
                    }
                )

    def texts(of: DataFrame) -> DataFrame:
        return rows.select("key", "copy", "text").join(of, ["key", "copy"]).select("id", "text")

    def possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
        """Those of ``pairs`` whose sketches allow that they agree."""
        for x in ("a", "b"):
            pairs = pairs.join(bits.withColumnsRenamed({"id": x, "n": f"n{x}", "bits": f"bits{x}"}), x)
        apart = F.expr("aggregate(zip_with(bitsa, bitsb, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
        most = F.lit((1 - similarity) / (1 + similarity)) * (F.col("na") + F.col("nb")) + 1e-9
        return pairs.filter(apart <= most).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = cut(nodes.join(wanted, "id", "left_semi"))
        wanted = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST else wanted
        grams = cut(texts(wanted).mapInArrow(shingles, "id long, n int, bits array<long>, grams array<long>"))
        release(spark)
        pairs = cut(possible(pairs, grams.select("id", "n", "bits")))
        release(spark)
        left = grams.select(F.col("id").alias("a"), F.col("grams").alias("x"))
        right = grams.select(F.col("id").alias("b"), F.col("grams").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        enough = both >= F.lit(similarity) * (F.size("x") + F.size("y") - both)
        return cut(pairs.join(left, "a").join(right, "b").filter(enough).select("a", "b"))

    spark = rows.sparkSession
    sample = nodes.filter(F.pmod("id", F.lit(1 + nodes.count() // LEARNED)) == 0)
    often = spark.sparkContext.broadcast(_often(texts(F.broadcast(sample)), n_words))
    held = cut(texts(nodes).mapInArrow(prints, "id long, n int, bits array<long>, first array<long>"))
    release(spark)
    spread = 1 + (held.agg(F.sum(F.size("first"))).first()[0] or 0) // ENTRIES
    keyed = held.select("id", "n", "first").mapInArrow(entries, "bucket int, key array<long>, id array<long>, n array<int>")
    met = cut(keyed.groupBy("bucket").applyInArrow(lambda t: _meetings(t, similarity), MEETING))
    del keyed
    release(spark)
    bits = held.select("id", "n", "bits")
    pairs = possible(met.filter("not crowd").select("a", "b").distinct(), bits)
    crowd = met.filter("crowd").select("key", F.col("a").alias("id"))
    crowded = not crowd.isEmpty()
    if crowded:
        # A shingle of very many texts is dealt to parts, and each part meets each other one.
        parts = crowd.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(CROWD)).alias("parts"))
        home = F.pmod(F.xxhash64("id", "key"), F.col("parts"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        dealt = crowd.join(parts, "key").withColumn("home", home).withColumn("other", other)
        dealt = dealt.select("key", "id", "home", F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"))
        led = dealt.filter("i = home and j = home").join(bits, "id").withColumn("root", F.col("id"))
        led = led.groupBy("key", "i").applyInArrow(lambda t: _led(t, similarity), "a long, b long")
        pairs = pairs.unionByName(led).distinct()
    pairs = cut(pairs)
    release(spark)
    found = verified(pairs)
    del pairs
    release(spark)
    if crowded:
        roots = components(found).withColumnRenamed("node", "id")
        dealt = cut(dealt.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
        open_ = dealt.groupBy("key", "i", "j").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key", "i", "j")
        left = dealt.join(open_, ["key", "i", "j"], "left_semi").join(bits, "id")
        rest = cut(left.groupBy("key", "i", "j").applyInArrow(lambda t: _across(t, similarity), "a long, b long").distinct())
        del left, open_, dealt
        release(spark)
        if not rest.isEmpty():
            found = found.unionByName(verified(rest))
    return found


def keep_one(docs: DataFrame, similarity: float = 0.8, n_words: int = 5, most: int | None = None) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the first in document order stays.

    Equal texts are near duplicates, and so are texts whose sets of ``n_words``-word shingles
    agree to ``similarity``, those of texts without a word among themselves included.  With ``most``
    so are texts that :func:`near_duplicates` links at this distance.  A group is what links of
    these kinds reach.
    """
    rows = numbered(docs, whole=True)
    # Equal texts share a node; only the first of them is compared with others.
    nodes = cut(rows.select("key", "copy", F.xxhash64("text").alias("id")))
    first = nodes.groupBy("id").agg(F.min(F.struct("key", "copy")).alias("at")).select("id", "at.*")
    linked = [] if most is None else [_print_links(rows, first, most)]
    release(docs.sparkSession)
    linked.append(similar_links(rows, first, similarity, n_words))
    found = components(reduce(DataFrame.unionByName, linked))
    rooted = first.join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "copy", F.coalesce("root", "id").alias("root"))
    kept = cut(rooted.groupBy("root").agg(F.min(F.struct("key", "copy")).alias("first")).select("first.*"))
    del nodes, first, linked, found, rooted
    release(docs.sparkSession)
    return rows.join(kept, ["key", "copy"], "left_semi").select("row.*")


def _print_links(rows: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """``(a, b)``: each node ``(id, key, copy)`` with the smallest one of its component of fingerprints."""
    texts = rows.select("key", "copy", "text").join(nodes, ["key", "copy"]).select(F.col("id").alias("doc_id"), "text")
    found = near_duplicates(texts, most).filter("doc_id <> component_id")
    return cut(found.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
