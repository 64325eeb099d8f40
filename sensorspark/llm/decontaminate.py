"""Benchmark decontamination with spaced seeds.

A seed is a window of words of which a fixed mask ignores some, so that a substituted word
does not hide it.  Benchmark texts of fewer words than a window are seeds as a whole.  Every window of every benchmark text and every document is hashed under
each mask.  Document windows pass a Bloom filter of the benchmark's hashes, of fixed size,
inside the scan; what passes is joined by hash; and around each hit the two texts are
compared word by word on the same diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import batches, gram_hashes, mix64, numbered, utf8, word_hashes
from sensorspark.session import cut

# The positions that count in a window of up to SPAN words.  Whichever fifth of 9
# to 19 words in a row is changed, some window of some mask is not; what is longer can be cut
# into parts of 10 to 19 words, one of which has no more than its share of the changes.
MASKS = (
    (0, 2, 3, 5, 6, 7),
    (0, 1, 2, 5, 7, 8),
    (0, 1, 3, 4, 5, 6),
    (0, 1, 2, 3, 4, 7),
    (0, 1, 3, 5, 7, 8),
    (0, 4, 5, 6, 7, 8),
)
SPAN = 9
FILTER_BITS = 24
REACH = 64


def _seeds(h: np.ndarray) -> list[np.ndarray]:
    """Hashes of all windows under each mask; a mask has hashes of its own."""
    return [gram_hashes(h, m[-1] + 1, m) ^ np.uint64(i) for i, m in enumerate(MASKS)]


def short_masks(n: int, share: float) -> list[tuple[int, ...]]:
    """Masks of a whole text of ``n < SPAN`` words, one of which any allowed changes leave as it is.

    The first and the last word are equal; all changes are taken to lie between.
    """
    inside = range(1, n - 1)
    changes = min(int(n * (1 - share) + 1e-9), len(inside))
    if changes == 1 and len(inside) > 1:
        # A change is in one half; the mask that ignores this half does not see it.
        half = n // 2
        ignored = [set(range(1, half)), set(range(half, n - 1))]
    else:
        ignored = [set(c) for c in combinations(inside, changes)]
    return [tuple(i for i in range(n) if i not in g) for g in ignored]


def _short_seeds(h: np.ndarray, n: int, share: float) -> list[np.ndarray]:
    """Hashes of all windows of ``n < SPAN`` words under the masks of a whole text so long."""
    return [gram_hashes(h, n, m) ^ mix64(np.array([n << 8 | i], np.uint64)) for i, m in enumerate(short_masks(n, share))]


def _slot(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(item, item_ids, words)``: the distinct benchmark texts as word hashes."""
    same = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.array_sort(F.collect_set(F.col("item_id").cast("long"))).alias("item_ids"))
    source = same.select(F.xxhash64("text").alias("item"), "item_ids", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                h, _, _, word = word_hashes(*utf8(part.column("text")))
                yield pa.record_batch(
                    {
                        "item": part.column("item"),
                        "item_ids": part.column("item_ids"),
                        "words": pa.ListArray.from_arrays(pa.array(word.astype(np.int32)), pa.array(h.view(np.int64))),
                    }
                )

    return source.mapInArrow(run, "item long, item_ids array<long>, words array<long>")


def _item_seeds(items: DataFrame, share: float) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for item, words in zip(part.column("item").to_pylist(), part.column("words")):
                h = words.values.to_numpy().view(np.uint64)
                for s in _seeds(h) if len(h) >= SPAN else _short_seeds(h, len(h), share) if len(h) else ():
                    yield pa.record_batch(
                        {"seed": pa.array(s.view(np.int64)), "item": pa.array(np.full(len(s), item, np.int64)), "at": pa.array(np.arange(len(s), dtype=np.int32))}
                    )

    return items.select("item", "words").mapInArrow(run, "seed long, item long, at int")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size, built in a few tasks."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for part in parts:
            bits[_slot(part.column("seed").to_numpy().view(np.uint64))] = True
        yield pa.record_batch({"bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for row in seeds.select("seed").coalesce(4).mapInArrow(run, "bits binary").collect():
        bits |= np.frombuffer(row.bits, np.uint8)
    return bits


def _regions(rows: DataFrame, bits: np.ndarray, short: list[int], share: float) -> DataFrame:
    """``(key, copy, begin, words, at, seeds)``: the surroundings of windows that pass the filter.

    A window as long as one of the ``short`` whole texts is a region by itself.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = shared.value
        for whole in parts:
            for part in batches(whole, "text"):
                h, _, _, word = word_hashes(*utf8(part.column("text")))
                at, seed = [], []
                end = np.repeat(word[1:], np.diff(word))

                def passing(s: np.ndarray, n: int) -> np.ndarray:
                    slot = _slot(s)
                    hit = np.flatnonzero(full[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
                    return hit[hit + n <= end[hit]]

                for n in short:
                    for s in _short_seeds(h, n, share):
                        hit = passing(s, n)
                        doc = np.searchsorted(word, hit, side="right") - 1
                        begin = pa.array((hit - word[doc]).astype(np.int64))
                        each = pa.array(np.arange(len(hit) + 1, dtype=np.int32))
                        yield pa.record_batch(
                            {
                                "key": part.column("key").take(pa.array(doc)),
                                "copy": part.column("copy").take(pa.array(doc)),
                                "begin": begin,
                                "words": pa.ListArray.from_arrays(
                                    pa.array(np.arange(len(hit) + 1, dtype=np.int32) * n), pa.array(h[hit[:, None] + np.arange(n)].reshape(-1).view(np.int64))
                                ),
                                "at": pa.ListArray.from_arrays(each, begin),
                                "seeds": pa.ListArray.from_arrays(each, pa.array(s[hit].view(np.int64))),
                            }
                        )
                for m, s in zip(MASKS, _seeds(h)):
                    hit = passing(s, m[-1] + 1)
                    at.append(hit)
                    seed.append(s[hit])
                at, seed = np.concatenate(at), np.concatenate(seed)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order]
                doc = np.searchsorted(word, at, side="right") - 1
                fresh = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * REACH)]
                first = np.flatnonzero(fresh)
                last = np.r_[first[1:], len(at)] - 1
                a = np.maximum(at[first] - REACH, word[doc[first]])
                b = np.minimum(at[last] + SPAN + REACH, word[doc[first] + 1])
                inside = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist())])
                bounds = pa.array(np.r_[first, len(at)].astype(np.int32))
                begin = a - word[doc[first]]
                yield pa.record_batch(
                    {
                        "key": part.column("key").take(pa.array(doc[first])),
                        "copy": part.column("copy").take(pa.array(doc[first])),
                        "begin": pa.array(begin.astype(np.int64)),
                        "words": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(b - a)].astype(np.int32)), pa.array(h[inside].view(np.int64))),
                        "at": pa.ListArray.from_arrays(bounds, pa.array((at - word[doc]).astype(np.int64))),
                        "seeds": pa.ListArray.from_arrays(bounds, pa.array(seed.view(np.int64))),
                    }
                )

    return rows.select("key", "copy", "text").mapInArrow(run, "key long, copy int, begin long, words array<long>, at array<long>, seeds array<long>")


def longest(equal: np.ndarray, share: float) -> tuple[int, int]:
    """The longest part of ``equal`` that begins and ends with True and is True to ``share``."""
    # sum(equal) >= share * length: the sums of equal - share must not fall from begin to end.
    level = np.r_[0.0, np.cumsum(equal - share)]
    # A part may begin before an equal word only; what is cut off at its end is not counted.
    low = np.minimum.accumulate(np.where(np.r_[equal, False], level, np.inf))
    # The earliest begin at or under the level of an end: low only falls, so search backwards.
    begin = len(low) - np.searchsorted(low[::-1], level + 1e-9, side="right")
    size = np.where(np.r_[False, equal], np.arange(len(level)) - begin, 0)
    end = int(size.argmax())
    if not size[end]:
        return 0, 0
    a = int(begin[end])
    while a < end and not equal[a]:
        a += 1
    while end > a and not equal[end - 1]:
        end -= 1
    return a, end


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8) -> DataFrame:
    """``(key, copy, doc_id, item_ids, n_words, spans)`` of the documents that hold benchmark text.

    A document is contaminated if ``least`` or more of its words in a row (the whole item, if
    that is shorter) stand on one diagonal with a benchmark text and ``share`` of them are
    equal, substitutions and nothing else being allowed between.  ``spans`` are
    ``(begin, end, item)`` in words, ``n_words`` is the length of the longest.  Benchmark texts
    without a word match nothing; NULL texts neither.  The seeds find all passages of nine words
    or more that agree to 0.8; a smaller ``share`` or ``least`` is found where a seed is left.
    """
    rows = numbered(docs)
    items = cut(benchmark_items(benchmark))
    seeds = cut(_item_seeds(items, share))
    short = sorted(x.n for x in items.select(F.size("words").alias("n")).filter(f"n between 1 and {SPAN - 1}").distinct().collect())
    regions = cut(_regions(rows, _filter(seeds), short, share))
    hits = regions.select("key", "copy", "begin", F.explode(F.arrays_zip("at", "seeds")).alias("hit"))
    hits = hits.select("key", "copy", "begin", F.col("hit.at").alias("place"), F.col("hit.seeds").alias("seed"))
    found = hits.join(seeds, "seed").select("key", "copy", "begin", "item", (F.col("place") - F.col("at")).alias("diagonal")).distinct()
    compared = found.join(regions.select("key", "copy", "begin", "words"), ["key", "copy", "begin"]).join(
        items.select("item", "item_ids", F.col("words").alias("item_words")), "item"
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            words, item_words = part.column("words"), part.column("item_words")
            begin, diagonal = part.column("begin").to_pylist(), part.column("diagonal").to_pylist()
            for i in range(len(part)):
                w, q = words[i].values.to_numpy(), item_words[i].values.to_numpy()
                shift = begin[i] - diagonal[i]  # place in the item of the region's first word
                a, b = max(0, shift), min(len(q), shift + len(w))
                if b <= a:
                    continue
                x, y = longest(w[a - shift : b - shift] == q[a:b], share)
                if y - x >= min(least, len(q)):
                    out.append((i, begin[i] + a - shift + x, begin[i] + a - shift + y))
            if out:
                at = pa.array([o[0] for o in out])
                yield pa.record_batch(
                    {
                        **{c: part.column(c).take(at) for c in ("key", "copy", "item", "item_ids")},
                        "first": pa.array([o[1] for o in out], pa.int64()),
                        "last": pa.array([o[2] for o in out], pa.int64()),
                    }
                )

    spans = compared.mapInArrow(run, "key long, copy int, item long, item_ids array<long>, first long, last long")
    each = spans.groupBy("key", "copy", "item").agg(F.first("item_ids").alias("item_ids"), F.collect_set(F.struct("first", "last")).alias("at"))
    whole = each.groupBy("key", "copy").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.flatten(F.collect_list(F.transform("at", lambda s: F.struct(s["first"].alias("begin"), s["last"].alias("end"), F.col("item").alias("item"))))).alias("spans"),
    )
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return whole.join(ids, "key").select(
        "key",
        "copy",
        "doc_id",
        "item_ids",
        F.array_max(F.transform("spans", lambda s: s["end"] - s["begin"])).alias("n_words"),
        F.array_sort("spans").alias("spans"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark text."""
    bad = contaminated(docs, benchmark, least, share).select("key", "copy")
    return numbered(docs, whole=True).join(bad, ["key", "copy"], "left_anti").select("row.*")
