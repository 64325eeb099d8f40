"""Removal of repeated byte strings through a logarithmic family of suffix arrays.

Indexed are the suffixes at anchors: in every window of ``length`` bytes the ``GRAM``-byte
strings with the smallest hash.  Equal strings of that length have equal anchors, so a match
never goes unseen, and only about one suffix in forty is stored.  An entry holds a hash of
the suffix's first bytes, by which suffixes are ordered, one of all bytes that a match over
this anchor may cover (the context), and the place.

A new batch is sorted into a suffix array of its own, dealt over buckets by suffix, and
merge-scanned against the levels of the index.  Equal contexts are repeats as a whole; of
each the first place stays in the index.  Suffixes that agree at first and differ later are
noted, and their contexts are compared string by string once all batches are in.  A batch
and the levels of its size are merged while they are scanned, so that a level is twice as
large as the one before it and every entry is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.llm.common import _BASE, _BYTE, _INVERSE, batches, mix64, numbered, powers, release, utf8, window_minimum
from sensorspark.session import fresh_path

GRAM = 20
# A chunk of a map task is reduced to one entry per context before it is dealt out.
CHUNK = 24 << 20
# Suffixes with so many contexts in one chunk, or noted places in all, are split by context.
HOT_IN_CHUNK, HOT = 256, 4096
# Contexts compared at a time, and bytes of text hashed at a time, in one task.
PART, SLICE = 4096, 1 << 19

ENTRY = "bucket int, level int, a array<long>, f array<long>, key array<long>, copy array<int>, pos array<int>, span array<int>"
FOUND = "kind string, " + ENTRY
FORCED = 1 << 20


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """``(place, gram hash, context hash, left, right)`` of the anchors of many texts."""
    n, width = len(raw), length - GRAM + 1
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z.astype(np.uint64), z, z
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[raw] * powers(_BASE, n), out=total[1:])
        inverse = powers(_INVERSE, n)
        gram = mix64((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
        least = window_minimum(gram, width)
        # Windows that reach over the end of their text select nothing.
        size = np.diff(offsets)
        bad = np.repeat(size < length, size)
        at_end = np.arange(n) > np.repeat(offsets[1:] - length, size)
        least = np.where((bad | at_end)[: len(least)], 0, least)
        edge = np.zeros(width - 1, np.uint64)
        most = ~window_minimum(~np.concatenate([edge, least, edge]), width)
        at = np.flatnonzero(gram == most[: len(gram)])
        text = np.searchsorted(offsets, at, side="right") - 1
        left = np.minimum(length - GRAM, at - offsets[text])
        right = np.minimum(length, offsets[text + 1] - at)
        f = mix64((total[at + right] - total[at - left]) * inverse[at - left] + (left * 512 + right).astype(np.uint64))
    return at, gram[at], f, left, right


def _merged(key, copy, begin, end):
    """Unions of the intervals of each text, in order."""
    o = np.lexsort((begin, copy, key))
    key, copy, begin, end = key[o], copy[o], begin[o], end[o]
    if not len(o):
        return key, copy, begin, end
    new = np.r_[True, (key[1:] != key[:-1]) | (copy[1:] != copy[:-1])]
    # The furthest end so far within the text: shift every text above the one before it.
    shift = np.cumsum(new) * np.int64(int(end.max()) + 1)
    far = np.maximum.accumulate(end + shift) - shift
    fresh = new | np.r_[True, begin[1:] > far[:-1]]
    first = np.flatnonzero(fresh)
    return key[first], copy[first], begin[first], far[np.r_[first[1:], len(o)] - 1]


def _rows(bucket: np.ndarray, columns: dict, level: int, kind: str | None = None) -> pa.RecordBatch:
    """One row per bucket with the entries that belong to it."""
    o = np.argsort(bucket, kind="stable")
    b = bucket[o]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    bounds = pa.array(np.r_[first, len(b)].astype(np.int32))
    out = {"kind": pa.array([kind] * len(first), pa.string())} if kind else {}
    out |= {"bucket": pa.array(b[first].astype(np.int32)), "level": pa.array(np.full(len(first), level, np.int32))}
    for name in ("a", "f", "key", "copy", "pos", "span"):
        v = columns[name][o]
        v = v.view(np.int64) if v.dtype == np.uint64 else v
        v = v.astype(np.int64 if name in ("a", "f", "key") else np.int32, copy=False)
        out[name] = pa.ListArray.from_arrays(bounds, pa.array(v))
    return pa.record_batch(out)


def _dups(key, copy, begin, end) -> dict:
    z = np.zeros(len(key), np.uint64)
    return {"a": z, "f": z, "key": key, "copy": copy, "pos": begin, "span": end - begin}


def _classes(a, f, key, copy, pos):
    """Order by suffix, context and place; where a suffix and where a context begins."""
    o = np.lexsort((pos, copy, key, f, a))
    a, f = a[o], f[o]
    new_a = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
    new_f = new_a | np.r_[True, f[1:] != f[:-1]] if len(a) else new_a
    return o, new_a, new_f


def _suffixes(parts: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of a batch of texts; level 0 are entries, level 2 intervals known to be repeats."""

    def flush(held):
        if not held:
            return
        e = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        o, new_a, new_f = _classes(e["a"], e["f"], e["key"], e["copy"], e["pos"])
        e = {c: v[o] for c, v in e.items()}
        again = ~new_f
        left, right = e["span"] >> 8 & 255, e["span"] & 255
        key, copy, begin, end = _merged(*(v[again] for v in (e["key"], e["copy"], e["pos"] - left, e["pos"] + right)))
        if len(key):
            yield _rows((key % buckets), _dups(key, copy, begin, end), 2)
        group = np.cumsum(new_a) - 1
        hot = (np.bincount(group, weights=new_f, minlength=1) >= HOT_IN_CHUNK)[group] if len(group) else new_a
        mark = {c: v[new_a & hot].copy() for c, v in e.items()}
        mark["pos"][:], mark["f"][:] = -1, 0
        e["span"] = e["span"] | np.where(hot, FORCED, 0)
        with np.errstate(over="ignore"):
            deal = np.where(hot, mix64(e["a"] + e["f"] * np.uint64(3)), e["a"])
        deal = np.r_[deal[new_f], mark["a"]] % np.uint64(buckets)
        yield _rows(deal.astype(np.int64), {c: np.r_[v[new_f], mark[c]] for c, v in e.items()}, 0)

    held, total = [], 0
    for whole in parts:
        for part in batches(whole, "text", SLICE):
            raw, offsets = utf8(part.column("text"))
            at, a, f, left, right = _anchors(raw, offsets, length)
            text = np.searchsorted(offsets, at, side="right") - 1
            held.append(
                {
                    "a": a, "f": f, "key": part.column("key").to_numpy()[text], "copy": part.column("copy").to_numpy()[text],
                    "pos": at - offsets[text], "span": left << 8 | right,
                }
            )
            total += len(raw)
            if total >= CHUNK:
                yield from flush(held)
                held, total = [], 0
    yield from flush(held)


def _column(table: pa.Table, name: str, rows: np.ndarray) -> np.ndarray:
    return table.column(name).combine_chunks().take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)


def _scan(table: pa.Table, merge_from: int) -> pa.Table:
    """Merge-scan of one bucket: the batch (level 0) against levels; those from -1 down to ``merge_from`` are merged.

    Levels are numbered -1, -2, ...; their entries hold one place for each context already.
    """
    level = table.column("level").to_numpy()
    bucket = int(table.column("bucket")[0].as_py())
    out = []
    known = np.flatnonzero(level == 2)
    if len(known):
        key, copy, begin, size = (_column(table, c, known) for c in ("key", "copy", "pos", "span"))
        out.append(("repeat", _dups(key, copy, begin, begin + size)))
    rows = np.flatnonzero(level <= 0)
    e = {c: _column(table, c, rows) for c in ("a", "f", "key", "copy", "pos", "span")}
    e["a"], e["f"] = e["a"].view(np.uint64), e["f"].view(np.uint64)
    lengths = table.column("a").combine_chunks().take(pa.array(rows)).value_lengths().to_numpy(zero_copy_only=False)
    e["level"] = np.repeat(level[rows], lengths)
    o, new_a, new_f = _classes(e["a"], e["f"], e["key"], e["copy"], e["pos"])
    e = {c: v[o] for c, v in e.items()}
    if len(o):
        fresh = (e["level"] == 0) & (e["pos"] >= 0)
        again = ~new_f & fresh
        out.append(("repeat", _dups(e["key"][again], e["copy"][again], (e["pos"] - (e["span"] >> 8 & 255))[again], (e["pos"] + (e["span"] & 255))[again])))
        group = np.cumsum(new_a) - 1
        # A suffix with several contexts, one of them new, has all its first places compared.
        classes = np.bincount(group, weights=new_f)
        touched = np.bincount(group, weights=(e["level"] == 0) & new_f)
        forced = (e["span"] & FORCED) > 0
        open_ = new_f & (e["pos"] >= 0) & (((classes >= 2) & (touched > 0))[group] | (forced & fresh))
        out.append(("compare", {c: v[open_] for c, v in e.items()}))
        stays = new_f & (e["level"] >= merge_from)
        out.append(("index", {c: v[stays] for c, v in e.items()}))
    made = [_rows(np.full(len(c["key"]), bucket), c, 0, kind) for kind, c in out if len(c["key"])]
    return pa.Table.from_batches(made, schema=None if made else _found_schema())


def _found_schema() -> pa.Schema:
    long, integer = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("level", pa.int32()), ("a", long), ("f", long), ("key", long), ("copy", integer), ("pos", integer), ("span", integer)])


class SuffixIndex:
    """The levels of an index under ``path``; batches are added in document order.

    ``add`` writes what it finds below ``path`` as well: a lost executor only repeats tasks.
    """

    def __init__(self, spark: SparkSession, path: str, length: int = 100, buckets: int = 64):
        self.spark, self.path, self.length, self.buckets = spark, path, length, buckets
        self.levels: list[tuple[int, str]] = []  # size in batches and path, the newest last
        self.batches: list[str] = []

    def add(self, texts: DataFrame) -> None:
        """Index a batch of ``(key, copy, text)``, all later in order than those before."""
        length, buckets = self.length, self.buckets
        new = texts.select("key", "copy", "text").mapInArrow(lambda parts: _suffixes(parts, length, buckets), ENTRY)
        size, merged = 1, 0
        while merged < len(self.levels) and self.levels[-1 - merged][0] == size:
            size, merged = size * 2, merged + 1
        union = new
        for n, (_, path) in enumerate(reversed(self.levels), 1):
            union = union.unionByName(self._read(path, "index").drop("kind").withColumn("level", F.lit(-n)))
        found = union.groupBy("bucket").applyInArrow(lambda t: _scan(t, -merged), FOUND)
        path = f"{self.path}/batch-{len(self.batches)}"
        found.write.partitionBy("kind").parquet(path)
        for _, old in self.levels[len(self.levels) - merged :]:
            _delete(self.spark, f"{old}/kind=index")
        self.levels = [*self.levels[: len(self.levels) - merged], (size, path)]
        self.batches.append(path)
        del new, union, found
        release(self.spark)

    def _read(self, path: str, kind: str) -> DataFrame:
        return self.spark.read.schema(FOUND).parquet(path).filter(F.col("kind") == kind)

    def found(self, kind: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._read(p, kind) for p in self.batches])

    def drop_levels(self) -> None:
        for _, path in self.levels:
            _delete(self.spark, f"{path}/kind=index")
        self.levels = []


def _first_places(keys: np.ndarray, key, copy, pos) -> np.ndarray:
    """True for all but the first place of every string."""
    o = np.lexsort((pos, copy, key, keys))
    again = np.zeros(len(keys), bool)
    again[o[1:]] = keys[o[1:]] == keys[o[:-1]]
    return again


def _windows(table: pa.Table, length: int):
    """``(hash, row, begin)`` of the strings over the anchors of some contexts."""
    data, offsets = utf8(table.column("context").combine_chunks())
    left = table.column("left").to_numpy().astype(np.int64)
    size = np.diff(offsets)
    n = len(data)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, n), out=total[1:])
        count = np.maximum(np.minimum(size - length, left) + 1, 0)
        row = np.repeat(np.arange(len(size)), count)
        begin = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[row] + begin
        h = (total[at + length] - total[at]) * powers(_INVERSE, n)[at] if n else np.zeros(0, np.uint64)
        a = table.column("a").to_numpy().view(np.uint64)[row]
        # The place of the anchor in the string is part of the comparison.
        h = mix64(mix64(h) + a + (left[row] - begin).astype(np.uint64) * np.uint64(_BASE))
    return h, row, begin


REPEAT = "key array<long>, copy array<int>, begin array<int>, end array<int>"


def _repeat_rows(key, copy, begin, end) -> pa.RecordBatch:
    bounds = pa.array(np.array([0, len(key)], np.int32))
    one = lambda v, t: pa.ListArray.from_arrays(bounds, pa.array(v.astype(t)))
    return pa.record_batch({"key": one(key, np.int64), "copy": one(copy, np.int32), "begin": one(begin, np.int32), "end": one(end, np.int32)})


def _compare(table: pa.Table, length: int) -> pa.Table:
    """Repeats among the contexts of one bucket, a part of its suffixes at a time."""
    table = table.sort_by("a")
    a = table.column("a").to_numpy()
    edges = np.r_[np.flatnonzero(np.r_[True, a[1:] != a[:-1]]), len(a)]
    out, start = [], 0
    while start < len(edges) - 1:
        stop = start + 1
        while stop < len(edges) - 1 and edges[stop + 1] - edges[start] <= PART:
            stop += 1
        part = table.slice(edges[start], edges[stop] - edges[start])
        start = stop
        h, row, begin = _windows(part, length)
        key, copy = part.column("key").to_numpy()[row], part.column("copy").to_numpy()[row]
        pos = (part.column("pos").to_numpy() - part.column("left").to_numpy())[row] + begin
        again = _first_places(h, key, copy, pos)
        if again.any():
            out.append(_repeat_rows(*_merged(key[again], copy[again], pos[again], pos[again] + length)))
    schema = pa.schema([("key", pa.list_(pa.int64())), ("copy", pa.list_(pa.int32())), ("begin", pa.list_(pa.int32())), ("end", pa.list_(pa.int32()))])
    return pa.Table.from_batches(out, schema=schema)


def _strings(parts: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The strings over hot anchors, dealt by string; repeats inside a chunk are passed on as such."""
    for part in parts:
        for at in range(0, len(part), PART):
            piece = pa.Table.from_batches([part.slice(at, PART)])
            h, row, begin = _windows(piece, length)
            key, copy = piece.column("key").to_numpy()[row], piece.column("copy").to_numpy()[row]
            pos = (piece.column("pos").to_numpy() - piece.column("left").to_numpy())[row] + begin
            again = _first_places(h, key, copy, pos)
            known = _merged(key[again], copy[again], pos[again], pos[again] + length)
            if len(known[0]):
                yield _rows(known[0] % buckets, _dups(*known), 2)
            z = np.zeros((~again).sum(), np.uint64)
            yield _rows((h[~again] % np.uint64(buckets)).astype(np.int64), {"a": h[~again], "f": z, "key": key[~again], "copy": copy[~again], "pos": pos[~again], "span": z}, 0)


def _compare_strings(table: pa.Table, length: int) -> pa.Table:
    level = table.column("level").to_numpy()
    known, rows = np.flatnonzero(level == 2), np.flatnonzero(level == 0)
    key, copy, begin, size = (_column(table, c, known) for c in ("key", "copy", "pos", "span"))
    out = [_repeat_rows(key, copy, begin, begin + size)] if len(key) else []
    h, key, copy, pos = (_column(table, c, rows) for c in ("a", "key", "copy", "pos"))
    again = _first_places(h, key, copy, pos)
    if again.any():
        out.append(_repeat_rows(key[again], copy[again], pos[again], pos[again] + length))
    schema = pa.schema([("key", pa.list_(pa.int64())), ("copy", pa.list_(pa.int32())), ("begin", pa.list_(pa.int32())), ("end", pa.list_(pa.int32()))])
    return pa.Table.from_batches(out, schema=schema)


def repeats(texts: DataFrame, path: str, length: int = 100, batches_: int = 3) -> DataFrame:
    """``(key, copy, at)``: intervals of bytes of each text that strings seen earlier cover."""
    spark = texts.sparkSession
    cuts = [i / batches_ for i in range(1, batches_)]
    size, bounds = texts.agg(F.sum(F.octet_length("text")), F.percentile_approx("key", F.array(*[F.lit(c) for c in cuts]), F.lit(10000))).first()
    # Buckets hold a bounded number of entries.
    index = SuffixIndex(spark, path, length, max(48, (size or 0) // (16 << 20)))
    edges = [None, *sorted(set(bounds or [])), None]
    for low, high in zip(edges, edges[1:]):
        inside = [F.col("key") > low] if low is not None else []
        inside += [F.col("key") <= high] if high is not None else []
        index.add(texts.filter(reduce(lambda x, y: x & y, inside)) if inside else texts)
    index.drop_levels()

    places = index.found("compare").select(F.explode(F.arrays_zip("a", "key", "copy", "pos")).alias("e")).select("e.*").distinct()
    hot = places.groupBy("a").count().filter(F.col("count") >= HOT).select("a", F.lit(True).alias("hot"))
    marked = places.join(hot, "a", "left")
    reach = length - GRAM
    contexts = marked.join(texts, ["key", "copy"]).select(
        "a", "key", "copy", "pos", F.coalesce("hot", F.lit(False)).alias("hot"),
        F.least(F.col("pos"), F.lit(reach)).alias("left"),
        F.expr(f"substring(cast(text as binary), greatest(pos - {reach}, 0) + 1, least(pos, {reach}) + {length})").alias("context"),
    )
    buckets = index.buckets
    contexts.write.partitionBy("hot").parquet(f"{path}/contexts")
    # From here on only the written contexts are read.
    del places, hot, marked, contexts
    release(spark)
    kind = "a long, key long, copy int, pos int, left int, context binary, hot boolean"
    contexts = spark.read.schema(kind).parquet(f"{path}/contexts")
    plain = contexts.filter("not hot").withColumn("bucket", F.pmod(F.hash("a"), F.lit(buckets)))
    by_suffix = plain.groupBy("bucket").applyInArrow(lambda t: _compare(t, length), REPEAT)
    strings = contexts.filter("hot").mapInArrow(lambda parts: _strings(parts, length, buckets), ENTRY)
    by_string = strings.groupBy("bucket").applyInArrow(lambda t: _compare_strings(t, length), REPEAT)
    whole = index.found("repeat").select("key", "copy", F.col("pos").alias("begin"), F.zip_with("pos", "span", lambda p, s: p + s).alias("end"))
    every = whole.unionByName(by_suffix).unionByName(by_string)
    rows = every.select(F.explode(F.arrays_zip("key", "copy", "begin", "end")).alias("e")).select("e.*")
    rows.groupBy("key", "copy").agg(F.collect_list(F.struct("begin", "end")).alias("at")).write.parquet(f"{path}/repeats")
    del plain, by_suffix, strings, by_string, whole, every, rows, contexts
    release(spark)
    for used in (f"{path}/contexts", *index.batches):
        _delete(spark, used)
    return spark.read.parquet(f"{path}/repeats")


def remove_repeats(docs: DataFrame, length: int = 100, batches_: int = 3) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans)``, one row for each row of ``docs``.

    Texts are UTF-8 bytes, NULL is empty.  A byte goes if a string of ``length`` bytes covers
    it that also starts earlier, in a row earlier by ``doc_id`` (then text) or earlier in the
    same text; strings are judged on the input.  ``kept`` are the bytes that remain and
    ``spans`` the maximal removed runs.
    """
    rows = numbered(docs)
    found = repeats(rows, fresh_path(docs.sparkSession, "suffix-index"), length, batches_)
    joined = rows.join(found, ["key", "copy"], "left").select("doc_id", "text", "at")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_of = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for whole in parts:
            for part in batches(whole, "text"):
                out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
                for text, at in zip(part.column("text").cast(pa.binary()), part.column("at").to_pylist()):
                    raw = text.as_py()
                    spans, kept, last = [], [], 0
                    for x in sorted((x["begin"], x["end"]) for x in at or []):
                        if spans and x[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], x[1])
                        else:
                            spans.append([*x])
                    for a, b in spans:
                        kept.append(raw[last:a])
                        last = b
                    left = b"".join([*kept, raw[last:]])
                    out["n_bytes"].append(len(raw))
                    out["n_removed"].append(len(raw) - len(left))
                    out["n_spans"].append(len(spans))
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                    out["kept"].append(left)
                    out["spans"].append([{"begin": a, "end": b} for a, b in spans])
                kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(), "spans": spans_of}
                yield pa.record_batch({"doc_id": part.column("doc_id"), **{c: pa.array(v, kinds[c]) for c, v in out.items()}})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<begin:int,end:int>>"
    return joined.mapInArrow(run, schema)
