"""Small helpers shared by the operators of this subpackage.

Conventions, the same for every operator:

* A NULL text is an empty text.  An empty table gives an empty result.
* The operators read the columns they name and build new tables from them, so
  extra columns of the caller, whatever their names, do not clash.
* Rows that repeat a ``doc_id``, or have none, are documents of their own.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The word patterns of the contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWEST = -(2**63)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer used."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def numbered(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``(key, copy, doc_id, text)``: ``(key, copy)`` is unique, in document order, never NULL.

    ``key`` is the ``doc_id`` (the lowest long for NULL) and ``copy`` numbers the rows
    that share it, by text.  Only ids are grouped; texts move only for ids that repeat.
    With ``whole`` a struct ``row`` holds all columns of the caller.
    """
    row = [F.struct("*").alias("row")] if whole else []
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        *row,
    )
    names = ["key", "copy", "doc_id", "text", *["row"] * whole]
    repeated = rows.groupBy("key").count().filter("count > 1").select("key")
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0)).select(names)
    order = Window.partitionBy("key").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    again = rows.join(repeated, "key", "left_semi").withColumn("copy", F.row_number().over(order))
    return (
        rows.join(repeated, "key", "left_anti")
        .withColumn("copy", F.lit(0))
        .unionByName(again)
        .select(names)
    )


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` in total; a larger row is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the ``n + 1`` offsets; NULL is empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def batches(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``limit`` bytes of text each."""
    column = batch.column(text)
    if len(column):
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, limit):
            yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# --- words as hashes -----------------------------------------------------------------------

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
# Lower case for A-Z; everything ASCII that is no letter or digit separates words.
_WORD_BYTE = _BYTE.copy()
_WORD_BYTE[65:91] = _BYTE[97:123]
_IS_WORD = np.ones(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _IS_WORD[_a : _b + 1] = False


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    with np.errstate(over="ignore"):
        done, step = 1, np.uint64(base)
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * step
            done += m
            step = step * step
    return out[:n]


def word_hashes(raw: np.ndarray, offsets: np.ndarray):
    """Hashes of the words of many texts: ``(hash, first byte, end byte, first word of each text)``.

    Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased.  Positions are
    in ``raw``; the last array has ``n + 1`` entries.
    """
    n = len(raw)
    word = _IS_WORD[raw]
    inner = offsets[1:-1]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    begin[inner[inner < n]] = word[inner[inner < n]]
    end = word.copy()
    end[:-1] &= ~word[1:]
    edge = inner[(inner > 0) & (inner <= n)] - 1
    end[edge] = word[edge]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_WORD_BYTE[raw] * powers(_BASE, n), out=total[1:])
        inverse = powers(_INVERSE, n) if n else np.zeros(0, np.uint64)
        h = (total[last] - total[first]) * inverse[first] if n else np.zeros(0, np.uint64)
        h = mix64(h + (last - first).astype(np.uint64))
    return h, first, last, np.searchsorted(first, offsets)


def gram_hashes(h: np.ndarray, k: int, mask: tuple[int, ...] | None = None) -> np.ndarray:
    """Hashes of ``k`` consecutive entries; ``mask`` lists the positions that count."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in mask if mask is not None else range(k):
            out = out * np.uint64(_BASE) + h[i : i + n]
        return mix64(out)


def window_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries."""
    size, low = 1, x
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = w - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], **same) -> pa.RecordBatch:
    """One row per bucket: list columns with the entries dealt to it, and ``same`` as constants."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    bounds = pa.array(np.r_[first, len(b)].astype(np.int32))
    out = {"bucket": pa.array(b[first].astype(np.int32))}
    out |= {c: pa.array([v] * len(first)) for c, v in same.items()}
    return pa.record_batch(out | {c: pa.ListArray.from_arrays(bounds, pa.array(v[order])) for c, v in columns.items()})


def unpacked(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    """The entries of all list columns ``names``, end to end."""
    return {c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in names}
