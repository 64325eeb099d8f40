"""Passages that repeat across documents, found by collinear chaining.

Seeds are shingles of five words, thinned to the smallest hash of every ``WINDOW`` in a row.
An occurrence of a seed is matched with its first occurrence and with the last one in an
earlier document, so matches are linear in the occurrences of the most frequent seed.  The
matches of two documents are merged along diagonals; a chain of them that goes forward in
both texts and loses least to gaps is found with a Fenwick tree; and the two texts are
aligned along the chain to see where they agree to four fifths over fifty words or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import batches, gram_hashes, numbered, packed, unpacked, utf8, window_minimum, word_hashes
from sensorspark.llm.decontaminate import longest
from sensorspark.session import cut

SHINGLE = 5
WINDOW = 8
# An unmatched word of either text costs a chain so much of a matched one; seeds are sparse, so
# little.  Where a chain leaves out more than GAP words of a text it is two.
GAP_COST = 0.1
GAP = 100
# Words beside a chain that are aligned as well, and the grid on which texts are fetched.
MARGIN, GRID = 40, 32
CHUNK = 48 << 20
HOT_IN_CHUNK = 256

SEED = "bucket int, known boolean, h array<long>, key array<long>, copy array<int>, pos array<int>, rkey array<long>, rcopy array<int>, rpos array<int>"
MATCH = "bucket int, key array<long>, copy array<int>, pos array<int>, rkey array<long>, rcopy array<int>, rpos array<int>"
_MATCH = ["key", "copy", "pos", "rkey", "rcopy", "rpos"]


def _sorted(e: dict) -> tuple[dict, np.ndarray, np.ndarray]:
    """By seed and place; where a seed begins and where a document of a seed begins."""
    o = np.lexsort((e["pos"], e["copy"], e["key"], e["h"]))
    e = {c: v[o] for c, v in e.items()}
    new = np.r_[True, e["h"][1:] != e["h"][:-1]] if len(o) else np.zeros(0, bool)
    doc = new | np.r_[True, (e["key"][1:] != e["key"][:-1]) | (e["copy"][1:] != e["copy"][:-1])] if len(o) else new
    return e, new, doc


def _matches(e: dict, new: np.ndarray, doc: np.ndarray, pick: np.ndarray | None = None) -> dict:
    """Each occurrence with the first one, and with the last one of an earlier document."""
    n = len(new)
    i = np.arange(n)
    first = np.maximum.accumulate(np.where(new, i, 0)) if n else i
    # The entry before the document's first one of this seed.
    before = (np.maximum.accumulate(np.where(doc, i, 0)) if n else i) - 1
    later = before >= first
    if pick is not None:
        later &= pick
    one, two = np.flatnonzero(later), np.flatnonzero(later & (before != first))
    at, ref = np.r_[one, two], np.r_[first[one], before[two]]
    return {c: e[c][at] for c in ("key", "copy", "pos")} | {"r" + c: e[c][ref] for c in ("key", "copy", "pos")}


def _seeds(parts: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Seeds dealt by hash.  A seed frequent in a chunk is sent once; its other occurrences match that one."""

    def flush(held):
        if not held:
            return
        e, new, doc = _sorted({c: np.concatenate([x[c] for x in held]) for c in held[0]})
        group = np.cumsum(new) - 1
        hot = (np.bincount(group, minlength=1) >= HOT_IN_CHUNK)[group] if len(group) else new
        none = {c: np.zeros(0, t) for c, t in (("rkey", np.int64), ("rcopy", np.int32), ("rpos", np.int32))}
        m = _matches(e, new, doc, hot)
        if len(m["key"]):
            empty = np.zeros(len(m["key"]), np.int64)
            yield packed(m["key"] % buckets, {"h": empty, **m}, known=True)
        sent = {c: v[~hot | new] for c, v in e.items()}
        rows = packed(sent["h"].view(np.uint64) % np.uint64(buckets), sent, known=False)
        n = len(rows)
        for c, v in none.items():
            rows = rows.append_column(c, pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array(v)))
        yield rows.select(["bucket", "known", "h", *_MATCH])

    held, total = [], 0
    for whole in parts:
        for part in batches(whole, "text", 2 << 20):
            raw, offsets = utf8(part.column("text"))
            h, _, _, word = word_hashes(raw, offsets)
            g = gram_hashes(h, SHINGLE)
            size = np.diff(word)
            end = np.repeat(word[1:], size)[: len(g)]
            whole_gram = np.arange(len(g)) + SHINGLE <= end
            # The largest value never is a minimum, so windows do not see over the end of a text.
            g = np.where(whole_gram, g, np.uint64(2**64 - 1))
            pad = np.full(WINDOW - 1, 2**64 - 1, np.uint64)
            least = window_minimum(np.concatenate([pad, g, pad]), WINDOW)
            most = ~window_minimum(~least, WINDOW) if len(least) >= WINDOW else least[:0]
            at = np.flatnonzero((g == most[: len(g)]) & whole_gram)
            text = np.searchsorted(word, at, side="right") - 1
            held.append(
                {
                    "h": g[at].view(np.int64), "key": part.column("key").to_numpy()[text], "copy": part.column("copy").to_numpy()[text],
                    "pos": (at - word[text]).astype(np.int32),
                }
            )
            total += len(raw)
            if total >= CHUNK:
                yield from flush(held)
                held, total = [], 0
    yield from flush(held)


def _join(table: pa.Table, buckets: int) -> pa.Table:
    """Matches of the seeds of one bucket, dealt by document."""
    known = np.array(table.column("known").to_pylist(), bool)
    seeds, done = table.filter(pa.array(~known)), table.filter(pa.array(known))
    parts = [unpacked(done, _MATCH), _matches(*_sorted(unpacked(seeds, ["h", "key", "copy", "pos"])))]
    m = {c: np.concatenate([p[c] for p in parts]) for c in _MATCH}
    return pa.Table.from_batches([packed(m["key"] % buckets, m)])


def best_chain(begin, end, rbegin, rend, gap: float = GAP_COST) -> tuple[list[int], float]:
    """The chain with the largest sum of lengths less ``gap`` times the words between, and that sum.

    Members follow one another in both texts.  Segments are visited by begin; one that has
    ended is entered in a Fenwick tree of prefix maxima over its end in the other text.
    """
    n = len(begin)
    ends = np.unique(rend)
    rank_end = np.searchsorted(ends, rend) + 1
    rank_begin = np.searchsorted(ends, rbegin, side="right")
    tree = [(-np.inf, -1)] * (len(ends) + 1)
    score, back = [0.0] * n, [-1] * n
    by_begin, by_end = np.lexsort((rbegin, begin)).tolist(), np.argsort(end, kind="stable").tolist()
    entered = 0
    for i in by_begin:
        while entered < n and end[by_end[entered]] <= begin[i]:
            j = by_end[entered]
            entered += 1
            value = (score[j] + gap * (end[j] + rend[j]), j)
            k = int(rank_end[j])
            while k < len(tree):
                if value > tree[k]:
                    tree[k] = value
                k += k & -k
        best, k = (-np.inf, -1), int(rank_begin[i])
        while k:
            if tree[k] > best:
                best = tree[k]
            k -= k & -k
        gain = best[0] - gap * (begin[i] + rbegin[i])
        score[i] = float(end[i] - begin[i])
        if gain > 0:
            score[i] += gain
            back[i] = best[1]
    i = int(np.argmax(score))
    chain, best = [], score[i]
    while i >= 0:
        chain.append(i)
        i = back[i]
    return chain[::-1], best


def _diagonals(m: dict) -> dict:
    """Matches of the same two documents merged along their diagonal, in order of the pair."""
    diagonal = m["pos"].astype(np.int64) - m["rpos"]
    o = np.lexsort((m["pos"], diagonal, m["rcopy"], m["rkey"], m["copy"], m["key"]))
    m, diagonal = {c: v[o] for c, v in m.items()}, diagonal[o]
    if not len(o):
        return m | {"begin": m["pos"], "end": m["pos"], "rbegin": m["pos"], "pair": m["pos"]}
    differs = lambda *cs: np.r_[True, reduce(np.logical_or, [m[c][1:] != m[c][:-1] for c in cs])]
    pair = differs("key", "copy", "rkey", "rcopy")
    # Seeds on one diagonal belong together if little is between them.
    far = np.r_[True, (diagonal[1:] != diagonal[:-1]) | (m["pos"][1:] - m["pos"][:-1] > 2 * WINDOW)]
    first = np.flatnonzero(pair | far)
    last = np.r_[first[1:], len(o)] - 1
    out = {c: m[c][first] for c in ("key", "copy", "rkey", "rcopy")}
    out["begin"], out["end"] = m["pos"][first].astype(np.int64), m["pos"][last].astype(np.int64) + SHINGLE
    out["rbegin"] = m["rpos"][first].astype(np.int64)
    out["pair"] = np.cumsum(pair)[first]
    return out


CHAIN = "key long, copy int, rkey long, rcopy int, begin array<int>, end array<int>, rbegin array<int>"


def _chains(table: pa.Table, least: int) -> pa.Table:
    """Chains of the documents of one bucket that may hold a passage of ``least`` words.

    A pair gives its best chain, then the best of what lies beside it, and so on.
    """
    d = _diagonals(unpacked(table, _MATCH))
    pair = d["pair"]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(pair)]
    # The edits of a passage may leave two seeds of it, even overlapping ones; the alignment finds its ends.
    shortest = min(least, SHINGLE + 1)
    found = []
    for a, b in zip(first.tolist(), last.tolist()):
        left = np.arange(a, b)
        while len(left):
            x, y, r = d["begin"][left], d["end"][left], d["rbegin"][left]
            chain, score = ([0], float(y[0] - x[0])) if len(left) == 1 else best_chain(x, y, r, r + (y - x))
            # No other chain has a larger sum.
            if score < shortest:
                break
            chain = np.array(chain)
            gap = np.maximum(x[chain[1:]] - y[chain[:-1]], r[chain[1:]] - (r + y - x)[chain[:-1]])
            beside = np.ones(len(left), bool)
            beside[chain] = False
            for piece in np.split(chain, np.flatnonzero(gap > GAP) + 1):
                low, high = x[piece[0]], y[piece[-1]]
                if high - low >= shortest:
                    covered = int((y[piece] - x[piece]).sum())
                    found.append((left[piece], int(low), int(high), covered))
                # What lies inside the span of this document is explained by it.
                beside &= ~((x >= low) & (y <= high))
            left = left[beside]
    rows = {c: [] for c in ("key", "copy", "rkey", "rcopy", "begin", "end", "rbegin")}
    by_doc: dict = {}
    for n, (at, low, high, covered) in enumerate(found):
        by_doc.setdefault((int(d["key"][at[0]]), int(d["copy"][at[0]])), []).append((low, -high, -covered, n))
    for spans in by_doc.values():
        dense_end = -1
        # One inside a dense chain of the same document shows nothing more.
        for low, high, covered, n in sorted(spans):
            if -high <= dense_end:
                continue
            if -covered >= 0.9 * (-high - low):
                dense_end = max(dense_end, -high)
            at = found[n][0]
            for c in ("key", "copy", "rkey", "rcopy"):
                rows[c].append(d[c][at[0]])
            for c in ("begin", "end", "rbegin"):
                rows[c].append(d[c][at].astype(np.int32))
    lists = pa.list_(pa.int32())
    kinds = {"key": pa.int64(), "copy": pa.int32(), "rkey": pa.int64(), "rcopy": pa.int32(), "begin": lists, "end": lists, "rbegin": lists}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in rows.items()})


def _common(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Indices of ``x`` in a longest common subsequence with ``y``."""
    n, m = len(x), len(y)
    if not n or not m:
        return []
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        same = y == x[i]
        row = np.maximum(table[i + 1, :-1], np.where(same, table[i + 1, 1:] + 1, 0))
        table[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j] and table[i, j] == table[i + 1, j + 1] + 1:
            out.append(i)
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(x: np.ndarray, y: np.ndarray, segments: list[tuple[int, int, int]]) -> np.ndarray:
    """For each word of ``x`` whether the alignment along the chain matches it.

    Segments ``(begin, end, begin in y)`` lie on diagonals; the words between two of them are
    aligned freely, and the first and the last diagonal go on over the margins.
    """
    hit = np.zeros(len(x), bool)

    def diagonal(a: int, b: int, shift: int) -> None:
        a, b = max(a, 0, shift), min(b, len(x), len(y) + shift)
        if b > a:
            hit[a:b] |= x[a:b] == y[a - shift : b - shift]

    for n, (a, b, r) in enumerate(segments):
        diagonal(0 if n == 0 else a, len(x) if n == len(segments) - 1 else b, a - r)
        if n:
            p, q, s = segments[n - 1]
            for i in _common(x[q:a], y[s + q - p : r]):
                hit[q + i] = True
    return hit


def passages(hit: np.ndarray, least: int, share: float) -> list[tuple[int, int]]:
    """Disjoint parts of at least ``least`` words that begin and end with a match and match to ``share``.

    First the maximal scoring parts, when a match is worth ``1 - share`` and a miss ``-share``:
    they end where the text stops to agree.  They cut off ends that lose as much as they win, so
    what lies beside them is searched for the longest part that holds the share, and again
    beside that one; no part of ``least`` words with the share is left between the results.
    """
    dense = _scoring(hit, least, share)
    out, at = [], 0
    for a, b in [*dense, (len(hit), len(hit))]:
        todo = [(at, a)]
        while todo:
            low, high = todo.pop()
            if high - low < least:
                continue
            p, q = longest(hit[low:high], share)
            if q - p >= least:
                out.append((low + p, low + q))
                todo += [(low, low + p), (low + q, high)]
        at = b
    return sorted([*dense, *out])


def _scoring(hit: np.ndarray, least: int, share: float) -> list[tuple[int, int]]:
    """The maximal scoring parts of at least ``least`` words."""
    out, stack, level = [], [], 0.0
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    last = 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        level -= share * (a - last)
        part = [a, b, level, level + (1 - share) * (b - a)]
        level, last = part[3], b
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= part[2]:
                j -= 1
            if j < 0 or stack[j][3] >= part[3]:
                break
            part = [stack[j][0], part[1], stack[j][2], part[3]]
            del stack[j:]
        stack.append(part)
    for a, b, _, _ in stack:
        if b - a >= least:
            out.append((a, b))
    return out


def _fetch(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """``(key, copy, a, b, words)``: hashes of the words ``a`` to ``b`` of each text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words = None, None
        for whole in parts:
            for part in batches(whole, "text"):
                key, copy = part.column("key").to_pylist(), part.column("copy").to_pylist()
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                out = []
                for i in range(len(part)):
                    if (key[i], copy[i]) != at:
                        h, _, _, _ = word_hashes(*utf8(part.column("text").slice(i, 1)))
                        at, words = (key[i], copy[i]), h.astype(np.uint32).view(np.int32)
                    out.append(words[max(a[i], 0) : b[i]])
                bounds = pa.array(np.r_[0, np.cumsum([len(o) for o in out])].astype(np.int32))
                yield pa.record_batch(
                    {c: part.column(c) for c in ("key", "copy", "a", "b")}
                    | {"words": pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(out) if out else np.zeros(0, np.int32)))}
                )

    joined = spans.join(rows, ["key", "copy"]).select("key", "copy", "a", "b", "text")
    return joined.mapInArrow(run, "key long, copy int, a int, b int, words array<int>")


PASSAGE = "key long, copy int, rkey long, rcopy int, begin int, end int, similarity double"


def repeated(rows: DataFrame, least: int = 50, share: float = 0.8) -> DataFrame:
    """``(key, copy, rkey, rcopy, begin, end, similarity)``: passages, in words, that an earlier text holds."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(48, size // (16 << 20))
    seeds = rows.select("key", "copy", "text").mapInArrow(lambda parts: _seeds(parts, buckets), SEED)
    matches = seeds.groupBy("bucket").applyInArrow(lambda t: _join(t, buckets), MATCH)
    chains = cut(matches.groupBy("bucket").applyInArrow(lambda t: _chains(t, least), CHAIN))
    low, high = F.element_at("begin", 1) - MARGIN, F.element_at("end", -1) + MARGIN
    # The last segment's end in the other text, and the first one's begin.
    rlow = F.element_at("rbegin", 1) - MARGIN
    rhigh = F.element_at("rbegin", -1) + F.element_at("end", -1) - F.element_at("begin", -1) + MARGIN
    down = lambda c: (F.floor(F.greatest(c, F.lit(0)) / GRID) * GRID).cast("int")
    up = lambda c: (F.ceil(c / GRID) * GRID).cast("int")
    placed = chains.select("*", down(low).alias("a"), up(high).alias("b"), down(rlow).alias("ra"), up(rhigh).alias("rb"))
    spans = placed.select("key", "copy", "a", "b").unionByName(
        placed.select(F.col("rkey").alias("key"), F.col("rcopy").alias("copy"), F.col("ra").alias("a"), F.col("rb").alias("b"))
    )
    words = cut(_fetch(spans.distinct(), rows))
    here = placed.join(words.withColumnRenamed("words", "x"), ["key", "copy", "a", "b"])
    there = words.select(F.col("key").alias("rkey"), F.col("copy").alias("rcopy"), F.col("a").alias("ra"), F.col("b").alias("rb"), F.col("words").alias("y"))
    both = here.join(there, ["rkey", "rcopy", "ra", "rb"]).select("key", "copy", "rkey", "rcopy", "begin", "end", "rbegin", "a", "ra", "x", "y")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            lists = {c: part.column(c) for c in ("begin", "end", "rbegin", "x", "y")}
            a, ra = part.column("a").to_pylist(), part.column("ra").to_pylist()
            for i in range(len(part)):
                begin, end, rbegin, x, y = (lists[c][i].values.to_numpy() for c in lists)
                segments = list(zip((begin - a[i]).tolist(), (end - a[i]).tolist(), (rbegin - ra[i]).tolist()))
                hit = align(x, y, segments)
                out += [(i, a[i] + p, a[i] + q, float(hit[p:q].mean())) for p, q in passages(hit, least, share)]
            if out:
                at = pa.array([o[0] for o in out])
                yield pa.record_batch(
                    {c: part.column(c).take(at) for c in ("key", "copy", "rkey", "rcopy")}
                    | {"begin": pa.array([o[1] for o in out], pa.int32()), "end": pa.array([o[2] for o in out], pa.int32()), "similarity": pa.array([o[3] for o in out])}
                )

    return both.mapInArrow(run, PASSAGE)


def repeated_passages(docs: DataFrame, least: int = 50, share: float = 0.8) -> DataFrame:
    """``(key, copy, doc_id, source_ids, n_words, spans)`` of the rows of ``docs`` that repeat a passage.

    A passage has ``least`` words or more of which ``share`` are matched in an earlier row (by
    ``doc_id``, then text).  The first text that holds a passage is not listed for it, nor is
    one that repeats itself only.  ``spans`` are ``(begin, end, source, similarity)`` in words,
    ``source_ids`` the rows they were matched with, ``n_words`` the words covered.  Words are
    runs of letters, digits and non-ASCII characters with A-Z lower-cased.
    """
    rows = numbered(docs)
    found = repeated(rows, least, share)
    names = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), F.col("doc_id").cast("long").alias("doc_id")).distinct()
    span = F.struct("begin", "end", F.col("rkey").alias("source"), "similarity")
    grouped = found.groupBy("key", "copy").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    # Words covered: each span counts from the furthest end before it.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("far"), F.lit(0).alias("n")),
        lambda s, x: F.struct(F.greatest(s["far"], x["end"]).alias("far"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["far"], x["begin"]))).alias("n")),
    )["n"]
    return grouped.join(names, "key").select(
        "key", "copy", "doc_id", F.array_distinct(F.transform("spans", lambda s: s["source"])).alias("source_ids"), covered.alias("n_words"), "spans"
    )


def without_passages(docs: DataFrame, least: int = 50, share: float = 0.8) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and ``n_chars`` counted anew where it exists.

    Rows of which no word is left go; all others stay, those without a passage as they were.
    """
    rows = numbered(docs, whole=True)
    found = repeated_passages(docs, least, share).select("key", "copy", "spans")
    joined = rows.join(found, ["key", "copy"], "left").select("row", "spans")
    others = [c for c in docs.columns if c != "text"]
    flat = joined.select(F.struct(*[F.col("row")[c].alias(c) for c in others]).alias("row"), F.col("row.text").alias("text"), F.transform("spans", lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"))).alias("spans"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in batches(whole, "text"):
                texts, gone = [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    lost = False
                    if spans and text is not None:
                        raw = text.encode()
                        _, first, last, _ = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                        kept, at, words = [], 0, len(first)
                        inside = np.zeros(words, bool)
                        for s in spans:
                            inside[s["begin"] : s["end"]] = True
                        edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
                        for p, q in zip(edge[::2].tolist(), edge[1::2].tolist()):
                            kept.append(raw[at : first[p]])
                            at = last[q - 1]
                        text = b"".join([*kept, raw[at:]]).decode()
                        lost = bool(inside.all())
                    texts.append(text)
                    gone.append(lost)
                yield pa.record_batch({"row": part.column("row"), "text": pa.array(texts, pa.string()), "gone": pa.array(gone, pa.bool_()), "cut": pa.array([bool(s) for s in part.column("spans").to_pylist()], pa.bool_())})

    kind = flat.schema["row"].dataType.simpleString()
    done = flat.mapInArrow(run, f"row {kind}, text string, gone boolean, cut boolean").filter("not gone")
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("cut"), F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c))
        else:
            columns.append(F.col("row")[c].alias(c))
    return done.select(columns)
