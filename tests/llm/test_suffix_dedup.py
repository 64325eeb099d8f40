from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from edge import SCHEMA, empty, frame, prose, rows

from sensorspark.llm import suffix_dedup as S
from sensorspark.llm.common import LOWEST


def brute(source, length=100):
    order = sorted(source, key=lambda r: (LOWEST if r[0] is None else r[0], r[1] or ""))
    seen, out = set(), []
    for r in order:
        raw = (r[1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    r = random.Random(8)
    line = prose(40, 5)[:160]
    out = []
    for i in range(120):
        parts = [prose(r.randint(1, 60), 1000 + i)]
        if i % 2:
            parts.insert(r.randint(0, 1), line)
        if i % 5 == 0:
            parts += [parts[0][: r.randint(90, 200)], prose(30, 7)]
        if i % 7 == 0:
            parts += ["ab" * r.randint(40, 120), "é" * 130]
        out.append((i * 3, "".join(parts) if i % 3 else " ".join(parts)))
    return [(i, t, None, None, None, 0, "", 0, "") for i, t in out]


def digests(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    source = rows() + cases()
    df = spark.createDataFrame(source, SCHEMA).repartition(4)
    want = brute(source)
    assert sum(w[2] for w in want) > 5000
    assert digests(S.remove_repeats(df)) == want
    # All anchors hot: strings are dealt one by one.
    monkeypatch.setattr(S, "HOT", 2)
    out = S.remove_repeats(df, batches_=5)
    assert digests(out) == want
    for r in out.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(s.end - s.begin for s in r.spans) == r.n_removed


def test_edge_rows(spark):
    assert digests(S.remove_repeats(frame(spark))) == brute(rows())
    assert S.remove_repeats(empty(spark)).count() == 0


def test_levels_double(spark):
    index = S.SuffixIndex(spark, S.fresh_path(spark, "levels"))
    df = spark.createDataFrame([(i, 0, prose(80, i)) for i in range(40)], "key long, copy int, text string")
    sizes = []
    for b in range(5):
        index.add(df.filter(f"key between {8 * b} and {8 * b + 7}"))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_hot_suffixes_are_split(monkeypatch):
    monkeypatch.setattr(S, "HOT_IN_CHUNK", 4)
    line = prose(40, 5)[:160]
    texts = [prose(3, i) + line + prose(3, 100 + i) for i in range(20)]
    batch = pa.record_batch({"key": pa.array(range(20), pa.int64()), "copy": pa.array([0] * 20, pa.int32()), "text": pa.array(texts)})
    out = pa.Table.from_batches(list(S._suffixes(iter([batch]), 100, 64)))
    span = np.concatenate([x.values.to_numpy() for c in out.column("span").chunks for x in c])
    pos = np.concatenate([x.values.to_numpy() for c in out.column("pos").chunks for x in c])
    assert ((span & S.FORCED) > 0).any() and (pos == -1).any()
    assert out.column("bucket").to_pylist()
