from __future__ import annotations

import hashlib
import re
import struct

import xxhash
from edge import empty, frame, prose, rows
from pyspark.sql import functions as F

from sensorspark.llm import order_minhash as O
from sensorspark.llm.common import LOWEST

SPACE = r"\x20\x09-\x0D"


def brute(text: str) -> str:
    runs = [m[1] for m in re.finditer(rf"(?<![^{SPACE}])(?=([^{SPACE}]+(?:[{SPACE}]+[^{SPACE}]+){{4}}(?![^{SPACE}])))", text)]
    if not runs:
        runs = [m[1] for m in re.finditer(rf"(?s)\A[{SPACE}]*([^{SPACE}].*)", text)]
    seen, bins = {}, {}
    for at, r in enumerate(runs):
        h = xxhash.xxh64_intdigest(r.encode(), 42)
        j = seen[r] = seen.get(r, -1) + 1
        if j:
            h = xxhash.xxh64_intdigest(struct.pack("<i", j), xxhash.xxh64_intdigest(struct.pack("<Q", h), 42))
        b = h % (2 * O.SLOTS)
        bins[b] = min(bins.get(b, (1 << 63,)), ((h >> 30), at))
    out = []
    for j in range(O.SLOTS):
        x, y = bins.get(2 * j), bins.get(2 * j + 1)
        if x is None and y is None:
            out.append("--------")
            continue
        in_order = x is None or y is None or x[1] <= y[1]
        seed = 42
        for v in (x[0] if x else -1, y[0] if y else -1):
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed = xxhash.xxh64_intdigest(struct.pack("<i", int(in_order)), seed)
        out.append(f"{seed & 0xFFFFFFFF:08x}")
    return "".join(out)


def likeness(a: str, b: str) -> float:
    cells = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
    filled = [x == y for x, y in cells if (x, y) != ("-" * 8, "-" * 8)]
    return sum(filled) / len(filled) if filled else 1.0


def test_against_brute_force(spark):
    source = rows() + [(100, "the same line\n" * 50, *[None] * 7), (101, prose(60, 4) + " " + prose(60, 4), *[None] * 7)]
    df = spark.createDataFrame(source, frame(spark).schema)
    order = sorted(((LOWEST if r[0] is None else r[0], r[1] or "", r[0]) for r in source), reverse=True)
    want = []
    for i, (_, text, doc) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = brute(text), brute(edited), brute(after)
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(likeness(a, b), 9), round(likeness(a, c), 9)))
    got = [(*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in O.compare_edits(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_order_counts(spark):
    a = prose(400, 1).split()
    swapped = " ".join(a[200:] + a[:200])
    df = spark.createDataFrame([(1, " ".join(a)), (2, swapped)], "id int, text string")
    s = {r.id: r.t for r in O.sketches(df, ["id"]).select("id", O.as_text(F.col("sketch")).alias("t")).collect()}
    assert 0.1 < likeness(s[1], s[2]) < 0.9


def test_empty(spark):
    assert O.compare_edits(empty(spark)).count() == 0
