from __future__ import annotations

import itertools
import random

import numpy as np
from edge import empty, frame, prose, rows

from sensorspark.llm import decontaminate as D


def test_longest_part():
    rng = np.random.default_rng(1)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 30)) < 0.7
        a, b = D.longest(equal, 0.8)
        n = len(equal)
        best = max((y - x for x in range(n) for y in range(x + 1, n + 1) if equal[x] and equal[y - 1] and equal[x:y].sum() >= 0.8 * (y - x) - 1e-9), default=0)
        assert b - a <= best and (b - a == 0 or equal[a:b].mean() >= 0.79)
        assert b - a >= best - 2 or best == 0


def test_planted_leaks(spark):
    r = random.Random(2)
    items = [(i, prose(30, 500 + i)) for i in range(20)] + [(20, None), (21, ""), (22, "too short"), (23, prose(30, 500)), (None, prose(12, 900))]
    docs, want = [], {}
    for i in range(200):
        text = prose(80, i)
        if i % 10 == 0:
            n = i // 10 % 20
            leak = items[n][1].split()
            for at in r.sample(range(len(leak)), 3):
                leak[at] = "changed"
            text = f"{text} {' '.join(leak).upper()} {prose(20, 3000 + i)}"
            want[i] = {n, 23} if n == 0 else {n}
        docs.append((i, text))
    docs.append((900, "x " + prose(12, 900) + " y"))
    df = spark.createDataFrame([(*d, "a", 1) for d in docs], "doc_id long, text string, words string, item int")
    bench = spark.createDataFrame([(*b, "b") for b in items], "item_id long, text string, key string")
    got = {x.doc_id: set(x.item_ids) for x in D.contaminated(df, bench).collect()}
    assert got.pop(900) == set()
    assert got == want
    kept = D.clean(df, bench)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {d[0] for d in docs} - set(want) - {900}


def test_masks_cover_every_allowed_change():
    for n in range(9, 20):
        for changed in map(set, itertools.combinations(range(n), n // 5)):
            assert any(not changed & {at + i for i in m} for m in D.MASKS for at in range(n - m[-1]))


def test_longest_part_is_not_cut_short():
    rng = np.random.default_rng(4)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 30)) < 0.7
        n = len(equal)
        best = max((y - x for x in range(n) for y in range(x + 1, n + 1) if equal[x] and equal[y - 1] and equal[x:y].sum() >= 0.8 * (y - x) - 1e-9), default=0)
        a, b = D.longest(equal, 0.8)
        assert b - a == best


def test_short_items_and_worst_changes(spark):
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (*range(1, 13), 15, 16, 20)}
    docs, want = [], {}
    for n, words in items.items():
        inside = list(itertools.combinations(range(1, n - 1), n // 5))
        # All allowed changes, and one more than allowed.
        for changed in random.Random(n).sample(inside, min(len(inside), 60)):
            text = ["other" if i in changed else w for i, w in enumerate(words)]
            want[len(docs)] = n
            docs.append(f"{prose(6, len(docs))} {' '.join(text)} {prose(6, 5000 + len(docs))}")
        if n // 5 + 1 <= n - 2:
            text = ["other" if i % 2 and i // 2 <= n // 5 else w for i, w in enumerate(words)]
            if n < 13:
                docs.append(f"{prose(6, len(docs))} {' '.join(text)} {prose(6, 5000 + len(docs))}")
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = {x.doc_id: x.item_ids for x in D.contaminated(df, bench).collect()}
    assert got == {i: [n] for i, n in want.items()}


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, rows()[0][1])], "item_id long, text string")
    got = D.contaminated(frame(spark), bench).collect()
    assert {x.doc_id for x in got} == {1, 2, 9, 11} and len(got) == 6
    assert D.clean(frame(spark), bench).count() == len(rows()) - 6
    assert D.contaminated(empty(spark), bench).count() == 0
    assert D.contaminated(frame(spark), bench.limit(0)).count() == 0
