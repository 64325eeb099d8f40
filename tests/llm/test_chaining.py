from __future__ import annotations

import random

import numpy as np
from edge import empty, frame, prose, rows

from sensorspark.llm import chaining as C


def test_chain_against_all_predecessors():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        begin, rbegin, size = rng.integers(0, 80, n), rng.integers(0, 80, n), rng.integers(5, 20, n)
        end, rend = begin + size, rbegin + size
        best = size.astype(float)
        for i in np.lexsort((rbegin, begin)):
            for j in range(n):
                if end[j] <= begin[i] and rend[j] <= rbegin[i]:
                    best[i] = max(best[i], size[i] + best[j] - 0.5 * (begin[i] - end[j] + rbegin[i] - rend[j]))
        chain, score = C.best_chain(begin, end, rbegin, rend, 0.5)
        assert abs(score - best.max()) < 1e-9
        assert all(end[a] <= begin[b] and rend[a] <= rbegin[b] for a, b in zip(chain, chain[1:]))


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(100):
        x, y = ([r.randint(0, 4) for _ in range(r.randint(0, 9))] for _ in range(2))
        t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                t[i + 1][j + 1] = t[i][j] + 1 if x[i] == y[j] else max(t[i][j + 1], t[i + 1][j])
        assert len(C._common(np.array(x), np.array(y))) == t[-1][-1]


def test_passages_hold_their_share():
    rng = np.random.default_rng(2)
    for _ in range(200):
        hit = rng.random(200) < np.repeat(rng.choice([0.1, 0.95], 10), 20)
        for a, b in C.passages(hit, 15, 0.8):
            assert hit[a] and hit[b - 1] and hit[a:b].mean() >= 0.8 - 1e-9
    assert C.passages(np.ones(60, bool), 50, 0.8) == [(0, 60)]
    assert C.passages(np.r_[np.zeros(9, bool), np.ones(51, bool), np.zeros(9, bool)], 50, 0.8) == [(9, 60)]


def test_passages_leave_none_out():
    """Between the passages no part of the length holds the share; scattered changes at the rate of the rule."""
    rng = np.random.default_rng(6)
    for size, changed in ((50, 5), (50, 8), (50, 10), (60, 10), (100, 18), (100, 20), (73, 14)):
        for _ in range(40):
            inner = np.ones(size, bool)
            inner[rng.choice(np.arange(1, size - 1), changed, replace=False)] = False
            hit = np.r_[rng.random(35) < 0.05, inner, rng.random(35) < 0.05]
            found = C.passages(hit, 50, 0.8)
            assert found and max(b for _, b in found) > 35 and min(a for a, _ in found) < 35 + size
    for _ in range(150):
        hit = rng.random(160) < np.repeat(rng.choice([0.1, 0.75, 0.85], 8), 20)
        found = C.passages(hit, 20, 0.8)
        level = np.r_[0, np.cumsum(hit)]
        for (_, a), (b, _) in zip([(0, 0), *found], [*found, (160, 160)]):
            for x in range(a, b):
                for y in range(x + 20, b + 1):
                    assert not (hit[x] and hit[y - 1]) or level[y] - level[x] < 0.8 * (y - x) - 1e-9


def planted():
    r = random.Random(3)
    passages = [prose(70, 7000 + i).split() for i in range(6)]
    docs, want = [], set()
    for i in range(240):
        text = prose(120, i)
        if i % 8 == 0:
            p = list(passages[i // 8 % 6])
            if i >= 48:
                want.add(i)
                for at in r.sample(range(20, 60), 2):
                    p[at] = "other"
                del p[40]
            text = f"{text} {' '.join(p)} {prose(30, 9000 + i)}"
        docs.append((i, text))
    return docs, want


def test_planted_passages(spark):
    docs, want = planted()
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, begin string").repartition(5)
    got = {x.doc_id: x for x in C.repeated_passages(df).collect()}
    assert set(got) == want
    for x in got.values():
        assert 60 <= x.n_words <= 85 and all(s < x.doc_id and (s - x.doc_id) % 48 == 0 for s in x.source_ids)
    out = {x.doc_id: x.text for x in C.without_passages(df).collect()}
    assert set(out) == {d[0] for d in docs}
    for i, text in docs:
        assert out[i] == text if i not in want else len(out[i].split()) < len(text.split()) - 55


def test_edge_rows(spark):
    got = {(x.doc_id, x.n_words) for x in C.repeated_passages(frame(spark)).collect()}
    assert got == {(2, 120), (9, 120), (11, 120)}
    kept = C.without_passages(frame(spark))
    assert kept.columns == frame(spark).columns
    left = sorted((str(x.doc_id), x.text or "") for x in kept.collect())
    assert len(left) == len(rows()) - 3 and ("2", " more") in left
    assert C.repeated_passages(empty(spark)).count() == 0 and C.without_passages(empty(spark)).count() == 0
