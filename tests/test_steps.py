"""Crowded buckets of steps: the sweep gives what all pairs give."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorspark.functions.sweep import best_overlap
from sensorspark.operators import steps


def all_pairs(start, end, b_start, b_end, position):
    out = []
    for s, e in zip(start, end):
        shared = np.minimum(e, b_end) - np.maximum(s, b_start)
        value = np.where(shared > 0, shared / ((e - s) + (b_end - b_start) - shared), 0.0)
        top = value.max() if len(value) else 0.0
        out.append((top, min(np.flatnonzero(value == top).tolist(), key=lambda i: position[i]) if top > 0 else -1))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_sweep_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    na, nb = rng.integers(0, 500, 2)
    if seed % 2:  # whole numbers: many ties
        start, b_start = rng.integers(0, 40, na).astype(float), rng.integers(0, 40, nb).astype(float)
        end, b_end = start + rng.integers(1, 30, na), b_start + rng.integers(1, 50, nb)
    else:
        start, b_start = rng.random(na) * 900, rng.random(nb) * 900
        end, b_end = start + rng.exponential(20, na) + 1e-3, b_start + rng.exponential(60, nb) + 1e-3
    position = rng.permutation(nb)
    got = best_overlap(start, end, b_start, b_end, position)
    assert list(zip(got[0].tolist(), got[1].tolist())) == all_pairs(start, end, b_start, b_end, position)


def test_sweep_of_mutually_overlapping_steps_is_far_from_all_pairs():
    rng = np.random.default_rng(3)

    def spent(n):
        start, b_start = rng.random(n) * 100, rng.random(n) * 100
        began = time.process_time()
        best_overlap(start, start + 500 + rng.random(n) * 500, b_start, b_start + 500 + rng.random(n) * 500, np.arange(n))
        return time.process_time() - began

    # Ten times the steps would be a hundred times the pairs.
    small = spent(4_000)
    assert spent(40_000) < 40 * max(small, 0.05)


def spans(spark, n, seed, kind):
    """A third of the rows lies in one clip around one instant; the rest is spread."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        start = float(rng.integers(0, 20)) if hot else float(rng.integers(0, 5_000))
        rows.append(("hot" if hot else f"c{i % 5}" if i % 7 else None, i, start, start + float(rng.integers(0, 60 if hot else 90))))
    return rows, spark.createDataFrame(rows, f"clip string, {kind} long, start double, end double")


@pytest.mark.parametrize("options", [{"crowded": 2, "swept_rows": 40}, {"crowded": 0}, {}])
def test_best_match_with_a_crowded_clip(spark, options):
    refs, reference = spans(spark, 240, 1, "step")
    cands, candidates = spans(spark, 300, 2, "position")
    got = {r["step"]: (r["iou"], r["position"], r["note"]) for r in steps.best_match(
        reference, candidates.withColumn("note", F.concat(F.lit("n"), F.col("position"))), ["clip"], carry=["note"], **options
    ).collect()}
    assert len(got) == len(refs)
    for clip, step, s, e in refs:
        own = [c for c in cands if c[0] == clip and clip is not None and c[3] > c[2]]
        (value, at), = all_pairs([s], [e], *[np.array([c[i] for c in own]) for i in (2, 3, 1)]) if e > s else [(0.0, -1)]
        position = own[at][1] if at >= 0 else None
        assert got[step] == (pytest.approx(value), position, None if position is None else f"n{position}")


@pytest.mark.parametrize("options", [{}, {"crowded": 2, "swept_rows": 40}])
def test_pairs_are_not_sorted_and_parts_follow_the_rows(spark, monkeypatch, options):
    refs, reference = spans(spark, 240, 1, "step")
    _, candidates = spans(spark, 300, 2, "position")
    want = sorted(map(str, steps.best_match(reference, candidates, ["clip"], **options).collect()))
    joined, cuts = [], []
    pairs, cut = steps.overlap_pairs, steps.cut
    monkeypatch.setattr(steps, "JOINED_ROWS", 50)
    monkeypatch.setattr(steps, "overlap_pairs", lambda *a, **k: joined.append(pairs(*a, **k)) or joined[-1])
    monkeypatch.setattr(steps, "cut", lambda df: cuts.append(df) or cut(df))
    got = sorted(map(str, steps.best_match(reference, candidates, ["clip"], **options).collect()))
    assert got == want and len(got) == len(refs)
    # 540 rows, 50 to a task.
    assert joined and all(x.rdd.getNumPartitions() == 11 for x in joined)
    # All pairs go into a hash table; what is sorted are the few that reach the maximum.
    plan = cuts[-1]._jdf.queryExecution().executedPlan().toString()
    assert "max(" in plan and "SortAggregate" not in plan


def test_best_match_without_keys_and_of_empty_tables(spark):
    _, reference = spans(spark, 90, 1, "step")
    _, candidates = spans(spark, 90, 2, "position")
    reference, candidates = reference.drop("clip"), candidates.drop("clip")
    plain = sorted(map(tuple, steps.best_match(reference, candidates).collect()))
    swept = sorted(map(tuple, steps.best_match(reference, candidates, crowded=0, swept_rows=25).collect()))
    assert plain == swept and len(plain) == 90
    none = steps.best_match(reference, candidates.limit(0), crowded=0).collect()
    assert len(none) == 90 and {(r["iou"], r["position"]) for r in none} == {(0.0, None)}
    assert steps.best_match(reference.limit(0), candidates).count() == 0


@pytest.mark.parametrize(("similarity", "crowded"), [(0.2, 0), (0.6, 0), (1.0, 0), (0.6, 10_000)])
def test_merge_against_all_pairs(spark, similarity, crowded):
    rng = np.random.default_rng(5)
    words = ["turn", "the", "cap", "valve", "open", "close", "red", "blue"]
    rows = []
    for i in range(160):
        start = float(rng.integers(0, 80))
        said = None if i % 23 == 0 else " ".join(rng.choice(words, rng.integers(0, 6)))
        rows.append(("hot" if i % 3 else "cold", i % 4, float(i % 4) * 10, i // 4, said, start, start + float(rng.integers(0, 30))))
    schema = "clip string, chunk int, chunk_start double, step int, instruction string, timestamp_start double, timestamp_end double"
    got = steps.merge_chunks(spark.createDataFrame(rows, schema), "clip", similarity=similarity, bucket=7.0, crowded=crowded).collect()

    def twins(x, y):
        a, b = set((x[4] or "").split()), set((y[4] or "").split())
        met = x[5] + x[2] < y[6] + y[2] and y[5] + y[2] < x[6] + x[2] and x[6] > x[5] and y[6] > y[5]
        return x[0] == y[0] and x[1] < y[1] and met and a | b and len(a & b) / len(a | b) >= similarity

    kept = [y for y in rows if not any(twins(x, y) for x in rows)]
    assert len(kept) < len(rows)
    want = sorted((y[0], y[1], y[4] or "", y[5] + y[2], y[6] + y[2]) for y in kept)
    assert sorted((r["clip"], r["chunk"], r["instruction"] or "", r["start"], r["end"]) for r in got) == want
