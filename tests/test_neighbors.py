"""Neighbours, prototypes and outlier scores against brute force."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorspark.operators import lof, neighbors


def table(spark, x, ids=None, **cols):
    ids = range(len(x)) if ids is None else ids
    names = list(cols)
    rows = [(int(i), [float(a) for a in v], *[cols[c][n] for c in names]) for n, (i, v) in enumerate(zip(ids, x))]
    kinds = "".join(f", {c} string" for c in names)
    return spark.createDataFrame(rows, f"id long, features array<double>{kinds}")


def test_small_example(spark):
    lib = table(spark, [(0, 0), (0.1, 0), (9, 9)], label=["healthy", "healthy", "degraded"])
    q = table(spark, [(0.05, 0), (9.1, 9)])
    for k, want in ((3, {0: "healthy"}), (1, {1: "degraded"})):
        near = neighbors.knn(q, lib, k, query_id="id", library_id="id", carry=["label"])
        got = {r["id"]: r["predicted"] for r in neighbors.vote(near, "id").collect()}
        assert want.items() <= got.items()


def test_vote_ties_go_to_the_nearer_label(spark):
    near = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", 0.2), (2, "b", 0.3), (2, "a", 0.3)], "id long, label string, distance double"
    )
    got = {r["id"]: r["predicted"] for r in neighbors.vote(near, "id").collect()}
    assert got == {1: "b", 2: "a"}


def brute(q, lib, k, skip):
    out = {}
    for i, v in enumerate(q):
        d = np.sqrt(((lib - v) ** 2).sum(1))
        if skip:
            d[i] = np.inf
        order = np.lexsort((np.arange(len(lib)), d))[:k]
        out[i] = [(int(j), round(float(d[j]), 9)) for j in order]
    return out


def collected(near):
    out = {}
    for r in near.collect():
        out.setdefault(r["id"], []).append((r["rank"], r["neighbor_id"], round(r["distance"], 9)))
    return {i: [(n, d) for _, n, d in sorted(v)] for i, v in out.items()}


@pytest.mark.parametrize("blocked", [False, True])
def test_both_paths_equal_brute_force_with_many_copies(spark, blocked, monkeypatch):
    """A third of the library are copies of one vector, so most distances tie."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((150, 6))
    x[::3] = x[0]
    df = table(spark, x)
    if blocked:
        monkeypatch.setattr(neighbors, "BLOCK_BYTES", 8 * 6 * 40)
        monkeypatch.setattr(neighbors, "QUERY_BLOCK", 60)
    size = 0 if blocked else neighbors.BROADCAST_BYTES
    near = neighbors.knn(df, df, 4, query_id="id", library_id="id", skip_same_id=True, broadcast_bytes=size)
    assert collected(near) == brute(x, x, 4, True)


@pytest.mark.parametrize("size", [0, neighbors.BROADCAST_BYTES])
def test_assets_are_searched_apart(spark, size):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((60, 4))
    asset = ["hot" if i % 3 else "cold" for i in range(60)]
    df = table(spark, x, asset=asset)
    near = neighbors.knn(df, df, 3, query_id="id", library_id="id", by=["asset"], skip_same_id=True, broadcast_bytes=size)
    got = collected(near)
    for i in range(60):
        same = [j for j in range(60) if asset[j] == asset[i] and j != i]
        d = sorted((round(float(np.sqrt(((x[j] - x[i]) ** 2).sum())), 9), j) for j in same)[:3]
        assert got[i] == [(j, v) for v, j in d]


def test_prototype_probabilities(spark):
    shots = table(spark, [(0, 0), (2, 0), (10, 0)], label=["n", "n", "f"])
    protos = neighbors.prototypes(shots)
    got = neighbors.nearest_prototype(table(spark, [(1, 0), (9, 0)]), protos, 2, query_id="id").orderBy("id").collect()
    assert [r["predicted"] for r in got] == ["n", "f"]
    assert got[0]["probabilities"]["n"] == pytest.approx(1 / (1 + np.exp(-9.0)))


@pytest.mark.parametrize("size", [0, neighbors.BROADCAST_BYTES])
def test_outlier_factor(spark, size):
    rng = np.random.default_rng(8)
    ref, k = rng.standard_normal((40, 3)), 5
    q = np.vstack([rng.standard_normal((4, 3)), [[8.0, 8.0, 8.0]]])
    fitted = lof.fit(table(spark, ref), id="id", k=k, broadcast_bytes=size)
    got = [r["anomaly_score"] for r in lof.score(table(spark, q), fitted, id="id", k=k, broadcast_bytes=size).orderBy("id").collect()]

    d = np.sqrt(((ref[:, None] - ref[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    nn = np.argsort(d, axis=1)[:, :k]
    kd = np.take_along_axis(d, nn, 1).max(1)
    lrd = 1 / (np.maximum(np.take_along_axis(d, nn, 1), kd[nn]).mean(1) + 1e-10)
    dq = np.sqrt(((q[:, None] - ref[None]) ** 2).sum(-1))
    nq = np.argsort(dq, axis=1)[:, :k]
    lq = 1 / (np.maximum(np.take_along_axis(dq, nq, 1), kd[nq]).mean(1) + 1e-10)
    assert got == pytest.approx((lrd[nq].mean(1) / lq).tolist())
    assert got[-1] > 2


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1.762,), (1.763,)], "anomaly_score double")
    assert [r["predicted_label"] for r in lof.label(df, 1.762).collect()] == ["normal", "anomaly"]


def test_a_bad_window_takes_no_other_with_it(spark):
    import numpy as np

    from sensorspark.functions import encoders

    def picky(x):
        if (x < 0).any():
            raise ValueError("negative")
        return encoders.moments(x)

    rows = [(i, [float(i), 2.0, 3.0] if i != 3 else [-1.0, 0.0, 0.0]) for i in range(8)] + [(8, []), (9, None)]
    df = spark.createDataFrame(rows, "id int, samples array<double>").coalesce(1)
    out = {r.id: r for r in encoders.encode(df, "samples", picky).collect()}
    assert [i for i, r in sorted(out.items()) if r.embedding is None] == [3, 8, 9]
    assert out[3].encode_error == "ValueError: negative" and out[8].encode_error == "no samples" and out[0].encode_error is None
    assert np.allclose(out[1].embedding[0], 2.0)


def test_cells_rule_out_what_is_far(spark, monkeypatch):
    """Twenty clusters: exact, and a query visits few of the cells; ids, copies and one asset without a pivot."""
    monkeypatch.setattr(neighbors, "BLOCK_BYTES", 8 * 3 * 40)
    rng = np.random.default_rng(9)
    centres = rng.uniform(-1000, 1000, (20, 3))
    x = np.repeat(centres, 60, axis=0) + rng.standard_normal((1200, 3))
    x[:60] = x[0]
    lib, q = table(spark, x), table(spark, x[::10], ids=range(0, 1200, 10))
    near = neighbors.knn(q, lib, 5, query_id="id", library_id="id", broadcast_bytes=0)
    got, want = collected(near), brute(x[::10], x, 5, False)
    assert got == {10 * i: v for i, v in want.items()}
    plain = lib.select(F.col("id").alias("neighbor_id"), neighbors.doubles("features").alias("__v"))
    cells = neighbors.Cells(plain, [], 1200, 3)
    n_cells = cells.library.select("__cell").distinct().count()
    asked = q.select(F.col("id").alias("__q"), neighbors.doubles("features").alias("__v"))
    far = near.groupBy(F.col("id").alias("__q")).agg(F.max("distance").alias("__far"))
    visits = cells.home(asked, 5).count() + cells.others(asked.join(far, "__q"), 5).count()
    assert n_cells > 40 and visits < 120 * n_cells / 5, (visits, n_cells)
    # Without a bound no cell is ruled out.
    assert cells.others(asked.withColumn("__far", F.lit(None).cast("double")), 5).count() + cells.home(asked, 5).count() == 120 * n_cells


def test_nearest_in_blocks_of_queries(monkeypatch):
    """The matrix product only proposes: huge offsets, ties and own rows."""
    monkeypatch.setattr(neighbors, "SCRATCH", 500)
    rng = np.random.default_rng(3)
    for offset in (0.0, 1e7):
        x = np.round(rng.standard_normal((80, 2)) * 2) + offset
        ids = rng.permutation(80)
        r, c, d = neighbors.nearest(x, ids, x, ids, 3, True)
        for i in range(80):
            e = np.sqrt(((x - x[i]) ** 2).sum(1))
            e[i] = np.inf
            order = np.lexsort((ids, e))[:3]
            assert list(c[r == i]) == list(order) and list(d[r == i]) == list(e[order])


def test_memory_beside_the_library_is_bounded():
    # Copies of one vector tie at the last place, so their queries are measured against all.
    lib, ids = np.zeros((300_000, 16)), np.arange(300_000)
    tracemalloc.start()
    r, c, d = neighbors.nearest(lib[:4], ids[:4], lib, ids, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert c.tolist() == [1, 2, 3, 0, 2, 3, 0, 1, 3, 0, 1, 2] and not d.any()
    assert peak < 8 * (3 * neighbors.SCRATCH + 8 * len(lib))
    assert neighbors.BROADCAST_BYTES <= 32 << 20
