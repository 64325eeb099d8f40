"""Windows, validity, subsampling, features and splits."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorspark.catalog.registry import QUERIES, load_all
from sensorspark.functions import encoders, vectors
from sensorspark.operators import audit, features, split, windows

load_all()


def ticks(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "t long")


def test_contiguous_starts(spark):
    df = ticks(spark, [0, 1, 2, 3, 1000, 1001, 1002, 1003])
    got = windows.contiguous(df, "t", 4)
    assert sorted({r["window_start"] for r in got.collect()}) == [0, 1000]


def test_contiguous_drops_short_runs_and_restarts(spark):
    df = ticks(spark, [0, 1, 2, 3, 4, 9, 10, 11, 12, 20])
    got = windows.contiguous(df, "t", 3)
    assert sorted({r["window_start"] for r in got.collect()}) == [0, 9]


@pytest.mark.parametrize("n,w,s,want", [(4200, 16, 1, 4185), (8798, 64, 1, 8735), (245_760, 1024, 1024, 240)])
def test_window_counts(spark, n, w, s, want):
    df = spark.range(n).withColumnRenamed("id", "t")
    assert windows.sliding(df, "t", w, s).select("window_id").distinct().count() == want


def test_seams_invalidate_the_windows_that_cross_them(spark):
    """Six segments of 700 rows have 5 seams; each spoils 15 windows of 16 rows."""
    df = spark.range(4200).select("id", (F.pmod("id", F.lit(700)) * 5 + 100).alias("t"))
    got = windows.validity(df, "t", 16, source_order="id", max_gap_s=None)
    assert got.count() == 4185 and got.filter("invalid").count() == 75


def test_rate_and_gap_rules(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([0, 60, 120, 300, 360, 420])], "i long, t long")
    got = windows.validity(df, "t", 2, source_order="i", expected_s=60.0, tolerance=0.05, max_gap_s=100.0)
    assert [(r["off_rate"], r["gap"]) for r in got.orderBy("i").collect()] == [
        (False, False), (False, False), (True, True), (False, False), (False, False)
    ]


def test_window_at(spark):
    df = spark.range(10).select(F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    assert windows.window_at(df, "t", ["x"], 3, 4).first()["values"]["x"] == [3.0, 4.0, 5.0, 6.0]
    for start in (8, 50):
        with pytest.raises(ValueError, match="out of range"):
            windows.window_at(df, "t", ["x"], start, 4)


@pytest.mark.parametrize("n,k", [(100, 7), (10, 10), (10, 20), (1000, 333), (11, 2), (5, 1)])
def test_even_subsample_matches_rounded_linspace(spark, n, k):
    got = sorted(r["id"] for r in windows.even_subsample(spark.range(n), "id", k).collect())
    want = list(range(n)) if n <= k else sorted(set(np.linspace(0, n - 1, k).round().astype(int).tolist()))
    assert got == want


def test_sample_frames_limit(spark):
    with pytest.raises(ValueError):
        windows.sample_frames(spark.range(5), "id", [], 65)


def test_resample_on_and_between_samples(spark):
    df = spark.createDataFrame([(0, 0.0), (10, 10.0), (45, 45.0)], "t long, x double")
    got = windows.resample(df, "t", ["x"], 5.0).orderBy("grid_us").collect()
    assert [r["x"] for r in got] == pytest.approx([5.0 * i for i in range(10)])


def test_fit_length(spark):
    df = spark.createDataFrame([([1.0] * 3,), ([2.0] * 20,), (list(map(float, range(1030))),)], "v array<double>")
    rows = windows.fit_length(df, "v").collect()
    assert all(len(r["fitted"]) == 1024 and len(r["mask"]) == 1024 for r in rows)
    assert [sum(r["mask"]) for r in rows] == [3, 20, 1024]
    assert rows[2]["fitted"][0] == 6.0 and "shorter" in rows[0]["warnings"][0] and "truncated" in rows[2]["warnings"][0]


def test_chunk_plan(spark):
    times = [0.0, 10.0, 50.0, 70.0, 80.0, 140.0, 150.0, 230.0, 400.0]
    df = spark.createDataFrame([("c", t) for t in times], "clip string, at double")
    got = [r["start_s"] for r in windows.plan_chunks(df, "clip", "at").orderBy("chunk").collect()]
    # 0 + 75 snaps to 70, 70 + 75 to 140; nothing lies in (140, 215] but 150; then 230 and 400 follow alone.
    assert got == [0.0, 70.0, 140.0, 150.0, 230.0, 400.0]


def test_chunk_plan_against_a_walk(spark):
    r = random.Random(8)
    clips = {c: sorted({round(r.uniform(0, span), 2) for _ in range(n)}) for c, span, n in (("long", 20_000, 3000), ("sparse", 9000, 40), ("one", 5, 1), ("dense", 60, 50))}
    df = spark.createDataFrame([(c, t) for c, ts in clips.items() for t in ts for _ in range(1 + (t > 100))], "clip string, at double")
    want = set()
    for c, ts in clips.items():
        start, n = ts[0], 0
        while True:
            want.add((c, n, start, start + 90))
            beyond = [t for t in ts if t > start + 75]
            if not beyond:
                break
            within = [t for t in ts if start < t <= start + 75]
            start, n = (within[-1] if within else beyond[0]), n + 1
    assert {tuple(x) for x in windows.plan_chunks(df, "clip", "at").collect()} == want


def test_splits(spark):
    df = spark.range(20).select((F.lit(100) - F.col("id")).alias("t"), "id")
    got = split.out_of_time(df, "t", ["id"], 0.3).collect()
    test = [r["t"] for r in got if r["split"] == "test"]
    train = [r["t"] for r in got if r["split"] == "train"]
    assert len(test) == 6 and max(train) < min(test)
    a = {r["id"] for r in split.seeded_random(df, ["id"]).filter("split = 'test'").collect()}
    b = {r["id"] for r in split.seeded_random(df.repartition(7), ["id"]).filter("split = 'test'").collect()}
    assert a == b and len(a) == 6
    for bad in (0.0, 1.0, 0.01):
        with pytest.raises(ValueError):
            split.out_of_time(df, "t", ["id"], bad)
    with pytest.raises(ValueError):
        split.out_of_time(df, "when", ["id"])


def embedding_rows(spark, labels=("normal", "normal", "fault")):
    rows = []
    for i, lab in enumerate(labels):
        rows.append((i, "b", [float(i), 1.0], lab))
        rows.append((i, "a", [0.0, float(i)], lab))
    return spark.createDataFrame(rows, "read_index long, sensor string, embedding array<float>, label string")


def test_joint_state(spark):
    got = features.joint_state(embedding_rows(spark), ["a", "b"]).orderBy("read_index").collect()
    assert got[2]["features"] == [0.0, 2.0, 2.0, 1.0] and got[2]["label"] == "fault"
    turned = features.joint_state(embedding_rows(spark), ["b", "a"]).orderBy("read_index").collect()
    assert turned[2]["features"] == [2.0, 1.0, 0.0, 2.0]


def test_joint_state_errors(spark):
    df = embedding_rows(spark)
    with pytest.raises(ValueError, match="exactly the sensors"):
        features.joint_state(df, ["a"])
    with pytest.raises(ValueError, match="exactly the sensors"):
        features.joint_state(df.filter("not (read_index = 1 and sensor = 'a')"), ["a", "b"])
    with pytest.raises(ValueError, match="exactly the sensors"):
        features.joint_state(df.unionByName(df.limit(1)), ["a", "b"])
    clash = df.withColumn("label", F.when(F.col("sensor") == "a", "x").otherwise(F.col("label")))
    with pytest.raises(ValueError, match="conflicting"):
        features.joint_state(clash, ["a", "b"])
    with pytest.raises(ValueError, match="missing"):
        features.joint_state(df.drop("label"), ["a", "b"])


def vector_table(spark, folder, ids):
    """An embeddings table whose vectors are ``[id, -id]``."""
    rows = [(i, [float(i), float(-i)], i % 3) for i in ids]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")


IDS = [0, 1, 2, 3, 4, 6, 6, 7, 8, 9]
WINDOWS = {0: [0, 1, 2, 3], 1: [4, 6, 6, 7], 2: [8, 9]}


def test_joint_state_keeps_windows_that_lack_or_repeat_a_sensor(spark, tmp_path):
    vector_table(spark, tmp_path, IDS)
    got = {r.read_index: (r.label, r.features) for r in QUERIES["joint_state"](spark, str(tmp_path)).collect()}
    assert got == {w: ("0", [x for i in ids for x in (float(i), float(-i))]) for w, ids in WINDOWS.items()}
    odd = embedding_rows(spark).unionByName(spark.createDataFrame([(0, None, [9.0], None), (0, "z", [8.0], None)], "read_index long, sensor string, embedding array<float>, label string"))
    got = {r.read_index: r.features for r in features.joint_state(odd, ["b", "a"], whole=False).collect()}
    assert got == {0: [0.0, 1.0, 0.0, 0.0, 8.0, 9.0], 1: [1.0, 1.0, 0.0, 1.0], 2: [2.0, 1.0, 0.0, 2.0]}
    clash = embedding_rows(spark).withColumn("label", F.col("sensor"))
    with pytest.raises(ValueError, match="conflicting"):
        features.joint_state(clash, ["a", "b"], whole=False)


def test_joint_state_by_default_keeps_windows_that_lack_or_repeat_a_sensor(spark, tmp_path):
    vector_table(spark, tmp_path, IDS)
    got = {r.read_index: r.features for r in QUERIES["joint_state_default"](spark, str(tmp_path)).collect()}
    assert got == {w: [x for i in ids for x in (float(i), float(-i))] for w, ids in WINDOWS.items()}


def test_normalisation_and_scalers(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]
    wide = spark.createDataFrame([(0.0, 10.0), (2.0, 10.0), (4.0, 10.0), (6.0, 10.0)], "a double, b double")
    fitted = features.fit_channels(wide, ["a", "b"])
    assert fitted["a"][0] == 3.0 and fitted["b"] == pytest.approx((10.0, 1e-9))
    dims = spark.createDataFrame([([0.0, 5.0],), ([2.0, 5.0],)], "v array<double>")
    scaled = features.fit_dimensions(dims, "v").transform(dims, "v").collect()
    assert [r["v"] for r in scaled] == [[-1.0, 0.0], [1.0, 0.0]]


def test_pca(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 3)) @ np.diag([5.0, 2.0, 0.1]) + 7
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    projection, shares = features.pca(df, "v", 2)
    got = np.array([r[0] for r in df.select(projection).collect()])
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    want = centred @ vt[:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)
    assert shares == pytest.approx((s**2 / (s**2).sum())[:2].tolist())
    for k in (0, 3):
        with pytest.raises(ValueError):
            features.pca(df, "v", k)


def test_encode_keeps_rows_and_guards_conventions(spark):
    df = spark.createDataFrame([([1.0] * 32,), (None,), ([2.0] * 16,)], "v array<double>")
    rows = encoders.encode(df, "v").collect()
    assert [r["embedding"] is None for r in rows] == [False, True, False]
    a = encoders.encode(df.limit(1), "v")
    b = encoders.encode(df.limit(1), "v", encoders.moments)
    encoders.assert_same_convention(a, a)
    with pytest.raises(ValueError):
        encoders.assert_same_convention(a, b)


def test_statistics_need_known_names(spark):
    with pytest.raises(ValueError):
        features.window_statistics(spark.range(3), [], "id", ["id"], [])


def test_sliding_statistics_equal_those_of_copied_rows(spark):
    """Against window_statistics over tagged rows: panes of one and of several rows, missing values, constant stretches."""
    r = random.Random(4)
    data = []
    for k, n in (("a", 150), ("b", 40), ("c", 7), ("d", 64)):
        for i in range(n):
            x = 1e6 + r.gauss(0, 1) if k == "a" else r.choice([-1.0, 0.0, 2.5])
            data.append((k, i * 3, None if r.random() < 0.2 or (k == "d" and 10 < i < 45) else x, 5.0))
    df = spark.createDataFrame(data, "k string, t long, x double, c double").withColumn("ts", F.timestamp_seconds("t"))
    for w, step in ((16, 4), (7, 1), (12, 8), (5, 9), (1, 1), (32, 1)):
        tagged = windows.sliding(df, "ts", w, step, ["k"])
        want = {tuple(x[:2]): x[2:] for x in features.window_statistics(tagged, ["k", "window_id"], "in_window", ["x", "c"]).collect()}
        got = {tuple(x[:2]): x[2:] for x in features.sliding_statistics(df, "ts", w, step, ["x", "c"], ["k"]).collect()}
        assert set(got) == set(want)
        for key, row in want.items():
            for a, b in zip(got[key], row):
                assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-6 * max(1.0, abs(b))), (w, step, key, got[key], row)


def test_sliding_statistics_over_many_stretches(spark, monkeypatch):
    real = features.with_halo
    monkeypatch.setattr(features, "with_halo", lambda df, keys, pos, before: real(df, keys, pos, before, chunk_rows=16))
    df = spark.range(300).select(F.timestamp_seconds("id").alias("ts"), (F.sin("id") * 10).alias("x"))
    got = features.sliding_statistics(df, "ts", 6, 1, ["x"], names=["mean", "max"]).orderBy("window_id").collect()
    xs = [x.x for x in df.orderBy("ts").collect()]
    assert len(got) == 295
    for i, row in enumerate(got):
        assert row.window_id == i and row.x_max == max(xs[i : i + 6]) and abs(row.x_mean - sum(xs[i : i + 6]) / 6) < 1e-9


def test_all_lengths_from_one_layout(spark):
    rows = [("a", t, float(t)) for t in [*range(0, 23), *range(30, 41)]] + [("b", t, 0.0) for t in range(5, 12)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    placed, runs = windows.prepare_sliding(df, "t", ["k"]), windows.prepare_contiguous(df, "t", ["k"])
    for w in (1, 3, 5, 8):
        for given, fresh in ((windows.sliding(placed, "t", w, 2, ["k"]), windows.sliding(df, "t", w, 2, ["k"])),
                             (windows.contiguous(runs, "t", w, ["k"]), windows.contiguous(df, "t", w, ["k"]))):
            assert given.columns == fresh.columns
            assert sorted(map(tuple, given.collect())) == sorted(map(tuple, fresh.collect()))
    # The prepared rows lie in the checkpoint folder: cutting windows from them moves no row.
    plan = windows.contiguous(runs, "t", 5, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_fit_series_counts_what_it_does_not_collect(spark):
    rows = [("long", t, float(t)) for t in range(50)] + [("exact", t, float(t)) for t in range(8)] + [("short", 0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {r["k"]: r for r in windows.fit_series(df, "t", "v", ["k"], shortest=4, longest=8).collect()}
    assert got["long"]["fitted"] == [float(t) for t in range(42, 50)] and got["long"]["n"] == 50
    assert got["long"]["warnings"] == ["truncated to the last 8 samples"] and all(got["long"]["mask"])
    assert got["exact"]["warnings"] == [] and len(got["exact"]["fitted"]) == 8
    assert got["short"]["fitted"] == [1.0] + [0.0] * 7 and got["short"]["mask"] == [True] + [False] * 7
    assert got["short"]["warnings"] == ["shorter than 4 samples"]


def test_a_test_table_must_not_hold_the_label(spark):
    df = spark.createDataFrame([(1, "x")], "id long, label string")
    audit.assert_no_label(df.drop("label"))
    with pytest.raises(ValueError):
        audit.assert_no_label(df)
