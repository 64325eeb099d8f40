"""Blocks, imputation and diagnosis on small frames with known results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorspark.operators import blocks, profile

START = dt.datetime(2024, 1, 1)


def frame(spark, a, b=None, minutes=None):
    minutes = minutes or range(len(a))
    b = b or [100.0 + i for i in range(len(a))]
    rows = [(START + dt.timedelta(minutes=m), x, y) for m, x, y in zip(minutes, a, b)]
    return spark.createDataFrame(rows, "timestamp timestamp, sensor_a double, sensor_b double")


def holes(n, *gone):
    return [None if i in gone else float(i) for i in range(n)]


def built(df, **kw):
    return blocks.build(df, **kw).orderBy("timestamp").collect()


def test_short_gap_is_filled_linearly(spark):
    rows = built(frame(spark, holes(30, 10, 11)))
    assert len(rows) == 30 and {r["block_id"] for r in rows} == {1}
    assert [rows[i]["sensor_a"] for i in (10, 11)] == pytest.approx([10.0, 11.0])
    assert [i for i, r in enumerate(rows) if r["imputed"]] == [10, 11]


def test_long_gap_splits_and_is_dropped(spark):
    rows = built(frame(spark, holes(30, *range(10, 17))))
    assert len(rows) == 23 and sorted({r["block_id"] for r in rows}) == [1, 2]


def test_any_sensor_can_split(spark):
    b = [None if 20 <= i <= 26 else 100.0 + i for i in range(30)]
    rows = built(frame(spark, holes(30, 5, 6), b))
    assert len(rows) == 23 and len({r["block_id"] for r in rows}) == 2


def test_threshold_is_strict(spark):
    assert len(built(frame(spark, holes(20, *range(5, 10))))) == 20
    assert len(built(frame(spark, holes(20, *range(5, 11))))) == 14


@pytest.mark.parametrize("method,want", [("ffill", [2.0, 2.0]), ("bfill", [5.0, 5.0]), ("time", [3.0, 4.0])])
def test_fill_methods(spark, method, want):
    rows = built(frame(spark, holes(10, 3, 4)), method=method)
    assert [rows[3]["sensor_a"], rows[4]["sensor_a"]] == pytest.approx(want)


def test_edges_take_the_nearest_value_and_neighbours_stay_inside_the_block(spark):
    a = [None, None, 2.0, 3.0] + [None] * 7 + [None, 12.0]
    b = [1.0] * 4 + [None] * 7 + [1.0] * 2
    rows = built(frame(spark, a, b))
    assert [r["sensor_a"] for r in rows[:2]] == [2.0, 2.0]
    # The sensor's own run of 8 is long, so its last null row is dropped as well.
    assert len(rows) == 5 and rows[-1]["sensor_a"] == 12.0


def test_sensor_without_values_in_a_short_series_stays_null(spark):
    rows = built(frame(spark, [None] * 4))
    assert all(r["sensor_a"] is None and r["imputed"] and r["still_null"] for r in rows)


def test_time_jump_alone_does_not_split(spark):
    minutes = [*range(15), *range(25, 40)]
    df = frame(spark, holes(30), minutes=minutes)
    assert {r["block_id"] for r in built(df)} == {1}
    assert {r["block_id"] for r in built(df, max_time_gap_s=300.0)} == {1, 2}


def test_nan_is_missing_and_non_sensor_columns_pass_through(spark):
    df = frame(spark, [0.0, float("nan"), 2.0]).withColumn("machine_status", F.lit(1)).withColumn("flag", F.lit(True))
    rows = built(df)
    assert rows[1]["sensor_a"] == 1.0 and rows[1]["machine_status"] == 1 and rows[1]["flag"] is True


def test_unsorted_input_and_dropped_sensors(spark):
    df = frame(spark, holes(30, *range(10, 17))).orderBy(F.rand(3))
    assert len(built(df)) == 23
    assert len(built(df, drop=["sensor_a", "unknown"])) == 30


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        blocks.build(frame(spark, [1.0]), method="magic")


def test_empty_frame(spark):
    assert blocks.build(frame(spark, [])).count() == 0


def test_repair_windows(spark):
    rows = [(0, i, None if i in (2, 3) or 6 <= i <= 9 else float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "w int, p int, x double")
    out = [r["x"] for r in blocks.repair_windows(df, ["w"], "p", ["x"], max_gap=2).orderBy("p").collect()]
    assert out[2:4] == [2.0, 3.0] and out[6:10] == [None] * 4


def test_sampling_report(spark):
    minutes = [*range(0, 5), *range(8, 13), *range(20, 25), *range(30, 35)]
    df = frame(spark, [0.0] * 20, minutes=minutes)
    r = profile.sampling(df, "timestamp").first()
    assert r["gap_count"] == 3 and r["median_delta_s"] == 60.0 and r["matches_expected"]
    top = profile.top_gaps(df, "timestamp", top_n=2).orderBy("gap_rank").collect()
    assert [g["size_s"] for g in top] == [480.0, 360.0]


def test_single_instant_has_no_sampling(spark):
    r = profile.sampling(frame(spark, [1.0] * 5, minutes=[0] * 5), "timestamp").first()
    assert r["n_duplicates"] == 4 and r["median_delta_s"] is None and r["gap_count"] is None


def test_null_profile(spark):
    df = frame(spark, holes(30, 1, 10, 11, 12))
    got = {r["column"]: r for r in profile.nulls(df, "timestamp").collect()}
    assert got["sensor_a"]["n_null"] == 4 and got["sensor_a"]["max_consecutive_null"] == 3
    assert got["sensor_b"]["max_consecutive_null"] == 0


def test_time_axis_of_strings(spark):
    good = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:01:00",)], "timestamp string")
    bad = spark.createDataFrame([("2024-01-01 00:00:00",), ("soon",)], "timestamp string")
    assert profile.time_axis(good, "timestamp").first()["coercible"] is True
    assert profile.time_axis(bad, "timestamp").first()["coercible"] is False
    assert profile.time_axis(bad, "when").first()["present"] is False


def test_hot_series_gives_the_same_blocks(spark):
    """One series holds most rows; cutting it finely must not change anything."""
    from sensorspark.plans import series

    rows = [("hot", i, None if (i // 7) % 9 == 0 or i % 13 == 0 else float(i % 50)) for i in range(2000)]
    rows += [(f"s{k}", i, None if i % 5 == k else float(i)) for k in range(5) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, timestamp long, x double")
    want = sorted(map(tuple, blocks.build(df, "timestamp", ["k"]).collect()), key=str)
    planned = series.plan_layout

    def fine(d, keys, axis, ties=(), **_):
        return planned(d, keys, axis, ties, first_width=10**9, target_rows=60)

    blocks.plan_layout = fine
    try:
        got = sorted(map(tuple, blocks.build(df, "timestamp", ["k"]).collect()), key=str)
    finally:
        blocks.plan_layout = planned
    assert got == want


def test_diagnose_a_burst(spark):
    """A third of the rows at one instant, a series of one row, missing times, a NULL key; times of another zone."""
    data = [("a", i * 10, 1.0 if i % 3 else None) for i in range(60)] + [("a", 200, 2.0)] * 40 + [("b", 5, None), (None, 7, 1.0), (None, 9, None), ("a", None, 3.0)]
    df = spark.createDataFrame(data, "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    report = profile.diagnose(df.drop("s"), "ts", ["k"], expected_seconds=10.0)
    assert set(report) == {"axis", "sampling", "gaps", "nulls", "columns_with_nulls"}
    got = {r.k: r for r in report["sampling"].collect()}
    assert (got["a"].n_rows, got["a"].n_duplicates, got["a"].median_delta_s, got["a"].matches_expected, got["a"].gap_count) == (101, 40, 10.0, True, 0)
    assert (got["b"].n_rows, got["b"].n_duplicates, got["b"].median_delta_s, got["b"].gap_count) == (1, 0, None, None)
    assert (got[None].median_delta_s, got[None].n_duplicates) == (2.0, 0)
    missing = {r.k: (r.n_columns, r["columns"]) for r in report["columns_with_nulls"].collect()}
    assert missing["b"] == (1, ["v"]) and missing["a"][0] == 1
    assert set(profile.diagnose(df, "nowhere")) == {"axis"}


def test_weighted_quantile(spark):
    from sensorspark.plans.ranks import weighted_quantile

    rows = [("a", v, w) for v, w in ((1, 5), (7, 1), (9, 4), (40, 2))] + [(None, 3, 10**12), (None, 4, 10**12)]
    df = spark.createDataFrame(rows, "k string, v long, w long")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.k: r.quantile for r in weighted_quantile(df, ["k"], "v", "w", q).collect()}
        want = df.filter("k = 'a'").agg(F.percentile("v", q, F.col("w"))).first()[0]
        assert got["a"] == pytest.approx(want) and 3 <= got[None] <= 4
