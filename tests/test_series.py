"""Ordered scans against plain single-task windows, on hot series, bursts and ties."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorspark.plans.ranks import exact_quantile, order_statistic
from sensorspark.plans.series import CHUNK, SUB, explode_range, plan_layout, scan, with_halo


def skewed(spark, seed=1):
    """One series holds most rows, a burst holds most of those, many rows share an instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        t = rng.choice([500, 501, rng.randrange(490, 520), rng.randrange(0, 5000)])
        rows.append(("hot", t, i, rng.choice([None, float(rng.randrange(9))])))
    for s in range(8):
        for i in range(rng.randrange(1, 12)):
            rows.append((f"s{s}", rng.randrange(0, 5000), 1000 + i, rng.choice([None, 1.0, 2.0])))
    return spark.createDataFrame(rows, "k string, t long, id long, v double")


PLAIN = """
select k, t, id, v, pos, n, lag_v, lead_v, tot,
  last_value(v ignore nulls) over (w rows between unbounded preceding and current row) as up_v,
  last_value(v ignore nulls) over (w rows between unbounded preceding and 1 preceding) as be_v,
  first_value(v ignore nulls) over (w rows between current row and unbounded following) as on_v,
  first_value(v ignore nulls) over (w rows between 1 following and unbounded following) as af_v,
  max(p) over (w rows between unbounded preceding and current row) as up_at,
  max(p) over (w rows between unbounded preceding and 1 preceding) as be_at,
  min(p) over (w rows between current row and unbounded following) as on_at,
  min(p) over (w rows between 1 following and unbounded following) as af_at
from (select *, case when v is not null then pos end as p from
  (select *, row_number() over (partition by k order by t, id) - 1 as pos,
    count(*) over (partition by k) as n,
    lag(v) over (partition by k order by t, id) as lag_v,
    lead(v) over (partition by k order by t, id) as lead_v,
    sum(coalesce(v, 0)) over (partition by k order by t, id) as tot from src))
window w as (partition by k order by t, id)
"""


@pytest.mark.parametrize("target,width", [(10**6, 10**6), (20, 4096), (5, 1000)])
def test_scan_equals_plain_window(spark, target, width):
    df = skewed(spark)
    src = df.toArrow()
    con = duckdb.connect()
    con.register("src", src)
    want = con.execute(f"select * from ({PLAIN}) order by k, pos").fetchall()
    lay = plan_layout(df, ["k"], "t", ["id"], first_width=width, target_rows=target)
    v = F.col("v")
    got = scan(
        df, lay, pos="pos", size="n", lag={"lag_v": v}, lead={"lead_v": v},
        total={"tot": F.coalesce(v, F.lit(0.0))},
        upto={"up": v}, before={"be": v}, onward={"on": v}, after={"af": v},
    )
    if target < 100:
        assert lay.levels
        counts = got.groupBy(*lay.partition).count().agg(F.max("count")).first()[0]
        assert counts <= 2 * target
    flat = got.orderBy("k", "pos").select(
        "k", "t", "id", "v", "pos", "n", "lag_v", "lead_v", "tot",
        "up.v", "be.v", "on.v", "af.v", "up.at", "be.at", "on.at", "af.at",
    )
    assert [tuple(r) for r in flat.collect()] == want


def test_chained_scans_shuffle_rows_once(spark):
    df = skewed(spark)
    lay = plan_layout(df, ["k"], "t", ["id"])
    first = scan(df, lay, pos="pos", lag={"p": F.col("v")})
    assert CHUNK in first.columns and SUB not in first.columns
    second = scan(first, lay, total={"c": F.col("p")})
    assert second.filter("c is not null").count() > 0


def test_halo_frames(spark):
    df = skewed(spark)
    lay = plan_layout(df, ["k"], "t", ["id"])
    placed = scan(df, lay, pos="pos")
    haloed, part, lent = with_halo(placed, ["k"], "pos", 6, chunk_rows=50)
    frame = Window.partitionBy(*part).orderBy("pos").rowsBetween(-6, 0)
    got = haloed.withColumn("c", F.count("v").over(frame)).filter(~F.col(lent))
    plain = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-6, 0)
    want = df.withColumn("c", F.count("v").over(plain))
    cols = ["k", "t", "id", "c"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_exact_quantile_and_order_statistic(spark):
    df = spark.range(100_001).select(F.lit("a").alias("k"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("v"))
    df = df.unionByName(spark.createDataFrame([("b", 1), ("b", 4), ("c", 9)], "k string, v long"))
    for q in (0.5, 0.99, 0.0, 1.0):
        got = {r["k"]: r["quantile"] for r in exact_quantile(df, ["k"], "v", q).collect()}
        want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("v", q).alias("p")).collect()}
        assert got == pytest.approx(want)
    values = sorted(r["v"] for r in df.collect())
    for k in (0, 50_000, 99_999):
        assert order_statistic(df, ["v"], k, len(values)) == (values[k],)


def test_order_statistic_with_huge_ties(spark, monkeypatch):
    """A third of the rows share one value and the sketch has to narrow several times."""
    from sensorspark.plans import ranks

    monkeypatch.setattr(ranks, "MAX_VALUES", 40)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"), "id"
    )
    rows = sorted((r["v"], r["id"]) for r in df.collect())
    for k in (0, 1499, 1700, 2999):
        assert order_statistic(df, ["v", "id"], k, 3000) == rows[k]


def test_explode_range(spark):
    df = spark.createDataFrame([(1, 0, 25), (2, 5, 4), (3, -7, -7)], "k long, a long, b long")
    got = explode_range(df, "x", F.col("a"), F.col("b"), batch=10)
    assert sorted((r["k"], r["x"]) for r in got.collect()) == [(1, i) for i in range(26)] + [(3, -7)]


def test_a_null_key_is_a_key(spark):
    rows = [(k, t) for k in ("a", None) for t in (3, 1, 2)]
    df = spark.createDataFrame(rows, "k string, t long")
    lay = plan_layout(df, ["k"], "t")
    out = lay.detach(scan(df, lay, pos="pos", size="n", lag={"prev": F.col("t")}))
    assert sorted((r.k or "", r.t, r.pos, r.n, r.prev) for r in out.collect()) == [
        (k, t, t - 1, 3, t - 1 if t > 1 else None) for k in ("", "a") for t in (1, 2, 3)
    ]


def test_rows_of_one_instant_without_ties(spark):
    """Fresh and placed scans over many small chunks: every place that is named holds the value that is named."""
    r = random.Random(5)
    data = [(r.choice("ab"), r.randint(0, 60), r.choice([None, None, r.randint(0, 9)]), n) for n in range(3000)]
    df = spark.createDataFrame(data, "k string, t long, v long, n long")
    lay = plan_layout(df, ["k"], "t", first_width=16, target_rows=40)
    nearest = dict(before={"b": F.col("v")}, after={"a": F.col("v")}, upto={"u": F.col("v")}, onward={"o": F.col("v")})
    for rows in (df, lay.place(df)):
        got = scan(rows, lay, pos="p", size="s", lag={"l": F.col("t")}, total={"c": F.lit(1)}, **nearest).collect()
        for key in "ab":
            series = sorted((x for x in got if x.k == key), key=lambda x: x.p)
            assert [x.p for x in series] == list(range(len(series))) and {x.s for x in series} == {len(series)}
            assert [x.t for x in series] == sorted(x.t for x in series)
            assert [x.c for x in series] == [i + 1 for i in range(len(series))]
            assert [x.l for x in series] == [None, *[x.t for x in series[:-1]]]
            present = [x.p for x in series if x.v is not None]
            for x in series:
                want = {
                    "b": max((p for p in present if p < x.p), default=None),
                    "u": max((p for p in present if p <= x.p), default=None),
                    "a": min((p for p in present if p > x.p), default=None),
                    "o": min((p for p in present if p >= x.p), default=None),
                }
                for name, place in want.items():
                    assert (x[name].v, x[name].at) == ((None, None) if place is None else (series[place].v, place))


def test_scans_of_placed_rows_move_nothing(spark):
    df = spark.range(5000).selectExpr("id % 3 as k", "id as t", "if(id % 7 = 0, id, null) as v", "cast(id as string) as other")
    lay = plan_layout(df, ["k"], "t", first_width=1000)
    first = scan(lay.place(df), lay, pos="p", lag={"l": F.col("v")})
    second = scan(first.withColumn("new", F.col("l").isNull()), lay, total={"c": F.col("new").cast("long")}, upto={"u": F.col("v")})
    plan = second._jdf.queryExecution().executedPlan().toString()
    # Only the inherited values of the two scans, which know no other column, are moved or sorted.
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.splitlines()]
    for i, (depth, line) in enumerate(lines):
        if "Exchange" in line or "Sort [" in line:
            below = [x for d, x in lines[i + 1 :] if d > depth][:3]
            assert not any("other#" in x for x in below), plan
    assert second.agg(F.max("c")).first()[0] > 1000


def test_brackets_are_narrowed_for_all_groups_at_once(spark, monkeypatch):
    """A hot group of distinct values, one of ties, a small one and a NULL key; coarse sketches need several rounds."""
    from sensorspark.plans import ranks

    monkeypatch.setattr(ranks, "ACCURACY", 200)
    monkeypatch.setattr(ranks, "IN_BRACKET", 30)
    monkeypatch.setattr(ranks, "GRID", 10)
    hot = spark.range(30_000).select(F.lit("hot").alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    ties = spark.range(9_000).select(F.lit("ties").alias("k"), F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(900))).otherwise(450).alias("v"))
    rest = spark.range(5_000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(ties).unionByName(rest).unionByName(spark.createDataFrame([("few", 1), ("few", 4)], "k string, v long"))
    for q in (0.5, 0.9371, 0.0, 1.0):
        got = {r["k"]: r["quantile"] for r in exact_quantile(df, ["k"], "v", q).collect()}
        want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("v", q).alias("p")).collect()}
        assert got == pytest.approx(want)
        assert exact_quantile(df, [], "v", q).first()["quantile"] == pytest.approx(df.agg(F.percentile("v", q)).first()[0])
    # No group has more than a few rows left to rank.
    bounds = df.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("__lo"), F.max("v").alias("__hi"))
    rows = df.withColumnRenamed("v", "__v")
    narrow = ranks._narrowed(rows, bounds, ["k"], 0.5, True)
    inside = ranks._with_bounds(rows, narrow, ["k"], True).filter("__v > __lo and __v < __hi").groupBy("k").count()
    assert narrow.count() == 4 and (inside.agg(F.max("count")).first()[0] or 0) <= 30


def test_a_cut_shuffles_no_distinct_values(spark, monkeypatch):
    from sensorspark.plans import ranks

    monkeypatch.setattr(ranks, "MAX_VALUES", 100)
    seen = []
    real = type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda self, *c: (c and seen.append(self.count()), real(self, *c))[1])
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    values = sorted(x.v for x in df.collect())
    assert order_statistic(df, ["v"], 14_000, 20_000) == (values[14_000],)
    assert max(seen, default=0) <= 100
