"""Window, validity, resampling and split queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.operators import split, windows

POS_SQL = """pos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY user_id) AS n FROM events)"""


@query("row_positions", f"WITH {POS_SQL} SELECT event_id, user_id, pos, n FROM pos")
def row_positions(t: Tables) -> DataFrame:
    return windows.positions(t.events.select("event_id", "user_id", "ts"), "ts", ["user_id"], ["event_id"]).drop("ts")


_TAGGED = """wins AS (SELECT p.*, w.window_id FROM pos p, LATERAL (SELECT unnest(generate_series(
  greatest(0, ceil((pos - {w} + 1) / {s}))::BIGINT,
  least(floor(pos / {s}), floor((n - {w}) / {s}))::BIGINT)) AS window_id) w
  WHERE pos < window_id * {s} + {w} AND pos >= window_id * {s})"""


@query(
    "sliding_windows",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=4)}
SELECT user_id, window_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS finish_us, count(*) AS n_rows
FROM wins GROUP BY 1, 2""",
)
def sliding_windows(t: Tables) -> DataFrame:
    tagged = windows.sliding(t.events.select("event_id", "user_id", "ts"), "ts", 16, 4, ["user_id"], ["event_id"])
    return windows.window_spans(tagged, "ts", ["user_id"])


@query(
    "tumbling_windows",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=16)}
SELECT user_id, window_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS finish_us, count(*) AS n_rows
FROM wins GROUP BY 1, 2""",
)
def tumbling_windows(t: Tables) -> DataFrame:
    tagged = windows.sliding(t.events.select("event_id", "user_id", "ts"), "ts", 16, 16, ["user_id"], ["event_id"])
    return windows.window_spans(tagged, "ts", ["user_id"])


HOURS_SQL = "hours AS (SELECT event_type, floor(epoch(ts) / 3600)::BIGINT AS hour, count(*) AS n FROM events GROUP BY 1, 2)"


def hourly(t: Tables) -> DataFrame:
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("hour")
    return t.events.groupBy("event_type", hour).agg(F.count(F.lit(1)).alias("n"))


@query(
    "contiguous_windows",
    f"""WITH {HOURS_SQL}, b AS (SELECT *, hour - lag(hour) OVER (PARTITION BY event_type ORDER BY hour) AS d FROM hours),
r AS (SELECT *, sum(CASE WHEN d = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY hour) AS run FROM b),
i AS (SELECT *, row_number() OVER (PARTITION BY event_type, run ORDER BY hour) - 1 AS p,
  min(hour) OVER (PARTITION BY event_type, run) AS h0 FROM r)
SELECT event_type, (h0 + (p // 6) * 6)::BIGINT AS window_start, count(*) AS n_rows, sum(n)::BIGINT AS n_events FROM i
GROUP BY event_type, run, h0, p // 6 HAVING count(*) = 6""",
)
def contiguous_windows(t: Tables) -> DataFrame:
    tagged = windows.contiguous(hourly(t), "hour", 6, ["event_type"])
    return tagged.groupBy("event_type", "window_start").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_events")
    )


@query(
    "window_validity",
    """WITH d AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos,
  (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id)) / 1e6 AS step FROM events),
f AS (SELECT *, coalesce(bool_or(step <= 0) OVER w, FALSE) AS backwards,
  coalesce(bool_or(abs(step / 36000.0 - 1) > 10.0) OVER w, FALSE) AS off_rate,
  coalesce(bool_or(step > 172800.0) OVER w, FALSE) AS gap FROM d
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, pos, epoch_us(ts) AS finish_us, backwards, off_rate, gap,
  (backwards OR off_rate OR gap) AS invalid FROM f WHERE pos >= 7""",
)
def window_validity(t: Tables) -> DataFrame:
    return windows.validity(
        t.events.select("event_id", "user_id", "ts"), "ts", 8, ["user_id"], source_order="event_id",
        expected_s=36_000.0, tolerance=10.0, max_gap_s=172_800.0,
    ).drop("ts")


@query(
    "resample_linear",
    """WITH e AS (SELECT user_id, epoch_us(ts) AS t, value AS v,
  lead(epoch_us(ts)) OVER w AS nt, lead(value) OVER w AS nv FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, unnest(generate_series(ceil(t / 21600000000.0)::BIGINT,
  coalesce(ceil(nt / 21600000000.0)::BIGINT - 1, floor(t / 21600000000.0)::BIGINT))) * 21600000000 AS grid_us FROM e)
SELECT user_id, grid_us, round(CASE WHEN grid_us = t THEN v
  ELSE v + (nv - v) * ((grid_us - t) / (nt - t)) END, 6) AS value FROM g""",
)
def resample_linear(t: Tables) -> DataFrame:
    return rounded(windows.resample(t.events, "ts", ["value"], 21_600.0, ["user_id"], ["event_id"]), "value")


@query(
    "even_subsample",
    f"""WITH {POS_SQL}, k AS (SELECT DISTINCT user_id, n, unnest(range(10)) AS i FROM pos),
s AS (SELECT DISTINCT user_id, round_even(i * ((n - 1) / 9), 0)::BIGINT AS pos FROM k)
SELECT event_id, user_id FROM pos SEMI JOIN s USING (user_id, pos)""",
)
def even_subsample(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts")
    return windows.even_subsample(rows, "ts", 10, ["user_id"], ["event_id"]).drop("ts")


@query(
    "snapshots",
    """SELECT user_id, epoch_us(time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01')) AS start_us,
  epoch_us(time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01')) + 43200000000 AS end_us,
  count(*) AS n_rows FROM events GROUP BY ALL""",
)
def snapshots(t: Tables) -> DataFrame:
    return windows.snapshots(t.events, "ts", ["value"], "12 hours", ["user_id"]).drop("document")


@query(
    "fit_length",
    f"""WITH {POS_SQL}, a AS (SELECT user_id, list(value ORDER BY pos) AS v FROM pos GROUP BY 1)
SELECT user_id, CASE WHEN len(v) > 64 THEN v[-64:] ELSE v || list_transform(range(64 - len(v)), lambda x: 0.0::DOUBLE) END AS fitted,
  (CASE WHEN len(v) < 16 THEN 'shorter than 16 samples' WHEN len(v) < 64 THEN 'padded to 64 samples'
    WHEN len(v) > 64 THEN 'truncated to the last 64 samples' ELSE '' END) AS warning,
  least(len(v), 64)::BIGINT AS n_real FROM a""",
)
def fit_length(t: Tables) -> DataFrame:
    fitted = windows.fit_series(t.events, "ts", "value", ["user_id"], ["event_id"], longest=64)
    return fitted.select(
        "user_id",
        "fitted",
        F.array_join("warnings", ";").alias("warning"),
        F.aggregate("mask", F.lit(0).cast("long"), lambda a, m: a + m.cast("long")).alias("n_real"),
    )


@query(
    "oot_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
  <= count(*) OVER () - floor(count(*) OVER () * 0.3) THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def oot_split(t: Tables) -> DataFrame:
    return split.out_of_time(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"]).drop(
        "o_orderdate"
    )


@query(
    "hash_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey)[1:15], o_orderkey) <= count(*) OVER () - floor(count(*) OVER () * 0.3)
  THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def hash_split(t: Tables) -> DataFrame:
    return split.seeded_random(t.orders.select("o_orderkey"), ["o_orderkey"])


@query(
    "chunk_plan",
    """WITH RECURSIVE k AS (SELECT DISTINCT o_custkey, epoch(o_orderdate) / 86400 AS d FROM orders),
c AS (SELECT o_custkey, 0::BIGINT AS chunk, min(d) AS start_s FROM k GROUP BY 1
  UNION ALL
  SELECT c.o_custkey, c.chunk + 1, coalesce(max(k.d) FILTER (WHERE k.d <= c.start_s + 500), min(k.d) FILTER (WHERE k.d > c.start_s + 500))
  FROM c JOIN k ON k.o_custkey = c.o_custkey AND k.d > c.start_s GROUP BY c.o_custkey, c.chunk, c.start_s
  HAVING max(k.d) > c.start_s + 500)
SELECT o_custkey, chunk, start_s, start_s + 600.0 AS end_s FROM c""",
)
def chunk_plan(t: Tables) -> DataFrame:
    """Order dates play keyframes of one recording per customer; a chunk is 600 days, overlap 100."""
    days = (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) / 86_400).alias("at")
    return windows.plan_chunks(
        t.orders.select("o_custkey", days).distinct(), "o_custkey", "at", chunk_s=600.0, overlap_s=100.0
    )
