"""Profile, blocking and imputation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.registry import Tables, query
from sensorspark.operators import blocks, profile
from sensorspark.plans.asof import as_of
from sensorspark.session import cut

SENSORS = ("click", "error", "purchase", "signup", "view")

FRAME_SQL = """frame AS (
  SELECT user_id, date_trunc('day', ts) AS day,
    avg(value) FILTER (WHERE event_type = 'click') AS click,
    avg(value) FILTER (WHERE event_type = 'error') AS error,
    avg(value) FILTER (WHERE event_type = 'purchase') AS purchase,
    avg(value) FILTER (WHERE event_type = 'signup') AS signup,
    avg(value) FILTER (WHERE event_type = 'view') AS view
  FROM events GROUP BY ALL)"""


def daily_frame(t: Tables) -> DataFrame:
    """A wide sensor frame: one series per user, one sensor per event type, one row per day.

    It is an aggregate that several passes read, so it is written once.
    """
    frame = t.events.groupBy("user_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).agg(
        *[F.avg(F.when(F.col("event_type") == s, F.col("value"))).alias(s) for s in SENSORS]
    )
    return cut(frame)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


DELTAS_SQL = """d AS (
  SELECT user_id, s, e, e - s AS delta FROM (
    SELECT user_id, epoch_us(ts) AS e,
      lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS s
    FROM (SELECT DISTINCT user_id, ts FROM events)) WHERE s IS NOT NULL),
m AS (SELECT user_id, quantile_cont(delta::DOUBLE, 0.5) AS med FROM d GROUP BY 1)"""


@query(
    "sampling_profile",
    f"""WITH {DELTAS_SQL},
c AS (SELECT user_id, count(*) AS n_rows, count(*) - count(DISTINCT ts) AS n_duplicates,
        epoch_us(min(ts)) AS min_us, epoch_us(max(ts)) AS max_us FROM events GROUP BY 1),
s AS (SELECT user_id, med, min(delta) / 1e6 AS lo, max(delta) / 1e6 AS hi, stddev_samp(delta / 1e6) AS sd,
        count(*) FILTER (WHERE delta > 2.0 * med) AS gap_count,
        coalesce(sum(delta) FILTER (WHERE delta > 2.0 * med), 0) / 1e6 AS gap_total_s
      FROM d JOIN m USING (user_id) GROUP BY 1, 2)
SELECT user_id, n_rows, n_duplicates, min_us, max_us, med / 1e6 AS median_delta_s,
  lo AS min_delta_s, hi AS max_delta_s,
  round(CASE WHEN med > 0 THEN sd / (med / 1e6) END, 6) AS regularity_cv,
  med = 3600 * 1e6 AS matches_expected, med * 2.0 / 1e6 AS gap_threshold_s,
  gap_count, gap_total_s
FROM c LEFT JOIN s USING (user_id)""",
)
def sampling_profile(t: Tables) -> DataFrame:
    out = profile.sampling(t.events, "ts", ["user_id"], expected_seconds=3600.0)
    return rounded(out, "regularity_cv")


@query(
    "top_gaps",
    f"""WITH {DELTAS_SQL}
SELECT user_id, gap_rank, s AS starts_us, e AS ends_us, round(delta / 1e6, 6) AS size_s FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY delta DESC, s) AS gap_rank
  FROM d JOIN m USING (user_id) WHERE delta > 2.0 * med) WHERE gap_rank <= 5""",
)
def top_gaps(t: Tables) -> DataFrame:
    return rounded(profile.top_gaps(t.events, "ts", ["user_id"]), "size_s")


@query(
    "delta_histogram",
    f"""WITH {DELTAS_SQL}, r AS (SELECT user_id, min(delta) AS lo, max(delta) AS hi FROM d GROUP BY 1),
b AS (SELECT user_id, lo, hi, coalesce(CASE WHEN hi > lo
    THEN least(floor((delta - lo) / ((hi - lo) / 10)), 9) END, 0)::BIGINT AS bin FROM d JOIN r USING (user_id))
SELECT user_id, bin, (lo + bin * ((hi - lo) / 10)) / 1e6 AS from_s, count(*) AS n
FROM b GROUP BY user_id, bin, lo, hi""",
)
def delta_histogram(t: Tables) -> DataFrame:
    return profile.delta_histogram(t.events, "ts", ["user_id"], bins=10)


@query(
    "time_axis",
    """SELECT user_id, count(*) AS n_rows, TRUE AS present, 'timestamp_ntz' AS dtype, NULL::VARCHAR AS timezone, TRUE AS coercible,
  epoch_us(min(ts)) AS min_us, epoch_us(max(ts)) AS max_us,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_s FROM events GROUP BY 1""",
)
def time_axis(t: Tables) -> DataFrame:
    return rounded(profile.time_axis(t.events, "ts", ["user_id"]), "duration_s")


@query(
    "sorted_in_source",
    """SELECT user_id, bool_and(ok) AS is_sorted FROM (
  SELECT user_id, coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY event_id), TRUE) AS ok FROM events)
GROUP BY 1""",
)
def sorted_in_source(t: Tables) -> DataFrame:
    return profile.sorted_in_source(t.events, "ts", "event_id", ["user_id"])


_RUNS = " UNION ALL ".join(
    f"SELECT user_id, '{s}' AS \"column\", day, {s} IS NULL AS gone FROM frame" for s in SENSORS
)


@query(
    "null_profile",
    f"""WITH {FRAME_SQL}, long AS ({_RUNS}),
isl AS (SELECT *, row_number() OVER (PARTITION BY user_id, "column" ORDER BY day)
          - row_number() OVER (PARTITION BY user_id, "column", gone ORDER BY day) AS g FROM long),
runs AS (SELECT user_id, "column", gone, g, count(*) AS c FROM isl GROUP BY ALL)
SELECT user_id, sum(c)::BIGINT AS n_rows, "column", 'double' AS dtype,
  coalesce(sum(c) FILTER (WHERE gone), 0)::BIGINT AS n_null,
  coalesce(max(c) FILTER (WHERE gone), 0)::BIGINT AS max_consecutive_null,
  round(coalesce(sum(c) FILTER (WHERE gone), 0) / sum(c) * 100, 6) AS pct_null
FROM runs GROUP BY user_id, "column" """,
)
def null_profile(t: Tables) -> DataFrame:
    return rounded(profile.nulls(daily_frame(t), "day", ["user_id"]), "pct_null")


@query(
    "missing_by_time",
    f"""WITH {FRAME_SQL}, w AS (SELECT *, time_bucket(INTERVAL '7 days', day, TIMESTAMP '1970-01-01') AS b FROM frame)
SELECT user_id, epoch_us(b) AS bucket_us, "column", round(avg(gone), 6) AS null_rate FROM ({' UNION ALL '.join(
    f"SELECT user_id, b, '{s}' AS " + '"column"' + f", ({s} IS NULL)::INT AS gone FROM w" for s in SENSORS)})
GROUP BY 1, 2, 3""",
)
def missing_by_time(t: Tables) -> DataFrame:
    return rounded(
        profile.missing_by_time(daily_frame(t), "day", SENSORS, ["user_id"], width="7 days"), "null_rate"
    )


_GAP = 6


def _flags_sql(sensors=SENSORS) -> str:
    runs = ", ".join(
        f"row_number() OVER (PARTITION BY user_id ORDER BY day) - row_number() OVER "
        f"(PARTITION BY user_id, {s} IS NULL ORDER BY day) AS g_{s}"
        for s in sensors
    )
    bad = " OR ".join(
        f"({s} IS NULL AND count(*) OVER (PARTITION BY user_id, {s} IS NULL, g_{s}) > {_GAP})" for s in sensors
    )
    return f"""{FRAME_SQL}, runs AS (SELECT *, {runs} FROM frame),
flags AS (SELECT *, {bad} AS bad FROM runs),
blocks AS (SELECT *, sum(CASE WHEN NOT bad AND prev THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY day) AS block_id FROM
  (SELECT *, coalesce(lag(bad) OVER (PARTITION BY user_id ORDER BY day), TRUE) AS prev FROM flags)),
good AS (SELECT *, row_number() OVER (PARTITION BY user_id, block_id ORDER BY day) AS p FROM blocks WHERE NOT bad)"""


def _near_sql() -> str:
    w = "OVER (PARTITION BY user_id, block_id ORDER BY day"
    parts = []
    for s in SENSORS:
        pos = f"CASE WHEN {s} IS NOT NULL THEN p END"
        parts += [
            f"last_value({s} IGNORE NULLS) {w}) AS {s}_l",
            f"max({pos}) {w}) AS {s}_lp",
            f"first_value({s} IGNORE NULLS) {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {s}_h",
            f"min({pos}) {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {s}_hp",
        ]
    return f"near AS (SELECT *, {', '.join(parts)} FROM good)"


def _fill_sql(kind: str) -> str:
    out = []
    for s in SENSORS:
        if kind == "linear":
            e = f"coalesce({s}, {s}_l + ({s}_h - {s}_l) * (p - {s}_lp) / ({s}_hp - {s}_lp), {s}_l, {s}_h)"
        elif kind == "ffill":
            e = f"coalesce({s}, {s}_l, {s}_h)"
        else:
            e = f"coalesce({s}, {s}_h, {s}_l)"
        out.append(f"round({e}, 6) AS {s}")
    any_null = " OR ".join(f"{s} IS NULL" for s in SENSORS)
    still = " OR ".join(f"({s}_l IS NULL AND {s}_h IS NULL)" for s in SENSORS)
    return f"""WITH {_flags_sql()}, {_near_sql()}
SELECT user_id, epoch_us(day) AS day_us, {', '.join(out)}, block_id::BIGINT AS block_id,
  ({any_null}) AS imputed, ({still}) AS still_null FROM near"""


def _built(t: Tables, method: str) -> DataFrame:
    out = blocks.build(daily_frame(t), "day", ["user_id"], gap_threshold=_GAP, method=method)
    return rounded(out, *SENSORS).withColumn("day_us", F.unix_micros("day")).drop("day")


@query("impute_linear", _fill_sql("linear"))
def impute_linear(t: Tables) -> DataFrame:
    return _built(t, "linear")


@query("impute_ffill", _fill_sql("ffill"))
def impute_ffill(t: Tables) -> DataFrame:
    return _built(t, "ffill")


@query("impute_bfill", _fill_sql("bfill"))
def impute_bfill(t: Tables) -> DataFrame:
    return _built(t, "bfill")


@query(
    "gap_blocks",
    f"""WITH {_flags_sql()}
SELECT user_id, block_id::BIGINT AS block_id, count(*) AS n_rows, epoch_us(min(day)) AS from_us,
  epoch_us(max(day)) AS to_us FROM good GROUP BY 1, 2""",
)
def gap_blocks(t: Tables) -> DataFrame:
    built = blocks.build(daily_frame(t), "day", ["user_id"], gap_threshold=_GAP)
    return built.groupBy("user_id", "block_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.unix_micros(F.min("day")).alias("from_us"),
        F.unix_micros(F.max("day")).alias("to_us"),
    )


@query(
    "time_segments",
    """SELECT user_id, segment_id::BIGINT AS segment_id, count(*) AS n, epoch_us(min(ts)) AS from_us FROM (
  SELECT *, sum(CASE WHEN d IS NULL OR d > 43200000000 OR d <= 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment_id FROM (
  SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events))
GROUP BY 1, 2""",
)
def time_segments(t: Tables) -> DataFrame:
    out = blocks.segment_on_time(t.events, "ts", ["user_id"], ["event_id"], max_gap_s=43_200.0)
    return out.groupBy("user_id", "segment_id").agg(
        F.count(F.lit(1)).alias("n"), F.unix_micros(F.min("ts").cast("timestamp")).alias("from_us")
    )


@query(
    "limit_values",
    "SELECT event_id, greatest(10.0, least(80.0, value))::DOUBLE AS value FROM events",
)
def limit_values(t: Tables) -> DataFrame:
    return blocks.limit_values(t.events.select("event_id", "value"), {"value": (10.0, 80.0)})


@query(
    "incident_slices",
    """WITH p AS (SELECT event_id, user_id, event_type = 'error' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
n AS (SELECT *, coalesce(lag(f) OVER w, FALSE) AS pf, max(CASE WHEN f THEN pos END) OVER w AS b,
  min(CASE WHEN f THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a
  FROM p WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
k AS (SELECT *, sum(CASE WHEN f AND NOT pf THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS k FROM n)
SELECT event_id, user_id, f AS in_episode, (CASE WHEN pos - b <= 2 AND (a IS NULL OR pos - b <= a - pos) THEN k
  WHEN a - pos <= 2 THEN k + 1 END)::BIGINT AS slice_id FROM k WHERE slice_id IS NOT NULL""",
)
def incident_slices(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    out = blocks.incident_slices(rows, "ts", F.col("event_type") == "error", 2, ["user_id"], ["event_id"])
    return out.drop("ts", "event_type")


@query(
    "asof_join",
    """SELECT e.event_id, p.value AS last_value, p.event_id AS last_event_id FROM (SELECT * FROM events WHERE event_type = 'error') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
def asof_join(t: Tables) -> DataFrame:
    """The last purchase at or before each error of the same user."""
    rows = t.events.select("event_id", "user_id", "ts", "value", "event_type")
    errors = rows.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = rows.filter("event_type = 'purchase'")
    out = as_of(errors, bought, ["user_id"], "ts", "ts", ["value", "event_id"], ties=["event_id"])
    return out.select("event_id", "last_value", "last_event_id")
