"""Streaming queries: a file stream of the given tables, drained and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.catalog.scoring import LOGS_SQL, logs
from sensorspark.catalog.vectors import SHOTS_SQL, shot_split
from sensorspark.operators import neighbors
from sensorspark.streaming import live


class StreamTables:
    """The same tables as file streams."""

    def __init__(self, t: Tables):
        self.t = t

    def __getattr__(self, name: str) -> DataFrame:
        # A pattern serves a single file as well as a folder of files.
        path = f"{self.t.directory}/{name}.parquet*"
        return self.t.spark.readStream.schema(getattr(self.t, name).schema).parquet(path)


def timed_events(t: Tables) -> DataFrame:
    return StreamTables(t).events.withColumn("ts", F.col("ts").cast("timestamp"))


# Rows are final once the watermark, in whole milliseconds, has passed them.
MARK = "(SELECT (epoch_us(max(ts)) // 1000) * 1000 - 86400000000 FROM events)"


@query(
    "stream_snapshots",
    f"""SELECT user_id, s AS start_us, s + 43200000000 AS end_us, count(*) AS n_rows, round(avg(value), 6) AS mean,
  min(value) AS "min", max(value) AS "max"
FROM (SELECT *, (epoch_us(ts) // 43200000000) * 43200000000 AS s FROM events) GROUP BY 1, 2 HAVING s + 43200000000 <= {MARK}""",
)
def stream_snapshots(t: Tables) -> DataFrame:
    out = live.snapshots(timed_events(t), "ts", "value", "12 hours", ["user_id"], delay="1 day")
    return rounded(live.drain(out, "snapshots"), "mean")


@query(
    "stream_sessions",
    f"""WITH d AS (SELECT *, epoch_us(ts) AS t, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) >= 43200000000, TRUE) AS b FROM events),
s AS (SELECT *, sum(b::INT) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM d)
SELECT user_id, min(t) AS start_us, max(t) + 43200000000 AS end_us, count(*) AS n_rows FROM s GROUP BY user_id, g
HAVING max(t) + 43200000000 <= {MARK}""",
)
def stream_sessions(t: Tables) -> DataFrame:
    return live.drain(live.sessions(timed_events(t), "ts", "12 hours", ["user_id"], delay="1 day"), "sessions")


@query(
    "stream_count_windows",
    f"""WITH p AS (SELECT user_id, epoch_us(ts) AS t, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
  FROM events WHERE epoch_us(ts) < {MARK}),
w AS (SELECT user_id, pos, min(t) OVER f AS start_us, t AS finish_us, avg(value) OVER f AS m FROM p
  WINDOW f AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT user_id, ((pos - 7) // 4)::BIGINT AS window_id, start_us, finish_us, round(m, 6) AS mean FROM w
WHERE pos >= 7 AND (pos - 7) % 4 = 0""",
)
def stream_count_windows(t: Tables) -> DataFrame:
    out = live.count_windows(timed_events(t), "ts", "event_id", "value", "user_id", size=8, step=4, delay="1 day")
    return rounded(live.drain(out, "count-windows"), "mean")


@query(
    "stream_sustained_alarm",
    """WITH p AS (SELECT conv_id, turn AS i, length(text) > 150 AS over FROM conversations),
s AS (SELECT *, i - coalesce(max(CASE WHEN NOT over THEN i END) OVER (PARTITION BY conv_id ORDER BY i), -1) AS k FROM p)
SELECT conv_id, min(i) FILTER (WHERE k = 3) - 2 AS detected_at FROM s GROUP BY 1 HAVING min(i) FILTER (WHERE k = 3) IS NOT NULL""",
)
def stream_sustained_alarm(t: Tables) -> DataFrame:
    """The turns of a conversation play the snapshots of an asset; a long text is over the line."""
    flags = StreamTables(t).conversations.select("conv_id", "turn", (F.length("text") > 150).alias("over"))
    return live.drain(live.sustained_alarm(flags, "conv_id", "turn", "over"), "alarms")


@query(
    "stream_run_outcomes",
    f"""WITH {LOGS_SQL} SELECT run_id, CASE WHEN bool_or(level = 'ERROR') THEN 'failed'
  WHEN bool_or(level = 'WARN' AND message LIKE '%reasoning block%') THEN 'empty-reasoning-overflow' ELSE 'completed' END AS outcome
FROM logs GROUP BY 1 HAVING arg_max(event_type, (created_at, event_type)) IN ('job.completed', 'job.failed') AND epoch_us(max(created_at)) < {MARK}""",
)
def stream_run_outcomes(t: Tables) -> DataFrame:
    """A run ends if its newest row is terminal once the watermark has passed it."""
    rows = logs(StreamTables(t)).withColumn("created_at", F.col("created_at").cast("timestamp"))
    return live.drain(live.run_outcomes(rows, delay="1 day", timeout_s=None), "outcomes")


@query(
    "stream_run_timeouts",
    f"""WITH {LOGS_SQL}, r AS (SELECT run_id, bool_or(level = 'ERROR') AS bad, bool_or(level = 'WARN' AND message LIKE '%reasoning block%') AS spent,
  arg_max(event_type, (created_at, event_type)) IN ('job.completed', 'job.failed') AND epoch_us(max(created_at)) < {MARK} AS ended,
  epoch_us(min(created_at)) // 1000 + 86400000 <= {MARK} // 1000 AS expired FROM logs GROUP BY 1)
SELECT run_id, CASE WHEN NOT ended THEN 'timeout' WHEN bad THEN 'failed' WHEN spent THEN 'empty-reasoning-overflow' ELSE 'completed' END AS outcome
FROM r WHERE ended OR expired""",
)
def stream_run_timeouts(t: Tables) -> DataFrame:
    """A run that shows no end within a day is given up, so no run keeps state for ever."""
    rows = logs(StreamTables(t)).withColumn("created_at", F.col("created_at").cast("timestamp"))
    return live.drain(live.run_outcomes(rows, delay="1 day"), "timeouts")


STREAM_KNN_SQL = f"""WITH {SHOTS_SQL}, d AS (SELECT e.vec_id, l.vec_id AS neighbor_id, l.label, list_distance(e.v, l.v) AS distance FROM emb e, lib l)
SELECT vec_id, neighbor_id, label, rank, round(distance, 6) AS distance FROM (SELECT *,
  row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d) WHERE rank <= 3"""


@query("stream_knn", STREAM_KNN_SQL)
def stream_knn(t: Tables) -> DataFrame:
    """Arriving vectors scored against a static library."""
    library, _ = shot_split(t)
    arriving = StreamTables(t).embeddings.select("vec_id", F.col("embedding").alias("features"))
    near = neighbors.knn(arriving, library, 3, query_id="vec_id", library_id="vec_id", carry=["label"])
    return rounded(live.drain(near, "knn"), "distance")


@query("stream_knn_blocked", STREAM_KNN_SQL)
def stream_knn_blocked(t: Tables) -> DataFrame:
    """The same beyond the broadcast limit, batch by batch."""
    library, _ = shot_split(t)
    arriving = StreamTables(t).embeddings.select("vec_id", F.col("embedding").alias("features"))
    near = live.neighbors_by_batch(
        arriving, library, 3, "knn-blocked", query_id="vec_id", library_id="vec_id", carry=["label"], broadcast_bytes=1
    )
    return rounded(near, "distance").select("vec_id", "neighbor_id", "label", "rank", "distance")
