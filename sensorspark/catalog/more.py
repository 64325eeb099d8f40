"""Readers, sinks, guards and windows that the other modules do not query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.catalog.scoring import fault_rows
from sensorspark.catalog.vectors import SHOTS_SQL, encoded_windows, shot_split
from sensorspark.catalog.windowing import POS_SQL, _TAGGED
from sensorspark.functions.encoders import assert_same_convention
from sensorspark.operators import blocks, evaluate, features, neighbors, windows
from sensorspark.plans.asof import as_of
from sensorspark.plans.ranks import exact_quantile
from sensorspark.plans.series import plan_layout, scan
from sensorspark.session import fresh_path
from sensorspark.sources import readers, sinks


@query("null_key_positions", """SELECT event_id, nullif(user_id % 3, 0) AS k, row_number() OVER (PARTITION BY nullif(user_id % 3, 0) ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY nullif(user_id % 3, 0)) AS n, lag(event_id) OVER (PARTITION BY nullif(user_id % 3, 0) ORDER BY ts, event_id) AS prev FROM events""")
def null_key_positions(t: Tables) -> DataFrame:
    """A third of the rows has no series key; they are a series of their own."""
    rows = t.events.select("event_id", F.nullif(F.col("user_id") % 3, F.lit(0)).alias("k"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    lay = plan_layout(rows, ["k"], "us", ["event_id"])
    out = lay.detach(scan(rows, lay, pos="pos", size="n", lag={"prev": F.col("event_id")}))
    return out.select("event_id", "k", "pos", "n", "prev")


@query("null_key_quantile", """SELECT nullif(user_id % 3, 0) AS k, round(quantile_cont(value, 0.25), 6) AS q, count(value) AS n FROM events GROUP BY 1""")
def null_key_quantile(t: Tables) -> DataFrame:
    rows = t.events.select(F.nullif(F.col("user_id") % 3, F.lit(0)).alias("k"), "value")
    return rounded(exact_quantile(rows, ["k"], "value", 0.25, "q"), "q")


@query(
    "asof_timeless",
    """WITH l AS (SELECT event_id, user_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts FROM events WHERE event_type = 'error'),
r AS (SELECT user_id, ts, event_id AS hit FROM events WHERE event_type = 'purchase')
SELECT l.event_id, arg_max(r.hit, (r.ts, r.hit)) AS last_event_id FROM l LEFT JOIN r ON l.user_id = r.user_id AND r.ts <= l.ts GROUP BY 1""",
)
def asof_timeless(t: Tables) -> DataFrame:
    """Left rows without a time stay, with nothing matched."""
    kind = F.col("event_type")
    left = t.events.filter(kind == "error").select("event_id", "user_id", F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ts"))
    right = t.events.filter(kind == "purchase").select("user_id", "ts", "event_id")
    return as_of(left, right, ["user_id"], "ts", "ts", ["event_id"], ties=["event_id"]).select("event_id", "last_event_id")


@query(
    "sensor_headers_differ",
    """SELECT o_orderkey AS timestamp, o_totalprice AS price, o_custkey::DOUBLE AS customer,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderkey % 7 END::DOUBLE AS extra FROM orders""",
)
def sensor_headers_differ(t: Tables) -> DataFrame:
    """Two sets of files with their columns in another order, one with a column of its own."""
    path = fresh_path(t.spark, "headers")
    time, price, customer = F.col("o_orderkey").alias("timestamp"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer")
    done = F.col("o_orderstatus") == "F"
    t.orders.filter(done).select(time, price, customer).write.csv(path, header=True)
    more = (F.col("o_orderkey") % 7).alias("extra")
    t.orders.filter(~done).select(customer, time, more, price).write.mode("append").csv(path, header=True)
    return readers.read_sensors(t.spark, path).select("timestamp", "price", "customer", "extra")


@query("sensor_without_time", """SELECT l_quantity AS quantity, l_tax AS tax FROM lineitem""")
def sensor_without_time(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "no-time")
    t.lineitem.select(F.col("l_orderkey").alias("time"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax")).write.csv(path, header=True)
    return readers.read_sensors(t.spark, path, keep_time=False).select("quantity", "tax")


def turns_by_conversation(t: Tables) -> DataFrame:
    """Turns dealt to tasks by conversation: many small documents need many writers, however few bytes they are."""
    return t.conversations.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "conv_id")


@query(
    "manual_scan",
    """SELECT conv_id::VARCHAR AS id, turn::INT AS step, text AS instruction, turn * 2.0::DOUBLE AS timestamp_start FROM conversations""",
)
def manual_scan(t: Tables) -> DataFrame:
    """One document per conversation; every third is wrapped in an array."""
    path = fresh_path(t.spark, "manuals")
    step = F.struct(F.col("turn").alias("step"), F.col("text").alias("instruction"), (F.col("turn") * 2.0).alias("timestamp_start"))
    docs = turns_by_conversation(t).groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("results"))
    record = F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), "results"))
    body = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("["), record, F.lit("]"))).otherwise(record)
    docs.select("conv_id", body.alias("value")).write.partitionBy("conv_id").text(path)
    return readers.read_manuals(t.spark, path).select("id", "step", "instruction", "timestamp_start")


@query(
    "procedure_scan",
    """SELECT step_no, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS step_no,
  trim(replace(text, chr(10), ' ')) AS text FROM conversations) GROUP BY 1""",
)
def procedure_scan(t: Tables) -> DataFrame:
    """A comment and an empty line stand before the steps of each procedure."""
    path = fresh_path(t.spark, "procedures")
    line = F.struct("turn", F.trim(F.replace("text", F.lit("\n"), F.lit(" "))).alias("line"))
    docs = turns_by_conversation(t).groupBy("conv_id").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    body = F.concat(F.lit("# steps\n\n"), F.array_join(F.col("lines")["line"], "\n"))
    docs.select("conv_id", body.alias("value")).write.partitionBy("conv_id").text(path)
    steps = readers.read_procedures(t.spark, path)
    return steps.groupBy("step_no").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    "embedding_sink",
    """SELECT vec_id, label::VARCHAR AS predicted_label, 'false' AS invalid, list_transform(embedding, lambda x: round(x::DOUBLE, 6)) AS embedding_vibration FROM embeddings""",
)
def embedding_sink(t: Tables) -> DataFrame:
    """Vectors go along as one column per variate, in a format that holds arrays."""
    path = fresh_path(t.spark, "with-embeddings")
    rows = t.embeddings.select(
        "vec_id", F.col("label").cast("string").alias("predicted_label"), F.lit(False).alias("invalid"),
        F.create_map(F.lit("vibration"), F.col("embedding")).alias("vectors"),
    )
    table = sinks.prediction_table(rows, embeddings="vectors", variates=["vibration"])
    sinks.write_predictions(table, path, format="parquet")
    back = t.spark.read.parquet(path)
    return back.withColumn("embedding_vibration", F.transform("embedding_vibration", lambda x: F.round(x.cast("double"), 6)))


@query("fault_label", "SELECT DISTINCT CASE WHEN event_type = 'error' THEN 'fault' END AS fault_label FROM events WHERE event_type = 'error'")
def fault_label(t: Tables) -> DataFrame:
    rows = fault_rows(t)
    return rows.filter(F.col("label") == evaluate.infer_fault_label(rows)).select(F.col("label").alias("fault_label")).distinct()


@query(
    "window_at",
    f"""WITH {POS_SQL} SELECT user_id, list(value ORDER BY pos) AS samples FROM pos WHERE pos >= 2 AND pos < 10
AND user_id IN (SELECT user_id FROM pos GROUP BY 1 HAVING count(*) >= 10) GROUP BY 1""",
)
def window_at(t: Tables) -> DataFrame:
    """The window at one offset, of the series that are long enough."""
    long_enough = t.events.groupBy("user_id").count().filter("count >= 10").select("user_id")
    rows = t.events.join(long_enough, "user_id", "left_semi")
    out = windows.window_at(rows, "ts", ["value"], 2, 8, ["user_id"], ["event_id"])
    return out.select("user_id", F.col("values")["value"].alias("samples"))


@query(
    "window_repair",
    """WITH w AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS p,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS x FROM orders),
f AS (SELECT *, last_value(x IGNORE NULLS) OVER b AS bx, max(CASE WHEN x IS NOT NULL THEN p END) OVER b AS bp,
  first_value(x IGNORE NULLS) OVER a AS ax, min(CASE WHEN x IS NOT NULL THEN p END) OVER a AS ap FROM w
  WINDOW b AS (PARTITION BY o_custkey ORDER BY p ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY o_custkey ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT o_orderkey, round(coalesce(x, CASE WHEN ap - bp - 1 <= 2 THEN bx + (ax - bx) * (p - bp) / (ap - bp) END), 4) AS x FROM f""",
)
def window_repair(t: Tables) -> DataFrame:
    """The orders of a customer play one window; gaps of at most two samples are filled."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("x"))
    placed = windows.positions(rows, "o_orderkey", ["o_custkey"], pos="p")
    out = blocks.repair_windows(placed, ["o_custkey"], "p", ["x"], max_gap=2)
    return out.select("o_orderkey", F.round("x", 4).alias("x"))


@query(
    "sliding_bounds",
    f"""WITH {POS_SQL} SELECT user_id, pos - 31 AS window_id, epoch_us(lag(ts, 31) OVER (PARTITION BY user_id ORDER BY pos)) AS start_us,
  epoch_us(ts) AS finish_us FROM pos QUALIFY pos >= 31""",
)
def sliding_bounds(t: Tables) -> DataFrame:
    """A window at every row: nothing is copied for the 32 rows it covers."""
    return windows.window_bounds(t.events.select("event_id", "user_id", "ts"), "ts", 32, 1, ["user_id"], ["event_id"])


@query(
    "joint_state_checked",
    """SELECT vec_id // 2 AS read_index, arg_min(label, vec_id % 2) FILTER (WHERE label IS NOT NULL) AS label, min(vec_id) * 10 AS at,
  128 AS n_dims FROM embeddings WHERE vec_id // 2 IN (SELECT vec_id // 2 FROM embeddings GROUP BY 1 HAVING count(*) = 2 AND min(label) = max(label)) GROUP BY 1""",
)
def joint_state_checked(t: Tables) -> DataFrame:
    """Windows with both sensors and one label, checked, with the time of their first sensor."""
    rows = t.embeddings.select(
        F.expr("vec_id div 2").alias("read_index"), F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b").alias("sensor"),
        "embedding", "label", (F.col("vec_id") * 10).alias("at"),
    )
    whole = rows.groupBy("read_index").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    rows = rows.join(whole.filter("n = 2 and lo = hi").select("read_index"), "read_index", "left_semi")
    out = features.joint_state(rows, ["a", "b"], timestamp="at")
    return out.select("read_index", "label", "at", F.size("features").alias("n_dims"))


@query(
    "convention_guard",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=16)} SELECT DISTINCT 'moments' AS encoder_id, 16::BIGINT AS encoded_length FROM wins""",
)
def convention_guard(t: Tables) -> DataFrame:
    """Windows of one convention pass the guard; those of another length are refused."""
    rows, other = encoded_windows(t, 16), encoded_windows(t, 8)
    assert_same_convention(rows, rows)
    try:
        assert_same_convention(other, rows)
    except ValueError:
        return rows.select("encoder_id", "encoded_length").distinct()
    raise AssertionError("vectors of another length were let through")


@query(
    "knn_blocked",
    f"""WITH {SHOTS_SQL}, d AS (SELECT e.vec_id, l.vec_id AS neighbor_id, list_distance(e.v, l.v) AS distance FROM test e, lib l)
SELECT vec_id, neighbor_id, rank, round(distance, 6) AS distance FROM (SELECT *,
  row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d) WHERE rank <= 3""",
)
def knn_blocked(t: Tables) -> DataFrame:
    """The way beyond the broadcast limit."""
    library, test = shot_split(t)
    near = neighbors.knn(test, library, 3, query_id="vec_id", library_id="vec_id", broadcast_bytes=1)
    return rounded(near.select("vec_id", "neighbor_id", "rank", "distance"), "distance")
