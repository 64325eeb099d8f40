"""File and model queries: the given tables written in each format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.catalog.vectors import KNN_SQL, LOF_SQL, lof_parts, predictions
from sensorspark.functions import models
from sensorspark.operators import lof
from sensorspark.session import fresh_path
from sensorspark.sources import readers, sinks


@query(
    "sensor_csv_scan",
    "SELECT floor(epoch(ts))::BIGINT AS timestamp, event_id::DOUBLE AS event_id, value FROM events",
)
def sensor_csv_scan(t: Tables) -> DataFrame:
    """Text columns and the time axis are told from channels by name and first row."""
    path = fresh_path(t.spark, "sensors")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    t.events.select("event_id", seconds.alias("Time"), "event_type", "value").write.csv(path, header=True)
    return readers.read_sensors(t.spark, path).select("timestamp", "event_id", "value")


@query("label_scan", "SELECT o_orderkey AS timestamp, o_orderpriority AS label FROM orders WHERE o_orderstatus = 'F'")
def label_scan(t: Tables) -> DataFrame:
    """Only the labels of finished orders are needed."""
    path = fresh_path(t.spark, "labels")
    t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("LABEL")).write.csv(path, header=True)
    needed = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("timestamp"))
    return readers.read_labels(t.spark, path, needed=needed).select("timestamp", "label")


@query(
    "verdict_scan",
    """SELECT conv_id::VARCHAR AS id, turn::INT AS step, ['PASSED', 'FAILED', 'MISSING'][1 + length(text) % 3] AS status,
  CASE WHEN length(text) % 3 < 2 THEN turn * 5.0::DOUBLE END AS timestamp_start FROM conversations""",
)
def verdict_scan(t: Tables) -> DataFrame:
    """One record with one verdict per line; a MISSING step carries no time."""
    path = fresh_path(t.spark, "verdicts")
    kind = F.pmod(F.length("text"), F.lit(3))
    row = F.struct(
        F.col("turn").alias("step"),
        F.when(kind == 0, "PASSED").when(kind == 1, "FAILED").otherwise("MISSING").alias("status"),
        F.when(kind < 2, F.col("turn") * 5.0).alias("timestamp_start"),
    )
    record = F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), F.array(row).alias("results")))
    t.conversations.select(record.alias("value")).write.text(path)
    return readers.read_verdicts(t.spark, path).select("id", "step", "status", "timestamp_start")


@query(
    "interval_scan",
    """SELECT l_partkey::INT AS step, l_quantity AS "start", l_quantity + l_linenumber AS "end" FROM lineitem WHERE l_returnflag <> 'A'""",
)
def interval_scan(t: Tables) -> DataFrame:
    """Accepted lines get a fourth field, which makes them malformed."""
    path = fresh_path(t.spark, "intervals")
    end = F.col("l_quantity") + F.col("l_linenumber")
    extra = F.when(F.col("l_returnflag") == "A", "note")
    line = F.concat_ws(",", *[c.cast("string") for c in (F.col("l_partkey"), F.col("l_quantity"), end, extra)])
    t.lineitem.select(line.alias("value")).write.text(path)
    return readers.read_intervals(t.spark, path).select("step", "start", "end")


@query(
    "flow_scan",
    """SELECT epoch_us(l_shipdate) AS time_us, l_suppkey::VARCHAR AS mac_a, l_partkey::VARCHAR AS mac_b, l_returnflag AS prot,
  l_linenumber AS tran, l_quantity::BIGINT AS bytes_a FROM lineitem""",
)
def flow_scan(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "flows")
    none = F.lit(0)
    t.lineitem.select(
        F.col("l_shipdate").cast("timestamp").alias("time_utc"), F.col("l_suppkey").alias("mac_a"),
        F.col("l_partkey").alias("mac_b"), F.col("l_returnflag").alias("prot"), F.col("l_linenumber").alias("tran"),
        none.alias("port_a"), none.alias("port_b"), F.col("l_quantity").cast("long").alias("bytes_a"),
        none.alias("bytes_b"), none.alias("pkts_a"), none.alias("pkts_b"),
    ).write.csv(path, sep="|", header=True)
    flows = readers.read_flows(t.spark, path)
    return flows.select(F.unix_micros("time_utc").alias("time_us"), "mac_a", "mac_b", "prot", "tran", "bytes_a")


@query(
    "prediction_sink",
    f"""WITH {KNN_SQL}, s AS (SELECT vec_id, label, c / sum(c) OVER (PARTITION BY vec_id) AS p FROM votes)
SELECT vec_id::VARCHAR AS vec_id, {', '.join(f"round(coalesce(max(p) FILTER (WHERE label = {i}), 0), 6) AS p_{i}" for i in range(10))}
FROM s GROUP BY 1""",
)
def prediction_sink(t: Tables) -> DataFrame:
    """Predictions written with one probability column per class and read as records."""
    path = fresh_path(t.spark, "predictions")
    classes = [str(i) for i in range(10)]
    table = sinks.prediction_table(predictions(t).select("vec_id", "predicted", "probabilities"), classes)
    sinks.write_predictions(table, path)
    names = [f"p_{c}" for c in classes]
    return rounded(readers.read_records(t.spark, path).select("vec_id", *names), *names)


@query(
    "artifact_score",
    f"WITH {LOF_SQL} SELECT vec_id, round(s, 6) AS anomaly_score, CASE WHEN s > 1.05 THEN 'anomaly' ELSE 'normal' END AS predicted_label FROM sc",
)
def artifact_score(t: Tables) -> DataFrame:
    """The fitted detector is saved; scoring takes reference, neighbours and threshold from the copy."""
    path = fresh_path(t.spark, "detector")
    fitted, rest = lof_parts(t)
    sinks.save_artifact(fitted, {"k": 10, "threshold": 1.05}, path)
    reference, params = sinks.load_artifact(t.spark, path)
    scored = lof.score(rest, reference, id="vec_id", k=params["k"], threshold=params["threshold"])
    return rounded(scored, "anomaly_score")


@query(
    "model_calls",
    """SELECT conv_id, turn, CASE WHEN turn % 4 <> 3 THEN length(text)::VARCHAR END AS answer,
  CASE WHEN turn % 4 = 3 THEN 'ValueError: refused' END AS error, CASE WHEN turn % 4 = 3 THEN 2 ELSE 1 END::BIGINT AS attempts
FROM conversations""",
)
def model_calls(t: Tables) -> DataFrame:
    """A local stand-in for a model: it measures the text and refuses every fourth turn."""

    def make_client():
        def client(text: str) -> str:
            if text.startswith("!"):
                raise ValueError("refused")
            return str(len(text))

        return client

    prompt = F.when(F.col("turn") % 4 == 3, F.concat(F.lit("!"), F.col("text"))).otherwise(F.col("text"))
    requests = t.conversations.select("conv_id", "turn", prompt.alias("prompt"))
    return models.call_model(requests, "prompt", make_client, keys=["conv_id", "turn"], retries=2, backoff_s=0.0)


@query(
    "media_rules",
    """SELECT conv_id, turn, CASE WHEN turn * 4 > 1 AND turn % 2 = 0 AND turn % 3 <> 0 THEN 'several images need multi_image or frame metadata'
  WHEN turn % 2 = 1 AND turn * 4 > 16 THEN 'more than 16 images' WHEN length(text) % 80 > 64 THEN 'more than 64 frames'
  WHEN role = 'user' THEN 'attach tabular text as text/plain' END AS problem FROM conversations""",
)
def media_rules(t: Tables) -> DataFrame:
    requests = t.conversations.select(
        "conv_id", "turn", (F.col("turn") * 4).alias("n_images"), F.pmod(F.length("text"), F.lit(80)).alias("max_frames"),
        (F.col("turn") % 2 == 1).alias("multi_image"), (F.col("turn") % 3 == 0).alias("has_frame_metadata"),
        F.when(F.col("role") == "user", "log.csv").otherwise("log.txt").alias("attachment"),
    )
    return models.check_media(requests).select("conv_id", "turn", "problem")
