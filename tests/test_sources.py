"""Readers, sinks, artifacts and model calls."""

from __future__ import annotations

import json
import os
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sensorspark.catalog import more
from sensorspark.catalog.registry import QUERIES, Tables
from sensorspark.functions import models
from sensorspark.operators import flows, lof
from sensorspark.sources import readers, sinks


def put(folder, name, body):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(body)
    return path


def test_sensor_csv(spark, tmp_path):
    p = put(tmp_path, "a.csv", "x,Time,label,y\n1.5,10.9,on,2\n\n2.5,11.2,off,3\n")
    rows = readers.read_sensors(spark, p).orderBy("source_row").collect()
    assert [(r["timestamp"], r["x"], r["y"]) for r in rows] == [(10, 1.5, 2.0), (11, 2.5, 3.0)]
    assert "label" not in rows[0].asDict()
    assert readers.read_sensors(spark, p, channels=1, keep_time=False).columns == ["source", "source_row", "x"]


def test_sensor_csv_without_time_name_uses_the_first_column(spark, tmp_path):
    p = put(tmp_path, "a.csv", "stamp,x\n7,1\n8,2\n")
    rows = readers.read_sensors(spark, p).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["stamp"], r["x"]) for r in rows] == [(7, 7.0, 1.0), (8, 8.0, 2.0)]


def test_sensor_csv_without_rows(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_sensors(spark, put(tmp_path, "a.csv", "time,x\n"))


def test_source_order_survives_splitting(spark, tmp_path):
    put(tmp_path, "a.csv", "time,x\n" + "".join(f"{i % 7},{i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_sensors(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert [r["x"] for r in df.orderBy("source_row").collect()] == [float(i) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_labels(spark, tmp_path):
    p = put(tmp_path, "a_labels.csv", "timestamp,other,Label\n1.0,u, a \n2,u,b\n2,u,c\n3\n")
    got = {r["timestamp"]: r["label"] for r in readers.read_labels(spark, p).collect()}
    assert got == {1: "a", 2: "c"}
    needed = spark.createDataFrame([(1,)], "timestamp long")
    assert readers.read_labels(spark, p, label_column="none", needed=needed).count() == 1


def test_sidecars(spark, tmp_path):
    put(tmp_path, "a.csv", "time,x\n1,5\n")
    put(tmp_path, "b.csv", "time,x\n1,6\n")
    sensors, labels = readers.with_sidecars(spark, str(tmp_path))
    assert labels is None and sensors.count() == 2
    put(tmp_path, "a_labels.csv", "timestamp,label\n1,on\n")
    sensors, labels = readers.with_sidecars(spark, str(tmp_path))
    got = sensors.join(labels, ["source", "timestamp"], "left").orderBy("x").collect()
    assert [r["label"] for r in got] == ["on", None]


def test_step_documents(spark, tmp_path):
    doc = {"id": "v", "results": [{"step": 0, "instruction": "Go.", "timestamp_start": 0.0, "timestamp_end": 2.5}]}
    put(tmp_path, "a.json", json.dumps(doc, indent=1))
    put(tmp_path, "b.json", json.dumps([doc, {"id": "w", "results": []}]))
    put(tmp_path, "c.json", json.dumps(doc) + "\n" + json.dumps({"id": "w", "results": []}))
    put(tmp_path, "d.json", "\n")
    put(tmp_path, "e.json", json.dumps({"id": "x", "results": []}))
    rows = readers.read_manuals(spark, str(tmp_path)).collect()
    got = {os.path.basename(r["source"]): (r["id"], r["step"], r["timestamp_end"]) for r in rows}
    assert len(rows) == 5 and all(got[f"{n}.json"] == ("v", 0, 2.5) for n in "abc")
    assert got["d.json"] == (None, None, None) and got["e.json"] == ("x", None, None)


def test_verdicts_intervals_procedures_flows(spark, tmp_path):
    lines = [{"id": "v", "results": [{"step": 0, "status": "PASSED"}, {"step": 1, "status": "MISSING"}]}, {"id": "w", "results": []}]
    rows = readers.read_verdicts(spark, put(tmp_path, "v.jsonl", "\n".join(map(json.dumps, lines)))).orderBy("source_row", "position").collect()
    assert [(r["id"], r["position"], r["status"]) for r in rows] == [("v", 0, "PASSED"), ("v", 1, "MISSING"), ("w", None, None)]

    rows = readers.read_intervals(spark, put(tmp_path, "r.csv", "1,0.5,2\n1,3\n2,1,2,9\n3,4,5\n")).collect()
    assert [(r["step"], r["start"], r["end"]) for r in rows] == [(1, 0.5, 2.0), (3, 4.0, 5.0)]

    rows = readers.read_procedures(spark, put(tmp_path, "p.txt", "# head\n\n first \nsecond\n  # not\n")).collect()
    assert [(r["step_no"], r["text"]) for r in rows] == [(1, "first"), (2, "second")]
    with pytest.raises(Exception, match="no step lines"):
        readers.read_procedures(spark, put(tmp_path, "q.txt", "# only\n")).collect()

    flow = "time_utc|mac_a|mac_b|prot|tran|port_a|port_b|bytes_a|bytes_b|pkts_a|pkts_b\n2020-01-01 00:00:00|aa|bb|SSH|6|22|5|100|20|3|1\n"
    assert readers.read_flows(spark, put(tmp_path, "f.txt", flow)).first()["bytes_a"] == 100


def test_prediction_sink(spark, tmp_path):
    df = spark.createDataFrame(
        [("one", 5, False, {"b": 0.25, "a": 0.75}, {"x": [1.0, 2.0]})],
        "source string, finish_us long, invalid boolean, probabilities map<string,double>, embeddings map<string,array<float>>",
    )
    plain = sinks.prediction_table(df, ["b", "a"], embeddings=None).drop("embeddings")
    assert plain.columns == ["source", "finish_us", "invalid", "p_a", "p_b"]
    path = str(tmp_path / "out")
    sinks.write_predictions(plain, path, source="source")
    back = spark.read.csv(path, header=True).first()
    assert (back["invalid"], back["p_a"], back["source"]) == ("false", "0.75", "one")
    wide = sinks.prediction_table(df, ["a", "b"], embeddings="embeddings", variates=["x"])
    with pytest.raises(ValueError):
        sinks.write_predictions(wide, str(tmp_path / "no"))
    sinks.write_predictions(wide, str(tmp_path / "yes"), format="parquet")
    assert spark.read.parquet(str(tmp_path / "yes")).first()["embedding_x"] == [1.0, 2.0]


def test_artifact_round_trip(spark, tmp_path):
    ref = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(30)], "id long, features array<double>")
    fitted = lof.fit(ref, id="id", k=3)
    path = str(tmp_path / "detector")
    sinks.save_artifact(fitted, {"k": 3, "threshold": 1.5, "window_size": 64}, path)
    reference, params = sinks.load_artifact(spark, path)
    assert params == {"k": 3, "threshold": 1.5, "window_size": 64}
    a = lof.score(ref, fitted, id="id", k=3).orderBy("id").collect()
    b = lof.score(ref, reference, id="id", k=params["k"]).orderBy("id").collect()
    assert a == b


def test_model_calls_retry_and_report(spark):
    def make_client():
        seen = {}

        def client(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "bad" or (text == "flaky" and seen[text] < 3):
                raise RuntimeError("busy")
            return text.upper()

        return client

    df = spark.createDataFrame([(1, "ok"), (2, "flaky"), (3, "bad")], "id long, p string")
    seen = Observation()
    out = models.observe_progress(models.call_model(df, "p", make_client, keys=["id"], backoff_s=0.0, parallel_calls=2), seen)
    got = {r["id"]: (r["answer"], r["attempts"]) for r in out.collect()}
    assert got == {1: ("OK", 1), 2: ("FLAKY", 3), 3: (None, 4)}
    assert seen.get == {"done": 3, "failed": 1}


def test_media_rules(spark):
    rows = [(2, 0, False, False, "a.png"), (2, 0, True, False, "a.png"), (17, 0, True, False, "a.png"), (2, 0, False, True, "a.png"),
            (1, 65, False, False, "a.mp4"), (1, 0, False, False, "log.CSV"), (1, 64, False, False, "log.txt")]
    df = spark.createDataFrame(rows, "n_images int, max_frames int, multi_image boolean, has_frame_metadata boolean, attachment string")
    got = [r["problem"] is None for r in models.check_media(df).collect()]
    assert got == [False, True, False, True, False, False, True]


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,temp,vib\n1,10,0.5\n2,11,0.6\n")
    (tmp_path / "b.csv").write_text('vib,time,"note, long",temp\n0.7,3,"x, y",12\n')
    out = readers.read_sensors(spark, str(tmp_path))
    assert out.columns[2:] == ["timestamp", "temp", "vib"] or set(out.columns[3:]) == {"temp", "vib"}
    assert sorted((r.timestamp, r.temp, r.vib) for r in out.collect()) == [(1, 10.0, 0.5), (2, 11.0, 0.6), (3, 12.0, 0.7)]


def test_small_documents_have_many_writers_and_few_listing_tasks(spark, tmp_path):
    rows = [(c, i, "user", f"say {c} {i}") for c in range(60) for i in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.id, r.step, r.instruction, r.timestamp_start) for r in QUERIES["manual_scan"](spark, str(tmp_path)).collect()}
    assert got == {(str(c), i, text, i * 2.0) for c, i, _, text in rows}
    assert [(r.step_no, r.n) for r in QUERIES["procedure_scan"](spark, str(tmp_path)).orderBy("step_no").collect()] == [(1, 60), (2, 60), (3, 60)]
    # Adaptive execution puts few bytes into one task, which would write all the files.
    docs = more.turns_by_conversation(Tables(spark, str(tmp_path))).groupBy("conv_id").agg(F.count("turn").alias("n"))
    tasks = docs.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 200


def test_flow_profile_moves_sums_with_protocols_only(spark, capsys):
    schema = "time_utc timestamp, mac_a string, mac_b string, prot string, bytes_a long, bytes_b long"
    at = "2024-01-01 0{}:10:00"
    rows = [(0, "a", "b", "x", 1, 2), (0, "a", "b", "y", 3, 4), (1, "a", None, "x", 5, 6), (None, "a", "c", None, 7, 8)]
    df = spark.createDataFrame([(None if h is None else at.format(h), *r) for h, *r in rows], schema.replace("timestamp", "string"))
    out = flows.profile(df)
    got = {r.device: tuple(r)[1:] for r in out.collect()}
    assert got["a"] == (4, 16, 20, 9.0, 3, 3, "x,y") and got["b"] == (2, 6, 4, 5.0, 1, 1, "x,y")
    assert got["c"] == (1, 8, 7, 15.0, 1, 1, "") and got[None] == (1, 6, 5, 11.0, 1, 1, "x")
    out.explain("extended")
    assert not re.search(r"sum\(up#\d+L?\) AS up#", capsys.readouterr().out)
