"""Window, incident, lead-time, step and verdict scoring on small known cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sensorspark.functions import text
from sensorspark.operators import evaluate, leadtime, runs, steps, verdicts


def test_binary(spark):
    df = spark.createDataFrame([("d", "d"), ("h", "d")], "t string, p string")
    r = evaluate.binary(df, "t", "p", "d").first()
    assert (r["recall"], r["precision"], r["tp"], r["fp"]) == (1.0, 0.5, 1, 1)


def test_macro_f1_only_over_classes_in_truth(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "t string, p string")
    r = evaluate.multiclass(df, "t", "p").first()
    assert r["accuracy"] == pytest.approx(2 / 3) and r["macro_f1"] == pytest.approx((2 / 3 + 1.0) / 2)


def red(spark, labels, preds, window):
    truth = spark.createDataFrame([(60 * i, lab) for i, lab in enumerate(labels)], "timestamp long, label string")
    spans = evaluate.truth_spans(truth, "timestamp", "label", "fault", window)
    out = spark.createDataFrame(preds, "finish long, predicted string, invalid string")
    joined = out.join(spans.drop("label"), out.finish == spans.timestamp, "left")
    joined = joined.withColumn("invalid", evaluate.invalid_flag(joined, "predicted"))
    found = evaluate.episodes(truth, "timestamp", F.col("label") == "fault")
    alarms = joined.filter("predicted = 'fault' and not invalid and pos is not null").withColumn("hi", F.col("pos") + 1)
    return evaluate.rare_event_metrics(joined, "fault").first(), evaluate.detect_incidents(found, alarms).collect()


def test_ties_go_to_the_rare_event(spark):
    m, _ = red(spark, ["fault", "fault", "normal", "normal"], [(180, "fault", "false")], 4)
    assert m["tp"] == 1


def test_high_accuracy_with_a_missed_incident(spark):
    labels = ["fault" if i in (20, 21) else "normal" for i in range(40)]
    m, incidents = red(spark, labels, [(60 * i, "normal", "false") for i in range(3, 40)], 4)
    assert m["fn"] == 3 and m["accuracy"] > 0.9
    assert [(e["row_from"], e["row_to"], e["detected"]) for e in incidents] == [(20, 22, False)]


def test_false_alarms_only_on_clean_windows(spark):
    labels = ["normal"] * 7 + ["fault"]
    m, incidents = red(spark, labels, [(180, "fault", "false"), (420, "fault", "false")], 4)
    assert (m["false_alarms"], m["clean_windows"]) == (1, 1)
    assert incidents[0]["detected"] and incidents[0]["latency"] == 0


def test_invalid_and_unmatched(spark):
    m, _ = red(spark, ["normal"] * 8, [(240, "INVALID_STATE", "false"), (300, "normal", "true"), (999, "normal", "false")], 4)
    assert (m["invalid"], m["unmatched"], m["tn"]) == (2, 1, 0)


def test_long_episode_and_many_windows(spark):
    found = spark.createDataFrame([(5, 5005)], "row_from long, row_to long")
    alarms = spark.range(0, 6000, 7).select(F.col("id").alias("lo"), (F.col("id") + 64).alias("hi"))
    got = evaluate.detect_incidents(found, alarms).first()
    want = [w for w in range(0, 6000, 7) if w < 5005 and 5 < w + 64]
    assert got["n_windows"] == len(want) and got["first_row"] == 63


def test_incidents_against_all_pairs(spark):
    """Windows of any length, nested and repeated, episodes that touch; a NULL key is a key."""
    r = random.Random(17)
    found, alarms = [], []
    for k in ("a", "b", None):
        edges = sorted(r.sample(range(0, 400), 40))
        found += [(k, edges[i], edges[i + 1]) for i in range(0, 40, 2)]
        for _ in range({"a": 60, "b": 5, None: 12}[k]):
            lo = r.randint(0, 420)
            alarms += [(k, lo, lo + r.choice([1, 3, 16, 200, 350]))] * r.choice([1, 1, 2])
    got = evaluate.detect_incidents(
        spark.createDataFrame(found, "k string, row_from long, row_to long"), spark.createDataFrame(alarms, "k string, lo long, hi long"), ["k"]
    ).collect()
    assert len(got) == len(found)
    late = 0
    for e in got:
        hits = [hi for k, lo, hi in alarms if k == e.k and lo < e.row_to and e.row_from < hi]
        first = min(hits) - 1 if hits else None
        late += bool(hits) and min(hits) > e.row_to
        assert (e.n_windows, e.first_row, e.detected) == (len(hits), first, bool(hits)), e
        assert e.latency == (None if first is None else max(0, first - e.row_from)) or not hits
    assert late > 3


def test_infer_fault_label(spark):
    def labels(*x):
        return spark.createDataFrame([(v,) for v in x], "label string")

    assert evaluate.infer_fault_label(labels("normal", "pump")) == "pump"
    assert evaluate.infer_fault_label(labels("normal")) is None
    with pytest.raises(ValueError):
        evaluate.infer_fault_label(labels("a", "b"))


@pytest.mark.parametrize("times,labels,window,want", [
    ([10, 15, 20, 25], ["d", "d", "r", "r"], 2, [15, 25]),
    ([10, 15, 200], ["d", "d", "d"], 2, [15]),
])
def test_steady_rows(spark, times, labels, window, want):
    df = spark.createDataFrame(list(zip(times, labels)), "t long, label string")
    got = evaluate.steady_rows(df, "t", "label", window).filter("steady").orderBy("t").collect()
    assert [r["t"] for r in got] == want


def lead(spark, scores, hours):
    out = spark.createDataFrame([(float(i), s, "false") for i, s in enumerate(scores)], "finish_timestamp double, anomaly_score double, invalid string")
    lab = spark.createDataFrame(
        [(i, float(i), float(h)) for i, h in enumerate(hours)],
        "snapshot_index int, window_end_timestamp double, operating_hours_to_end double",
    )
    return leadtime.score_runs(out, lab, 1.5).first()


def test_sustained_detection_and_lead(spark):
    r = lead(spark, [1.0, 1.0, 2.0, 2.0, 2.0, 1.0], [9, 8, 7, 6, 5, 4])
    assert (r["detected"], r["detected_at"], r["lead_hours"], r["crossings"]) == (True, 2, 7.0, 3)
    assert r["crossing_rate"] == 0.5 and r["median_score"] == 1.5
    r = lead(spark, [1.0, 2.0, 1.0, 2.0, 1.0, 1.0], [9, 8, 7, 6, 5, 4])
    assert not r["detected"] and r["lead_hours"] is None


def test_lead_by_the_end_of_windows(spark):
    lab = spark.createDataFrame(
        [(i // 2, float(i), float(20 - i)) for i in range(16)], "snapshot_index int, window_end_timestamp double, operating_hours_to_end double"
    )

    def run(high, lost=()):
        rows = [(float(i), 2.0 if i in high else 1.0, "false") for i in range(16) if i not in lost]
        out = spark.createDataFrame(rows, "finish_timestamp double, anomaly_score double, invalid string")
        r = leadtime.score_runs(out, lab, 1.5, by_time=True).first()
        return r["detected_at"], r["lead_hours"], r["snapshots"]

    assert run({6, 8, 10}) == (3, 14.0, 8)
    # Lost windows before the crossing do not move it; a snapshot that lost both breaks a streak.
    assert run({6, 8, 10}, lost={0, 1, 2, 3}) == (3, 14.0, 8)
    assert run({6, 8, 10, 12, 14}, lost={8, 9}) == (5, 10.0, 8)
    # A window that no label row knows belongs to no snapshot.
    extra = spark.createDataFrame([(0.5, 9.0, "false"), (2.5, 9.0, "false"), (4.5, 9.0, "false")], "finish_timestamp double, anomaly_score double, invalid string")
    r = leadtime.score_runs(extra, lab, 1.5, by_time=True).first()
    assert (r["crossings"], r["detected"]) == (3, False)


def manual(spark, rows):
    return spark.createDataFrame(rows, "step int, instruction string, timestamp_start double, timestamp_end double")


def test_manual_scoring(spark):
    reference = spark.createDataFrame([(1, 0.0, 10.0), (1, 2.0, 12.0), (2, 20.0, 30.0), (3, 90.0, 95.0)], "step int, start double, end double")
    doc = manual(spark, [(0, "Open it.", 0.0, 12.0), (1, "Never touch it.", 20.0, 30.0), (2, "Close it.", 25.0, 30.0), (3, "Close it.", 25.0, 30.0)])
    got = steps.score_manual(doc, reference).orderBy("step").collect()
    assert [r["iou"] for r in got] == pytest.approx([1.0, 0.5, 0.0])
    assert [r["position"] for r in got] == [0, 2, None]
    hits = {r["threshold"]: r["hits"] for r in steps.recall(steps.score_manual(doc, reference)).collect()}
    assert hits == {0.1: 2, 0.3: 2, 0.5: 2}


def test_document_checks(spark):
    doc = manual(spark, [(0, "a.", 0.0, 5.0), (1, "cut off", 5.0, 9.0)]).withColumns(
        {"doc": F.lit("d"), "frame_start": F.col("timestamp_start") * 30, "frame_end": F.col("timestamp_end") * 30}
    )
    r = steps.document_checks(doc, ["doc"], fps=30.0).first()
    assert r["numbered"] and r["tiles"] and r["truncated"] and r["frames_match"]


def test_merge_keeps_real_repetitions(spark):
    rows = [
        ("v", 0, 0.0, 0, "Click on the OK button.", 0.0, 10.0),
        ("v", 0, 0.0, 1, "Click on the OK button.", 10.0, 20.0),
        ("v", 0, 0.0, 2, "Turn the blue cap firmly.", 70.0, 90.0),
        ("v", 1, 75.0, 0, "Turn the blue cap very firmly.", 0.0, 15.0),
        ("v", 1, 75.0, 1, "Click on the OK button.", 15.0, 30.0),
    ]
    df = spark.createDataFrame(rows, "clip string, chunk int, chunk_start double, step int, instruction string, timestamp_start double, timestamp_end double")
    got = steps.merge_chunks(df, "clip").orderBy("step").collect()
    assert [(r["step"], r["start"]) for r in got] == [(0, 0.0), (1, 10.0), (2, 70.0), (3, 90.0)]


def test_labels_in_names(spark):
    names = ["2_pass_5_fail_7_pass_B", "1_PASS-1_fail", "clip"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.labels_in_name(F.col("n"))).collect()]
    assert got == [{2: True, 5: False, 7: True}, {1: False}, {}]


def verdict_frame(spark, rows):
    return spark.createDataFrame(rows, "clip string, step int, position int, status string, reason string, timestamp_start double, timestamp_end double")


def test_verdict_scoring(spark):
    expected = spark.createDataFrame([("c", 1, True), ("c", 2, True), ("c", 3, False)], "clip string, step_no int, expected boolean")
    rows = verdict_frame(spark, [("c", 0, 0, "PASSED", "ok", 0.0, 1.0), ("c", 1, 1, "passed", "ok", 1.0, 2.0), ("c", 2, 2, "MISSING", "no", None, None)])
    assert verdicts.summarise(verdicts.score(rows, expected, ["clip"]), ["clip"]).first()["correct"] == 3
    empty = verdicts.summarise(verdicts.score(rows.limit(0), expected, ["clip"]), ["clip"]).first()
    assert (empty["correct"], empty["unreported"], empty["one_sided"]) == (0, 3, False)


def test_verdict_collapse_prefers_the_informative_row(spark):
    rows = verdict_frame(spark, [("c", 0, 0, "PASSED", "seen", 1.0, 2.0), ("c", 0, 1, "FAILED", "...", None, None), ("c", 0, 2, "FAILED", "...", 1.0, 2.0)])
    assert verdicts.collapse(rows, ["clip"], order="position").first()["position"] == 0
    assert verdicts.collapse(rows, ["clip"], order="position", rule="last").first()["position"] == 2


def test_procedure_pairing(spark):
    videos = spark.createDataFrame([("cam-file-12-run",), ("other",)], "video string")
    stems = spark.createDataFrame([("file-1",), ("file-12",), ("zzz",)], "stem string")
    got = {r["video"]: r["procedure"] for r in verdicts.pair_procedures(videos, stems, video="video", stem="stem").collect()}
    assert got == {"cam-file-12-run": "file-12"}
    got = {r["video"]: r["procedure"] for r in verdicts.pair_procedures(videos, stems, video="video", stem="stem", default="d").collect()}
    assert got["other"] == "d"
    one = verdicts.pair_procedures(videos, stems.limit(1), video="video", stem="stem")
    assert one.count() == 2


def test_run_outcomes(spark):
    rows = [
        ("good", 1, "INFO", "pod.started", "Agent execution terminated successfully"),
        ("bad", 1, "INFO", "pod.terminated", "completed successfully"), ("bad", 0, "ERROR", "x", "boom"),
        ("exit", 1, "INFO", "x", "process ended, exit=1"), ("open", 1, "INFO", "x", "Agent terminated"),
    ]
    logs = spark.createDataFrame([(r, i, lv, e, m) for r, i, lv, e, m in rows], "run_id string, id int, level string, event_type string, message string")
    logs = logs.withColumn("created_at", F.timestamp_seconds("id"))
    got = {r["run_id"]: r["outcome"] for r in runs.outcome_by_message(logs).collect()}
    assert got == {"good": "completed", "bad": "failed", "exit": "failed", "open": "running"}
    got = {r["run_id"]: r["outcome"] for r in runs.outcome_by_event(logs).collect()}
    assert got == {"good": "running", "bad": "failed", "exit": "running", "open": "running"}


def test_response_shapes_and_fences(spark):
    cases = {
        '{"response": {"response": ["a", "b"]}}': "a", '{"response": {"response": "a"}}': "a", '{"response": ["a"]}': "a",
        '{"response": "a"}': "a", '{"text": "a"}': "a", '{"response": {"response": []}, "text": "t"}': "t", "[]": "", "no": "",
    }
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    assert [r[0] for r in df.select(text.response_text(F.col("p"))).collect()] == list(cases.values())
    fenced = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), (" {\"a\": 1} ",), ("Sure!",)], "p string")
    got = [tuple(r) for r in fenced.select(text.parse_model_json(F.col("p"), "a int").alias("x")).select("x.valid", "x.value.a").collect()]
    assert got == [(True, 1), (True, 1), (False, None)]
