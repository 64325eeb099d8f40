"""Scoring, lead-time, audit and run-outcome queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import FRAME_SQL, SENSORS, daily_frame, rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.catalog.windowing import POS_SQL
from sensorspark.operators import audit, evaluate, flows, leadtime, runs, windows

W = 4

BASE_SQL = f"""{POS_SQL}, pr AS (SELECT event_id, user_id, ts, pos, n, value, event_type,
  CASE WHEN event_type = 'error' THEN 'fault' ELSE 'normal' END AS label,
  CASE WHEN value > 40 THEN 'fault' ELSE 'normal' END AS predicted,
  CAST(regexp_extract(props, '[0-9]+') AS INT) < 5 AS invalid FROM pos),
sp AS (SELECT *, greatest(0, pos - {W - 1}) AS lo, pos - greatest(0, pos - {W - 1}) + 1 AS n_rows,
  sum(CASE WHEN label = 'fault' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos
    ROWS BETWEEN {W - 1} PRECEDING AND CURRENT ROW)::BIGINT AS n_fault FROM pr)"""

RED_SQL = """SELECT {by} count(*) FILTER (WHERE invalid) AS invalid, 0::BIGINT AS unmatched, tp, fp, fn, tn, clean AS clean_windows,
  fa AS false_alarms, 0::BIGINT AS other_predicted FROM x"""


def fault_rows(t: Tables) -> DataFrame:
    """Errors play the rare event; a high value is a predicted fault; a low key marks invalid windows."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        "event_id",
        "user_id",
        "ts",
        "value",
        "event_type",
        F.when(F.col("event_type") == "error", "fault").otherwise("normal").alias("label"),
        F.when(F.col("value") > 40, "fault").otherwise("normal").alias("predicted"),
        F.when(k < 5, "true").otherwise("false").alias("invalid"),
    )


def spans(t: Tables, window: int = W) -> DataFrame:
    return evaluate.truth_spans(fault_rows(t), "ts", "label", "fault", window, ["user_id"], ["event_id"])


@query("truth_spans", f"WITH {BASE_SQL} SELECT event_id, pos, lo, n_rows, n_fault FROM sp")
def truth_spans(t: Tables) -> DataFrame:
    return spans(t).select("event_id", "pos", "lo", "n_rows", "n_fault")


def _red_sql(by: str, window: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""SELECT {g}{window}i AS invalid, 0::BIGINT AS unmatched, tp, fp, fn, tn, clean_windows, false_alarms,
  0::BIGINT AS other_predicted, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(tn / nullif(tn + fn, 0), 0), 6) AS normal_precision,
  round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS normal_recall,
  round(false_alarms / nullif(clean_windows, 0), 6) AS false_alarm_rate,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  round(coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), 6) AS normal_f1,
  round((coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2, 6) AS macro_f1
FROM (SELECT {g}count(*) FILTER (WHERE invalid) AS i,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 >= n_rows AND predicted = 'fault') AS tp,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 < n_rows AND predicted = 'fault') AS fp,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 >= n_rows AND predicted <> 'fault') AS fn,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 < n_rows AND predicted <> 'fault') AS tn,
  count(*) FILTER (WHERE NOT invalid AND n_fault = 0) AS clean_windows,
  count(*) FILTER (WHERE NOT invalid AND n_fault = 0 AND predicted = 'fault') AS false_alarms
  FROM sp {f'GROUP BY {by}' if by else ''})"""


_RED_RATES = (
    "accuracy precision recall normal_precision normal_recall false_alarm_rate f1 normal_f1 macro_f1"
).split()


def _flagged(df: DataFrame) -> DataFrame:
    return df.withColumn("invalid", evaluate.invalid_flag(df, "predicted"))


@query("rare_event_metrics", f"WITH {BASE_SQL} {_red_sql('user_id')}")
def rare_event_metrics(t: Tables) -> DataFrame:
    out = evaluate.rare_event_metrics(_flagged(spans(t)), "fault", by=["user_id"])
    return rounded(out, *_RED_RATES)


@query(
    "rare_event_join",
    f"""WITH {BASE_SQL}, u AS (SELECT user_id, epoch_us(ts) + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS finish_us,
  CASE WHEN event_id % 11 = 0 THEN 'odd' ELSE predicted END AS predicted, invalid FROM pr),
t AS (SELECT user_id, epoch_us(ts) AS at_us, arg_max(n_rows, pos) AS n_rows, arg_max(n_fault, pos) AS n_fault FROM sp GROUP BY 1, 2),
j AS (SELECT u.*, n_rows, n_fault FROM u LEFT JOIN t ON u.user_id = t.user_id AND u.finish_us = t.at_us)
SELECT user_id, count(*) FILTER (WHERE invalid) AS invalid, count(*) FILTER (WHERE NOT invalid AND n_rows IS NULL) AS unmatched,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 >= n_rows AND predicted = 'fault') AS tp,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 < n_rows AND predicted = 'fault') AS fp,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 >= n_rows AND predicted <> 'fault') AS fn,
  count(*) FILTER (WHERE NOT invalid AND n_fault * 2 < n_rows AND predicted <> 'fault') AS tn,
  count(*) FILTER (WHERE NOT invalid AND n_rows IS NOT NULL AND predicted = 'odd') AS other_predicted FROM j GROUP BY 1""",
)
def rare_event_join(t: Tables) -> DataFrame:
    """Predictions joined to the spans by their finish; some finish between rows, some name another state."""
    rows = fault_rows(t)
    late = F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    said = rows.select(
        "user_id", (F.unix_micros(F.col("ts").cast("timestamp")) + late).alias("finish_us"),
        F.when(F.col("event_id") % 11 == 0, "odd").otherwise(F.col("predicted")).alias("predicted"), "invalid",
    )
    joined = evaluate.match_spans(said, spans(t), ["user_id"], "finish_us")
    out = evaluate.rare_event_metrics(_flagged(joined), "fault", by=["user_id"])
    return out.select("user_id", "invalid", "unmatched", "tp", "fp", "fn", "tn", "other_predicted")


def _sweep_sql() -> str:
    parts = []
    for w in (2, 4, 8):
        base = BASE_SQL.replace(f"pos - {W - 1}", f"pos - {w - 1}").replace(f"{W - 1} PRECEDING", f"{w - 1} PRECEDING")
        parts.append(f"SELECT {w}::BIGINT AS window_size, * FROM (WITH {base} {_red_sql('')})")
    return " UNION ALL ".join(parts)


@query("window_size_sweep", _sweep_sql())
def window_size_sweep(t: Tables) -> DataFrame:
    """The whole evaluation once per window length, as one job; all lengths share the positions."""
    placed = evaluate.prepare_truth(fault_rows(t), "ts", ["user_id"], ["event_id"])
    out = None
    for w in (2, 4, 8):
        counted = evaluate.truth_spans(placed, "ts", "label", "fault", w, ["user_id"], ["event_id"])
        one = evaluate.rare_event_metrics(_flagged(counted), "fault").withColumn("window_size", F.lit(w).cast("long"))
        out = one if out is None else out.unionByName(one)
    return evaluate.comparison(rounded(out, *_RED_RATES))


EPISODES_SQL = f"""{BASE_SQL}, st AS (SELECT *, label = 'fault' AS f,
  coalesce(lag(label = 'fault') OVER (PARTITION BY user_id ORDER BY pos), FALSE) AS pf FROM pr),
ep AS (SELECT user_id, g, min(pos) AS row_from, max(pos) + 1 AS row_to, min(epoch_us(ts)) AS onset_us FROM (
  SELECT *, sum(CASE WHEN f AND NOT pf THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos) AS g FROM st)
  WHERE f GROUP BY 1, 2)"""


@query("episodes", f"WITH {EPISODES_SQL} SELECT user_id, row_from, row_to, onset_us FROM ep")
def episodes(t: Tables) -> DataFrame:
    return evaluate.episodes(fault_rows(t), "ts", F.col("label") == "fault", ["user_id"], ["event_id"])


@query(
    "incident_detection",
    f"""WITH {EPISODES_SQL} SELECT ep.user_id, row_from, row_to, onset_us, count(sp.pos) AS n_windows,
  min(sp.pos) AS first_row, count(sp.pos) > 0 AS detected, greatest(0, min(sp.pos) - row_from) AS latency
FROM ep LEFT JOIN sp ON ep.user_id = sp.user_id AND NOT sp.invalid AND sp.predicted = 'fault'
  AND sp.lo < row_to AND row_from < sp.pos + 1 GROUP BY 1, 2, 3, 4""",
)
def incident_detection(t: Tables) -> DataFrame:
    alarms = spans(t).filter("predicted = 'fault' and invalid = 'false'").withColumn("hi", F.col("pos") + 1)
    return evaluate.detect_incidents(episodes(t), alarms, ["user_id"])


STATE_SQL = f"""{POS_SQL}, st AS (SELECT *, CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INT) < 5 THEN 'INVALID_STATE'
    WHEN value < 20 THEN 'view' WHEN value < 60 THEN 'click' ELSE 'error' END AS predicted FROM pos),
br AS (SELECT *, coalesce(event_type <> lag(event_type) OVER w, FALSE) OR coalesce(
    (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 NOT BETWEEN 1 AND 86400, FALSE) AS b FROM st
  WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
sd AS (SELECT *, pos >= 1 AND NOT b AS steady, predicted <> 'INVALID_STATE' AS ok FROM br)"""


@query(
    "steady_state_accuracy",
    f"""WITH {STATE_SQL} SELECT user_id, count(*) FILTER (WHERE ok) AS n, count(*) FILTER (WHERE NOT ok) AS skipped,
  count(*) FILTER (WHERE ok AND predicted = event_type) AS correct,
  round(coalesce(count(*) FILTER (WHERE ok AND predicted = event_type) / nullif(count(*) FILTER (WHERE ok), 0), 0), 6) AS accuracy,
  count(*) FILTER (WHERE ok AND steady) AS n_steady,
  round(coalesce(count(*) FILTER (WHERE ok AND steady AND predicted = event_type) /
    nullif(count(*) FILTER (WHERE ok AND steady), 0), 0), 6) AS steady_accuracy FROM sd GROUP BY 1""",
)
def steady_state_accuracy(t: Tables) -> DataFrame:
    joined = state_windows(t)
    return rounded(evaluate.score_states(joined, "steady", ["user_id"]), "accuracy", "steady_accuracy")


def state_windows(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    predicted = (
        F.when(k < 5, "INVALID_STATE").when(F.col("value") < 20, "view").when(F.col("value") < 60, "click").otherwise("error")
    )
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    steady = evaluate.steady_rows(
        rows, "ts", "event_type", 2, ["user_id"], ["event_id"], max_step_s=86_400.0
    ).select("user_id", us.alias("finish_us"), predicted.alias("predicted"), "steady")
    truth = rows.select("user_id", us.alias("at_us"), F.col("event_type").alias("label"))
    return evaluate.end_row_truth(steady, truth, keys=["user_id"])


@query(
    "multiclass_metrics",
    f"""WITH {STATE_SQL}, c AS (SELECT event_type AS t, predicted AS p, count(*) AS c FROM sd WHERE ok GROUP BY ALL),
l AS (SELECT t AS label FROM c UNION SELECT p FROM c),
m AS (SELECT label, coalesce(sum(c) FILTER (WHERE t = label AND p = label), 0)::BIGINT AS tp,
  coalesce(sum(c) FILTER (WHERE t = label AND p <> label), 0)::BIGINT AS fn,
  coalesce(sum(c) FILTER (WHERE t <> label AND p = label), 0)::BIGINT AS fp FROM l, c GROUP BY 1)
SELECT label, tp, fn, fp, tp + fn AS support, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM m""",
)
def multiclass_metrics(t: Tables) -> DataFrame:
    usable = state_windows(t).filter("not invalid and matched")
    return rounded(evaluate.per_class(usable, "truth", "predicted"), "precision", "recall", "f1")


@query(
    "binary_metrics",
    """SELECT event_type, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (SELECT event_type,
  count(*) FILTER (WHERE user_id % 2 = 1 AND value > 40) AS tp, count(*) FILTER (WHERE user_id % 2 <> 1 AND value > 40) AS fp,
  count(*) FILTER (WHERE user_id % 2 = 1 AND value <= 40) AS fn, count(*) FILTER (WHERE user_id % 2 <> 1 AND value <= 40) AS tn
  FROM events GROUP BY 1)""",
)
def binary_metrics(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_type", (F.col("user_id") % 2 == 1).alias("truth"), (F.col("value") > 40).alias("predicted")
    )
    out = evaluate.binary(rows, "truth", "predicted", True, ["event_type"])
    return rounded(out, "accuracy", "precision", "recall", "f1")


@query(
    "sustained_crossing",
    f"""WITH {POS_SQL}, o AS (SELECT *, max(CASE WHEN value <= 30 THEN pos END) OVER (PARTITION BY user_id ORDER BY pos) AS miss FROM pos)
SELECT user_id, min(pos) - 2 AS detected_at FROM o WHERE pos - coalesce(miss, -1) = 3 GROUP BY 1""",
)
def sustained_crossing(t: Tables) -> DataFrame:
    placed = windows.positions(t.events.select("user_id", "ts", "event_id", "value"), "ts", ["user_id"], ["event_id"])
    flags = placed.select("user_id", "pos", (F.col("value") > 30).alias("over"))
    return leadtime.first_sustained(flags, "pos", "over", ["user_id"])


LEAD_SQL = f"""{POS_SQL}, w AS (SELECT user_id, pos, value / 40 AS s, CAST(regexp_extract(props, '[0-9]+') AS INT) < 5 AS invalid,
  pos // 2 AS snap, (max(epoch_us(ts)) OVER (PARTITION BY user_id) - epoch_us(ts)) / 3.6e9 AS h, ts FROM pos),
lb AS (SELECT user_id, greatest(1, floor(count(*) / count(DISTINCT snap)))::BIGINT AS wps FROM w GROUP BY 1),
ov AS (SELECT user_id, pos // wps AS k, bool_or(s > 1.0) AS over FROM w JOIN lb USING (user_id) GROUP BY 1, 2),
sk AS (SELECT *, k - coalesce(max(CASE WHEN NOT over THEN k END) OVER (PARTITION BY user_id ORDER BY k), -1) AS streak FROM ov),
det AS (SELECT user_id, min(k) - 2 AS detected_at FROM sk WHERE streak = 3 GROUP BY 1),
lead AS (SELECT det.user_id, detected_at, arg_min(h, ts) AS lead_hours FROM det LEFT JOIN w ON w.user_id = det.user_id AND snap = detected_at GROUP BY 1, 2),
runs AS (SELECT w.user_id, count(*) AS windows, count(*) FILTER (WHERE invalid) AS invalid, max(s) AS max_score,
  count(*) FILTER (WHERE s > 1.0) AS crossings, count(*) FILTER (WHERE s > 1.0) / count(s) AS crossing_rate,
  quantile_cont(s, 0.5) AS median_score FROM w GROUP BY 1)"""


def scored_windows(t: Tables) -> DataFrame:
    """Values play anomaly scores; two windows make a snapshot and the record ends at the last event."""
    rows = t.events.select("event_id", "user_id", "ts", "value", "props")
    placed = windows.positions(rows, "ts", ["user_id"], ["event_id"])
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    last = rows.groupBy("user_id").agg(F.max(us).alias("__end"))
    k = F.get_json_object("props", "$.k").cast("int")
    return placed.join(last, "user_id").select(
        "user_id",
        "event_id",
        F.col("ts").alias("finish_timestamp"),
        (F.col("value") / 40).alias("anomaly_score"),
        F.when(k < 5, "true").otherwise("false").alias("invalid"),
        F.floor(F.col("pos") / 2).alias("snapshot_index"),
        F.col("ts").alias("window_end_timestamp"),
        ((F.col("__end") - us) / 3.6e9).alias("operating_hours_to_end"),
        (F.col("user_id") % 4 == 0).cast("string").alias("failed"),
        (F.col("pos") < 10).cast("string").alias("in_reference"),
    )


def lead_runs(t: Tables) -> DataFrame:
    scored = scored_windows(t)
    return leadtime.score_runs(scored, scored, 1.0, keys=["user_id"], ties=["event_id"])


@query(
    "lead_time",
    f"""WITH {LEAD_SQL} SELECT user_id, windows, invalid, round(max_score, 6) AS max_score, crossings,
  round(crossing_rate, 6) AS crossing_rate, round(median_score, 6) AS median_score,
  (SELECT count(*) FROM ov WHERE ov.user_id = runs.user_id) AS snapshots, detected_at,
  round(lead_hours, 6) AS lead_hours, detected_at IS NOT NULL AS detected
FROM runs LEFT JOIN lead USING (user_id)""",
)
def lead_time(t: Tables) -> DataFrame:
    return rounded(lead_runs(t), "max_score", "crossing_rate", "median_score", "lead_hours")


@query(
    "lead_time_by_end",
    f"""WITH {POS_SQL}, w AS (SELECT user_id, event_id, value / 40 AS s, epoch_us(ts) AS us, pos // 2 AS snap,
  (max(epoch_us(ts)) OVER (PARTITION BY user_id) - epoch_us(ts)) / 3.6e9 AS h FROM pos),
lb AS (SELECT user_id, us, min(snap) AS k FROM w GROUP BY 1, 2),
seen AS (SELECT user_id, k, bool_or(s > 1.0) AS over FROM lb JOIN (SELECT * FROM w WHERE event_id % 5 <> 0) USING (user_id, us) GROUP BY 1, 2),
ev AS (SELECT user_id, unnest(range(min(k), max(k) + 1)) AS k FROM lb GROUP BY 1),
ov AS (SELECT user_id, k, coalesce(over, FALSE) AS over FROM ev LEFT JOIN seen USING (user_id, k)),
sk AS (SELECT *, k - coalesce(max(CASE WHEN NOT over THEN k END) OVER (PARTITION BY user_id ORDER BY k), -1) AS streak FROM ov),
det AS (SELECT user_id, min(k) - 2 AS detected_at FROM sk WHERE streak = 3 GROUP BY 1)
SELECT r.user_id, count(*) AS windows, (SELECT count(*) FROM ov WHERE ov.user_id = r.user_id) AS snapshots, det.detected_at,
  round((SELECT arg_min(h, us) FROM w l WHERE l.user_id = r.user_id AND l.snap = det.detected_at), 6) AS lead_hours
FROM (SELECT * FROM w WHERE event_id % 5 <> 0) r LEFT JOIN det USING (user_id) GROUP BY r.user_id, det.detected_at""",
)
def lead_time_by_end(t: Tables) -> DataFrame:
    """A fifth of the windows has no score; the others keep their snapshots, which they find by their end."""
    labels = scored_windows(t)
    out = leadtime.score_runs(labels.filter("event_id % 5 <> 0"), labels, 1.0, keys=["user_id"], by_time=True)
    return rounded(out.select("user_id", "windows", "snapshots", "detected_at", "lead_hours"), "lead_hours")


@query(
    "failure_modes",
    f"""WITH {LEAD_SQL}, r AS (SELECT 'mode' || (runs.user_id % 3) AS mode, runs.user_id AS asset, detected_at, lead_hours
  FROM runs LEFT JOIN lead USING (user_id))
SELECT mode, asset, count(*) AS n_runs, count(detected_at) AS n_detected, round(avg(lead_hours), 6) AS mean_lead_hours,
  grouping(mode, asset)::BIGINT AS level, coalesce(mode = 'mode2', FALSE) AS held_out FROM r GROUP BY ROLLUP (mode, asset)""",
)
def failure_modes(t: Tables) -> DataFrame:
    per_run = lead_runs(t).withColumns(
        {"mode": F.concat(F.lit("mode"), (F.col("user_id") % 3).cast("string")), "asset": F.col("user_id")}
    )
    return rounded(leadtime.by_failure_mode(per_run, "mode", "asset", ["mode2"]), "mean_lead_hours")


@query(
    "false_alarms",
    f"""WITH {POS_SQL} SELECT user_id, count(*) AS n_windows, count(*) FILTER (WHERE value / 40 > 1.0) AS n_crossings,
  round(avg((value / 40 > 1.0)::INT), 6) AS crossing_rate FROM pos WHERE user_id % 4 <> 0 AND pos >= 10 GROUP BY 1""",
)
def false_alarms(t: Tables) -> DataFrame:
    return rounded(leadtime.false_alarms(scored_windows(t), 1.0, ["user_id"]), "crossing_rate")


ONSET_SQL = f"""{LEAD_SQL}, c AS (SELECT h <= cut AS t, s > 1.0 AS p, cut FROM w, (SELECT unnest([24.0, 72.0, 168.0, 336.0])::DOUBLE AS cut)),
b AS (SELECT cut AS onset_cut_h, count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
  count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM c GROUP BY 1)"""
_CUTS = (24.0, 72.0, 168.0, 336.0)


@query(
    "onset_sweep",
    f"""WITH {ONSET_SQL} SELECT onset_cut_h, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM b""",
)
def onset_sweep(t: Tables) -> DataFrame:
    out = leadtime.onset_sweep(scored_windows(t), 1.0, _CUTS)
    return rounded(out, "accuracy", "precision", "recall", "f1")


@query(
    "onset_range",
    f"""WITH {ONSET_SQL} SELECT round(min(tp / (tp + fp)), 6) AS precision_low, round(max(tp / (tp + fp)), 6) AS precision_high,
  round(min(tp / (tp + fn)), 6) AS recall_low, round(max(tp / (tp + fn)), 6) AS recall_high FROM b""",
)
def onset_range(t: Tables) -> DataFrame:
    out = leadtime.onset_range(leadtime.onset_sweep(scored_windows(t), 1.0, _CUTS))
    return rounded(out, "precision_low", "precision_high", "recall_low", "recall_high")


@query(
    "operating_time",
    """SELECT event_id, sum(CASE WHEN d <= 43200000000 THEN d ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS operating_us FROM (
  SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS d FROM events)""",
)
def operating_time(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts")
    return leadtime.operating_time(rows, "ts", ["user_id"], ["event_id"], stop_s=43_200.0).select(
        "event_id", "operating_us"
    )


@query(
    "run_agreement",
    """WITH q AS (SELECT event_id, value > 50 AS la, value AS sa, value + 0.002 * (event_id % 3) > 50 AS lb,
  value + 0.002 * (event_id % 3) AS sb FROM events),
p AS (SELECT * FROM q WHERE event_id % 10 <> 1 AND event_id % 7 <> 2)
SELECT (SELECT count(*) FROM q WHERE event_id % 10 <> 1 AND event_id % 7 = 2) AS only_a,
  (SELECT count(*) FROM q WHERE event_id % 10 = 1 AND event_id % 7 <> 2) AS only_b, count(*) AS n_windows, round(avg((la = lb)::INT), 6) AS label_agreement, round(max(abs(sa - sb)), 6) AS max_abs_diff,
  max(abs(sa - sb)) <= 1e-4 AS within_noise,
  round(quantile_cont(abs(sa - sb) / nullif(abs(sa), 0), 0.5), 6) AS median_relative_diff FROM p""",
)
def run_agreement(t: Tables) -> DataFrame:
    a = t.events.select("event_id", "value")
    b = a.withColumn("value", F.col("value") + 0.002 * (F.col("event_id") % 3))
    a, b = (x.withColumn("label", F.col("value") > 50) for x in (a, b))
    # Each run lacks some windows of the other.
    a, b = a.filter("event_id % 10 <> 1"), b.filter("event_id % 7 <> 2")
    out = evaluate.agreement(a, b, ["event_id"], label="label", score="value")
    return rounded(out, "label_agreement", "max_abs_diff", "median_relative_diff")


@query(
    "leakage_audit",
    f"""WITH {FRAME_SQL}, l AS ({' UNION ALL '.join(
        f"SELECT '{s}' AS sensor, {s} IS NULL AS gone, coalesce({s} = 0, FALSE) AS zero, coalesce(error > 60, FALSE) AS f FROM frame"
        for s in SENSORS)}),
r AS (SELECT sensor, avg(gone::INT) FILTER (WHERE f) AS ni, avg(gone::INT) FILTER (WHERE NOT f) AS n_o,
  avg(zero::INT) FILTER (WHERE f) AS zi, avg(zero::INT) FILTER (WHERE NOT f) AS zo FROM l GROUP BY 1)
SELECT sensor, round(ni, 6) AS null_inside, round(n_o, 6) AS null_outside, round(zi, 6) AS zero_inside,
  round(zo, 6) AS zero_outside, coalesce(greatest(ni - n_o, zi - zo) > 0.05, FALSE) AS suspect FROM r""",
)
def leakage_audit(t: Tables) -> DataFrame:
    out = audit.fault_leakage(daily_frame(t), SENSORS, F.col("error") > 60)
    return rounded(out, "null_inside", "null_outside", "zero_inside", "zero_outside")


@query(
    "leakage_overlap",
    """SELECT count(*) AS n_shared FROM (SELECT DISTINCT o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'
  AND o_orderdate IN (SELECT o_orderdate FROM orders WHERE o_orderpriority <> '1-URGENT'))""",
)
def leakage_overlap(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return audit.shared_instants(t.orders.filter(urgent), t.orders.filter(~urgent), ["o_orderdate"])


@query(
    "input_contract",
    """WITH l AS (SELECT l_returnflag, unnest([{'s': 'l_quantity', 'x': l_quantity}, {'s': 'l_discount', 'x': l_discount},
  {'s': 'l_tax', 'x': l_tax}]) AS e FROM lineitem)
SELECT l_returnflag, e.s AS sensor, round(avg(e.x), 6) AS mean, round(stddev_pop(e.x), 6) AS std,
  count(*) FILTER (WHERE e.x IS NULL) AS n_missing, abs(avg(e.x)) <= 0.1 AND abs(stddev_pop(e.x) - 1) <= 0.1 AS z_scored
FROM l GROUP BY 1, 2""",
)
def input_contract(t: Tables) -> DataFrame:
    out = audit.input_contract(t.lineitem, ["l_quantity", "l_discount", "l_tax"], ["l_returnflag"])
    return rounded(out, "mean", "std")


@query(
    "drift",
    """WITH d AS (SELECT vec_id // 100 AS period, unnest(range(1, 65)) AS i, embedding FROM embeddings),
m AS (SELECT period, i, avg(embedding[i]::DOUBLE) AS m, count(*) AS n FROM d GROUP BY 1, 2)
SELECT a.period, max(a.n) AS n, round(sqrt(sum((a.m - b.m) ** 2)), 6) AS drift
FROM m a JOIN m b ON a.i = b.i AND b.period = 0 GROUP BY 1""",
)
def drift(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.floor(F.col("vec_id") / 100).alias("period"), "embedding")
    return rounded(audit.drift(rows, "period", F.col("period") == 0, "embedding"), "drift")


LOGS_SQL = """logs AS (SELECT user_id AS run_id, event_id AS id, ts AS created_at,
  CASE WHEN value > 200 THEN 'ERROR' WHEN value > 150 THEN 'WARN' ELSE 'INFO' END AS level,
  CASE event_type WHEN 'purchase' THEN 'job.completed' WHEN 'error' THEN 'job.failed' ELSE 'job.' || event_type END AS event_type,
  CASE event_type WHEN 'purchase' THEN 'Agent execution terminated successfully' WHEN 'view' THEN 'ended inside the reasoning block, dropping ' || regexp_extract(props, '[0-9]+') || ' rehearsed row(s)'
    ELSE 'step ' || event_type END AS message FROM events)"""


def logs(t: Tables) -> DataFrame:
    """Events play log rows of one run per user."""
    k = F.get_json_object("props", "$.k")
    kind, value = F.col("event_type"), F.col("value")
    return t.events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.when(value > 200, "ERROR").when(value > 150, "WARN").otherwise("INFO").alias("level"),
        F.when(kind == "purchase", "job.completed").when(kind == "error", "job.failed")
        .otherwise(F.concat(F.lit("job."), kind)).alias("event_type"),
        F.when(kind == "purchase", "Agent execution terminated successfully")
        .when(kind == "view", F.concat(F.lit("ended inside the reasoning block, dropping "), k, F.lit(" rehearsed row(s)")))
        .otherwise(F.concat(F.lit("step "), kind)).alias("message"),
    )


EVENT_OUTCOME_SQL = """oe AS (SELECT run_id, CASE
  WHEN arg_max(event_type, (created_at, id)) IN ('pod.terminated', 'job.completed', 'job.failed', 'job.canceled') THEN
    CASE WHEN bool_or(level = 'ERROR') THEN 'failed' WHEN bool_or(level = 'WARN' AND message LIKE '%reasoning block%')
      THEN 'empty-reasoning-overflow' ELSE 'completed' END
  ELSE 'running' END AS outcome FROM logs GROUP BY 1)"""


@query(
    "run_outcome_message",
    f"""WITH {LOGS_SQL} SELECT run_id, CASE WHEN bool_or(level = 'ERROR') THEN 'failed'
  WHEN bool_or(message LIKE '%terminated successfully%') THEN 'completed' ELSE 'running' END AS outcome FROM logs GROUP BY 1""",
)
def run_outcome_message(t: Tables) -> DataFrame:
    return runs.outcome_by_message(logs(t))


@query("run_outcome_event", f"WITH {LOGS_SQL}, {EVENT_OUTCOME_SQL} SELECT * FROM oe")
def run_outcome_event(t: Tables) -> DataFrame:
    return runs.outcome_by_event(logs(t))


@query(
    "run_settled",
    f"""WITH {LOGS_SQL}, {EVENT_OUTCOME_SQL}, r AS (SELECT o_custkey AS run_id, count(*) AS c FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT run_id, outcome, coalesce(c, 0) AS n_results, CASE WHEN c > 0 THEN 'succeeded' WHEN outcome = 'completed' THEN 'empty'
  ELSE outcome END AS settled FROM oe LEFT JOIN r USING (run_id)""",
)
def run_settled(t: Tables) -> DataFrame:
    """Finished orders of the customer with the run's number play its results."""
    results = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("run_id"))
    return runs.settle(runs.outcome_by_event(logs(t)), results)


@query(
    "dropped_rows",
    f"""WITH {LOGS_SQL}, d AS (SELECT run_id, id, CAST(regexp_extract(message, 'dropping ([0-9]+)', 1) AS BIGINT) AS dropped
  FROM logs WHERE message LIKE '%dropping%')
SELECT run_id, id, dropped, CASE WHEN dropped = 0 THEN 'never converged' WHEN dropped >= 10 THEN 'repetition'
  ELSE 'cut after drafting' END AS diagnosis FROM d""",
)
def dropped_rows(t: Tables) -> DataFrame:
    return runs.dropped_rows(logs(t)).select("run_id", "id", "dropped", "diagnosis")


@query(
    "output_sanity",
    """SELECT c_custkey AS run_id, count(user_id) AS n_rows, coalesce(bool_and(value > 60), FALSE) AS all_invalid,
  count(user_id) > 0 AND NOT coalesce(bool_and(value > 60), FALSE) AS usable
FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1""",
)
def output_sanity(t: Tables) -> DataFrame:
    expected = t.customer.select(F.col("c_custkey").alias("run_id"))
    output = t.events.select(F.col("user_id").alias("run_id"), (F.col("value") > 60).alias("invalid"))
    return runs.output_sanity(expected, output)


@query(
    "missing_runs",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
)
def missing_runs(t: Tables) -> DataFrame:
    return runs.missing_runs(t.customer.select("c_custkey"), t.events.select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


@query(
    "flow_profile",
    """WITH f AS (SELECT date_trunc('hour', l_shipdate) AS hour, l_returnflag || l_linestatus AS protocol,
  unnest([{'d': 's' || l_suppkey, 'p': 'p' || l_partkey, 'u': l_quantity::BIGINT, 'w': l_linenumber::BIGINT},
          {'d': 'p' || l_partkey, 'p': 's' || l_suppkey, 'u': l_linenumber::BIGINT, 'w': l_quantity::BIGINT}]) AS e FROM lineitem),
r AS (SELECT hour, protocol, e.d AS device, e.p AS peer, e.u AS up, e.w AS down FROM f),
a AS (SELECT device, count(*) AS flow_count, sum(up)::BIGINT AS bytes_up, sum(down)::BIGINT AS bytes_down,
  round(avg(up + down), 6) AS mean_flow_bytes, count(DISTINCT hour) AS active_hours, count(DISTINCT peer) AS distinct_peers FROM r GROUP BY 1),
p AS (SELECT device, protocol, row_number() OVER (PARTITION BY device ORDER BY count(*) DESC, protocol) AS k FROM r GROUP BY 1, 2),
t AS (SELECT device, string_agg(protocol, ',' ORDER BY k) AS top_protocols FROM p WHERE k <= 3 GROUP BY 1)
SELECT * FROM a JOIN t USING (device)""",
)
def flow_profile(t: Tables) -> DataFrame:
    """Line items play flows between a supplier and a part."""
    rows = t.lineitem.select(
        F.col("l_shipdate").alias("time_utc"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("mac_a"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("mac_b"),
        F.concat("l_returnflag", "l_linestatus").alias("prot"),
        F.col("l_quantity").cast("long").alias("bytes_a"),
        F.col("l_linenumber").cast("long").alias("bytes_b"),
    )
    return rounded(flows.profile(rows), "mean_flow_bytes")
