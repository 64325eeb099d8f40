"""The held-out neighbour evaluation, end to end on hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.functions.encoders import moments
from sensorspark.operators import holdout
from sensorspark.session import cut

# The labelled pool is the first SHOT_HOURS of the series, a bound of the classifier; all later windows are judged.
SHOT_HOURS, STRIDE = 240, 3


def hourly_sensors(t: Tables) -> DataFrame:
    """One series per event type: events per hour and their mean value."""
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("hour")
    frame = t.events.groupBy("event_type", hour).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("v")
    )
    return cut(frame)


def _one_sql(w: int) -> str:
    return f"""SELECT {w}::BIGINT AS window_size, (SELECT count(*) FROM lf{w}) AS n_library, 0::BIGINT AS n_unencoded, tp, fp, fn, tn,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM (SELECT count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
  count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM (
  SELECT event_type = 'error' AS t, label = 'error' AS p FROM (SELECT *, row_number() OVER (
    PARTITION BY event_type, s ORDER BY c DESC, d, label) AS r FROM (
    SELECT event_type, s, label, count(*) AS c, sum(d) AS d FROM kn{w} GROUP BY 1, 2, 3)) WHERE r = 1))"""


def _parts_sql(w: int) -> str:
    def joint(src: str, by: str, order: str) -> str:
        six = ", ".join(
            f"avg({c}), stddev_pop({c}), min({c}), max({c}), sqrt(avg({c} * {c})), avg(d{c})" for c in ("n", "v")
        )
        return f"""SELECT {by}, list_transform(f, lambda x: x / (sqrt(list_sum(list_transform(f, lambda y: y * y))) + 1e-9)) AS f FROM (
  SELECT {by}, list_transform([{six}], lambda x: x::FLOAT::DOUBLE) AS f FROM (SELECT *,
    abs(n - lag(n) OVER (PARTITION BY {by} ORDER BY {order})) AS dn, abs(v - lag(v) OVER (PARTITION BY {by} ORDER BY {order})) AS dv
    FROM {src}) GROUP BY {by})"""

    return f"""lw{w} AS (SELECT z.*, k.wid FROM zl z, LATERAL (SELECT unnest(generate_series(greatest(0, ceil((p - {w} + 1) / {STRIDE}))::BIGINT,
  least(floor(p / {STRIDE}), floor((c - {w}) / {STRIDE}))::BIGINT)) AS wid) k),
lf{w} AS ({joint(f"lw{w}", "event_type, label, wid", "hour")}),
tw{w} AS (SELECT event_type, hour, n, v, h0 + (i // {w}) * {w} AS s FROM (SELECT *, min(hour) OVER (PARTITION BY event_type, run) AS h0,
  row_number() OVER (PARTITION BY event_type, run ORDER BY hour) - 1 AS i, count(*) OVER (PARTITION BY event_type, run) AS len FROM zr)
  WHERE (i // {w} + 1) * {w} <= len),
tf{w} AS ({joint(f"tw{w}", "event_type, s", "hour")}),
kn{w} AS (SELECT * FROM (SELECT t.event_type, t.s, l.label, list_distance(t.f, l.f) AS d, row_number() OVER (PARTITION BY t.event_type, t.s
  ORDER BY list_distance(t.f, l.f), l.event_type || '/' || l.label || '/' || l.wid) AS r FROM tf{w} t, lf{w} l) WHERE r <= 3)"""


@query(
    "knn_holdout_sweep",
    f"""WITH h AS (SELECT event_type, floor(epoch(ts) / 3600)::BIGINT AS hour, count(*)::DOUBLE AS n, avg(value) AS v FROM events GROUP BY 1, 2),
cut AS (SELECT min(hour) + {SHOT_HOURS} AS c FROM h),
sc AS (SELECT avg(n) AS mn, stddev_pop(n) + 1e-9 AS sn, avg(v) AS mv, stddev_pop(v) + 1e-9 AS sv FROM h, cut WHERE hour < c),
z AS (SELECT event_type, hour, (n - mn) / sn AS n, (v - mv) / sv AS v, hour < c AS shot,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'other' END AS label FROM h, sc, cut),
zl AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hour) - 1 AS p, count(*) OVER (PARTITION BY event_type) AS c FROM z WHERE shot),
zb AS (SELECT *, hour - lag(hour) OVER (PARTITION BY event_type ORDER BY hour) AS dh FROM z WHERE NOT shot),
zr AS (SELECT *, sum(CASE WHEN dh = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY hour) AS run FROM zb),
{_parts_sql(4)}, {_parts_sql(6)}
{_one_sql(4)} UNION ALL {_one_sql(6)}""",
)
def knn_holdout_sweep(t: Tables) -> DataFrame:
    """Shots are the first ten days; the rest is the unlabelled inference series."""
    rows = hourly_sensors(t)
    start = rows.agg(F.min("hour")).first()[0]
    label = F.when(F.col("event_type") == "error", "error").otherwise("other").alias("label")
    shots = rows.filter(F.col("hour") < start + SHOT_HOURS).select("*", label)
    rest = rows.filter(F.col("hour") >= start + SHOT_HOURS)
    out = holdout.sweep(
        (4, 6), shots, ["n", "v"], inference=rest, labels=rest.select("event_type", "hour", label), tick="hour",
        stride=STRIDE, positive="error", encoder=moments, series=["event_type"],
    )
    return rounded(out, "accuracy", "precision", "recall", "f1")
