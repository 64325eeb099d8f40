"""Neighbour, prototype, outlier and feature queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.catalog.windowing import POS_SQL, _TAGGED
from sensorspark.functions import encoders, vectors
from sensorspark.operators import evaluate, features, lof, neighbors, windows
from sensorspark.plans.series import plan_layout, scan

SHOTS = 10

SHOTS_SQL = f"""emb AS (SELECT vec_id, label, embedding::DOUBLE[] AS v,
  row_number() OVER (PARTITION BY label ORDER BY vec_id) AS shot FROM embeddings),
lib AS (SELECT * FROM emb WHERE shot <= {SHOTS}), test AS (SELECT * FROM emb WHERE shot > {SHOTS})"""

KNN_SQL = f"""{SHOTS_SQL}, near AS (SELECT * FROM (
  SELECT t.vec_id, t.label AS truth, l.vec_id AS neighbor_id, l.label, list_distance(t.v, l.v) AS distance,
    row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.v, l.v), l.vec_id) AS rank
  FROM test t, lib l) WHERE rank <= 3),
votes AS (SELECT vec_id, truth, label, count(*) AS c, sum(distance) AS d FROM near GROUP BY ALL),
pred AS (SELECT vec_id, truth, label AS predicted FROM (SELECT *, row_number() OVER (
  PARTITION BY vec_id ORDER BY c DESC, d, label) AS r FROM votes) WHERE r = 1)"""


def shot_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The n-shot library (the first shots of each class) and everything else."""
    w = Window.partitionBy("label").orderBy("vec_id")
    emb = t.embeddings.select("vec_id", "label", F.col("embedding").alias("features"))
    library = emb.withColumn("shot", F.row_number().over(w)).filter(F.col("shot") <= SHOTS).drop("shot")
    # The limit per class is applied before the shuffle; numbering all rows would not be.
    return library, emb.join(library.select("vec_id"), "vec_id", "left_anti")


def predictions(t: Tables) -> DataFrame:
    library, test = shot_split(t)
    near = neighbors.knn(test, library, 3, query_id="vec_id", library_id="vec_id", carry=["label"])
    voted = neighbors.vote(near, "vec_id")
    return test.select("vec_id", F.col("label").alias("truth")).join(voted, "vec_id")


@query("knn_topk", f"WITH {KNN_SQL} SELECT vec_id, neighbor_id, label, rank, round(distance, 6) AS distance FROM near")
def knn_topk(t: Tables) -> DataFrame:
    library, test = shot_split(t)
    near = neighbors.knn(test, library, 3, query_id="vec_id", library_id="vec_id", carry=["label"])
    return rounded(near, "distance")


@query("knn_predict", f"WITH {KNN_SQL} SELECT vec_id, truth, predicted FROM pred")
def knn_predict(t: Tables) -> DataFrame:
    return predictions(t).drop("probabilities")


CLASS_SQL = """conf AS (SELECT truth, predicted, count(*) AS c FROM pred GROUP BY ALL),
cls AS (SELECT truth AS label FROM conf UNION SELECT predicted FROM conf),
m AS (SELECT label, coalesce((SELECT sum(c) FROM conf WHERE truth = label AND predicted = label), 0)::BIGINT AS tp,
  coalesce((SELECT sum(c) FROM conf WHERE truth = label AND predicted <> label), 0)::BIGINT AS fn,
  coalesce((SELECT sum(c) FROM conf WHERE truth <> label AND predicted = label), 0)::BIGINT AS fp FROM cls),
prf AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM m)"""


@query(
    "knn_class_metrics",
    f"""WITH {KNN_SQL}, {CLASS_SQL} SELECT label, tp, fn, fp, tp + fn AS support, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf""",
)
def knn_class_metrics(t: Tables) -> DataFrame:
    return rounded(evaluate.per_class(predictions(t), "truth", "predicted"), "precision", "recall", "f1")


@query(
    "knn_accuracy",
    f"""WITH {KNN_SQL}, {CLASS_SQL} SELECT (SELECT sum(c) FROM conf)::BIGINT AS n,
  (SELECT sum(tp) FROM prf)::BIGINT AS correct,
  round((SELECT sum(tp) FROM prf) / (SELECT sum(c) FROM conf), 6) AS accuracy,
  round((SELECT avg(f1) FROM prf WHERE tp + fn > 0), 6) AS macro_f1""",
)
def knn_accuracy(t: Tables) -> DataFrame:
    return rounded(evaluate.multiclass(predictions(t), "truth", "predicted"), "accuracy", "macro_f1")


@query("knn_confusion", f"WITH {KNN_SQL} SELECT truth, predicted, count(*) AS n FROM pred GROUP BY ALL")
def knn_confusion(t: Tables) -> DataFrame:
    return evaluate.confusion(predictions(t), "truth", "predicted")


@query(
    "knn_vote_shares",
    f"""WITH {KNN_SQL} SELECT vec_id, label::VARCHAR AS class, round(c / sum(c) OVER (PARTITION BY vec_id), 6) AS p FROM votes""",
)
def knn_vote_shares(t: Tables) -> DataFrame:
    shares = predictions(t).select("vec_id", F.explode("probabilities").alias("class", "p"))
    return rounded(shares, "p")


@query(
    "knn_weighted_vote",
    f"""WITH {KNN_SQL}, wv AS (SELECT vec_id, label, sum(1.0 + neighbor_id % 3)::DOUBLE AS c, sum(distance) AS d FROM near GROUP BY ALL)
SELECT vec_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, d, label) AS r FROM wv) WHERE r = 1""",
)
def knn_weighted_vote(t: Tables) -> DataFrame:
    """Library rows carry their own weight in the vote."""
    library, test = shot_split(t)
    weighted = library.withColumn("weight", 1.0 + F.col("vec_id") % 3)
    near = neighbors.knn(test, weighted, 3, query_id="vec_id", library_id="vec_id", carry=["label", "weight"])
    return neighbors.vote(near, "vec_id", weight="weight").drop("probabilities")


@query(
    "similarity_search",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, neighbor_id, rank, round(distance, 6) AS distance FROM (
  SELECT a.vec_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS distance,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank
  FROM e a, e b WHERE a.vec_id <> b.vec_id) WHERE rank <= 5""",
)
def similarity_search(t: Tables) -> DataFrame:
    emb = t.embeddings.select("vec_id", F.col("embedding").alias("features"))
    near = neighbors.knn(emb, emb, 5, query_id="vec_id", library_id="vec_id", skip_same_id=True)
    return rounded(near, "distance")


PROTO_SQL = f"""{SHOTS_SQL}, dims AS (SELECT label, unnest(range(1, 65)) AS i, v FROM lib),
means AS (SELECT label, i, avg(v[i]) AS m FROM dims GROUP BY 1, 2),
protos AS (SELECT label, list(m ORDER BY i) AS p FROM means GROUP BY 1),
pd AS (SELECT vec_id, t.label AS truth, p.label, list_distance(v, p.p) AS d FROM test t, protos p)"""


@query(
    "prototype_predict",
    f"""WITH {PROTO_SQL} SELECT vec_id, label AS predicted, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS r FROM pd) WHERE r = 1""",
)
def prototype_predict(t: Tables) -> DataFrame:
    library, test = shot_split(t)
    protos = neighbors.prototypes(library)
    near = neighbors.knn(
        test, protos.withColumn("predicted", F.col("label")), 1, query_id="vec_id", library_id="label"
    )
    return rounded(near.select("vec_id", F.col("neighbor_id").alias("predicted"), "distance"), "distance")


@query(
    "prototype_probabilities",
    f"""WITH {PROTO_SQL} SELECT vec_id, label::VARCHAR AS class,
  round(exp(-d) / sum(exp(-d)) OVER (PARTITION BY vec_id), 6) AS p FROM pd""",
)
def prototype_probabilities(t: Tables) -> DataFrame:
    library, test = shot_split(t)
    protos = neighbors.prototypes(library)
    n = library.select("label").distinct().count()
    out = neighbors.nearest_prototype(test, protos, n, query_id="vec_id")
    return rounded(out.select("vec_id", F.explode("probabilities").alias("class", "p")), "p")


LOF_SQL = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
r AS (SELECT * FROM e WHERE label < 5),
rn AS (SELECT * FROM (SELECT a.vec_id AS p, b.vec_id AS o, list_distance(a.v, b.v) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
  FROM r a, r b WHERE a.vec_id <> b.vec_id) WHERE k <= 10),
kd AS (SELECT p, max(d) AS kdist FROM rn GROUP BY 1),
lrd AS (SELECT rn.p, 1.0 / (avg(greatest(d, kdist)) + 1e-10) AS density FROM rn JOIN kd ON rn.o = kd.p GROUP BY 1),
qn AS (SELECT * FROM (SELECT a.vec_id AS q, b.vec_id AS o, list_distance(a.v, b.v) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
  FROM e a, r b WHERE a.label >= 5) WHERE k <= 10),
sc AS (SELECT q AS vec_id, avg(density) * (avg(greatest(d, kdist)) + 1e-10) AS s
  FROM qn JOIN kd ON o = kd.p JOIN lrd ON o = lrd.p GROUP BY 1)"""


def lof_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Classes below 5 play the healthy reference; the others are scored against it."""
    emb = t.embeddings.select("vec_id", "label", F.col("embedding").alias("features"))
    fitted = lof.fit(emb.filter("label < 5"), id="vec_id", k=10)
    return fitted, emb.filter("label >= 5")


@query("lof_fit", f"WITH {LOF_SQL} SELECT kd.p AS ref_id, round(kdist, 6) AS k_distance, round(density, 6) AS density FROM kd JOIN lrd ON kd.p = lrd.p")
def lof_fit(t: Tables) -> DataFrame:
    return rounded(lof_parts(t)[0].drop("features"), "k_distance", "density")


@query(
    "lof_score",
    f"WITH {LOF_SQL} SELECT vec_id, round(s, 6) AS anomaly_score, CASE WHEN s > 1.05 THEN 'anomaly' ELSE 'normal' END AS predicted_label FROM sc",
)
def lof_score(t: Tables) -> DataFrame:
    fitted, rest = lof_parts(t)
    return rounded(lof.score(rest, fitted, id="vec_id", k=10, threshold=1.05), "anomaly_score")


@query(
    "lof_distribution",
    f"""WITH {LOF_SQL} SELECT round(quantile_cont(s, 0.5), 6) AS median, round(quantile_cont(s, 0.99), 6) AS p99,
  round(max(s), 6) AS max, round(avg((s > 1.05)::INT), 6) AS crossing_share, count(*) AS n FROM sc""",
)
def lof_distribution(t: Tables) -> DataFrame:
    fitted, rest = lof_parts(t)
    scored = lof.score(rest, fitted, id="vec_id", k=10)
    return rounded(lof.distribution(scored, 1.05), "median", "p99", "max", "crossing_share")


@query("lof_threshold", f"WITH {LOF_SQL} SELECT round(quantile_cont(s, 0.9), 6) AS threshold FROM sc")
def lof_threshold(t: Tables) -> DataFrame:
    fitted, rest = lof_parts(t)
    scored = lof.score(rest, fitted, id="vec_id", k=10)
    return rounded(lof.choose_threshold(scored, 0.1), "threshold")


@query(
    "lof_per_asset",
    """WITH e AS (SELECT vec_id, label AS asset, embedding::DOUBLE[] AS v,
  row_number() OVER (PARTITION BY label ORDER BY vec_id) AS shot, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
r AS (SELECT * FROM e WHERE 3 * shot <= n),
rn AS (SELECT * FROM (SELECT a.asset, a.vec_id AS p, b.vec_id AS o, list_distance(a.v, b.v) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
  FROM r a JOIN r b ON a.asset = b.asset AND a.vec_id <> b.vec_id) WHERE k <= 5),
kd AS (SELECT p, max(d) AS kdist FROM rn GROUP BY 1),
lrd AS (SELECT rn.p, 1.0 / (avg(greatest(d, kdist)) + 1e-10) AS density FROM rn JOIN kd ON rn.o = kd.p GROUP BY 1),
qn AS (SELECT * FROM (SELECT a.asset, a.vec_id AS q, b.vec_id AS o, list_distance(a.v, b.v) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
  FROM e a JOIN r b ON a.asset = b.asset WHERE 3 * a.shot > a.n) WHERE k <= 5)
SELECT asset, q AS vec_id, round(avg(density) * (avg(greatest(d, kdist)) + 1e-10), 6) AS anomaly_score
FROM qn JOIN kd ON o = kd.p JOIN lrd ON o = lrd.p GROUP BY 1, 2""",
)
def lof_per_asset(t: Tables) -> DataFrame:
    """One detector per asset, fitted on the first third of the asset's own windows."""
    emb = t.embeddings.select("vec_id", F.col("label").alias("asset"), F.col("embedding").alias("features"))
    lay = plan_layout(emb, ["asset"], "vec_id")
    placed = lay.detach(scan(emb, lay, pos="pos", size="n"))
    shots = placed.filter("3 * (pos + 1) <= n").drop("pos", "n")
    rest = placed.filter("3 * (pos + 1) > n").drop("pos", "n")
    fitted = lof.fit(shots, id="vec_id", k=5, by=["asset"])
    return rounded(lof.score(rest, fitted, id="vec_id", k=5, by=["asset"]), "anomaly_score")


@query(
    "l2_normalize",
    """SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE / n, 6)) AS features FROM (SELECT *,
  sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings)""",
)
def l2_normalize(t: Tables) -> DataFrame:
    unit = vectors.l2_normalize(vectors.doubles("embedding"))
    return t.embeddings.select("vec_id", F.transform(unit, lambda x: F.round(x, 6)).alias("features"))


@query(
    "standardize_dims",
    """WITH d AS (SELECT vec_id, unnest(range(1, 65)) AS i, embedding FROM embeddings),
s AS (SELECT i, avg(embedding[i]::DOUBLE) AS m, stddev_pop(embedding[i]::DOUBLE) AS sd FROM d GROUP BY 1)
SELECT vec_id, list(round((embedding[i]::DOUBLE - m) / sd, 6) ORDER BY i) AS features FROM d JOIN s USING (i) GROUP BY 1""",
)
def standardize_dims(t: Tables) -> DataFrame:
    emb = t.embeddings.select("vec_id", F.col("embedding").alias("features"))
    scaled = features.fit_dimensions(emb, "features").transform(emb, "features")
    return scaled.withColumn("features", F.transform("features", lambda x: F.round(x, 6)))


JOINT = """SELECT (vec_id // 4)::BIGINT AS read_index, 'ch' || (vec_id % 4) AS sensor, embedding, label, vec_id
  FROM embeddings"""


def channel_rows(t: Tables) -> DataFrame:
    """Consecutive vectors play the four channels of one window."""
    return t.embeddings.select(
        F.floor(F.col("vec_id") / 4).alias("read_index"),
        F.concat(F.lit("ch"), F.pmod("vec_id", F.lit(4)).cast("string")).alias("sensor"),
        "embedding",
        F.floor(F.col("vec_id") / 40).cast("string").alias("label"),
    )


@query(
    "joint_state",
    f"""SELECT read_index, min((vec_id // 40)::VARCHAR) AS label,
  list_transform(flatten(list(embedding ORDER BY sensor)), lambda x: round(x::DOUBLE, 6)) AS features FROM ({JOINT}) GROUP BY 1""",
)
def joint_state(t: Tables) -> DataFrame:
    """The last window may lack channels, as a table may end anywhere."""
    joint = features.joint_state(channel_rows(t), ["ch0", "ch1", "ch2", "ch3"], whole=False)
    return joint.withColumn("features", F.transform("features", lambda x: F.round(x, 6)))


@query("pca_project")
def pca_project(t: Tables) -> DataFrame:
    emb = t.embeddings.select("vec_id", F.col("embedding").alias("features"))
    projection, _ = features.pca(emb, "features", 4)
    return emb.select("vec_id", projection.alias("components"))


_STATS = ("mean", "std", "min", "max", "rms", "peak_to_peak", "skewness", "kurtosis", "crest_factor", "zero_crossings", "slope")


@query(
    "window_features",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=8)}, v AS (SELECT *, value - 40 AS x, pos - window_id * 8 AS p FROM wins),
z AS (SELECT *, coalesce((lag(x >= 0) OVER (PARTITION BY user_id, window_id ORDER BY p)) <> (x >= 0), FALSE) AS zc,
  avg(x) OVER (PARTITION BY user_id, window_id) AS m FROM v)
SELECT user_id, window_id, round(avg(x), 6) AS x_mean, round(stddev_pop(x), 6) AS x_std, round(min(x), 6) AS x_min,
  round(max(x), 6) AS x_max, round(sqrt(avg(x * x)), 6) AS x_rms, round(max(x) - min(x), 6) AS x_peak_to_peak,
  round(avg((x - m) ** 3) / pow(avg((x - m) ** 2), 1.5), 6) AS x_skewness,
  round(avg((x - m) ** 4) / pow(avg((x - m) ** 2), 2) - 3, 6) AS x_kurtosis,
  round(max(abs(x)) / sqrt(avg(x * x)), 6) AS x_crest_factor, count(*) FILTER (WHERE zc) AS x_zero_crossings,
  round(regr_slope(x, p), 6) AS x_slope FROM z GROUP BY 1, 2""",
)
def window_features(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", (F.col("value") - 40).alias("x"))
    out = features.sliding_statistics(rows, "ts", 16, 8, ["x"], ["user_id"], ["event_id"], _STATS)
    return rounded(out, *[f"x_{n}" for n in _STATS if n != "zero_crossings"])


_DENSE = ("mean", "std", "min", "max", "rms", "zero_crossings", "slope")


@query(
    "window_features_dense",
    """WITH p AS (SELECT *, quantity - 25 AS x, row_number() OVER (PARTITION BY k ORDER BY ts, o, l, quantity) - 1 AS pos FROM
  (SELECT l_orderkey // 20000 AS k, l_shipdate::TIMESTAMP AS ts, l_orderkey AS o, l_linenumber AS l, l_quantity::DOUBLE AS quantity FROM lineitem)),
s AS (SELECT *, x >= 0 AS up, coalesce((lag(x >= 0) OVER (PARTITION BY k ORDER BY pos)) <> (x >= 0), FALSE) AS zc FROM p),
w AS (SELECT k, pos, count(*) OVER f AS n, avg(x) OVER f AS m, stddev_pop(x) OVER f AS d, min(x) OVER f AS lo, max(x) OVER f AS hi,
  sqrt(avg(x * x) OVER f) AS rms, (sum(zc::INT) OVER f) - first_value(zc::INT) OVER f AS z, regr_slope(x, pos) OVER f AS slope
  FROM s WINDOW f AS (PARTITION BY k ORDER BY pos ROWS 1023 PRECEDING))
SELECT k, (pos - 1023)::BIGINT AS window_id, round(m, 6) AS x_mean, round(d, 6) AS x_std, round(lo, 6) AS x_min, round(hi, 6) AS x_max,
  round(rms, 6) AS x_rms, z::BIGINT AS x_zero_crossings, round(slope, 6) AS x_slope FROM w WHERE n = 1024""",
)
def window_features_dense(t: Tables) -> DataFrame:
    """Windows of 1,024 rows at every row."""
    rows = t.lineitem.select(
        F.floor(F.col("l_orderkey") / 20000).alias("k"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), (F.col("l_quantity").cast("double") - 25).alias("x"),
    )
    out = features.sliding_statistics(rows, "ts", 1024, 1, ["x"], ["k"], ["o", "l", "x"], _DENSE)
    return rounded(out, *[f"x_{n}" for n in _DENSE if n != "zero_crossings"])


@query(
    "channel_scaler",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) + 1e-9 AS d FROM events WHERE event_type <> 'error')
SELECT event_id, round((value - m) / d, 6) AS value FROM events, s""",
)
def channel_scaler(t: Tables) -> DataFrame:
    """Fitted on the rows of the normal class only, applied to every row."""
    rows = t.events.select("event_id", "value", "event_type")
    scaler = features.fit_channels(rows.filter("event_type <> 'error'"), ["value"])
    return rounded(features.scale_channels(rows.drop("event_type"), scaler), "value")


@query(
    "channel_separation",
    """WITH l AS (SELECT l_returnflag = 'R' AS f, unnest([
  {'s': 'l_quantity', 'x': l_quantity}, {'s': 'l_extendedprice', 'x': l_extendedprice},
  {'s': 'l_discount', 'x': l_discount}, {'s': 'l_tax', 'x': l_tax}]) AS e FROM lineitem)
SELECT e.s AS sensor, round(abs(avg(e.x) FILTER (WHERE f) - avg(e.x) FILTER (WHERE NOT f))
  / sqrt((var_pop(e.x) FILTER (WHERE f) + var_pop(e.x) FILTER (WHERE NOT f)) / 2), 6) AS effect FROM l GROUP BY 1""",
)
def channel_separation(t: Tables) -> DataFrame:
    sensors = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(features.separation(t.lineitem, sensors, F.col("l_returnflag") == "R"), "effect")


@query(
    "convention_difference",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE - x::DOUBLE / n))) / 64, 6) AS diff FROM (
  SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9 AS n FROM embeddings)""",
)
def convention_difference(t: Tables) -> DataFrame:
    raw = vectors.doubles("embedding")
    diff = vectors.mean_abs_difference(raw, vectors.l2_normalize(raw, 1e-9))
    return rounded(t.embeddings.select("vec_id", diff.alias("diff")), "diff")


@query(
    "window_znorm",
    """SELECT vec_id, list_transform(embedding, lambda x: round((x::DOUBLE - m) / (s + 1e-9), 6)) AS z FROM (SELECT *,
  list_avg(embedding::DOUBLE[]) AS m, list_stddev_pop(embedding::DOUBLE[]) AS s FROM embeddings)""",
)
def window_znorm(t: Tables) -> DataFrame:
    z = vectors.z_normalize(vectors.doubles("embedding"))
    return t.embeddings.select("vec_id", F.transform(z, lambda x: F.round(x, 6)).alias("z"))


def encoded_windows(t: Tables, size: int = 16, encoder: encoders.Encoder = encoders.moments) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value")
    tagged = windows.sliding(rows, "ts", size, size, ["user_id"], ["event_id"])
    arrays = windows.collect_windows(tagged, ["user_id", "window_id"], "in_window", ["value"])
    return encoders.encode(
        arrays.select("user_id", "window_id", F.col("values")["value"].alias("samples")), "samples", encoder, encoder_id="moments"
    )


@query(
    "encode_windows",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=16)},
d AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id, window_id ORDER BY pos)) AS dv FROM wins)
SELECT user_id, window_id, 16::BIGINT AS encoded_length, 'moments' AS encoder_id,
  list_transform([avg(value), stddev_pop(value), min(value), max(value), sqrt(avg(value * value)), avg(dv)],
    lambda x: round(x::FLOAT::DOUBLE, 3)) AS embedding FROM d GROUP BY 1, 2""",
)
def encode_windows(t: Tables) -> DataFrame:
    out = encoded_windows(t).drop("samples", "encode_error")
    return out.withColumn("embedding", F.transform("embedding", lambda x: F.round(x.cast("double"), 3)))


def _careful(x: np.ndarray) -> np.ndarray:
    """An encoder that refuses windows with a very high value."""
    if (x > 180).any():
        raise ValueError("value out of range")
    return encoders.moments(x)


@query(
    "encode_rejected",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=16)}
SELECT user_id, window_id, CASE WHEN max(value) > 180 THEN 'ValueError: value out of range' END AS encode_error,
  CASE WHEN max(value) <= 180 THEN 6 END::INTEGER AS n_dims FROM wins GROUP BY 1, 2""",
)
def encode_rejected(t: Tables) -> DataFrame:
    """Only the refused windows are without a vector."""
    out = encoded_windows(t, encoder=_careful)
    return out.select("user_id", "window_id", "encode_error", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("n_dims"))


@query(
    "fused_features",
    f"""WITH {POS_SQL}, {_TAGGED.format(w=16, s=16)},
d AS (SELECT *, pos - window_id * 16 AS p, abs(value - lag(value) OVER (PARTITION BY user_id, window_id ORDER BY pos)) AS dv FROM wins)
SELECT user_id, window_id, list_transform([avg(value), stddev_pop(value), min(value), max(value), sqrt(avg(value * value)), avg(dv)],
    lambda x: round(x::FLOAT::DOUBLE, 3)) || [round(max(value) - min(value), 6), round(regr_slope(value, p), 6)] AS fused FROM d GROUP BY 1, 2""",
)
def fused_features(t: Tables) -> DataFrame:
    """Encoder vector and statistics of the same window side by side."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    tagged = windows.sliding(rows, "ts", 16, 16, ["user_id"], ["event_id"])
    by = ["user_id", "window_id"]
    stats = features.window_statistics(tagged, by, "in_window", ["value"], ["peak_to_peak", "slope"])
    out = features.fuse(encoded_windows(t), stats, by, "embedding", ["value_peak_to_peak", "value_slope"])
    shown = F.transform("fused", lambda x, i: F.when(i < 6, F.round(x, 3)).otherwise(F.round(x, 6)))
    return out.select(*by, shown.alias("fused"))
