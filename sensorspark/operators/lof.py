"""Local outlier factor against a fitted reference, one detector per asset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.operators.neighbors import BROADCAST_BYTES, knn
from sensorspark.plans.ranks import exact_quantile
from sensorspark.session import cut

# Keeps the density of exact duplicates finite.
TINY = 1e-10


def _density(near: DataFrame, reference: DataFrame, point: str, by: Sequence[str]) -> DataFrame:
    """Local reachability density of each point from its neighbours' k-distances."""
    known = reference.select(*by, F.col("ref_id").alias("neighbor_id"), "k_distance")
    reach = near.join(known, [*by, "neighbor_id"]).withColumn("__r", F.greatest("distance", "k_distance"))
    return reach.groupBy(*by, point).agg((F.lit(1.0) / (F.avg("__r") + TINY)).alias("density"))


def fit(
    reference: DataFrame,
    *,
    id: str,
    features: str = "features",
    k: int = 20,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Reference rows with ``k_distance`` and ``density``; the fitted detector."""
    # The neighbours are read twice, the detector by every later scoring: each is computed once.
    near = cut(
        knn(
            reference, reference, k, query_id=id, library_id=id, features=features, by=by, skip_same_id=True,
            broadcast_bytes=broadcast_bytes,
        ).withColumnRenamed(id, "ref_id")
    )
    spread = near.groupBy(*by, "ref_id").agg(F.max("distance").alias("k_distance"))
    dense = _density(near, spread, "ref_id", by)
    base = reference.select(*by, F.col(id).alias("ref_id"), F.col(features).alias("features"))
    return cut(base.join(spread, [*by, "ref_id"]).join(dense, [*by, "ref_id"]))


def score(
    queries: DataFrame,
    fitted: DataFrame,
    *,
    id: str,
    features: str = "features",
    k: int = 20,
    by: Sequence[str] = (),
    threshold: float | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``anomaly_score``: mean density of the neighbours over the point's own; 1 is neutral."""
    near = knn(
        queries.withColumnRenamed(features, "features"), fitted, k, query_id=id, library_id="ref_id", by=by,
        broadcast_bytes=broadcast_bytes,
        carry=["k_distance", "density"],
    )
    reach = F.greatest("distance", "k_distance")
    out = near.groupBy(*by, id).agg((F.avg("density") * (F.avg(reach) + TINY)).alias("anomaly_score"))
    return label(out, threshold) if threshold is not None else out


def label(scored: DataFrame, threshold: float) -> DataFrame:
    """``anomaly`` strictly above the threshold, else ``normal``."""
    above = F.col("anomaly_score") > threshold
    return scored.withColumn("predicted_label", F.when(above, "anomaly").otherwise("normal"))


def choose_threshold(scored_reference: DataFrame, target_rate: float, by: Sequence[str] = ()) -> DataFrame:
    """The score that leaves ``target_rate`` of the reference above it."""
    if not 0 < target_rate < 1:
        raise ValueError(f"target_rate must be in (0, 1), got {target_rate}")
    return exact_quantile(scored_reference, by, "anomaly_score", 1 - target_rate, "threshold").drop("n")


def distribution(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Median, 99th percentile, maximum and crossing share of a set of scores."""
    scored = cut(scored)
    mid = exact_quantile(scored, by, "anomaly_score", 0.5, "median")
    high = exact_quantile(scored, by, "anomaly_score", 0.99, "p99").drop("n")
    top = scored.groupBy(*by).agg(
        F.max("anomaly_score").alias("max"),
        F.avg((F.col("anomaly_score") > threshold).cast("double")).alias("crossing_share"),
    )
    if by:
        return mid.join(high, list(by)).join(top, list(by))
    return mid.join(F.broadcast(high)).join(F.broadcast(top))
