"""Held-out evaluation: n-shot library, scaled and encoded windows, neighbours, metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.functions.encoders import Encoder, assert_same_convention, encode, spectral
from sensorspark.functions.vectors import doubles, l2_normalize
from sensorspark.operators import evaluate, features, neighbors, windows
from sensorspark.session import cut

# Library stride and number of neighbours.
LIBRARY_STRIDE, NEIGHBORS = 256, 3

Scaler = Mapping[str, tuple[float, float]]


def joint_features(
    tagged: DataFrame, by: Sequence[str], order: str, sensors: Sequence[str], scaler: Scaler, encoder: Encoder = spectral
) -> DataFrame:
    """One unit-length joint vector per window; a window that could not be encoded keeps a NULL vector.

    ``tagged`` has one row per window and sample.  Every channel is scaled and encoded on
    its own and the vectors are concatenated in the order of ``sensors``.
    """
    scaled = features.scale_channels(tagged, scaler)
    arrays = windows.collect_windows(scaled, by, order, sensors)
    out = arrays.select(*by, *[F.col("values")[s].alias(f"__s_{s}") for s in sensors])
    for s in sensors:
        out = encode(out, f"__s_{s}", encoder, embedding=f"__v_{s}", error=f"__x_{s}")
    joint = F.concat(*[doubles(f"__v_{s}") for s in sensors])
    vectors = out.withColumn("features", l2_normalize(joint, 1e-9))
    return vectors.select(*by, "encoder_id", "encoded_length", "features")


def library(
    shots: DataFrame, tick: str, label: str, sensors: Sequence[str], scaler: Scaler, *, window_size: int,
    stride: int = LIBRARY_STRIDE, encoder: Encoder = spectral, series: Sequence[str] = (),
) -> DataFrame:
    """Strided windows of the labelled shots as ``lib_id, label, features``."""
    by = [*dict.fromkeys([*series, label])]
    tagged = windows.sliding(shots, tick, window_size, stride, by)
    joint = joint_features(tagged, [*by, "window_id"], "in_window", sensors, scaler, encoder)
    joint = joint.filter(F.col("features").isNotNull())
    ident = F.concat_ws("/", *[F.col(c).cast("string") for c in (*by, "window_id")])
    # A few shots per class, read by every evaluation step: written once.
    return cut(joint.select(ident.alias("lib_id"), F.col(label).alias("label"), "features", "encoder_id", "encoded_length"))


def test_windows(
    inference: DataFrame, tick: str, sensors: Sequence[str], scaler: Scaler, *, window_size: int,
    max_windows: int | None = None, encoder: Encoder = spectral, series: Sequence[str] = (),
) -> DataFrame:
    """Back-to-back gap-free windows, evenly subsampled per series before they are encoded."""
    tagged = windows.contiguous(inference, tick, window_size, series)
    if max_windows is not None:
        starts = tagged.filter(F.col("in_window") == 0).select(*series, "window_start")
        kept = windows.even_subsample(starts, "window_start", max_windows, series)
        tagged = tagged.join(kept, [*series, "window_start"], "left_semi")
    return joint_features(tagged, [*series, "window_start"], "in_window", sensors, scaler, encoder)


def predict(
    test: DataFrame, lib: DataFrame, series: Sequence[str] = (), *, k: int = NEIGHBORS
) -> DataFrame:
    """Majority label of the nearest library windows, per test window that has a vector.

    Test and library must share encoder and window length.
    """
    assert_same_convention(test, lib)
    ident = F.concat_ws("/", *[F.col(c).cast("string") for c in (*series, "window_start")])
    keyed = test.filter(F.col("features").isNotNull()).withColumn("test_id", ident)
    near = neighbors.knn(keyed, lib, k, query_id="test_id", library_id="lib_id", carry=["label"])
    voted = neighbors.vote(near, "test_id").select("test_id", "predicted")
    return keyed.select("test_id", *series, "window_start").join(voted, "test_id")


def evaluate_window_size(
    shots: DataFrame, inference: DataFrame, labels: DataFrame, tick: str, sensors: Sequence[str], *, window_size: int,
    stride: int, positive: str, max_windows: int | None = None, encoder: Encoder = spectral, series: Sequence[str] = (),
    k: int = NEIGHBORS, scaler: Scaler | None = None,
) -> DataFrame:
    """One row of metrics for one window length.

    ``shots`` carries ``label``; ``labels`` is ``(series, tick, label)`` and a window's truth
    is the label of its first row.  The scaler is fitted on the shot pool only.  Windows
    that could not be encoded are counted as ``n_unencoded``.
    """
    fitted = scaler or features.fit_channels(shots, sensors)
    lib = library(shots, tick, "label", sensors, fitted, window_size=window_size, stride=stride, encoder=encoder, series=series)
    # Read by the convention check, the search and the count: encoded once.
    test = cut(
        test_windows(
            inference, tick, sensors, fitted, window_size=window_size, max_windows=max_windows, encoder=encoder, series=series
        )
    )
    truth = labels.select(*series, F.col(tick).alias("window_start"), F.col("label").alias("truth"))
    judged = predict(test, lib, series, k=k).join(truth, [*series, "window_start"])
    n_lib = lib.agg(F.count(F.lit(1)).alias("n_library"))
    lost = test.agg(F.count_if(F.col("features").isNull()).alias("n_unencoded"))
    out = evaluate.binary(judged, "truth", "predicted", positive)
    named = F.lit(window_size).cast("long").alias("window_size")
    return out.join(F.broadcast(n_lib)).join(F.broadcast(lost)).select(named, "n_library", "n_unencoded", *out.columns)


def sweep(
    window_sizes: Sequence[int], shots: DataFrame, sensors: Sequence[str], *, inference: DataFrame, tick: str,
    series: Sequence[str] = (), **kwargs,
) -> DataFrame:
    """The evaluation once per window length as one table.

    The scaler is fitted once, and rows are ordered once: all lengths cut their windows from
    the same positions and the same runs of ticks.
    """
    fitted = features.fit_channels(shots, sensors)
    placed = windows.prepare_sliding(shots, tick, [*dict.fromkeys([*series, "label"])])
    runs = windows.prepare_contiguous(inference, tick, series)
    rows = [
        evaluate_window_size(
            placed, runs, tick=tick, sensors=sensors, window_size=w, scaler=fitted, series=series, **kwargs
        )
        for w in window_sizes
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return evaluate.comparison(out)
