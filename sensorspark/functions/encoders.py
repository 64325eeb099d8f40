"""Window encoders: ``encode(samples[m, length]) -> vectors[m, dim]``, channels independent.

Any callable with that shape plugs in.  The two here are ours and deterministic; they
are not a trained model and their accuracy is not comparable with one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from collections.abc import Callable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[np.ndarray], np.ndarray]

BANDS, PROJECTED, GRID = 16, 40, 128


def moments(x: np.ndarray) -> np.ndarray:
    """Mean, deviation, minimum, maximum, root mean square and mean absolute step."""
    step = np.abs(np.diff(x, axis=1)).mean(axis=1) if x.shape[1] > 1 else np.zeros(len(x))
    rms = np.sqrt((x * x).mean(axis=1))
    return np.column_stack([x.mean(1), x.std(1), x.min(1), x.max(1), rms, step])


def spectral(x: np.ndarray) -> np.ndarray:
    """Moments, log band energies and a fixed random projection of the resampled window."""
    power = np.abs(np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1)) ** 2
    edges = np.linspace(0, power.shape[1], BANDS + 1).astype(int)
    bands = np.column_stack([power[:, a:b].sum(axis=1) for a, b in zip(edges[:-1], edges[1:])])
    at = np.linspace(0, x.shape[1] - 1, GRID)
    left = np.floor(at).astype(int)
    right = np.minimum(left + 1, x.shape[1] - 1)
    grid = x[:, left] + (x[:, right] - x[:, left]) * (at - left)
    projection = np.random.default_rng(7).standard_normal((GRID, PROJECTED)) / np.sqrt(GRID)
    return np.column_stack([moments(x), np.log1p(bands), grid @ projection])


def encode(
    df: DataFrame,
    samples: str,
    encoder: Encoder = spectral,
    *,
    encoder_id: str | None = None,
    embedding: str = "embedding",
    error: str = "encode_error",
) -> DataFrame:
    """Add one vector per row; a failing or empty window gets NULL and an error instead of ending the job.

    Windows of one Arrow batch that have the same length are encoded together.  If that fails
    they are encoded one by one, so a bad window takes no other with it, whatever batch it is in.
    ``encoder_id`` and ``encoded_length`` are recorded so vectors made under different
    conventions are never compared.
    """

    def run(column: pd.Series) -> pd.DataFrame:
        out: list = [None] * len(column)
        errors: list = ["no samples"] * len(column)
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(column):
            if v is not None and len(v):
                by_length.setdefault(len(v), []).append(i)
        for rows in by_length.values():
            try:
                vectors = encoder(np.stack([np.asarray(column.iloc[i], dtype=float) for i in rows]))
                for i, v in zip(rows, vectors):
                    out[i], errors[i] = v.astype(np.float32), None
                continue
            except Exception:
                pass
            for i in rows:
                try:
                    (v,) = encoder(np.asarray(column.iloc[i], dtype=float)[None, :])
                    out[i], errors[i] = v.astype(np.float32), None
                except Exception as e:
                    errors[i] = f"{type(e).__name__}: {e}"
        return pd.DataFrame({"vector": out, "error": errors})

    udf: Callable[[str], Column] = F.pandas_udf(run, "vector array<float>, error string")
    name = encoder_id or getattr(encoder, "__name__", "encoder")
    made = df.withColumn("__encoded", udf(samples))
    return made.withColumns(
        {
            embedding: F.col("__encoded")["vector"],
            error: F.col("__encoded")["error"],
            "encoder_id": F.lit(name),
            "encoded_length": F.size(samples).cast("long"),
        }
    ).drop("__encoded")


def assert_same_convention(queries: DataFrame, library: DataFrame) -> None:
    """Vectors may only be compared when encoder and window length agree."""
    kinds = ["encoder_id", "encoded_length"]
    odd = queries.select(kinds).distinct().exceptAll(library.select(kinds).distinct()).limit(1).collect()
    if odd:
        raise ValueError(f"queries encoded as {tuple(odd[0])} have no library of the same convention")
