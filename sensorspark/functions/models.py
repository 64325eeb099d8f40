"""Batched calls of an external model over a request table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Media limits of one request.
MAX_IMAGES, MAX_FRAMES = 16, 64


def check_media(
    requests: DataFrame, *, images: str = "n_images", frames: str = "max_frames", multi_image: str = "multi_image",
    has_frame_metadata: str = "has_frame_metadata", attachment: str = "attachment",
) -> DataFrame:
    """Add ``problem``: why a request must not be sent, or NULL.

    Several images are either independent (``multi_image``) or frames with metadata, at
    most 16 of the former; at most 64 frames; tabular text goes as plain text, not as CSV.
    """
    several = F.col(images) > 1
    problem = (
        F.when(several & ~F.col(multi_image) & ~F.col(has_frame_metadata), "several images need multi_image or frame metadata")
        .when(F.col(multi_image) & (F.col(images) > MAX_IMAGES), f"more than {MAX_IMAGES} images")
        .when(F.col(frames) > MAX_FRAMES, f"more than {MAX_FRAMES} frames")
        .when(F.lower(F.col(attachment)).endswith(".csv"), "attach tabular text as text/plain")
    )
    return requests.withColumn("problem", problem)


def call_model(
    requests: DataFrame,
    prompt: str,
    make_client: Callable[[], Callable[[str], str]],
    *,
    keys: Sequence[str],
    retries: int = 4,
    backoff_s: float = 1.5,
    parallel_calls: int | None = None,
) -> DataFrame:
    """Call ``make_client()(text)`` once per row: ``keys, answer, error, attempts``.

    One client serves a partition.  A failing call is retried with a growing pause, then
    its row gets NULL and the error; the job goes on.  ``parallel_calls`` bounds how many
    run at once.
    """
    source = requests.select(*keys, F.col(prompt).alias("__p"))
    if parallel_calls:
        source = source.repartition(parallel_calls)

    def run(batches):
        client = make_client()
        for pdf in batches:
            answers, errors, attempts = [], [], []
            for text in pdf["__p"]:
                answer, error, tries = None, None, 0
                for tries in range(1, retries + 1):
                    try:
                        answer, error = client(text), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                        if tries < retries:
                            time.sleep(backoff_s * tries)
                answers.append(answer)
                errors.append(error)
                attempts.append(tries)
            yield pdf[list(keys)].assign(
                answer=pd.Series(answers, dtype="object", index=pdf.index),
                error=pd.Series(errors, dtype="object", index=pdf.index),
                attempts=pd.Series(attempts, dtype="int64", index=pdf.index),
            )

    kinds = ", ".join(f"`{k}` {requests.schema[k].dataType.simpleString()}" for k in keys)
    return source.mapInPandas(run, f"{kinds}, answer string, error string, attempts long")


def observe_progress(df: DataFrame, observation, answer: str = "answer") -> DataFrame:
    """Count finished and failed rows as they pass, without another job."""
    failed = F.count_if(F.col(answer).isNull())
    return df.observe(observation, F.count(F.lit(1)).alias("done"), failed.alias("failed"))
