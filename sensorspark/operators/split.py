"""Train/test splits with exact sizes; every row keeps its columns and gets ``split``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import micros
from sensorspark.operators.windows import positions
from sensorspark.plans.ranks import order_statistic

AXIS = "__us"


def _sizes(n: int, test_size: float) -> int:
    if not 0 < test_size < 1:
        raise ValueError(f"a test share lies between 0 and 1, not at {test_size}")
    n_test = int(n * test_size)
    if n_test == 0 or n_test == n:
        raise ValueError(f"{test_size} of {n} rows leaves one side without rows")
    return n - n_test


def _before(order: Sequence[str], at: Sequence) -> Column:
    """Rows strictly before ``at`` in lexicographic order."""
    out = F.lit(False)
    for i in reversed(range(len(order))):
        out = (F.col(order[i]) < F.lit(at[i])) | ((F.col(order[i]) == F.lit(at[i])) & out)
    return out


def _cut(rows: DataFrame, order: Sequence[str], test_size: float) -> DataFrame:
    n = rows.count()
    n_train = _sizes(n, test_size)
    at = order_statistic(rows, order, n_train, n)
    return rows.withColumn("split", F.when(_before(order, at), "train").otherwise("test"))


def out_of_time(df: DataFrame, timestamp: str, ties: Sequence[str], test_size: float = 0.3) -> DataFrame:
    """The earliest rows train, the latest ``floor(n * test_size)`` test.

    Only the cut point is searched for; the rows themselves are neither sorted nor
    shuffled.  ``ties`` must make the order total.
    """
    if timestamp not in df.columns:
        raise ValueError(f"no column {timestamp!r} to order by")
    rows = df.withColumn(AXIS, micros(df, timestamp))
    return _cut(rows, [AXIS, *ties], test_size).drop(AXIS)


def seeded_random(df: DataFrame, key: Sequence[str], test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """Same sizes as :func:`out_of_time`, in the order of a seeded hash of a unique key."""
    # Sixty bits of a digest: every engine computes the same order.
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    rows = df.withColumn("__h", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"))
    return _cut(rows, ["__h", *key], test_size).drop("__h")


MODES = ("oot", "random")


def problems(df: DataFrame, timestamp: str, mode: str = "oot", test_size: float = 0.3) -> DataFrame:
    """What is wrong with the settings of a split, one row per problem; no rows when it can be made."""
    found = []
    if mode not in MODES:
        found.append(("mode", f"{mode!r} is not one of {list(MODES)}"))
    if mode == "oot" and timestamp not in df.columns:
        found.append(("timestamp", f"no column {timestamp!r} to order by"))
    if not 0 < test_size < 1:
        found.append(("test_size", f"a test share lies between 0 and 1, not at {test_size}"))
    else:
        n = df.count()
        if int(n * test_size) in (0, n):
            found.append(("test_size", f"{test_size} of {n} rows leaves one side without rows"))
    return df.sparkSession.createDataFrame(found, "setting string, problem string")


def in_time_order(parts: DataFrame, timestamp: str, ties: Sequence[str] = ()) -> DataFrame:
    """Both parts of a split with ``part_pos``, the place of a row in its part in order of time."""
    return positions(parts, timestamp, ["split"], ties, pos="part_pos", size="part_rows")
