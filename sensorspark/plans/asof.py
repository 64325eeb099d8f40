"""As-of joins as one ordered scan over the union of both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import micros
from sensorspark.plans.series import plan_layout, scan

AXIS, SPREAD = "__us", "__spread"


def as_of(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, carry: Sequence[str],
    *, ties: Sequence[str] = (), prefix: str = "last_",
) -> DataFrame:
    """Each left row with the last right row at or before it, as ``<prefix><column>``.

    ``ties`` are right columns that order equal instants.  Rows without an earlier match
    keep NULLs, and so do left rows without a time.  Nothing is joined, so a hot key is cut
    like any other series.
    """
    # Of the right rows of an instant the last one counts: they are reduced before any row moves.
    # Left rows of an instant may come in any order, so a hash spreads a burst of them.
    hashed = [c for c in left.columns if "map<" not in left.schema[c].dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*hashed), F.lit(1 << 20)) + 1
    a = left.select(*keys, micros(left, left_ts).alias(AXIS), spread.alias(SPREAD), F.struct(*left.columns).alias("__row"), F.lit(None).alias("__hit"))
    hit = F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in carry])
    b = right.select(*keys, micros(right, right_ts).alias(AXIS), hit.alias("__hit"), F.struct(F.lit(0).alias("__o"), *ties).alias("__order"))
    b = b.groupBy(*keys, AXIS).agg(F.max_by("__hit", "__order").alias("__hit"))
    both = a.unionByName(b.withColumn(SPREAD, F.lit(0).cast("long")).withColumn("__row", F.lit(None)))
    # Equal instants: the right row first.
    lay = plan_layout(both, keys, AXIS, [SPREAD])
    seen = scan(both, lay, upto={"__last": F.col("__hit")}, at=False).filter(F.col(SPREAD) > 0)
    found = seen.select("__row.*", *[F.col("__last")["v"][f"{prefix}{c}"].alias(f"{prefix}{c}") for c in carry])
    kinds = {f.name: f.dataType for f in right.schema}
    timeless = left.filter(micros(left, left_ts).isNull())
    return found.unionByName(timeless.select(*left.columns, *[F.lit(None).cast(kinds[c]).alias(f"{prefix}{c}") for c in carry]))
