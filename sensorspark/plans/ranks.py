"""Exact order statistics without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.columns import join_on
from sensorspark.plans.series import plan_layout, scan
from sensorspark.session import cut

ACCURACY = 100_000
MAX_VALUES = 200_000
# Rows of a group that may lie in its bracket before it is narrowed further.
IN_BRACKET = 100_000
GRID = 1_000
MAX_BROADCAST_GROUPS = 200_000


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, name: str = "quantile"
) -> DataFrame:
    """Linear-interpolated quantile per key, plus the number of values as ``n``.

    A mergeable sketch brackets the wanted rank of every group, everything below the bracket
    is only counted, and only the few distinct values inside it are ranked.  Where a group is
    so large that many rows may lie inside, the brackets of all such groups are narrowed
    together, round by round, until none holds more than ``IN_BRACKET`` rows that differ
    from its ends.
    """
    rows = df.select(*keys, F.col(value).alias("__v")).filter(F.col("__v").isNotNull())
    slack = 2.0 / ACCURACY
    bounds = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("__v", max(0.0, q - slack), ACCURACY).alias("__lo"),
        F.percentile_approx("__v", min(1.0, q + slack), ACCURACY).alias("__hi"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
    )
    # A sketch of few values rounds its ranks, so widen short groups to everything.
    short = F.col("n") <= ACCURACY
    bounds = bounds.select(
        *keys,
        "n",
        F.when(short, F.col("__min")).otherwise(F.col("__lo")).alias("__lo"),
        F.when(short, F.col("__max")).otherwise(F.col("__hi")).alias("__hi"),
    )
    bounds = cut(bounds)
    groups = bounds.agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("most")).first()
    small = groups["n"] <= MAX_BROADCAST_GROUPS
    # The sketch is off by a share of the rows: only groups above this may have wide brackets.
    if (groups["most"] or 0) * 3 * slack > IN_BRACKET:
        bounds = _narrowed(rows, bounds, keys, q, small)
    return _at_ranks(rows, bounds, keys, q, name, small)


def weighted_quantile(
    counts: DataFrame, keys: Sequence[str], value: str, weight: str, q: float, name: str = "quantile"
) -> DataFrame:
    """:func:`exact_quantile` of whole numbers that are given once each with their number.

    ``counts`` has one row per key and value, and is read several times.  Running totals come
    from an ordered scan, so the values of a key are not ranked in one task.
    """
    rows = counts.select(*keys, F.col(value).cast("long").alias("__v"), F.col(weight).alias("__w"))
    lay = plan_layout(rows, keys, "__v", first_width=1 << 40)
    upto = lay.detach(scan(rows, lay, total={"__upto": F.col("__w")}))
    tagged = join_on(upto, rows.groupBy(*keys).agg(F.sum("__w").alias("n")), keys)
    at = F.lit(q) * (F.col("n") - 1)

    def pick(k: Column) -> Column:
        return F.max(F.when((F.col("__upto") > k) & (F.col("__upto") - F.col("__w") <= k), F.col("__v")))

    out = tagged.groupBy(*keys, "n").agg(pick(F.floor(at)).alias("__a"), pick(F.ceil(at)).alias("__b"))
    return out.select(*keys, (F.col("__a") + (F.col("__b") - F.col("__a")) * (at - F.floor(at))).alias(name), "n")


def _with_bounds(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Rows with the bounds of their group; rows stay where they are unless there are very many groups."""
    if not keys:
        return rows.join(F.broadcast(bounds))
    # A struct never is NULL, so the group of a NULL key meets its bounds as well.
    side = bounds.select(F.struct(*keys).alias("__k"), *[c for c in bounds.columns if c not in keys])
    return rows.withColumn("__k", F.struct(*keys)).join(F.broadcast(side) if small else side, "__k").drop("__k")


def _narrowed(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], q: float, small: bool) -> DataFrame:
    """``bounds`` with brackets that hold few rows strictly inside, or are one value.

    Each round counts the rows below, at and between the ends of every bracket, and takes
    a grid of quantiles of those between; all of it combines before the shuffle.
    """
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    k = F.floor(F.lit(q) * (F.col("n") - 1))
    grid = [i / GRID for i in range(GRID + 1)]
    done = None
    while True:
        inside = F.when((v > lo) & (v < hi), v)
        counted = cut(
            _with_bounds(rows, bounds.drop("__min", "__max"), keys, small)
            .groupBy(*keys, "n", "__lo", "__hi")
            .agg(
                F.count_if(v < lo).alias("__low"),
                F.count_if(v == lo).alias("__at_lo"),
                F.count(inside).alias("__mid"),
                F.percentile_approx(inside, grid, 20 * GRID).alias("__grid"),
            )
        )
        first = F.col("__low") + F.col("__at_lo")
        # The wanted rank among the rows between the ends, and the places around it on the grid.
        share = (k - first) / F.greatest(F.col("__mid"), F.lit(1)) * GRID
        at = lambda place: F.try_element_at("__grid", F.least(F.greatest(place, F.lit(1)), F.lit(GRID + 1)).cast("int"))
        between = (k >= first) & (k < first + F.col("__mid"))
        low = F.when(k < first, lo).when(between, at(F.floor(share) - 1 + 1)).otherwise(hi)
        high = F.when(k < first, lo).when(between, at(F.ceil(share) + 1 + 1)).otherwise(hi)
        wide = F.col("__mid") > IN_BRACKET
        ready = counted.filter(~wide).select(*keys, "n", "__lo", "__hi")
        done = ready if done is None else done.unionByName(ready)
        bounds = cut(counted.filter(wide).select(*keys, "n", low.alias("__lo"), high.alias("__hi")))
        if bounds.isEmpty():
            return done


def _at_ranks(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], q: float, name: str, small: bool) -> DataFrame:
    tagged = _with_bounds(rows, bounds, keys, small)
    counted = tagged.groupBy(
        *keys,
        "n",
        F.when(F.col("__v") < F.col("__lo"), F.lit(None))
        .when(F.col("__v") > F.col("__hi"), F.lit(None))
        .otherwise(F.col("__v"))
        .alias("__v"),
        (F.col("__v") < F.col("__lo")).alias("__below"),
    ).agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__least"))
    # Values above the bracket sort last, those below it first; of those above the least may be wanted.
    rank = (
        Window.partitionBy(*keys)
        .orderBy(F.col("__below").desc(), F.col("__v").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.withColumn("__upto", F.sum("__c").over(rank))
    at = F.lit(q) * (F.col("n") - 1)

    def pick(k: Column) -> Column:
        hit = (F.col("__upto") > k) & (F.col("__upto") - F.col("__c") <= k)
        above = F.when(~F.col("__below") & (F.col("__upto") - F.col("__c") == k), F.col("__least"))
        return F.max(F.when(hit, F.coalesce("__v", above).cast("double")))

    out = ranked.groupBy(*keys, "n").agg(pick(F.floor(at)).alias("__a"), pick(F.ceil(at)).alias("__b"))
    low, high = F.col("__a"), F.col("__b")
    frac = at - F.floor(at)
    checked = F.when(
        low.isNull() | high.isNull(), F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    ).otherwise(low + (high - low) * frac)
    return out.select(*keys, checked.alias(name), "n")


def _value_at(rows: DataFrame, column: str, k: int, n: int):
    """The value of ``column`` at 0-based rank ``k`` of ``n`` rows and how many are below it.

    A sketch narrows the range until few rows are left between its ends; copies of the ends
    are only counted, so ties of any size cost nothing, and no distinct values are shuffled
    before there are few.
    """
    below, inside = 0, rows.select(column)
    while True:
        if n <= MAX_VALUES:
            counts = inside.groupBy(column).count().collect()
            for value, c in sorted(counts):
                if below + c > k:
                    return value, below
                below += c
            raise ValueError(f"rank {k} is beyond the {n} rows")
        q, slack = (k - below) / n, 2.0 / ACCURACY
        ends = [max(0.0, q - slack), min(1.0, q + slack)]
        lo, hi = inside.select(F.percentile_approx(column, ends, ACCURACY).alias("b")).first()["b"]
        c = F.col(column)
        part = inside.agg(
            F.count_if(c < lo).alias("low"),
            F.count_if(c == lo).alias("at_lo"),
            F.count_if((c > lo) & (c < hi)).alias("mid"),
            F.count_if((c == hi) & (c > lo)).alias("at_hi"),
        ).first()
        below += part["low"]
        if not below <= k < below + part["at_lo"] + part["mid"] + part["at_hi"]:
            raise ValueError(f"the sketch missed rank {k}")
        if k < below + part["at_lo"]:
            return lo, below
        below += part["at_lo"]
        if k >= below + part["mid"]:
            return hi, below + part["mid"]
        inside, n = inside.filter((c > lo) & (c < hi)), part["mid"]


def order_statistic(df: DataFrame, order: Sequence[str], k: int, n: int) -> tuple:
    """The numeric ``order`` columns of the row at 0-based rank ``k`` of ``n`` rows.

    Returns a tuple of driver values.  Each column is settled in turn, among the rows that
    tie on the ones before it; nothing is sorted.
    """
    found: list = []
    rows = df.select(*order)
    for c in order:
        value, below = _value_at(rows, c, k, n)
        found.append(value)
        rows = rows.filter(F.col(c) == value)
        k, n = k - below, rows.count()
    return tuple(found)
