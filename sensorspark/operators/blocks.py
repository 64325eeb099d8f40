"""Gap-aware blocks and imputation.

A row is bad when any sensor lies in a run of missing values longer than the
threshold; good rows between bad ones form a block.  Runs, blocks and neighbours
all reduce to row positions: one scan finds, for every sensor, the nearest present
value strictly before and after each row, and a second one numbers the blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.columns import DEFAULT_NON_SENSOR, MICROS, drop_sensors, micros, nan_to_null, sensor_columns
from sensorspark.plans.series import plan_layout, scan

AXIS = "__us"
METHODS = ("linear", "time", "ffill", "bfill")


def build(
    df: DataFrame,
    timestamp: str = "timestamp",
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    *,
    gap_threshold: int = 5,
    drop: Iterable[str] = (),
    method: str = "linear",
    sensors: Sequence[str] | None = None,
    non_sensor: Iterable[str] = DEFAULT_NON_SENSOR,
    max_time_gap_s: float | None = None,
) -> DataFrame:
    """Drop rows in long gaps, number the blocks from 1 and fill short gaps inside them.

    Adds ``block_id``, ``imputed`` (some sensor was missing) and ``still_null`` (some
    sensor has no value anywhere in its block).  A jump in time alone does not split a
    block unless ``max_time_gap_s`` is given.
    """
    if method not in METHODS:
        raise ValueError(f"method {method!r} is not one of {METHODS}")
    rows = drop_sensors(df, drop)
    cols = list(sensors) if sensors is not None else sensor_columns(rows, timestamp, (*keys, *ties), non_sensor)
    rows = nan_to_null(rows, cols).withColumn(AXIS, micros(rows, timestamp))
    rows = rows.filter(F.col(AXIS).isNotNull())
    lay = plan_layout(rows, keys, AXIS, ties)

    # Pass 1: nearest present values around each row.
    timed = {c: F.expr(f"if(`{c}` is null, null, {AXIS})") for c in cols} if method == "time" else {}
    seen = scan(
        lay.place(rows),
        lay,
        pos="__pos",
        size="__n",
        lag={"__pt": F.col(AXIS)} if max_time_gap_s is not None else {},
        lead={"__nt": F.col(AXIS)} if max_time_gap_s is not None else {},
        before={f"__b{i}": F.col(c) for i, c in enumerate(cols)} | {f"__bt{i}": timed[c] for i, c in enumerate(timed)},
        after={f"__a{i}": F.col(c) for i, c in enumerate(cols)} | {f"__at{i}": timed[c] for i, c in enumerate(timed)},
    )
    last = [f"coalesce(__b{i}.at, -1)" for i in range(len(cols))]
    nxt = [f"coalesce(__a{i}.at, __n)" for i in range(len(cols))]
    long_run = _any(f"`{c}` is null and {nxt[i]} - {last[i]} - 1 > {gap_threshold}" for i, c in enumerate(cols))
    # The row before (after) a good row is bad when a long run ends (starts) there.
    first = _any([
        "__pos = 0", *(f"`{c}` is not null and __pos - {last[i]} - 1 > {gap_threshold}" for i, c in enumerate(cols))
    ])
    final = _any([
        "__pos = __n - 1", *(f"`{c}` is not null and {nxt[i]} - __pos - 1 > {gap_threshold}" for i, c in enumerate(cols))
    ])
    if max_time_gap_s is not None:
        limit = int(max_time_gap_s * MICROS)
        first = f"({first} or coalesce({AXIS} - __pt > {limit}, false))"
        final = f"({final} or coalesce(__nt - {AXIS} > {limit}, false))"
    # From here on only missing cells need their neighbours.
    owner = {f"{side}{i}": c for i, c in enumerate(cols) for side in ("__a", "__b", "__at", "__bt")}
    slim = [f"if(`{owner[c]}` is null, {c}, null) as {c}" if c in owner else f"`{c}`" for c in seen.columns]
    good = seen.filter(f"not {long_run}").selectExpr(*slim, f"{first} as __first", f"{final} as __final")

    # Pass 2: number the blocks and find where each begins and ends.
    blocks = scan(
        good.drop("__pt", "__nt"),
        lay,
        total={"block_id": F.col("__first").cast("long")},
        upto={"__from": F.when(F.col("__first"), F.col("__pos"))},
        onward={"__to": F.when(F.col("__final"), F.col("__pos"))},
    )
    filled = {c: f"coalesce(`{c}`, {_fill(method, i)})" for i, c in enumerate(cols)}
    out = [f"{filled[c]} as `{c}`" if c in filled else f"`{c}`" for c in rows.columns if c != AXIS]
    missing_now = _any(f"`{c}` is null" for c in cols)
    missing_still = _any(f"{e} is null" for e in filled.values())
    return blocks.selectExpr(*out, "block_id", f"{missing_now} as imputed", f"{missing_still} as still_null")


def _any(flags: Iterable[str]) -> str:
    listed = [f"({f})" for f in flags]
    return f"({' or '.join(listed)})" if listed else "false"


def _fill(method: str, i: int) -> str:
    """SQL for the value of sensor ``i`` in a gap; only neighbours in the row's block count."""
    low = f"if(__b{i}.at >= __from.v, __b{i}.v, null)"
    high = f"if(__a{i}.at <= __to.v, __a{i}.v, null)"
    if method == "ffill":
        return f"{low}, {high}"
    if method == "bfill":
        return f"{high}, {low}"
    if method == "linear":
        share = f"(__pos - __b{i}.at) / (__a{i}.at - __b{i}.at)"
    else:
        share = f"try_divide({AXIS} - __bt{i}.v, __at{i}.v - __bt{i}.v)"
    return f"{low} + ({high} - {low}) * {share}, {low}, {high}"


def segment_on_time(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), ties: Sequence[str] = (), *, max_gap_s: float
) -> DataFrame:
    """Number segments split where time jumps by more than ``max_gap_s`` or repeats."""
    rows = df.withColumn(AXIS, micros(df, timestamp))
    lay = plan_layout(rows, keys, AXIS, ties)
    seen = scan(lay.place(rows), lay, lag={"__pt": F.col(AXIS)})
    step = F.col(AXIS) - F.col("__pt")
    fresh = F.coalesce((step > int(max_gap_s * MICROS)) | (step <= 0), F.lit(True))
    out = scan(seen.withColumn("__new", fresh), lay, total={"segment_id": F.col("__new").cast("long")})
    return lay.detach(out).drop(AXIS, "__pt", "__new")


def repair_windows(
    df: DataFrame, window_keys: Sequence[str], pos: str, sensors: Sequence[str], *, max_gap: int = 16
) -> DataFrame:
    """Fill gaps of at most ``max_gap`` samples inside each window, linearly by position.

    ``window_keys`` identify one window, whose length is bounded by construction.
    """
    fwd = Window.partitionBy(*window_keys).orderBy(pos)
    rev = Window.partitionBy(*window_keys).orderBy(F.col(pos).desc())
    rows = nan_to_null(df, sensors)
    near: dict[str, Column] = {}
    for i, c in enumerate(sensors):
        here = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("x"), F.col(pos).alias("p")))
        near[f"__b{i}"] = F.last(here, ignorenulls=True).over(fwd)
        near[f"__a{i}"] = F.last(here, ignorenulls=True).over(rev)
    rows = rows.withColumns(near)
    filled = {}
    for i, c in enumerate(sensors):
        b, a = F.col(f"__b{i}"), F.col(f"__a{i}")
        short = a["p"] - b["p"] - 1 <= max_gap
        between = b["x"] + (a["x"] - b["x"]) * (F.col(pos) - b["p"]) / (a["p"] - b["p"])
        filled[c] = F.coalesce(F.col(c), F.when(short, between))
    return rows.withColumns(filled).drop(*near)


def limit_values(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Clip sensors to ``(low, high)``; an open side is None and missing values stay missing."""
    out = {}
    for c, (low, high) in bounds.items():
        e = F.col(c)
        if low is not None:
            e = F.when(e < low, F.lit(low)).otherwise(e)
        if high is not None:
            e = F.when(e > high, F.lit(high)).otherwise(e)
        out[c] = e
    return df.withColumns(out)


def incident_slices(
    df: DataFrame, timestamp: str, fault: Column, context: int, keys: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Fault episodes with up to ``context`` normal rows on either side, numbered per series.

    A normal row between two episodes belongs to the nearer one, the earlier on a tie, so
    no row is used twice.
    """
    rows = df.withColumns({AXIS: micros(df, timestamp), "__f": F.coalesce(fault, F.lit(False))})
    lay = plan_layout(rows, keys, AXIS, ties)
    mark = F.when(F.col("__f"), F.lit(True))
    seen = scan(lay.place(rows), lay, pos="__pos", lag={"__pf": F.col("__f")}, upto={"__b": mark}, onward={"__a": mark})
    begins = (F.col("__f") & ~F.coalesce(F.col("__pf"), F.lit(False))).cast("long")
    numbered = scan(seen.withColumn("__new", begins), lay, total={"__k": F.col("__new")})
    back, ahead = F.col("__pos") - F.col("__b")["at"], F.col("__a")["at"] - F.col("__pos")
    to_last = back.isNotNull() & (back <= context) & (ahead.isNull() | (back <= ahead))
    to_next = ahead.isNotNull() & (ahead <= context)
    number = F.when(to_last, F.col("__k")).when(to_next, F.col("__k") + 1)
    out = numbered.withColumns({"slice_id": number, "in_episode": F.col("__f")}).filter(F.col("slice_id").isNotNull())
    return lay.detach(out).select(*df.columns, "slice_id", "in_episode")
