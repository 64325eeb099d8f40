"""Row-count windows, their validity, resampling and subsampling.

Windows are numbered from row positions, which one ordered scan provides.  Whether
a trailing window contains a bad step needs no frame at all: it is valid when the
last bad step lies before it, for any window length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.columns import MICROS, join_on, micros
from sensorspark.plans.series import explode_range, plan_layout, scan, with_halo
from sensorspark.session import cut

AXIS = "__us"
# Columns of prepared rows: position and length of the series, ends of the run of ticks.
POS, SIZE, BEGIN, END = "__pos", "__n", "__begin", "__end"

# The encoder's trained range of window lengths.
MIN_WINDOW, MAX_WINDOW = 16, 1024


def _check_sizes(window_size: int, step: int = 1) -> None:
    if window_size < 1 or step < 1:
        raise ValueError(f"window_size and step must be positive, got {window_size} and {step}")


def positions(
    df: DataFrame, timestamp: str, keys: Sequence[str] = (), ties: Sequence[str] = (), *, pos: str = "pos", size: str = "n"
) -> DataFrame:
    """Add the 0-based position in the series and the series length."""
    taken = {pos, size} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} already exist")
    rows = df.withColumn(AXIS, micros(df, timestamp))
    lay = plan_layout(rows, keys, AXIS, ties)
    return lay.detach(scan(rows, lay, pos=pos, size=size)).drop(AXIS)


def window_at(
    df: DataFrame,
    timestamp: str,
    sensors: Sequence[str],
    start: int,
    window_size: int = MAX_WINDOW,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """The window of every series at row ``start``; an error when it runs past the end."""
    _check_sizes(window_size)
    rows = positions(df, timestamp, keys, ties, pos="__pos", size="__n")
    if not rows.filter((F.col("__pos") == 0) & (F.col("__n") < start + window_size)).isEmpty():
        raise ValueError(f"window [{start}:{start + window_size}] out of range")
    inside = rows.filter((F.col("__pos") >= start) & (F.col("__pos") < start + window_size))
    out = collect_windows(inside.withColumn("window_id", F.lit(0).cast("long")), [*keys, "window_id"], "__pos", sensors)
    return out.drop("window_id")


def collect_windows(df: DataFrame, by: Sequence[str], order: str, sensors: Sequence[str]) -> DataFrame:
    """One row per window with ``values``: a map from sensor to its ordered samples."""
    cells = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), *[F.col(s) for s in sensors])))
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), cells.alias("__cells"))
    pairs = []
    for s in sensors:
        pairs += [F.lit(s), F.col("__cells")[s].cast("array<double>")]
    return out.withColumn("values", F.create_map(*pairs)).drop("__cells")


def prepare_sliding(df: DataFrame, timestamp: str, keys: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """The rows with their positions, written once; ``sliding`` takes them for any window length and step."""
    return cut(positions(df, timestamp, keys, ties, pos=POS, size=SIZE))


def sliding(
    df: DataFrame,
    timestamp: str,
    window_size: int,
    step: int = 1,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Rows tagged with every full window that covers them: ``window_id`` and ``in_window``.

    A row belongs to at most ``ceil(window_size / step)`` windows, and to exactly one
    when the windows do not overlap.  Windows never look at time gaps.  Rows that
    ``prepare_sliding`` has seen are not ordered again.
    """
    _check_sizes(window_size, step)
    rows = df if POS in df.columns else positions(df, timestamp, keys, ties, pos=POS, size=SIZE)
    pos = F.col(POS)
    first = F.greatest(F.lit(0), F.ceil((pos - window_size + 1) / step))
    last = F.least(F.floor(pos / step), F.floor((F.col(SIZE) - window_size) / step))
    if step >= window_size:
        ids = rows.withColumn("window_id", F.floor(pos / step))
        ids = ids.filter((F.col("window_id") <= last) & (pos < F.col("window_id") * step + window_size))
    else:
        covering = F.when(first <= last, F.sequence(first, last))
        ids = rows.withColumn("window_id", F.explode(covering))
    return ids.withColumn("in_window", pos - F.col("window_id") * step).drop(POS, SIZE)


def window_spans(df: DataFrame, timestamp: str, keys: Sequence[str] = ()) -> DataFrame:
    """Start and finish instants of tagged windows; the finish is the last row's time."""
    us = micros(df, timestamp)
    return df.groupBy(*keys, "window_id").agg(
        F.min(us).alias("start_us"), F.max(us).alias("finish_us"), F.count(F.lit(1)).alias("n_rows")
    )


def window_bounds(
    df: DataFrame, timestamp: str, window_size: int, step: int = 1, keys: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Start and finish instants of the full windows of every series, without a copy of any row.

    A window is known by two rows, its first and its last; the two meet by their number.
    """
    _check_sizes(window_size, step)
    us = micros(df, timestamp)
    placed = positions(df.select(*keys, timestamp, *ties), timestamp, keys, ties, pos="__pos", size="__n")
    placed = placed.select(F.struct(*keys).alias("__key") if keys else F.lit(0).alias("__key"), "__pos", "__n", us.alias("us"))
    full = F.floor((F.col("__n") - window_size) / step)
    begins = placed.filter((F.col("__pos") % step == 0) & (F.col("__pos") / step <= full))
    begins = begins.select("__key", F.floor(F.col("__pos") / step).alias("window_id"), F.col("us").alias("start_us"))
    last = F.col("__pos") - (window_size - 1)
    ends = placed.filter((last >= 0) & (last % step == 0)).select("__key", F.floor(last / step).alias("window_id"), F.col("us").alias("finish_us"))
    out = begins.join(ends, ["__key", "window_id"])
    return out.select(*[F.col("__key")[k].alias(k) for k in keys], "window_id", "start_us", "finish_us")


def _tick_runs(df: DataFrame, tick: str, keys: Sequence[str], step: int) -> DataFrame:
    """The rows with the first and the last tick of their run of consecutive ticks."""
    rows = df.withColumn("__t", F.col(tick).cast("long"))
    # Cells should cover as many ticks per row as other axes cover microseconds.
    lay = plan_layout(rows, keys, "__t", first_width=1 << 22)
    seen = scan(lay.place(rows), lay, lag={"__pt": F.col("__t")}, lead={"__nt": F.col("__t")})
    breaks = F.coalesce(F.col("__t") - F.col("__pt") != step, F.lit(True))
    ends = F.coalesce(F.col("__nt") - F.col("__t") != step, F.lit(True))
    runs = scan(
        seen.withColumns({"__new": breaks, "__last": ends}),
        lay,
        upto={"__from": F.when(F.col("__new"), F.col("__t"))},
        onward={"__to": F.when(F.col("__last"), F.col("__t"))},
        at=False,
    )
    found = [F.col("__from")["v"].alias(BEGIN), F.col("__to")["v"].alias(END)]
    return lay.detach(runs).select(*df.columns, *found)


def prepare_contiguous(df: DataFrame, tick: str, keys: Sequence[str] = (), *, step: int = 1) -> DataFrame:
    """The rows with the ends of their runs of ticks, written once; ``contiguous`` takes them for any window length."""
    return cut(_tick_runs(df, tick, keys, step))


def contiguous(
    df: DataFrame,
    tick: str,
    window_size: int,
    keys: Sequence[str] = (),
    *,
    step: int = 1,
) -> DataFrame:
    """Back-to-back full windows inside runs of consecutive integer ticks.

    Returns the rows of complete windows tagged with ``window_start`` (the tick the
    window starts at) and ``in_window``.  After a jump the windows restart at the first
    row behind it.  Ticks must be strictly increasing per series.  Rows that
    ``prepare_contiguous`` has seen, with the same step, are not ordered again.
    """
    _check_sizes(window_size)
    runs = df if BEGIN in df.columns else _tick_runs(df, tick, keys, step)
    begin, end = F.col(BEGIN), F.col(END)
    index = F.floor((F.col(tick).cast("long") - begin) / F.lit(step))
    start = begin + F.floor(index / window_size) * (window_size * step)
    out = runs.withColumns({"window_start": start, "in_window": F.pmod(index, F.lit(window_size))})
    return out.filter(F.col("window_start") + (window_size - 1) * step <= end).drop(BEGIN, END)


def validity(
    df: DataFrame,
    timestamp: str,
    window_size: int,
    keys: Sequence[str] = (),
    *,
    source_order: str,
    expected_s: float | None = None,
    tolerance: float | None = 0.05,
    max_gap_s: float | None = 60.0,
    monotonic: bool = True,
) -> DataFrame:
    """Validity of the trailing window that ends at each row, in source order.

    Flags ``backwards`` (a step back or a repeat, which marks a seam between
    concatenated segments), ``off_rate`` and ``gap``; ``invalid`` is any of them.
    Rows with fewer than ``window_size - 1`` rows before them have no window.
    """
    _check_sizes(window_size)
    rows = df.withColumns({"__o": F.col(source_order).cast("long"), AXIS: micros(df, timestamp)})
    lay = plan_layout(rows, keys, "__o", first_width=1 << 40)
    seen = scan(lay.place(rows), lay, lag={"__pt": F.col(AXIS)})
    step = (F.col(AXIS) - F.col("__pt")) / MICROS
    rules: dict[str, Column] = {"backwards": step <= 0}
    if expected_s is not None and tolerance is not None:
        rules["off_rate"] = F.abs(step / expected_s - 1) > tolerance
    if max_gap_s is not None:
        rules["gap"] = step > max_gap_s
    marked = scan(
        seen,
        lay,
        pos="pos",
        upto={f"__{name}": F.when(rule, F.lit(True)) for name, rule in rules.items()},
    )
    inside = {
        name: F.coalesce(F.col(f"__{name}")["at"] > F.col("pos") - window_size + 1, F.lit(False)) for name in rules
    }
    out = marked.filter(F.col("pos") >= window_size - 1).withColumns(inside)
    invalid = F.lit(False)
    for name in rules:
        if name != "backwards" or monotonic:
            invalid = invalid | F.col(name)
    return (
        lay.detach(out.withColumn("invalid", invalid))
        .withColumn("finish_us", F.col(AXIS))
        .select(*df.columns, "pos", "finish_us", *rules, "invalid")
    )


def trailing_counts(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    window_size: int,
    counts: Mapping[str, Column],
) -> DataFrame:
    """Sums over the trailing ``window_size`` rows, clipped at the start of the series."""
    _check_sizes(window_size)
    haloed, part, lent = with_halo(df, keys, pos, window_size - 1)
    frame = Window.partitionBy(*part).orderBy(pos).rowsBetween(-(window_size - 1), 0)
    summed = haloed.withColumns({name: F.sum(e).over(frame) for name, e in counts.items()})
    return summed.filter(~F.col(lent)).drop(lent, "__slot")


def resample(
    df: DataFrame,
    timestamp: str,
    sensors: Sequence[str],
    interval_s: float,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Linear interpolation on the regular grid of multiples of ``interval_s``.

    Every row produces the grid points between itself and the next row, so no grid is
    built for a whole series.  Points outside a sensor's first and last value are NULL.
    """
    step = int(round(interval_s * MICROS))
    rows = df.select(*keys, *ties, *sensors, micros(df, timestamp).alias(AXIS))
    lay = plan_layout(rows, keys, AXIS, ties)
    value = {s: F.when(F.col(s).isNotNull(), F.struct(F.col(s).alias("x"), F.col(AXIS).alias("t"))) for s in sensors}
    seen = scan(
        rows,
        lay,
        lead={"__nt": F.col(AXIS)},
        upto={f"__b{i}": value[s] for i, s in enumerate(sensors)},
        after={f"__a{i}": value[s] for i, s in enumerate(sensors)},
        at=False,
    )
    first = F.ceil(F.col(AXIS) / step).cast("long")
    last = F.coalesce(F.ceil(F.col("__nt") / step).cast("long") - 1, F.floor(F.col(AXIS) / step).cast("long"))
    grid = explode_range(seen, "__k", first, last).withColumn("grid_us", F.col("__k") * step)
    out = {}
    for i, s in enumerate(sensors):
        b, a = F.col(f"__b{i}")["v"], F.col(f"__a{i}")["v"]
        share = (F.col("grid_us") - b["t"]) / (a["t"] - b["t"])
        out[s] = F.when(F.col("grid_us") == b["t"], b["x"]).otherwise(b["x"] + (a["x"] - b["x"]) * share)
    return grid.select(*keys, "grid_us", *[e.alias(s) for s, e in out.items()])


def fit_series(
    df: DataFrame, timestamp: str, value: str, keys: Sequence[str] = (), ties: Sequence[str] = (), *,
    shortest: int = MIN_WINDOW, longest: int = MAX_WINDOW,
) -> DataFrame:
    """Every series fitted to the encoder as ``samples, n`` and the columns of :func:`fit_length`.

    Only the newest ``longest`` samples can stay, so earlier ones are counted and not collected:
    a series of any length is an array of bounded size.
    """
    placed = positions(df.select(*keys, timestamp, *ties, value), timestamp, keys, ties, pos=POS, size=SIZE)
    recent = placed.filter(F.col(POS) >= F.col(SIZE) - longest)
    cells = F.array_sort(F.collect_list(F.struct(POS, F.col(value).cast("double").alias("v"))))
    arrays = recent.groupBy(*keys).agg(cells["v"].alias("samples"), F.max(SIZE).alias("n"))
    return fit_length(arrays, "samples", length="n", shortest=shortest, longest=longest)


def fit_length(
    df: DataFrame, values: str, *, length: str | None = None, shortest: int = MIN_WINDOW, longest: int = MAX_WINDOW
) -> DataFrame:
    """Fit sample arrays to the encoder: the last ``longest`` samples, zero padded with a mask.

    ``length`` names the whole length where an array holds the newest samples only.
    """
    held = F.size(values)
    n = F.col(length).cast("int") if length else held
    kept = F.when(held > longest, F.slice(values, -longest, longest)).otherwise(F.col(values))
    pad = F.greatest(F.lit(0), F.lit(longest) - n)
    notes = F.array(
        F.when(n < shortest, F.lit(f"shorter than {shortest} samples")),
        F.when((n >= shortest) & (n < longest), F.lit(f"padded to {longest} samples")),
        F.when(n > longest, F.lit(f"truncated to the last {longest} samples")),
    )
    return df.withColumns(
        {
            "fitted": F.concat(kept, F.array_repeat(F.lit(0.0), pad)),
            "mask": F.concat(
                F.array_repeat(F.lit(True), F.least(n, F.lit(longest))), F.array_repeat(F.lit(False), pad)
            ),
            "warnings": F.filter(notes, lambda w: w.isNotNull()),
        }
    )


def even_subsample(df: DataFrame, order: str, target: int, keys: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """``target`` rows spread evenly over each series, all rows when there are no more.

    The kept positions are ``i * (n - 1) / (target - 1)`` rounded half to even; each row
    tests the two ``i`` next to it, so nothing is joined.
    """
    if target < 1:
        raise ValueError(f"target must be positive, got {target}")
    rows = positions(df, order, keys, ties, pos="__pos", size="__n")
    if target == 1:
        return rows.filter(F.col("__pos") == 0).drop("__pos", "__n")
    pace = (F.col("__n") - 1) / F.lit(target - 1)
    near = F.floor(F.col("__pos") / pace)
    hit = F.lit(False)
    for shift in (-1, 0, 1):
        i = near + shift
        hit = hit | ((i >= 0) & (i < target) & (F.bround(i * pace) == F.col("__pos")))
    return rows.filter((F.col("__n") <= target) | hit).drop("__pos", "__n")


def sample_frames(df: DataFrame, frame: str, clip: Sequence[str], max_frames: int = 32) -> DataFrame:
    """At most ``max_frames`` (limit 64) frame rows spread evenly over each clip."""
    if not 1 <= max_frames <= 64:
        raise ValueError(f"max_frames must be in 1..64, got {max_frames}")
    return even_subsample(df, frame, max_frames, clip)


def snapshots(df: DataFrame, timestamp: str, sensors: Sequence[str], width: str, keys: Sequence[str] = ()) -> DataFrame:
    """Fixed-interval summaries, each also serialised to a JSON ``document`` for a model."""
    w = F.window(F.col(timestamp).cast("timestamp"), width)
    stats = []
    for s in sensors:
        stats.append(
            F.struct(
                F.count(s).alias("n"), F.round(F.avg(s), 6).alias("mean"), F.min(s).alias("min"), F.max(s).alias("max")
            ).alias(s)
        )
    out = df.groupBy(*keys, w.alias("__w")).agg(F.count(F.lit(1)).alias("n_rows"), *stats)
    return out.select(
        *keys,
        F.unix_micros(F.col("__w")["start"]).alias("start_us"),
        F.unix_micros(F.col("__w")["end"]).alias("end_us"),
        "n_rows",
        F.to_json(F.struct(*sensors)).alias("document"),
    )


def plan_chunks(
    keyframes: DataFrame, clip: str, at: str, *, chunk_s: float = 90.0, overlap_s: float = 15.0
) -> DataFrame:
    """Chunks of long recordings, cut on keyframes and stepped from each actual start.

    A chunk starts at the last keyframe at or before the previous start plus
    ``chunk_s - overlap_s``; without such a keyframe it starts at the next one.  Every keyframe
    gets a pointer to the start that would follow it, by an as-of lookup; the starts that are
    really reached are found by doubling: pointers of 1, 2, 4, .. steps take the known starts
    on, so a recording of any length is cut in a logarithmic number of joins.
    """
    stride = chunk_s - overlap_s
    clips = [clip]
    frames = keyframes.select(clip, F.col(at).cast("double").alias("__t")).filter(F.col("__t").isNotNull()).distinct()
    axis = lambda t: F.floor(t * MICROS).cast("long").alias(AXIS)
    known = frames.select(clip, axis(F.col("__t")), "__t", F.lit(0).alias("__side"), F.col("__t").alias("__frame"))
    asks = frames.select(
        clip, axis(F.col("__t") + stride), (F.col("__t") + stride).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast("double").alias("__frame"),
        F.col("__t").alias("__from"),
    )
    both = known.unionByName(asks, allowMissingColumns=True)
    lay = plan_layout(both, clips, AXIS, ["__t", "__side"])
    frame = F.col("__frame")
    seen = lay.detach(scan(both, lay, upto={"__last": frame}, after={"__next": frame}, at=False)).filter("__side = 1")
    last, following = F.col("__last")["v"], F.col("__next")["v"]
    # Nothing follows where no keyframe lies beyond the stride.
    target = F.when(following.isNull(), F.lit(None)).when(last > F.col("__from"), last).otherwise(following)
    jumps = cut(seen.select(clip, "__from", target.alias("__to")).filter(F.col("__to").isNotNull()))
    starts = cut(frames.groupBy(clip).agg(F.min("__t").alias("__from")).withColumn("chunk", F.lit(0).cast("long")))
    length = 1
    while not jumps.isEmpty():
        reached = join_on(starts, jumps, [clip, "__from"]).select(clip, F.col("__to").alias("__from"), (F.col("chunk") + length).alias("chunk"))
        starts = cut(starts.unionByName(reached))
        onward = jumps.select(clip, F.col("__from").alias("__to"), F.col("__to").alias("__end"))
        jumps = cut(join_on(jumps, onward, [clip, "__to"]).select(clip, "__from", F.col("__end").alias("__to")))
        length *= 2
    return starts.select(clip, "chunk", F.col("__from").alias("start_s"), (F.col("__from") + chunk_s).alias("end_s"))
