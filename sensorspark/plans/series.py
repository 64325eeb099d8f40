"""Ordered scans that never put one series into one task.

A row-by-row operator over a series (lag, running sum, carry-forward, position)
normally needs ``Window.partitionBy(series)``, which places a whole series in one
task.  One series may hold a third of a 100 TB table, so the work is cut along the
axis instead:

1. every row gets a *chunk*: the start of its axis cell.  Cells that hold too many
   rows are divided into finer cells, level by level, down to single instants and
   then by the tie column, so neither a hot series nor a burst overloads a task;
2. each chunk is reduced to one summary row without sorting it: counts, sums, and the
   values at the first and the last row by ``min_by`` and ``max_by`` over the order
   columns.  These combine before the shuffle, so no row moves for the summary;
3. a window over the summaries, about a million times fewer rows than the data, yields
   what each chunk inherits from its neighbours;
4. window functions run inside ``(series, chunk)``, where rows are shuffled and sorted
   for the only time, and the inherited values are joined on ``(series, chunk)``.

A scan over the result of another has no source to summarise, so operators that chain
scans *place* their rows first: rows are shuffled and sorted once and written in that
order to the shared checkpoint folder, and every scan over them runs where they lie.

Chunks depend only on the data, so a recomputed task produces the same rows.  Rows alike
in axis and ties are ordered by a hash of what the scan reads, so the summary and the
scan agree on their order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.session import cut, cut_in_order

DAY = 86_400_000_000
FIRST_WIDTH = 32 * DAY
FINER_BY = 64
TARGET_ROWS = 1_000_000
# Rows of a partition when rows are placed.
PLACED_ROWS = 1_000_000
MAX_BROADCAST_CELLS = 200_000

CHUNK, SUB, KEY, ROW_HASH = "__chunk", "__sub", "__key", "__hash"


def _cell(axis: str, width: int) -> Column:
    return F.col(axis) - F.pmod(F.col(axis), F.lit(width))


def _names(columns: Sequence[str], direction: str = "") -> str:
    return ", ".join(f"`{c}` {direction}".strip() for c in columns)


@dataclass(frozen=True)
class Layout:
    """How the rows of one table are cut: series keys, integer axis, tie columns.

    ``levels`` lists the hot cells of each width as ``(width, table, rows)``;
    the list is empty for a table without hot cells, and ``counts`` then holds the
    number of rows per chunk.
    """

    keys: tuple[str, ...]
    axis: str
    ties: tuple[str, ...] = ()
    first_width: int = FIRST_WIDTH
    levels: tuple[tuple[int, DataFrame, int], ...] = ()
    splits_ties: bool = False
    counts: DataFrame | None = None
    n_rows: int = 0

    @property
    def chunk_columns(self) -> list[str]:
        return [CHUNK, SUB] if self.splits_ties else [CHUNK]

    @property
    def partition(self) -> list[str]:
        # The keys as one struct: it never is NULL, so a NULL key joins like any other.
        return [*([KEY] if self.keys else []), *self.chunk_columns]

    def keyed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(KEY, F.struct(*self.keys)) if self.keys and KEY not in df.columns else df

    @property
    def order(self) -> list[str]:
        return [self.axis, *self.ties]

    @property
    def _by_cell(self) -> list[str]:
        return [*([KEY] if self.keys else []), CHUNK]

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the chunk columns unless an earlier scan already did.

        Rows without an axis value have no place in the order and are left out.  A NULL
        series key is a key like any other.
        """
        if CHUNK in df.columns:
            return df
        out = self.keyed(df.filter(F.col(self.axis).isNotNull())).withColumn(CHUNK, _cell(self.axis, self.first_width))
        if self.splits_ties:
            out = out.withColumn(SUB, F.lit(0).cast("long"))
        width = self.first_width
        for width, cells, n in self.levels:
            side = F.broadcast(cells) if n <= MAX_BROADCAST_CELLS else cells
            out = out.join(side, self._by_cell, "left")
            if width == 1:
                out = out.withColumn(
                    SUB,
                    F.when(
                        F.col("__tie_width").isNotNull(),
                        F.floor((F.col(self.ties[0]) - F.col("__tie_low")) / F.col("__tie_width")),
                    ).otherwise(F.col(SUB)),
                ).drop("__tie_low", "__tie_width")
            else:
                finer = _cell(self.axis, max(1, width // FINER_BY))
                out = out.withColumn(CHUNK, F.when(F.col("__hot"), finer).otherwise(F.col(CHUNK)))
                out = out.drop("__hot")
        return out

    def place(self, df: DataFrame) -> DataFrame:
        """Attach the chunks, shuffle and sort once, and keep the rows in that order.

        For chains of scans.  The copy in the checkpoint folder keeps its partitioning and
        its order, so scans over it neither shuffle nor sort.
        """
        spark = df.sparkSession
        default = int(spark.conf.get("spark.sql.shuffle.partitions"))
        n = max(default, -(-self.n_rows // PLACED_ROWS))
        return cut_in_order(self.attach(df).repartition(n, *self.partition).sortWithinPartitions(*self.partition, *self.order))

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(CHUNK, SUB, KEY, ROW_HASH)


def plan_layout(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    ties: Sequence[str] = (),
    *,
    first_width: int = FIRST_WIDTH,
    target_rows: int = TARGET_ROWS,
) -> Layout:
    """Find the cells above ``target_rows`` by counting, level by level.

    The counts are combined on the map side over the key and axis columns only.
    There are at most ``rows / target_rows`` hot cells per level; beyond the
    broadcast limit they stay a table and are joined by shuffle.
    """
    keys, ties = tuple(keys), tuple(ties)
    spark = df.sparkSession
    rest = df.select(*keys, axis, *ties).filter(F.col(axis).isNotNull())
    rest = rest.withColumn(CHUNK, _cell(axis, first_width))
    by = [CHUNK]
    if keys:
        rest, by = rest.withColumn(KEY, F.struct(*keys)), [KEY, CHUNK]
    counts, n_rows = None, 0
    levels: list[tuple[int, DataFrame, int]] = []
    width, splits_ties = first_width, False
    while True:
        extra = []
        if width == 1:
            if not ties:
                break
            low, high = F.min(ties[0]), F.max(ties[0])
            parts = F.ceil(F.count(F.lit(1)) / F.lit(target_rows))
            extra = [
                low.cast("long").alias("__tie_low"),
                F.greatest(F.lit(1), F.ceil((high - low + 1) / parts)).cast("long").alias("__tie_width"),
            ]
        cells = rest.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *extra)
        if counts is None:
            counts = cells = cut(cells)
            n_rows = counts.agg(F.sum("__n")).first()[0] or 0
            if n_rows <= target_rows:
                break
        cells = cells.filter(F.col("__n") > target_rows).drop("__n")
        if not extra:
            cells = cells.withColumn("__hot", F.lit(True))
        found = cells.limit(MAX_BROADCAST_CELLS + 1).collect()
        if not found:
            break
        if len(found) <= MAX_BROADCAST_CELLS:
            table, n = spark.createDataFrame(found, cells.schema), len(found)
        else:
            table = cut(cells)
            n = table.count()
        levels.append((width, table, n))
        if width == 1:
            splits_ties = True
            break
        side = F.broadcast(table) if n <= MAX_BROADCAST_CELLS else table
        rest = rest.join(side.select(*by), by, "left_semi")
        width = max(1, width // FINER_BY)
        rest = rest.withColumn(CHUNK, _cell(axis, width))
    return Layout(keys, axis, ties, first_width, tuple(levels), splits_ties, None if levels else counts, n_rows)


def _packed(values: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"{e} as `{n}`" for n, e in values.items()) + ")"


def _summary(source: DataFrame, layout: Layout, order: Sequence[str], steps: Mapping[str, Sequence[str]], at: bool) -> DataFrame:
    """``(partition, __n, __last, __first)`` of the chunks of ``source``, whose rows are in no order.

    All aggregates combine before the shuffle.  The place of the last present value in its
    chunk is the number of rows less those after it, which a second look at the source
    counts once the order of that value is known.
    """
    key = f"struct({_names(order)})"
    ends = {
        "__last": ([*steps["lag"], *steps["total"]], steps["last"], "max"),
        "__first": ([*steps["lead"]], steps["first"], "min"),
    }
    aggs = [F.count(F.lit(1)).alias("__n")]
    for end, (edge, nearest, pick) in ends.items():
        values = {n: f"sum(`__e_{n}`)" if n in steps["total"] else f"{pick}_by(`__e_{n}`, {key})" for n in edge}
        values |= {n: f"{pick}_by(`__e_{n}`, {key}) filter (where `__e_{n}` is not null)" for n in nearest}
        if values:
            aggs.append(F.expr(_packed(values)).alias(end))
        if at:
            aggs += [F.expr(f"{pick}({key}) filter (where `__e_{n}` is not null)").alias(f"__k_{n}") for n in nearest]
    chunks = source.groupBy(*layout.partition).agg(*aggs)
    near = [n for _, nearest, _ in ends.values() for n in nearest]
    if not at or not near:
        return chunks
    chunks = cut(chunks)
    known = chunks.select(*layout.partition, *[f"`__k_{n}`" for n in near])
    side = F.broadcast(known) if chunks.count() <= MAX_BROADCAST_CELLS else known
    beyond = []
    for _, nearest, pick in ends.values():
        sign = ">" if pick == "max" else "<"
        beyond += [F.expr(f"count_if({key} {sign} `__k_{n}`)").alias(f"__o_{n}") for n in nearest]
    counted = source.select(*layout.partition, *order).join(side, layout.partition).groupBy(*layout.partition).agg(*beyond)
    out = ["__n"]
    for end, (edge, nearest, pick) in ends.items():
        values = {n: f"{end}.`{n}`" for n in (*edge, *nearest)}
        for n in nearest:
            place = f"__n - `__o_{n}`" if pick == "max" else f"`__o_{n}` + 1"
            values[f"@{n}"] = f"if(`__k_{n}` is null, null, {place})"
        if values:
            out.append(f"{_packed(values)} as {end}")
    return chunks.join(counted, layout.partition).selectExpr(*[f"`{c}`" for c in layout.partition], *out)


def scan(
    df: DataFrame,
    layout: Layout,
    *,
    pos: str | None = None,
    size: str | None = None,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    upto: Mapping[str, Column] | None = None,
    before: Mapping[str, Column] | None = None,
    onward: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    at: bool = True,
) -> DataFrame:
    """Add ordered columns to every row; each mapping is ``{new name: expression}``.

    ``pos``/``size`` are the 0-based position in the series and the series length.
    ``lag``/``lead`` read the neighbouring row and ``total`` is a running sum.
    ``upto``/``before`` give the last non-null value at or before / strictly before
    the row, ``onward``/``after`` the next one, each as ``struct<v, at>`` where
    ``at`` is the position it was found at and NULL when there is none.  Without ``at``
    the structs hold ``v`` alone and the source is read once less.  Totals should be of
    whole numbers or decimals, whose sums do not depend on the order.
    """
    lag, lead, total = dict(lag or {}), dict(lead or {}), dict(total or {})
    upto, before = dict(upto or {}), dict(before or {})
    onward, after = dict(onward or {}), dict(after or {})
    given = {**lag, **lead, **total, **upto, **before, **onward, **after}
    fresh = CHUNK not in df.columns
    rows = layout.attach(df)
    kept = [c for c in rows.columns if c not in given and c not in (pos, size, ROW_HASH)]

    # SQL text keeps the many window expressions to a few calls into the JVM.
    part = _names(layout.partition)
    order = layout.order
    rows = rows.select("*", *[e.alias(f"__e_{n}") for n, e in given.items()])
    if fresh and given:
        order = [*order, ROW_HASH]
        rows = rows.withColumn(ROW_HASH, F.xxhash64(*[F.col(f"`__e_{n}`") for n in given]))
    fwd = f"partition by {part} order by {_names(order)}"
    source = rows
    rows = rows.selectExpr("*", f"cast(row_number() over ({fwd}) as bigint) as __i")

    # One sort serves both directions: the nearest non-null value is an offset function.
    # A frame that ends at "unbounded following" would be re-evaluated on every row.
    local = [f"lag(`__e_{n}`) over ({fwd}) as `__l_{n}`" for n in lag]
    local += [f"lead(`__e_{n}`) over ({fwd}) as `__l_{n}`" for n in lead]
    local += [f"sum(`__e_{n}`) over ({fwd} rows unbounded preceding) as `__l_{n}`" for n in total]
    for group, step in ((upto, "lag"), (before, "lag"), (onward, "lead"), (after, "lead")):
        for n in group:
            local.append(f"{step}(`__e_{n}`) ignore nulls over ({fwd}) as `__l_{n}`")
            if at:
                place = f"if(`__e_{n}` is null, null, __i)"
                local.append(f"{step}({place}) ignore nulls over ({fwd}) as `__p_{n}`")
    if given:
        local.append(f"lead(1) over ({fwd}) is null as __tail_row")
    rows = rows.selectExpr("*", *local) if local else rows

    def own_or_near(n: str) -> tuple[str, str]:
        """Value and chunk-local position at the row itself or next to it."""
        return f"coalesce(`__e_{n}`, `__l_{n}`)", f"if(`__e_{n}` is null, `__p_{n}`, __i)"

    # One row per chunk: what it hands to the chunks after and before it.
    steps = {"total": total, "lag": lag, "lead": lead, "last": (*upto, *before), "first": (*onward, *after)}
    if not given:
        if layout.counts is not None and fresh:
            chunks = layout.counts
        else:
            chunks = layout.attach(df).groupBy(*layout.partition).agg(F.count(F.lit(1)).alias("__n"))
    elif fresh:
        chunks = _summary(source, layout, order, steps, at)
    else:
        # The rows lie in chunks already: their first and last row tell.
        hand_on = {n: f"`__e_{n}`" for n in lag} | {n: f"`__l_{n}`" for n in total}
        hand_back = {n: f"`__e_{n}`" for n in lead}
        for side, names in ((hand_on, steps["last"]), (hand_back, steps["first"])):
            for n in names:
                side[n], place = own_or_near(n)
                if at:
                    side[f"@{n}"] = place
        aggs = [F.expr("max(__i)").alias("__n")]
        if hand_on:
            aggs.append(F.expr(f"max_by({_packed(hand_on)}, __i)").alias("__last"))
        if hand_back:
            aggs.append(F.expr(f"min_by({_packed(hand_back)}, __i)").alias("__first"))
        chunks = rows.filter("__tail_row or __i = 1").groupBy(*layout.partition).agg(*aggs)

    by = f"partition by {KEY}" if layout.keys else ""
    down = f"{by} order by {_names(layout.chunk_columns)}"
    gone = "rows between unbounded preceding and 1 preceding"
    chunks = chunks.selectExpr("*", f"coalesce(sum(__n) over ({down} {gone}), 0) as __base")

    carry = [f"sum(__n) over ({by}) as __size"] if size else []
    carry += [f"lag(__last.`{n}`) over ({down}) as `__c_{n}`" for n in lag]
    carry += [f"lead(__first.`{n}`) over ({down}) as `__c_{n}`" for n in lead]
    carry += [f"sum(__last.`{n}`) over ({down} {gone}) as `__c_{n}`" for n in total]
    for group, side, step in ((upto, "__last", "lag"), (before, "__last", "lag"), (onward, "__first", "lead"), (after, "__first", "lead")):
        for n in group:
            carry.append(f"{step}({side}.`{n}`) ignore nulls over ({down}) as `__c_{n}`")
            if at:
                carry.append(f"{step}({side}.`@{n}` - 1 + __base) ignore nulls over ({down}) as `__q_{n}`")
    inherited = cut(chunks.selectExpr(*[f"`{c}`" for c in layout.partition], "__base", *carry))

    out = [f"__base + __i - 1 as `{pos}`"] if pos else []
    out += [f"__size as `{size}`"] if size else []
    out += [f"if(__i = 1, `__c_{n}`, `__l_{n}`) as `{n}`" for n in lag]
    out += [f"if(__tail_row, `__c_{n}`, `__l_{n}`) as `{n}`" for n in lead]
    out += [f"coalesce(`__c_{n}`, 0) + `__l_{n}` as `{n}`" for n in total]
    for n in (*upto, *onward):
        v, place = own_or_near(n)
        found = f", coalesce({place} - 1 + __base, `__q_{n}`) as at" if at else ""
        out.append(f"struct(coalesce({v}, `__c_{n}`) as v{found}) as `{n}`")
    for n in (*before, *after):
        found = f", coalesce(`__p_{n}` - 1 + __base, `__q_{n}`) as at" if at else ""
        out.append(f"struct(coalesce(`__l_{n}`, `__c_{n}`) as v{found}) as `{n}`")
    return rows.join(inherited, layout.partition, "left").selectExpr(*[f"`{c}`" for c in kept], *out)


def with_halo(
    df: DataFrame, keys: Sequence[str], pos: str, rows_before: int, chunk_rows: int | None = None
) -> tuple[DataFrame, list[str], str]:
    """Cut by row position for frames of at most ``rows_before`` preceding rows.

    Returns the table, its partition columns and the name of a flag that is true on
    the copies lent to the next chunk; drop those after the window function.
    """
    size = max(chunk_rows or 100_000, 8 * rows_before, 1)
    home = F.floor(F.col(pos) / F.lit(size))
    lent = F.pmod(F.col(pos), F.lit(size)) >= size - rows_before
    out = df.withColumn(
        "__slot",
        F.explode(F.when(lent, F.array(home, home + 1)).otherwise(F.array(home))),
    ).withColumn("__lent", F.col("__slot") != home)
    return out, [*keys, "__slot"], "__lent"


def explode_range(df: DataFrame, name: str, first: Column, last: Column, batch: int = 10_000) -> DataFrame:
    """One row per integer in ``[first, last]``; two steps keep the generated arrays short."""
    out = df.withColumns({"__first": first.cast("long"), "__last": last.cast("long")})
    out = out.filter(F.col("__first") <= F.col("__last"))
    out = out.withColumn("__from", F.explode(F.sequence("__first", "__last", F.lit(batch).cast("long"))))
    upto = F.least(F.col("__from") + (batch - 1), F.col("__last"))
    return out.withColumn(name, F.explode(F.sequence(F.col("__from"), upto))).drop("__first", "__last", "__from")
