"""Scoring of per-window predictions against truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.columns import MICROS, join_on, micros, truthy
from sensorspark.operators.windows import trailing_counts
from sensorspark.plans.series import plan_layout, scan
from sensorspark.session import cut

AXIS = "__us"
INVALID_STATE = "INVALID_STATE"


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 when the denominator is empty."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return ratio(2 * p * r, p + r)


def confusion(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def binary(df: DataFrame, truth: str, predicted: str, positive: object, by: Sequence[str] = ()) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 with ``positive`` as the positive class."""
    t, p = F.col(truth) == F.lit(positive), F.col(predicted) == F.lit(positive)
    out = df.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = out.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
        }
    )
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def per_class(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """``tp, fn, fp`` and precision, recall, F1 of every class seen on either side."""
    cells = confusion(df, truth, predicted, by)
    hit = F.col(truth) == F.col(predicted)
    # Both roles of a cell in one pass over the confusion table.
    roles = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col(truth).alias("label"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                         F.when(hit, 0).otherwise(F.col("n")).alias("fn"), F.lit(0).cast("long").alias("fp")),
                F.struct(F.col(predicted).alias("label"), F.lit(0).cast("long").alias("tp"),
                         F.lit(0).cast("long").alias("fn"), F.when(hit, 0).otherwise(F.col("n")).alias("fp")),
            )
        ),
    )
    out = roles.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")])
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    out = out.withColumns({"support": tp + fn, "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def multiclass(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and macro-F1 over the classes that occur in truth."""
    classes = per_class(df, truth, predicted, by)
    return classes.groupBy(*by).agg(
        F.sum("support").alias("n"),
        F.sum("tp").alias("correct"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("f1"))).alias("macro_f1"),
    )


def invalid_flag(df: DataFrame, predicted: str, flag: str | None = "invalid") -> Column:
    """Either signal counts: the flag column, or the reserved state."""
    state = F.coalesce(F.col(predicted).cast("string") == INVALID_STATE, F.lit(False))
    return state | truthy(F.col(flag)) if flag and flag in df.columns else state


def end_row_truth(
    predictions: DataFrame,
    truth: DataFrame,
    *,
    keys: Sequence[str] = (),
    finish: str = "finish_us",
    at: str = "at_us",
    predicted: str = "predicted",
    label: str = "label",
    truncate_s: bool = False,
) -> DataFrame:
    """Join each window to the label of its last row; adds ``truth``, ``invalid``, ``matched``.

    Instants are whole milliseconds, or whole seconds with ``truncate_s``.  On duplicate
    truth instants the last row in label order wins.
    """
    unit = MICROS if truncate_s else 1_000

    def tick(c: str) -> Column:
        return F.floor(F.col(c) / unit) if truncate_s else F.round(F.col(c) / unit).cast("long")

    known = truth.groupBy(*keys, tick(at).alias("__k")).agg(F.max_by(label, F.struct(at, label)).alias("truth"))
    flagged = predictions.withColumn("invalid", invalid_flag(predictions, predicted)).withColumn("__k", tick(finish))
    out = flagged.join(known, [*keys, "__k"], "left").drop("__k")
    return out.withColumn("matched", F.col("truth").isNotNull())


def steady_rows(
    truth: DataFrame, timestamp: str, label: str, window_size: int, keys: Sequence[str] = (), ties: Sequence[str] = (),
    *, min_step_s: float = 1.0, max_step_s: float = 60.0,
) -> DataFrame:
    """Flag rows whose trailing window has one label and only steps inside the bounds.

    A break is a label change or an odd step; the window is steady when the last break
    lies before it, so no frame is evaluated.
    """
    rows = truth.withColumn(AXIS, micros(truth, timestamp))
    lay = plan_layout(rows, keys, AXIS, ties)
    seen = scan(lay.place(rows), lay, lag={"__pt": F.col(AXIS), "__pl": F.col(label)})
    step = (F.col(AXIS) - F.col("__pt")) / MICROS
    breaks = ~F.col(label).eqNullSafe(F.col("__pl")) | ~step.between(min_step_s, max_step_s)
    marked = scan(seen, lay, pos="pos", upto={"__break": F.when(breaks & F.col("__pt").isNotNull(), F.lit(True))})
    clean = F.coalesce(F.col("__break")["at"] <= F.col("pos") - window_size + 1, F.lit(True))
    out = marked.withColumn("steady", (F.col("pos") >= window_size - 1) & clean)
    return lay.detach(out).drop("__pt", "__pl", "__break", AXIS)


def score_states(joined: DataFrame, steady: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and steady-state accuracy over the scorable windows of :func:`end_row_truth`."""
    usable = ~F.col("invalid") & F.col("matched")
    right = F.col("predicted") == F.col("truth")
    calm = usable & F.coalesce(F.col(steady), F.lit(False)) if steady else F.lit(False)
    return joined.groupBy(*by).agg(
        F.count_if(usable).alias("n"),
        F.count_if(~usable).alias("skipped"),
        F.count_if(usable & right).alias("correct"),
        ratio(F.count_if(usable & right), F.count_if(usable)).alias("accuracy"),
        F.count_if(calm).alias("n_steady"),
        ratio(F.count_if(calm & right), F.count_if(calm)).alias("steady_accuracy"),
    )


def infer_fault_label(truth: DataFrame, label: str = "label", normal: str = "normal") -> str | None:
    """The only label that is not ``normal``; none is legal, several need an explicit choice."""
    others = [r[0] for r in truth.select(label).filter(F.col(label) != normal).distinct().limit(2).collect()]
    if len(others) > 1:
        raise ValueError(f"several labels besides {normal!r}, such as {sorted(others)}; name the fault label")
    return others[0] if others else None


def prepare_truth(
    truth: DataFrame, timestamp: str, keys: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Truth rows with ``pos`` and ``at_us``, written once; ``truth_spans`` takes them for any window length."""
    return cut(_placed_truth(truth, timestamp, keys, ties))


def _placed_truth(truth: DataFrame, timestamp: str, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    rows = truth.withColumn(AXIS, micros(truth, timestamp))
    lay = plan_layout(rows, keys, AXIS, ties)
    return lay.detach(scan(rows, lay, pos="pos")).withColumn("at_us", F.col(AXIS)).drop(AXIS)


def truth_spans(
    truth: DataFrame, timestamp: str, label: str, fault: str, window_size: int, keys: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Truth rows with ``pos`` and, for the window ending there, ``lo``, ``n_rows``, ``n_fault``.

    Rows that ``prepare_truth`` has seen are not ordered again.
    """
    prepared = {"pos", "at_us"} <= set(truth.columns)
    placed = truth if prepared else _placed_truth(truth, timestamp, keys, ties)
    is_fault = (F.col(label) == fault).cast("long")
    out = trailing_counts(placed, keys, "pos", window_size, {"n_fault": is_fault})
    lo = F.greatest(F.lit(0), F.col("pos") - window_size + 1)
    return out.withColumns({"lo": lo, "n_rows": F.col("pos") - lo + 1})


def match_spans(predictions: DataFrame, spans: DataFrame, keys: Sequence[str], finish_us: str) -> DataFrame:
    """Every prediction with the truth span that ends at its finish: ``pos, lo, n_rows, n_fault``.

    Where several truth rows share an instant the last one counts.  A prediction without a
    span keeps NULLs and is unmatched in ``rare_event_metrics``.  NULL keys match one another.
    """
    held = [c for c in ("pos", "lo", "n_rows", "n_fault")]
    at = F.struct(*keys, F.col("at_us")).alias("__at")
    last = spans.groupBy(at).agg(F.max_by(F.struct(*held), "pos").alias("__span"))
    keyed = predictions.withColumn("__at", F.struct(*keys, F.col(finish_us).alias("at_us")))
    return keyed.join(last, "__at", "left").select(*predictions.columns, *[F.col("__span")[c].alias(c) for c in held])


def rare_event_metrics(joined: DataFrame, fault: str, normal: str = "normal", by: Sequence[str] = ()) -> DataFrame:
    """Both classes' precision, recall, F1, macro-F1 and the false-alarm rate.

    Needs ``predicted, invalid, n_rows, n_fault``; rows without a span are unmatched.
    False alarms are counted on windows without a single fault row.  A predicted label
    that is neither class counts as normal and in ``other_predicted``.
    """
    usable = ~F.col("invalid") & F.col("n_rows").isNotNull()
    truth = F.col("n_fault") * 2 >= F.col("n_rows")
    says = F.trim(F.col("predicted")) == fault
    clean = usable & (F.col("n_fault") == 0)
    out = joined.groupBy(*by).agg(
        F.count_if(F.col("invalid")).alias("invalid"),
        F.count_if(~F.col("invalid") & F.col("n_rows").isNull()).alias("unmatched"),
        F.count_if(usable & truth & says).alias("tp"),
        F.count_if(usable & ~truth & says).alias("fp"),
        F.count_if(usable & truth & ~says).alias("fn"),
        F.count_if(usable & ~truth & ~says).alias("tn"),
        F.count_if(clean).alias("clean_windows"),
        F.count_if(clean & says).alias("false_alarms"),
        F.count_if(usable & ~says & (F.trim(F.col("predicted")) != normal)).alias("other_predicted"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = out.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "normal_precision": ratio(tn, tn + fn),
            "normal_recall": ratio(tn, tn + fp),
            "false_alarm_rate": F.try_divide(F.col("false_alarms"), F.col("clean_windows")),
        }
    )
    out = out.withColumns(
        {
            "f1": _f1(F.col("precision"), F.col("recall")),
            "normal_f1": _f1(F.col("normal_precision"), F.col("normal_recall")),
        }
    )
    return out.withColumn("macro_f1", (F.col("f1") + F.col("normal_f1")) / 2)


def episodes(
    truth: DataFrame, timestamp: str, fault: Column, keys: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Contiguous fault runs as half-open row ranges ``[row_from, row_to)``."""
    rows = truth.withColumns({AXIS: micros(truth, timestamp), "__f": F.coalesce(fault, F.lit(False))})
    lay = plan_layout(rows, keys, AXIS, ties)
    seen = scan(
        rows, lay, pos="row_from", size="__n", lag={"__pf": F.col("__f")}, after={"__ok": F.when(~F.col("__f"), True)}
    )
    starts = seen.filter(F.col("__f") & ~F.coalesce(F.col("__pf"), F.lit(False)))
    return starts.select(
        *keys,
        "row_from",
        F.coalesce(F.col("__ok")["at"], F.col("__n")).alias("row_to"),
        F.col(AXIS).alias("onset_us"),
    )


def detect_incidents(found: DataFrame, alarms: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each episode with the predicted fault windows ``[lo, hi)`` that overlap it.

    No pair of an episode and a window is made.  A window overlaps ``[row_from, row_to)`` unless
    it begins at ``row_to`` or later or ends at ``row_from`` or before, so their number is the
    difference of two running counts.  The first to end after ``row_from`` is the first alarm
    if it ends by ``row_to``; otherwise the first alarm is the earliest end among the windows
    around ``row_to``, which the windows leave at the nodes of a binary tree over the rows.
    """
    on = [*keys, "row_from"]
    none = F.lit(None).cast("long")
    windows = alarms.select(*keys, F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
    ends = found.select(*keys, "row_from", "row_to")

    def events(df: DataFrame, at: str, side: int, opens: Column, closes: Column, end: Column, row_from: Column) -> DataFrame:
        return df.select(
            *keys, F.col(at).cast("long").alias("__at"), F.lit(side).cast("long").alias("__side"), opens.alias("__opens"),
            closes.alias("__closes"), end.alias("__hi"), row_from.alias("row_from"), F.lit(at).alias("__kind"),
        )

    # At one row: windows that end come first, then episodes, then windows that begin; windows alike count once.
    zero, n = F.lit(0).cast("long"), F.col("__n")
    closing = windows.groupBy(*keys, "hi").agg(F.count(F.lit(1)).alias("__n"))
    opening = windows.groupBy(*keys, "lo").agg(F.count(F.lit(1)).alias("__n"))
    both = events(closing, "hi", 0, zero, n, F.col("hi"), none).unionByName(events(opening, "lo", 2, n, zero, none, none))
    for at in ("row_from", "row_to"):
        both = both.unionByName(events(ends, at, 1, zero, zero, none, F.col("row_from").cast("long")))
    lay = plan_layout(both, keys, "__at", ["__side"], first_width=1 << 22)
    seen = scan(
        both, lay, total={"__begun": F.col("__opens"), "__ended": F.col("__closes")}, after={"__next": F.col("__hi")}, at=False
    )
    begins = F.col("__kind") == "row_from"
    counted = lay.detach(seen).filter("__side = 1").groupBy(*on).agg(
        (F.max(F.when(~begins, F.col("__begun"))) - F.max(F.when(begins, F.col("__ended")))).alias("n_windows"),
        F.max(F.when(begins, F.col("__next")["v"])).alias("__next"),
    )
    out = join_on(found, counted, on, "left")
    late = (F.col("n_windows") > 0) & (F.col("__next") > F.col("row_to"))
    around = _earliest_end(windows, out.filter(late).select(*on, "row_to"), keys)
    out = join_on(out, around, on, "left")
    first = F.when(F.col("n_windows") > 0, F.when(late, F.col("__around")).otherwise(F.col("__next"))) - 1
    out = out.withColumn("first_row", first).drop("__next", "__around")
    return out.withColumns(
        {
            "n_windows": F.coalesce(F.col("n_windows"), F.lit(0).cast("long")),
            "detected": F.col("first_row").isNotNull(),
            "latency": F.greatest(F.lit(0).cast("long"), F.col("first_row") - F.col("row_from")),
        }
    )


def _earliest_end(windows: DataFrame, episodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, row_from, __around)``: the least ``hi`` of the windows with ``lo < row_to < hi``.

    The rows ``lo + 1 .. hi - 1`` of a window are at most two nodes on each level of a binary
    tree; ``row_to`` lies in one node on each level, so both sides meet in an equality join.
    """
    longest = windows.agg(F.max(F.col("hi") - F.col("lo"))).first()[0] or 0
    levels = F.sequence(F.lit(0), F.lit(max(0, longest.bit_length() - 1)))
    left = lambda k: F.expr(f"(lo + 1 + shiftleft(1L, {k}) - 1) div shiftleft(1L, {k})")
    nodes = windows.filter("hi > lo + 1").withColumn("__level", F.explode(levels))
    nodes = nodes.withColumns({"__l": left("__level"), "__r": F.expr("hi div shiftleft(1L, __level)")}).filter("__l < __r")
    taken = F.array_compact(
        F.array(F.when(F.col("__l") % 2 == 1, F.col("__l")), F.when(F.col("__r") % 2 == 1, F.col("__r") - 1))
    )
    nodes = nodes.withColumn("__node", F.explode(taken)).groupBy(*keys, "__level", "__node").agg(F.min("hi").alias("__around"))
    asked = episodes.withColumn("__level", F.explode(levels)).withColumn("__node", F.expr("row_to div shiftleft(1L, __level)"))
    return join_on(asked, nodes, [*keys, "__level", "__node"]).groupBy(*keys, "row_from").agg(F.min("__around").alias("__around"))


def agreement(
    a: DataFrame, b: DataFrame, on: Sequence[str], *, label: str, score: str, noise_floor: float = 1e-4
) -> DataFrame:
    """Agreement of two runs over the same windows: labels, scores and a noise-floor test.

    Windows of one run only are counted as ``only_a`` and ``only_b``; the figures are over
    those of both.
    """
    from sensorspark.plans.ranks import exact_quantile

    all_ = a.select(*on, F.lit(True).alias("in_a"), F.col(label).alias("la"), F.col(score).alias("sa")).join(
        b.select(*on, F.lit(True).alias("in_b"), F.col(label).alias("lb"), F.col(score).alias("sb")), list(on), "full"
    )
    alone = all_.agg(F.count_if(F.col("in_b").isNull()).alias("only_a"), F.count_if(F.col("in_a").isNull()).alias("only_b"))
    both = all_.filter("in_a and in_b")
    diff = F.abs(F.col("sa") - F.col("sb"))
    rows = both.select(
        (F.col("la").eqNullSafe(F.col("lb"))).cast("double").alias("same"),
        diff.alias("diff"),
        F.try_divide(diff, F.abs(F.col("sa"))).alias("relative"),
    )
    main = rows.agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.avg("same").alias("label_agreement"),
        F.max("diff").alias("max_abs_diff"),
        (F.max("diff") <= noise_floor).alias("within_noise"),
    )
    mid = exact_quantile(rows, [], "relative", 0.5, "median_relative_diff").drop("n")
    return main.join(F.broadcast(alone)).join(F.broadcast(mid), how="left")


def comparison(rows: DataFrame, by: str = "window_size") -> DataFrame:
    """Evaluation results of several runs as one ordered table."""
    return rows.orderBy(by)
