"""Joint states, scalers, reduction and per-window statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.columns import micros
from sensorspark.functions.vectors import doubles
from sensorspark.operators import windows
from sensorspark.plans.series import plan_layout, scan, with_halo


MAX_SENSORS = 1_000


def joint_state(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    *,
    keys: Sequence[str] = (),
    window: str = "read_index",
    sensor: str = "sensor",
    embedding: str = "embedding",
    label: str | None = "label",
    timestamp: str | None = None,
    check: bool = True,
    whole: bool = True,
) -> DataFrame:
    """One row per window: the sensor vectors concatenated in the order of ``sensors``, by default the alphabet.

    With ``check`` a missing, unknown or repeated sensor, or labels that differ inside a
    window, raise an error naming up to five windows.  The label is the first non-null
    one in sensor order.  Without ``whole`` windows may lack or repeat a sensor: all vectors
    they have are joined, copies side by side and those of unknown sensors last, and only
    labels are checked.
    """
    for needed in (window, sensor, embedding, *([label] if label else []), *([timestamp] if timestamp else [])):
        if needed not in df.columns:
            raise ValueError(f"column {needed!r} is missing")
    if sensors is None:
        names = df.select(sensor).filter(F.col(sensor).isNotNull()).distinct().limit(MAX_SENSORS + 1).collect()
        if len(names) > MAX_SENSORS:
            raise ValueError(f"more than {MAX_SENSORS} sensors; is {sensor!r} a sensor column?")
        sensors = sorted(r[0] for r in names)
    rank = F.array_position(F.array(*[F.lit(s) for s in sensors]), F.col(sensor))
    rows = df.withColumn("__rank", rank)
    by = [*keys, window]
    if check:
        checks = [
            F.count(F.lit(1)).alias("__rows"),
            F.count_distinct("__rank").alias("__sensors"),
            F.min("__rank").alias("__least"),
        ]
        checks = checks if whole else checks[:1]
        if label:
            checks.append((F.min(label) != F.max(label)).alias("__clash"))
        seen = rows.groupBy(*by).agg(*checks)
        n = len(sensors)
        wrong = (F.col("__rows") != n) | (F.col("__sensors") != n) | (F.col("__least") == 0)
        bad = seen.filter(wrong).select(window).limit(5).collect() if whole else []
        if bad:
            raise ValueError(f"windows without exactly the sensors {list(sensors)}: {[r[0] for r in bad]}")
        if label:
            bad = seen.filter("__clash").select(window).limit(5).collect()
            if bad:
                raise ValueError(f"windows with conflicting labels: {[r[0] for r in bad]}")
    if whole:
        # One vector per sensor is kept, however often a window repeats.
        aggs = [
            F.any_value(F.when(F.col("__rank") == i + 1, F.col(embedding)), F.lit(True)).alias(f"__v{i}")
            for i in range(len(sensors))
        ]
        features = F.concat(*[doubles(f"__v{i}") for i in range(len(sensors))])
    else:
        place = F.when(F.col("__rank") > 0, F.col("__rank")).otherwise(len(sensors) + 1)
        vector = F.struct(place.alias("i"), F.col(sensor).isNull().alias("u"), F.col(sensor).alias("s"), doubles(embedding).alias("v"))
        aggs = [F.array_sort(F.collect_list(vector)).alias("__all")]
        features = F.flatten(F.col("__all")["v"])
    if label:
        aggs.append(F.min_by(label, F.when(F.col(label).isNotNull(), F.col("__rank"))).alias(label))
    if timestamp:
        aggs.append(F.min_by(timestamp, "__rank").alias(timestamp))
    out = rows.groupBy(*by).agg(*aggs)
    extras = [c for c in (label, timestamp) if c]
    return out.select(*by, *extras, features.alias("features"))


@dataclass(frozen=True)
class DimensionScaler:
    """Fitted mean and deviation of every vector position; a few numbers per dimension."""

    mean: tuple[float, ...]
    std: tuple[float, ...]

    def transform(self, df: DataFrame, features: str, out: str | None = None) -> DataFrame:
        mean = F.array(*[F.lit(x) for x in self.mean])
        std = F.array(*[F.lit(x) for x in self.std])
        centred = F.zip_with(doubles(features), mean, lambda x, m: x - m)
        return df.withColumn(out or features, F.zip_with(centred, std, lambda x, s: x / s))


def fit_dimensions(df: DataFrame, features: str) -> DimensionScaler:
    """Population standardisation per position; zero variance is left unscaled."""
    v = array_to_vector(doubles(features))
    s = df.select(Summarizer.metrics("mean", "variance", "count").summary(v).alias("s")).first()["s"]
    n = s["count"]
    var = [x * (n - 1) / n if n > 1 else 0.0 for x in s["variance"]]
    return DimensionScaler(
        tuple(float(x) for x in s["mean"]), tuple(float(x) ** 0.5 if x > 0 else 1.0 for x in var)
    )


def pca(train: DataFrame, features: str, k: int) -> tuple[Column, list[float]]:
    """Fit ``k`` components on ``train``; returns the projection expression and the variance shares.

    The stored components are few numbers (``k`` times the dimension).  Vectors are centred
    first, because Spark's PCA transform does not, and the sign of a component makes its
    largest loading positive.
    """
    shape = train.select(F.count(F.lit(1)).alias("n"), F.max(F.size(features)).alias("d")).first()
    if not 0 < k < min(shape["n"], shape["d"]):
        raise ValueError(f"k={k} must be below the dimension {shape['d']} and the row count {shape['n']}")
    mean = fit_dimensions(train, features).mean
    means = F.array(*[F.lit(x) for x in mean])

    def centred(c: str) -> Column:
        return F.zip_with(doubles(c), means, lambda x, m: x - m)

    model = PCA(k=k, inputCol="v", outputCol="p").fit(train.select(array_to_vector(centred(features)).alias("v")))
    columns = model.pc.toArray().T
    parts = []
    for c in columns:
        sign = 1.0 if c[abs(c).argmax()] >= 0 else -1.0
        loading = F.array(*[F.lit(float(x) * sign) for x in c])
        parts.append(
            F.aggregate(F.zip_with(centred(features), loading, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        )
    return F.array(*parts), [float(x) for x in model.explainedVariance.toArray()]


def fit_channels(df: DataFrame, sensors: Sequence[str], epsilon: float = 1e-9) -> dict[str, tuple[float, float]]:
    """Mean and population deviation plus ``epsilon`` of every channel, from the shot pool."""
    aggs = []
    for s in sensors:
        aggs += [F.avg(s).alias(f"m_{s}"), F.stddev_pop(s).alias(f"s_{s}")]
    row = df.agg(*aggs).first()
    return {s: (row[f"m_{s}"], row[f"s_{s}"] + epsilon) for s in sensors}


def scale_channels(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({s: (F.col(s) - F.lit(m)) / F.lit(d) for s, (m, d) in scaler.items()})


def window_statistics(
    df: DataFrame, by: Sequence[str], order: str, sensors: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Statistics of every sensor in each window, as columns ``<sensor>_<name>``.

    ``order`` is the row's position inside its window.  One aggregation, combined before
    the shuffle; only the sign-change count needs neighbouring rows.
    """
    known = (
        "mean std min max rms peak_to_peak skewness kurtosis crest_factor zero_crossings slope"
    ).split()
    names = list(names) if names is not None else known
    if not names or set(names) - set(known):
        raise ValueError(f"statistic names must be one or more of {known}, got {names}")
    rows = df
    if "zero_crossings" in names:
        w = Window.partitionBy(*by).orderBy(order)
        rows = rows.withColumns({f"__sign_{s}": F.lag(F.col(s) >= 0).over(w) != (F.col(s) >= 0) for s in sensors})
    aggs = []
    for s in sensors:
        c = F.col(s).cast("double")
        rms = F.sqrt(F.avg(c * c))
        made: dict[str, Column] = {
            "mean": F.avg(c),
            "std": F.stddev_pop(c),
            "min": F.min(c),
            "max": F.max(c),
            "rms": rms,
            "peak_to_peak": F.max(c) - F.min(c),
            "skewness": F.skewness(c),
            "kurtosis": F.kurtosis(c),
            "crest_factor": F.try_divide(F.max(F.abs(c)), rms),
            "slope": F.regr_slope(c, F.col(order).cast("double")),
        }
        if "zero_crossings" in names:
            made["zero_crossings"] = F.count_if(F.coalesce(F.col(f"__sign_{s}"), F.lit(False)))
        aggs += [made[n].alias(f"{s}_{n}") for n in names]
    return rows.groupBy(*by).agg(*aggs)


# --- statistics of sliding windows without copies -----------------------------------------

STATISTICS = ("mean", "std", "min", "max", "rms", "peak_to_peak", "skewness", "kurtosis", "crest_factor", "zero_crossings", "slope")
_MOMENTS = ("n", "mean", "m2", "m3", "m4", "low", "high", "crossings", "edge", "at", "xx", "xy")


def _pane_of_one(value: Column, at: Column, crossed: Column) -> Column:
    """The moments of a pane of one row; ``edge`` tells whether the sign changes where the pane begins."""
    there = value.isNotNull()
    zero = F.lit(0.0)
    fields = {
        "n": there.cast("double"), "mean": F.coalesce(value, zero), "m2": zero, "m3": zero, "m4": zero, "low": value, "high": value,
        "crossings": F.lit(0).cast("long"), "edge": crossed.cast("long"), "at": F.when(there, at).otherwise(zero), "xx": zero, "xy": zero,
    }
    return F.struct(*[fields[c].alias(c) for c in _MOMENTS])


def _pane(value: str, at: Column, crossed: Column, begins: Column) -> Column:
    """The moments of the rows of a pane as one aggregate; empty sums are zero."""
    v = F.col(value)
    x = F.when(v.isNotNull(), at)
    n = F.count(v).cast("double")
    m2 = F.coalesce(F.var_pop(v), F.lit(0.0)) * n
    fields = {
        "n": n,
        "mean": F.coalesce(F.avg(v), F.lit(0.0)),
        "m2": m2,
        # Without spread there is no skewness, and no moment above the first either.
        "m3": F.coalesce(F.skewness(v) * F.pow(m2, F.lit(1.5)) / F.sqrt(F.greatest(n, F.lit(1.0))), F.lit(0.0)),
        "m4": F.coalesce((F.kurtosis(v) + 3) * m2 * m2 / F.greatest(n, F.lit(1.0)), F.lit(0.0)),
        "low": F.min(v),
        "high": F.max(v),
        "crossings": F.count_if(crossed & ~begins),
        "edge": F.count_if(crossed & begins),
        "at": F.coalesce(F.avg(x), F.lit(0.0)),
        "xx": F.coalesce(F.var_pop(x), F.lit(0.0)) * n,
        "xy": F.coalesce(F.covar_pop(x, v), F.lit(0.0)) * n,
    }
    return F.struct(*[fields[c].alias(c) for c in _MOMENTS])


def _merged(a: Column, b: Column) -> Column:
    """The moments of the rows of ``a`` followed by those of ``b``; stable for values far from zero."""
    na, nb = a["n"], b["n"]
    total = na + nb
    n = F.greatest(total, F.lit(1.0))
    d, dx = b["mean"] - a["mean"], b["at"] - a["at"]
    both = na * nb / n
    fields = {
        "n": total,
        "mean": a["mean"] + d * nb / n,
        "m2": a["m2"] + b["m2"] + d * d * both,
        "m3": a["m3"] + b["m3"] + d * d * d * both * (na - nb) / n + 3.0 * d * (na * b["m2"] - nb * a["m2"]) / n,
        "m4": a["m4"] + b["m4"] + d * d * d * d * both * (na * na - na * nb + nb * nb) / (n * n)
        + 6.0 * d * d * (na * na * b["m2"] + nb * nb * a["m2"]) / (n * n) + 4.0 * d * (na * b["m3"] - nb * a["m3"]) / n,
        "low": F.least(a["low"], b["low"]),
        "high": F.greatest(a["high"], b["high"]),
        "crossings": a["crossings"] + b["edge"] + b["crossings"],
        "edge": a["edge"],
        "at": a["at"] + dx * nb / n,
        "xx": a["xx"] + b["xx"] + dx * dx * both,
        "xy": a["xy"] + b["xy"] + dx * d * both,
    }
    return F.struct(*[fields[c].alias(c) for c in _MOMENTS])


def _statistic(m: Column, name: str) -> Column:
    n = F.when(m["n"] > 0, m["n"])
    spread = F.when(m["m2"] > 0, m["m2"])
    rms = F.sqrt(m["m2"] / n + m["mean"] * m["mean"])
    return {
        "mean": F.when(m["n"] > 0, m["mean"]),
        "std": F.sqrt(m["m2"] / n),
        "min": m["low"],
        "max": m["high"],
        "rms": rms,
        "peak_to_peak": m["high"] - m["low"],
        "skewness": F.sqrt(n) * m["m3"] / F.pow(spread, F.lit(1.5)),
        "kurtosis": n * m["m4"] / (spread * spread) - 3.0,
        "crest_factor": F.try_divide(F.greatest(F.abs(m["low"]), F.abs(m["high"])), rms),
        "zero_crossings": m["crossings"],
        "slope": m["xy"] / F.when(m["xx"] > 0, m["xx"]),
    }[name]


def sliding_statistics(
    df: DataFrame,
    timestamp: str,
    window_size: int,
    step: int,
    sensors: Sequence[str],
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    names: Sequence[str] = STATISTICS,
) -> DataFrame:
    """The statistics of every full window of ``window_size`` rows, ``step`` rows apart.

    Same columns and values as :func:`window_statistics` over the rows that
    :func:`~sensorspark.operators.windows.sliding` tags, and no row is copied into its windows:
    rows are reduced to panes of ``gcd(window_size, step)`` rows, and a window is merged from
    its panes by doubling, runs of 1, 2, 4, .. panes, so a step costs the logarithm of the
    window.  Every series is cut into stretches of panes that borrow the panes of one window.
    """
    windows._check_sizes(window_size, step)
    names = list(names)
    if not names or set(names) - set(STATISTICS):
        raise ValueError(f"statistic names must be one or more of {STATISTICS}, got {names}")
    size = gcd(window_size, step)
    need = window_size // size
    values = [F.col(s).cast("double").alias(f"__v{i}") for i, s in enumerate(sensors)]
    rows = df.select(*keys, *ties, micros(df, timestamp).alias("__us"), *values)
    lay = plan_layout(rows, keys, "__us", ties)
    signs = {f"__s{i}": F.col(f"__v{i}") >= 0 for i in range(len(sensors))} if "zero_crossings" in names else {}
    seen = scan(rows, lay, pos="__pos", size="__n", lag=signs)
    at = F.col("__pos").cast("double")

    def crossed(i: int) -> Column:
        return F.coalesce(F.col(f"__s{i}") != (F.col(f"__v{i}") >= 0), F.lit(False)) if signs else F.lit(False)

    if size == 1:
        made = [_pane_of_one(F.col(f"__v{i}"), at, crossed(i)).alias(f"__m{i}") for i in range(len(sensors))]
        panes = lay.detach(seen).select(*keys, F.col("__pos").alias("__pane"), "__n", *made)
    else:
        begins = F.col("__pos") % size == 0
        tagged = lay.detach(seen).withColumn("__pane", F.floor(F.col("__pos") / size))
        made = [_pane(f"__v{i}", at, crossed(i), begins).alias(f"__m{i}") for i in range(len(sensors))]
        panes = tagged.groupBy(*keys, "__pane").agg(F.max("__n").alias("__n"), *made)
    halo, by, lent = with_halo(panes, keys, "__pane", need - 1)
    order = Window.partitionBy(*by).orderBy("__pane")
    # ``run`` holds the moments of the last ``length`` panes, ``__w`` those of the pieces of the window so far.
    taken, length, run, out = 0, 1, "__m", halo
    while True:
        if need & length:
            for i in range(len(sensors)):
                piece = F.lag(f"{run}{i}", taken).over(order) if taken else F.col(f"{run}{i}")
                out = out.withColumn(f"__p{i}", piece)
                whole = _merged(F.col(f"__p{i}"), F.col(f"__w{i}")) if taken else F.col(f"__p{i}")
                out = out.withColumn(f"__w{i}", whole).drop(f"__p{i}")
            taken += length
        if taken == need:
            break
        for i in range(len(sensors)):
            out = out.withColumn(f"__p{i}", F.lag(f"{run}{i}", length).over(order))
            out = out.withColumn(f"__r{i}", _merged(F.col(f"__p{i}"), F.col(f"{run}{i}"))).drop(f"__p{i}")
        run, length = "__r", length * 2
    first = (F.col("__pane") - (need - 1)) * size
    full = ~F.col(lent) & (first >= 0) & (first % step == 0) & ((F.col("__pane") + 1) * size <= F.col("__n"))
    statistics = [_statistic(F.col(f"__w{i}"), n).alias(f"{s}_{n}") for i, s in enumerate(sensors) for n in names]
    return out.filter(full).select(*keys, F.floor(first / step).alias("window_id"), *statistics)


def fuse(embeddings: DataFrame, statistics: DataFrame, by: Sequence[str], embedding: str, columns: Sequence[str]) -> DataFrame:
    """Embedding and statistics of the same window as one vector, aligned by key."""
    stats = F.array(*[F.col(c).cast("double") for c in columns])
    return embeddings.join(statistics.select(*by, stats.alias("__s")), list(by)).withColumn(
        "fused", F.concat(doubles(embedding), F.col("__s"))
    ).drop("__s")


def separation(df: DataFrame, sensors: Sequence[str], fault: Column, top: int | None = None) -> DataFrame:
    """Channels ranked by effect size between fault and normal rows, on the build region."""
    aggs = []
    for s in sensors:
        for flag, side in ((fault, 1), (~fault, 0)):
            c = F.when(flag, F.col(s))
            aggs += [F.avg(c).alias(f"m{side}_{s}"), F.var_pop(c).alias(f"v{side}_{s}")]
    one = df.agg(*aggs)
    effect = [
        F.struct(
            F.lit(s).alias("sensor"),
            F.try_divide(
                F.abs(F.col(f"m1_{s}") - F.col(f"m0_{s}")), F.sqrt((F.col(f"v1_{s}") + F.col(f"v0_{s}")) / 2)
            ).alias("effect"),
        )
        for s in sensors
    ]
    out = one.select(F.inline(F.array(*effect))).orderBy(F.col("effect").desc_nulls_last(), "sensor")
    return out.limit(top) if top else out
