"""Exact nearest neighbours, votes and prototypes.

A library that fits the size limit is broadcast and every query is handled where it
lies.  A larger one is dealt to cells around pivots, rows of the library drawn by hash, and
searched in two rounds: a query first meets the cells nearest to it, which gives an upper
bound of its ``k``-th distance, and then only those that the triangle inequality does not
rule out.  Cells and the queries that visit them are cut into blocks; each (query block,
library block) is one bounded task that returns only its own ``k`` best per query, and the
partial results are merged.  No pair of rows is ever emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark.functions.vectors import doubles
from sensorspark.session import cut

# A worker holds its own copy of a broadcast library, and all workers of an executor do.
BROADCAST_BYTES = 32 << 20
BLOCK_BYTES = 64 << 20
QUERY_BLOCK = 20_000
# Numbers in the largest array of a search beside the library.
SCRATCH = 2_000_000
SPARE = 8
# Pivots drawn for each block of the library, and the bytes they may take in all.
PIVOTS_PER_BLOCK = 4
PIVOT_BYTES = 32 << 20


def nearest(q: np.ndarray, q_ids: np.ndarray, lib: np.ndarray, lib_ids: np.ndarray, k: int, skip_same_id: bool):
    """The ``k`` closest library rows of each query as (query row, library row, distance).

    A matrix product proposes ``k + SPARE`` rows; their distances are then computed
    directly.  A query whose proposal ends within rounding of its ``k``-th distance is
    recomputed over the whole block, so the result does not depend on the shortcut.
    Ties go to the smaller library id.
    """
    own = pd.Index(lib_ids).get_indexer(q_ids) if skip_same_id else np.full(len(q), -1)
    place = np.empty(len(lib), int)
    place[np.argsort(lib_ids, kind="stable")] = np.arange(len(lib))
    sq_lib = np.einsum("ij,ij->i", lib, lib)
    take = min(k + SPARE, len(lib))
    step = max(1, SCRATCH // max(1, len(lib), take * lib.shape[1]))
    rows, cols, dists = [], [], []

    def measured(part: np.ndarray, mine: np.ndarray, cand: np.ndarray):
        """The best ``k`` of the candidates of each query, by distance and id."""
        exact = np.sqrt(((lib[cand] - part[:, None, :]) ** 2).sum(axis=2))
        exact[cand == mine[:, None]] = np.inf
        order = np.lexsort((place[cand], exact), axis=1)[:, :k]
        return np.take_along_axis(cand, order, 1), np.take_along_axis(exact, order, 1)

    def over_all(v: np.ndarray, mine: int):
        """The best ``k`` of the whole block for one query."""
        exact, some = np.empty(len(lib)), max(1, SCRATCH // max(1, lib.shape[1]))
        for at in range(0, len(lib), some):
            exact[at : at + some] = np.sqrt(((lib[at : at + some] - v) ** 2).sum(axis=1))
        if mine >= 0:
            exact[mine] = np.inf
        least = np.flatnonzero(exact <= np.partition(exact, k - 1)[k - 1])
        order = least[np.lexsort((place[least], exact[least]))[:k]]
        return order, exact[order]

    for a in range(0, len(q), step):
        part, mine = q[a : a + step], own[a : a + step]
        if take < len(lib):
            sq = (part * part).sum(axis=1)
            guess = part @ lib.T
            guess *= -2.0
            guess += sq_lib
            guess += sq[:, None]
            has = np.flatnonzero(mine >= 0)
            guess[has, mine[has]] = np.inf
            near = np.argpartition(guess, take - 1, axis=1)[:, :take]
            best, exact = measured(part, mine, near)
            slack = 1e-9 * (sq + sq_lib.max() + 1.0)
            unsure = np.take_along_axis(guess, near, 1).max(axis=1) <= exact[:, -1] ** 2 + slack
            for i in np.flatnonzero(unsure):
                best[i], exact[i] = over_all(part[i], mine[i])
        else:
            best, exact = measured(part, mine, np.broadcast_to(np.arange(len(lib)), (len(part), len(lib))))
        i, j = np.nonzero(np.isfinite(exact))
        rows.append(a + i)
        cols.append(best[i, j])
        dists.append(exact[i, j])
    if not rows:
        return np.array([], int), np.array([], int), np.array([], float)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dists)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column])


def knn(
    queries: DataFrame,
    library: DataFrame,
    k: int,
    *,
    query_id: str,
    library_id: str,
    features: str = "features",
    carry: Sequence[str] = (),
    by: Sequence[str] = (),
    skip_same_id: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact Euclidean ``k`` nearest library rows: ``query_id, neighbor_id, rank, distance``.

    ``carry`` columns of the library (a label, a weight) come along.  With ``by`` every
    asset is searched only against its own library.
    """
    if k < 1:
        raise ValueError(f"k must be positive, got {k}")
    g = list(by)
    q = queries.select(*g, F.col(query_id).alias("__q"), doubles(features).alias("__v"))
    lib = library.select(*g, F.col(library_id).alias("neighbor_id"), doubles(features).alias("__v"), *carry)
    shape = lib.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("__v")).alias("d")).first()
    kinds = {f.name: f.dataType.simpleString() for f in (*q.schema, *lib.schema)}
    fields = [*g, "__q", "neighbor_id", *carry]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in fields) + ", distance double, rank long"
    empty = pd.DataFrame(columns=[*fields, "distance", "rank"])

    def search(qs: pd.DataFrame, ls: pd.DataFrame, matrix: np.ndarray | None = None) -> pd.DataFrame:
        if not len(qs) or not len(ls):
            return empty
        r, c, d = nearest(
            _matrix(qs["__v"]),
            qs["__q"].to_numpy(),
            _matrix(ls["__v"]) if matrix is None else matrix,
            ls["neighbor_id"].to_numpy(),
            k,
            skip_same_id,
        )
        left = qs[[*g, "__q"]].iloc[r].reset_index(drop=True)
        right = ls[["neighbor_id", *carry]].iloc[c].reset_index(drop=True)
        # Results come query by query in order, so the rank is a running count.
        rank = pd.Series(r).groupby(r).cumcount().to_numpy() + 1 if len(r) else r
        return pd.concat([left, right], axis=1).assign(distance=d, rank=rank)

    if (shape["n"] or 0) * (shape["d"] or 0) * 8 <= broadcast_bytes:
        table = lib.toPandas()
        groups = table.groupby(g) if g else [((), table)]
        # Vectors go as one matrix for each asset, which takes no more than their numbers.
        shared = queries.sparkSession.sparkContext.broadcast(
            {key: (rows.drop(columns="__v"), _matrix(rows["__v"])) for key, rows in groups if len(rows)}
        )

        def local(batches):
            for pdf in batches:
                for key, rows in pdf.groupby(g) if g else [((), pdf)]:
                    if key in shared.value:
                        yield search(rows, *shared.value[key])

        found = q.mapInPandas(local, schema)
    else:
        best = Window.partitionBy(*g, "__q").orderBy("distance", "neighbor_id")

        def merged(parts: DataFrame) -> DataFrame:
            return parts.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)

        cells = Cells(lib, g, shape["n"], shape["d"])
        by_cell = [*g, CELL]
        # A row is not its own neighbour, so one more is needed to be sure of k.
        first = merged(_blocked(cells.home(q, k + skip_same_id), cells.library, by_cell, shape["d"], search, schema))
        first = cut(first)
        bound = first.groupBy(*g, "__q").agg(F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("__far"))
        second = _blocked(cells.others(q.join(bound, [*g, "__q"], "left"), k + skip_same_id), cells.library, by_cell, shape["d"], search, schema)
        found = merged(first.unionByName(second))
    return found.withColumnRenamed("__q", query_id)


CELL = "__cell"


class Cells:
    """A library dealt to cells around pivots, and the cells that a query has to visit.

    Pivots are library rows drawn by hash, so there are a few for each block of rows and their
    bytes are bounded.  Each row belongs to its nearest pivot; a cell knows its number of rows and
    the range of their distances to the pivot.  A library (of an asset) without a pivot is one cell.
    """

    def __init__(self, lib: DataFrame, by: Sequence[str], n: int, dim: int):
        self.by = list(by)
        rows = max(1, BLOCK_BYTES // (8 * dim))
        share = min(PIVOTS_PER_BLOCK / rows, PIVOT_BYTES / (8 * dim * max(1, n)), 1.0)
        drawn = F.pmod(F.xxhash64(*by, "neighbor_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
        found = lib.filter(drawn).select(*by, "__v").toPandas()
        groups = found.groupby(self.by) if by else [((), found)]
        # Copies of one vector are one pivot.
        pivots = {key: np.unique(_matrix(rows["__v"]), axis=0) for key, rows in groups if len(rows)}
        self.shared = lib.sparkSession.sparkContext.broadcast(pivots)
        self.library = cut(lib.mapInPandas(self._deal(), _widened(lib, (CELL, T.IntegerType()), ("__reach", T.DoubleType()))))
        stats = self.library.filter(F.col(CELL) >= 0).groupBy(*by, CELL).agg(
            F.count(F.lit(1)).alias("n"), F.min("__reach").alias("low"), F.max("__reach").alias("high")
        )
        self.sizes = {}
        for r in stats.collect():
            key = tuple(r[c] for c in by)
            if key not in self.sizes:
                self.sizes[key] = np.tile([[0.0], [np.inf], [-np.inf]], len(pivots[key]))
            self.sizes[key][:, r[CELL]] = r["n"], r["low"], r["high"]

    def _deal(self):
        shared, by = self.shared, self.by

        def deal(batches):
            for pdf in batches:
                for key, rows in pdf.groupby(by) if by else [((), pdf)]:
                    if key in shared.value:
                        far, _ = _to_pivots(rows, shared.value[key])
                        cell = far.argmin(axis=1)
                        yield rows.assign(**{CELL: cell.astype(np.int32), "__reach": far[np.arange(len(rows)), cell]})
                    else:
                        yield rows.assign(**{CELL: np.int32(-1), "__reach": 0.0})

        return deal

    def _visits(self, q: DataFrame, choose) -> DataFrame:
        """A row for each query and cell that ``choose(rows, distances, slack, sizes)``, a boolean matrix, names."""
        shared, by, sizes = self.shared, self.by, self.sizes
        names = [c for c in q.columns if c != "__far"]

        def visit(batches):
            for pdf in batches:
                for key, rows in pdf.groupby(by) if by else [((), pdf)]:
                    if key in sizes:
                        far, slack = _to_pivots(rows, shared.value[key])
                        i, cell = np.nonzero(choose(rows, far, slack, sizes[key]))
                        yield rows[names].iloc[i].assign(**{CELL: cell.astype(np.int32)})
                    elif not choose.later:
                        yield rows[names].assign(**{CELL: np.int32(-1)})

        return q.mapInPandas(visit, _widened(q.select(*names), (CELL, T.IntegerType())))

    def home(self, q: DataFrame, enough: int) -> DataFrame:
        """Queries with the nearest cells that hold ``enough`` rows together."""

        def choose(rows, far, slack, sizes):
            return _nearest_cells(far, sizes, enough)

        choose.later = False
        return self._visits(q, choose)

    def others(self, q: DataFrame, enough: int) -> DataFrame:
        """Queries with the other cells that may hold a row within ``__far``, where NULL is any distance."""

        def choose(rows, far, slack, sizes):
            limit = rows["__far"].to_numpy(dtype=float)
            limit = np.where(np.isnan(limit), np.inf, limit)[:, None] + slack
            n, low, high = sizes
            least = np.maximum(far - high, low - far)
            return (least <= limit) & (n > 0) & ~_nearest_cells(far, sizes, enough)

        choose.later = True
        return self._visits(q, choose)


def _widened(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in fields]])


def _to_pivots(rows: pd.DataFrame, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of rows to pivots, and a bound of their error and that of a cell's range."""
    v = _matrix(rows["__v"])
    sq, sq_p = (v * v).sum(axis=1)[:, None], (pivots * pivots).sum(axis=1)[None, :]
    far = np.sqrt(np.maximum(sq + sq_p - 2.0 * (v @ pivots.T), 0.0))
    return far, 1e-5 * (1.0 + np.sqrt(sq) + np.sqrt(sq_p.max()))


def _nearest_cells(far: np.ndarray, sizes: np.ndarray, enough: int) -> np.ndarray:
    """The nearest cells of each row that hold ``enough`` rows together."""
    order = np.argsort(far, axis=1, kind="stable")
    before = np.cumsum(sizes[0][order], axis=1) - sizes[0][order]
    chosen = np.zeros(far.shape, bool)
    np.put_along_axis(chosen, order, before < enough, axis=1)
    return chosen & (sizes[0] > 0)


def _blocked(q: DataFrame, lib: DataFrame, g: list[str], dim: int, search, schema: str) -> DataFrame:
    block = max(1, BLOCK_BYTES // (8 * dim))
    cells = lib.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / block).alias("__nl"))
    wide = q.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / min(QUERY_BLOCK, block)).alias("__nq"))
    # One row per asset: the number of blocks on each side.
    plan = cells.join(wide, g) if g else cells.join(F.broadcast(wide))

    def spread(df: DataFrame, own: str, other: str, key: str) -> DataFrame:
        sized = df.join(plan, g) if g else df.join(F.broadcast(plan))
        mine = F.pmod(F.xxhash64(key), F.col(own)).alias(f"{own}_b")
        # Fresh aliases keep the two sides apart when both come from one table.
        return sized.select(
            *[F.col(c).alias(c) for c in df.columns], mine, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"{other}_b")
        )

    qs = spread(q, "__nq", "__nl", "__q")
    ls = spread(lib, "__nl", "__nq", "neighbor_id")
    cell = [*g, "__nq_b", "__nl_b"]
    return qs.groupBy(*cell).cogroup(ls.groupBy(*cell)).applyInPandas(lambda left, right: search(left, right), schema)


def vote(
    neighbors: DataFrame, query_id: str, label: str = "label", *, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Majority label per query with vote shares.

    Most votes (or summed weight) win; ties go to the smaller summed distance, then to
    the smaller label.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    votes = neighbors.groupBy(*by, query_id, label).agg(
        F.sum(w).alias("__votes"), F.sum("distance").alias("__distance")
    )
    score = F.struct((-F.col("__votes")).alias("a"), F.col("__distance").alias("b"), F.col(label).alias("c"))
    # A query has at most k labels, so the entry list is short.
    entries = F.map_from_entries(
        F.array_sort(F.collect_list(F.struct(F.col(label).cast("string").alias("l"), F.col("__votes").alias("v"))))
    )
    out = votes.groupBy(*by, query_id).agg(
        F.min_by(label, score).alias("predicted"), F.sum("__votes").alias("__all"), entries.alias("__share")
    )
    shares = F.transform_values("__share", lambda _, v: v / F.col("__all"))
    return out.withColumn("probabilities", shares).drop("__all", "__share")


def prototypes(shots: DataFrame, label: str = "label", features: str = "features", by: Sequence[str] = ()) -> DataFrame:
    """Mean vector per class, combined before the shuffle."""
    mean = Summarizer.mean(array_to_vector(doubles(features)))
    return shots.groupBy(*by, label).agg(vector_to_array(mean).alias("features"), F.count(F.lit(1)).alias("shots"))


def nearest_prototype(
    queries: DataFrame,
    protos: DataFrame,
    n_classes: int,
    *,
    query_id: str,
    label: str = "label",
    features: str = "features",
    by: Sequence[str] = (),
) -> DataFrame:
    """Class of the closest prototype; probabilities are the softmax of the negative distances."""
    near = knn(
        queries.withColumnRenamed(features, "features"),
        protos.withColumn("__class", F.col(label)),
        n_classes,
        query_id=query_id,
        library_id=label,
        by=by,
    )
    # Distances to all classes of one query: as many rows as there are classes.
    out = near.groupBy(*by, query_id).agg(
        F.min_by("neighbor_id", F.struct("distance", "neighbor_id")).alias("predicted"),
        F.min("distance").alias("distance"),
        F.array_sort(F.collect_list(F.struct(F.col("neighbor_id").cast("string").alias("l"), F.col("distance").alias("d")))).alias("__d"),
    )
    weights = F.transform("__d", lambda e: F.struct(e["l"].alias("l"), F.exp(F.col("distance") - e["d"]).alias("w")))
    out = out.withColumn("__w", weights)
    out = out.withColumn("__t", F.aggregate("__w", F.lit(0.0), lambda a, e: a + e["w"]))
    shares = F.map_from_entries(F.transform("__w", lambda e: F.struct(e["l"], e["w"] / F.col("__t"))))
    return out.withColumn("probabilities", shares).drop("__d", "__w", "__t")
