"""A Merkle tree over the rows of a dataset, with the proof of every row.

The leaves of a source are cut into superblocks of ``FAN ** LEVELS`` neighbours, so a source of
any size is many groups of one size.  Each block is reduced to one node; the nodes of a source
are leaves of the same problem, a few thousand times smaller, so a few rounds reach the root.
On the way back each block is cogrouped with the nodes outside it that its proofs need: they are
the same few for all of its leaves.  The group finishes its own reduction, joins both halves of
the proofs and folds every leaf up to the root.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.session import cut

FAN = 3
LEVELS = 7
# Rows of a range while positions are counted.
RANGE_ROWS = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: str = "text") -> Column:
    """The digest of a row of documents, with ``text`` as its text."""
    return F.sha2(F.concat(*[field(F.col(text if c == "text" else c)) for c in FIELDS]), 256)


def positions(rows: DataFrame, group: str, order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``pos``, the number of rows of the same group before it in ``order``, and ``size``, that of all.

    The order must be total.  Rows are dealt to ranges of ``(group, order)``, which are written;
    the counts of the ranges before one are its offset, so no group is ranked in one task.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, -(-rows.count() // range_rows))
    dealt = cut(rows.repartitionByRange(n, group, *order).withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(group, "range").agg(F.count("*").alias("rows"))
    offsets = counts.select(
        group,
        "range",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.partitionBy(group)).alias("size"),
    )
    inside = Window.partitionBy(group, "range").orderBy(*order)
    ranked = dealt.withColumn("place", F.row_number().over(inside) - 1)
    return ranked.join(offsets, [group, "range"]).withColumn("pos", F.col("offset") + F.col("place")).drop("range", "place", "offset")


def reduce_block(nodes: list[str], height: int) -> list[list[str]]:
    """The levels over ``nodes``, from themselves up to ``height`` levels above."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def path(levels: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """What leads from node ``i`` up: its place in each run, and the others of the run, joined."""
    places, others = [], []
    for nodes in levels[:-1]:
        run = i - i % FAN
        places.append(i - run)
        others.append("".join(nodes[run:i] + nodes[i + 1 : run + FAN]))
        i //= FAN
    return places, others


SIZE = 64  # Characters of a digest.


def fold(node: str, places: list[int], others: list[str]) -> str:
    """The root that ``node`` leads to."""
    for place, rest in zip(places, others):
        node = digest(rest[: place * SIZE] + node + rest[place * SIZE :])
    return node


PROVEN = "group string, pos long, root string, places array<int>, others array<string>"


def superblocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (``group``, ``pos``, ``size`` of the group, ``node`` and more) with ``block`` and ``height``,
    the levels to reduce the block by.

    Blocks of a group with several are reduced by ``levels``; a group that fits one block by
    what it takes to become one node.
    """
    need = sum(F.when(F.col("size") > FAN**k, 1).otherwise(0) for k in range(levels))
    return nodes.withColumn("height", need).withColumn("block", F.expr(f"pos div {FAN**levels}"))


def outer_paths(blocks: DataFrame, levels: int) -> DataFrame:
    """``(group, block, root, places, others)``: the way from the top of each block to the root of its group.

    The tops of the blocks are the nodes of a tree of the same kind.
    """

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        node = reduce_block(rows["node"].tolist(), int(rows["height"].iloc[0]))[-1][0]
        one = rows.iloc[:1]
        size = -(-one["size"] // FAN**levels)
        return pd.DataFrame({"group": one["group"], "pos": one["block"], "size": size, "node": [node]})

    small = blocks.select("group", "pos", "size", "node", "block", "height")
    tops = cut(small.groupBy("group", "block").applyInPandas(top, "group string, pos long, size long, node string"))
    above = tops.filter("size > 1")
    done = tops.filter("size = 1").select(
        "group",
        F.col("pos").alias("block"),
        F.col("node").alias("root"),
        F.array().cast("array<int>").alias("places"),
        F.array().cast("array<string>").alias("others"),
    )
    if above.isEmpty():
        return done
    return done.unionByName(climb(above, levels).withColumnRenamed("pos", "block"))


def finish(blocks: DataFrame, outer: DataFrame, result, schema: str) -> DataFrame:
    """Each block with its way to the root: what ``result(rows, outside, paths)`` returns for it.

    ``rows`` are those of the block in order of ``pos``, ``outside`` is its row of ``outer`` and
    ``paths`` has the places and the other nodes from each row to the root.
    """

    def join(rows: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        inner = reduce_block(rows["node"].tolist(), int(rows["height"].iloc[0]))
        way = outside.iloc[0]
        paths = []
        for i in range(len(rows)):
            places, others = path(inner, i)
            paths.append(([*places, *way["places"]], [*others, *way["others"]]))
        return result(rows, way, paths)

    return blocks.groupBy("group", "block").cogroup(outer.groupBy("group", "block")).applyInPandas(join, schema)


def climb(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The root of the group of each node, and the way there: rows of ``PROVEN``."""

    def proven(rows: pd.DataFrame, way: pd.Series, paths: list) -> pd.DataFrame:
        out = rows[["group", "pos"]].copy()
        out["root"] = way["root"]
        out["places"], out["others"] = [p for p, _ in paths], [o for _, o in paths]
        return out

    blocks = superblocks(nodes, levels)
    return finish(blocks, outer_paths(blocks, levels), proven, PROVEN)


def manifest(docs: DataFrame, tampered: Column | None = None, with_proofs: bool = True, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified, places, others)``.

    One row for each row of ``docs`` (``FIELDS``).  ``leaf`` is the digest of the row, ``subroot``
    the root of its source, ``root`` that of the dataset.  The proof is, run by run from the leaf
    to the root, the place of the node in the run and the other nodes, joined; ``proof_sha256``
    is the digest of all of these nodes.  ``folded_root`` follows the proof from the leaf of the
    row with its text replaced by ``tampered`` (by default nothing is replaced), and ``verified``
    tells whether that gives ``root``.  Without ``with_proofs`` the last two columns are left out.

    A NULL value is ``-``.  NULL sources come first, rows without ``doc_id`` first in their
    source; rows of one source and ``doc_id`` are ordered by leaf, and equal leaves by tampered
    leaf and place in the input.  An empty table has no leaves and gives no rows.
    """
    texts = docs.select(*FIELDS, (F.col("text") if tampered is None else tampered).alias("tampered_text"))
    # A source as a key that is never NULL and sorts like it, NULL first.
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    leaves = cut(
        texts.select(
            key.alias("group"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf().alias("node"),
            leaf("tampered_text").alias("changed"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    placed = cut(positions(leaves, "group", ["doc_id", "node", "changed", "row"]).drop("row"))
    blocks = superblocks(placed, levels)
    inside = cut(outer_paths(blocks, levels))

    # The roots of the sources are the leaves of the tree above them.
    subroots = inside.filter("block = 0").select(F.lit("").alias("group"), F.col("group").alias("source"), F.col("root").alias("node"))
    sources = cut(positions(subroots, "group", ["source"]))
    roots = sources.join(climb(sources, levels), ["group", "pos"]).select(
        F.col("source").alias("group"), F.col("root").alias("top"), F.col("places").alias("more"), F.col("others").alias("rest")
    )
    outer = inside.join(roots, "group").select(
        "group",
        "block",
        F.col("root").alias("subroot"),
        F.col("top").alias("root"),
        F.concat("places", "more").alias("places"),
        F.concat("others", "rest").alias("others"),
    )

    def proven(rows: pd.DataFrame, way: pd.Series, paths: list) -> pd.DataFrame:
        out = rows[["doc_id", "group"]].copy()
        out["leaf"], out["subroot"], out["root"] = rows["node"], way["subroot"], way["root"]
        out["proof_sha256"] = [digest("".join(o)) for _, o in paths]
        out["folded_root"] = [fold(node, *p) for node, p in zip(rows["changed"], paths)]
        out["verified"] = out["folded_root"] == out["root"]
        if with_proofs:
            out["places"], out["others"] = [p for p, _ in paths], [o for _, o in paths]
        return out

    names = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names += ", places array<int>, others array<string>" * with_proofs
    # Ids travel as text: pandas has no whole numbers that may be missing.
    blocks = blocks.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = finish(blocks, outer, proven, f"doc_id string, group string, {names}")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("group") != "", F.expr("substring(group, 2)")).alias("source"),
        *[c.split()[0] for c in names.split(", ")],
    )
