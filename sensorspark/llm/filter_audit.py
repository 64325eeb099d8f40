"""What each quality filter removes, in every order of the filters.

A document is reduced to the set of filters it fails (a bit mask), and the table to one count
for each part and mask.  From those all coalitions are tabulated: how many documents a set of
filters removes, whatever its order.  A step of an order is the difference of two coalitions.
The Shapley value of a filter is the solution of least squares over the coalitions, weighted
by the Shapley kernel and constrained to share out what all filters remove; it is solved in
rationals, so it is exact.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import SPACED_WORD, text_or_empty

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10


def text_conditions(text: Column) -> list[Column]:
    """Failure conditions A to D of a text: short, repetitive, capitals, symbols."""
    words = F.array_remove(F.split(text, SPACED_WORD.replace("^", ""), -1), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def mask(conditions: list[Column]) -> Column:
    """Bit ``i`` is set where condition ``i`` holds."""
    return sum(F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)).cast("int")


def failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, fails, n)``: rows of ``docs`` counted by id, part and mask of A to E.

    ``part`` is the language, empty for NULL.  E holds for a text that a smaller ``doc_id``
    has too; rows of one id do not make each other fail, and a row without an id neither
    fails E nor makes others fail.  A text is known by its SHA-256.  Only rows without texts
    are shuffled, counted before each shuffle, and no key is a text alone once its smallest
    id is known, so copies of one text are spread by their ids.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        mask(text_conditions(text)).alias("fails"),
        F.sha2(text, 256).alias("digest"),
    )
    counted = rows.groupBy("digest", "doc_id", "part", "fails").agg(F.count("*").alias("n"))
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    told = counted.join(first, ["digest", "doc_id"], "left").withColumn(
        "fails", F.col("fails") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    )
    return told.groupBy("doc_id", "part", "fails").agg(F.sum("n").alias("n"))


def coalitions(failed: DataFrame, labels: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """``(part, coalition, docs, removed, good, toxic)``, one row for each part and set of filters.

    ``removed`` counts the documents that fail a filter of the set, ``good`` and ``toxic``
    those of them labelled quality=1 and toxic=1, ``docs`` all of the part.  Several labels of
    one ``doc_id`` count once; labels of unknown documents count nowhere.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic")
    )
    counts = (
        failed.join(known, "doc_id", "left")
        .groupBy("part", "fails")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("n_good"),
            F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("n_toxic"),
        )
    )
    every = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
    hit = F.col("fails").bitwiseAND(F.col("coalition")) != 0
    return every.groupBy("part", "coalition").agg(
        F.sum("n").alias("docs"),
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(a) for c, a in (("n", "removed"), ("n_good", "good"), ("n_toxic", "toxic"))],
    )


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of linear equations, by elimination in rationals."""
    n = len(matrix)
    rows = [[*line, b] for line, b in zip(matrix, right)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [line[n] for line in rows]


def shapley(value: list[int], n: int) -> list[Fraction]:
    """Shapley values of the game ``value[coalition]`` by constrained least squares.

    Minimises the sum over the proper coalitions S of ``w(S) (value(S) - sum of x over S)^2``,
    with ``w = (n - 1) / (C(n, s) s (n - s))``, under ``sum of x = value(all)``: the normal
    equations and the constraint, with its multiplier as the last unknown.
    """
    full = (1 << n) - 1
    gain = [v - value[0] for v in value]
    normal = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for s in range(1, full):
        members = [i for i in range(n) if s >> i & 1]
        k = len(members)
        weight = Fraction(n - 1, comb(n, k) * k * (n - k))
        for i in members:
            right[i] += weight * gain[s]
            for j in members:
                normal[i][j] += weight
    for i in range(n):
        normal[i][n] = normal[n][i] = Fraction(1)
    right[n] = Fraction(gain[full])
    return solve(normal, right)[:n]


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def steps(table: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from the table of coalitions.

    A part is one group of ``2 ** n`` rows, whatever the number of its documents.
    """
    n = len(names)
    full = (1 << n) - 1

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        by = rows.set_index("coalition").sort_index()
        docs = int(by["docs"].iloc[0])
        removed, good, toxic = (by[c].tolist() for c in ("removed", "good", "toxic"))
        # Summed over all orders, as whole numbers.
        shares = [int(x * factorial(n)) for x in shapley(removed, n)]
        out = []
        for order in permutations(range(n)):
            before = 0
            for step, i in enumerate(order, 1):
                after = before | 1 << i
                here = removed[after] - removed[before]
                out.append(
                    (
                        rows["part"].iloc[0],
                        "".join(names[j] for j in order),
                        step,
                        docs - removed[after],
                        here,
                        removed[1 << i] - here,
                        removed[full] - removed[full & ~(1 << i)],
                        good[after] - good[before],
                        toxic[after] - toxic[before],
                        shares[i],
                    )
                )
                before = after
        return pd.DataFrame(out, columns=[c.split()[0] for c in STEPS.split(", ")])

    return table.groupBy("part").applyInPandas(of_part, STEPS)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Filters A to E on ``docs`` (``doc_id``, ``text``, ``lang``), with ``labels`` (``doc_id``,
    ``quality``, ``toxic``): the steps of all 120 orders for each part; see ``steps``.

    A NULL text is empty; it is short, and a copy of every other empty text.  A table without
    rows has no parts and gives no rows.
    """
    return steps(coalitions(failures(docs), labels))
