from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import pytest
from edge import SCHEMA, empty, rows
from pyspark.sql import functions as F

from sensorspark.llm import merkle as M


def H(s):
    return sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute(docs):
    """Rows of ``(doc_id, source, lang, n_chars, text)``: whole trees in memory, sorted results."""
    by_source = {}
    for d in docs:
        changed = d[4]
        if d[0] is not None and crc32(str(d[0]).encode()) % 2 == 0 and changed is not None:
            changed = changed.replace("\n", "")
        by_source.setdefault(d[1], []).append((d[0], leaf(d), leaf((*d[:4], changed))))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[s] = tree([x[1] for x in by_source[s]])
    crown = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (doc_id, own, node) in enumerate(by_source[s]):
            proof = []
            for levels, at in ((trees[s], i), (crown, k)):
                for nodes in levels[:-1]:
                    run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
                    here = at % 3
                    proof += run[:here] + run[here + 1 :]
                    node = H("".join([*run[:here], node, *run[here + 1 :]]))
                    at //= 3
            root = crown[-1][0]
            out.append((doc_id, own, trees[s][-1][0], root, H("".join(proof)), node, node == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def run(df, levels):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return M.manifest(df, tampered, levels=levels)


def result(df, levels):
    return sorted((tuple(r) for r in run(df, levels).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_whole_trees(spark, levels):
    """Sources of 1 to 100 leaves and one of 400; small blocks give several rounds."""
    r = random.Random(levels)
    sizes = {None: 1, "": 3, "a": 9, "b": 10, "é": 28, "z": 100, "hot": 400, "B": 2}
    docs = []
    for s, n in sizes.items():
        for _ in range(n):
            text = r.choice([None, "", "x\ny", "line\n", "no break", "ünï\n漢"])
            docs.append((len(docs) * 7 - 300, s, r.choice([None, "en"]), r.choice([None, 3]), text))
    r.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    assert result(df, levels) == brute(docs)


def test_odd_rows(spark):
    odd = rows() + [(None, "a\nb", None, None, None, 1, "x", 1, "y")] * 4
    odd += [(2, "same\n", "en", "s1", 5, 1, "x", 1, "y")] * 5 + [(2**60 + 1, "big", "en", "s1", 5, 1, "x", 1, "y")]
    df = spark.createDataFrame(odd, SCHEMA)
    docs = [(i, s, lang, n, t) for i, t, lang, s, n, *_ in odd]
    got = result(df, 1)
    assert got == brute(docs)
    assert any(x[0] == 2**60 + 1 for x in got)


def test_few_rows(spark):
    assert M.manifest(empty(spark)).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    row = M.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == H("1:1----") and row.verified
    assert row.proof_sha256 == H("") and row.places == []


def test_proofs_lead_to_the_root_and_nothing_else_does(spark):
    docs = [(i, f"s{i % 2}", "en", i, f"text {i}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    got = M.manifest(df, levels=2).collect()
    assert len({x.root for x in got}) == 1 and all(x.verified for x in got)
    for x in got:
        assert M.fold(x.leaf, x.places, x.others) == x.root
        assert M.fold(H("forged"), x.places, x.others) != x.root
    by_lang = M.manifest(df, F.concat("text", F.lit("!")), levels=2)
    assert by_lang.filter("verified").count() == 0


def test_positions_of_a_hot_group(spark):
    rows_ = [("hot" if i % 3 else f"g{i}", i // 5, i) for i in range(2000)]
    df = spark.createDataFrame(rows_, "group string, v long, tie long")
    got = M.positions(df, "group", ["v", "tie"], range_rows=100)
    want = {}
    for g, v, tie in sorted(rows_):
        want[tie] = sum(1 for k in want if rows_[k][0] == g)
    assert {x.tie: x.pos for x in got.collect()} == want
    assert {x.size for x in got.collect() if x.group == "hot"} == {sum(g == "hot" for g, *_ in rows_)}
