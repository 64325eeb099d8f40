from __future__ import annotations

import os
import random
import re

import pytest
from edge import empty, frame
from test_simhash import brute_print

import corpus_pipeline
from sensorspark.llm import mixing, simhash
from sensorspark.session import fresh_path

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def shingles(text: str) -> set:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


@needs_data
def test_near_duplicates_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    sets = [shingles(r.text) for r in rows]
    by: dict = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {(a, b) for own in by.values() if len(own) < 200 for b in own for a in own if a < b}
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {rows[i].doc_id for i in range(len(rows)) if find(i) == i}
    got = {r.doc_id for r in simhash.keep_one(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert want <= got and len(got - want) <= 0.02 * (len(rows) - len(want))


def odd_pairs(seed: int) -> list[str]:
    """Texts that were appended to, use few words, were permuted in blocks, form chains, or crowd under one passage."""
    r = random.Random(seed)
    many, few = [f"w{i}" for i in range(5_000)], [f"v{i}" for i in range(12)]
    prose = lambda n, of=many: [r.choice(of) for _ in range(n)]
    out = []
    for extra in (10, 25, 45, 49, 50, 55):
        for _ in range(6):
            base = prose(200)
            out += [base, base + prose(extra)]
    for _ in range(15):
        base = prose(600, few)
        out += [base, base + prose(40, few), base[: 500 + r.randrange(90)]]
    for _ in range(8):
        base = prose(400)
        out += [base, base[200:] + base[:200], base[300:] + base[100:300] + base[:100]]
    # Each follows the last one closely; the ends have nothing in common, and all stand beside one passage.
    passage, own = prose(60), prose(120)
    for i in range(60):
        out.append(passage + own)
        own = own[5:] + prose(5)
    # Many share most of a passage: some by enough, others by a little less.
    for i in range(60):
        out.append(passage * 3 + prose(r.choice([20, 40, 44, 60, 200])))
    out += [prose(n) for n in (1, 2, 3, 4, 5, 6)]
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("crowd", [simhash.CROWD, 7])
def test_near_duplicates_lose_no_link(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    texts = odd_pairs(5)
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(texts)):
        for a in range(b):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = [i for i in range(len(texts)) if find(i) == i]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == want


def test_the_mix_drops_what_it_does_not_take(spark):
    docs = spark.createDataFrame([(i, f"word {i}", "abc"[i % 3]) for i in range(60)] + [(60, "", "a")], "doc_id long, text string, source string")
    want = {r.doc_id: r.taken for r in mixing.mix(docs, 1.5, 2).collect()}
    got = {r.doc_id: r.taken for r in corpus_pipeline.source_mix(spark, docs, SMALL).collect()}
    assert 0 in want.values() and got == {d: n for d, n in want.items() if n > 0}


@needs_data
def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = fresh_path(spark, name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() <= before
        before = docs.count()
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert before > 150 and {"taken", "target"} <= set(docs.columns)


@needs_data
@pytest.mark.parametrize("make", [frame, empty])
def test_odd_rows(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh_path(spark, name)
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    corpus_pipeline.source_mix(spark, docs, SMALL).count()


@pytest.mark.parametrize("repeated", [False, True])
def test_the_stage_joins_fingerprints_and_shingles(spark, repeated):
    texts = odd_pairs(5) + ["", "  \n", "!!!"]
    sets, prints = [shingles(t) for t in texts], [brute_print(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_print = 0
    for b in range(len(texts)):
        for a in range(b):
            alike = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            near = (prints[a] ^ prints[b]).bit_count() <= simhash.MOST
            by_print += near and not alike
            if alike or near:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = [i for i in range(len(texts)) if find(i) == i]
    assert by_print
    # Rows without an id come first; rows that come twice are near duplicates of each other.
    rows = [(i or None, t, "s") for i, t in enumerate(texts)] * (1 + repeated)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    stays = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert stays.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in stays.collect()) == want
