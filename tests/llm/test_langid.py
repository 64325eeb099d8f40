from __future__ import annotations

import itertools
import os

import numpy as np
import pytest
from edge import empty, frame, rows
from pyspark.sql import functions as F

from sensorspark.llm import langid as L

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    word = np.array([0, 0, 5, 6, 10])
    score = rng.normal(size=(10, 3)).astype(np.float32)
    got = L.viterbi(score, word, 0.7)
    for a, b in zip(word[:-1], word[1:]):

        def value(path):
            return sum(score[a + i, s] for i, s in enumerate(path)) - 0.7 * sum(x != y for x, y in zip(path, path[1:]))

        best = max(map(value, itertools.product(range(3), repeat=b - a)))
        assert abs(value(got[a:b]) - best) < 1e-5


@pytest.mark.skipif(not os.path.exists(DATA), reason="test tables are not here")
def test_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet(DATA)
    model = L.fit(docs.filter(~L.held_out()))
    out = L.label(docs, model, keep=("doc_id", "lang")).withColumn("held", L.held_out()).collect()
    held = [r for r in out if r.held]
    assert len(held) > 150 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out)
    mixed = docs.filter("lang = 'de'").limit(1).collect()[0].text[:800] + "\n" + docs.filter("lang = 'fr'").limit(1).collect()[0].text[:500]
    (r,) = L.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    assert r.lang_pred == "de" and [s.lang for s in r.spans] == ["de", "fr"] and abs(r.spans[1].begin - 801) < 60


def test_edge_rows(spark):
    model = L.fit(frame(spark).withColumn("lang", F.coalesce("lang", F.lit("xx"))))
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 6)) if r.doc_id is not None else (-9, r.lang_pred, 0) for r in L.label(frame(spark), model).collect())
    assert len(got) == len(rows())
    und = {r[0] for r in got if r[1] == "und"}
    assert {3, 4, 5} <= und and not und & {1, 2, 8, 10, 12}
    assert L.label(empty(spark), model).count() == 0
    nothing = L.fit(empty(spark))
    assert {r.lang_pred for r in L.label(frame(spark), nothing).collect()} == {"und"}
    assert L.accepted(frame(spark)).columns == frame(spark).columns


def test_scripts_narrow_candidates(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "кошка и собака", "ru")], "doc_id long, text string, lang string")
    out = L.label(spark.createDataFrame([(1, "ф"), (2, "q"), (3, "собака the")], "doc_id long, text string"), L.fit(df)).collect()
    assert [r.lang_pred for r in sorted(out)] == ["ru", "en", "ru"]
