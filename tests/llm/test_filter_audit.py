from __future__ import annotations

import random
import re
from itertools import permutations

from edge import SCHEMA, empty, frame, prose, rows

from sensorspark.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int, text string, part string"


def brute(docs, labels):
    """Every order applied to every document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    tables = {}
    for i, text, lang in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        caps = len(re.findall("[A-Z]", text))
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * caps > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        tables.setdefault(lang or "", []).append((i, fails))
    out = {}
    for part, members in tables.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[f] += len(gone)
                failing = [x for _, x in members if x[f]]
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(sum(x.values()) == 1 for x in failing),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


def check(spark, docs, labels):
    df = spark.createDataFrame([(i, t, g, "s", 1, 2, "x", 3, "y") for i, t, g in docs], SCHEMA)
    marks = spark.createDataFrame([(*x, "clash", "clash") for x in labels], LABELS)
    got = A.audit(df, marks).collect()
    assert len(got) == 120 * 5 * len({g or "" for _, _, g in docs})
    assert result(A.audit(df, marks)) == brute(docs, labels)


def test_against_brute_force(spark):
    r = random.Random(11)
    texts = []
    for n in range(60):
        words = [f"w{r.randint(0, 300)}" for _ in range(r.choice([20, 99, 100, 140]))]
        if n % 4 == 0:
            words = [w.upper() if r.random() < 0.4 else w for w in words]
        if n % 5 == 0:
            words.append(r.choice("#$%&*|"))
        texts.append(r.choice([" ", "\n", "\x0b ", "  "]).join(words))
    docs = [(i, r.choice(texts), r.choice(["en", "de", None, ""])) for i in range(150)]
    labels = [(r.randint(0, 160), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(120)]
    check(spark, docs, [*labels, (None, 1, 1)])


def test_odd_rows(spark):
    docs = [(i, t, lang) for i, t, lang, *_ in rows()]
    docs += [(None, docs[0][1], "en"), (1, docs[0][1], "fr"), (1, docs[0][1], "fr"), (0, None, "fr"), (20, "É" * 200 + "A" * 19, "en"), (21, " ".join("ab"), "en")]
    check(spark, docs, [(1, 1, 0), (1, 0, 1), (4, 1, 1), (None, 1, 1)])


def test_boundaries(spark):
    hundred = [f"w{i}" for i in range(100)]
    docs = [
        (1, " ".join(hundred), "a"),
        (2, " ".join(hundred[:99]), "b"),
        (3, " ".join(hundred[:80] * 1 + hundred[:20]), "c"),
        (4, " ".join(hundred[:79] + hundred[:21]), "d"),
        (5, "A" + "b" * 9, "e"),
        (6, "AA" + "b" * 9, "f"),
    ]
    check(spark, docs, [])


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(empty(spark), none).count() == 0
    assert A.audit(frame(spark), none).filter("good_lost <> 0 or toxic_lost <> 0").count() == 0


def test_copies_fill_a_third(spark):
    docs = [(i, "one text" if i % 3 == 0 else prose(5, i), "en") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = result(A.audit(df, spark.createDataFrame([], LABELS)))
    assert got["en", "EABCD", 1][1] == 99
    # Rows of one text do not meet in one task: what is joined is keyed by text and id.
    assert A.failures(df).filter("fails >= 16").count() == 99


def test_shapley_of_any_game():
    r = random.Random(3)
    for n in (2, 3, 4, 5):
        game = [0, *[r.randint(0, 1000) for _ in range((1 << n) - 1)]]
        orders = list(permutations(range(n)))
        want = [0] * n
        for order in orders:
            s = 0
            for i in order:
                want[i] += game[s | 1 << i] - game[s]
                s |= 1 << i
        assert [x * len(orders) for x in A.shapley(game, n)] == want
