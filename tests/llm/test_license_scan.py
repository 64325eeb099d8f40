from __future__ import annotations

import random
import re

from edge import SCHEMA, empty, frame, prose, rows

from sensorspark.llm import license_scan as L

TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License. Really, the MIT license; mit LICENSE",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License v2.1 or later",
    "SPDX-License-Identifier: BSD-3-Clause\n" + prose(50, 9) + "\nMIT License",
    "Licensed under CC BY-NC 4.0.",
    "mit licenses and permit license are none; mit the license neither",
    "Licensed under a private licence. All rights reserved, see the licence.",
    "mit license mit license apache license general public license",
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def brute_labels(text):
    """Every rule on the whole text, then suppression by comparing all detections."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    norm = " " + " ".join(words) + " "
    hits = []
    for i, r in enumerate(L.rules()):
        for m in re.finditer(r["pattern"], norm):
            begin = norm[: m.start()].count(" ")
            hits.append((begin, begin + m[0].count(" ") + 1, r["priority"], i, r["label"]))
    hits.sort(key=lambda h: (h[0], -h[1], h[2], h[3]))
    left = []
    for h in hits:
        if not left or h[1] > max(x[1] for x in left):
            left.append(h)
    stays = []
    for i, h in enumerate(left):
        before = i and left[i - 1][1] > h[0] and left[i - 1][2] < h[2]
        after = i + 1 < len(left) and left[i + 1][0] < h[1] and left[i + 1][2] < h[2]
        if not before and not after:
            stays.append(h[4])
    return stays


def test_against_brute_force(spark):
    source = [(i, t, None, None, None, 0, "", 0, "") for i, t in enumerate(TEXTS)] + [r for r in rows() if r[0] is None or r[0] != 2]
    got = {(r.doc_id, r.n_words): r for r in L.scan(spark.createDataFrame(source, SCHEMA).filter("true")).collect()}
    for r in source:
        want = brute(r[1])
        row = got[(r[0], want[0])]
        if r[0] is None or r[0] >= len(TEXTS) or r[1] == TEXTS[r[0]]:
            assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == want or sum(x[0] == r[0] for x in source) > 1
    by_id = {r.doc_id: r for r in L.scan(spark.createDataFrame(source[: len(TEXTS)], SCHEMA)).collect()}
    for i, t in enumerate(TEXTS):
        row, base, more = by_id[i], brute(t), brute_labels(t)
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == base
        assert row.labels == ",".join(sorted(set(filter(None, base[4].split(","))) | set(more)))
        assert row.n_detections == len(more)
        assert 0 <= row.score <= 1
    assert by_id[0].labels == "apache,apache-2.0"
    assert by_id[2].labels == "gpl,gpl-3.0"
    assert by_id[3].labels == "gpl,lgpl-2.1"
    assert by_id[5].labels == "cc-by-nc-4.0"
    assert by_id[6].labels == ""


def brute_score(text):
    """Labels and best score of every rule on the whole normalised text, without gate, keywords or suppression."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    norm = " " + " ".join(words) + " "
    hits = [(r["label"], r["score"]) for r in L.rules() if re.search(r["pattern"], norm)]
    return {h[0] for h in hits}, max((h[1] for h in hits), default=0.0)


def test_notices_without_the_word_license(spark):
    want = {
        "Released under the GPL v2 or later.": "gpl-2.0",
        "distributed under the terms of the Apache 2.0": "apache-2.0",
        "Published under CC BY-SA 4.0": "cc-by-sa-4.0",
        "GPL-3.0-only": "gpl-3.0",
        "x\nCC-BY\n\t4.0": "cc-by-4.0",
        "released into the public\ndomain": "public-domain",
        "it is free and unencumbered, see the Unlicense": "unlicense",
        "permit, submit and gplv2x are words": "",
        "": "",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(want)], "doc_id long, text string")
    got = {x.doc_id: x for x in L.scan(df).collect()}
    for i, (text, labels) in enumerate(want.items()):
        found, best = brute_score(text)
        assert got[i].labels == labels and set(filter(None, labels.split(","))) <= found
        assert got[i].score == best and (best > 0) == bool(labels)


def test_the_gate_passes_all_that_a_rule_finds(spark):
    r = random.Random(6)
    pieces = ["released", "under", "the", "GPL", "v2", "or later", "MIT", "Apache", "2.0", "CC", "BY", "public", "domain", "placed", "in", "BSD", "3", "clause", "license", "spdx", "identifier", "all rights reserved", "a"]
    texts = ["".join(r.choice(pieces) + r.choice([" ", "-", "\n", ". ", " \t"]) for _ in range(r.randint(1, 14))) for _ in range(2000)]
    got = {x.doc_id: x for x in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = 0
    for i, text in enumerate(texts):
        base, more = brute(text), brute_labels(text)
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == base
        assert got[i].n_detections == len(more)
        assert got[i].labels == ",".join(sorted(set(filter(None, base[4].split(","))) | set(more)))
        found += bool(more)
    assert found > 250


def test_edge_rows(spark):
    assert L.scan(frame(spark)).count() == len(rows())
    assert L.scan(empty(spark)).count() == 0
    assert len(L.rules()) > 250
