from __future__ import annotations

import random
import re

import xxhash
from edge import empty, frame, rows

from sensorspark.llm import simhash


def brute_print(text: str | None) -> int:
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints: list[int]) -> list[int]:
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_edge_rows(spark):
    source = rows()
    prints = [brute_print(r[1]) for r in source]
    groups = brute_groups(prints)
    least = {g: min((source[i][0] for i in range(len(source)) if groups[i] == g and source[i][0] is not None), default=None) for g in set(groups)}
    want = sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(source, prints, groups)), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(frame(spark)).collect()), key=str) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).columns == empty(spark).columns


def test_links_of_random_and_clustered_fingerprints(spark):
    r = random.Random(4)
    prints = [r.getrandbits(64) for _ in range(60)]
    for _ in range(400):
        p = r.choice(prints)
        for b in r.sample(range(64), r.randint(1, 4)):
            p ^= 1 << b
        prints.append(p)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame_ = spark.createDataFrame([(p,) for p in signed], "fp long")
    pairs = [tuple(x) for x in simhash.links(frame_).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in pairs)
    from sensorspark.llm.components import components

    found = {x.node: x.root for x in components(simhash.links(frame_)).collect()}
    got = [found.get(p, p) for p in signed]
    want = brute_groups(prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    source = rows()
    groups = brute_groups([brute_print(r[1]) for r in source])
    assert kept.count() == len(set(groups))
    assert {1, 8, 11} <= {r.doc_id for r in kept.collect()}
