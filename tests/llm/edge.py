"""Small tables with every odd case: NULLs, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

VOCABULARY = [a + b for a in ("ba", "de", "ki", "lo", "mu", "ra", "so", "ti") for b in ("", "n", "st", "lur", "mek", "vo")]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def rows() -> list[tuple]:
    """``(doc_id, text, lang, source, n_chars, key, copy, size, fp)``; the last four only clash."""
    base = prose(120, 1)
    texts = [
        (1, base), (2, base), (2, base), (2, base + " more"), (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "one two"),
        (8, prose(4000, 2)), (9, base.replace("ba", "BA")), (10, "Ünïcode ßtraße naïve 漢字 кошка"), (None, "no id at all"),
        (None, None), (11, prose(90, 3) + " " + base), (12, "a" * 5000), (13, "tab\tand\x0bother\x0cspace\rhere\nend"), (-4, "minus four"),
    ]
    return [(i, t, "en" if n % 3 else None, None if n % 5 == 0 else f"s{n % 2}", None, 7, "x", 3, "y") for n, (i, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key int, copy string, size int, fp string"


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
