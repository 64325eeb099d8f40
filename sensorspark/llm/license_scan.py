"""License detection by ordered signature rules, with built-in functions only.

A text becomes lower-case words with single spaces between.  Every rule names words that all
its matches hold: one of its keywords, and one more (the word ``under``, a form of ``license``
or the number of the version).  A document whose words name neither is done after one look at
the set of its words; in the others a rule runs only where both of its evidences occur.
Every detection is an interval of words.  One that lies inside another is
suppressed, and of two that overlap the one of the better priority stays.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import numbered

# The phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Names of license families, the identifier they begin with, and the versions
# they exist in.
FAMILIES = [
    ("apache|apache software", "apache", "1 0|1 1|2 0"),
    ("gnu general public|gnu gpl|gpl", "gpl", "1 0|2 0|3 0"),
    ("gnu lesser general public|gnu library general public|gnu lgpl|lgpl", "lgpl", "2 0|2 1|3 0"),
    ("gnu affero general public|affero general public|gnu agpl|agpl", "agpl", "1 0|3 0"),
    ("gnu free documentation|gfdl", "gfdl", "1 1|1 2|1 3"),
    ("mozilla public|mpl", "mpl", "1 0|1 1|2 0"),
    ("eclipse public|epl", "epl", "1 0|2 0"),
    ("eclipse distribution|edl", "edl", "1 0"),
    ("common development and distribution|cddl", "cddl", "1 0|1 1"),
    ("common public|cpl", "cpl", "1 0"),
    ("ibm public", "ipl", "1 0"),
    ("european union public|eupl", "eupl", "1 0|1 1|1 2"),
    ("open software|osl", "osl", "1 0|2 0|2 1|3 0"),
    ("academic free|afl", "afl", "1 1|1 2|2 0|2 1|3 0"),
    ("artistic", "artistic", "1 0|2 0"),
    ("boost software|bsl", "bsl", "1 0"),
    ("business source|busl", "busl", "1 1"),
    ("server side public|sspl", "sspl", "1 0"),
    ("elastic", "elastic", "1 0|2 0"),
    ("microsoft public|ms pl", "ms-pl", ""),
    ("microsoft reciprocal|ms rl", "ms-rl", ""),
    ("creative commons attribution noncommercial sharealike|cc by nc sa", "cc-by-nc-sa", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons attribution noncommercial noderivatives|cc by nc nd", "cc-by-nc-nd", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons attribution noncommercial|cc by nc", "cc-by-nc", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons attribution sharealike|cc by sa", "cc-by-sa", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons attribution noderivatives|cc by nd", "cc-by-nd", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons attribution|cc by", "cc-by", "1 0|2 0|2 5|3 0|4 0"),
    ("creative commons zero|cc0", "cc0", "1 0"),
    ("open data commons attribution|odc by", "odc-by", "1 0"),
    ("open data commons open database|open database|odbl", "odbl", "1 0"),
    ("public domain dedication and|pddl", "pddl", "1 0"),
    ("community data agreement permissive|cdla permissive", "cdla-permissive", "1 0|2 0"),
    ("mit", "mit", ""),
    ("x11", "x11", ""),
    ("isc", "isc", ""),
    ("zlib|zlib libpng", "zlib", ""),
    ("libpng", "libpng", "2 0"),
    ("openssl", "openssl", ""),
    ("php", "php", "3 0|3 01"),
    ("python software foundation|psf", "psf", "2 0"),
    ("ruby", "ruby", ""),
    ("perl", "perl", ""),
    ("postgresql", "postgresql", ""),
    ("zope public|zpl", "zpl", "1 1|2 0|2 1"),
    ("w3c software notice and|w3c", "w3c", ""),
    ("sil open font|ofl", "ofl", "1 0|1 1"),
    ("latex project public|lppl", "lppl", "1 0|1 1|1 2|1 3"),
    ("nasa open source agreement|nosa", "nasa", "1 3"),
    ("educational community|ecl", "ecl", "1 0|2 0"),
    ("do what the fuck you want to public|wtfpl", "wtfpl", "2"),
    ("beerware|beer ware", "beerware", ""),
    ("unicode", "unicode", ""),
    ("vim", "vim", ""),
    ("curl", "curl", ""),
    ("bsd 4 clause|4 clause bsd|original bsd", "bsd-4-clause", ""),
    ("bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd", "bsd-3-clause", ""),
    ("bsd 2 clause|2 clause bsd|simplified bsd|freebsd", "bsd-2-clause", ""),
    ("bsd zero clause|zero clause bsd|0bsd", "0bsd", ""),
    ("bsd", "bsd", ""),
    ("mulan permissive software|mulan psl", "mulanpsl", "1 0|2 0"),
    ("blue oak model", "blueoak", "1 0 0"),
    ("q public|qpl", "qpl", "1 0"),
    ("reciprocal public|rpl", "rpl", "1 1|1 5"),
    ("sun industry standards source|sissl", "sissl", "1 1|1 2"),
]
# Phrases that speak of terms without naming a family.
GENERAL = [
    ("unlicense", "unlicense|free and unencumbered", "", "(?:this is free and unencumbered software released into the public domain|the unlicense|unlicense)"),
    ("public-domain", "public domain", "", "(?:released|dedicated|placed) (?:into|to|in) the public domain"),
    ("proprietary", "all rights reserved", "license|licence", "all rights reserved (?:\\S+ ){0,8}licen[cs]e"),
    ("unknown", "license|licence", "under", "(?:licensed|released|distributed|available) under (?:a|the terms of a|the terms of the) \\S+ licen[cs]e"),
]
_LICENSE = "(?: licen[cs]e| licen[cs]es)?"
_UNDER = "(?:(?:dual )?licensed|licen[cs]e|released|distributed|published|available|provided|redistribute(?:d|s)?) (?:\\S+ ){0,4}?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"


def rules() -> list[dict]:
    """The rules in order of priority: identifiers, notices with a version, notices, names.

    Built from the families: each version has a rule for its identifier, one for a notice
    and one for its full name, and each family has the three without a version.
    """
    out = []

    def add(priority: int, score: float, label: str, keywords: str, needs: str, pattern: str) -> None:
        phrases = keywords.split("|")
        # One word of each keyword, the longest, tells whether the keyword can be there.
        heads = sorted({max(k.split(), key=len) for k in phrases})
        out.append(
            {
                "priority": priority,
                "score": score,
                "label": label,
                "keywords": [f" {k} " for k in phrases],
                "heads": heads,
                "needs": needs.split("|") if needs else heads,
                "pattern": f"(?<= )(?:{pattern})(?= )",
            }
        )

    for name, short, versions in FAMILIES:
        ident = short.replace("-", " ")
        any_of = f"(?:{name})"
        for v in filter(None, versions.split("|")):
            label = f"{short}-{v.replace(' ', '.')}"
            # "2", "2 0", "v2 0" all name version 2.0; "3 01" only itself.
            number = v.removesuffix(" 0") + "(?: 0)?" if v.endswith(" 0") else v
            version = f"(?:(?: version| v| ver)? {number}| v{number})"
            later = "(?: or (?:\\S+ ){0,4}?later(?: version)?| only)?"
            major = v.split()[0]
            add(1, 1.0, label, "spdx", major, f"spdx licen[cs]e identifier {ident} {v}(?: only| or later)?")
            add(2, 0.95, label, name, f"{major}|v{major}", f"{_UNDER}{any_of}{_LICENSE}{version}{later}")
            add(4, 0.8, label, name, f"{major}|v{major}", f"{any_of}{_LICENSE}{version}{later}")
        add(3, 0.85, short, name, "under", f"{_UNDER}{any_of}{_LICENSE}")
        add(5, 0.6, short, name, "license|licence", f"(?:{name}) licen[cs]e")
        if not versions:
            add(1, 1.0, short, "spdx", "license|licence", f"spdx licen[cs]e identifier {ident}")
    for label, keywords, needs, pattern in GENERAL:
        add(6, 0.3, label, keywords, needs, pattern)
    return out


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, rule_table: list[dict] | None = None) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections)``.

    One row for each row of ``docs``.  Words are runs of letters, digits and non-ASCII
    characters after lower-casing A-Z.  The base columns count every place of the base
    phrases; ``labels`` adds the labels of the detections that are left after suppression,
    and ``score`` is the best of their confidences, at least 0.5 where a base phrase stands.
    """
    rows = numbered(docs)
    rule_table = rules() if rule_table is None else rule_table
    listed = [{"rule": i, **r} for i, r in enumerate(rule_table)]
    kind = (
        "array<struct<rule:int,priority:int,score:double,label:string,keywords:array<string>,"
        "heads:array<string>,needs:array<string>,pattern:string>>"
    )
    known = F.from_json(F.lit(json.dumps(listed)), kind)
    heads = {h for r in listed for h in r["heads"]} | {p.split()[-1] for p in BASE}
    needs = {n for r in listed for n in r["needs"]}
    upper = string.ascii_uppercase
    breaks = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    words = F.split(F.translate("text", breaks + upper, " " * len(breaks) + upper.lower()), " ", -1)
    rows = rows.select("key", "copy", "doc_id", F.array_remove(words, "").alias("words"))
    rows = rows.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", F.array(*[F.lit(w) for w in sorted(heads | needs)])).alias("hits"),
    )
    passed = F.arrays_overlap("hits", F.array(*[F.lit(w) for w in sorted(heads)]))
    rows = rows.withColumn("norm", F.when(passed, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
    # Each text that holds a base phrase is split once for it.
    rows = rows.select(
        "key",
        "copy",
        "doc_id",
        "n_words",
        "hits",
        "norm",
        *[
            F.when(F.contains("norm", F.lit(f" {p} ")), F.split("norm", F.lit(f"(?<= ){p}(?= )"), -1)).alias(f"base{i}")
            for i, p in enumerate(BASE)
        ],
    )
    base = [F.col(f"base{i}") for i in range(len(BASE))]
    firsts = [F.when(F.size(b) > 1, _spaces(b[0]) - 1) for b in base]
    lasts = [
        F.when(F.size(b) > 1, F.col("n_words") - (_spaces(F.element_at(b, -1)) - 1) - len(p.split()))
        for p, b in zip(BASE, base)
    ]
    norm = F.col("norm")

    def detect(r: Column) -> Column:
        lengths = F.transform(F.regexp_extract_all(norm, r["pattern"], F.lit(0)), lambda p: (_spaces(p) + 1).cast("int"))
        return F.struct(r.alias("r"), lengths.alias("lengths"))

    def locate(d: Column) -> Column:
        # Words before each place and after the last one.
        gaps = F.transform(F.split(norm, d["r"]["pattern"], -1), lambda p: (_spaces(p) - 1).cast("int"))
        return F.struct(*[d["r"][c].alias(c) for c in ("rule", "priority", "score", "label")], gaps.alias("gaps"), d["lengths"].alias("lengths"))

    def evident(r: Column) -> Column:
        words = F.arrays_overlap(r["heads"], F.col("hits")) & F.arrays_overlap(r["needs"], F.col("hits"))
        return words & F.exists(r["keywords"], lambda k: F.contains(norm, k))

    gated = F.filter(known, evident)
    found = F.transform(F.filter(F.transform(gated, detect), lambda d: F.size(d["lengths"]) > 0), locate)
    here = F.col("norm").isNotNull()
    found_base = [F.when(F.size(b) > 1, F.lit(name)) for b, name in zip(base, BASE.values())]
    judged = rows.select(
        "key",
        "copy",
        "doc_id",
        "n_words",
        sum(F.coalesce(F.size(b) - 1, F.lit(0)) for b in base).cast("long").alias("n_base"),
        F.when(here, F.least(*firsts)).cast("long").alias("first_word"),
        F.when(here, F.greatest(*lasts)).cast("long").alias("last_word"),
        F.when(here, F.array_compact(F.array(*found_base))).otherwise(F.array().cast("array<string>")).alias("base"),
        F.when(here, found).alias("found"),
    )
    kept = ["key", "copy", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    by_rule = judged.select(*kept, F.explode_outer("found").alias("d"))
    places = by_rule.select(*kept, "d", F.posexplode_outer("d.lengths").alias("place", "length"))
    flat = places.repartition("key", "copy").select(
        *kept,
        F.col("d.rule").alias("rule"),
        F.col("d.priority").alias("priority"),
        F.col("d.score").alias("score"),
        F.col("d.label").alias("label"),
        "place",
        "length",
        F.try_element_at("d.gaps", F.col("place") + 1).alias("gap"),
    )
    doc = Window.partitionBy("key", "copy")
    in_rule = Window.partitionBy("key", "copy", "rule").orderBy("place")
    spans = flat.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(in_rule)).withColumn("begin", F.col("end") - F.col("length"))
    order = doc.orderBy("begin", F.col("end").desc(), "priority", "rule")
    inside = F.coalesce(F.col("end") <= F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    # What is left is ordered by begin and by end alike, so overlaps are those of neighbours.
    left = spans.withColumn("inside", inside).withColumn("rank", F.when(F.col("inside"), F.lit(None)).otherwise(F.col("priority")))
    near = Window.partitionBy("key", "copy", "inside").orderBy("begin", F.col("end").desc(), "priority", "rule")
    beaten = ((F.lag("end").over(near) > F.col("begin")) & (F.lag("priority").over(near) < F.col("priority"))) | (
        (F.lead("begin").over(near) < F.col("end")) & (F.lead("priority").over(near) < F.col("priority"))
    )
    stays = F.col("label").isNotNull() & ~F.col("inside") & ~F.coalesce(beaten, F.lit(False))
    final = left.withColumn("stays", stays)
    whole = final.groupBy(*kept).agg(
        F.collect_set(F.when(F.col("stays"), F.col("label"))).alias("more"),
        F.coalesce(F.max(F.when(F.col("stays"), F.col("score"))), F.lit(0.0)).alias("best"),
        F.count(F.when(F.col("stays"), 1)).alias("n_detections"),
    )
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return whole.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        join(F.col("base")).alias("base_labels"),
        join(F.concat("base", "more")).alias("labels"),
        F.greatest("best", F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "n_detections",
    )
