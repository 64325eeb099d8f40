"""String and JSON expressions for step documents, model output and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that open a spoken caution rather than an action.
ADVISORY_PREFIXES = ("never ", "do not ", "don't ", "avoid ", "be careful")


def is_advisory(text: Column) -> Column:
    """The step opens with a caution phrase."""
    opening = F.lower(F.trim(text))
    out = F.lit(False)
    for p in ADVISORY_PREFIXES:
        out = out | F.startswith(opening, F.lit(p))
    return out


def ends_mid_clause(text: Column) -> Column:
    """The text lacks closing punctuation, the sign of an output cut at its token cap."""
    return ~F.rtrim(text).rlike("[.!?]$")


def strip_fences(text: Column) -> Column:
    """Model output without the Markdown code fence around it."""
    t = F.trim(text)
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\A```[A-Za-z]*\s*", ""), r"\s*```\z", ""))


def response_text(payload: Column) -> Column:
    """Text of a model response in any of its known shapes, else an empty string.

    In order: a list or a string nested under ``response.response``, a list or a string
    under ``response``, a ``text`` field.
    """
    v = F.try_parse_json(payload)

    def at(path: str, kind: str) -> Column:
        return F.try_variant_get(v, path, kind)

    def kind_of(path: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))

    def is_list(path: str) -> Column:
        return F.startswith(kind_of(path), F.lit("ARRAY"))

    def first(path: str) -> Column:
        return F.coalesce(at(f"{path}[0]", "string"), F.lit(""))

    inner, outer = "$.response.response", "$.response"

    def filled(path: str) -> Column:
        return is_list(path) & (kind_of(f"{path}[0]") != "VOID")

    return (
        F.when(filled(inner), first(inner))
        .when(kind_of(inner) == "STRING", at(inner, "string"))
        .when(filled(outer), first(outer))
        .when(kind_of(outer) == "STRING", at(outer, "string"))
        .when(kind_of("$.text") == "STRING", at("$.text", "string"))
        .otherwise(F.lit(""))
    )


def parse_model_json(text: Column, schema: str) -> Column:
    """Fence-tolerant parse against ``schema``; a bad row gives ``valid = false``, not an error."""
    parsed = F.from_json(strip_fences(text), schema)
    ok = F.try_parse_json(strip_fences(text)).isNotNull()
    return F.struct(ok.alias("valid"), F.when(ok, parsed).alias("value"))


def step_verdicts(text: Column) -> Column:
    """``Step n: PASS or FAIL / Description: ...`` as an array of structs."""
    pattern = r"(?i)Step (\d+):\s*(PASS|FAIL)\s*(?:\n\s*Description:\s*([^\n]*))?"

    def group(i: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(i))

    zipped = F.arrays_zip(group(1).alias("n"), group(2).alias("v"), group(3).alias("d"))
    return F.transform(
        zipped,
        lambda e: F.struct(
            e["n"].cast("long").alias("step"), (F.upper(e["v"]) == "PASS").alias("passed"), F.trim(e["d"]).alias("description")
        ),
    )


def labels_in_name(name: Column) -> Column:
    """``1_pass_2_fail`` anywhere in a name as a map from step number to pass; the last one wins."""
    pattern = r"(?i)(\d+)_(pass|fail)"
    numbers = F.regexp_extract_all(name, F.lit(pattern), F.lit(1)).cast("array<int>")
    verdicts = F.transform(F.regexp_extract_all(name, F.lit(pattern), F.lit(2)), lambda v: F.lower(v) == "pass")
    pairs = F.arrays_zip(numbers.alias("step"), verdicts.alias("passed"))
    distinct = F.array_distinct(numbers)
    # Building the map step by step lets a repeated step keep its last verdict.
    return F.map_from_arrays(
        distinct,
        F.transform(
            distinct, lambda n: F.element_at(F.filter(pairs, lambda p: p["step"] == n), -1)["passed"]
        ),
    )


def file_stem(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def sidecar_name(path: Column, suffix: str = "_labels.csv") -> Column:
    """``<stem>_labels.csv`` next to a CSV."""
    return F.concat(F.regexp_replace(path, r"\.csv$", ""), F.lit(suffix))


def tokens(text: Column) -> Column:
    """Distinct lower-case words."""
    words = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays, 0 when both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def digest(payload: Column) -> Column:
    """Digests that show whether two outputs are byte-identical."""
    return F.struct(F.md5(payload).alias("md5"), F.sha2(payload, 256).alias("sha256"), F.octet_length(payload).alias("bytes"))
