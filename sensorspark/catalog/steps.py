"""Interval, step, verdict and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.catalog.prep import rounded
from sensorspark.catalog.registry import Tables, query
from sensorspark.functions import text
from sensorspark.operators import steps, verdicts

SPANS_SQL = """line AS (SELECT *, (epoch(l_shipdate) / 86400)::DOUBLE AS d FROM lineitem),
ref AS (SELECT l_suppkey AS clip, l_partkey AS step, min(d) AS s, max(d + 10 + l_linenumber) AS e
  FROM line WHERE l_returnflag = 'R' GROUP BY 1, 2),
cand AS (SELECT l_suppkey AS clip, l_orderkey * 10 + l_linenumber AS position, d - 5 AS s, d + l_quantity AS e
  FROM line WHERE l_returnflag <> 'R'),
pairs AS (SELECT r.clip, r.step, c.position, (least(r.e, c.e) - greatest(r.s, c.s)) /
  ((r.e - r.s) + (c.e - c.s) - (least(r.e, c.e) - greatest(r.s, c.s))) AS v
  FROM ref r JOIN cand c ON r.clip = c.clip AND r.s < c.e AND c.s < r.e),
best AS (SELECT clip, step, max(v) AS v, arg_max(position, (v, -position)) AS position FROM pairs GROUP BY 1, 2),
res AS (SELECT r.clip, r.step, r.s, r.e, coalesce(v, 0) AS iou, position FROM ref r LEFT JOIN best b USING (clip, step))"""


def intervals(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Returned lines play annotated reference steps per supplier, the others predicted steps."""
    d = (F.unix_seconds(F.col("l_shipdate").cast("timestamp")) / 86_400).cast("double")
    line = t.lineitem.select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", d.alias("d"))
    reference = line.filter("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("clip"), F.col("l_partkey").alias("step"), F.col("d").alias("start"),
        (F.col("d") + 10 + F.col("l_linenumber")).alias("end"),
    )
    candidates = line.filter("l_returnflag <> 'R'").select(
        F.col("l_suppkey").alias("clip"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
        (F.col("d") - 5).alias("start"), (F.col("d") + F.col("l_quantity")).alias("end"),
    )
    return reference, candidates


def matches(t: Tables) -> DataFrame:
    reference, candidates = intervals(t)
    return steps.best_match(steps.hull(reference, ["clip"]), candidates, ["clip"], bucket=120.0)


@query("interval_hull", f'WITH {SPANS_SQL} SELECT clip, step, s AS "start", e AS "end" FROM ref')
def interval_hull(t: Tables) -> DataFrame:
    return steps.hull(intervals(t)[0], ["clip"])


@query(
    "interval_best_iou",
    f'WITH {SPANS_SQL} SELECT clip, step, s AS "start", e AS "end", round(iou, 6) AS iou, position FROM res',
)
def interval_best_iou(t: Tables) -> DataFrame:
    return rounded(matches(t), "iou")


@query(
    "manual_score",
    f"""WITH {SPANS_SQL.replace("WHERE l_returnflag <> 'R'", "WHERE l_returnflag <> 'R' AND l_linenumber % 3 <> 0")}
SELECT clip, step, s AS "start", e AS "end", round(iou, 6) AS iou, position FROM res""",
)
def manual_score(t: Tables) -> DataFrame:
    """Every third predicted step is a caution and matches nothing."""
    reference, candidates = intervals(t)
    says = F.when(F.col("position") % 10 % 3 == 0, " Never touch the blade").otherwise("Turn the blade")
    predicted = candidates.select(
        "clip", F.col("position").alias("step"), F.col("start").alias("timestamp_start"), F.col("end").alias("timestamp_end"), says.alias("instruction")
    )
    return rounded(steps.score_manual(predicted, reference, ["clip"], bucket=120.0).drop("instruction"), "iou")


@query(
    "interval_recall",
    f"""WITH {SPANS_SQL} SELECT clip, threshold, count(*) FILTER (WHERE iou >= threshold) AS hits, count(*) AS n_reference,
  round(avg((iou >= threshold)::INT), 6) AS recall, round(avg(iou) FILTER (WHERE iou > 0), 6) AS mean_iou
FROM res, (SELECT unnest([0.1, 0.3, 0.5])::DOUBLE AS threshold) GROUP BY 1, 2""",
)
def interval_recall(t: Tables) -> DataFrame:
    return rounded(steps.recall(matches(t), ["clip"]), "recall", "mean_iou")


DOC_SQL = """doc AS (SELECT conv_id AS clip, turn // 3 AS chunk, (turn // 3) * 20.0::DOUBLE AS chunk_start, turn AS step,
  text AS instruction, (turn % 3) * 10.0::DOUBLE AS timestamp_start, (turn % 3) * 10.0::DOUBLE + 8 + turn % 2 AS timestamp_end FROM conversations)"""


def step_rows(t: Tables) -> DataFrame:
    """Turns play the steps of one recording per conversation, three to a chunk."""
    local = F.pmod("turn", F.lit(3)) * 10.0
    return t.conversations.select(
        F.col("conv_id").alias("clip"),
        F.floor(F.col("turn") / 3).alias("chunk"),
        (F.floor(F.col("turn") / 3) * 20.0).alias("chunk_start"),
        F.col("turn").alias("step"),
        F.col("text").alias("instruction"),
        local.alias("timestamp_start"),
        (local + 8 + F.pmod("turn", F.lit(2))).alias("timestamp_end"),
    )


_WORDS = (
    "list_distinct(list_filter(string_split(regexp_replace(lower(instruction), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), "
    "lambda w: w <> ''))"
)


@query(
    "chunk_merge",
    f"""WITH {DOC_SQL}, p AS (SELECT *, timestamp_start + chunk_start AS s, timestamp_end + chunk_start AS e, {_WORDS} AS w FROM doc),
drop AS (SELECT DISTINCT b.clip, b.chunk, b.step FROM p a JOIN p b ON a.clip = b.clip AND a.chunk < b.chunk
  AND a.s < b.e AND b.s < a.e WHERE len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)) >= 0.15)
SELECT clip, chunk, s AS "start", e AS "end", row_number() OVER (PARTITION BY clip ORDER BY s, chunk) - 1 AS step,
  length(instruction) AS n_chars FROM p ANTI JOIN drop USING (clip, chunk, step)""",
)
def chunk_merge(t: Tables) -> DataFrame:
    merged = steps.merge_chunks(step_rows(t), "clip", similarity=0.15)
    return merged.withColumn("n_chars", F.length("instruction").cast("long")).drop("instruction")


@query(
    "step_coverage",
    f"""WITH {DOC_SQL}, l AS (SELECT *, timestamp_start - lag(timestamp_end) OVER (PARTITION BY clip ORDER BY step) AS g FROM doc)
SELECT clip, count(*) AS n_steps, min(timestamp_start) AS first_s, max(timestamp_end) AS last_s,
  coalesce(sum(greatest(g, 0)), 0)::DOUBLE AS gap_s FROM l GROUP BY 1""",
)
def step_coverage(t: Tables) -> DataFrame:
    return steps.coverage(step_rows(t), ["clip"])


@query(
    "document_checks",
    f"""WITH {DOC_SQL}, l AS (SELECT *, abs(timestamp_start - lag(timestamp_end) OVER (PARTITION BY clip ORDER BY step)) <= 2.0 AS j FROM doc)
SELECT clip, count(*) AS n_steps, min(step) = 0 AND max(step) + 1 = count(*) AND count(DISTINCT step) = count(*) AS numbered,
  coalesce(bool_and(j), TRUE) AS tiles, NOT regexp_matches(rtrim(arg_max(instruction, step)), '[.!?]$') AS truncated FROM l GROUP BY 1""",
)
def document_checks(t: Tables) -> DataFrame:
    return steps.document_checks(step_rows(t), ["clip"], tolerance=2.0)


@query(
    "advisory_steps",
    """SELECT conv_id, turn, starts_with(o, 'never ') OR starts_with(o, 'do not ') OR starts_with(o, 'don''t ')
  OR starts_with(o, 'avoid ') OR starts_with(o, 'be careful') AS advisory
FROM (SELECT *, lower(trim(CASE WHEN turn % 3 = 1 THEN ' Be careful: ' ELSE '' END || text)) AS o FROM conversations)""",
)
def advisory_steps(t: Tables) -> DataFrame:
    opened = F.concat(F.when(F.pmod("turn", F.lit(3)) == 1, " Be careful: ").otherwise(""), F.col("text"))
    return t.conversations.select("conv_id", "turn", text.is_advisory(opened).alias("advisory"))


VERDICT_SQL = """v AS (SELECT conv_id AS clip, turn // 2 AS step, turn AS position,
  ['PASSED', 'FAILED', 'MISSING'][1 + length(text) % 3] AS status,
  CASE WHEN turn % 3 = 1 THEN '...' ELSE text END AS reason,
  CASE WHEN length(text) % 3 < 2 THEN turn * 5.0::DOUBLE END AS timestamp_start,
  CASE WHEN length(text) % 3 < 2 THEN turn * 5.0::DOUBLE + 4 END AS timestamp_end FROM conversations),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clip, step ORDER BY timestamp_start IS NOT NULL DESC,
  regexp_replace(reason, '[\\s.…]+', '', 'g') <> '' DESC, position DESC) AS r FROM v) WHERE r = 1),
ex AS (SELECT clip, unnest([{'n': 1, 'x': clip % 3 <> 0}, {'n': 2, 'x': TRUE}, {'n': 4, 'x': clip % 2 = 0}]) AS e
  FROM (SELECT DISTINCT conv_id AS clip FROM conversations)),
sc AS (SELECT ex.clip, e.n AS step_no, e.x AS expected, coalesce(status, 'NOT REPORTED') AS status,
  coalesce((status = 'PASSED') = e.x, FALSE) AS correct FROM ex LEFT JOIN one ON ex.clip = one.clip AND one.step + 1 = e.n)"""


def verdict_rows(t: Tables) -> DataFrame:
    """Turns play repeated verdicts, two to a step."""
    kind = F.pmod(F.length("text"), F.lit(3))
    return t.conversations.select(
        F.col("conv_id").alias("clip"),
        F.floor(F.col("turn") / 2).alias("step"),
        F.col("turn").alias("position"),
        F.when(kind == 0, "PASSED").when(kind == 1, "FAILED").otherwise("MISSING").alias("status"),
        F.when(F.pmod("turn", F.lit(3)) == 1, "...").otherwise(F.col("text")).alias("reason"),
        F.when(kind < 2, F.col("turn") * 5.0).alias("timestamp_start"),
        F.when(kind < 2, F.col("turn") * 5.0 + 4).alias("timestamp_end"),
    )


def expected(t: Tables) -> DataFrame:
    """Outcomes encoded in clip names such as ``1_pass_2_pass_4_fail``."""

    def word(flag):
        return F.when(flag, "pass").otherwise("fail")

    name = F.concat(
        F.lit("1_"), word(F.col("clip") % 3 != 0), F.lit("_2_PASS_4_"), word(F.col("clip") % 2 == 0)
    )
    clips = t.conversations.select(F.col("conv_id").alias("clip")).distinct().withColumn("name", name)
    return verdicts.expected_from_names(clips, ["clip"], "name")


@query("label_parse", f"WITH {VERDICT_SQL} SELECT clip, e.n AS step_no, e.x AS expected FROM ex")
def label_parse(t: Tables) -> DataFrame:
    return expected(t)


@query(
    "verdict_collapse",
    f"WITH {VERDICT_SQL} SELECT clip, step, position, status, reason, timestamp_start, timestamp_end FROM one",
)
def verdict_collapse(t: Tables) -> DataFrame:
    return verdicts.collapse(verdict_rows(t), ["clip"], order="position")


@query("verdict_score", f"WITH {VERDICT_SQL} SELECT * FROM sc")
def verdict_score(t: Tables) -> DataFrame:
    return verdicts.score(verdict_collapse(t), expected(t), ["clip"])


@query(
    "verdict_summary",
    f"""WITH {VERDICT_SQL} SELECT clip, count(*) FILTER (WHERE correct) AS correct, count(*) AS n_steps,
  count(*) FILTER (WHERE status = 'NOT REPORTED') AS unreported, bool_and(expected) AS one_sided FROM sc GROUP BY 1""",
)
def verdict_summary(t: Tables) -> DataFrame:
    return verdicts.summarise(verdict_score(t), ["clip"])


@query(
    "status_split",
    f"""WITH {VERDICT_SQL} SELECT clip, count(*) FILTER (WHERE status = 'PASSED') AS n_passed,
  count(*) FILTER (WHERE status = 'FAILED') AS n_failed, count(*) FILTER (WHERE status = 'MISSING') AS n_missing,
  0::BIGINT AS malformed FROM one GROUP BY 1""",
)
def status_split(t: Tables) -> DataFrame:
    return verdicts.status_split(verdict_collapse(t), ["clip"])


@query(
    "verdict_majority",
    f"""WITH {VERDICT_SQL}, c AS (SELECT clip, step, status, count(*) AS c FROM v GROUP BY ALL)
SELECT clip, step, arg_min(status, (-c, status)) AS verdict, round(max(c) / sum(c), 6) AS agreement, count(*) AS n_distinct FROM c GROUP BY 1, 2""",
)
def verdict_majority(t: Tables) -> DataFrame:
    return rounded(verdicts.majority(verdict_rows(t), ["clip", "step"]), "agreement")


@query(
    "procedure_pairing",
    """SELECT page_id, url, arg_min(stem, (-length(stem), stem)) AS procedure FROM pages
  JOIN (SELECT DISTINCT item_id::VARCHAR AS stem FROM benchmark) ON contains(url, stem) GROUP BY 1, 2""",
)
def procedure_pairing(t: Tables) -> DataFrame:
    """Item numbers play procedure stems, page addresses play video names."""
    stems = t.benchmark.select(F.col("item_id").cast("string").alias("stem"))
    return verdicts.pair_procedures(t.pages.select("page_id", "url"), stems, video="url", stem="stem")


@query(
    "response_text",
    """SELECT conv_id, turn, CASE turn % 7 WHEN 5 THEN '' WHEN 6 THEN '' ELSE text END AS answer FROM conversations""",
)
def response_text(t: Tables) -> DataFrame:
    """Each turn wrapped in one of the response shapes, then unwrapped."""
    body = F.col("text")
    listed = F.array(body, F.lit("second"))
    shape = F.pmod("turn", F.lit(7))
    payload = (
        F.when(shape == 0, F.to_json(F.struct(F.struct(listed.alias("response")).alias("response"))))
        .when(shape == 1, F.to_json(F.struct(F.struct(body.alias("response")).alias("response"))))
        .when(shape == 2, F.to_json(F.struct(listed.alias("response"))))
        .when(shape == 3, F.to_json(F.struct(body.alias("response"))))
        .when(shape == 4, F.to_json(F.struct(body.alias("text"))))
        .when(shape == 5, F.lit('{"other": 1}'))
        .otherwise(F.lit("not json"))
    )
    return t.conversations.select("conv_id", "turn", text.response_text(payload).alias("answer"))


@query("strip_fences", "SELECT conv_id, turn, trim(text) AS answer FROM conversations")
def strip_fences(t: Tables) -> DataFrame:
    fenced = F.concat(F.lit("```json\n"), F.trim("text"), F.lit("\n```  "))
    wrapped = F.when(F.pmod("turn", F.lit(2)) == 0, fenced).otherwise(F.col("text"))
    return t.conversations.select("conv_id", "turn", text.strip_fences(wrapped).alias("answer"))


@query(
    "model_json",
    """SELECT event_id, event_id % 4 <> 3 AS valid, CASE WHEN event_id % 4 <> 3
  THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k FROM events""",
)
def model_json(t: Tables) -> DataFrame:
    fenced = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    broken = F.concat(F.lit("Sure! "), F.col("props"))
    answer = F.when(F.col("event_id") % 4 == 3, broken).when(F.col("event_id") % 2 == 0, fenced).otherwise(F.col("props"))
    parsed = text.parse_model_json(answer, "k bigint")
    return t.events.select("event_id", parsed.alias("p")).select("event_id", "p.valid", F.col("p.value.k").alias("k"))


@query(
    "step_answers",
    """SELECT conv_id, turn, unnest([{'s': 1, 'p': turn % 2 = 0}, {'s': 2, 'p': TRUE}], recursive := true) FROM conversations""",
)
def step_answers(t: Tables) -> DataFrame:
    verdict = F.when(F.col("turn") % 2 == 0, "PASS").otherwise("FAIL")
    answer = F.concat(F.lit("Step 1: "), verdict, F.lit("\nDescription: it moved.\nStep 2: PASS\nSummary: ok"))
    rows = t.conversations.select("conv_id", "turn", F.explode(text.step_verdicts(answer)).alias("e"))
    return rows.select("conv_id", "turn", F.col("e.step").cast("int").alias("s"), F.col("e.passed").alias("p"))


@query(
    "file_names",
    """SELECT page_id, regexp_replace(split_part(url, '/', -1), '(.)\\.[^.]*$', '\\1') AS stem,
  regexp_replace(url, '\\.csv$', '') || '_labels.csv' AS sidecar FROM pages""",
)
def file_names(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", text.file_stem(F.col("url")).alias("stem"), text.sidecar_name(F.col("url")).alias("sidecar")
    )


@query(
    "output_digest",
    "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS bytes FROM documents",
)
def output_digest(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", text.digest(F.col("text")).alias("d")).select("doc_id", "d.*")
    return rows.withColumn("bytes", F.col("bytes").cast("long"))
