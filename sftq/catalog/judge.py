"""Queries on the judgement stage. The judge is a stub that looks at the prompt only."""

import json

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.functions.formats import norm_format
from sftq.operators import judge as J
from sftq.operators.records import extract_pair
from sftq.plans.evaluate import check_grammar, evaluate_records, judged_prompt
from sftq.sources.jsonl import parse_records as parsed

MODEL = "stub"


def make_stub():
    """A scorer whose score follows from the prompt's length; even lengths need a second try.

    A second try is the next call after the first one, so only that one's prompts are remembered.
    """
    seen = set()

    def scorer(prompts):
        nonlocal seen
        before, seen = seen, set()
        replies = []
        for prompt in prompts:
            n = len(prompt)
            if n % 2 == 0 and prompt not in before:
                seen.add(prompt)
                replies.append({"ok": True, "text": "thinking", "raw": {"done_reason": "stop"}})
                continue
            text = json.dumps({"usable": n % 3 > 0, "score": n % 101, "rationale_en": "by length"})
            raw = {"done_reason": "stop", "model": MODEL, "eval_count": n, "other": 1}
            replies.append({"ok": True, "text": text, "error": None, "raw": raw})
        return replies

    return scorer


_FORMAT_CASE = "CASE expect_format " + " ".join(
    f"WHEN '{fmt.upper()}' THEN '{text.replace(chr(39), chr(39) * 2)}'" for fmt, text in J.CHECKLISTS.items()
)
_PROMPT_SQL = f"""'{J.INSTRUCTIONS}' || chr(10) || 'Target format: ' || expect_format || chr(10) || chr(10) || {_FORMAT_CASE} END
  || chr(10) || '--- request ---' || chr(10) || prompt || chr(10) || chr(10) || '--- returned data ---' || chr(10) || expect_payload || chr(10)"""


@query(
    "checklist_lookup",
    f"""SELECT record_id, CASE WHEN record_id % 13 = 0 THEN '{J.GENERIC_CHECKLIST}' ELSE {_FORMAT_CASE} END END AS checklist
        FROM $sft_records r""",
)
def checklist_lookup(t):
    label = F.when(F.col("record_id") % 13 == 0, "ini").otherwise(norm_format(F.col("output_format")))
    return t.sft_records.select("record_id", J.checklist(label).alias("checklist"))


@query("build_judge_prompt", f"SELECT record_id, {_PROMPT_SQL} AS judge_prompt FROM $sft_records r")
def build_judge_prompt(t):
    rows = check_grammar(t.sft_records)
    prompt = J.build_judge_prompt(F.col("grammar.output_format"), F.col("prompt"), F.col("final_output"))
    return rows.select("record_id", prompt.alias("judge_prompt"))


@query(
    "judge",
    f"""SELECT record_id, expect_ok AS ok, CASE WHEN expect_ok THEN n % 101 END AS score, CASE WHEN expect_ok THEN n END AS eval_count
        FROM (SELECT record_id, expect_ok, length({_PROMPT_SQL}) AS n FROM $sft_records r) q""",
)
def judge(t):
    rows = check_grammar(t.sft_records)
    rows = rows.withColumn("reply", J.judge(judged_prompt(rows), make_stub))
    return rows.select(
        "record_id",
        F.coalesce("reply.ok", F.lit(False)).alias("ok"),
        F.get_json_object("reply.text", "$.score").cast("bigint").alias("score"),
        J.judge_meta(F.col("reply.raw"))["eval_count"].alias("eval_count"),
    )


_RESOLVED = """
SELECT record_id, attempt, ok, error, done_reason, text FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY CASE WHEN final THEN 0 ELSE 1 END, CASE WHEN final THEN attempt ELSE -attempt END) AS n FROM (
    SELECT *, NOT ok OR attempt >= 2 OR NOT (
      (trim(text) = '' AND coalesce(done_reason, '') IN ('load', '')) OR
      (trim(text) <> '' AND NOT (starts_with(trim(text), '{') AND suffix(trim(text), '}')))) AS final
    FROM $judge_attempts a) b) c WHERE n = 1
"""


@query("resolve_attempts", _RESOLVED)
def resolve_attempts(t):
    return J.resolve_attempts(t.judge_attempts)


@query(
    "parse_judgement",
    f"""SELECT record_id, attempt,
          good AND (record_id % 6 IN (3, 4) OR js ->> '$.usable' = 'true') AS usable,
          CASE WHEN good THEN least(greatest(CAST(js ->> '$.score' AS INT), 0), 100) ELSE 0 END AS score,
          CASE WHEN good THEN js ->> '$.rationale_en' ELSE '' END AS rationale_en,
          trim(text) AS raw_response,
          CASE WHEN good THEN 'none' WHEN NOT ok THEN error WHEN trim(text) = '' THEN 'llm_empty_response' ELSE 'llm_json_parse_fail' END AS error
        FROM (SELECT *, ok AND coalesce(json_valid(js) AND js ->> '$.score' IS NOT NULL, false) AS good FROM (
          SELECT *, CASE WHEN contains(text, '{{') THEN regexp_extract(text, '[{{].*[}}]') END AS js FROM $judge_attempts a) b) c""",
)
def parse_judgement(t):
    rows = J.parse_judgement(t.judge_attempts)
    said = F.col("judgement")
    return rows.select(
        "record_id",
        "attempt",
        said["usable"].alias("usable"),
        said["score"].alias("score"),
        said["rationale_en"].alias("rationale_en"),
        said["raw_response"].alias("raw_response"),
        F.coalesce(F.regexp_replace(said["error"], "(?s)^llm_json_parse_fail: .*", J.BAD_REPLY), F.lit("none")).alias(
            "error"
        ),
    )


@query(
    "judge_meta",
    """SELECT record_id, attempt, done_reason, 'stub' AS model, record_id * 1000 AS total_duration, length(text) AS eval_count, CAST(NULL AS BIGINT) AS load_duration
       FROM $judge_attempts a""",
)
def judge_meta(t):
    raw = F.to_json(
        F.struct(
            "done_reason",
            F.lit(MODEL).alias("model"),
            (F.col("record_id") * 1000).alias("total_duration"),
            F.length("text").alias("eval_count"),
            F.struct("text").alias("message"),
        )
    )
    meta = t.judge_attempts.withColumn("m", J.judge_meta(raw))
    fields = ("done_reason", "model", "total_duration", "eval_count", "load_duration")
    return meta.select("record_id", "attempt", *[F.col(f"m.{f}").alias(f) for f in fields])


@query(
    "extraction_audit",
    """SELECT record_id, trim(output, ' ' || chr(10)) <> expect_payload AS changed, sha1(expect_payload) AS sha1
       FROM $sft_records r""",
)
def extraction_audit(t):
    rows = check_grammar(t.sft_records)
    audit = J.extraction_audit(F.col("output"), F.col("final_output"))
    return rows.withColumn("a", audit).select("record_id", "a.changed", "a.sha1")


@query(
    "grammar_gate",
    """SELECT record_id, expect_ok AS usable, CASE WHEN expect_ok THEN 80 ELSE 0 END AS score,
         CASE WHEN expect_ok THEN 'none' ELSE 'skipped_due_to_grammar_error' END AS error
       FROM $sft_records r""",
)
def grammar_gate(t):
    judged = F.struct(
        F.lit(True).alias("usable"),
        F.lit(80).alias("score"),
        F.lit("fine").alias("rationale_en"),
        F.lit("{}").alias("raw_response"),
        F.lit(None).cast("string").alias("error"),
    )
    rows = J.grammar_gate(check_grammar(t.sft_records).withColumn("judgement", judged))
    error = F.coalesce("llm.error", F.lit("none")).alias("error")
    return rows.select("record_id", "llm.usable", "llm.score", error)


# Records keep their shape through the whole plan: shapes 0 and 1 carry prompt and output,
# 3 only the output, 2 an empty last message and 4 no pair at all.
@query(
    "evaluate_records",
    f"""SELECT record_id, ok AS grammar_ok, ok AND n % 3 > 0 AS usable, CAST(CASE WHEN ok THEN n % 101 ELSE 0 END AS INT) AS score,
          CASE WHEN ok THEN 'none' ELSE 'skipped_due_to_grammar_error' END AS error,
          trim(output, ' ' || chr(10)) <> expect_payload AS changed, CASE WHEN expect_payload <> '' THEN sha1(expect_payload) ELSE '' END AS sha1,
          CASE WHEN ok THEN n END AS eval_count
        FROM (SELECT *, length({_PROMPT_SQL}) AS n FROM (
          SELECT record_id, expect_format, CASE WHEN shape IN (0, 1, 3) THEN expect_ok ELSE expect_format = 'TOML' END AS ok,
            CASE WHEN shape IN (0, 1) THEN prompt ELSE '' END AS prompt, CASE WHEN shape IN (0, 1, 3) THEN output ELSE '' END AS output,
            CASE WHEN shape IN (0, 1, 3) THEN expect_payload ELSE '' END AS expect_payload
          FROM (SELECT *, (record_id % 5) AS shape FROM $sft_records s) r) q) p""",
)
def evaluate(t):
    rows = evaluate_records(extract_pair(parsed(t.raw_records)), make_stub, MODEL)
    e = "evaluation."
    return rows.select(
        "record_id",
        F.col(e + "grammar.ok").alias("grammar_ok"),
        F.col(e + "usable").alias("usable"),
        F.col(e + "llm.score").alias("score"),
        F.coalesce(e + "llm.error", F.lit("none")).alias("error"),
        F.col(e + "extraction.changed").alias("changed"),
        F.col(e + "extraction.sha1").alias("sha1"),
        F.col(e + "llm.meta.eval_count").alias("eval_count"),
    )
