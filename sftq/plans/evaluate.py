"""The scoring plan: pair, extraction, syntax, judgement, ``evaluation``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.functions.text import extract_final_output
from sftq.operators.judge import (
    MAX_RETRIES,
    Scorer,
    build_judge_prompt,
    extraction_audit,
    grammar_gate,
    judge,
    judge_meta,
    parse_judgement,
)
from sftq.operators.validate import validate_by_format

TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def check_grammar(df: DataFrame, yaml_style: bool = True) -> DataFrame:
    """Add ``final_output, payload, grammar`` to rows with ``output, output_format``."""
    return validate_by_format(extract_final_output(df), yaml_style=yaml_style)


def judged_prompt(df: DataFrame) -> Column:
    """The judge's prompt, null for rows that failed the grammar check."""
    prompt = build_judge_prompt(F.col("grammar.output_format"), F.col("prompt"), F.col("final_output"))
    return F.when(F.col("grammar.ok"), prompt)


def prompted(df: DataFrame, yaml_style: bool = True) -> DataFrame:
    """Rows with ``prompt, output, output_format`` as far as the judge's ``_prompt``."""
    df = check_grammar(df, yaml_style)
    return df.withColumn("_prompt", judged_prompt(df))


def concluded(df: DataFrame, model: str) -> DataFrame:
    """Add ``evaluation`` to prompted rows that have the judge's ``_reply``.

    A judged record carries the time of its reply, others the time of the job.
    """
    df = df.withColumns({f"_said_{c}": F.col(f"_reply.{c}") for c in ("ok", "text", "error", "raw")})
    df = parse_judgement(df, "_said_text", "_said_ok", "_said_error", "_judged")
    df = grammar_gate(df, "_judged", "_llm")
    sound, said = F.col("grammar.ok"), F.col("_llm")
    evaluation = F.struct(
        extraction_audit(F.col("output"), F.col("final_output")).alias("extraction"),
        F.col("grammar"),
        F.struct(
            F.lit(model).alias("model"),
            *[said[c].alias(c) for c in ("usable", "score", "rationale_en", "raw_response", "error")],
            F.when(sound, judge_meta(F.col("_said_raw"))).alias("meta"),
        ).alias("llm"),
        (sound & F.coalesce(said["usable"], F.lit(False))).alias("usable"),
        F.coalesce("_reply.at", F.date_format(F.current_timestamp(), TIMESTAMP)).alias("timestamp"),
    )
    scratch = [c for c in df.columns if c.startswith("_")] + ["final_output", "payload", "grammar"]
    return df.withColumn("evaluation", evaluation).drop(*scratch)


def evaluate_records(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    model: str,
    yaml_style: bool = True,
    max_retries: int = MAX_RETRIES,
    partitions: int | None = None,
) -> DataFrame:
    """Add the ``evaluation`` struct to rows with ``prompt, output, output_format``.

    ``partitions`` spreads the costly judging evenly over that many tasks (a
    round-robin shuffle, so no group of equal rows ends up in one task).
    """
    df = prompted(df, yaml_style)
    if partitions:
        df = df.repartition(partitions)
    return concluded(df.withColumn("_reply", judge(F.col("_prompt"), make_scorer, max_retries)), model)
