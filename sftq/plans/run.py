"""The three whole jobs: score a tree of shards, filter scored shards, audit datasets."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sftq.operators.audit import (
    escape_report,
    inline_table_sample,
    route_rows,
    task_error_reasons,
    task_stats,
    toml_structure_stats,
)
from sftq.operators.judge import MAX_RETRIES, Scorer
from sftq.operators.records import extract_pair
from sftq.operators.replies import PER_TASK, answer, with_replies
from sftq.operators.select import is_kept, limit_global, limit_per_dataset, score_and_format
from sftq.plans.audit import audit_records
from sftq.plans.evaluate import concluded, prompted
from sftq.sources.jsonl import first_files, list_shards, parse_records, scan_records
from sftq.sources.scratch import written
from sftq.sources.sinks import (
    evaluation_text,
    read_scored,
    with_evaluation,
    write_by_task,
    write_scored,
    write_summary,
)

LINE_ORDER = ("block_start", "line_no")


def score_files(
    spark: SparkSession,
    root: str,
    out: str,
    make_scorer: Callable[[], Scorer],
    model: str,
    yaml_style: bool = True,
    max_records: int = 0,
    max_retries: int = MAX_RETRIES,
    partitions: int | None = None,
    ledger: str | None = None,
    per_task: int = PER_TASK,
    retry_failed: bool = False,
) -> dict[str, int]:
    """Judge every record below ``root`` and write it with its ``evaluation`` to ``out``.

    Replies are kept in ``ledger`` (a folder in ``out`` unless given) as tasks of ``per_task`` prompts
    end (or of as many as ``partitions`` tasks make), so a job that is run again asks only what is
    open; equal prompts are asked once.
    Returns the counts of processed records and of prompts asked. Each shard becomes a file at
    its own path, also one without records; with ``max_records`` only the files that
    hold the first so many are read and written.
    """
    ledger = ledger or f"{out.rstrip('/')}/_replies"
    files = first_files(spark, root, max_records) if max_records > 0 else None
    lines = scan_records(spark, root, parse=False, files=files)
    lines = limit_global(lines, max_records, line=LINE_ORDER, chunk=F.col("block_start"))
    pairs = extract_pair(parse_records(lines)).select(
        "rel_path", *LINE_ORDER, "raw", "prompt", "output", "output_format"
    )
    seen = Observation()
    pairs = pairs.observe(seen, F.count(F.lit(1)).alias("processed"))
    # Written once: the prompts are needed before the replies, the rest beside them.
    checked = written(prompted(pairs, yaml_style))
    asked = checked.select(F.col("_prompt").alias("prompt"))
    asked = answer(asked, ledger, make_scorer, model, max_retries, per_task, retry_failed=retry_failed, partitions=partitions)
    rows = with_replies(checked, ledger, model, F.concat_ws(":", "rel_path", *LINE_ORDER))
    line = with_evaluation(F.col("raw"), value=evaluation_text(F.col("evaluation")))
    scored = concluded(rows, model).select("rel_path", *LINE_ORDER, line.alias("line"))
    shards = list_shards(spark, root)
    shards = shards if files is None else shards.where(F.col("path").isin(files))
    write_scored(scored, out, order=LINE_ORDER, chunk=F.col("block_start"), shards=shards)
    return {**seen.get, "asked": asked}


def filter_files(
    spark: SparkSession,
    scored: str,
    out: str,
    min_score: Mapping[str, int] | None = None,
    require_usable_flag: bool = True,
) -> dict[str, int]:
    """Write the kept records of ``scored`` to ``out``; returns processed and kept counts.

    ``scored`` is any tree of scored JSON lines, or what ``write_scored_folders`` wrote. The counts
    are observed while writing, so the shards are read once. Every shard gets a file, kept lines or not.
    """
    seen = Observation()
    rows = score_and_format(parse_records(read_scored(spark, scored)))
    kept = is_kept(F.col("usable"), F.col("score"), F.col("format"), min_score, require_usable_flag)
    rows = rows.select("rel_path", *LINE_ORDER, "raw", kept.alias("kept")).observe(
        seen, F.count(F.lit(1)).alias("processed"), F.count_if("kept").alias("kept")
    )
    shards = list_shards(spark, scored, "*.jsonl")
    shards = shards.where(~F.col("rel_path").startswith("rel_path="))
    write_scored(rows.where("kept"), out, "raw", order=LINE_ORDER, chunk=F.col("block_start"), shards=shards)
    return seen.get


def audit_datasets(
    df: DataFrame, out: str, yaml_style: bool = True, max_rows: int = 0, save_errors: bool = False
) -> None:
    """All reports on rows of ``dataset, split, dataset_pos, i, record``, below ``out``.

    The measured records are written once and every report reads that table.
    """
    measured = audit_records(limit_per_dataset(df, max_rows), yaml_style)
    measured = measured.drop("metadata", "raw", "assistant_text").withColumn("messages", F.to_json("messages"))
    measured.write.parquet(f"{out}/measured")
    table = df.sparkSession.read.schema(measured.schema).parquet(f"{out}/measured")
    write_by_task(route_rows(table), f"{out}/tasks", save_errors)
    write_summary(task_stats(table), f"{out}/summary_task_stats")
    reasons = task_error_reasons(table).where("reason IS NOT NULL")
    write_summary(reasons.groupBy("task_key", "reason").agg(F.sum("rows").alias("rows")), f"{out}/summary_task_errors")
    write_summary(escape_report(table), f"{out}/summary_escape_stats")
    toml = toml_structure_stats(table.where("output_format = 'TOML'"))
    write_summary(toml, f"{out}/summary_toml_structure_stats", null_text="N/A")
    inline_table_sample(table).write.json(f"{out}/toml_inline_table_examples")
