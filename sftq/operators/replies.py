"""A ledger of the judge's replies, so that a prompt is paid for once.

Replies are recorded as tasks finish, not when the job does: with version 2 of Hadoop's
output committer a task's file is in its final place once the task is done. A job that
dies leaves what it has paid for, and the next one asks only what is open.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftq.operators.judge import BATCH_SIZE, MAX_RETRIES, REPLY, Scorer, judge

#: Prompts of a task: what a lost task or a dead driver costs at most, for each core.
PER_TASK = 256
MOST_TASKS = 100_000
SCHEMA = f"key string, reply {REPLY.simpleString()}"
AS_TASKS_END = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def prompt_key(model: str, prompt: Column) -> Column:
    """What a reply is filed under: a SHA-256 of model and prompt, null for no prompt."""
    return F.sha2(F.concat(F.lit(model + "\n"), prompt), 256)


def recorded(spark: SparkSession, ledger: str) -> DataFrame:
    """``key, reply`` of all replies so far, one for each key; good ones are preferred.

    A key is filed twice only if a task died while its file was put in place, or two jobs
    share a ledger, so the rows are usually taken as they are.
    """
    spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(f"{ledger}/replies")
    rows = spark.read.schema(SCHEMA).parquet(f"{ledger}/replies")
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        return rows
    best = F.struct("reply.ok", "reply.text", "reply.error", "reply.raw", "reply.at")
    return rows.groupBy("key").agg(F.max_by("reply", best).alias("reply"))


def open_prompts(prompts: DataFrame, ledger: str, model: str, retry_failed: bool = False) -> DataFrame:
    """``key, prompt``: each distinct non-null ``prompt`` that has no reply yet.

    ``retry_failed`` counts replies that failed for good as none.
    """
    known = recorded(prompts.sparkSession, ledger)
    known = known.where("reply.ok") if retry_failed else known
    asked = prompts.where("prompt IS NOT NULL").select(prompt_key(model, F.col("prompt")).alias("key"), "prompt")
    return asked.dropDuplicates(["key"]).join(known.select("key"), "key", "left_anti")


def answer(
    prompts: DataFrame,
    ledger: str,
    make_scorer: Callable[[], Scorer],
    model: str,
    max_retries: int = MAX_RETRIES,
    per_task: int = PER_TASK,
    batch_size: int = BATCH_SIZE,
    retry_failed: bool = False,
    partitions: int | None = None,
) -> int:
    """Ask what is open among ``prompts`` (column ``prompt``) and record it; returns how many were asked.

    A task asks ``per_task`` prompts, unless the number of tasks is given as ``partitions``.
    The open prompts are written first, so that their number is known and no lost task can
    change which prompts another one asks.
    """
    spark = prompts.sparkSession
    todo = f"{ledger}/open/{uuid.uuid4().hex}"
    open_prompts(prompts, ledger, model, retry_failed).write.parquet(todo)
    rows = spark.read.schema("key string, prompt string").parquet(todo)
    n = rows.count()
    if n:
        tasks = partitions or min(MOST_TASKS, math.ceil(n / per_task))
        replies = rows.repartition(tasks).select("key", judge(F.col("prompt"), make_scorer, max_retries, batch_size).alias("reply"))
        replies.write.mode("append").options(**AS_TASKS_END).parquet(f"{ledger}/replies")
    folder = spark._jvm.org.apache.hadoop.fs.Path(todo)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return n


def with_replies(df: DataFrame, ledger: str, model: str, place: Column, prompt: str = "_prompt", out: str = "_reply") -> DataFrame:
    """Add the recorded reply to each row's ``prompt``; null where there is none to ask.

    ``place`` tells rows apart: those without a prompt are dealt by it instead of meeting in one task.
    """
    key = F.coalesce(prompt_key(model, F.col(prompt)), F.concat(F.lit("none:"), place))
    known = recorded(df.sparkSession, ledger).select(F.col("key").alias("_key"), F.col("reply").alias(out))
    return df.withColumn("_key", key).join(known, "_key", "left").drop("_key")
