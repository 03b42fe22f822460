"""Writing scored records, routed rows and summary tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftq.functions.whitespace import strip
from sftq.sources.jsonl import scan_records
from sftq.sources.shards import write_shards


@F.arrow_udf(T.StringType())
def _replace_evaluation(raw: pa.Array, evaluation: pa.Array) -> pa.Array:
    def replaced(record: str | None, value: str) -> str | None:
        if record is None:
            return None
        return json.dumps(json.loads(record) | {"evaluation": json.loads(value)}, ensure_ascii=False)

    pairs = zip(raw.to_pylist(), evaluation.to_pylist())
    return pa.array([replaced(r, e) for r, e in pairs], pa.string())


def evaluation_text(evaluation: Column) -> Column:
    """The scoring plan's ``evaluation`` as JSON: nulls stay, but for those of ``llm.meta``.

    Skipped records have no ``meta``, judged ones only the fields that the judge gave.
    """
    whole = {"ignoreNullFields": "false"}
    open_end = lambda c: F.regexp_replace(F.to_json(c, whole), r"\}$", "")
    meta = F.concat(F.lit(',"meta":'), F.to_json(evaluation["llm"]["meta"]))
    llm = F.concat(open_end(evaluation["llm"].dropFields("meta")), F.coalesce(meta, F.lit("")), F.lit("}"))
    ends = F.to_json(F.struct(evaluation["usable"].alias("usable"), evaluation["timestamp"].alias("timestamp")), whole)
    starts = open_end(F.struct(evaluation["extraction"].alias("extraction"), evaluation["grammar"].alias("grammar")))
    return F.concat(starts, F.lit(',"llm":'), llm, F.lit(","), F.substr(ends, F.lit(2)))


def with_evaluation(raw: Column, evaluation: Column | None = None, value: Column | None = None) -> Column:
    """The record's JSON text with its ``evaluation`` member set, from a column or as JSON ``value``.

    The member is appended to the text, so all other fields stay exactly as they were;
    only records that already carry one are rebuilt.
    """
    if value is None:
        value = F.to_json(evaluation, {"ignoreNullFields": "false"})
    present = F.array_contains(F.json_object_keys(raw), "evaluation")
    body = F.regexp_replace(strip(raw), rf"\s*+\}}$", "")
    comma = F.when(strip(body) == "{", "").otherwise(", ")
    appended = F.concat(body, comma, F.lit('"evaluation": '), value, F.lit("}"))
    odd = F.coalesce(present, F.lit(True))
    return F.when(odd, _replace_evaluation(F.when(odd, raw), F.when(odd, value))).otherwise(appended)


def write_scored(
    df: DataFrame, path: str, line: str = "line", shard: str = "rel_path", order: Sequence[str] = (),
    chunk: Column | None = None, shards: DataFrame | None = None,
) -> None:
    """JSON lines, one file for each shard at the shard's own path below ``path``.

    ``chunk`` numbers runs of a shard's lines in their order; with ``order`` each is written by one
    task, so a large shard is written by many. Without it a shard is cut by ranges of ``order``, for
    which the lines are stored once, or anywhere if there is none. ``shards`` (column ``rel_path``)
    names the shards that get a file even without lines.
    """
    part = [] if chunk is None else [chunk.cast("long").alias("chunk")]
    rows = df.select(F.col(shard).alias("shard"), *part, F.col(line).alias("line"), *[F.col(c).alias(f"_{c}") for c in order])
    write_shards(rows, path, None if shards is None else shards.select(F.col("rel_path").alias("shard")), [f"_{c}" for c in order])


def write_scored_folders(
    df: DataFrame, path: str, line: str = "line", shard: str = "rel_path", order: Sequence[str] = ()
) -> None:
    """JSON lines, one folder per input shard. Rows stay in the tasks that hold them: no shuffle.

    Within a task they are sorted by shard and ``order``, so a file keeps its shard's order.
    """
    rows = df.sortWithinPartitions(shard, *order) if order else df
    rows.select(shard, F.col(line).alias("value")).write.partitionBy(shard).option(
        "compression", "none"
    ).text(path)


def read_scored(spark: SparkSession, path: str, glob: str = "*.{jsonl,txt}") -> DataFrame:
    """``rel_path``, ``raw`` and the order of the lines of a tree of scored files.

    A tree of shards is read as it is. In what ``write_scored_folders`` wrote, the shard is the
    name of the folder, not the path of the part file. Lines are not numbered.
    """
    lines = scan_records(spark, path, parse=False, glob=glob, numbered=False)
    folder = F.regexp_extract("rel_path", r"^rel_path=([^/]*)/", 1)
    shard = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return lines.withColumn("rel_path", F.when(folder != "", shard).otherwise(F.col("rel_path")))


def write_by_task(df: DataFrame, path: str, save_errors: bool = False) -> None:
    """Routed rows as JSON below ``status=…/task_key=…``.

    The rebalance hint gathers a task's rows into few files and splits large tasks
    over several writers by size.
    """
    rows = df if save_errors else df.where("status = 'usable'")
    rows.hint("rebalance", "status", "task_key").write.partitionBy("status", "task_key").json(path)


def write_summary(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, null_text: str = ""
) -> None:
    """A summary table as CSV with a header and as JSON, in the given column order.

    Adaptive execution writes a small table as one file; sorted rows stay sorted across files.
    """
    # Computed for the JSON files only; these are read again for the CSV ones.
    table = df.select(*columns) if columns else df
    table.write.option("ignoreNullFields", False).json(f"{path}/json")
    kept = df.sparkSession.read.schema(table.schema).json(f"{path}/json")
    nested = {f.name for f in table.schema if f.dataType.simpleString().startswith(("map", "array", "struct"))}
    flat = kept.select(*[F.to_json(c).alias(c) if c in nested else c for c in table.columns])
    csv = {"header": "true", "escape": '"', "nullValue": null_text}
    flat.write.options(**csv).csv(f"{path}/csv")
