"""A sink that writes one file for each shard, at the shard's own path.

Tasks write the parts of shards to a staging folder and report them in their commit message;
the commit writes the list of parts, which decides what belongs to the result. A second
job then puts each shard in its place: the only part is moved, several are joined in their
order, and a shard without rows becomes an empty file. It repeats safely if a task is lost.
Paths are opened with Arrow's file systems (local and mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from sftq.sources.scratch import written

PARTS = pa.schema([("shard", pa.string()), ("chunk", pa.int64()), ("serial", pa.int64()), ("file", pa.string())])
COPY_BYTES = 1 << 24


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@dataclass
class Parts(WriterCommitMessage):
    """``shard, chunk, serial, file`` of what a task has written."""

    rows: list[tuple[str, int, int, str]]


class ShardWriter(DataSourceArrowWriter):
    """Rows ``shard, chunk, line``, sorted by shard and chunk within a task, to parts."""

    def __init__(self, staging: str):
        self.staging = staging

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        store, root = opened(self.staging)
        task = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        rows: list[tuple[str, int, int, str]] = []
        current, sink = None, None
        for batch in iterator:
            shards, chunks = (batch.column(k) for k in (0, 1))
            lines = batch.column(2).to_pylist()
            keys = list(zip(shards.to_pylist(), chunks.to_pylist(), strict=True))
            begin = 0
            for at in range(1, len(keys) + 1):
                if at < len(keys) and keys[at] == keys[begin]:
                    continue
                if keys[begin] != current:
                    if sink:
                        sink.close()
                    current = keys[begin]
                    if not rows:
                        store.create_dir(f"{root}/{task}")
                    file = f"{task}/{len(rows)}"
                    rows.append((*current, len(rows), file))
                    sink = store.open_output_stream(f"{root}/{file}")
                sink.write("".join([f"{line}\n" for line in lines[begin:at]]).encode())
                begin = at
        if sink:
            sink.close()
        return Parts(rows)

    def commit(self, messages: list[Parts | None]) -> None:
        store, root = opened(self.staging)
        store.create_dir(root)
        rows = [row for m in messages if m for row in m.rows]
        columns = zip(*rows, strict=True) if rows else [[]] * len(PARTS)
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, PARTS)], schema=PARTS)
        pq.write_table(table, f"{root}/parts.parquet", filesystem=store)

    def abort(self, messages: list[Parts | None]) -> None:
        store, root = opened(self.staging)
        if store.get_file_info(root).type == fs.FileType.Directory:
            store.delete_dir(root)


class ShardSink(DataSource):
    """``df.write.format("sftq_shards").option("staging", folder)``."""

    @classmethod
    def name(cls) -> str:
        return "sftq_shards"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["staging"])


def _place(batches: Iterator[pa.RecordBatch], path: str, staging: str) -> Iterator[pa.RecordBatch]:
    """Rows ``shard, files`` to the finished files."""
    store, root = opened(path)
    _, parts = opened(staging)
    there = lambda file: store.get_file_info(file).type == fs.FileType.File
    for batch in batches:
        for shard, files in zip(*(batch.column(c).to_pylist() for c in ("shard", "files"))):
            if not shard or shard.startswith("/") or ".." in shard.split("/"):
                raise ValueError(f"not a path below the output folder: {shard!r}")
            files, target = [f"{parts}/{f}" for f in files], f"{root}/{shard}"
            store.create_dir(target.rpartition("/")[0])
            whole = files[0] if len(files) == 1 else f"{parts}/whole-{uuid.uuid4().hex}"
            if len(files) == 1 and not there(whole):
                if there(target):
                    continue  # an earlier attempt of this task has moved it
                raise FileNotFoundError(whole)
            if len(files) != 1:
                with store.open_output_stream(whole) as sink:
                    for file in files:
                        with store.open_input_stream(file) as source:
                            while data := source.read(COPY_BYTES):
                                sink.write(data)
            if there(target) and not isinstance(store, fs.LocalFileSystem):
                store.delete_file(target)
            store.move(whole, target)
        yield batch.select(["shard"])


def dealt(rows: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows ``shard, chunk, line`` and those of ``order`` in tasks, each sorted; no shard is bound to one task.

    With ``order``, a chunk is one task's. Rows without the column ``chunk`` are stored, dealt by ranges
    of shard and order, and take the number of their range as their chunk. Without ``order`` any task
    may write any row of a chunk: adaptive execution cuts what is too large for one and joins what is small.
    """
    chunked = "chunk" in rows.columns
    if not order:
        rows = rows if chunked else rows.withColumn("chunk", F.lit(0))
        rows = rows.hint("rebalance", "shard", "chunk").sortWithinPartitions("shard", "chunk")
    elif chunked:
        rows = rows.repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", *order)
    else:
        # Stored, as ranges are found by a look at the rows before they are dealt.
        rows = written(rows).repartitionByRange("shard", *order).sortWithinPartitions("shard", *order)
        rows = rows.withColumn("chunk", F.spark_partition_id())
    return rows.select("shard", F.col("chunk").cast("long"), "line")


def write_shards(rows: DataFrame, path: str, shards: DataFrame | None = None, order: Sequence[str] = ()) -> None:
    """Rows ``shard, chunk, line`` as files below ``path``; ``shards`` names files that must exist, rows or not.

    Chunks of a shard follow each other by number, and the lines of a chunk in ``order``; ``chunk`` may be
    missing. Files that are there already are replaced.
    """
    spark = rows.sparkSession
    spark.dataSource.register(ShardSink)
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    dealt(rows, order).write.format("sftq_shards").option("staging", staging).mode("append").save()
    parts = spark.read.schema("shard string, chunk long, serial long, file string").parquet(f"{staging}/parts.parquet")
    files = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "serial", "file"))), lambda p: p["file"])
    todo = parts.groupBy("shard").agg(files.alias("files"))
    if shards is not None:
        none = F.array().cast("array<string>")
        todo = shards.select("shard").distinct().join(todo, "shard", "full").select("shard", F.coalesce("files", none).alias("files"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = todo.repartition(tasks).mapInArrow(lambda batches: _place(batches, path, staging), "shard string")
    done.agg(F.count("*")).collect()
    store, root = opened(staging)
    store.delete_dir(root)
