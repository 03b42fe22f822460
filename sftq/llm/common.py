"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but these.
BLANKS = r"\x20\x09-\x0D"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the checksum of the identifier's decimal text; null ids fall into fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/sftq-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage like ``checkpoint()`` does, in compressed columns, and gives the
    planner true sizes. The files stay until the checkpoint folder is cleaned.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_rows(df: DataFrame, *replaced: str) -> DataFrame:
    """``df`` as one struct column ``row`` without the ``replaced`` columns.

    Helper columns beside ``row`` cannot clash with the caller's.
    """
    gone = {name.lower() for name in replaced}
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in gone]
    return df.select(F.struct(*kept).alias("row"))


def binary_list(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Values of a text column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches_of(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most_bytes`` bytes, one row at least.

    A single row may be larger; it makes a batch of its own.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        start, size = 0, 0
        for i, n in enumerate(lengths.to_pylist()):
            if size and size + n > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def hashed(values):
    """A mixed copy of an array of unsigned 64-bit integers."""
    import numpy as np

    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))
