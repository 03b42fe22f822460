"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")
    return f"{root.rstrip('/')}/sftq-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: computed once, of known size, safe from lost executors."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
