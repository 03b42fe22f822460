"""A corpus pipeline: stages over ``documents``, each reading what the one before it wrote.

All stages take null texts as empty and texts of any length whole, give no rows for no rows, and
keep all columns as they are, whatever their names; only packing returns columns of its own.
Repeated rows are judged each by the quality rules, are one document to line dedup and one row to
near-dedup, and are mixed and packed each. Ties go to the smaller identifier, nulls last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftq.llm import lines, mixing, packing, quality, simhash
from sftq.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule, or come from a rejected host, go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines go, but for the first; ``n_chars`` follows the text."""
    out = lines.drop_repeated(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token pieces placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints and tokens have no SQL form; the tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
