"""The operators over their whole tables, with the settings used in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sftq.llm import ann, divergence, ledger, lines, mixing, packing, phrases, quality, repeats, simhash, suffix_tree, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_nearest_neighbours": lambda spark, sf_dir: ann.nearest(table(spark, sf_dir, "embeddings")),
    "op2_url_filters": urls.query,
    "op3_toxicity": lambda spark, sf_dir: toxicity.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op4_simhash_near_dedup": documents(simhash.clusters),
    "op5_line_dedup": documents(lines.digest),
    "op6_quality_rules": documents(quality.judged),
    "op7_lm_scoring": documents(suffix_tree.score),
    "op8_suffix_array_dedup": documents(repeats.digest),
    "op9_best_fit_packing": documents(packing.pack),
    "op10_source_mixing": documents(mixing.mixed),
    "op11_secret_scans": documents(ledger.digest),
    "op12_phrase_collocations": documents(phrases.mine),
    "op13_source_divergence": documents(divergence.audit),
}

#: DuckDB SQL of those that SQL can express.
ORACLES: dict[str, str] = {
    "op1_nearest_neighbours": ann.ORACLE,
    "op2_url_filters": urls.ORACLE,
    "op5_line_dedup": lines.ORACLE,
    "op11_secret_scans": ledger.ORACLE,
    "op12_phrase_collocations": phrases.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
