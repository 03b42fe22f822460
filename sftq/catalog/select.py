"""Queries on keeping and limiting records."""

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.operators import select as S
from sftq.sources.jsonl import parse_records as parsed

SHIPPED = {"csv": 80, "json": 80, " Yaml": 80, "toml": 80, "xml": 80}

_SCORE = "CASE WHEN score_text IS NULL OR record_id % 10 <= 1 THEN 0 ELSE CAST(score_text AS INT) END"
_LABEL = "upper(trim(coalesce(output_format, '')))"
_THRESHOLD = f"CASE WHEN {_LABEL} IN ('CSV', 'JSON', 'YAML', 'TOML', 'XML') THEN {{}} ELSE 0 END"
_KEPT = f"(coalesce(usable, false) AND {_SCORE} >= {_THRESHOLD.format(80)})"


def scored(t):
    return S.score_and_format(parsed(t.sft_scored.drop("usable", "output_format", "score_text")))


@query(
    "score_and_format",
    f"""SELECT record_id, {_SCORE.replace('record_id % 10 <= 1', 'record_id % 10 <= 1 OR try_cast(score_text AS INT) IS NULL').replace('AS INT) END', 'AS BIGINT) END')} AS score,
         {_LABEL} AS format, coalesce(usable, false) AS usable FROM $sft_scored s""",
)
def score_and_format(t):
    return scored(t).select("record_id", "score", "format", "usable")


@query(
    "format_thresholds",
    f"SELECT record_id, {_THRESHOLD.format(80)} AS shipped, {_THRESHOLD.format(90)} AS by_default FROM $sft_scored s",
)
def format_thresholds(t):
    fmt = F.col("format")
    return scored(t).select(
        "record_id", S.threshold(fmt, SHIPPED).alias("shipped"), S.threshold(fmt).alias("by_default")
    )


@query("keep_filter", f"SELECT record_id FROM $sft_scored s WHERE {_KEPT}")
def keep_filter(t):
    return S.keep_filter(scored(t), SHIPPED).select("record_id")


@query(
    "filter_counts",
    f"""SELECT coalesce(rel_path, 'all') AS shard, count(*) AS processed, count(*) FILTER (WHERE {_KEPT}) AS kept
        FROM $sft_scored s GROUP BY ROLLUP (rel_path)""",
)
def filter_counts(t):
    kept = S.is_kept(F.col("usable"), F.col("score"), F.col("format"), SHIPPED)
    counts = S.filter_counts(scored(t), kept)
    return counts.select(F.coalesce("rel_path", F.lit("all")).alias("shard"), "processed", "kept")


@query(
    "limit_global",
    """SELECT record_id, rel_path, line_no FROM $sft_scored s
       ORDER BY string_split(rel_path, '/'), line_no LIMIT 300""",
)
def limit_global(t):
    return S.limit_global(t.sft_scored.select("record_id", "rel_path", "line_no"), 300)


@query(
    "limit_global_by_chunks",
    """SELECT record_id, rel_path, line_no FROM $sft_scored s
       ORDER BY string_split(rel_path, '/'), line_no LIMIT 300""",
)
def limit_global_by_chunks(t):
    rows = t.sft_scored.select("record_id", "rel_path", "line_no")
    return S.limit_global(rows, 300, chunk=F.floor(F.col("line_no") / 64))


_PER_DATASET = """SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM $documents d) q WHERE n <= 20"""


@query("limit_per_dataset", _PER_DATASET)
def limit_per_dataset(t):
    rows = t.documents.select("doc_id", "source")
    return S.limit_per_dataset(rows, 20, dataset="source", row="doc_id")


@query("limit_per_dataset_by_chunks", _PER_DATASET)
def limit_per_dataset_by_chunks(t):
    rows = t.documents.select("doc_id", "source")
    chunk = F.floor(F.col("doc_id") / 64)
    return S.limit_per_dataset(rows, 20, dataset="source", row="doc_id", chunk=chunk)
