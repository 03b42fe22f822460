"""Queries on record shapes."""

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.functions.formats import norm_format as canonical
from sftq.operators import records as R
from sftq.sources.jsonl import parse_records as parsed




@query(
    "detect_family",
    """SELECT record_id, CASE WHEN shape IN (0, 3) THEN 'u10bei' WHEN shape IN (1, 2) THEN 'daichira' ELSE 'unknown' END AS family
       FROM $raw_records r""",
)
def detect_family(t):
    return parsed(t.raw_records).select("record_id", R.detect_family(F.col("record")).alias("family"))


@query(
    "detect_family_audit",
    """SELECT record_id, CASE WHEN shape IN (2, 3) THEN 'u10bei' WHEN shape = 4 THEN 'daichira' ELSE 'unknown' END AS family
       FROM $raw_records r""",
)
def detect_family_audit(t):
    return parsed(t.raw_records).select(
        "record_id", R.detect_family_audit(F.col("record")).alias("family")
    )


@query(
    "last_role_content",
    """SELECT conv_id,
         coalesce(max_by(coalesce(text, ''), turn) FILTER (WHERE role = 'user'), '') AS last_user,
         coalesce(max_by(coalesce(text, ''), turn) FILTER (WHERE role = 'assistant'), '') AS last_assistant
       FROM $conversations c GROUP BY conv_id""",
)
def last_role_content(t):
    return t.conversations.groupBy("conv_id").agg(
        R.last_turn("user").alias("last_user"), R.last_turn("assistant").alias("last_assistant")
    )


@query(
    "extract_pair",
    """SELECT record_id, CASE WHEN shape IN (0, 3) THEN 'u10bei' WHEN shape IN (1, 2) THEN 'daichira' ELSE 'unknown' END AS family,
         CASE WHEN shape IN (0, 1) THEN expect_prompt ELSE '' END AS prompt,
         CASE WHEN shape IN (0, 1, 3) THEN expect_output ELSE '' END AS output, expect_label AS output_format
       FROM $raw_records r""",
)
def extract_pair(t):
    pairs = R.extract_pair(parsed(t.raw_records))
    return pairs.select("record_id", "family", "prompt", "output", "output_format")


@query("norm_format", "SELECT record_id, expect_format AS format FROM $sft_records r")
def norm_format(t):
    return t.sft_records.select("record_id", canonical(F.col("output_format")).alias("format"))


CATEGORIES = """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'C_XML' WHEN 1 THEN 'C_TOML' ELSE 'C_CSV' END AS category,
  CASE doc_id % 4 WHEN 0 THEN 'xml_to_yaml' WHEN 1 THEN 'text_to_yml ' WHEN 2 THEN 'extract' ELSE '' END AS subcategory
FROM $documents d
"""


@query(
    "infer_format_from_category",
    """SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN 'YAML' WHEN doc_id % 3 = 0 THEN 'XML' WHEN doc_id % 3 = 1 THEN 'TOML' ELSE 'CSV' END AS format
       FROM $documents d""",
)
def infer_format_from_category(t):
    i = F.col("doc_id")
    category = F.element_at(F.array(*map(F.lit, ("C_XML", "C_TOML", "C_CSV"))), (i % 3 + 1).cast("int"))
    sub = F.element_at(
        F.array(*map(F.lit, ("xml_to_yaml", "text_to_yml ", "extract", ""))), (i % 4 + 1).cast("int")
    )
    return t.documents.select("doc_id", R.infer_format_from_category(sub, category).alias("format"))


@query(
    "explode_bundles",
    """SELECT doc_id, j, lang || CAST(j AS STRING) AS format, text || CAST(j AS STRING) AS content
       FROM $documents d CROSS JOIN (VALUES (0), (1), (2)) AS m(j) WHERE j < 1 + doc_id % 3""",
)
def explode_bundles(t):
    def member(j):
        return F.struct(F.concat("lang", F.lit(str(j))).alias("format"))

    def turns(j):
        said = F.concat("text", F.lit(str(j)))
        return F.array(F.struct(F.lit("assistant").alias("role"), said.alias("content")))

    bundles = t.documents.select(
        "doc_id",
        F.slice(F.array(*map(member, range(3))), F.lit(1), (1 + F.col("doc_id") % 3).cast("int")).alias(
            "metadata"
        ),
        F.array(*map(turns, range(3))).alias("messages"),
    )
    return R.explode_bundles(bundles).select(
        "doc_id",
        "j",
        F.col("metadata.format").alias("format"),
        R.last_role_content(F.col("messages"), "assistant").alias("content"),
    )


@query("task_key", "SELECT i, idx, task_key FROM $audit_expected e")
def task_key(t):
    return R.record_infos(parsed(t.audit_raw)).select("i", "idx", "task_key")
