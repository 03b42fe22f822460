"""Queries on structured-output extraction."""

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.functions import text as T


@query(
    "after_last_marker",
    """SELECT record_id, CASE WHEN record_id % 4 = 1 THEN expect_payload ELSE trim(output, ' ' || chr(10)) END AS text
       FROM $sft_records r""",
)
def after_last_marker(t):
    return t.sft_records.select("record_id", T.after_last_marker(F.col("output")).alias("text"))


@query(
    "last_fenced_block",
    """SELECT record_id, CASE WHEN record_id % 4 >= 2 THEN expect_payload ELSE trim(output, ' ' || chr(10)) END AS text
       FROM $sft_records r""",
)
def last_fenced_block(t):
    return t.sft_records.select("record_id", T.last_fenced_block(F.col("output")).alias("text"))


@query(
    "json_substring",
    r"""SELECT record_id, coalesce(trim(regexp_extract(output, '(?s)[{\[].*'), ' ' || chr(10)), '') AS text
       FROM $sft_records r""",
)
def json_substring(t):
    return t.sft_records.select("record_id", T.json_substring(F.col("output")).alias("text"))


@query(
    "xml_substring",
    """SELECT record_id, CASE WHEN contains(output, '<') THEN trim(substr(output, strpos(output, '<')), ' ' || chr(10)) ELSE '' END AS text
       FROM $sft_records r""",
)
def xml_substring(t):
    return t.sft_records.select("record_id", T.xml_substring(F.col("output")).alias("text"))


@query(
    "drop_leading_prose",
    """SELECT record_id, expect_payload AS text FROM $sft_records r
       WHERE expect_format IN ('YAML', 'TOML', 'CSV')""",
)
def drop_leading_prose(t):
    text, kind = F.concat(F.lit("Some words\n  \n"), "payload", F.lit("\n")), F.col("fmt")
    kept = F
    for name in ("YAML", "TOML", "CSV"):
        kept = kept.when(kind == name, T.drop_leading_prose(text, name))
    rows = t.sft_payloads.where(kind.isin("YAML", "TOML", "CSV"))
    return rows.select(F.col("doc_id").alias("record_id"), kept.alias("text"))


@query(
    "extract_final_output",
    "SELECT record_id, expect_payload AS final_output FROM $sft_records r",
)
def extract_final_output(t):
    return T.extract_final_output(t.sft_records).select("record_id", "final_output")


@query(
    "strip_fence_lines",
    r"""SELECT record_id, trim(regexp_replace(output, '(?m)^\s*```[a-zA-Z0-9_\-]*\s*$', '', 'g'), ' ' || chr(10)) AS text
       FROM $sft_records r""",
)
def strip_fence_lines(t):
    return t.sft_records.select("record_id", T.strip_fence_lines(F.col("output")).alias("text"))


@query(
    "extract_payload",
    "SELECT record_id, expect_payload AS payload FROM $sft_records r",
)
def extract_payload(t):
    return T.extract_payload(t.sft_records, text="output").select("record_id", "payload")
