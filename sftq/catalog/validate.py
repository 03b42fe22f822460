"""Queries on syntax and style verdicts."""

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.functions.formats import norm_format
from sftq.functions.text import extract_payload
from sftq.operators import validate as V


def _payloads(t, fmt):
    """Payloads of one format's records, extracted from the model text."""
    rows = t.sft_records.withColumn("label", norm_format(F.col("output_format")))
    return extract_payload(rows.where(F.col("label") == fmt), text="output", fmt="label")


def _verdicts(t, fmt):
    rows = V.parse_verdict(_payloads(t, fmt), "payload", "label", "v")
    reason = F.substring_index("v.reason", ":", 1)
    return rows.select("record_id", F.col("v.ok").alias("ok"), reason.alias("reason_class"))


def _parse_sql(fmt, ok="expect_ok"):
    return f"""SELECT record_id, {ok} AS ok, CASE WHEN {ok} THEN 'ok' ELSE 'parse_fail' END AS reason_class
       FROM $sft_records r WHERE expect_format = '{fmt}'"""


@query("validate_json", _parse_sql("JSON", "json_valid(expect_payload)"))
def validate_json(t):
    return _verdicts(t, "JSON")


@query("validate_yaml", _parse_sql("YAML", "true"))
def validate_yaml(t):
    return _verdicts(t, "YAML")


@query(
    "yaml_indent_canonical",
    """SELECT record_id, list_bool_and(list_transform(string_split(expect_payload, chr(10)),
         lambda x: (length(x) - length(ltrim(x, ' '))) % 2 = 0)) AS canonical
       FROM $sft_records r WHERE expect_format = 'YAML'""",
)
def yaml_indent_canonical(t):
    verdict = V.yaml_indent_canonical(F.col("payload"))
    return _payloads(t, "YAML").select("record_id", verdict.alias("canonical"))


@query("validate_toml", _parse_sql("TOML"))
def validate_toml(t):
    return _verdicts(t, "TOML")


@query("validate_xml", _parse_sql("XML"))
def validate_xml(t):
    return _verdicts(t, "XML")


@query(
    "validate_csv",
    """SELECT record_id, expect_ok AS ok, CASE WHEN expect_ok THEN 'ok' WHEN record_id % 2 = 0 THEN 'parse_fail: row 2 width mismatch: 4 != 3'
         ELSE 'parse_fail: row ' || CAST(len(string_split(expect_payload, chr(10))) AS STRING) || ' width mismatch: 3 != 2' END AS reason
       FROM $sft_records r WHERE expect_format = 'CSV'""",
)
def validate_csv(t):
    rows = V.parse_verdict(_payloads(t, "CSV"), "payload", "label", "v")
    return rows.select("record_id", "v.ok", "v.reason")


@query(
    "validate_by_format",
    """SELECT record_id, expect_ok AND record_id % 13 <> 0 AS ok,
         CASE WHEN record_id % 13 = 0 THEN 'unknown_format: INI' WHEN expect_ok THEN 'ok'
              WHEN expect_format = 'YAML' THEN 'yaml_indent_fail' ELSE 'parse_fail' END AS reason_class,
         CASE WHEN record_id % 13 = 0 THEN 'INI' ELSE expect_format END AS output_format
       FROM $sft_records r""",
)
def validate_by_format(t):
    label = F.when(F.col("record_id") % 13 == 0, "c_ini").otherwise(F.col("output_format"))
    rows = V.validate_by_format(t.sft_records.withColumn("output_format", label), text="output")
    reason = F.regexp_replace("grammar.reason", "(?s)^parse_fail: .*", "parse_fail")
    return rows.select("record_id", "grammar.ok", reason.alias("reason_class"), "grammar.output_format")
