"""The audit plan: classify, validate and measure every record once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.functions.formats import norm_format
from sftq.functions.staging import once
from sftq.functions.text import extract_payload
from sftq.functions.whitespace import unix_lines
from sftq.operators.audit import (
    any_json,
    escape_entries,
    inline_fold,
    inline_tables_of,
    toml_json_candidates,
    toml_structure,
)
from sftq.operators.records import PAIRED, record_infos
from sftq.operators.validate import parse_verdict, yaml_indent_canonical


def member_order(row: Column, member: Column) -> Column:
    """``STRUCT<i, j>`` that orders bundle members within a dataset."""
    first = F.coalesce(member, F.lit(0)).cast("bigint")
    return F.struct(row.cast("bigint").alias("i"), first.alias("j"))


def measure_records(df: DataFrame, yaml_style: bool = True) -> DataFrame:
    """Add ``format, payload, usable, reason, escapes, inline, structure, json_stringified_like``.

    Needs ``family, output_format`` and ``assistant_text``. All Python work (parsers,
    inline tables, JSON in strings) shares one Arrow hop.
    """
    payload, fmt = F.col("payload"), F.col("format")
    toml = fmt == "TOML"
    structured = (F.col("output_format") == "TOML") & (F.col("family") == PAIRED)
    df = df.withColumn("format", norm_format(F.col("output_format")))
    df = extract_payload(df, "assistant_text", "format", "payload")
    df = df.withColumns(
        {
            "_strings": F.when(structured, toml_json_candidates(payload)),
            "_lines": F.when(structured, unix_lines(payload)),
            "_fold": once(inline_fold(F.when(toml, payload))),
        }
    )
    df = parse_verdict(
        df,
        "payload",
        "format",
        "_verdict",
        same_hop={
            "inline": inline_tables_of(payload, F.col("_fold")),
            "json_stringified_like": any_json(F.col("_strings")),
        },
    )
    ok = F.col("_verdict.ok")
    bad_indent = F.lit(False)
    if yaml_style:
        bad_indent = ok & (fmt == "YAML") & ~yaml_indent_canonical(payload)
    return (
        df.withColumn("_bad_indent", bad_indent)
        .withColumns(
            {
                "usable": ok & ~F.col("_bad_indent"),
                "reason": F.when(F.col("_bad_indent"), "yaml_indent_fail").otherwise(
                    F.col("_verdict.reason")
                ),
                "structure": toml_structure(F.col("_lines")),
                "escapes": escape_entries(fmt, payload, F.col("inline")),
            }
        )
        .drop("_strings", "_lines", "_fold", "_verdict", "_bad_indent")
    )


def audit_members(df: DataFrame) -> DataFrame:
    """Classified members of rows of ``dataset, split, dataset_pos, i, record``.

    A report on some formats or tasks filters here, before anything is parsed.
    """
    return record_infos(df).withColumn("pos", member_order(F.col("i"), F.col("j")))


def audit_records(df: DataFrame, yaml_style: bool = True) -> DataFrame:
    """Classified and measured members of raw records.

    Several reports read the result: write it (or ``checkpoint()`` it) once and build
    them from that.
    """
    return measure_records(audit_members(df), yaml_style)
