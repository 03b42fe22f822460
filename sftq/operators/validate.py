"""Syntax and style verdicts on extracted payloads.

Plain JSON and CSV, quoted fields included, are accepted by built-in expressions. What those do not
accept, and every YAML, TOML and XML payload, goes through one Arrow UDF that asks
the Python parsers for verdict and reason; all other rows hand it a null.
"""

from __future__ import annotations

import csv
import io
import json
import re
import tomllib
import xml.etree.ElementTree as ET
from collections.abc import Mapping

import pyarrow as pa
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftq.functions.formats import FORMATS, norm_format
from sftq.functions.text import extract_payload
from sftq.functions.whitespace import BLANK, unix_lines

VERDICT = T.StructType().add("ok", T.BooleanType()).add("reason", T.StringType())
CSV_FIELD_LIMIT = 131072  # fixed value: Python's csv field size limit


def json_is_plain(payload: Column, digest: Column) -> Column:
    """True only for well-formed JSON; false also for what Spark's parser is stricter on.

    The payload becomes the first of two array items. The second is its own SHA-1
    (``digest``), so trailing text or a second value cannot stand in for it.
    """
    pair = F.try_parse_json(F.concat(F.lit("["), payload, F.lit(',"'), digest, F.lit('"]')))
    return F.coalesce(F.try_variant_get(pair, "$[1]", "string") == digest, F.lit(False))


#: Stands for a quoted piece of a field; texts that hold it themselves go to Python.
QUOTED = "\x01"


def csv_is_plain(payload: Column) -> Column:
    """True only for rows that all have the header's width, their fields bare or quoted as wholes.

    Quoted pieces, with the commas and line breaks in them, become one sign each; a doubled quote
    parts two pieces. What is left has a row on each line. Quotes that open or close within a
    field are not accepted here.
    """
    bare = F.when(payload.contains('"'), F.regexp_replace(payload, '"[^"]*+"', QUOTED)).otherwise(payload)
    commas = F.regexp_replace(bare, r"[^,\n]++", "")
    mixed = bare.rlike(rf"[^,\n{QUOTED}]{QUOTED}|{QUOTED}[^,\n{QUOTED}]")
    return (
        (payload != "")
        & (F.length(payload) <= CSV_FIELD_LIMIT)
        & ~payload.contains(QUOTED)
        & ~payload.contains("\r")
        & ~bare.contains('"')
        & ~bare.contains("\n\n")
        & ~bare.startswith("\n")
        & ~(payload.contains('"') & mixed)
        & (F.size(F.array_distinct(F.split(commas, "\n", -1))) == 1)
    )


def yaml_indent_canonical(text: Column, indent: int = 2) -> Column:
    """No tab in any indent, indents multiples of ``indent``, blocks open by one step."""
    ignorable = rf"{BLANK}*+(?:#|$)"
    tab = r"^ *+\t"
    uneven = rf"^(?: {{{indent}}})*+ {{1,{indent - 1}}}(?! )(?!{ignorable})"
    opener = rf"(?!{BLANK}*+#)(?:{BLANK}*+-.*+|.*:{BLANK}*+)\n"
    skipped = rf"(?:{BLANK}*+(?:#.*+)?\n)*+"
    jump = rf"^( *+){opener}{skipped}\1 {{{indent + 1}}}(?!{ignorable})"
    faults = [tab, uneven, jump] if indent > 1 else [tab, jump]
    return (text != "") & ~unix_lines(text).rlike("(?md)" + "|".join(faults))


def _csv_check(payload: str) -> None:
    rows = csv.reader(io.StringIO(payload))
    header = next(rows, None)
    table = list(rows)  # a reader error anywhere wins over a width mismatch
    if header is None:
        raise ValueError("empty")
    if not header:
        raise ValueError("no header")
    for number, row in enumerate(table, start=2):
        if len(row) != len(header):
            raise ValueError(f"row {number} width mismatch: {len(row)} != {len(header)}")


# Where the C parser of YAML and the Python one, whose verdict counts, might differ:
# tabs, rare line breaks, any token that is not a plain or quoted scalar, deep nesting.
YAML_NOT_SIMPLE = re.compile(
    r"[\t\x85\u2028\u2029\ufeff]|(?:^|\s)[%!&*|>@`\[{?]|^[ -]{100}", re.MULTILINE
)
_FastLoader = getattr(yaml, "CSafeLoader", None)


def _yaml_check(payload: str) -> None:
    """Simple text that the C parser takes is valid; anything else is up to the Python parser."""
    if _FastLoader is not None and not YAML_NOT_SIMPLE.search(payload):
        try:
            yaml.load(payload, Loader=_FastLoader)
            return
        except Exception:  # the Python parser gives verdict and reason
            pass
    yaml.safe_load(payload)


PARSERS = {
    "JSON": json.loads,
    "YAML": _yaml_check,
    "TOML": tomllib.loads,
    "XML": ET.fromstring,
    "CSV": _csv_check,
}


def _parse(fmt: str | None, payload: str | None) -> tuple[bool | None, str | None]:
    if fmt is None or payload is None:
        return None, None
    try:
        PARSERS[fmt](payload)
    except Exception as error:  # the parser's own message is the reason
        return False, f"parse_fail: {error}"
    return True, "ok"


@F.arrow_udf(VERDICT)
def _parser_verdict(fmt: pa.Array, payload: pa.Array) -> pa.Array:
    """``(ok, reason)`` from the Python parser of each row's format; null for null input."""
    verdicts = [_parse(f.as_py(), p.as_py()) for f, p in zip(fmt, payload)]  # one text at a time
    ok, reason = zip(*verdicts) if verdicts else ((), ())
    return pa.StructArray.from_arrays(
        [pa.array(ok, pa.bool_()), pa.array(reason, pa.string())], ["ok", "reason"]
    )


# Non-deterministic to Spark, so that a filter on the verdict does not parse again.
parser_verdict = _parser_verdict.asNondeterministic()


def _verdict(ok: Column, reason: Column) -> Column:
    return F.struct(ok.alias("ok"), reason.alias("reason"))


def parse_verdict(
    df: DataFrame, payload: str, fmt: str, out: str, same_hop: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add ``out STRUCT<ok, reason>``: does ``payload`` parse as the canonical label ``fmt``?

    ``same_hop`` adds further Arrow UDF columns that run with the parsers in one hop.
    """
    p, f, plain, slow = F.col(payload), F.col(fmt), F.col("_plain"), F.col("_slow")
    return (
        df.withColumn("_digest", F.when(f == "JSON", F.sha1(p)))
        .withColumn(
            "_plain",
            F.when(f == "JSON", json_is_plain(p, F.col("_digest")))
            .when(f == "CSV", csv_is_plain(p))
            .otherwise(False),
        )
        .withColumn("_slow", F.when(f.isin(*FORMATS) & ~plain, f))
        .withColumns(
            {"_parsed": parser_verdict(slow, F.when(slow.isNotNull(), p)), **(same_hop or {})}
        )
        .withColumn(
            out,
            F.when(plain, _verdict(F.lit(True), F.lit("ok")))
            .when(slow.isNotNull(), F.col("_parsed"))
            .otherwise(_verdict(F.lit(False), F.concat(F.lit("unknown_format: "), f))),
        )
        .drop("_digest", "_plain", "_slow", "_parsed")
    )


def validate_by_format(
    df: DataFrame,
    text: str = "final_output",
    fmt: str = "output_format",
    out: str = "grammar",
    yaml_style: bool = True,
    payload: str = "payload",
) -> DataFrame:
    """Add ``payload`` and ``out STRUCT<ok, reason, output_format>`` for ``text``."""
    label = F.col("_label")
    df = extract_payload(df.withColumn("_label", norm_format(F.col(fmt))), text, "_label", payload)
    df = parse_verdict(df, payload, "_label", "_verdict")
    ok, reason = F.col("_verdict.ok"), F.col("_verdict.reason")
    if yaml_style:
        indent_ok = F.when(label == "YAML", yaml_indent_canonical(F.col(payload))).otherwise(True)
        df = df.withColumn("_bad_indent", ok & ~indent_ok)
        reason = F.when(F.col("_bad_indent"), "yaml_indent_fail").otherwise(reason)
        ok = ok & ~F.col("_bad_indent")
    return df.withColumn(
        out, F.struct(ok.alias("ok"), reason.alias("reason"), label.alias("output_format"))
    ).drop("_label", "_verdict", "_bad_indent")
