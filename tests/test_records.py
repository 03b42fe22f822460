import json

import pytest
from pyspark.sql import functions as F

from sftq.functions.loose import int_or_null, text_or_empty, truth
from sftq.operators.records import (
    detect_family,
    detect_family_audit,
    explode_bundles,
    extract_pair,
    infer_format_from_category,
    last_role_content,
    record_infos,
)
from sftq.sources.jsonl import parse_records


def records(spark, *objects):
    rows = [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(objects)]
    return parse_records(spark.createDataFrame(rows, "i bigint, raw string"))


def said(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


def test_families(spark):
    df = records(
        spark,
        {"metadata": {"prompt": None, "output": 1}, "messages": None},
        {"metadata": {"prompt": "p"}, "messages": []},
        {"metadata": [{"prompt": 1, "output": 2}], "messages": "x"},
        {"category": 1, "subcategory": None, "messages": None},
        {"messages": said(("user", "x"))},
        {},
    )
    got = df.select(detect_family(F.col("record")), detect_family_audit(F.col("record"))).collect()
    assert [tuple(r) for r in got] == [
        ("u10bei", "u10bei"),
        ("daichira", "u10bei"),
        ("unknown", "u10bei"),
        ("unknown", "daichira"),
        ("daichira", "unknown"),
        ("unknown", "unknown"),
    ]


def test_pairs(spark):
    df = records(
        spark,
        {"metadata": {"prompt": 5, "output": ""}, "output_format": "json"},
        {"messages": said(("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", None)), "output_format": None},
        {"messages": [1, "x", {"role": "assistant", "content": False}, {"role": "user", "content": True}]},
        {"x": 1, "output_format": "XML"},
    )
    got = extract_pair(df).orderBy("i").select("family", "prompt", "output", "output_format").collect()
    assert [tuple(r) for r in got] == [
        ("u10bei", "5", "", "json"),
        ("daichira", "c", "", ""),
        ("daichira", "True", "", ""),
        ("unknown", "", "", "XML"),
    ]


def test_last_message_wins_even_when_null(spark):
    rows = [([("user", "a"), ("assistant", "b"), ("assistant", None)],), ([],), (None,)]
    df = spark.createDataFrame(rows, "m array<struct<role string, content string>>")
    got = df.select(last_role_content(F.col("m"), "assistant"), last_role_content(F.col("m"), "user")).collect()
    assert [tuple(r) for r in got] == [("", "a"), ("", ""), ("", "")]


@pytest.mark.parametrize(
    ("sub", "cat", "want"),
    [
        ("xml_to_yaml", "C_XML", "YAML"),
        ("a_to_b_to_yml ", "x", "YAML"),
        ("text", "C_TOML", "TOML"),
        (None, None, ""),
        ("_to_", "tsv", "CSV"),
        ("to_json", "c_xml", "XML"),
    ],
)
def test_format_from_category(spark, sub, cat, want):
    df = spark.createDataFrame([(sub, cat)], "s string, c string")
    assert df.select(infer_format_from_category(F.col("s"), F.col("c"))).first()[0] == want


def test_typed_bundles(spark):
    rows = [(1, [("a",), ("b",), ("c",)], [("x",), ("y",)]), (2, [], [("x",)]), (3, None, [("x",)])]
    df = spark.createDataFrame(rows, "id int, metadata array<struct<f string>>, messages array<struct<t string>>")
    got = explode_bundles(df).orderBy("id", "j").collect()
    assert [(r.id, r.j, r.metadata.f, r.messages.t) for r in got] == [(1, 0, "a", "x"), (1, 1, "b", "y")]


def test_record_infos(spark):
    df = records(
        spark,
        {"metadata": [{"format": "yml", "type": " g "}, None, {}], "messages": [said(("assistant", "1")), None]},
        {"metadata": [{"format": "C_JSON", "schema": "s"}], "messages": said(("assistant", "2"))},
        {"metadata": {"format": "csv"}, "messages": [said(("assistant", "3"))]},
        {"metadata": [], "messages": [said(("assistant", "4"))]},
        {"category": "C_XML", "subcategory": " x_to_toml ", "task": "", "messages": said(("assistant", "5"))},
        {"messages": said(("assistant", "6"))},
    )
    got = record_infos(df).orderBy("i", "j").select("idx", "task_key", "assistant_text").collect()
    assert [tuple(r) for r in got] == [
        ("0:0", "u10bei|YAML|g|unknown", "1"),
        ("0:1", "u10bei||unknown|unknown", ""),
        ("1", "u10bei|JSON|unknown|s", "2"),
        ("2", "u10bei|CSV|unknown|unknown", "3"),
        ("4", "daichira|TOML|unknown|x_to_toml", "5"),
        ("5", "unknown|UNKNOWN|unknown|unknown", "6"),
    ]


VALUES = [0, 1, -3, 87.9, -87.9, 1e30, 0.0, True, False, None, "", "false", "87", " 87 ", "+5", "87.5", "1_000", "1__0", "x", [], [0], {}, {"a": 1}, 2**70, "9" * 40, "-" + "9" * 40]


def test_loose_values_match_python(spark):
    def integer(x):
        try:
            return max(min(int(x), 2**63 - 1), 1 - 2**63)
        except (TypeError, ValueError):
            return None

    df = records(spark, *[{"v": v} for v in VALUES]).withColumn("v", F.variant_get("record", "$.v", "variant"))
    v = F.col("v")
    got = df.orderBy("i").select(text_or_empty(v), truth(v), int_or_null(v)).collect()
    for value, (text, true, number) in zip(VALUES, got):
        assert true is bool(value), value
        assert number == integer(value), value
        if isinstance(value, (str, bool, int, type(None))) and abs(value if isinstance(value, int) else 0) < 2**60:
            assert text == str(value or ""), value


def test_record_reader(spark):
    df = records(spark, '{"a": NaN, "b": 1, "b": 2}')
    got = df.select(F.variant_get("record", "$.b", "int"), F.variant_get("record", "$.a", "double")).first()
    assert got[0] == 2 and got[1] != got[1]
    for bad in ('{"a": 1} x', '{"a": 1', '{"a": 1}, {"b": 2}', "x"):
        with pytest.raises(Exception, match="(?i)malformed"):
            records(spark, bad).select(F.variant_get("record", "$.a", "int")).collect()
