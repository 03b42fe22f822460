import json

import pytest
from pyspark.sql import functions as F

from sftq.operators.select import (
    filter_counts,
    format_thresholds,
    keep_filter,
    limit_global,
    limit_per_dataset,
    score_and_format,
)
from sftq.sources.jsonl import parse_records


def scored(spark, *objects):
    rows = [(i, json.dumps(x)) for i, x in enumerate(objects)]
    return score_and_format(parse_records(spark.createDataFrame(rows, "id int, raw string")))


def evaluated(fmt, usable, score):
    return {"output_format": fmt, "evaluation": {"usable": usable, "llm": {"score": score}}}


def test_filter(spark):
    df = scored(
        spark,
        evaluated("json", True, 90),
        evaluated(" Json ", "false", "95"),
        evaluated("json", True, 89.9),
        evaluated("yml", True, "bad"),
        evaluated("C_JSON", 1, None),
        evaluated("xml", False, 100),
        {"output_format": "csv", "evaluation": {"usable": True, "llm": [1]}},
        {"output_format": "csv", "evaluation": None},
        {},
    )
    kept = lambda *a, **k: sorted(r.id for r in keep_filter(df, *a, **k).collect())
    assert kept() == [0, 1, 3, 4]
    assert kept({"xml": 100}, require_usable_flag=False) == list(range(9))
    assert kept({"json": 95}) == [1, 3, 4, 6]


def test_thresholds():
    assert format_thresholds() == dict.fromkeys(("JSON", "YAML", "TOML", "XML", "CSV"), 90)
    assert format_thresholds({" csv": "80"}) == {"CSV": 80}


PATHS = ["a-b/x", "a/b", "a/c/d", "a", "a.b"]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(p, i * 3 + len(p)) for p in PATHS for i in range(50)]
    return spark.createDataFrame(rows, "rel_path string, line_no bigint").repartition(5)


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 137, 250, 400, 100_001])
def test_limit_global(lines, n):
    got = {tuple(r) for r in limit_global(lines, n, chunk=F.floor(F.col("line_no") / 7)).collect()}
    rows = sorted((tuple(r) for r in lines.collect()), key=lambda r: (r[0].split("/"), r[1]))
    assert got == set(rows[:n] if n else rows)


@pytest.mark.parametrize("n", [0, 1, 8, 50, 99, 1000])
def test_limit_per_dataset(lines, n):
    df = lines.select(F.when(F.col("rel_path") != "a", F.col("rel_path")).alias("dataset"), F.col("line_no").alias("i"))
    got = sorted((tuple(r) for r in limit_per_dataset(df, n, chunk=F.floor(F.col("i") / 7)).collect()), key=repr)
    groups = {}
    for r in sorted((tuple(r) for r in df.collect()), key=lambda r: r[1]):
        groups.setdefault(r[0], []).append(r)
    assert got == sorted((r for g in groups.values() for r in (g[:n] if n else g)), key=repr)


def test_limits_gather_no_rows(lines):
    """Rows meet one position a group: no sort, top-k or window over whole rows."""
    wide = lines.withColumn("raw", F.repeat(F.lit("x"), 100))
    for df in (limit_global(wide, 5), limit_per_dataset(wide, 5, dataset="rel_path", row="line_no")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Limit" not in plan
        assert all("raw" not in x for x in plan.splitlines() if "Window" in x or "Aggregate" in x or "Sort" in x)


def test_counts(spark, lines):
    got = {r.rel_path: (r.processed, r.kept) for r in filter_counts(lines, F.col("line_no") < 30).collect()}
    assert got[None] == (250, sum(k for p, (_, k) in got.items() if p))
    assert got["a"] == (50, 10)
