import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sftq.operators.select import limit_global
from sftq.plans.run import filter_files, score_files
from sftq.sources.jsonl import parse_records, scan_records
from sftq.sources.sinks import read_scored, with_evaluation, write_scored, write_scored_folders, write_summary

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_scan(spark, tmp_path):
    for name, text in {
        "a/b.jsonl": '{"n": 1}\n\n  \n {"n": 2} \r\n{"n": 3}',
        "a-b/x y+é.jsonl": '{"n": 4}\n',
        "a/skip.json": "not json",
        "z.jsonl": "",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")
    df = scan_records(spark, str(tmp_path))
    rows = df.select("rel_path", F.variant_get("record", "$.n", "int").alias("n"), "raw").collect()
    assert sorted((r.rel_path, r.n) for r in rows) == [
        ("a-b/x y+é.jsonl", 4), ("a/b.jsonl", 1), ("a/b.jsonl", 2), ("a/b.jsonl", 3),
    ]
    assert {r.raw for r in rows} >= {'{"n": 2}'}
    for n in (1, 2, 4, 9, 200_000):
        first = limit_global(df, n, line=("block_start", "line_no"), chunk=F.col("block_start"))
        found = first.select(F.variant_get("record", "$.n", "int").alias("n"))
        assert sorted(r.n for r in found.collect()) == list(range(1, min(n, 4) + 1))


def test_order_survives_file_splits(spark, tmp_path):
    (tmp_path / "big.jsonl").write_text("".join(f'{{"n": {i}}}\n' for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = scan_records(spark, str(tmp_path))
        assert df.select("block_start").distinct().count() > 3
        first = limit_global(df, 1234, line=("block_start", "line_no"), chunk=F.col("block_start"))
        numbers = [r.n for r in first.select(F.variant_get("record", "$.n", "int").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(numbers) == list(range(1234))


def test_evaluation_member(spark, tmp_path):
    raws = ['{"a": 1.0, "b": "é"}', "{}", ' {"evaluation": {"old": 1}, "z": 2 } ', '{"a": {"evaluation": 1} }']
    df = spark.createDataFrame([(r, f"d/{i % 2}.jsonl") for i, r in enumerate(raws)], "raw string, rel_path string")
    value = F.struct(F.lit("ü").alias("x"), F.lit(None).cast("int").alias("y"))
    path = str(tmp_path / "out")
    write_scored(df.select("rel_path", with_evaluation(F.col("raw"), value).alias("line")), path)
    back = read_scored(spark, path).collect()
    assert {r.rel_path for r in back} == {"d/0.jsonl", "d/1.jsonl"}
    want = [{**json.loads(r), "evaluation": {"x": "ü", "y": None}} for r in raws]
    assert sorted(map(json.dumps, (json.loads(r.raw) for r in back))) == sorted(map(json.dumps, want))
    assert any(r.raw.startswith('{"a": 1.0, "b": "é", "evaluation"') for r in back)
    assert parse_records(read_scored(spark, path)).count() == 4


def test_summary(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"x', {"r": 1})], "k string, v string, m map<string,int>")
    write_summary(df, str(tmp_path / "s"), ["v", "k", "m"])
    text = "".join(f.read_text() for f in (tmp_path / "s" / "csv").glob("*.csv"))
    assert 'v,k,m\n"q""x","a,b","{""r"":1}"\n' in text
    assert spark.read.json(str(tmp_path / "s" / "json")).first().m.r == 1


def test_roots_give_right_paths_or_raise(spark, tmp_path, monkeypatch):
    (tmp_path / "p" / "q").mkdir(parents=True)
    (tmp_path / "p" / "q" / "a.jsonl").write_text('{"n": 1}\n')
    monkeypatch.chdir(tmp_path)
    for root in (f"{tmp_path}/p", f"{tmp_path}/p/", f"{tmp_path}/p/../p", f"file://{tmp_path}/p"):
        assert [r.rel_path for r in scan_records(spark, root).collect()] == ["q/a.jsonl"]
    with pytest.raises(ValueError):
        scan_records(spark, f"{tmp_path}/*")


def judged_by(prompts):
    reply = json.dumps({"usable": True, "score": 90, "rationale_en": "ok"})
    return [{"ok": True, "text": reply, "error": None, "raw": {"model": "m", "eval_count": 3}} for _ in prompts]


def make_judge():
    return judged_by


def test_scored_files_keep_order_and_shape(spark, tmp_path):
    (tmp_path / "in" / "d").mkdir(parents=True)
    for shard in range(3):
        said = lambda i: [{"role": "user", "content": "p"}, {"role": "assistant", "content": '{"a": 1}' if i % 4 else "{"}]
        lines = [{"n": i, "messages": said(i), "output_format": "JSON"} for i in range(100)]
        (tmp_path / "in" / "d" / f"{shard}.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    counts = score_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), make_judge, "stub", partitions=8)
    assert counts == {"processed": 300, "asked": 1}  # equal prompts are one
    files = sorted(p for p in (tmp_path / "out").rglob("*") if p.is_file() and "_replies" not in p.parts and p.suffix != ".crc")
    assert [str(f.relative_to(tmp_path / "out")) for f in files] == [f"d/{i}.jsonl" for i in range(3)]
    for file in files:
        records = [json.loads(x) for x in file.read_text(encoding="utf-8").splitlines()]
        assert [r["n"] for r in records] == list(range(100))
        for r in records:
            llm = r["evaluation"]["llm"]
            if r["n"] % 4:
                assert llm["meta"] == {"model": "m", "eval_count": 3} and llm["error"] is None
            else:
                assert "meta" not in llm and llm["error"]
    kept = filter_files(spark, str(tmp_path / "out"), str(tmp_path / "kept"), {"json": 80})
    assert kept == {"processed": 300, "kept": 225}
    # The same rows from a folder for each shard.
    write_scored_folders(read_scored(spark, str(tmp_path / "out")), str(tmp_path / "folders"), line="raw", order=("block_start", "line_no"))
    assert filter_files(spark, str(tmp_path / "folders"), str(tmp_path / "kept2"), {"json": 80}) == kept
    for shard in range(3):
        lines = [(tmp_path / name / "d" / f"{shard}.jsonl").read_text() for name in ("kept", "kept2")]
        assert lines[0] == lines[1] and len(lines[0].splitlines()) == 75
