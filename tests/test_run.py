"""The whole jobs on a few files."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from sftq.plans.run import audit_datasets, filter_files, score_files
from sftq.sources.jsonl import parse_records
from sftq.sources.sinks import read_scored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def make_scorer():
    return lambda prompts: [
        {"ok": True, "text": json.dumps({"usable": "bad" not in p, "score": 85}), "raw": {}} for p in prompts
    ]


def test_score_then_filter(spark, tmp_path):
    def chat(label, prompt, answer):
        turns = [{"role": "user", "content": prompt}, {"role": "assistant", "content": answer}]
        return json.dumps({"id": 1.0, "output_format": label, "messages": turns})

    source = tmp_path / "in" / "d"
    source.mkdir(parents=True)
    (source / "a.jsonl").write_text("\n".join([chat("json", "q", "{}"), chat("json", "q", "{"), ""]))
    (source / "b.jsonl").write_text(chat("csv", "bad", "a,b"))
    scored, kept = str(tmp_path / "scored"), str(tmp_path / "kept")
    score_files(spark, str(tmp_path / "in"), scored, make_scorer, "m", partitions=2)
    rows = [(r.rel_path, json.loads(r.raw)) for r in read_scored(spark, scored).collect()]
    assert sorted((p, x["evaluation"]["usable"], x["evaluation"]["llm"]["score"]) for p, x in rows) == [
        ("d/a.jsonl", False, 0), ("d/a.jsonl", True, 85), ("d/b.jsonl", False, 85),
    ]
    assert filter_files(spark, scored, kept, {"json": 80}) == {"processed": 3, "kept": 1}
    assert json.loads(read_scored(spark, kept).first().raw)["messages"][1]["content"] == "{}"
    first = str(tmp_path / "first")
    score_files(spark, str(tmp_path / "in"), first, make_scorer, "m", max_records=1)
    assert read_scored(spark, first).count() == 1


def test_audit(spark, tmp_path):
    def plain(fmt, text):
        return json.dumps({"metadata": {"format": fmt}, "messages": [{"role": "assistant", "content": text}]})

    rows = [
        ("d0", "train", 0, 0, plain("toml", "k = { a = 1 }")),
        ("d0", "train", 0, 1, plain("json", "{")),
        ("d0", "train", 0, 2, plain("json", "{}")),
        ("d0", "train", 0, 3, plain("json", "[]")),
    ]
    df = spark.createDataFrame(rows, "dataset string, split string, dataset_pos int, i bigint, raw string")
    out = str(tmp_path / "audit")
    audit_datasets(parse_records(df), out, max_rows=3, save_errors=True)
    read = lambda name: spark.read.option("header", True).csv(f"{out}/{name}/csv")
    assert {(r.task_key, r.total, r.errors) for r in read("summary_task_stats").collect()} == {
        ("u10bei|TOML|unknown|unknown", "1", "0"), ("u10bei|JSON|unknown|unknown", "2", "1"),
    }
    assert read("summary_task_errors").count() == 1
    assert read("summary_toml_structure_stats").first().avg_table_headers == "0.0"
    assert read("summary_escape_stats").where("escape_type = 'toml_inline_table'").first().occurrences_total == "1"
    tasks = spark.read.json(f"{out}/tasks")
    assert tasks.groupBy("status").agg(F.count("*")).count() == 2
    assert spark.read.json(f"{out}/toml_inline_table_examples").first().payload_excerpt == "k = { a = 1 }"
