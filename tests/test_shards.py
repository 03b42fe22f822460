"""Numbered scans, limits that stop reading, and one file for each shard."""

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sftq.operators.select import limit_global
from sftq.plans.run import filter_files
from sftq.sources import shards
from sftq.sources.jsonl import first_files, first_records, list_shards, scan_records
from sftq.sources.shards import opened
from sftq.sources.sinks import read_scored, write_scored, write_summary


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def tree(folder):
    """Relative path to lines of all files below a folder."""
    found = {}
    for top, _, names in os.walk(folder):
        for name in names:
            path = os.path.join(top, name)
            with open(path, encoding="utf-8", newline="") as f:
                found[os.path.relpath(path, folder)] = f.read()
    return found


def fill(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8", newline="")


def test_lines_are_numbered_from_the_top_of_split_files(spark, tmp_path, small_splits):
    text = "".join(("\n" if i % 7 == 0 else "") + json.dumps({"i": i, "x": "é" * (i % 50)}, ensure_ascii=False) + "\n" for i in range(2000))
    fill(tmp_path, {"d/a.jsonl": text, "d/b.jsonl": text[: len(text) // 3], "c.jsonl": "\n\n{}", "empty.jsonl": ""})
    df = scan_records(spark, str(tmp_path), parse=False)
    rows = df.select("rel_path", "line_no", "raw", "block_start").collect()
    assert len({r.block_start for r in rows if r.rel_path == "d/a.jsonl"}) > 5
    for name in ("d/a.jsonl", "d/b.jsonl", "c.jsonl"):
        with open(tmp_path / name, encoding="utf-8") as f:
            want = [(k, line.strip()) for k, line in enumerate(f, 1) if line.strip()]
        assert sorted((r.line_no, r.raw) for r in rows if r.rel_path == name) == want


def test_malformed_lines_are_named(spark, tmp_path, small_splits):
    lines = ['{"a": 1}'] * 3000
    lines[2500] = '{"a": '
    fill(tmp_path, {"d/x.jsonl": "\n".join(lines), "y.jsonl": "{}\n"})
    with pytest.raises(Exception, match=r'malformed record in d/x.jsonl, line 2501: \{"a":'):
        scan_records(spark, str(tmp_path)).select(F.max(F.col("record").cast("string"))).collect()


def test_limit_reads_only_the_files_it_needs(spark, tmp_path):
    fill(tmp_path, {f"s{i // 10}/{i % 10}.jsonl": "".join(f'{{"n": {i * 20 + k}}}\n\n' for k in range(20)) for i in range(60)})
    fill(tmp_path, {"s0/00 [x].jsonl": "", "s0-a/0.jsonl": '{"n": -1}\n'})
    root = str(tmp_path)
    whole = scan_records(spark, root, parse=False)
    for n, most in ((1, 5), (20, 5), (21, 5), (130, 12), (601, 46), (1201, 62), (9999, 62)):
        files = first_files(spark, root, n)
        assert len(files) <= most, (n, len(files))
        got = first_records(spark, root, n, parse=False)
        assert len(got.inputFiles()) >= 1
        want = limit_global(whole, n, line=("block_start", "line_no"), chunk=F.col("block_start"))
        columns = ["rel_path", "line_no", "raw"]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    read = first_records(spark, root, 25, parse=False).select("rel_path").distinct().count()
    assert read == 2
    assert first_records(spark, root, 0).count() == 1201


def test_one_file_for_each_shard_at_its_path(spark, tmp_path):
    out, rows = tmp_path / "out", []
    want = {}
    for shard, n in (("d/a b.jsonl", 500), ("d/é+%20.jsonl", 3), ("e/f/g.jsonl", 1)):
        lines = [json.dumps({"i": i, "s": shard, "t": "line break"}, ensure_ascii=False) for i in range(n)]
        want[shard] = "".join(f"{x}\n" for x in lines)
        rows += [(shard, i // 40, i, x) for i, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "rel_path string, block long, i int, line string").repartition(7)
    shards = spark.createDataFrame([("empty.jsonl",), ("d/a b.jsonl",), ("z/none.jsonl",)], "rel_path string")
    want |= {"empty.jsonl": "", "z/none.jsonl": ""}
    fill(out, {"empty.jsonl": "old", "kept.jsonl": "kept\n"})
    write_scored(df, str(out), order=["i"], chunk=F.col("block"), shards=shards)
    assert tree(out) == want | {"kept.jsonl": "kept\n"}
    write_scored(df.where("i < 2"), f"file:{out}", order=["i"])
    assert tree(out)["d/a b.jsonl"] == "".join(f"{r[3]}\n" for r in rows[:2])
    empty = df.where("i < 0")
    write_scored(empty, str(tmp_path / "none"), shards=shards)
    assert tree(tmp_path / "none") == {"empty.jsonl": "", "z/none.jsonl": "", "d/a b.jsonl": ""}


@pytest.mark.parametrize("order", [[], ["i"]])
def test_one_large_shard_is_written_by_many_tasks(spark, tmp_path, monkeypatch, order):
    kept, here = [], os.getpid()
    left = SimpleNamespace(delete_dir=kept.append)  # leaves the staging folder, which lists what tasks have written
    small = [f"spark.sql.adaptive.{c}" for c in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")]
    for name in small:
        spark.conf.set(name, "64k")
    monkeypatch.setattr(shards, "opened", lambda path: (left, path) if os.getpid() == here else opened(path))
    try:
        line = F.concat_ws(" ", F.lpad("id", 5, "0"), F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
        df = spark.range(8000, 0, -1, 8).select(F.lit("a.jsonl").alias("rel_path"), F.when(F.col("id") > 9, F.col("id")).alias("i"), line.alias("line"))
        df = df.unionByName(spark.createDataFrame([("b.jsonl", 1, "one")], df.schema))
        write_scored(df, str(tmp_path), order=order)
    finally:
        for name in small:
            spark.conf.unset(name)
    parts = spark.read.parquet(f"{kept[-1]}/parts.parquet").where("shard = 'a.jsonl'").select("file").collect()
    assert len(parts) >= 4
    sizes = [(tmp_path / kept[-1] / x.file).stat().st_size for x in parts]
    assert max(sizes) < sum(sizes) / 3
    lines = (tmp_path / "a.jsonl").read_text().splitlines()
    want = [r.line for r in df.where("rel_path = 'a.jsonl'").collect()]
    assert (tmp_path / "b.jsonl").read_text() == "one\n" and sorted(lines) == sorted(want)
    if order:
        assert sorted(lines[:9]) == sorted(want)[:9] and lines[9:] == sorted(want)[9:]  # nulls first


def test_paths_outside_the_folder_are_refused(spark, tmp_path):
    for name in ("../x", "/x", "a/../../x", ""):
        with pytest.raises(Exception, match="not a path below"):
            write_scored(spark.createDataFrame([(name, "x")], "rel_path string, line string"), str(tmp_path / "o"))
    assert not (tmp_path / "x").exists()


def test_a_failed_write_leaves_no_files(spark, tmp_path):
    df = spark.range(100).select(F.lit("a.jsonl").alias("rel_path"), F.when(F.col("id") == 70, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).alias("line"))
    with pytest.raises(Exception, match="broken"):
        write_scored(df, str(tmp_path / "o"))
    assert tree(tmp_path) == {}


def test_filter_keeps_the_tree(spark, tmp_path):
    line = lambda score: json.dumps({"output_format": "json", "evaluation": {"usable": True, "llm": {"score": score}}})
    fill(tmp_path / "in", {"a/x.jsonl": line(95) + "\n" + line(10) + "\n", "a/y.jsonl": line(1) + "\n", "z.jsonl": ""})
    counts = filter_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert counts == {"processed": 3, "kept": 1}
    assert tree(tmp_path / "out") == {"a/x.jsonl": line(95) + "\n", "a/y.jsonl": "", "z.jsonl": ""}
    assert read_scored(spark, str(tmp_path / "out")).count() == 1
    assert list_shards(spark, str(tmp_path / "out")).count() == 3


def test_summary_is_computed_once(spark, tmp_path):
    df = spark.range(500).select("id", F.rand().alias("x"), F.array(F.lit(None).cast("int"), F.lit(2)).alias("l"), F.lit(None).cast("string").alias("none"))
    write_summary(df, str(tmp_path / "s"), ["x", "id", "l", "none"], null_text="N/A")
    read = lambda kind: spark.read.options(header=True).format(kind).load(str(tmp_path / "s" / kind))
    of = lambda rows: {int(r["id"]): float(r["x"]) for r in rows.collect()}
    assert of(read("csv")) == of(read("json")) and len(of(read("csv"))) == 500
    assert read("csv").first()["none"] == "N/A" and json.loads(read("csv").select(F.regexp_replace("l", r"\\", "").alias("l")).first()["l"]) == [None, 2]


def test_paths_open(tmp_path):
    for path in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert opened(path)[1] == str(tmp_path)
