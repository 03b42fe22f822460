"""Secret scans: spans against plain regular expressions, and what a ledger saves."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sftq.llm import ledger

SCHEMA = "doc_id long, text string"
KEYS = ("password", "Passwd", "SECRET", "token", "api_key", "apikey")


def brute(text):
    """Spans by the standard library, and how many of each base kind."""
    found = []
    for no, rule in enumerate(ledger.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), no, f"{rule.kind}:{m.start()}:{m.end()}"))
    found.sort()
    base = ",".join(s for _, no, s in found if no < len(ledger.BASE))
    counts = [sum(no == k for _, no, _ in found) for k in range(len(ledger.BASE))]
    return (*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(s for *_, s in found))


def random_text(rng):
    value = lambda n: "".join(rng.choice("abcdef0123456789") for _ in range(n))
    parts = [
        lambda: rng.choice(KEYS) + rng.choice(["", '"', "'"]) + " " * rng.randrange(3) + rng.choice(":=") + " " * rng.randrange(2) + rng.choice(["", '"']) + value(rng.randrange(9)),
        lambda: rng.choice(KEYS) + "=" + rng.choice(KEYS) + rng.choice([":", "=", "-"]) + value(rng.randrange(4, 9)),
        lambda: "AKIA" * rng.randrange(1, 3) + "".join(rng.choice("ABC123") for _ in range(rng.randrange(20))),
        lambda: value(rng.randrange(20, 50)),
        lambda: "ghp_" + value(rng.randrange(30, 45)),
        lambda: "xoxb-" + value(rng.randrange(5, 20)),
        lambda: f"https://us{rng.randrange(9)}:p{value(3)}@host/",
        lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + value(20) + "\n-----END RSA PRIVATE KEY-----",
        lambda: rng.choice(["é", "😀", "ſecret=abcdefgh", "toKen=abcdefgh", " ", "\n", "中文"]),
    ]
    return rng.choice(["", " ", "\n"]).join(rng.choice(parts)() for _ in range(rng.randrange(12)))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_spans_equal_plain_search(spark):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(400)] + [None, "", "token = \"" + "ab" * 30 + "\" " * 3000]
    texts += ["é" * 200_000 + " secret=abcdefghij", "passwd=abcdef " * 4000, "AKIA" * 20_000, "token token= " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(5)
    got = {r[0]: r[1:] for r in rows(ledger.digest(docs))}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert sum(r[0] for r in got.values()) > 4000


def scans(spark, folder):
    return spark.read.parquet(f"{folder}/scanned")


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    folder, n = str(tmp_path), len(ledger.RULES)
    first = [(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, None), (4, "clean")]
    docs = spark.createDataFrame(first, SCHEMA)
    want = rows(ledger.digest(docs, folder))
    assert scans(spark, folder).count() == 3 * n
    assert rows(ledger.digest(docs, folder)) == want
    assert scans(spark, folder).count() == 3 * n
    more = spark.createDataFrame([*first, (5, "a new token=zyxwvuts"), (6, "clean")], SCHEMA)
    assert len(rows(ledger.digest(more, folder))) == 6
    assert scans(spark, folder).count() == 4 * n
    raised = tuple(r._replace(version=2, least=9) if r.kind == "assign" else r for r in ledger.RULES)
    out = ledger.scan(more, folder, raised).collect()
    assert scans(spark, folder).count() == 4 * n + 4
    assert all(not r.findings for r in out)
    assert sum(len(r.findings) for r in ledger.scan(more, folder).collect()) == 3


def test_a_scan_that_died_before_its_pairs_is_repeated(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([(1, "token=abcdefgh " + "0a" * 20)], SCHEMA)
    want = rows(ledger.digest(docs, folder))
    again = str(tmp_path / "again")
    spark.read.parquet(f"{folder}/findings").write.parquet(f"{again}/findings")
    assert rows(ledger.digest(docs, again)) == want


def test_rows_columns_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "token=abcdefgh", "x", 7, 3), (1, "token=abcdefgh", "x", 7, 3), (None, "token=abcdefgh", None, 8, 4), (None, None, None, None, None)],
        "doc_id long, text string, `row` string, `kinds` int, `findings` int",
    ).withColumn("key", F.lit(1)).withColumn("a.b", F.lit(2))
    out = ledger.scan(docs, str(tmp_path / "a"))
    assert out.columns == ["doc_id", "row", "kinds", "key", "a.b", "blob", "findings"]
    assert sorted(len(r.findings) for r in out.collect()) == [0, 1, 1, 1]
    empty = spark.createDataFrame([], SCHEMA)
    assert ledger.digest(empty, str(tmp_path / "b")).collect() == []


@pytest.mark.parametrize("rule", ledger.RULES, ids=lambda r: r.kind)
def test_quick_patterns_miss_nothing(rule):
    rng = random.Random(9)
    for _ in range(2000):
        text = random_text(rng)
        if any(len(m[rule.group]) >= rule.least for m in re.finditer(rule.pattern, text, re.ASCII)):
            assert re.search(rule.quick, text, re.ASCII)
