"""The pipeline's stages, each against a plain recomputation of its own input."""

import random
from collections import Counter

import duckdb
import pytest
from test_pairs import brute_groups
from test_texts import goals

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from sftq.llm import lines, quality, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark):
    rng = random.Random(11)
    words = ["w%d" % i for i in range(300)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage = "\n".join(say(12) for _ in range(8))
    texts = ["\n".join(say(15) for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    texts += [t + "\n" + passage for t in texts[:10]] + [texts[3]] * 5 + [texts[4] + " end"] * 2
    texts += ["short", "", None, "again and again " * 30, say(4000)]
    rows = [(i, t, "en", ["a", "a", "a", "b", None][i % 5], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, texts[5], None, "b", None)], DOCS)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs, out = made(spark), []
    docs.write.parquet(f"{root}/documents.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(root)).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((docs, after))
        docs = after
    return str(root), out


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


def test_columns_stay(steps):
    for before, after in steps[1][:-1]:
        assert after.dtypes == before.dtypes


def test_quality_keeps_what_passes(steps):
    before, after = steps[1][0]
    good = Counter()
    for row, n in rows_of(before).items():
        count, _, _, _, repeated = quality.measure((row[1] or "").encode())
        if count >= 20 and 100 * repeated <= 30 * count:
            good[row] += n
    assert rows_of(after) == good


def test_lines_go_as_the_sql_says(steps):
    before, after = steps[1][1]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows_of(before).elements()])
    want = Counter((r[0], r[3]) for r in con.execute(lines.ORACLE).fetchall())
    got = Counter((r[0], r[1]) for r in after.selectExpr("doc_id", "md5(cast(text as binary))").collect())
    assert got == want and after.where("n_chars <> length(text)").count() == 0
    assert sum(len(r[1]) for r in rows_of(after)) < sum(len(r[1]) for r in rows_of(before))


def test_one_of_each_group_stays(steps):
    before, after = steps[1][2]
    last = 10**9  # a null identifier names a group only if nothing else does
    number = lambda r: last if r[0] is None else r[0]
    prints = {number(r): simhash.fingerprint((r[1] or "").encode(), 3) for r in rows_of(before)}
    assert Counter(map(number, rows_of(after).elements())) == Counter(set(brute_groups(prints, 3).values()))


def test_mix_meets_targets(steps):
    before, after = steps[1][3]
    assert set(rows_of(after)) <= set(rows_of(before))
    assert all(n <= 2 * rows_of(before)[row] for row, n in rows_of(after).items())
    size = lambda df: Counter({s: sum(len((r[1] or "").split()) for r in rows_of(df).elements() if r[3] == s) for s in ("a", "b", None)})
    want, got = goals(size(before)), size(after)
    assert all(abs(got[s] - want[s]) <= 0.02 * want[s] + 40 for s in want)


def test_packing_holds_the_mix(steps):
    before, after = steps[1][4]
    pieces = after.collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r[0] for r in rows_of(before).elements())
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_run_and_registration(spark, steps):
    root, out = steps
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, root).select(columns).collect())
    assert got == Counter(tuple(r) for r in out[-1][1].select(columns).collect())
    names = [n for n in queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14
    assert set(oracle_sql()) & set(names) == {
        "op1_nearest_neighbours", "op2_url_filters", "op5_line_dedup",
        "op11_secret_scans", "op12_phrase_collocations", "op13_source_divergence",
    }


def test_nothing_in_nothing_out(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
