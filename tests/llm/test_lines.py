"""Line dedup against a plain list of repeated blocks of lines."""

import random

import pytest

from sftq.llm import lines

DOCS = "doc_id long, text string"


def brute(docs):
    """Lines that lie in a block of lines with words that stands earlier, by plain search."""
    first, out = {}, []
    for doc_id, text in docs:
        own = [] if text is None else text.split("\n")
        worded = [i for i, line in enumerate(own) if line.strip(" \t\n\v\f\r")]
        gone = set()
        for a, b in zip(worded, worded[1:]):
            block = tuple(own[a : b + 1])
            if first.setdefault(block, (doc_id, a)) != (doc_id, a):
                gone |= set(range(a, b + 1))
        out.append((doc_id, len(own), len(gone), None if text is None else "\n".join(x for i, x in enumerate(own) if i not in gone)))
    return out


def got(df):
    rows = lines.drop_repeated(df, verdicts=True).select("doc_id", "n_lines", "n_gone", "text").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_repeated_block_goes(spark, seed):
    rng = random.Random(seed)
    fresh = lambda: f"line {rng.randrange(10**9)}"
    texts = []
    for k in (2, 3, 4, 6, 10, 20):
        for _ in range(8):
            block = [rng.choice([fresh(), fresh(), fresh(), "", " "]) if 0 < i < k - 1 else fresh() for i in range(k)]
            for _ in range(rng.randrange(2, 4)):
                texts.append("\n".join([fresh() for _ in range(rng.randrange(5))] + block + [fresh() for _ in range(rng.randrange(5))]))
    few = [str(i) for i in range(4)]
    texts += ["\n".join(rng.choice([*few, "", "\t"]) for _ in range(rng.randrange(12))) for _ in range(60)]
    docs = list(enumerate(texts))
    want = brute(docs)
    assert sum(r[2] for r in want) > 300
    assert got(spark.createDataFrame(docs, DOCS).repartition(6)) == sorted(want)


def test_runs_alternating_and_long_texts(spark):
    texts = ["same\n" * 50, "a\nb\n" * 25, "x\ny\nz\n" * 4000, "one\n\n\ntwo", "zero\none\n\n\ntwo", "one\n\ntwo", "alone", "alone", "\n\n"]
    docs = list(enumerate(texts))
    rows = got(spark.createDataFrame(docs, DOCS))
    assert rows == sorted(brute(docs))
    assert rows[0][3] == "same\n" and rows[1][3] == "a\nb\n" and rows[4][3] == "zero" and rows[5][2] == 0
    assert rows[2][3].split("\n") == ["x", "y", "z", ""]


def test_clashing_names_and_empty_table(spark):
    text = "a line\nanother line"
    df = spark.createDataFrame([(1, text, 5, 6, "r"), (2, text, 7, 8, None)], DOCS + ", k1 int, gone int, `row` string")
    out = sorted(tuple(r) for r in lines.drop_repeated(df).collect())
    assert out == [(1, text, 5, 6, "r"), (2, "", 7, 8, None)]
    assert lines.drop_repeated(df.limit(0)).collect() == []


def test_one_block_in_very_many_documents(spark):
    block = "shared one\nshared two\nshared three"
    docs = [(i, f"own {i}\n{block}\nend {i}") for i in range(4000)]
    rows = got(spark.createDataFrame(docs, DOCS).repartition(12))
    assert rows[0][2] == 0 and {r[2] for r in rows[1:]} == {3}
