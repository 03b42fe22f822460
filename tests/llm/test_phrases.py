"""Collocations against plain counting, and the filters' exactness."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sftq.llm import phrases
from sftq.llm.phrases import Counted, Packing

SCHEMA = "lang string, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=10, top=2000):
    counts, size = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        rows, hidden = [], set()
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            rows.append((phrase, a, f[phrase[:k]], f[phrase[k:]], score))
            if len(phrase) == 3:
                hidden |= {p for p in (phrase[:2], phrase[1:]) if 100 * a >= 50 * f[p]}
        rows = [(-s, -a, " ".join(p).encode(), l, r) for p, a, l, r, s in rows if p not in hidden]
        out += [(lang, i + 1, p.decode(), -a, l, r, size[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def random_docs(rng, n, words):
    pool = [rng.choice(["a", "B", "é", "中文", "\x00x", "\xa0", "w"]) + str(k) for k in range(words)]
    text = lambda: "".join(rng.choice(pool) + rng.choice(["  ", " ", " ", "\t", " ", ". ", "\n", "\r"]) for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "de", None, ""]), rng.choice([text(), text(), text(), None, ""])) for _ in range(n)]


@pytest.mark.parametrize(("seed", "words", "top"), [(1, 6, 2000), (2, 25, 15)])
def test_equals_plain_counting(spark, seed, words, top):
    rng = random.Random(seed)
    docs = random_docs(rng, 400, words) + [("en", "one two three. " * 40)] * 3 + [("fr", "la la la la la la la la la la la la")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    assert got(phrases.mine(df, top=top)) == brute(docs, top=top)


def test_long_text_and_hot_phrase(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(300)}" for _ in range(700_000)]
    long = " ".join(words[k] if k % 3 else "hot pair" for k in range(len(words)))
    docs = [("en", long), ("en", "hot pair " * 50_000), ("en", "hot pair")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert got(phrases.mine(df)) == brute(docs)


def test_empty_table_and_other_columns(spark):
    for empty in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([("en", None), (None, " . ")], SCHEMA)):
        assert phrases.mine(empty).collect() == []
    docs = [("en", "x y")] * 12
    df = spark.createDataFrame([(*d, "q", 5) for d in docs], SCHEMA + ", word string, block int")
    assert got(phrases.mine(df)) == brute(docs) == [("en", 1, "x y", 12, 12, 12, 24, 10**6)]


@pytest.mark.parametrize("bits", [3, 4, 17, 21, 22, 31])
def test_packing_and_permutation_can_be_undone(bits):
    how, rng = Packing(bits, 64), np.random.default_rng(bits)
    words = rng.integers(0, 1 << bits, (5000, 3)).astype(np.int32)
    high, low = phrases.pack(words, how)
    assert len(set(zip(high.tolist(), low.tolist()))) == len(set(map(tuple, words.tolist())))
    mixed = phrases.permute(high, low, how.half)
    assert max(int(x.max()) for x in mixed) < 1 << how.half
    assert (phrases.unpack(*phrases.permute(*mixed, how.half, back=True), how) == words).all()


@pytest.mark.parametrize(("bits", "segments"), [(3, 64), (14, 64), (20, 256), (31, 4096)])
def test_filters_lose_nothing(bits, segments):
    how, rng = Packing(bits, segments), np.random.default_rng(bits)
    for size in (1, 2, 9, 700):
        limit = 1 << how.half
        segment = int(rng.integers(0, min(segments, limit)))
        high = (np.uint64(segment) << np.uint64(how.shift)) | rng.integers(0, 1 << how.shift, size).astype(np.uint64)
        n = np.where(rng.random(size) < 0.3, rng.integers(1, 10**12, size), rng.integers(1, 300, size))
        part = phrases.merged([Counted(high, rng.integers(0, limit, size).astype(np.uint64), n.astype(np.int64))], how.half)
        back = phrases.from_filter(phrases.to_filter(part, how), how)
        assert all((a == b).all() for a, b in zip(part, back))


@pytest.mark.parametrize("half", [3, 40])
def test_merged_runs_add_up(half):
    rng = np.random.default_rng(8)
    want, parts = Counter(), []
    for _ in range(7):
        high, low = (rng.integers(0, 6, 40).astype(np.uint64) for _ in range(2))
        n = rng.integers(1, 9, 40)
        for key in zip(high.tolist(), low.tolist(), n.tolist()):
            want[key[:2]] += key[2]
        parts.append(phrases.merged([Counted(high, low, n)], half))
    out = phrases.merged(parts, half)
    assert dict(zip(zip(out.high.tolist(), out.low.tolist()), out.n.tolist())) == dict(want)


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(6)
    rows = [(a := rng.randrange(10, 10**12), a + rng.randrange(10**10), a + rng.randrange(10**12)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    for r in df.select("*", phrases.exact_score(df.a, df.l, df.r).alias("s")).collect():
        assert r.s == 10**6 * r.a * r.a // (r.l * r.r)
