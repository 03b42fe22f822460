"""Source divergence against plain counting, and the packing of terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sftq.llm import divergence

SCHEMA = "lang string, source string, text string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, smooth=5, scale=1_000_000_000, top=50):
    docs = [tuple(x or "" for x in d) for d in docs]
    found = [(lang, source, [t.translate(LOWER) for t in TERM.findall(text)]) for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in docs}:
        seen, counts = Counter(), defaultdict(Counter)
        for own, source, terms in found:
            if own == lang:
                seen.update(set(terms))
                counts[source].update(terms)
        kept = [t for t, n in seen.items() if n >= least]
        every = sum(counts.values(), Counter())
        share = lambda c, of: 1 + scale * (c[of] + smooth) // (sum(c[t] for t in kept) + smooth * len(kept))
        p = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        q = {t: share(every, t) for t in kept}
        for s in counts:
            pairs = [(other, sum(abs(p[s][t] - p[other][t]) for t in kept)) for other in counts if other != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, k + 1) for k, x in enumerate(items[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def random_docs(rng, n, sources, langs=("en", "de", None)):
    pool = ["".join(rng.choice("abcXYZéß中") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 33, 70]))) for _ in range(60)]
    text = lambda: "".join(rng.choice(pool) + rng.choice(" .,@[`{\x7f\x00\n") for _ in range(rng.randrange(40)))
    return [(rng.choice(langs), rng.choice(sources), rng.choice([text(), text(), text(), None, ""])) for _ in range(n)]


@pytest.mark.parametrize(("seed", "chunk", "block"), [(1, 1 << 22, 512), (2, 300, 2), (3, 40, 3)])
def test_equals_plain_counting(spark, seed, chunk, block):
    rng = random.Random(seed)
    docs = random_docs(rng, 250, ["a", "b", "c", "é", "Z", None, "s7"])
    docs += [("xx", "only", "word"), ("yy", "one", "1 2 3"), ("yy", "two", None), ("yy", "three", None)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert got(divergence.audit(df, least_docs=6, chunk=chunk, block=block)) == brute(docs, 6)


def test_long_text_is_one_document(spark):
    rng = random.Random(4)
    long = " ".join(rng.choice(["one", "Two", "three" * 9, "éé"]) for _ in range(3000))
    docs = [("en", "a", long), ("en", "b", "one two"), ("en", "b", "one")]
    df = spark.createDataFrame(docs, SCHEMA)
    counts = {(r.source, r.term): (r.n, r.docs) for r in divergence.term_counts(df, 100).collect()}
    assert counts["a", "one"] == (long.split().count("one"), 1) and counts["b", "one"] == (2, 2)
    assert got(divergence.audit(df, least_docs=2, chunk=100)) == brute(docs, 2)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", term string, n int, value int")
    assert divergence.audit(empty).collect() == []
    docs = [("en", "a", "x"), ("en", "a", "x"), ("en", "b", "y")]
    df = spark.createDataFrame([(*d, "term", 1, 2) for d in docs], SCHEMA + ", term string, n int, rank int")
    assert got(divergence.audit(df, least_docs=1)) == brute(docs, 1)


def test_shares_are_exact_beyond_64_bits(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(10**12), rng.randrange(10**12, 10**14), rng.randrange(10**7)) for _ in range(200)]
    df = spark.createDataFrame(rows, "c long, t long, v long").selectExpr("*")
    for r in df.select("c", "t", "v", divergence.share(df.c, df.t, df.v, 5, 10**9).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.c + 5) // (r.t + 5 * r.v)


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 5, 4000).astype(np.uint64) << np.uint64(60), rng.integers(0, 2**63, 4000).astype(np.uint64) >> np.uint64(50)]
    want = sorted(range(4000), key=lambda i: (words[0][i], words[1][i], i))
    assert divergence.radix_order(words).tolist() == want


def test_slices_cut_between_terms():
    rng = random.Random(2)
    text = " ".join("a" * rng.randrange(1, 40) for _ in range(200)).encode()
    parts = list(divergence.slices_of(text, 25))
    assert b"".join(parts) == text and sum((p.split() for p in parts), []) == text.split()
