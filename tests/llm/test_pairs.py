"""Nearest neighbours, SimHash groups and repeated strings against plain recomputation."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sftq.llm import ann, components, repeats, simhash

DOCS = "doc_id long, text string"


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 8)).astype(np.float32)
    base[100:140] = base[7]  # a hot vector: all ties
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(base)]
    odd = [(500, None, 1), (None, [1.0] * 8, 1), (520, [0.0] * 8, 1), (540, [float("nan")] + [1.0] * 7, 1), (560, [None] + [1.0] * 7, 1), (580, [float("inf")] + [1.0] * 7, 1)]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>, rank int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, k=20).collect())
    want = []
    for q in range(0, 150, 20):
        scores = ann.exact_products(np.repeat(base[q : q + 1], 150, 0).astype(float), base.astype(float))
        best = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != q)[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want


def test_nearest_with_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [1.0])], schema)
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in ann.nearest(two).collect()] == [(0, 1, 0.5)]


def test_tile_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(20, 33)) * 1e3, rng.normal(size=(30, 33)) * 1e-3
    ca, sa, la, ra = ann.quantised(a)
    cb, sb, lb, rb = ann.quantised(b)
    near = ann.tile_products(ca, cb) * sa[:, None] * sb
    error = ra[:, None] * lb + np.linalg.norm(a, axis=1)[:, None] * rb
    assert (np.abs(near - a @ b.T) <= error * (1 + 1e-9)).all()


def brute_groups(prints, radius):
    parent = {i: i for i in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in prints}


def test_simhash_groups(spark):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    texts += [t + " tail" for t in texts[:15]] + [texts[3]] * 10 + ["", None, "  \n", "one two", "ONE two"]
    df = spark.createDataFrame(list(enumerate(texts, 5)), DOCS)
    prints = {i: simhash.fingerprint((t or "").encode(), 3) for i, t in enumerate(texts, 5)}
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.clusters(df).collect()}
    groups = brute_groups(prints, 3)
    assert got == {i: (prints[i], groups[i]) for i in prints}
    kept = [r["doc_id"] for r in simhash.keep_one(df).collect()]
    assert sorted(kept) == sorted(set(groups.values()))


def test_simhash_bits_are_majorities():
    import xxhash

    text = "A b\tc d  e b c D"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text.encode(), 3) == want


def test_simhash_null_and_repeated_ids(spark):
    rows = [(None, "a b c d", 1), (None, "a b c d", 2), (4, "q r s t u", 3), (4, "q r s t u", 4), (9, "q r s t u", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4]
    assert simhash.clusters(spark.createDataFrame([], DOCS)).count() == 0


def test_tile_links_are_a_forest():
    x = np.array([0, 1, 3, 7, 3 << 40, (3 << 40) + 1], np.uint64)
    v, u = simhash.tile_links(x, None, 1)
    assert len(v) == 4 and (u < v).all()


def test_components_of_path_star_and_ring(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)]
    ring = [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    rows = components.components(spark.createDataFrame(path + star + ring + [(77777, 77777)], "v long, u long")).collect()
    roots = dict((r["v"], r["root"]) for r in rows)
    assert len(rows) == len(roots) == 41 + 59 + 9
    assert all(root == (100 if 100 <= v < 200 else 1 if v < 100 else 300) for v, root in roots.items())
    assert components.components(spark.createDataFrame([], "v long, u long")).count() == 0


@pytest.mark.parametrize("width,anchor", [(400, 256), (40, 16)])
def test_repeats_equal_brute_force(spark, width, anchor):
    rng = random.Random(width)
    letters = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passage, other = letters(900), letters(500)
    texts = [letters(300) + passage[rng.randrange(200) : 500 + rng.randrange(300)] + letters(rng.randrange(80)) for _ in range(12)]
    texts += [other * 3, passage, passage, "a" * (width - 1), "b" * width, "x" + "b" * width, "ab" * width, "", None, letters(width)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, k1 string")
    out = repeats.remove_repeats(df, width, anchor)
    assert out.columns == ["doc_id", "text", "k1", "repeat_cut"]
    got = {}
    for r in out.collect():
        cut = r["repeat_cut"]
        got[r["doc_id"]] = (cut["n_bytes"], cut["n_removed"], cut["n_spans"], hashlib.sha256(bytes(cut["kept"])).hexdigest())
    want = brute_repeats([(t or "").encode() for t in texts], width)
    assert got == dict(enumerate(want))


def test_repeats_of_runs_mixed_in_one_task(spark):
    """X and Y share a name in one task; Z in another shares all of X's first run, Y one window of it."""
    width, anchor = 40, 16
    mixed, others = [], []
    for seed in range(24):
        rng = random.Random(seed)
        letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
        x = letters(120)
        n = int(repeats.runs_of([x.encode()], width, anchor, repeats.Roller(1), repeats.Roller(2))[4][0])
        mixed += [x, letters(60) + x[n // 2 : n // 2 + width] + letters(60)]
        others.append(x[: n + width - 1] + letters(60))
    parts = [list(enumerate(mixed)), list(enumerate(others, len(mixed)))]
    df = spark.createDataFrame(spark.sparkContext.parallelize(parts, 2).flatMap(lambda part: part), DOCS)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(df, width, anchor).selectExpr("doc_id", "repeat_cut.n_bytes", "repeat_cut.n_removed", "repeat_cut.n_spans", "sha2(repeat_cut.kept, 256)").collect()}
    assert got == dict(enumerate(brute_repeats([t.encode() for t in mixed + others], width)))


def brute_repeats(texts, width):
    count = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = [False] * (len(t) + 1)
        for i in range(len(t) - width + 1):
            if count[t[i : i + width]] > 1:
                gone[i : i + width] = [True] * width
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone[:-1], [False, *gone]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_of_nothing(spark):
    assert repeats.digest(spark.createDataFrame([], DOCS)).count() == 0
