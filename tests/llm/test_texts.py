"""URL rules, toxicity, line dedup, quality, language model, packing and mixing on small inputs."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from sftq.llm import lines, mixing, packing, quality, suffix_tree, toxicity, urls

DOCS = "doc_id long, text string, source string"


def frames(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


URLS = [
    (1, "http://Blog.Example.ORG/en/12?x", "h"),
    (2, "https://example.org/es/1#a", None),
    (3, "https://example.org", "h"),
    (4, "http://notexample.org/es/1", "h"),
    (5, "x://a.com/de/1", "h"),
    (6, "x://a.com/fr/1://b", "h"),
    (7, "x://com/fr/", "h"),
    (8, None, "h"),
    (9, "no scheme", "h"),
    (10, "", "h"),
    (11, "x://example.org:80/es/", "h"),
    (12, "x://..org/", "h"),
    (1, "http://Blog.Example.ORG/en/12?x", "h"),
    (None, "x:///p", "h"),
    (13, "x://a.com/" + "p" * 50_000, "h"),
    (14, "x://a\n.org/\ud7ff/é", "h"),
]


def test_url_rules_equal_sql(spark):
    pages = frames(spark, URLS, "page_id long, url string, host string")
    out = urls.judge_urls(pages, urls.rules_table(spark))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = Counter(tuple(r) for r in out.drop("url").select("page_id", "host", "path", "rule", "verdict").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in URLS])
    assert got == Counter(con.execute(urls.ORACLE).fetchall())


def test_nested_rules_and_ties(spark):
    rules = [("block", "a.b", "/x"), ("allow", "a.b", "/x/y"), ("block", "a.b", "/x/y/z"), ("allow", "b", "/x/y"), ("block", "b", "/x/y"), ("odd", "b", "/"), ("block", "", "/"), ("block", None, "/"), ("block", "b", None)]
    cases = {"s://a.b/x/y/zz": "block", "s://a.b/x/y/q": "allow", "s://a.b/xx": "block", "s://c.b/x/y": "block", "s://c.b/": "none", "s://q.a.b/x/y": "allow"}
    pages = frames(spark, list(enumerate(cases)), "page_id int, url string")
    got = urls.judge_urls(pages, frames(spark, rules, "verdict string, host string, path string"), "none")
    assert {r["url"]: r["verdict"] for r in got.collect()} == cases
    none = urls.judge_urls(pages.limit(0), urls.rules_table(spark)).collect()
    assert none == []
    assert urls.judge_urls(pages, urls.rules_table(spark).limit(0)).where("verdict = 'allow' and rule is null").count() == len(cases)


def test_rules_reach_over_many_ranges(spark):
    rng = random.Random(12)
    part = lambda: rng.choice(["a", "b", "ab", "é", "x", ""])
    path = lambda n: "/" + "/".join(part() for _ in range(rng.randrange(n)))
    host = lambda: ".".join(rng.choice(["a", "b", "q", "com"]) for _ in range(rng.randrange(1, 4)))
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in [("com", "/")] + [(host(), path(5)) for _ in range(150)]}.values())
    # One domain holds most URLs, and one of its URLs stands very often.
    pages = [f"s://{rng.choice(['hot.com', host()])}{path(7)}" for _ in range(3000)] + ["s://hot.com/x"] * 1500

    def best(url):
        own, _, rest = url.partition("://")[2].partition("/")
        fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (own == h or own.endswith("." + h)) and ("/" + rest).startswith(p)]
        return (max(fit)[2:] if fit else (None, "none"))

    df = frames(spark, list(enumerate(pages)), "page_id int, url string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = urls.judge_urls(df, frames(spark, rules, "verdict string, host string, path string"), "none").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {i: best(u) for i, u in enumerate(pages)}
    assert len(got) == len(pages)


PASSAGE = "\n".join(f"line {i} of a passage" for i in range(20))
LINED = [
    (1, "first own line\n" + PASSAGE + "\nlast own line", "a"),
    (2, "another start\nmore\n" + PASSAGE, "a"),
    (3, PASSAGE, None),
    (3, PASSAGE, None),
    (None, PASSAGE + "\n\n\n", "a"),
    (4, None, "a"),
    (5, "", "a"),
    (6, "\n\n\n\n\n\n", "a"),
    (7, "\n\n\n\n\n\n", "a"),
    (8, "only one line", "a"),
    (9, "only one line", "a"),
    (10, "\n".join(f"{i % 3}" for i in range(3000)), "a"),
]


def test_line_dedup_equals_sql(spark):
    docs = frames(spark, LINED)
    got = Counter(tuple(r) for r in lines.digest(docs).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in LINED])
    assert got == Counter(con.execute(lines.ORACLE).fetchall())
    out = {r["doc_id"]: r["text"] for r in lines.drop_repeated(docs.withColumnRenamed("source", "k1")).collect()}
    assert out[1] == LINED[0][1] or len(out[1]) < len(LINED[0][1])
    assert len(out[2]) < len(PASSAGE) / 2 and out[4] is None and out[6] == LINED[7][1]
    assert lines.digest(docs.limit(0)).count() == 0


def test_quality_measures(spark):
    text = "a b c d e f g h i a b c d e f g h j # $\nx x\n\nx x\n x x\nx x"
    assert quality.measure(text.encode()) == (28, 28, 2, 2, 16)
    assert quality.measure(None) == (0, 0, 0, 0, 0)
    assert quality.measure("é é".encode()) == (2, 2, 0, 0, 0)
    rng = random.Random(2)
    for _ in range(200):
        words = [rng.choice("abc").encode() for _ in range(rng.randrange(60))]
        runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(8)}
        assert quality.repeated_words(words) == len(inside)


def test_hosts_are_judged_by_shrunk_shares(spark):
    good = " ".join(f"wording{i}" for i in range(40))
    bad = " ".join(["same words again and again here now ok"] * 9)
    rows = [(i, good, "fine") for i in range(300)] + [(1000 + i, bad, "foul") for i in range(40)]
    rows += [(2000, good, "foul"), (3000, bad, "new"), (3001, good, "new"), (4000, None, None), (4001, good, None), (4001, good, None)]
    out = {}
    for r in quality.judged(frames(spark, rows)).collect():
        out[r["doc_id"]] = r
    assert not out[2000]["kept"] and out[3001]["kept"] and not out[3000]["kept"] and out[4001]["kept"]
    assert out[4000]["n_words"] == 0 and out[4000]["base_failed"]
    docs = frames(spark, [(*r, i) for i, r in enumerate(rows)], DOCS + ", m int")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 300 + 1 + 2
    assert quality.judged(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def corpus(n=120):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 6))) for _ in range(80)]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 81), k=rng.randrange(200))), "s%d" % (i % 4)) for i in range(n)]
    return rows + [(900, None, None), (901, "", "s1"), (None, "a  B\tc", "s2"), (5, rows[5][1], "s1"), (5, rows[5][1], "s1")]


def test_base_score_and_probabilities(spark):
    rows = corpus()
    got = suffix_tree.score(frames(spark, rows)).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, _ in rows]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)
        want[i, held(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    mean = lambda name: sum(r[name] for r in got if r["held_out"]) / sum(r["n_tokens"] for r in got if r["held_out"])
    assert mean("score") > -1.6 * math.log10(256)
    assert suffix_tree.score(frames(spark, rows).limit(0)).count() == 0
    assert suffix_tree.score(frames(spark, [(0, "a b", "s")])).count() == 1


def test_next_symbols_sum_to_one(spark):
    tree = suffix_tree.grow(frames(spark, corpus()), least=1e-4, gain_bits=1.0)
    assert sum(len(level[0]) for level in tree.levels) > 50
    for past in (b"\n" * 5, b"ab cd", b"zzzzz", b"e fa "):
        code = int.from_bytes(past, "big") << 8
        p = tree.probability(np.arange(256, dtype=np.uint64) + np.uint64(code))
        assert (p > 0).all() and abs(p.sum() - 1) < 1e-9


def test_rare_contexts_stay_in_a_large_corpus(spark):
    rare = frames(spark, [(i, "qz", "s") for i in range(3)])
    filler = spark.range(60).selectExpr("repeat('ab cd ', 70000) AS text")
    code = np.array([int.from_bytes(b"qz", "big")], np.uint64)
    small, large = (suffix_tree.grow(df).probability(code)[0] for df in (rare, rare.select("text").union(filler)))
    assert small > 0.4 and large > 0.4


def test_codes_follow_texts():
    bodies = [suffix_tree.symbols(x.split()) for x in (b"", b"ab", b"a b c")]
    codes, start = suffix_tree.codes_of(bodies)
    assert start.tolist() == [0, 1, 4] and len(codes) == 1 + 3 + 6
    assert bytes(int(c) & 255 for c in codes) == b"\nab\na b c\n"


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    odd = ["a  b \t c\n\n d ", "<|endoftext|> x", "don't  I'll\u2003wide \x1c sep", "1234 5é6 漢字", "", None, " ", "x" * 9000]
    rows = [(i, t, "s") for i, t in enumerate([*odd, "word " * 5000, *["the same"] * 30])] + [(0, odd[0], "s")]
    out = [r.asDict() for r in packing.pack(frames(spark, rows)).collect()]
    want = Counter()
    for i, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        start, stop = 0, len(ids) % 2048 or 2048
        for piece in range(-(-len(ids) // 2048)):
            want[i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
            start, stop = stop, stop + 2048
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 2048
    assert packing.pack(frames(spark, rows).limit(0)).count() == 0


def test_fast_parts_have_the_tokenizers_ids():
    import public_tokenizers

    paths = [str(public_tokenizers.path(x)) for x in (packing.TOKENIZER, packing.RANKS)]
    fast, plain = packing.Encoder(*paths), packing.Encoder(paths[0])
    rng = random.Random(12)
    letters = "abcdefghiknorstuABEST éñüßàœ'\"-_.,;:!?()[]{}#$%&|<>/0123456789²½\u00ad\u00a0\t\n"
    for _ in range(4000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 40)))
        whole = np.array(plain.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert fast.encode(text) == plain.encode(text) == whole, repr(text)


@pytest.mark.parametrize("seed", range(6))
def test_fullest_is_optimal(seed):
    rng = random.Random(seed)
    counts = [0] * 41
    for _ in range(5):
        counts[rng.randrange(1, 40)] += rng.randrange(1, 4)
    for room in range(1, 41):
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n):
                sums |= {s + length for s in sums if s + length <= room}
        chosen = packing.fullest(counts, room)
        assert sum(length * k for length, k in chosen.items()) == max(sums)
        assert all(k <= counts[length] for length, k in chosen.items())


@pytest.mark.parametrize("lengths,waste", [([100, 100, 60, 41, 37, 13, 9, 7, 2], 0.08), (range(1, 101), 0.01), ([51], 1.0), ([100], 0.0)])
def test_plan_places_everything_once(lengths, waste):
    rng = random.Random(9)
    histogram = Counter(rng.choice(lengths) for _ in range(5000))
    rows = packing.plan(histogram, 100)
    ends = {(a[0], a[1]): b[1] for a, b in zip(rows.tolist(), rows.tolist()[1:], strict=False) if a[0] == b[0]}
    filled = Counter()
    for length, first, start, _ in rows.tolist():
        for i in range(ends.get((length, first), histogram[length]) - first):
            filled[start + i] += length
    assert sum(filled.values()) == sum(length * n for length, n in histogram.items())
    assert max(filled.values()) <= 100 and len(filled) <= sum(filled.values()) / 100 * (1 + waste) + 1


def goals(sizes, weights=(5, 2, 1), share=1.5):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    open_, left, out = set(names), share * sum(sizes.values()), {}
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]} if total else set()
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    rows = [(i, "w " * min(900, int(rng.paretovariate(1.2) * 12)), rng.choice(["a", "a", "a", "a", "b", "é", "z", None])) for i in range(900)]
    rows += [(2000 + i, "same text here", "a") for i in range(300)] + [(3000, None, "b"), (3001, "", "empty"), (None, "x y", "b"), (5, rows[5][1], rows[5][2])]
    docs = frames(spark, rows)
    out = mixing.mixed(docs).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = goals(sizes)
    assert {r["source_size"] for r in out} == set(sizes.values())
    of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in out:
        source = of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - want[source]) < 1e-6 * (1 + want[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 15 for s in sizes)
    again = Counter(tuple(r) for r in mixing.mixed(docs.repartition(3)).collect())
    assert again == Counter(tuple(r) for r in out)
    mixed = mixing.mix(docs.withColumnRenamed("source", "source").withColumn("copies", docs.doc_id))
    assert mixed.columns == ["doc_id", "text", "source", "copies"]
    assert mixed.selectExpr("sum(size(split(trim(text), ' ')))").first()[0] == sum(taken.values())
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_toxicity_separates(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    rows, marks = [], []
    for i in range(600):
        words = rng.choices(plain, k=rng.randrange(10, 60))
        toxic = i % 4 == 0
        if toxic:
            words += ["Vile" + rng.choice(["st", "ly", "ness!", ","]), rng.choice(["foulmouth", "FOULMOUTH"]), "you"]
            rng.shuffle(words)
        rows.append((i, " ".join(words), "s"))
        marks.append((i, 1, int(toxic)))
    docs = frames(spark, [*rows, (5000, None, "s"), (5001, "", "s"), (None, "foulmouth vilest", "s"), rows[0]])
    labels = frames(spark, [*marks, marks[0], (7, 1, None), (None, 0, 1), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == len(rows) + 4
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    truth = {i: t for i, _, t in marks}
    test = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert test and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in test)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in test) / len(test) > 0.97
    only = toxicity.score(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in only} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0
