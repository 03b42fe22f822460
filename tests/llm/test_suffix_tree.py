"""Scores of the suffix tree against a plain tree of dictionaries."""

import math
import random
import zlib
from collections import Counter

import pytest

from sftq.llm import suffix_tree

DOCS = "doc_id long, text string"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain_scores(rows):
    depth = suffix_tree.DEPTH
    bodies = [suffix_tree.symbols((t or "").encode().lower().split()) for _, t in rows]
    seen: dict[bytes, Counter] = {}
    for (i, _), body in zip(rows, bodies):
        for at in range(depth, len(body)) if not held(i) else ():
            for d in range(depth + 1):
                seen.setdefault(body[at - d : at], Counter())[body[at]] += 1
    root = seen.get(b"", Counter())
    states: dict[bytes, tuple[dict, float]] = {}

    def chance(past, symbol, most):
        p = (1 + root[symbol]) / (256 + sum(root.values()))
        for d in range(1, most + 1):
            if past[-d:] in states:
                shares, rest = states[past[-d:]]
                p = p * rest + shares.get(symbol, 0.0)
        return p

    for d in range(1, depth + 1):
        kept = {}
        for context, next_ in seen.items():
            c = sum(next_.values())
            if len(context) != d or c < suffix_tree.LEAST:
                continue
            shares = {s: n / (c + suffix_tree.SMOOTHING * len(next_)) for s, n in next_.items()}
            rest = 1 - sum(shares.values())
            gain = 0.0
            for s, n in next_.items():
                parent = chance(context, s, d - 1)
                gain += n * math.log2((shares[s] + rest * parent) / parent)
            if gain >= suffix_tree.GAIN_BITS * len(next_):
                kept[context] = (shares, rest)
        states |= kept
    scores = [sum(math.log10(chance(body[:at], body[at], depth)) for at in range(depth, len(body))) for body in bodies]
    return scores, len(states)


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choices(words, weights=range(1, 41), k=rng.randrange(60)))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "Abc ABC"), (5, rows[5][1]), (90, "x" * 3000), (91, " ".join(words * 40))]
    want, states = plain_scores(rows)
    assert states > 100
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted((r["doc_id"] or -1, r["score"]) for r in suffix_tree.score(df).collect())
    for (i, a), (j, b) in zip(got, sorted((i or -1, s) for (i, _), s in zip(rows, want))):
        assert i == j and abs(a - b) < 1e-6 * max(1, abs(b)), (i, a, b)
