"""Repeated byte strings: long and repetitive texts, hashes, clashing names."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sftq.llm import repeats

DOCS = "doc_id long, text string"


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    counts = Counter(hash(d[i : i + width]) for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int32)
        for i in range(len(d) - width + 1):
            if counts[hash(d[i : i + width])] > 1:
                gone[i] += 1
                gone[i + width] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_long_and_repetitive_texts_equal_brute_force(spark):
    rng = random.Random(7)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = noise(900)
    texts = [
        "line of a menu\n" * 60_000,  # packs far more than 60-fold
        "line of a menu\n" * 20 + "x",
        noise(1_300_000) + passage + noise(700),
        noise(100) + passage + noise(300_000) + passage[:500],
        passage, None, "", "ab" * 300_000, noise(500),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in repeats.digest(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 400)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "x" * 900, 5, 6, 7, "a")], DOCS + ", `_` int, `k1` int, `row` int, ranges string")
    out = repeats.remove_repeats(df).first()
    assert (out["_"], out["k1"], out["row"], out["ranges"], out["text"]) == (5, 6, 7, "a", "")
    alone = repeats.remove_repeats(df.select("text"))
    assert alone.columns == ["text", "repeat_cut"] and alone.first().repeat_cut.n_removed == 900


def test_parts_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 50)
    for n in (0, 3, 9, 10, 49, 50, 51, 59, 60, 137):
        text = bytes(random.Random(n).randrange(256) for _ in range(n))
        parts = list(repeats.pieces(text, 10))
        windows = [(at + i) for at, part in parts for i in range(len(part) - 9)]
        assert windows == list(range(max(0, n - 9)))
        assert all(text[at : at + len(part)] == part for at, part in parts)


@pytest.mark.parametrize("seed", range(1, 5))
def test_hashes_tell_texts_of_two_letters_apart(seed):
    # Texts whose differences cancel at every scale, by letters and by blocks; in sums, before bits are mixed.
    sums = []
    for block in (1, 2, 8, 16):
        order = np.array([bin(i).count("1") % 2 for i in range(512 // block)])
        for a, b in ((b"abcdefgh" * 2, b"zyxwvuts" * 2), (b"zyxwvuts" * 2, b"abcdefgh" * 2)):
            roller = repeats.Roller(seed)
            roller.load(np.frombuffer(b"".join((a, b)[k][:block] for k in order), np.uint8))
            sums.append(int(roller.sums[-1]))
    for i in range(0, len(sums), 2):
        differ = sums[i] ^ sums[i + 1]
        assert differ and differ & -differ < 1 << 24  # the low bits that agree are few


def test_equal_strings_have_equal_hashes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    roller = repeats.Roller(9, 4)
    roller.load(data)
    whole = {}
    for i, h in enumerate(roller.all_of(6).tolist()):
        assert whole.setdefault(bytes(data[i : i + 6]), h) == h
    assert len(set(whole.values())) == len(whole)
    at = np.array([0, 3, 100, 4000])
    assert (roller.between(at, at + 6) == roller.all_of(6)[at]).all()
