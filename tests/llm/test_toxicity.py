"""The lexicon against plain counting, and what a text's features say."""

import math
import random
from collections import Counter

from sftq.llm import toxicity


def plain_lexicon(rows):
    count = [Counter(), Counter()]
    for text, label in rows:
        words = {w.strip("!,._-*#").lower() for w in (text or "").split()} - {""}
        begun = {w[:n] + "*" for w in words for n in toxicity.BEGINNINGS if len(w) > n}
        count[label].update(words | begun)
    size = [sum(label == k for _, label in rows) for k in (0, 1)]
    out = {}
    for term, n in count[1].items():
        a, b = n + 0.5, count[0][term] + 0.5
        odds = math.log(a / (size[1] + 1)) - math.log(b / (size[0] + 1))
        if n >= 3 and odds - toxicity.CERTAIN * math.sqrt(1 / a + 1 / b) > toxicity.STRONG:
            out[term] = odds
    return out


def test_lexicon_equals_plain_counting(spark):
    rng = random.Random(3)
    mild = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 9))) for _ in range(150)]
    foul = ["vileness", "vilest", "Foul", "gross!", "über-foul"]
    rows = []
    for i in range(900):
        label = int(i % 3 == 0)
        words = rng.choices(mild, k=rng.randrange(30)) + (rng.choices(foul, k=2) if label or rng.random() < 0.03 else [])
        rng.shuffle(words)
        rows.append((rng.choice([" ", "\n"]).join(w + rng.choice(["", "", "!", ",", "."]) for w in words) or None, label))
    df = spark.createDataFrame(rows, "text string, label int").repartition(5)
    got, want = toxicity.learn_lexicon(df), plain_lexicon(rows)
    assert got.keys() == want.keys() and len(want) > 5
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_features_of_a_text():
    lexicon = {"foul": 2.0, "vile*": 1.0}
    f = dict(zip(toxicity.FEATURES, toxicity.features("You FOUL, vilest f0ul thing! thing", lexicon)))
    assert f["words"] == math.log1p(6) and f["word_density"] == 1 / 6 and f["begin_density"] == 1 / 6
    assert f["strongest"] == 2.0 and f["weight"] == 3.0 / 6 and f["near_you"] == 2 / 6
    assert f["shouts"] == 1 / 6 and f["obfuscated"] == 1 / 6 and f["obfuscated_hits"] == math.log1p(1) and f["repeats"] == 1 / 6
    none = toxicity.features(None, lexicon)
    assert none == toxicity.features("", lexicon) and all(x == 0 for x in none)
