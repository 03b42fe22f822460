"""Measures, host shares and verdicts of the quality rules against plain recomputation."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sftq.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def verdicts(rows):
    measured = {i: plain_measures(t) for i, t, _ in rows}
    base = {i: m[0] < 20 or 100 * m[4] > 30 * m[0] for i, m in measured.items()}
    any_rule = {i: base[i] or 10 * m[2] > m[0] or 10 * m[3] > m[0] or m[1] > 12 * m[0] or m[1] < 2 * m[0] for i, m in measured.items()}
    hosts = defaultdict(list)
    for i, _, host in rows:
        hosts[host].append(any_rule[i])
    total, failed = len(rows), sum(any_rule.values())
    mean = failed / total
    spread = sum(len(h) * (sum(h) / len(h) - mean) ** 2 for h in hosts.values()) / total
    between = max(spread - mean * (1 - mean) * (len(hosts) - 1) / total, 0.0)
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    share = {h: (sum(k) + mean * strength) / (len(k) + strength) for h, k in hosts.items()}
    return {i: (*measured[i], base[i], not base[i] and share[h] <= quality.HOST_LIMIT, share[h]) for i, _, h in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_verdicts_equal_plain_recomputation(spark, seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(50)] + ["é", "中文", "a-very-long-word-indeed", "#", "**"]
    texts = [None, "", "   \n\t", "é " * 30, "word " * 20_000, "#" * 9000]
    rows = []
    for i in range(400):
        host = rng.choice(["good", "good", "mid", "foul", None, f"h{i % 7}"])
        n = rng.choice([5, 9, 60]) if host == "foul" else rng.choice([15, 60, 60, 60, 90])
        text = " ".join(rng.choices(words if host != "mid" else words[:4], k=n))
        rows.append((i, rng.choice([text] * 8 + [text.replace(" ", "\n"), rng.choice(texts)]), host))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want = verdicts(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = {r["doc_id"]: r for r in quality.judged(df).collect()}
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == {i: v[:7] for i, v in want.items()}
    assert all(abs(r["host_share"] - want[i][7]) < 1e-12 for i, r in got.items())
    assert {r["doc_id"] for r in quality.keep_good(df).collect()} == {i for i, v in want.items() if v[6]}
    assert len({v[6] for v in want.values()}) == 2
