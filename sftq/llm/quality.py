"""Quality rules with verdicts on whole hosts.

Each text is measured once. The share of documents that fail any rule is taken per host,
drawn towards the overall share by a beta prior fitted to all hosts, and a host whose
share stays above a limit is rejected with all its documents. ``source`` is the host.

* A null or empty text has no words and fails a base rule; a null ``source`` is a host like any other.
* Texts are measured whole, in time proportional to their length. Repeated rows count each.
* A host at the limit exactly is kept. An empty table gives an empty result.
* ``keep_good`` returns all columns as they are, whatever their names; ``judged`` reads three.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.llm.common import stored, whole_rows

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: A host is rejected if more than this share of its documents fails, after shrinking.
HOST_LIMIT = 0.5


def _ranked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the pairs, and how often each pair occurs, by place."""
    codes, counts = np.unique(left * (right.max() + 1) + right, return_inverse=True, return_counts=True)[1:]
    return codes, counts[codes]


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a run of eight words found twice or more in the list."""
    if len(words) < WINDOW + 1:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    two, _ = _ranked(ids[:-1], ids[1:])
    four, often = _ranked(two[:-2], two[2:])
    start = np.flatnonzero((often[:-4] > 1) & (often[4:] > 1))
    if not len(start):
        return 0
    _, often = _ranked(four[start], four[start + 4])
    start = start[often > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The measures of one text; null is empty. Lines without a word are not repeated lines."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measures(text: Column) -> Column:
    @F.pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        names = [x.split()[0] for x in MEASURES.split(", ")]
        return pd.DataFrame([measure(x) for x in texts], columns=names)

    return of(text.cast("binary"))


def base_failed(m: Column) -> Column:
    """Too few words, or too many in repeated windows; holds for a text without words."""
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def any_failed(m: Column) -> Column:
    """A rule that counts against the host: base, symbols, repeated lines, odd word length."""
    return (
        base_failed(m)
        | (10 * m["n_symbols"] > m["n_words"])
        | (10 * m["n_dup_lines"] > m["n_words"])
        | (m["word_chars"] > 12 * m["n_words"])
        | (m["word_chars"] < 2 * m["n_words"])
    )


def host_shares(measured: DataFrame) -> DataFrame:
    """``source, host_share`` from ``source, m``: failing share of each host, shrunk.

    The prior's mean is the overall share, its strength the one that explains how far the
    hosts' shares differ beyond chance (method of moments). Null is a host of its own.
    """
    hosts = measured.groupBy("source").agg(F.count("*").alias("n"), F.sum(any_failed(F.col("m")).cast("long")).alias("k"))
    hosts = stored(hosts)
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("hosts")).first()
    if not total["n"]:
        return hosts.select("source", F.lit(0.0).alias("host_share"))
    mean = total["k"] / total["n"]
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - mean, 2))).first()[0] / total["n"]
    chance = mean * (1 - mean)
    between = max(spread - chance * (total["hosts"] - 1) / total["n"], 0.0)
    strength = min(max(chance / between - 1, 1.0), 1e6) if between > 0 else 1e6
    share = (F.col("k") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("source", share.alias("host_share"))


def judged(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``kept``, ``host_share`` for every row."""
    measured = stored(docs.select("doc_id", "source", measures(F.col("text")).alias("m")))
    shares = host_shares(measured).withColumnRenamed("source", "host")
    met = measured.join(shares, F.expr("source <=> host"), "left")
    failed = base_failed(F.col("m"))
    kept = ~failed & (F.coalesce("host_share", F.lit(0.0)) <= limit)
    return met.select("doc_id", "m.*", failed.alias("base_failed"), kept.alias("kept"), "host_share")


def keep_good(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Rows of ``docs`` that pass the base rules and whose host is not rejected, unchanged."""
    rows = whole_rows(docs).select("row", measures(F.col("row.text")).alias("m"))
    shares = host_shares(rows.select("row.source", "m"))
    bad = shares.where(F.col("host_share") > limit).select(F.col("source").alias("host"))
    good = rows.where(~base_failed(F.col("m")))
    return good.join(bad, F.expr("row.source <=> host"), "left_anti").select("row.*")
