"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

The features are densities of toxic words and word beginnings, how close they stand to a
word that addresses the reader, the shares of capitals and exclamation marks, and how many words
are obfuscated. The lexicon is learned from labelled texts: words and beginnings of words
that are clearly more frequent in toxic ones, in whatever language. Lexicon, trees and
calibration each learn from documents of their own: of about ``3 * SAMPLE`` labelled ones at most,
a half, a quarter and a quarter.

* A null text is scored like an empty one; a null identifier is held out. Texts are read whole.
* Of several labels of one identifier the highest counts; terms of equal certainty rank by themselves.
* An empty table gives an empty result; repeated rows get equal scores. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.llm.common import fold, stored

FOLDS = 5
#: A third of the labelled documents that the three models together learn from, at most.
SAMPLE = 20_000
#: Terms of the lexicon, at most; the strongest stay.
TERMS = 4_000
#: A term's log odds must be above zero by so many standard errors, and by so much.
CERTAIN, STRONG = 2.6, 0.5
BEGINNINGS = (4, 5, 6)
NEAR = 5
#: Words that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tú tus usted ustedes vosotros su".split())
LEET = str.maketrans("013457@$!|€+", "oieastasiiet")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
FEATURES = ("words", "word_hits", "word_density", "begin_hits", "begin_density", "weight", "strongest", "near_you", "capitals", "shouts", "punctuation", "obfuscated", "obfuscated_hits", "repeats")


def bare_words(text: str) -> list[str]:
    """Lower-cased words without punctuation around them."""
    return [w for w in (EDGES.sub("", x) for x in text.lower().split()) if w]


def terms_of(text: str) -> set[str]:
    """Words, and beginnings of words marked by ``*``."""
    words = set(bare_words(text))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


def features(text: str | None, lexicon: dict[str, float]) -> tuple[float, ...]:
    text = text or ""
    raw = text.split()
    words = [EDGES.sub("", x) for x in text.lower().split()]
    n = max(1, len(raw))
    exact = {i: lexicon[w] for i, w in enumerate(words) if w in lexicon}
    begun = {}
    for i, w in enumerate(words):
        if i not in exact:
            best = max((lexicon.get(w[:k] + "*", 0.0) for k in BEGINNINGS if len(w) > k), default=0.0)
            if best:
                begun[i] = best
    hits = sorted({**exact, **begun})
    you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    close = 0
    if len(you) and hits:
        at = np.searchsorted(you, hits)
        left = np.abs(np.array(hits) - you[np.maximum(at - 1, 0)])
        right = np.abs(you[np.minimum(at, len(you) - 1)] - np.array(hits))
        close = int((np.minimum(left, right) <= NEAR).sum())
    odd = [w for w in words if not w.isalpha() and any(c.isalpha() for c in w)]
    disguised = sum(EDGES.sub("", w.translate(LEET).replace("*", "").replace(".", "")) in lexicon for w in odd)
    weights = [*exact.values(), *begun.values()]
    return (
        float(np.log1p(len(raw))),
        float(np.log1p(len(exact))),
        len(exact) / n,
        float(np.log1p(len(begun))),
        len(begun) / n,
        sum(weights) / n,
        max(weights, default=0.0),
        close / n,
        sum(map(str.isupper, text)) / max(1, len(text)),
        text.count("!") / n,
        (text.count(",") + text.count(".") + text.count("?") + text.count(";")) / n,
        len(odd) / n,
        float(np.log1p(disguised)),
        sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) / n,
    )


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(x, lexicon) for x in texts], columns=list(FEATURES))

    return of(text)


def learn_lexicon(labelled: DataFrame, most: int = TERMS) -> dict[str, float]:
    """Terms of ``text, label`` with their log odds; no more than ``most``."""
    found = F.pandas_udf(lambda texts: texts.map(lambda x: list(terms_of(x or ""))), "array<string>")
    toxic = F.col("label") == 1
    totals = labelled.agg(F.count(F.when(toxic, 1)), F.count(F.when(~toxic, 1))).first()
    counts = labelled.select("label", F.explode(found("text")).alias("term")).groupBy("term").agg(F.count(F.when(toxic, 1)).alias("a"), F.count(F.when(~toxic, 1)).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (totals[0] + 1)) - F.log(b / (totals[1] + 1))
    sure = odds - CERTAIN * F.sqrt(1 / a + 1 / b)
    best = counts.where("a >= 3").select("term", odds.alias("odds"), sure.alias("sure")).where(F.col("sure") > STRONG)
    return {r["term"]: r["odds"] for r in best.orderBy(F.desc("sure"), "term").limit(most).collect()}


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    """The same rows on every run, at most about ``most``: a share chosen by a hash of the identifier."""
    n = rows.count()
    return rows if n <= most else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Labels of identifiers whose checksum leaves 0 are never read; null identifiers count as
    0. A null text counts as empty and is scored like one. Of several labels of one
    identifier the highest counts. If the labels lack one class, every score is the share
    of toxic ones, 0 without labels.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = known.withColumn("fold", fold(F.col("doc_id"), folds)).where("fold > 0")
    # No more rows than the models learn from: bounded by a parameter, so texts need no shuffle.
    known = F.broadcast(stored(_bounded(known, 3 * sample)))
    training = stored(docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "label"))
    third = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    shares = training.groupBy("label").count().collect()
    if len(shares) < 2:
        only = float(shares[0]["label"]) if shares else 0.0
        return rows.select("doc_id", "held_out", F.lit(only).alias("score"), F.lit(int(only >= 0.5)).alias("predicted"))
    lexicon = learn_lexicon(training.where(third < 2))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    measured = stored(training.select("label", third.alias("part"), feature_column(F.col("text"), lexicon).alias("f")).select("label", "part", "f.*"))
    ready = assembler.transform(measured).select("features", F.col("label").cast("double").alias("label"), "part")
    fit = ready.where("part = 2") if measured.where("part = 2").select("label").distinct().count() > 1 else ready
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, seed=7, maxBins=64).fit(fit)
    # Over-fitted scores would mislead the calibration: it has documents of its own.
    raw = lambda df: trees.transform(df).withColumn("raw", vector_to_array("probability")[1])
    check = ready.where("part = 3") if measured.where("part = 3").select("label").distinct().count() > 1 else ready
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw(check).select("raw", "label"))
    told = assembler.transform(rows.select("doc_id", "held_out", feature_column(F.col("text"), lexicon).alias("f")).select("doc_id", "held_out", "f.*"))
    scored = steps.transform(raw(told).select("doc_id", "held_out", "raw"))
    value = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", "held_out", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
