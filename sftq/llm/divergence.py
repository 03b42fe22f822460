"""How far the sources of a language differ in the words they use.

Terms of up to 16 bytes are packed into one or two unsigned 64-bit words, whose order is
that of their bytes; the words of some megabytes of text are radix-sorted by 16-bit digits
and counted by runs. Longer terms are sorted as bytes in buckets by length. Each task sends
one row for a term of a source, and the rest is sums: terms in enough documents of a
language are kept, shares are smoothed and scaled to integers, and differences of shares are
added up, pair by pair in blocks of sources and term by term for the report.

* Null language, source and text count as empty. Repeated rows are documents of their own.
* A text longer than a chunk is counted in slices cut between terms and still is one document.
* Ties rank by item in byte order. A source without terms is compared like any other; where a
  language keeps no term, all its pairs have value 0.
* An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import stored

#: Bytes of text that are sorted together.
CHUNK_BYTES = 1 << 22
#: Sources of a language compared in one matrix.
BLOCK = 512
#: Terms of a matrix.
MATRIX_ROWS = 2048
#: Bytes of matrices that a task holds before it sends them.
HELD_BYTES = 1 << 26
COUNTS = "lang string, source string, term string, n long, docs long"
SUMS = "lang string, i int, j int, value long"


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows of 64-bit words, the first most significant, digit by digit."""
    order = np.arange(len(words[0]), dtype=np.int32)
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(keys: list[np.ndarray], doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """``first, group, n, docs`` of the runs of equal keys and group, of rows in their order."""
    new = np.zeros(len(doc), bool)
    new[:1] = True
    for key in (*keys, group):
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(doc)])
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    return first, group[first], n, np.add.reduceat(fresh, first, dtype=np.int64)


def terms_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lower-cased and room for two words behind, starts and ends of terms."""
    low = np.frombuffer(data + bytes(16), np.uint8).copy()
    low[(low >= 0x41) & (low <= 0x5A)] |= 0x20
    inside = (low >= 0x80) | ((low >= 0x61) & (low <= 0x7A))
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    return low, edge[::2], edge[1::2]


def _words(low: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as a big-endian number, zeros behind."""
    every = np.ndarray(len(low) - 7, ">u8", low, strides=(1,))
    spare = np.uint64(64) - (length.astype(np.uint64) << np.uint64(3))
    return every[start].astype(np.uint64) >> spare << spare


def count_chunk(texts: list[bytes], group: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """``terms, group, n, docs`` of whole texts, in parts by length of the terms."""
    turn = np.argsort(group, kind="stable")
    low, start, end = terms_of(b"\0".join(texts[i] for i in turn))
    size = np.array([len(texts[i]) for i in turn]) + 1
    doc = np.searchsorted(np.cumsum(size), start, side="right").astype(np.int32)
    length, owner = end - start, group[turn][doc]
    for least, most in ((1, 8), (9, 16)):
        at = np.flatnonzero((length >= least) & (length <= most))
        if len(at):
            words = [_words(low, start[at], np.minimum(length[at], 8))]
            if most > 8:
                words.append(_words(low, start[at] + 8, length[at] - 8))
            order = radix_order(words)
            keys = [w[order] for w in words]
            first, own, n, docs = _runs(keys, doc[at][order], owner[at][order])
            packed = np.stack([k[first] for k in keys], axis=1).astype(">u8")
            yield packed.view(f"S{most}").ravel().tolist(), own, n, docs
    bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    for k in np.unique(bucket[length > 16]):
        at = np.flatnonzero((bucket == k) & (length > 16))
        terms = np.array([low[a:b].tobytes() for a, b in zip(start[at], end[at])], f"S{1 << k}")
        order = np.argsort(terms, kind="stable")
        first, own, n, docs = _runs([terms[order]], doc[at][order], owner[at][order])
        yield terms[order][first].tolist(), own, n, docs


def slices_of(text: bytes, most: int) -> Iterator[bytes]:
    """A long text in parts of about ``most`` bytes, cut between terms."""
    begin, (_, start, end) = 0, terms_of(text)
    while len(text) - begin > most:
        k = np.searchsorted(start, begin + most)
        # The last term that starts in the part may end behind it.
        cut = max(begin + most, int(end[k - 1])) if k else begin + most
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def count_terms(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, source, text`` to one row for a term of a source of each chunk."""
    known: dict[tuple[str, str], int] = {}
    texts: list[bytes] = []
    owners: list[int] = []

    def table(terms: list[bytes], group: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        langs, sources = (pa.array([g[k] for g in known], pa.string()).take(pa.array(group)) for k in (0, 1))
        return pa.RecordBatch.from_arrays([langs, sources, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def counted() -> Iterator[pa.RecordBatch]:
        for part in count_chunk(texts, np.array(owners, np.int32)):
            yield table(*part)
        texts.clear()
        owners.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            own = known.setdefault((lang.as_py(), source.as_py()), len(known))
            n = text.as_buffer().size
            if n > chunk:
                whole: Counter[bytes] = Counter()
                for piece in slices_of(text.as_py(), chunk):
                    for terms, _, counts, _ in count_chunk([piece], np.zeros(1, np.int32)):
                        whole.update(dict(zip(terms, counts.tolist())))
                if whole:
                    yield table(list(whole), np.full(len(whole), own), np.array(list(whole.values())), np.ones(len(whole)))
                continue
            texts.append(text.as_py())
            owners.append(own)
            size += n
            if size >= chunk:
                yield from counted()
                size = 0
    if texts:
        yield from counted()


def share(count: Column, total: Column, terms: Column, smooth: int, scale: int) -> Column:
    """``1 + floor(scale * (count + smooth) / (total + smooth * terms))``, exact beyond 64 bits."""
    part = (count + smooth).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", part, (total + smooth * terms).cast("decimal(20,0)"))


def pair_sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, bi, bj, a, b, cells`` of one term each to sums of differences in each block of pairs."""
    held: dict[tuple[str, int, int], np.ndarray] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, bi, bj), sums in held.items():
            i, j = np.nonzero(sums)
            keep = (i < j) | (bi < bj)
            i, j = i[keep], j[keep]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(i + bi * size, pa.int32()), pa.array(j + bj * size, pa.int32()), pa.array(sums[i, j])], ["lang", "i", "j", "value"])
        held.clear()

    for batch in batches:
        rows: dict[tuple[str, int, int], list[int]] = {}
        for r, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "bi", "bj")))):
            rows.setdefault(key, []).append(r)
        parts = ((key, own[at : at + MATRIX_ROWS]) for key, own in rows.items() for at in range(0, len(own), MATRIX_ROWS))
        for (lang, bi, bj), own in parts:
            part = batch.take(pa.array(own))
            cells = part.column("cells")
            row = np.repeat(np.arange(len(own)), np.diff(cells.offsets.to_numpy()))
            index, p = (x.to_numpy(zero_copy_only=False) for x in cells.flatten().flatten())
            sides = []
            for block, base in ((bi, "a"), (bj, "b")):
                side = np.tile(part.column(base)[0].values.to_numpy(zero_copy_only=False), (len(own), 1))
                here = index // size == block
                side[row[here], index[here] - block * size] = p[here]
                sides.append(side)
            left, right = sides
            sums = held.setdefault((lang, bi, bj), np.zeros((left.shape[1], right.shape[1]), np.int64))
            for i in range(left.shape[1]):
                sums[i] += np.abs(left[:, i : i + 1] - right).sum(axis=0)
        if sum(x.nbytes for x in held.values()) >= HELD_BYTES:
            yield from flushed()
    yield from flushed()


def ranked(df: DataFrame) -> DataFrame:
    """``rank`` from 1 within language and source, by value descending, then item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.withColumn("rank", F.row_number().over(order))


def term_counts(docs: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term and the documents that have it."""
    text = F.make_valid_utf8(F.coalesce("text", F.lit(""))).cast("binary").alias("text")
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], text)
    rows = rows.mapInArrow(lambda batches: count_terms(batches, chunk), COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(
    docs: DataFrame, least_docs: int = 30, smooth: int = 5, scale: int = 1_000_000_000, top: int = 50, chunk: int = CHUNK_BYTES, block: int = BLOCK
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of rows with ``lang, source, text``.

    Part ``pair`` has the summed difference of each source to every other of its language,
    part ``term`` the ``top`` terms of which a source has more than its language.
    """
    cell = F.struct("source", "n")
    terms = term_counts(docs, chunk).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(cell).alias("cells"))
    kept = stored(terms.where(F.col("docs") >= least_docs).drop("docs"))
    cells = kept.select("lang", "term", "all", F.inline("cells"))
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    own = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    own = own.fillna(0, ["total", "terms", "lang_total"])
    index = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("i")
    own = stored(own.select("*", index))
    # p and q in the units of the scale.
    p, q = share(F.col("n"), F.col("total"), F.col("terms"), smooth, scale), share(F.col("all"), F.col("lang_total"), F.col("terms"), smooth, scale)
    shares = cells.join(own, ["lang", "source"]).select("lang", "source", "term", "i", p.alias("p"), q.alias("q"))
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = ranked(over).where(F.col("rank") <= top)

    base = own.where("terms > 0").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", share(F.lit(0), F.col("total"), F.col("terms"), smooth, scale).alias("p")))).alias("base"))
    base = base.select("lang", F.transform("base", lambda x: x["p"]).alias("base"))
    last = F.floor((F.size("base") - 1) / block).cast("int")
    base = base.select("lang", "base", F.explode(F.sequence(F.lit(0), last)).alias("bi"))
    base = base.select("*", F.explode(F.sequence("bi", last)).alias("bj"))
    piece = lambda b: F.slice("base", F.col(b) * block + 1, F.lit(block))
    base = stored(base.select("lang", "bi", "bj", piece("bi").alias("a"), piece("bj").alias("b")))
    by_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "p")).alias("cells"))
    sums = by_term.join(base, "lang").select("lang", "bi", "bj", "a", "b", "cells").mapInArrow(lambda batches: pair_sums(batches, block), SUMS)
    sums = stored(sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
    both = sums.unionByName(sums.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    other = own.select("lang", F.col("source").alias("item"), F.col("i").alias("j"))
    pairs = own.select("lang", "source", "i").join(other, "lang").where("i <> j").join(both, ["lang", "i", "j"], "left")
    pairs = ranked(pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(over, "term"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
words AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs
),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM groups LEFT JOIN cells USING (lang, source) GROUP BY ALL),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
shares AS (
  SELECT lang, source, term, coalesce(cells.c, 0) AS c,
    (1 + 1000000000 * (coalesce(cells.c, 0)::HUGEINT + 5) // (sizes.n + 5 * v))::BIGINT AS p,
    (1 + 1000000000 * (kept.c::HUGEINT + 5) // (langs.n + 5 * v))::BIGINT AS q
  FROM kept JOIN sizes USING (lang) JOIN langs USING (lang) LEFT JOIN cells USING (lang, source, term)
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q
),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranks WHERE part = 'pair' OR rank <= 50
"""
