"""Removal of repeated blocks of lines, cut where their content says so.

Each line with words starts a chunk, and the chunk ends with the next line with words, with
the blank lines between: boundaries follow from the lines themselves, so a passage is cut
in the same places wherever it stands and whatever comes before it. A rolling hash over
the two line hashes names a chunk; chunks whose name occurs more than once anywhere are
compared byte by byte. The first stays, and all lines of the others go. A block of any number of
lines is the union of its chunks, so none of two lines and more is missed. Sparser cuts, by a
remainder of the rolling hash, miss most short blocks; README has figures.

* A null text stays null and an empty one empty; neither has lines to lose. A document may end up empty.
* First is by ``doc_id``, null last, then by place. Rows equal in ``doc_id`` and ``text`` are one
  document and keep the same lines. Of a run of one line the first stays.
* Texts are taken whole; work is in proportion to their length, a chunk is two lines however long.
* An empty table gives an empty result. All other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.llm.common import BLANKS, stored, whole_rows

FACTOR = 1_000_003
#: Bits of the filter that is sent to all tasks, in words of 64: 8 MB, however many chunks repeat.
FILTER_WORDS = 1 << 20


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression that a lambda reads is computed for each element; an element is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks_of(text: Column) -> Column:
    """Chunks of a text as structs ``a, b, h``: first and last line, from 0, and the rolling hash."""
    worded = lambda own: F.filter(
        F.transform(own, lambda line, i: F.when(line.rlike(f"[^{BLANKS}]"), F.struct(i.alias("i"), F.xxhash64(line).alias("h")))),
        lambda x: x.isNotNull(),
    )
    chunk = lambda a, b: F.struct(a["i"].alias("a"), b["i"].alias("b"), F.xxhash64(a["h"], b["h"], F.lit(FACTOR)).alias("h"))
    pairs = lambda own: F.transform(F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))), lambda x, k: chunk(x, F.get(own, k + 1)))
    return once(worded(F.split(text, "\n", -1)), pairs)


def _keys() -> list[Column]:
    """Two hashes of identifier and text: rows equal in both are one document."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2")]


def _word(h: Column) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(FILTER_WORDS - 1)


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``k1, k2, a, b``: lines of the chunks of each document that stand earlier elsewhere.

    Hashes find candidates, and a filter of fixed size keeps the texts of most others where they
    are; grouping by text decides, and compares copies within a task before any are sent.
    """
    names = docs.select(F.explode(chunks_of(F.col("text"))).alias("c")).select("c.h")
    often = stored(names.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    bits = often.groupBy(_word(F.col("h")).alias("word")).agg(F.bit_or(_bit(F.col("h"))).alias("bits"))
    rows = docs.where("text IS NOT NULL").select(*_keys(), "doc_id", "text", F.explode(chunks_of(F.col("text"))).alias("c"))
    rows = rows.withColumn("word", _word(F.col("c.h"))).join(F.broadcast(bits), "word").where(_bit(F.col("c.h")).bitwiseAND(F.col("bits")) != 0)
    # The text is cut only here, so that other chunks are never built.
    chunk = F.array_join(F.slice(F.split("text", "\n", -1), F.col("c.a") + 1, F.col("c.b") - F.col("c.a") + 1), "\n")
    rows = rows.select("k1", "k2", "doc_id", "c.a", "c.b", "c.h", chunk.alias("chunk"))
    met = stored(rows.withColumn("digest", F.sha2("chunk", 256)))
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "k1", "k2", "a")
    firsts = met.groupBy("h", "chunk").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.first("digest").alias("digest")).where("n > 1")
    firsts = stored(firsts.select("h", "digest", "first"))
    # Each row finds its class again by the digest; the bytes were compared above.
    later = met.drop("chunk").join(firsts, ["h", "digest"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("k1", "k2", "a", "b")


def lines_gone(docs: DataFrame) -> DataFrame:
    """``k1, k2, gone``: numbers of the lines that each document loses."""
    rows = repeated_chunks(docs).select("k1", "k2", F.explode(F.sequence("a", "b")).alias("i"))
    return rows.groupBy("k1", "k2").agg(F.collect_set("i").alias("gone"))


def drop_repeated(docs: DataFrame, verdicts: bool = False) -> DataFrame:
    """``docs`` with ``text`` freed of repeated blocks; with ``verdicts`` also ``n_lines, n_gone``."""
    gone = stored(lines_gone(docs.select("doc_id", "text")))
    rows = whole_rows(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    # A sort-merge join at every size: the lists of lost lines have no bound that a broadcast could rely on.
    rows = rows.select("row", *_keys()).join(gone.hint("merge"), ["k1", "k2"], "left")
    kept = lambda own: F.array_except(F.sequence(F.lit(0), F.size(own) - 1), "gone")
    left = once(F.split("row.text", "\n", -1), lambda own: F.array_join(F.transform(kept(own), lambda i: F.get(own, i)), "\n"))
    text = F.when(F.isnull("gone") | F.isnull("row.text"), F.col("row.text")).otherwise(left)
    out = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    if not verdicts:
        return rows.select(*out)
    count = F.when(F.isnull("row.text"), 0).otherwise(F.size(F.split("row.text", "\n", -1)))
    lost = F.when(F.isnull("gone"), 0).otherwise(F.size("gone"))
    return rows.select(*out, count.alias("n_lines"), lost.alias("n_gone"))


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_gone, text_md5`` of every document."""
    out = drop_repeated(docs.select("doc_id", "text"), verdicts=True)
    return out.select("doc_id", "n_lines", "n_gone", F.md5(F.col("text").cast("binary")).alias("text_md5"))


#: Lists repeated blocks directly: neighbouring lines with words that stand earlier.
ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS own FROM documents),
lines AS (SELECT r, unnest(own) AS line, generate_subscripts(own, 1) AS i FROM docs),
worded AS (SELECT r, i AS a, lead(i) OVER (PARTITION BY r ORDER BY i) AS b FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
blocks AS (
  SELECT r, doc_id, text, a, b, array_to_string(own[a:b], chr(10)) AS block FROM worded JOIN docs USING (r) WHERE b IS NOT NULL
),
later AS (
  SELECT r, a, b, (doc_id, text, a) IS DISTINCT FROM first_value((doc_id, text, a)) OVER (PARTITION BY block ORDER BY doc_id NULLS LAST, a) AS gone FROM blocks
),
gone AS (SELECT DISTINCT r, unnest(range(a, b + 1)) AS i FROM later WHERE gone),
kept AS (
  SELECT r, count(*) AS n_lines, count(gone.i) AS n_gone, string_agg(line, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL) AS text
  FROM lines LEFT JOIN gone USING (r, i) GROUP BY r
)
SELECT d.doc_id, coalesce(n_lines, 0)::INTEGER AS n_lines, coalesce(n_gone, 0)::INTEGER AS n_gone,
  CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS text_md5
FROM docs d LEFT JOIN kept k USING (r)
"""
