"""Phrase collocations from exact n-gram counts in counting quotient filters.

Words get dense numbers, so a phrase packs into a few bits. A Feistel network permutes the
packed phrase; its high bits are the quotient, the rest the remainder, and as the permutation
can be undone and the remainder is kept whole, a filter is an exact counter that holds no
words. Each task counts its phrases in filters, cut into segments by the quotient; filters of one
segment meet in one task, which merges them as sorted runs. The permutation spreads the
most frequent phrases like all others, and each is one slot in a filter however frequent.

1. Texts become blocks: the distinct words of a few megabytes, and the text as numbers into them.
2. Words that are frequent enough for a phrase are numbered across the corpus, and each
   block learns the numbers of its own words by a join.
3. Phrases of numbered words are counted in filters and merged; candidates are joined with
   the counts of their parts, and words are put back last.

* A null text is empty, a null language ``und``. Repeated rows count each.
* A text longer than a block is a block of its own.
* Ties rank by count, then phrase in byte order. Empty tables give an empty result. Other columns
  of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import batches_of, binary_list, stored

#: Bytes of text in a block.
BLOCK_BYTES = 1 << 23
#: Words whose phrases are counted together.
STEP_WORDS = 1 << 17
#: Different phrases that a task holds before it makes a filter of them.
HELD_PHRASES = 1 << 20
#: Phrases, counted each time they occur, for which one segment is made.
SEGMENT_PHRASES = 1 << 22

BLOCKS = "block long, lang string, words array<string>, counts array<int>, size long, tokens binary"
FILTERS = "segment int, filter binary"
COUNTS = "w1 int, w2 int, w3 int, n long"

#: A-Z become lower case, marks and line ends end a piece, tabs are spaces.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256)
)


# Words and blocks


def encode(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, how often each occurs, and the texts as numbers from 1 with 0 between pieces."""
    number: dict[bytes, int] = {}
    take = number.setdefault
    tokens: list[int] = []
    for text in texts:
        for piece in text.translate(PLAIN).split(b"\n"):
            if words := piece.split(b" "):
                tokens += [take(w, len(number) + 1) for w in words if w]
                tokens.append(0)
    array = np.array(tokens, np.int32)
    return list(number), np.bincount(array, minlength=len(number) + 1)[1:], array


def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, text`` to one row for a language of each block."""
    serial = TaskContext.get().partitionId() << 32
    for batch in batches_of(batches, "text", BLOCK_BYTES):
        langs = batch.column("lang").dictionary_encode()
        texts, own = binary_list(batch.column("text")), langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            words, counts, tokens = encode([texts[i] for i in np.flatnonzero(own == k)])
            if words:
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([serial]), "lang": pa.array([lang]), "words": pa.array([[w.decode(errors="replace") for w in words]]),
                    "counts": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())), "size": pa.array([len(tokens)]),
                    "tokens": pa.array([tokens.astype(np.int32 if len(words) >> 16 else np.uint16).tobytes()]),
                })
                serial += 1


# Counting quotient filters


class Packing(NamedTuple):
    """How phrases are packed: ``bits`` a word, ``segments`` a power of two."""

    bits: int
    segments: int

    @property
    def half(self) -> int:
        """Bits of each half of a packed phrase of three words."""
        return max(4, (3 * self.bits + 1) // 2)

    @property
    def shift(self) -> int:
        """Bits of the high half below those that name the segment."""
        return max(0, self.half - (self.segments - 1).bit_length())


#: Odd constants of the four rounds of the permutation.
ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _scrambled(half: np.ndarray, constant: int, bits: int) -> np.ndarray:
    x = (half + np.uint64(1)) * np.uint64(constant)
    x ^= x >> np.uint64(29)
    x *= np.uint64(ROUNDS[0])
    return x >> np.uint64(64 - bits)


def permute(high: np.ndarray, low: np.ndarray, bits: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of packed phrases, permuted by a Feistel network, or restored."""
    if back:
        for constant in reversed(ROUNDS):
            high, low = low ^ _scrambled(high, constant, bits), high
        return high, low
    for constant in ROUNDS:
        high, low = low, high ^ _scrambled(low, constant, bits)
    return high, low


def pack(words: np.ndarray, how: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Columns of word numbers (third 0 for phrases of two) as two halves of bits."""
    half, bits = how.half, how.bits
    w1, w2, w3 = (words[:, k].astype(np.uint64) for k in range(3))
    # The middle word lies across both halves.
    below = np.uint64(half - bits)
    high = (w1 << below) | (w2 >> np.uint64(bits) - below) if half > bits else w1
    low = ((w2 & (np.uint64(1) << np.uint64(bits) - below) - np.uint64(1)) << np.uint64(bits)) | w3
    return high, low


def unpack(high: np.ndarray, low: np.ndarray, how: Packing) -> np.ndarray:
    half, bits = how.half, how.bits
    below = np.uint64(half - bits)
    upper = np.uint64(bits) - below
    mask = lambda n: (np.uint64(1) << n) - np.uint64(1)
    w1, w2 = high >> below, ((high & mask(below)) << upper) | (low >> np.uint64(bits) & mask(upper))
    return np.stack([w1, w2, low & mask(np.uint64(bits))], axis=1).astype(np.int32)


class Counted(NamedTuple):
    """Permuted phrases in order, with their counts: what a filter holds."""

    high: np.ndarray
    low: np.ndarray
    n: np.ndarray


def merged(parts: list[Counted], half: int) -> Counted:
    """Sorted runs merged into one; equal phrases add up. Short phrases sort as one number."""
    high, low, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    one = 2 * half <= 64
    keys = [(high << np.uint64(half)) | low] if one else [high, low]
    # Stable: runs that are sorted already are only merged.
    order = np.argsort(keys[0], kind="stable") if one else np.lexsort((low, high))
    new = np.zeros(len(n), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    first = np.flatnonzero(new)
    at = order[first]
    return Counted(high[at], low[at], np.add.reduceat(n[order], first) if len(n) else n)


def stacked(runs: list[Counted], half: int) -> None:
    """Merge the last runs like digits of a counter, so that each phrase is merged a few times only."""
    while len(runs) > 1 and len(runs[-1].n) * 2 >= len(runs[-2].n):
        runs[-2:] = [merged(runs[-2:], half)]


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs, behind that width."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: memoryview, count: int) -> tuple[np.ndarray, memoryview]:
    width = data[0]
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = np.frombuffer(data[1 : 1 + width * count], np.uint8).reshape(count, width)
    return out.view("<u8").ravel().astype(np.uint64), data[1 + width * count :]


def to_filter(part: Counted, how: Packing) -> bytes:
    """A segment's phrases as a filter.

    The quotient has about as many values as there are slots. A filter holds, as bits, which
    quotients occur and where the run of each ends, then remainders, then counters: one
    byte a slot, with the rest of larger counts behind.
    """
    slots, mask = len(part.n), np.uint64((1 << how.shift) - 1)
    quotient_bits = min(how.shift, max(1, slots.bit_length()))
    rest = how.shift - quotient_bits
    within = part.high & mask
    quotient = (within >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    ends = np.ones(slots, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    short = np.minimum(part.n, 255).astype(np.uint8)
    head = np.array([slots, quotient_bits, int(part.high[0] >> np.uint64(how.shift)) if slots else 0], "<u8").tobytes()
    large = part.n[short == 255]
    return b"".join([
        head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), _narrow(within & np.uint64((1 << rest) - 1)),
        _narrow(part.low), short.tobytes(), _narrow(large.astype(np.uint64) - np.uint64(255)),
    ])


def from_filter(data: bytes, how: Packing) -> Counted:
    view = memoryview(data)
    slots, quotient_bits, segment = (int(x) for x in np.frombuffer(view[:24], "<u8"))
    view = view[24:]
    size = -(-(1 << quotient_bits) // 8)
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view[:size], np.uint8)))
    view = view[size:]
    size = -(-slots // 8)
    ends = np.unpackbits(np.frombuffer(view[:size], np.uint8), count=slots)
    upper, view = _wide(view[size:], slots)
    low, view = _wide(view, slots)
    n = np.frombuffer(view[:slots], np.uint8).astype(np.int64)
    large = np.flatnonzero(n == 255)
    more, _ = _wide(view[slots:], len(large))
    n[large] += more.astype(np.int64)
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
    rest = how.shift - quotient_bits
    return Counted(np.uint64(segment) << np.uint64(how.shift) | quotient << np.uint64(rest) | upper, low, n)


def phrases_of(tokens: np.ndarray, most: int) -> np.ndarray:
    """Runs of two and three numbered words that start among the first ``most``; 0 is no word."""
    tokens = np.concatenate([tokens, np.zeros(2, tokens.dtype)])
    two = np.flatnonzero((tokens[:most] > 0) & (tokens[1 : most + 1] > 0))
    three = two[tokens[two + 2] > 0]
    out = np.zeros((len(two) + len(three), 3), np.int32)
    for k in range(3):
        out[len(two) :, k] = tokens[three + k]
        if k < 2:
            out[: len(two), k] = tokens[two + k]
    return out


def count_phrases(batches: Iterator[pa.RecordBatch], how: Packing) -> Iterator[pa.RecordBatch]:
    """Rows ``size, tokens, numbers`` to filters by segment; ``numbers`` pairs a block's words with the corpus's."""
    held: list[Counted] = []

    def flushed() -> Iterator[pa.RecordBatch]:
        whole = merged(held, how.half)
        held.clear()
        segment = (whole.high >> np.uint64(how.shift)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        parts = [Counted(*(x[a:b] for x in whole)) for a, b in zip(cut, np.r_[cut[1:], len(segment)])]
        for at in range(0, len(parts), 256):
            some = parts[at : at + 256]
            yield pa.RecordBatch.from_pydict({"segment": pa.array(segment[cut[at : at + 256]], pa.int32()), "filter": pa.array([to_filter(p, how) for p in some], pa.binary())})

    for batch in batches:
        for size, tokens, numbers in zip(batch.column("size").to_pylist(), batch.column("tokens"), batch.column("numbers")):
            data = tokens.as_buffer()
            local = np.frombuffer(data, np.int32 if data.size > 2 * size else np.uint16)
            at, number = (x.to_numpy() for x in numbers.values.flatten())
            known = np.zeros(int(max(local.max(initial=0), at.max(initial=0))) + 1, np.int32)
            known[at] = number
            for low in range(0, len(local), STEP_WORDS):
                most = min(STEP_WORDS, len(local) - low)
                found = phrases_of(known[local[low : low + most + 2]], most)
                if len(found):
                    held.append(merged([Counted(*permute(*pack(found, how), how.half), np.ones(len(found), np.int64))], how.half))
                    stacked(held, how.half)
                if sum(len(p.n) for p in held) >= HELD_PHRASES:
                    yield from flushed()
    if held:
        yield from flushed()


def merge_filters(batches: Iterator[pa.RecordBatch], how: Packing, least: int) -> Iterator[pa.RecordBatch]:
    """Filters sorted by segment to the phrases that occur often enough."""
    segment, held = None, []

    def counted() -> Iterator[pa.RecordBatch]:
        whole = merged(held, how.half)
        often = whole.n >= least
        high, low = permute(whole.high[often], whole.low[often], how.half, back=True)
        words, n = unpack(high, low, how), whole.n[often]
        if len(n):
            yield pa.RecordBatch.from_arrays([*(pa.array(words[:, k]) for k in range(3)), pa.array(n)], ["w1", "w2", "w3", "n"])

    for batch in batches:
        for own, data in zip(batch.column("segment").to_pylist(), batch.column("filter")):
            if own != segment and held:
                yield from counted()
                held = []
            segment = own
            held.append(from_filter(data.as_buffer(), how))
            stacked(held, how.half)
    if held:
        yield from counted()


# Whole tables


def blocks_of(docs: DataFrame) -> DataFrame:
    """The texts of ``docs`` as stored blocks."""
    text = F.make_valid_utf8(F.coalesce("text", F.lit(""))).cast("binary").alias("text")
    return stored(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text).mapInArrow(make_blocks, BLOCKS))


def numbered_words(blocks: DataFrame, least: int) -> DataFrame:
    """``number, lang, word, n`` of words that occur often enough in a language, numbered from 1 without gaps."""
    words = blocks.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("word"))
    words = words.agg(F.sum("counts").alias("n")).where(F.col("n") >= least)
    # Numbers with gaps between tasks are written first: closing the gaps must not see other ones.
    words = stored(words.withColumn("at", F.monotonically_increasing_id()))
    task, place = F.shiftright("at", 33).alias("task"), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = words.groupBy(task).agg(F.count("*").alias("size"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    numbered = words.select("*", task).join(offsets, "task")
    return stored(numbered.select((F.col("offset") + place + 1).cast("int").alias("number"), "lang", "word", "n"))


def phrase_counts(blocks: DataFrame, words: DataFrame, least: int, segment_phrases: int = SEGMENT_PHRASES) -> DataFrame:
    """``w1, w2, w3, n`` of phrases that occur ``least`` times, by numbers of words, ``w3`` 0 for phrases of two."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    segments = max(64, 1 << int(2 * total // segment_phrases).bit_length())
    how = Packing(max(3, words.count().bit_length()), segments)
    own = blocks.select("block", "lang", F.posexplode("words").alias("at", "word")).join(words, ["lang", "word"])
    own = own.groupBy("block").agg(F.collect_list(F.struct((F.col("at") + 1).alias("at"), "number")).alias("numbers"))
    texts = blocks.select("block", "size", "tokens").join(own, "block").select("size", "tokens", "numbers")
    filters = texts.mapInArrow(lambda batches: count_phrases(batches, how), FILTERS)
    # As many partitions as segments at most, so that none holds more than a few.
    runs = filters.repartition("segment").sortWithinPartitions("segment")
    return stored(runs.mapInArrow(lambda batches: merge_filters(batches, how, least), COUNTS))


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` without rounding."""
    big = lambda x: x.cast("decimal(19,0)")
    return F.call_function("div", big(a) * big(a) * F.lit(1_000_000), big(left) * big(right))


def candidates(docs: DataFrame, least: int = 10) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all phrases left after those inside longer ones are dropped."""
    blocks = blocks_of(docs)
    words = numbered_words(blocks, least)
    counts = phrase_counts(blocks, words, least)
    word = lambda k: words.select(F.col("number").alias(f"w{k}"), *([F.col("lang")] if k == 1 else []), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"))
    two = stored(counts.where("w3 = 0").select("w1", "w2", F.col("n").alias("a")).join(word(1), "w1").join(word(2), "w2"))
    first = two.select("w1", "w2", "lang", "word1", "n1", "word2", F.col("a").alias("n12"))
    last = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("word2").alias("word3"), F.col("n2").alias("n3"), F.col("a").alias("n23"))
    three = counts.where("w3 > 0").withColumnRenamed("n", "a").join(first, ["w1", "w2"]).join(last, ["w2", "w3"])
    cut = lambda left, right: F.struct(exact_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))
    three = stored(three.withColumns({"early": cut("n1", "n23"), "late": cut("n12", "n3")}))
    parts = F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
    around = three.select("a", parts.alias("p")).groupBy("p.w1", "p.w2").agg(F.max("a").alias("longest"))
    free = two.join(around, ["w1", "w2"], "left").where("longest IS NULL OR 100 * longest < 50 * a")
    free = free.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", cut("n1", "n2").alias("cut"))
    best = F.when(F.col("late.score") < F.col("early.score"), F.col("late")).otherwise(F.col("early"))
    long = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", best.alias("cut"))
    sizes = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    rows = free.unionByName(long).join(sizes, "lang")
    return rows.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language of ``lang, text``, by score.

    Only phrases that reach the score and count at which a language's first ``top`` end are
    ranked, so one language is one short list and ties at its end.
    """
    rows = stored(candidates(docs, least))
    value = F.struct("score", "a")
    sizes = rows.groupBy("lang", value.alias("value")).agg(F.count("*").alias("size"))
    above = Window.partitionBy("lang").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    reached = sizes.withColumn("above", F.coalesce(F.sum("size").over(above), F.lit(0))).where(F.col("above") < top)
    ends = reached.groupBy("lang").agg(F.min("value").alias("end"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.join(ends, "lang").where(value >= F.col("end"))
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) AS sizes(size)
),
counts AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
cuts AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1
),
scored AS (
  SELECT c.*, l.f AS l, r.f AS r, 1000000 * c.f * c.f // (l.f * r.f) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000 * c.f * c.f // (l.f * r.f), k) = 1
),
inner_parts AS (
  SELECT lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS phrase, f FROM scored WHERE size = 3
),
around AS (SELECT lang, phrase, max(f) AS f FROM inner_parts GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.f DESC, s.phrase) AS rank, s.phrase, s.f::BIGINT AS a, s.l::BIGINT AS l,
  s.r::BIGINT AS r, n, s.score::BIGINT AS score
FROM scored s JOIN totals USING (lang) LEFT JOIN around ON around.lang = s.lang AND around.phrase = s.phrase
WHERE around.f IS NULL OR 100 * around.f < 50 * s.f
QUALIFY rank <= 2000
"""
