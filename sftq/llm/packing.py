"""Packing token sequences by minimum bin slack.

Documents become token pieces of at most ``CAPACITY``; only their lengths matter for the
packing, so the plan is made from the histogram of lengths, at most ``CAPACITY`` rows
whatever the input. Each bin takes the longest piece left and, by a bitset subset-sum
over the lengths available, the fullest combination that fits beside it. The same
combination is taken as often as the counts allow. Pieces then find their bin by their
number among the pieces of their length.

* A null or empty text is its end token alone. Long documents are cut into pieces, never shortened.
* Pieces of one length are alike for the plan; which of them goes where follows a hash of document and
  piece. Repeated rows are documents of their own. An empty table gives an empty result.
* Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import stored

CAPACITY = 2048
END = 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Words whose tokens a task remembers; then it starts anew.
REMEMBERED = 300_000
#: White space as the tokenizer's own splitting sees it.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The tokenizer never joins across these parts, so each can be encoded by itself.
PARTS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

#: How the tokenizer splits a text, and the first letter beyond Latin.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN_END = "\u0250"


class Encoder(dict):
    """Token ids of a text as little-endian 32-bit bytes; remembers the parts of texts.

    ``ranks`` is the tokenizer's vocabulary in merge order. With it, parts of Latin letters
    are merged by tiktoken, which gives the same ids three times as fast; all others, and texts
    with a special token, go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.fast = Tokenizer.from_file(path), None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("parts", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if self.fast and max(part) < LATIN_END:
            ids = self.fast.encode_ordinary(part)
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        self[part] = value = np.array(ids, "<u4").tobytes()
        return value

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, PARTS.findall(text)))


PIECES = "block long, place long, doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces_of(
    batches: Iterator[pa.RecordBatch], path: str, ranks: str | None, capacity: int
) -> Iterator[pa.RecordBatch]:
    """Rows ``doc_id, text`` to pieces, numbered by length within the task (``block``)."""
    from pyspark import TaskContext

    encoder, block = Encoder(path, ranks), TaskContext.get().partitionId()
    counts = np.zeros(capacity + 1, np.int64)
    end = np.array([END], "<u4").tobytes()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = memoryview(encoder.encode(text or "") + end)
            n = len(ids) // 4
            start, stop = 0, n % capacity or capacity
            for piece in range(-(-n // capacity)):
                length = stop - start
                rows.append((block, counts[length], doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * stop])))
                counts[length] += 1
                start, stop = stop, stop + capacity
        if rows:
            names = [x.split()[0] for x in PIECES.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


def fullest(counts: np.ndarray | list[int], room: int) -> dict[int, int]:
    """The combination of available lengths with the greatest sum up to ``room``: length to number."""
    if room and counts[room]:
        return {room: 1}
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in range(room, 0, -1):
        left = min(int(counts[length]), room // length)
        k = 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= length * k
            chosen[length] = chosen.get(length, 0) + k
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows ``length, first, bin, offset``: pieces of a length from number ``first`` on.

    They fill consecutive bins from ``bin`` on, at ``offset``; up to the next row's ``first``.
    Each combination used uses up a length, so there are few of them.
    """
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    used, rows, bins, top = [0] * (capacity + 1), [], 0, capacity
    while True:
        while top and not counts[top]:
            top -= 1
        if not top:
            return np.array(sorted(rows), np.int64).reshape(-1, 4)
        counts[top] -= 1
        chosen = fullest(counts, capacity - top)
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        times = min(counts[length] // k for length, k in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                rows.append((length, used[length], bins, offset))
                used[length] += times
                offset += length
            counts[length] -= times * chosen[length]
        bins += times


def placed(batches: Iterator[pa.RecordBatch], rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds ``sequence_id, offset`` to pieces with their ``number`` among those of their length."""
    keys = (rows[:, 0] << 48) + rows[:, 1]
    for batch in batches:
        length, number = batch.column("length").to_numpy().astype(np.int64), batch.column("number").to_numpy()
        at = np.searchsorted(keys, (length << 48) + number, side="right") - 1
        columns = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        columns["length"] = length
        yield pa.RecordBatch.from_pydict(columns | {"sequence_id": rows[at, 2] + number - rows[at, 1], "offset": rows[at, 3]})


def pack(
    docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    A document is its tokens and one end token; a null text is empty and one token long.
    Longer ones than ``capacity`` are cut, the first piece taking the remainder. Repeated
    rows are documents of their own. ``tokenizer`` is a file of the tokenizers library that
    all executors see, ``ranks`` the same vocabulary for tiktoken, if there is one; by
    default the public byte-level one.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer, ranks = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
    path, ranks = str(tokenizer), ranks and str(ranks)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(texts.mapInArrow(lambda batches: pieces_of(batches, path, ranks, capacity), PIECES))
    # One row for each task and length.
    blocks = stored(pieces.groupBy("block", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = pieces.join(first, ["block", "length"]).withColumn("number", F.col("first") + F.col("place"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        lambda batches: placed(batches, rows), schema
    )
