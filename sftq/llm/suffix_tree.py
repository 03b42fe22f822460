"""Language-model scores by a probabilistic suffix tree.

Symbols are the bytes of a text's lower-cased words with one blank between them and one
end. Contexts are up to ``DEPTH`` bytes long. A context is a state of the tree if it is
frequent enough and its next-symbol distribution diverges enough from that of its longest
suffix in the tree. Its distribution is smoothed with that suffix's, down to the root.
Each symbol is scored by the longest suffix of its past that is a state.

All training texts are counted. A context must be seen ``LEAST`` times, whatever the size
of the corpus, and keeps all its entries. So the tree grows with the corpus, and it passes
through the driver to all tasks: nothing but ``DEPTH`` and the variety of the text bounds its
size there. The word counts behind the base score are joined instead.

* A null or empty text is one token, its end. Texts are counted and scored whole.
* Of contexts the longest counts, so there are no ties; repeated rows count as often as they stand.
* An empty table gives an empty result; without training texts every symbol is equally likely.
* Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftq.llm.common import batches_of, binary_list, fold, stored

DEPTH = 5
#: Times that a context must be seen.
LEAST = 2
#: Bits by which a context's own distribution must shorten the training text, for each of its entries.
GAIN_BITS = 4.0
#: Weight of the suffix's distribution for each kind of symbol seen after a context.
SMOOTHING = 3
FOLDS, HELD_OUT = 7, 2
BATCH_BYTES = 1 << 21
#: Bytes of text whose words are numbered together.
BLOCK_BYTES = 1 << 24
PAD = b"\n" * DEPTH


def symbols(words: list[bytes]) -> bytes:
    return PAD + b" ".join(words) + b"\n"


def codes_of(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol with its ``DEPTH`` predecessors as a number, and where each text starts."""
    data = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint64)
    n = len(data) - DEPTH
    codes = np.zeros(n, np.uint64)
    for i in range(DEPTH + 1):
        codes = codes << np.uint64(8) | data[i : i + n]
    length = np.array([len(b) for b in bodies])
    start = np.cumsum(length) - length
    inside = np.ones(n, bool)
    for i in range(DEPTH):
        inside[(start[1:] - DEPTH + i)] = False
    return codes[inside], start - DEPTH * np.arange(len(bodies))


def count_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``text`` to ``code, n``, summed over a task as far as memory is bounded."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        code = np.concatenate([h[0] for h in held])
        n = np.concatenate([h[1] for h in held])
        order = np.argsort(code)
        code, n = code[order], n[order]
        head = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        return code[head], np.add.reduceat(n, head)

    def out(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"code": code.view(np.int64), "n": n.astype(np.int64)})

    for batch in batches_of(batches, "text", BATCH_BYTES):
        bodies = [symbols(t.lower().split()) for t in binary_list(batch.column("text"))]
        held.append(np.unique(codes_of(bodies)[0], return_counts=True))
        if len(held) == 8:
            held[:] = [merged()]
            if len(held[0][0]) > 2_000_000:
                yield out(*held.pop())
    if held:
        yield out(*merged())


class Tree:
    """States by depth: sorted contexts with the share left to the suffix, and sorted entries."""

    def __init__(self, root: np.ndarray):
        self.root, self.levels = root, []

    def add(self, contexts: np.ndarray, rest: np.ndarray, entries: np.ndarray, shares: np.ndarray) -> None:
        self.levels.append((contexts, rest, entries, shares))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        """Of the last byte of each code after those before it."""
        p = self.root[(codes & np.uint64(255)).astype(np.int64)]
        for depth, (contexts, rest, entries, shares) in enumerate(self.levels, 1):
            if not len(contexts):
                continue
            entry = codes & np.uint64((1 << 8 * (depth + 1)) - 1)
            at = np.minimum(np.searchsorted(contexts, entry >> np.uint64(8)), len(contexts) - 1)
            met = np.flatnonzero(contexts[at] == entry >> np.uint64(8))
            p[met] *= rest[at[met]]
            at = np.minimum(np.searchsorted(entries, entry[met]), len(entries) - 1)
            hit = entries[at] == entry[met]
            p[met[hit]] += shares[at[hit]]
        return p


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    """A bounded table, sorted by its first column."""
    table = df.select(*names).toArrow()
    columns = [table.column(n).to_numpy() for n in names]
    order = np.argsort(columns[0].view(np.uint64))
    return [c[order] for c in columns]


def grow(training: DataFrame, least: float = LEAST, gain_bits: float = GAIN_BITS) -> Tree:
    """The tree of the texts of ``training`` (``text``)."""
    counted = training.select("text").mapInArrow(count_codes, "code long, n long")
    level = stored(counted.groupBy("code").agg(F.sum("n").alias("n")))
    tables = []
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            level = level.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))
            level = stored(level)
        context = F.shiftright("code", 8).alias("context")
        contexts = level.groupBy(context).agg(F.sum("n").alias("c"), F.count("*").alias("kinds")).where(F.col("c") >= least)
        tables.append((depth, _columns(contexts, "context", "c", "kinds"), _columns(level.join(contexts, context == F.col("context"), "left_semi") if depth else level, "code", "n")))
    tree = None
    for depth, (context, c, kinds), (code, n) in reversed(tables):
        code = code.view(np.uint64)
        if depth == 0:
            root = np.ones(256)
            root[code.astype(np.int64)] += n
            tree = Tree(root / root.sum())
            continue
        context = context.view(np.uint64)
        at = np.minimum(np.searchsorted(context, code >> np.uint64(8)), max(0, len(context) - 1))
        if not len(context):
            tree.add(context, np.zeros(0), code[:0], np.zeros(0))
            continue
        share = n / (c + SMOOTHING * kinds)[at]
        rest = 1 - np.bincount(at, share, len(context))
        parent = tree.probability(code)
        gain = np.bincount(at, n * np.log2((share + rest[at] * parent) / parent), len(context))
        keep = gain >= gain_bits * np.bincount(at, minlength=len(context)).clip(1)
        tree.add(context[keep], rest[keep], code[keep[at]], share[keep[at]])
    return tree


SCORED = "block long, number int, word binary, n long, doc_id long, held_out boolean, n_tokens long, score double, ids binary"


def score_texts(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    """Rows ``doc_id, held_out, text`` to scored documents and, a block at a time, its words.

    A document carries the numbers and counts of its words; a block's word carries its number
    and its count in the block's training documents. Word 0 is the end.
    """
    from pyspark import TaskContext

    task, blocks, size = TaskContext.get().partitionId(), 0, 0
    numbers: dict[bytes, int] = {b"\n": 0}
    trained: list[np.ndarray] = []
    pack = zstandard.ZstdCompressor()

    def words() -> pa.RecordBatch:
        n = np.bincount(np.concatenate([*trained, np.zeros(0, np.int64)]), minlength=len(numbers))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(numbers), block)), pa.array(np.arange(len(numbers), dtype=np.int32)), pa.array(list(numbers), pa.binary()), pa.array(n)]
            + [pa.nulls(len(numbers), k) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.binary())],
            [x.split()[0] for x in SCORED.split(", ")],
        )

    block = task << 24
    for batch in batches_of(batches, "text", BATCH_BYTES):
        split = [t.lower().split() for t in binary_list(batch.column("text"))]
        codes, start = codes_of([symbols(w) for w in split])
        place, distinct = pd.factorize(codes)
        score = np.add.reduceat(np.log10(tree.probability(distinct))[place], start)
        held, ids = batch.column("held_out").to_pylist(), []
        for own, out in zip(split, held, strict=True):
            number = np.array([0, *[numbers.setdefault(w, len(numbers)) for w in own]], np.int64)
            if not out:
                trained.append(number)
            kinds, counts = np.unique(number, return_counts=True)
            ids.append(pack.compress(np.r_[np.diff(kinds, prepend=0), counts].astype("<u4").tobytes()))
        rows = len(split)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows, block)), *[pa.nulls(rows, k) for k in (pa.int32(), pa.binary(), pa.int64())]]
            + [batch.column("doc_id"), batch.column("held_out"), pa.array([len(w) + 1 for w in split], pa.int64()), pa.array(score), pa.array(ids, pa.binary())],
            [x.split()[0] for x in SCORED.split(", ")],
        )
        size += sum(map(len, ids)) * 4
        if size >= BLOCK_BYTES:
            yield words()
            blocks, size, numbers, trained = blocks + 1, 0, {b"\n": 0}, []
            block = (task << 24) + blocks
    if len(numbers) > 1 or trained or size:
        yield words()


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def base_scores(docs: pa.Table, words: pa.Table, total: int, distinct: int) -> pa.Table:
    """Documents of one block with the corpus counts of the block's words."""
    c = np.zeros(words.num_rows, np.int64)
    c[words.column("number").to_numpy()] = words.column("c").to_numpy()
    value = np.log10((c + 1) / (total + distinct + 1))
    known, base = [], []
    unpack = zstandard.ZstdDecompressor()
    for ids in docs.column("ids").to_pylist():
        both = np.frombuffer(unpack.decompress(ids), "<u4").reshape(2, -1).astype(np.int64)
        kinds, counts = np.cumsum(both[0]), both[1]
        known.append(int(counts[c[kinds] > 0].sum()))
        base.append(float(np.dot(counts, value[kinds])))
    columns = {x: docs.column(x) for x in ("doc_id", "held_out", "n_tokens")}
    columns |= {"n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([total] * len(base), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": docs.column("score")}
    return pa.table(columns)


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Documents whose identifier's checksum leaves ``held_out`` are scored but not learned
    from; null identifiers count as remainder 0. A null text is empty: one token, the end.
    Repeated rows count as often as they stand. Without training texts every symbol is
    equally likely.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "text")
    tree = grow(rows.where("not held_out"))
    scored = stored(rows.mapInArrow(lambda batches: score_texts(batches, tree), SCORED))
    words = scored.where("word is not null").select("block", "number", "word", "n")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("c")))
    sums = counts.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    total, distinct = int(sums[0] or 0), int(sums[1])
    known = words.join(counts, "word").select("block", "number", "c").groupBy("block")
    texts = scored.where("word is null").select(F.col("block").alias("own"), "doc_id", "held_out", "n_tokens", "score", "ids").groupBy("own")
    return texts.cogroup(known).applyInArrow(lambda a, b: base_scores(a, b, total, distinct), RESULT)
