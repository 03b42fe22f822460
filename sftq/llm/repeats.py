"""Removal of byte strings that occur more than once in a corpus.

Every string of ``width`` bytes that starts at two places is removed wherever it stands.
Three narrowing steps replace a sort of all suffixes; README gives the reason.

1. *Anchors.* Each window of ``width`` bytes is named by the least hash of the
   ``anchor``-byte strings inside it, the leftmost of equal ones. Equal windows have equal
   names at equal offsets. Neighbouring windows named by one place form a run, about one
   per ``(width - anchor) / 2`` bytes; no two of its windows are equal. A run is hashed as
   a whole. A name seen once cannot repeat; runs that repeat as a whole are
   done; runs that share only their name go on.
2. *Windows.* The windows of these runs, a few per cent of all, are hashed one by one and
   meet their equals in a shuffle by hash.
3. *Spans.* The repeated windows of a text are united into spans and cut out.

Rows that meet inside a task are settled there and leave one row for the shuffle, so a
passage that stands in a third of all documents reaches a reducer as a few rows per task.
Names and runs have 64-bit hashes of different rollers, windows 96 bits, texts 96 bits. Texts travel
compressed to the windows; the cut runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import batches_of, binary_list, hashed, stored

BATCH_BYTES = 1 << 19
#: Bytes of text whose runs are settled together before the shuffle.
SETTLE_BYTES = 1 << 23
#: Windows that are settled together.
SETTLE_WINDOWS = 1 << 17
RUNS = "a long, c long, k1 long, k2 int, lo int, n int, kind byte"
SPANS = "k1 long, k2 int, lo int, n int"
#: Kinds of a run on its way: one of its name in its task; one that stands for equal ones,
#: all settled; one that stands for several of the same name, all sent on to the windows.
SINGLE, SAME, MIXED = 0, 1, 2
#: Kinds of a span: windows known to be repeated; windows to check, or that others are checked against.
REPEATED, CHECK = -1, -2


class Roller:
    """Hashes of all substrings of a byte array by prefix sums modulo 2**64.

    The symbols are mixed numbers of ``gram`` neighbouring bytes. Sums of plain bytes would agree
    for texts of two letters whose differences cancel at every scale, as those of the Thue-Morse
    sequence do; those of mixed neighbours do not. Substrings are at least ``gram`` bytes long.
    """

    def __init__(self, seed: int, gram: int = 8):
        rng = np.random.default_rng(seed)
        self.gram, self.mask = gram, np.uint64((1 << 8 * gram) - 1)
        self.salt, self.first, self.second = (np.uint64(int(rng.integers(0, 2**63)) * 2 + 1) for _ in range(3))
        self.base = int(rng.integers(0, 2**63)) * 2 + 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.power) <= len(data):
            most = len(data) + (len(data) >> 2) + 1
            for name, base in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
                steps = np.full(most, base % 2**64, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        n = max(0, len(data) + 1 - self.gram)
        symbols = np.ndarray(n, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,)) & self.mask
        symbols ^= self.salt
        for factor in (self.first, self.second):
            symbols *= factor
            symbols ^= symbols >> np.uint64(31)
        symbols *= self.power[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols, out=self.sums[1:])

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return hashed((self.sums[hi + (1 - self.gram)] - self.sums[lo]) * self.inverse[lo])

    def all_of(self, width: int) -> np.ndarray:
        n = max(0, len(self.sums) + self.gram - 1 - width)
        grams = width + 1 - self.gram
        return hashed((self.sums[grams : grams + n] - self.sums[:n]) * self.inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs_of(texts: list[bytes], width: int, anchor: int, first: Roller, second: Roller):
    """``(text, name, hash, start in text, number of windows)`` of all runs."""
    kept = [i for i, x in enumerate(texts) if len(x) >= width]
    if not kept:
        return None
    data = np.frombuffer(b"".join(texts[i] for i in kept), np.uint8)
    length = np.array([len(texts[i]) for i in kept])
    end = np.cumsum(length)
    first.load(data)
    second.load(data)
    names = first.all_of(anchor)
    # The high half of the hash, then the place: the least is the leftmost of the least.
    ranked = names >> np.uint64(32) << np.uint64(32) | np.arange(len(names), dtype=np.uint64)
    leader = sliding_minimum(ranked, width - anchor + 1) & np.uint64(0xFFFFFFFF)
    text = np.repeat(np.arange(len(kept)), length)[: len(leader)]
    at = np.flatnonzero(np.arange(len(leader)) + width <= end[text])
    leader, text = leader[at].astype(np.int64), text[at]
    cut = np.flatnonzero(np.r_[True, leader[1:] != leader[:-1]])
    lo, hi = at[cut], at[np.r_[cut[1:] - 1, len(at) - 1]] + width
    text, name = text[cut], names[leader[cut]]
    # Runs of different numbers of windows differ, whatever their hashes.
    whole = second.between(lo, hi) ^ hashed((hi - lo).astype(np.uint64))
    return np.array(kept)[text], name, whole, lo - (end - length)[text], hi - lo - width + 1


def _neighbours(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row equals the row before it, and the row after it, in all ``keys``."""
    same = np.ones(max(0, len(keys[0]) - 1), bool)
    for key in keys:
        same &= key[1:] == key[:-1]
    return np.r_[False, same][: len(keys[0])], np.r_[same, False][: len(keys[0])]


def _table(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    out = {}
    for field, values in zip(names.split(", "), columns, strict=True):
        name, kind = field.split()
        kind = {"long": np.int64, "int": np.int32, "byte": np.int8}[kind]
        values = np.asarray(values)
        out[name] = values.view(np.int64) if values.dtype == np.uint64 else values.astype(kind)
    return pa.RecordBatch.from_pydict(out)


def _settle_runs(rows: list[np.ndarray]) -> pa.RecordBatch:
    """Runs of one task: one of each name to be compared with others, and settled ones as spans."""
    order = np.lexsort((rows[1], rows[0]))
    a, c, k1, k2, lo, n = (x[order] for x in rows)
    before, _ = _neighbours(a)
    same, _ = _neighbours(a, c)
    group = np.cumsum(~before) - 1
    several = np.bincount(group) > 1
    kind = np.where(several, np.where(np.bincount(group, ~same) == 1, SAME, MIXED), SINGLE)[group]
    sent, own = np.flatnonzero(~before), np.flatnonzero(several[group])
    take = np.r_[sent, own]
    # Settled rows are dealt by text, not by name.
    name = np.r_[a[sent].view(np.int64), k1[own]]
    kinds = np.r_[kind[sent], np.where(kind[own] == SAME, REPEATED, CHECK)]
    return _table(RUNS, name, c[take], k1[take], k2[take], lo[take], n[take], kinds)


def pieces(text: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """A long text in parts that share ``width - 1`` bytes, so that each window is in one part.

    A run that is cut has the same name in both parts; its windows are then compared one by one.
    """
    for at in range(0, max(1, len(text) - width + 1), BATCH_BYTES):
        yield at, text[at : at + BATCH_BYTES + width - 1]


def find_runs(batches: Iterator[pa.RecordBatch], width: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Rows ``text, k1, k2`` to runs."""
    first, second = (Roller(seed, min(8, anchor)) for seed in (1, 2))
    held, size = [], 0
    for batch in batches_of(batches, "text", BATCH_BYTES):
        own = [(row, at, part) for row, text in enumerate(binary_list(batch.column("text"))) for at, part in pieces(text, width)]
        k1, k2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2"))
        # Several parts only if they are those of one long text.
        for parts in [own] if own and own[-1][1] == 0 else [[x] for x in own]:
            found = runs_of([part for *_, part in parts], width, anchor, first, second)
            size += sum(len(part) for *_, part in parts)
            if found is not None:
                text, name, whole, start, n = found
                row, at = (np.array([x[k] for x in parts])[text] for k in (0, 1))
                held.append((name, whole, k1[row], k2[row], (start + at).astype(np.int32), n.astype(np.int32)))
            if size >= SETTLE_BYTES and held:
                yield _settle_runs([np.concatenate(x) for x in zip(*held, strict=True)])
                held, size = [], 0
    if held:
        yield _settle_runs([np.concatenate(x) for x in zip(*held, strict=True)])


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """Each batch with the row before it and the row after it: rows, first own row, end."""
    last = current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if current is not None:
            parts = [x for x in (last, current, batch.slice(0, 1)) if x is not None]
            start = 0 if last is None else 1
            yield pa.Table.from_batches(parts), start, start + current.num_rows
            last = current.slice(current.num_rows - 1)
        current = batch
    if current is not None:
        parts = [x for x in (last, current) if x is not None]
        start = 0 if last is None else 1
        yield pa.Table.from_batches(parts), start, start + current.num_rows


def _apart(batches: Iterator[pa.RecordBatch], settled: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows still to be compared; the others go to ``settled``."""
    for batch in batches:
        done = pa.compute.less(batch.column("kind"), 0)
        if pa.compute.any(done).as_py():
            settled.append(batch.filter(done))
            batch = batch.filter(pa.compute.invert(done))
        yield batch


def _arrays(table: pa.Table, names: str) -> list[np.ndarray]:
    return [table.column(x).to_numpy() for x in names.split()]


JUDGED = "k1 long, k2 int, lo int, n int, kind byte"


def judge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by name, mixed ones first, and hash to spans, by comparing neighbours."""
    settled: list[pa.RecordBatch] = []
    going_on = False
    for table, start, stop in _windowed(_apart(batches, settled)):
        a, c, k1, k2, lo, n, kind = _arrays(table, "a c k1 k2 lo n kind")
        before, after = _neighbours(a)
        same_before, same_after = _neighbours(a, c)
        equal = same_before | same_after
        repeated = (kind == SINGLE) & equal
        check = (kind == SINGLE) & ~equal & (before | after)
        # A repeated run meets others of its name: one of its class goes along for comparison.
        witness = (equal | (kind == SAME)) & ((before & ~same_before) | (after & ~same_after))
        # A mixed row hides runs that are still to be checked, also against classes equal to its own.
        group = np.cumsum(~before) - 1
        mixed = np.bincount(group, kind == MIXED) > 0
        mixed[0] |= going_on
        mixed = mixed[group]
        witness |= mixed & (~same_before | np.r_[False, kind[:-1] == MIXED])
        going_on = bool(mixed[stop - 1])
        for rows, what in ((repeated, REPEATED), (check | (witness & (kind != MIXED)), CHECK)):
            take = start + np.flatnonzero(rows[start:stop])
            if len(take):
                yield _table(JUDGED, k1[take], k2[take], lo[take], n[take], np.full(len(take), what))
        while settled:
            yield settled.pop().select(["k1", "k2", "lo", "n", "kind"])
    while settled:
        yield settled.pop().select(["k1", "k2", "lo", "n", "kind"])


WINDOWS = "h long, h2 int, k1 long, k2 int, lo int, n int, kind byte"


def _united(k1: np.ndarray, k2: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each text with touching ones joined."""
    order = np.lexsort((lo, k2, k1))
    k1, k2, lo, hi = (x[order] for x in (k1, k2, lo, lo + n))
    before, _ = _neighbours(k1, k2)
    text = np.cumsum(~before)
    reach = np.maximum.accumulate(hi.astype(np.int64) + (text << 32)) - (text << 32)
    head = np.flatnonzero(~before | np.r_[True, lo[1:] > reach[:-1]])
    stop = reach[np.r_[head[1:] - 1, len(lo) - 1]]
    return k1[head], k2[head], lo[head], stop - lo[head]


def _settle_windows(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    h, h2, k1, k2, lo = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((h2, h))
    h, h2, k1, k2, lo = (x[order] for x in (h, h2, k1, k2, lo))
    before, after = _neighbours(h, h2)
    sent, own = np.flatnonzero(~before), np.flatnonzero(before | after)
    yield _table(WINDOWS, h[sent], h2[sent], k1[sent], k2[sent], lo[sent], np.ones(len(sent)), np.where(after[sent], SAME, SINGLE))
    if len(own):
        k1, k2, lo, n = _united(k1[own], k2[own], lo[own], np.ones(len(own), np.int64))
        yield _table(WINDOWS, k1, np.zeros(len(k1)), k1, k2, lo, n, np.full(len(k1), REPEATED))


def find_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows ``zipped, k1, k2, spans`` to windows; equal ones of some leave one, and a settled span.

    One text is unpacked at a time and hashed in parts, so memory follows the longest text.
    """
    first, second = (Roller(seed, min(8, width)) for seed in (3, 4))
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for zipped, k1, k2, spans in zip(*(batch.column(x) for x in ("zipped", "k1", "k2", "spans")), strict=True):
            text, spans = unzipped(zipped.as_py()), spans.as_py()
            every, n = (np.array([s[x] for s in spans], np.int64) for x in ("lo", "n"))
            key = np.zeros(len(every), np.int64)
            for _, _, begin, count in zip(*(x.tolist() for x in _united(key, key, every, n)), strict=True):
                for at in range(begin, begin + count, SETTLE_WINDOWS):
                    most = min(SETTLE_WINDOWS, begin + count - at)
                    data = np.frombuffer(text, np.uint8, most + width - 1, at)
                    first.load(data)
                    second.load(data)
                    more = (second.all_of(width) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    held.append((first.all_of(width), more, np.full(most, k1.as_py()), np.full(most, k2.as_py(), np.int32), np.arange(at, at + most, dtype=np.int32)))
                    if sum(len(x[0]) for x in held) >= SETTLE_WINDOWS:
                        yield from _settle_windows(held)
                        held = []
    if held:
        yield from _settle_windows(held)


def judge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by hash to repeated spans."""
    settled: list[pa.RecordBatch] = []
    for table, start, stop in _windowed(_apart(batches, settled)):
        h, h2, k1, k2, lo, kind = _arrays(table, "h h2 k1 k2 lo kind")
        before, after = _neighbours(h, h2)
        take = start + np.flatnonzero(((kind == SINGLE) & (before | after))[start:stop])
        if len(take):
            yield _table(SPANS, *_united(k1[take], k2[take], lo[take], np.ones(len(take), np.int64)))
        while settled:
            yield settled.pop().select(["k1", "k2", "lo", "n"])
    while settled:
        yield settled.pop().select(["k1", "k2", "lo", "n"])


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans with touching ones of a batch joined, to shorten what is shuffled."""
    for batch in batches:
        if batch.num_rows:
            yield _table(SPANS, *_united(*(batch.column(x).to_numpy() for x in ("k1", "k2", "lo", "n"))))


def zip_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``text, k1, k2`` with the text compressed, some at a time."""
    pack = zstandard.ZstdCompressor()
    for batch in batches_of(batches, "text", BATCH_BYTES):
        zipped = pa.array([pack.compress(x) for x in binary_list(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), zipped], ["k1", "k2", "zipped"])


def unzipped(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def text_keys(text: Column) -> list[Column]:
    """Two hashes of a text; null and empty are alike."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.hash(F.lit(1), text).alias("k2")]


def repeated_spans(docs: DataFrame, width: int = 400, anchor: int = 256, text: str = "text") -> DataFrame:
    """``k1, k2, lo, n``: for each text with repeated windows, runs of their starts; some overlap.

    ``k1, k2`` are two hashes of the text: equal texts repeat in the same places.
    """
    keyed = docs.select(F.col(text).alias("text")).where(F.octet_length("text") >= width)
    keyed = keyed.select("text", *text_keys(F.col("text")))
    runs = keyed.mapInArrow(lambda batches: find_runs(batches, width, anchor), RUNS)
    spans = stored(runs.repartition("a").sortWithinPartitions("a", F.col("kind") != MIXED, "c").mapInArrow(judge_runs, JUDGED))
    todo = spans.where(F.col("kind") == CHECK).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    packed = keyed.mapInArrow(zip_texts, "k1 long, k2 int, zipped binary")
    windows = packed.join(todo, ["k1", "k2"]).mapInArrow(lambda batches: find_windows(batches, width), WINDOWS)
    late = windows.repartition("h").sortWithinPartitions("h", "h2").mapInArrow(judge_windows, SPANS)
    every = spans.where(F.col("kind") == REPEATED).drop("kind").unionByName(late)
    return every.mapInArrow(_unite, SPANS)


def removed_ranges(spans: DataFrame, width: int) -> DataFrame:
    """``k1, k2, ranges``: for each text the byte ranges ``a`` to ``b`` that the windows cover, united and in order."""
    rows = spans.select("k1", "k2", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + (width - 1)).alias("b"))
    text = Window.partitionBy("k1", "k2").orderBy("a", "b")
    reach = F.max("b").over(text.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", F.when(F.col("a") <= reach, 0).otherwise(1))
    rows = rows.withColumn("no", F.sum("opens").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    ranges = rows.groupBy("k1", "k2", "no").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return ranges.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("ranges"))


def remaining(data: Column, ranges: Column) -> Column:
    """The bytes of a binary column outside of ``ranges``."""
    size = F.octet_length(data)
    end = lambda i: F.coalesce(F.get(ranges, i)["a"], size)
    begin = lambda i: F.coalesce(F.get(ranges, i - 1)["b"], F.lit(0))
    # Joined as text of one character a byte: arrays of bytes have no join that copies once.
    part = lambda i: F.decode(F.substring(data, begin(i) + 1, end(i) - begin(i)), "ISO-8859-1")
    return F.encode(F.array_join(F.transform(F.sequence(F.lit(0), F.size(ranges)), part), ""), "ISO-8859-1")


def remove_repeats(docs: DataFrame, width: int = 400, anchor: int = 256, text: str = "text") -> DataFrame:
    """All rows of ``docs``, ``text`` replaced by what stays of it, and ``repeat_cut``.

    ``repeat_cut`` has ``n_bytes, n_removed, n_spans, kept``; ``kept`` is the remaining bytes,
    which need not be valid UTF-8. A null text counts as empty and comes back empty; shorter texts
    than ``width`` stay whole; repeated rows are copies of each other and lose all they share; a
    long text is worked on in parts. A string has no ties to break: every place of it goes. An empty
    table gives an empty result. Other columns stay as they are, whatever their names; only one
    named ``repeat_cut`` is replaced.
    """
    ranges = stored(removed_ranges(repeated_spans(docs, width, anchor, text), width))
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [c for c in docs.columns if c.lower() != "repeat_cut"]
    kept = [F.col(f"`{c}`") for c in names if c != text]
    rows = docs.select(F.struct(F.struct(*kept).alias("rest") if kept else F.lit(0).alias("rest")).alias("row"), value.alias("text"), *text_keys(value))
    out = rows.join(ranges, ["k1", "k2"], "left")
    data = F.col("text").cast("binary")
    stay = F.when(F.isnull("ranges"), data).otherwise(remaining(data, F.col("ranges")))
    lost = F.coalesce(F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"]), F.lit(0).cast("long"))
    count = F.when(F.isnull("ranges"), 0).otherwise(F.size("ranges")).cast("long")
    cut = F.struct(F.octet_length("text").cast("long").alias("n_bytes"), lost.alias("n_removed"), count.alias("n_spans"), stay.alias("kept"))
    out = out.select("row", cut.alias("repeat_cut"))
    back = [F.make_valid_utf8(F.col("repeat_cut.kept").cast("string")).alias(c) if c == text else F.col("row.rest")[c].alias(c) for c in names]
    return out.select(*back, "repeat_cut")


def digest(docs: DataFrame) -> DataFrame:
    """Result of the query over ``doc_id, text``."""
    out = remove_repeats(docs.select("doc_id", "text"))
    cut = F.col("repeat_cut")
    return out.select("doc_id", cut["n_bytes"].alias("n_bytes"), cut["n_removed"].alias("n_removed"), cut["n_spans"].alias("n_spans"), F.sha2(cut["kept"], 256).alias("kept_sha256"))
