"""Near-duplicate documents by SimHash fingerprints compared in tiles.

Distinct fingerprints are grouped by the numbers of one bits in their two halves. Two
fingerprints within ``radius`` bits differ by no more than ``radius`` in the sum of both
differences, so all other tile pairs are skipped; the rest are compared bit by bit.
The comparison is exact. Its work grows with the square of the number of distinct
fingerprints, thinned to about an eighth by the skipping.

* A null or wordless text has fingerprint zero and is linked like any other. Texts are taken whole.
* Of rows with one identifier the least text stays, so ties are settled; repeated rows are one.
* An empty table gives an empty result. Other columns come back as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import stored, whole_rows
from sftq.llm.components import components

SEED = 42
#: Fingerprints of a tile, on average at most.
TILE = 4096
#: Rows of one tile compared with a whole other tile at a time.
STRIP = 256
#: Tile pairs that one task compares, about.
PAIRS = 64


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 if it has no word.

    A bit is set if it is set in more than half the shingles' hashes.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-shingle] + 1].tolist()
    parts = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.uint16)
    set_bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """Fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(x, shingle) for x in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return prints(text.cast("binary"))


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a`` and ``b``; a label is the least linked place."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        np.minimum.at(label, np.maximum(la, lb)[differ], np.minimum(la, lb)[differ])
        while not np.array_equal(label, label[label]):
            label = label[label]


def tile_links(x: np.ndarray, y: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that links what pairs within ``radius`` link, as places in ``x`` then ``y``.

    ``y`` None compares ``x`` with itself. A group of n near copies gives n - 1 links.
    """
    other = x if y is None else y
    shift = 0 if y is None else len(x)
    label = np.arange(shift + len(other))
    for at in range(0, len(x), STRIP):
        near = np.bitwise_count(x[at : at + STRIP, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            label = _unite(label, i + at, j + shift)
    node = np.flatnonzero(label != np.arange(len(label)))
    return node, label[node]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows ``x, y, same`` of tile pairs to links ``v, u``."""
    for batch in batches:
        for x, y, same in zip(batch.column("x"), batch.column("y"), batch.column("same").to_pylist(), strict=True):
            x, y = (z.values.to_numpy().view(np.uint64) for z in (x, y))
            v, u = tile_links(x, None if same else y, radius)
            if len(v):
                every = (x if same else np.r_[x, y]).view(np.int64)
                yield pa.RecordBatch.from_pydict({"v": every[v], "u": every[u]})


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``v, u``: a forest over the distinct fingerprints ``fp`` with the components of all links."""
    halves = prints.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("p"),
        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("q"),
    )
    # At most 33 x 33 rows, whatever the input.
    cells = F.broadcast(halves.groupBy("p", "q").agg(F.ceil(F.count("*") / TILE).alias("tiles")))
    tiles = stored(
        halves.join(cells, ["p", "q"])
        .groupBy("p", "q", F.pmod(F.xxhash64("fp"), "tiles").alias("tile"))
        .agg(F.collect_list("fp").alias("prints"))
    )
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1) if i + abs(j) <= radius and (i, j) >= (0, 0)]
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    # Pairs are made of tile numbers alone and dealt by both, so those of a full cell are many tasks'.
    number = F.struct("p", "q", "tile")
    left = tiles.select(number.alias("left"), "tile", step.alias("s"), "p", "q").select(
        "left",
        F.col("tile").alias("other"),
        (F.col("p") + F.col("s.i")).alias("p"),
        (F.col("q") + F.col("s.j")).alias("q"),
        ((F.col("s.i") == 0) & (F.col("s.j") == 0)).alias("own"),
    )
    pairs = left.join(tiles.select("p", "q", "tile", number.alias("right")), ["p", "q"]).where("not own or other <= tile")
    pairs = stored(pairs.select("left", "right", F.expr("own and other = tile").alias("same")))
    tasks = -(-pairs.count() // PAIRS) or 1
    fetched = lambda side, name: tiles.select(number.alias(side), F.col("prints").alias(name))
    pairs = pairs.join(fetched("left", "x"), "left").join(fetched("right", "y"), "right")
    pairs = pairs.repartition(tasks, "left", "right").select("x", "y", "same")
    return pairs.mapInArrow(lambda batches: _compare(batches, radius), "v long, u long")


def groups(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``fp, component_id, winner`` for every distinct fingerprint of ``doc_id, fp``.

    ``component_id`` is the smallest identifier in the component (null if all are null);
    ``winner`` marks the one fingerprint of a component that carries it.
    """
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = components(links(distinct, radius)).select(F.col("v").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = F.min(F.struct(F.isnull("rep").alias("none"), "rep", "fp"))
    heads = rooted.groupBy("root").agg(best.alias("best"))
    return rooted.join(heads, "root").select(
        "fp", F.col("best.rep").alias("component_id"), (F.col("fp") == F.col("best.fp")).alias("winner")
    )


def clusters(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    A null or wordless text has fingerprint zero and is linked like any other. Rows with a
    null identifier are linked too, but name no component. Repeated rows get equal results.
    """
    prints = stored(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")))
    found = prints.join(groups(prints, radius), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest identifier.

    Of several rows with this identifier and fingerprint, the least text stays.
    """
    text = F.coalesce("text", F.lit(""))
    keys = [F.xxhash64(text).alias("k1"), F.hash(F.lit(1), text).alias("k2")]
    prints = stored(docs.select("doc_id", *keys, fingerprint_column(F.col("text"), shingle).alias("fp")))
    heads = groups(prints, radius).where("winner").select("fp", F.col("component_id").alias("head"))
    # The fingerprints are not made again: winners are found by identifier and a hash of the text,
    # so rows of a large group do not meet, and no other row has a partner.
    won = prints.join(heads, "fp").where(F.col("doc_id").eqNullSafe(F.col("head")))
    won = stored(won.select(F.col("doc_id").alias("head"), "k1", "k2", "fp").distinct())
    rows = whole_rows(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    rows = rows.select("row", "doc_id", *keys)
    same = F.expr("rows.k1 = won.k1 AND rows.k2 = won.k2 AND rows.doc_id <=> won.head")
    met = rows.alias("rows").join(won.alias("won"), same).select("row", "fp")
    order = Window.partitionBy("fp").orderBy("row.text")
    return met.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
