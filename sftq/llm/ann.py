"""Nearest neighbours by inner product: a block matrix join of queries and candidates.

Queries and candidates are dealt to a grid of cells. In a cell, blocks of both are
quantised to int8 and multiplied tile by tile. Each product comes with a bound of its
error, from the exact lengths of what quantisation cut off. Pairs whose upper bound
reaches the k-th best lower bound of their query are recomputed in double precision and
kept in one heap a query. The heaps of all cells are merged at the end. The result is
exact: no true neighbour can be lost.

* Null, zero and non-finite vectors, and rows without id, take no part; ties go to the smaller id;
  repeated rows count once. An empty table, or one without sound vectors, gives an empty result.
* Vectors of any length are compared whole, with those of their length. Other columns are not read.
* Squares of components must stay within doubles: lengths near 1e150 and beyond lose their bounds.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftq.llm.common import stored

K, EVERY = 20, 20
#: Rows of a cell, on average, and of a tile: they bound a task's memory.
CELL_QUERIES, CELL_CANDIDATES, TILE = 2048, 16384, 2048
#: Integers below 2**24 are exact in single precision: so many products of two int8 are summed at a time.
EXACT_DIMS = 1024


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, length of the coded vector, length of the remainder, by row.

    Lengths are rounded up a little, so that bounds built from them hold in floating point.
    """
    scale = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    up = 1 + 1e-9
    return codes, scale, np.linalg.norm(coded, axis=1) * up, np.linalg.norm(vectors - coded, axis=1) * up


def tile_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, by single-precision matrix products."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def distinct_vectors(ids: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` smallest ids of each group of equal vectors.

    Ties go to the smaller id, so no other copy can be among the nearest: a vector that
    stands in a third of all rows costs a tile no more than ``keep`` of its rows.
    """
    order = np.lexsort((ids, *vectors.T[::-1]))
    new = np.r_[True, (vectors[order[1:]] != vectors[order[:-1]]).any(axis=1)]
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return np.sort(order[np.arange(len(order)) - start < keep])


def nearest_in_cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """``(query, candidate, score)`` of the best ``k`` for each query, own id left out."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    floor = np.full(len(query_ids), -np.inf)
    take = distinct_vectors(ids, vectors, k + 1)
    ids, vectors = ids[take], vectors[take]
    q_codes, q_scale, q_coded, q_rest = quantised(queries)
    q_length = np.linalg.norm(queries, axis=1) * (1 + 1e-9)
    for at in range(0, len(ids), TILE):
        own, block = ids[at : at + TILE], vectors[at : at + TILE]
        codes, scale, coded, rest = quantised(block)
        near = tile_products(q_codes, codes) * q_scale[:, None] * scale[None, :]
        # x.y = cx.cy + rx.cy + x.ry, by the lengths of codes and remainders; and rounding.
        error = q_rest[:, None] * coded[None, :] + q_length[:, None] * rest[None, :]
        error += 1e-12 * q_coded[:, None] * coded[None, :] + 1e-300
        near[query_ids[:, None] == own[None, :]] = -np.inf
        if len(own) > k:
            floor = np.maximum(floor, np.partition(near - error, len(own) - k, axis=1)[:, len(own) - k])
        i, j = np.nonzero((near + error >= floor[:, None]) & (near > -np.inf))
        for part in range(0, len(i), 1 << 16):
            qi, cj = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
            scores = exact_products(queries[qi], block[cj])
            for q, score, other in zip(qi.tolist(), scores.tolist(), own[cj].tolist(), strict=True):
                heap = heaps[q]
                if len(heap) < k:
                    heapq.heappush(heap, (score, -other))
                elif (score, -other) > heap[0]:
                    heapq.heapreplace(heap, (score, -other))
        full = [n for n, heap in enumerate(heaps) if len(heap) == k]
        floor[full] = np.maximum(floor[full], [heaps[n][0][0] for n in full])
    return [(q, -other, score) for q, heap in zip(query_ids.tolist(), heaps, strict=True) for score, other in heap]


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = table.column("v").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return table.column("vec_id").to_numpy(), flat.reshape(table.num_rows, -1)


def _cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    rows: list = []
    if queries.num_rows and candidates.num_rows:
        rows = nearest_in_cell(*_matrix(queries), *_matrix(candidates), k)
    kinds = (pa.int64(), pa.int64(), pa.float64())
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, kinds, strict=True)})


def sound(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, v``: rows that take part, one for each id."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.max(v).alias("v"))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every ``every``-th id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows without id. Only vectors of the same length are compared. Ties go to the smaller
    ``vec_id``. Repeated rows count once; of several vectors with one id the greatest, compared
    component by component, counts.
    """
    rows = stored(sound(vectors))
    n = rows.count()
    across, down = max(1, -(-n // CELL_CANDIDATES)), max(1, -(-n // every // CELL_QUERIES))
    row = F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int").alias("row")
    column = F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int").alias("column")
    lines = [F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(c) for m, c in ((across, "column"), (down, "row"))]
    size = F.size("v").alias("size")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v", size, row, lines[0])
    others = rows.select("vec_id", "v", size, column, lines[1])
    cell = ("size", "row", "column")
    found = queries.groupBy(*cell).cogroup(others.groupBy(*cell)).applyInArrow(
        lambda a, b: _cell(a, b, k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH sound AS (
  SELECT vec_id, max(embedding::DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
  GROUP BY vec_id
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM sound q JOIN sound c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 20
"""
