"""Keeping and limiting scored records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftq.functions.formats import FORMATS, upper_label
from sftq.functions.loose import int_or_null, item, text_or_empty, truth
from sftq.functions.staging import once

DEFAULT_MIN_SCORE = 90  # fixed value: for each known format when no threshold is given

# Line numbers per chunk. Any number gives the same rows; the one chunk that a limit cuts is sorted.
CHUNK_ROWS = 65_536


def score_and_format(df: DataFrame, record: str = "record") -> DataFrame:
    """Add ``usable``, ``score`` and ``format`` (upper-cased only, aliases stay as they are).

    The score is 0 where it is missing or not an integer.
    """
    r, usable, score, label = F.col(record), F.col("_usable"), F.col("_score"), F.col("_label")
    return (
        df.withColumns(
            {
                "_usable": item(r, "evaluation.usable"),
                "_score": item(r, "evaluation.llm.score"),
                "_label": item(r, "output_format"),
            }
        )
        .withColumns(
            {
                "usable": once(truth(usable)),
                "score": once(F.coalesce(int_or_null(score), F.lit(0))),
                "format": once(upper_label(text_or_empty(label))),
            }
        )
        .drop("_usable", "_score", "_label")
    )


def format_thresholds(min_score: Mapping[str, int] | None = None) -> dict[str, int]:
    """Thresholds by upper-case label; every known format gets the default if none is given."""
    given = {str(k).strip().upper(): int(v) for k, v in (min_score or {}).items()}
    return given or dict.fromkeys(FORMATS, DEFAULT_MIN_SCORE)


def threshold(fmt: Column, min_score: Mapping[str, int] | None = None) -> Column:
    """The label's threshold, 0 for labels without one. A literal map: nothing to join."""
    pairs = [F.lit(x) for kv in format_thresholds(min_score).items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[fmt], F.lit(0))


def is_kept(
    usable: Column, score: Column, fmt: Column, min_score: Mapping[str, int] | None = None,
    require_usable_flag: bool = True,
) -> Column:
    enough = score >= threshold(fmt, min_score)
    return F.coalesce(usable, F.lit(False)) & enough if require_usable_flag else enough


def keep_filter(
    df: DataFrame, min_score: Mapping[str, int] | None = None, require_usable_flag: bool = True
) -> DataFrame:
    """Rows with the usable flag and enough score; a narrow filter."""
    kept = is_kept(F.col("usable"), F.col("score"), F.col("format"), min_score, require_usable_flag)
    return df.where(kept)


def filter_counts(df: DataFrame, kept: Column, shard: str = "rel_path") -> DataFrame:
    """Processed and kept rows per shard, and for all shards where the shard is null."""
    return (
        df.select(F.col(shard), kept.alias("_kept"))
        .rollup(shard)
        .agg(F.count(F.lit(1)).alias("processed"), F.count_if("_kept").alias("kept"))
    )


def _boundary(df: DataFrame, n: int, order: Sequence[str], within: Sequence[str]) -> DataFrame:
    """``_last``: position of the n-th row (or the last) of each group, for groups with rows.

    Counts the rows of each chunk, finds the one chunk that the limit cuts, and numbers
    only its rows. Chunks are runs of rows, one short row each once counted; their running
    sum is taken in one task for each group.
    """
    counts = df.groupBy(*within, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*within).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(n) - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    reached = counts.withColumn("_left", left).where("_left > 0")
    cut = reached.groupBy(*within).agg(F.max(F.struct("_chunk", "_left")).alias("_cut"))
    cut = cut.select(*[F.col(c).alias(f"_of_{c}") for c in within], "_cut.*").withColumnRenamed("_chunk", "_at")
    same = F.col("_chunk") == F.col("_at")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    number = F.row_number().over(Window.partitionBy(*within, "_chunk").orderBy(*order))
    rows = df.join(cut, same).withColumn("_n", number).where("_n <= _left")
    return rows.groupBy(*within).agg(F.max(F.struct(*order)).alias("_last"))


def first_rows(
    df: DataFrame, n: int, order: Sequence[str], chunk: Column, within: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows by ``order``, in each group of ``within``; ``n <= 0`` keeps all.

    ``order`` must tell rows of a group apart, and ``chunk`` must not decrease along it.
    The result is a filter by one position a group; no rows are gathered or sorted as a whole,
    and one plan serves every ``n``.
    """
    if n <= 0:
        return df
    position = df.select(*dict.fromkeys([*within, *order]), chunk.alias("_chunk"))
    last = _boundary(position, n, order, within)
    here = F.struct(*order)
    if not within:
        return df.where(here <= last.select("_last").scalar())
    last = last.select(*[F.col(c).alias(f"_of_{c}") for c in within], "_last")
    same = here <= F.col("_last")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return df.join(last, same, "left_semi")


def limit_global(
    df: DataFrame, n: int, path: str = "rel_path", line: Sequence[str] = ("line_no",),
    chunk: Column | None = None,
) -> DataFrame:
    """First ``n`` records in path and line order; ``n <= 0`` keeps all.

    Paths sort by their parts, so a directory comes before its longer-named sibling.
    ``chunk`` numbers runs of consecutive lines of one file (the block of a scanned
    file; by default 65,536 line numbers). Lines of a path must differ in ``line``.
    """
    if n <= 0:
        return df
    parts = F.split(path, "/")
    chunk = F.floor(F.col(line[0]) / CHUNK_ROWS) if chunk is None else chunk
    rows = first_rows(df.withColumn("_parts", parts), n, ["_parts", *line], F.struct(parts, chunk))
    return rows.drop("_parts")


def limit_per_dataset(
    df: DataFrame, n: int, dataset: str = "dataset", row: str = "i", chunk: Column | None = None
) -> DataFrame:
    """First ``n`` input rows of each dataset; ``n <= 0`` keeps all. Rows must differ in ``row``."""
    chunk = F.floor(F.col(row) / CHUNK_ROWS) if chunk is None else chunk
    return first_rows(df, n, [row], chunk, [dataset])
