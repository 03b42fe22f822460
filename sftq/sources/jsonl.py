"""Reading trees of JSONL shards."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftq.functions.staging import once
from sftq.functions.whitespace import strip
from sftq.operators.select import limit_global
from sftq.sources.scratch import written


def parse_records(df: DataFrame, raw: str = "raw", out: str = "record") -> DataFrame:
    """Add ``out``: one JSON object per text as VARIANT; anything malformed fails the job.

    The error names file and line if ``df`` has the columns of a scan. The text is wrapped as
    the first of two array items, so trailing text is noticed. The last of duplicate keys wins
    (a session setting of Spark's reader).
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text, pair = F.col(raw), F.col("_pair")
    items = F.concat(F.lit("["), text, F.lit(',"end"]'))
    # The second reader also takes NaN and Infinity.
    lenient = {"singleVariantColumn": "pair", "mode": "PERMISSIVE"}
    read = F.coalesce(F.try_parse_json(items), F.from_json(items, "pair variant", lenient)["pair"])
    whole = F.try_variant_get(pair, "$[1]", "string") == "end"
    place = []
    if "rel_path" in df.columns:
        place += [F.lit(" in "), F.coalesce("rel_path", F.lit("?"))]
    if "line_no" in df.columns:
        place += [F.lit(", line "), F.coalesce(F.col("line_no").cast("string"), F.lit("?"))]
    problem = F.raise_error(F.concat(F.lit("malformed record"), *place, F.lit(": "), F.substring(text, 1, 200)))
    found = F.variant_get(pair, "$[0]", "variant")
    record = F.when(whole, found).when(text.isNotNull(), problem.cast("variant"))
    return df.withColumn("_pair", read).withColumn(out, once(record)).drop("_pair")


_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)"


def resolved_root(spark: SparkSession, root: str) -> str:
    """The absolute path of a folder without its store, ``.`` and ``..`` resolved; no globs."""
    if re.search(r"[*?\[{]", root):
        raise ValueError(f"one folder is needed, not a pattern: {root}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return posixpath.normpath(re.sub(_STORE, "", store.makeQualified(hadoop).toString()))


def relative_path(file_path: Column, root: str) -> Column:
    """Path below the resolved ``root``, decoded; ``+`` is a plain character in paths."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    plain, below = F.regexp_replace(decoded, _STORE, ""), root.rstrip("/") + "/"
    outside = F.raise_error(F.concat(F.lit(f"not below {below}: "), plain)).cast("string")
    return F.when(plain.startswith(below), F.substr(plain, F.lit(len(below) + 1))).otherwise(outside)


def _text_lines(spark: SparkSession, root: str, glob: str, files: Sequence[str] | None) -> DataFrame:
    """``rel_path, block_start, id, value`` of all lines; ``id`` counts up within a block of a file."""
    below = resolved_root(spark, root)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if files is not None and not files:
        return spark.createDataFrame([], "rel_path string, block_start long, id long, value string")
    lines = reader.text(root) if files is None else spark.read.text([_literal(f) for f in files])
    return lines.select(
        relative_path(F.col("_metadata.file_path"), below).alias("rel_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _literal(path: str) -> str:
    """A path without characters that Spark would take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _numbered(lines: DataFrame) -> DataFrame:
    """``line_no`` from 1 at the top of each file, blank lines included.

    Lines are counted by block first; the blocks before a block give its first number. Both
    scans must cut the files alike, which fails the job if it does not hold.
    """
    counts = lines.groupBy("rel_path", "block_start").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    above = Window.partitionBy("rel_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    # Written first, so that the planner knows its size: lines are shuffled only if it is large.
    counts = written(counts.withColumn("before", F.coalesce(F.sum("size").over(above), F.lit(0))))
    numbered = lines.join(counts, ["rel_path", "block_start"], "left")
    number = F.col("id") - F.col("first")
    moved = F.raise_error(F.lit("the files were cut in other places while their lines were counted")).cast("long")
    line_no = F.when((number >= 0) & (number < F.col("size")), F.col("before") + number + 1).otherwise(moved)
    return numbered.withColumn("line_no", once(line_no)).drop("first", "size", "before", "id")


def scan_records(
    spark: SparkSession, root: str, parse: bool = True, glob: str = "*.jsonl",
    numbered: bool = True, files: Sequence[str] | None = None,
) -> DataFrame:
    """All non-blank lines of the files below ``root`` whose name fits ``glob``.

    ``rel_path, line_no`` order the records; ``line_no`` counts from 1 at the top of the file,
    blank lines included, and ``block_start`` tells the split of the file that holds the line.
    Numbering reads the lines twice. Unless ``numbered``, lines only count upwards within
    a split, and ``rel_path, block_start, line_no`` order them. ``raw`` keeps the line as it is and
    ``record`` is its parsed form. ``files`` are paths below ``root`` to read instead of all.
    """
    lines = _text_lines(spark, root, glob, files)
    lines = _numbered(lines) if numbered else lines.withColumnRenamed("id", "line_no")
    lines = lines.select("rel_path", "block_start", "line_no", strip(F.col("value")).alias("raw")).where("raw <> ''")
    return parse_records(lines) if parse else lines


def list_shards(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """``path, rel_path`` of the files that a scan lists, empty ones included; contents are not read.

    The names come from Spark's own file index, which is on the driver for any scan.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    names = spark.createDataFrame([(f,) for f in reader.text(root).inputFiles()], "uri string")
    path = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    return names.select(path.alias("path"), relative_path(F.col("uri"), resolved_root(spark, root)).alias("rel_path"))


def first_files(spark: SparkSession, root: str, n: int, glob: str = "*.jsonl", step: int = 4) -> list[str]:
    """Paths of the first files, in path order, that together hold ``n`` records, or all.

    Files are taken in growing steps and only the new ones are counted, so about as much is
    read as the limit needs. A step ends where the files so far suggest that it is enough.
    """
    parts = F.split("rel_path", "/")
    shards = list_shards(spark, root, glob).select("path", parts.alias("parts"))
    taken: list[str] = []
    last, found = None, 0
    while True:
        rest = shards if last is None else shards.where(F.col("parts") > F.array(*map(F.lit, last)))
        some = rest.orderBy("parts").limit(step).collect()
        if not some:
            return taken
        paths = [r["path"] for r in some]
        lines = scan_records(spark, root, parse=False, numbered=False, files=paths)
        counts = {r["rel_path"]: r["n"] for r in lines.groupBy("rel_path").agg(F.count("*").alias("n")).collect()}
        for r in some:
            taken.append(r["path"])
            found += counts.get("/".join(r["parts"]), 0)
            if found >= n:
                return taken
        last = some[-1]["parts"]
        # As many files as the records so far ask for, at most four times what was read.
        step = min(4 * len(taken), max(1, -(-(n - found) * len(taken) // found)) if found else 4 * len(taken))


def first_records(spark: SparkSession, root: str, n: int, parse: bool = True, glob: str = "*.jsonl") -> DataFrame:
    """The first ``n`` records of a scan, in path and line order, from no more files than needed."""
    if n <= 0:
        return scan_records(spark, root, parse, glob)
    rows = scan_records(spark, root, False, glob, files=first_files(spark, root, n, glob))
    rows = limit_global(rows, n, line=("block_start", "line_no"), chunk=F.col("block_start"))
    return parse_records(rows) if parse else rows


def scan_order() -> list[Column]:
    """The order of scanned records: path parts, then position in the file."""
    return [F.split("rel_path", "/"), F.col("block_start"), F.col("line_no")]
