"""Secret scans with a ledger of blobs, so that nothing is scanned twice.

Every version of a text is addressed by its content. A ledger folder records which blob was
scanned under which version of which rule, and what was found. A scan hashes all versions,
drops the pairs of blob and rule version that the ledger knows, reads one text for each
blob with pairs left, and joins the findings of all blobs back to every path that holds them.

The ledger has two append-only tables. ``findings`` is written before ``scanned``: a job that
dies between the two scans those blobs again, and readers take findings as a set.

* A null text is the empty blob. Repeated rows and copies share one scan, and each row is returned.
* Texts are scanned whole; every pattern takes time in proportion to the text.
* Spans of one kind never overlap, those of different kinds may. They are ordered by start, then
  by kind as listed in ``RULES``, so there are no ties.
* An empty table gives an empty result and leaves the ledger as it is.
* All columns but the text come back whatever they are named; ``blob`` and ``findings`` replace
  columns of these names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftq.llm.common import shared_folder, stored, whole_rows


class Rule(NamedTuple):
    """Matches of ``pattern``, leftmost and non-overlapping; short ones are dropped afterwards.

    A match counts if its ``group`` has ``least`` characters. Texts without ``quick`` have no
    match that counts, and are left alone. Raise ``version`` with any change.
    """

    kind: str
    version: int
    pattern: str
    quick: str
    group: int = 0
    least: int = 1


#: The three base patterns.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i:passw|secret|token|api_?key)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{24}", 0, 24),
)
#: Published shapes of private keys, tokens of two services, and logins in URLs.
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*", "PRIVATE KEY-----"),
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]+", r"gh[opsur]_[A-Za-z0-9]{36}", 0, 40),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]+", r"xox[abprs]-[A-Za-z0-9-]{10}", 0, 15),
    Rule("login", 1, r"://[A-Za-z0-9._~%+-]+:[^\x20\x09-\x0D/@]+@", "://"),
)
RULES = BASE + MORE

SCANNED = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, start int, stop int"


def blob_of(text: Column) -> Column:
    """The content address of a text: its SHA-256."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _opened(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """A table of the ledger, created empty where it is missing."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{ledger}/{name}")
    return spark.read.schema(schema).parquet(f"{ledger}/{name}")


def _gaps(text: Column, rule: Rule) -> Column:
    """For each match of a rule: its kind and number, characters before it since the last, its own, whether it counts.

    The matches and the text between them come from the same pattern, so lengths give places.
    """
    # Both lists are elements of an array, else the lambda would compute them for each match.
    lists = F.array(F.struct(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"), F.split(text, rule.pattern, -1).alias("between")))
    group = lambda m: F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m
    each = lambda s: F.transform(
        s["found"],
        lambda m, i: F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), i.alias("i"),
            F.length(F.get(s["between"], i)).alias("gap"), F.length(m).alias("n"), (F.length(group(m)) >= rule.least).alias("counts"),
        ),
    )
    return F.when(text.rlike(rule.quick), F.get(F.transform(lists, each), F.lit(0)))


def _todo(spark: SparkSession, paths: DataFrame, ledger: str, rules: Sequence[Rule]) -> DataFrame:
    """``blob, key, kinds``: one path for each blob with rules that it was not scanned under."""
    want = F.array(*[F.lit(r.kind) for r in rules])
    current = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    seen = _opened(spark, ledger, "scanned", SCANNED).where(current)
    seen = seen.groupBy("blob").agg(F.collect_set("kind").alias("done"))
    blobs = paths.groupBy("blob").agg(F.min("key").alias("key")).join(seen, "blob", "left")
    kinds = F.array_except(want, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.select("blob", "key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _scan(texts: DataFrame, todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, kinds, gaps`` of the blobs to be scanned, under the rules that are left for each."""
    rows = texts.join(todo, ["blob", "key"])
    own = [F.when(F.array_contains("kinds", r.kind), _gaps(F.col("text"), r)) for r in rules]
    empty = F.array().cast("array<struct<kind:string,version:int,i:int,gap:int,n:int,counts:boolean>>")
    return rows.select("blob", "kinds", F.concat(*[F.coalesce(x, empty) for x in own]).alias("gaps"))


def _places(scans: DataFrame) -> DataFrame:
    """Findings with their places, by running sums over the matches of one kind of a blob."""
    rows = scans.select("blob", F.explode("gaps").alias("m")).select("blob", "m.*").distinct()
    upto = Window.partitionBy("blob", "kind").orderBy("i")
    stop = F.sum(F.col("gap") + F.col("n")).over(upto)
    placed = rows.select("blob", "kind", "version", "counts", (stop - F.col("n")).cast("int").alias("start"), stop.cast("int").alias("stop"))
    return placed.where("counts").drop("counts")


def scan(docs: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``blob`` and ``findings`` instead of the text; ``ledger`` is brought up to date.

    ``findings`` is an array of ``start, stop, kind`` in code points, stop exclusive. Rows that
    share ``path`` and text count as one version.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(blob_of(value).alias("blob"), F.xxhash64(F.col(f"`{path}`")).alias("key"), value.alias("text"))
    rows = whole_rows(docs.withColumn("blob", blob_of(value)), text, "findings")
    paths = stored(rows.select("row", F.col("row.blob").alias("blob"), F.xxhash64(F.col(f"row.`{path}`")).alias("key")))
    todo = stored(_todo(spark, paths, ledger, rules))
    scans = stored(_scan(keyed, todo, rules))
    _opened(spark, ledger, "findings", FINDINGS)
    _places(scans).write.mode("append").parquet(f"{ledger}/findings")
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    pairs = scans.select("blob", F.explode("kinds").alias("kind")).withColumn("version", versions[F.col("kind")])
    pairs.write.mode("append").parquet(f"{ledger}/scanned")
    known = spark.read.schema(FINDINGS).parquet(f"{ledger}/findings")
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    found = known.where(F.col("version") == versions[F.col("kind")])
    found = found.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", order[F.col("kind")].alias("no"), "stop", "kind"))).alias("findings"))
    joined = paths.drop("key").join(stored(found), "blob", "left")
    spans = F.transform("findings", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    none = F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    names = [f.name for f in paths.schema["row"].dataType.fields]
    return joined.select(*[F.col("row")[n].alias(n) for n in names], F.coalesce(spans, none).alias("findings"))


def digest(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Result of the query over ``doc_id, text``; a new ledger unless one is given."""
    out = scan(docs.select("doc_id", "text"), ledger or shared_folder(docs.sparkSession))
    base = F.filter("findings", lambda s: s["kind"].isin([r.kind for r in BASE]))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("findings")).alias("spans"),
    )


def _sql(rule: Rule, no: int) -> str:
    # RE2 folds letters beyond ASCII too, so both cases are spelled out.
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    pattern = rule.pattern.replace("(?i:password|passwd|secret|token|api_?key)", words).replace("'", "''")
    return f"""
SELECT r, {no} AS no, '{rule.kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS counted, unnest(regexp_extract_all(text, '{pattern}')) AS found,
  unnest(string_split_regex(text, '{pattern}')[:-2]) AS gap, generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS i, {rule.least} AS least
FROM docs"""


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_sql(rule, no) for no, rule in enumerate(RULES))}),
placed AS (SELECT *, sum(length(gap) + length(found)) OVER (PARTITION BY r, no ORDER BY i) AS stop FROM found),
shown AS (
  SELECT r, no, (stop - length(found))::INTEGER AS start, kind || ':' || (stop - length(found))::INTEGER || ':' || stop::INTEGER AS span
  FROM placed WHERE length(counted) >= least
),
united AS (
  SELECT r, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, no) FILTER (no < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, no) AS spans
  FROM shown GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN united USING (r)
"""
