"""Verdicts on URLs by host and path rules, as a sort-merge join of intervals.

A host is written with its labels reversed and a dot after each, ``org.example.``; then a
blank and the path. In this order all URLs that a rule fits under one host form an
interval, and the intervals of two rules are nested or apart. Every distinct host and path
appears once for each of its parent domains that carries rules, so rules on a domain reach its
subdomains. Keys are dealt to tasks by ranges, and each range starts with the rules that are
still open at its first key. A sweep over a range carries the rules that are open at the last
rule passed (its stack); those of them that still enclose the URL fit, and the innermost is the longest.

* A null URL, or one without ``://``, has an empty host and path and no rule. Repeated rows stay.
* Long URLs are judged whole. Of equally long rules that of the longer host wins, of equal rules a block.
* Empty tables of pages or rules give no rows, or the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftq.llm.common import lower_ascii, stored, whole_rows

#: Rules of the query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def keyed(labels: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """``domain, path, stack``: for each rule the rules that enclose it, itself included.

    Of rules with one host and path a block wins. Rules without a host or path, or with
    another verdict than allow and block, are left out. A stack is no longer than the path.
    """
    sound = rules.where("verdict in ('allow', 'block') and host <> '' and path is not null")
    sound = sound.groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    sound = sound.select("host", "path", "verdict", keyed(reversed_labels(F.col("host"))).alias("domain"))
    # Every prefix of a path that is itself a rule's path encloses it.
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.expr("path").substr(F.lit(1), n)))
    inner = sound.select("domain", F.col("path").alias("inner"), prefix.alias("path"))
    entry = F.struct(F.length("path").alias("size"), "path", F.concat("host", "path").alias("rule"), "verdict")
    met = inner.join(sound.select("domain", "path", entry.alias("entry")), ["domain", "path"])
    return met.groupBy("domain", F.col("inner").alias("path")).agg(F.sort_array(F.collect_list("entry")).alias("stack"))


def swept(probes: DataFrame, stacks: DataFrame) -> DataFrame:
    """``host, path, domain, open``: for each probe the stack of the last rule at or before it, null without one.

    Rules and probes are dealt together by ranges of their keys. Many hosts of one domain may have
    one path, so the host is part of the order. What is open where a range begins is the
    last stack of the ranges before it: one row a range.
    """
    stack = F.struct("domain", "stack").alias("open")
    none = F.lit(None)
    rules = stacks.select(none.cast("string").alias("host"), "domain", "path", stack)
    rows = rules.unionByName(probes.withColumn("open", none.cast(rules.schema["open"].dataType)))
    rows = rows.withColumns({"key": F.concat("domain", F.lit(" "), "path"), "kind": F.isnotnull("host")})
    # Of equal keys the rule comes first: it fits the URL. Written, so that ranges keep their numbers.
    order = ["key", "kind", "host"]
    rows = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    ends = rows.groupBy("range").agg(F.max_by("open", F.when(~F.col("kind"), F.col("key"))).alias("last"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = stored(ends.select("range", F.last("last", ignorenulls=True).over(earlier).alias("before")))
    upto = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    passed = F.coalesce(F.last("open", ignorenulls=True).over(upto), F.col("before"))
    return rows.join(ends, "range").withColumn("open", passed).where("kind").select("host", "path", "domain", "open")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` plus ``host, path, rule, verdict`` from ``url``.

    The longest rule that fits wins. Without one, ``rule`` is null and ``verdict`` is ``default``.
    Columns with these names are replaced.
    """
    rows = whole_rows(pages).select(
        "row", host_of(F.col("row.url")).alias("host"), path_of(F.col("row.url")).alias("path")
    )
    stacks = stored(rule_stacks(rules))
    labels = reversed_labels(F.col("host"))
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: keyed(F.slice(labels, F.lit(1), n)))
    probes = rows.where("host <> ''").select("host", "path").distinct().select("host", "path", F.explode(parents).alias("domain"))
    probes = probes.join(stacks.select("domain").distinct(), "domain", "left_semi")
    # The last rule may be another domain's, or have ended before the URL.
    inside = F.filter("open.stack", lambda e: F.col("path").startswith(e["path"]))
    hit = F.when((F.col("open.domain") == F.col("domain")) & (F.size(inside) > 0), F.element_at(inside, -1)).alias("hit")
    hits = swept(probes, stacks).select("host", "path", hit, F.length("domain").alias("depth")).where("hit is not null")
    longest = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("hit.rule").alias("size"), "depth", "hit.rule", "hit.verdict")).alias("best"))
    met = rows.join(stored(longest), ["host", "path"], "left")
    kept = [F.col("row")[c].alias(c) for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    verdict = F.coalesce("best.verdict", F.lit(default))
    return met.select(*kept, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


ORACLE = """
WITH rules(verdict, host, path) AS (VALUES %s),
urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS id
  FROM pages
),
best AS (
  SELECT u.id, max(struct_pack(size := length(r.host || r.path), depth := length(r.host), rule := r.host || r.path, verdict := r.verdict)) AS b
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.id
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM urls LEFT JOIN best USING (id)
""" % ", ".join(str(r) for r in RULES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rules_table(spark)).drop("url")
