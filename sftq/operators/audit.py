"""Audit reports: escape patterns, TOML structure, task statistics."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftq.functions.whitespace import BLANK, SPACE, strip
from sftq.operators.records import PAIRED
from sftq.operators.select import CHUNK_ROWS, first_rows

# What is counted per format, as plain text...
ESCAPE_TEXTS = {
    "XML": {
        "xml_amp": "&amp;",
        "xml_lt": "&lt;",
        "xml_gt": "&gt;",
        "xml_quot": "&quot;",
        "xml_apos": "&apos;",
        "xml_cdata": "<![CDATA[",
    },
    "JSON": {
        "json_escaped_quote": r"\"",
        "json_escaped_backslash": r"\\",
        "json_escaped_slash": r"\/",
        "json_escape_b": r"\b",
        "json_escape_f": r"\f",
        "json_escape_n": r"\n",
        "json_escape_r": r"\r",
        "json_escape_t": r"\t",
    },
    "TOML": {
        "toml_escaped_quote": r"\"",
        "toml_escaped_backslash": r"\\",
        "toml_escape_b": r"\b",
        "toml_escape_t": r"\t",
        "toml_escape_n": r"\n",
        "toml_escape_f": r"\f",
        "toml_escape_r": r"\r",
    },
    "YAML": {
        "yaml_escaped_quote": r"\"",
        "yaml_escaped_backslash": r"\\",
        "yaml_escape_n": r"\n",
        "yaml_escape_t": r"\t",
        "yaml_escape_r": r"\r",
        "yaml_single_quote_doubled": "''",
    },
    "CSV": {"csv_quote_doubled": '""'},
}

# ... and as patterns (Java).
ESCAPE_PATTERNS = {
    "XML": {
        "xml_num_dec": r"&#\p{Nd}+;",
        "xml_num_hex": r"&#x[0-9A-Fa-f]+;",
        "xml_bare_amp": r"&(?!amp;|lt;|gt;|quot;|apos;|#\p{Nd}+;|#x[0-9A-Fa-f]+;)",
    },
    "JSON": {
        "json_escape_u": r"\\u[0-9A-Fa-f]{4}",
        "json_raw_control_char": r"[\x00-\x1F]",
    },
    "TOML": {
        "toml_escape_u": r"\\u[0-9A-Fa-f]{4}",
        "toml_escape_U": r"\\U[0-9A-Fa-f]{8}",
    },
    "YAML": {
        "yaml_escape_u": r"\\u[0-9A-Fa-f]{4}",
        "yaml_escape_U": r"\\U[0-9A-Fa-f]{8}",
        "yaml_escape_x": r"\\x[0-9A-Fa-f]{2}",
    },
    "CSV": {"csv_quoted_newline": r'"[^"\n]*+\n[^"]*+"'},
}

# Counts that come from the inline-table scan, and the label for other formats.
INLINE_TABLE_TYPES = {
    "toml_inline_table": "total",
    "toml_inline_table_after_eq": "after_eq",
    "toml_inline_table_in_array": "in_array",
}
NO_CHECKS = "__no_escape_checks_defined__"
SAMPLE_ROWS, EXCERPT_CHARS = 2000, 2000

CHECKED_TYPES = {
    fmt: sorted([*ESCAPE_TEXTS[fmt], *ESCAPE_PATTERNS[fmt], *(INLINE_TABLE_TYPES if fmt == "TOML" else ())])
    for fmt in ESCAPE_TEXTS
}

INLINE_COUNTS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("total", "after_eq", "in_array")])
STRUCTURE_FIELDS = (
    "array_table_headers",
    "array_table_headers_with_dot",
    "table_headers",
    "max_header_depth",
    "child_tables_under_array",
)

_TOML_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)|\'[^\']*(?:\'|\Z)|[{}]', re.DOTALL)


def count_text(text: Column, found: str) -> Column:
    """Non-overlapping occurrences of a fixed ASCII text: bytes lost by removing it."""
    rest = F.replace(text, F.lit(found), F.lit(""))
    return ((F.octet_length(text) - F.octet_length(rest)) / len(found)).cast("int")


#: What holds all that is counted, so a text is read once: a run of backslashes with what follows it, a run
#: of quotes, an ampersand with its entity. Runs stay whole: pairs within them are counted as in the text.
_AFTER_BACKSLASHES = r"u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2}"
ESCAPE_TOKENS = {
    "XML": r"&(?:amp;|lt;|gt;|quot;|apos;|#\p{Nd}++;|#x[0-9A-Fa-f]++;)?+|<!\[CDATA\[",
    "JSON": rf"\\++(?:{_AFTER_BACKSLASHES}|[^\\])?+",
    "TOML": rf"\\++(?:{_AFTER_BACKSLASHES}|[^\\])?+",
    "YAML": rf"\\++(?:{_AFTER_BACKSLASHES}|'++|[^\\'])?+|'{{2,}}+",
    "CSV": '"{2,}+',
}
#: These are not made of such tokens, and are counted in the text itself.
COUNTED_IN_TEXT = ("json_raw_control_char", "csv_quoted_newline")


def with_counts(text: Column, fmt: str, result: Callable[[dict[str, Column]], Column]) -> Column:
    """``result`` of the counts by escape type of one format, each computed once.

    What a lambda gets is an element of an array, which is computed once; an expression is
    computed wherever it is read.
    """
    tokens = F.array_join(F.regexp_extract_all(text, F.lit(ESCAPE_TOKENS[fmt]), F.lit(0)), "\n")

    def counted(own: Column) -> Column:
        # The tokens of most texts are few, so counting them costs little beside finding them.
        counts = {name: count_text(own["tokens"], found) for name, found in ESCAPE_TEXTS[fmt].items()}
        for name, pattern in ESCAPE_PATTERNS[fmt].items():
            counts[name] = F.regexp_count(own["text" if name in COUNTED_IN_TEXT else "tokens"], F.lit(pattern))
        return result(counts)

    return F.get(F.transform(F.array(F.struct(text.alias("text"), tokens.alias("tokens"))), counted), F.lit(0))


def escape_counts(text: Column, fmt: str) -> dict[str, Column]:
    """Occurrences per checked escape type of one format (without TOML inline tables)."""
    names = [*ESCAPE_TEXTS[fmt], *ESCAPE_PATTERNS[fmt]]
    every = with_counts(text, fmt, lambda counts: F.array(*[counts[name] for name in names]))
    return {name: F.get(every, F.lit(i)) for i, name in enumerate(names)}


def _inline_table_counts(payload: str) -> tuple[int, int, int]:
    total = after_eq = in_array = 0
    open_braces: list[int] = []
    for token in _TOML_TOKEN.finditer(payload):
        brace = token.group()
        if brace == "{":
            open_braces.append(token.start())
        elif brace == "}" and open_braces:
            start = open_braces.pop()
            if payload.find("=", start, token.start()) < 0:
                continue
            total += 1
            before = start
            while before and payload[before - 1].isspace():
                before -= 1
            lead = payload[before - 1 : before]
            after_eq += lead == "="
            in_array += lead in ("[", ",")
    return total, after_eq, in_array


@F.arrow_udf(INLINE_COUNTS)
def _toml_inline_tables(payload: pa.Array) -> pa.Array:
    rows = [(None,) * 3 if p is None else _inline_table_counts(p) for p in payload.to_pylist()]
    columns = [pa.array(c, pa.int32()) for c in zip(*rows)] if rows else [pa.array([], pa.int32())] * 3
    return pa.StructArray.from_arrays(columns, ["total", "after_eq", "in_array"])


#: Strings; equals signs, and what leads to an opening brace, with that brace; braces.
_INLINE_TOKENS = (
    r"""(?s)"(?:[^"\\]++|\\.)*+(?:"|\\?\z)|'[^']*+(?:'|\z)"""
    rf"|=(?:{SPACE}*+\{{)?+|[\[,]{SPACE}*+\{{|\{{|\}}"
)
#: Open braces that the state holds; texts that nest deeper go to Python.
MOST_OPEN = 64
#: An open brace in the state: whether an equals sign came since, and what led to it.
_SEEN_EQ, _AFTER_EQ, _IN_ARRAY = 1, 2, 4


def inline_fold(payload: Column) -> Column:
    """``STRUCT<counts, deep>``: inline tables by a fold over tokens with a stack of open braces.

    ``counts`` is null for texts without braces or equals signs, and for ``deep`` ones, which
    nest more than ``MOST_OPEN`` braces.
    """

    def top(stack: Column) -> Column:
        return F.get(stack, F.size(stack) - 1)

    def below(stack: Column) -> Column:
        return F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))

    def marked(stack: Column) -> Column:
        fresh = top(stack).bitwiseAND(_SEEN_EQ) == 0  # null for an empty stack
        return F.when(fresh, F.concat(below(stack), F.array(top(stack).bitwiseOR(_SEEN_EQ)))).otherwise(stack)

    def state(stack: Column, seen: Column, counted: Column | None = None, frame: Column | None = None) -> Column:
        add = lambda name, bit: seen[name] if counted is None else seen[name] + (counted & (frame.bitwiseAND(bit) != 0)).cast("int")
        total = seen["total"] if counted is None else seen["total"] + counted.cast("int")
        return F.struct(
            stack.alias("stack"), total.alias("total"), add("after_eq", _AFTER_EQ).alias("after_eq"), add("in_array", _IN_ARRAY).alias("in_array"),
            (seen["deep"] | (F.size(stack) > MOST_OPEN)).alias("deep"),
        )

    def step(seen: Column, token: Column) -> Column:
        stack, first = seen["stack"], F.left(token, F.lit(1))
        quoted = first.isin('"', "'")
        equals = (first == "=") | (quoted & token.contains("="))
        noted = F.when(equals, marked(stack)).otherwise(stack)
        lead = F.when(first == "=", _AFTER_EQ).when(first.isin("[", ","), _IN_ARRAY).otherwise(0)
        counted = F.coalesce(top(stack).bitwiseAND(_SEEN_EQ) != 0, F.lit(False))
        # A sign within an inner table is one within the outer table too.
        closed = F.when(counted, marked(below(stack))).otherwise(below(stack))
        return (
            F.when(seen["deep"], seen)
            .when(token == "}", state(closed, seen, counted, F.coalesce(top(stack), F.lit(0))))
            .when(~quoted & token.endswith("{"), state(F.concat(noted, F.array(lead)), seen))
            .otherwise(state(noted, seen))
        )

    zero = F.struct(F.array().cast("array<int>").alias("stack"), *[F.lit(0).alias(f.name) for f in INLINE_COUNTS], F.lit(False).alias("deep"))
    counts = lambda seen: F.struct(*[seen[f.name].alias(f.name) for f in INLINE_COUNTS])
    finish = lambda seen: F.struct(F.when(~seen["deep"], counts(seen)).alias("counts"), seen["deep"].alias("deep"))
    tokens = F.regexp_extract_all(payload, F.lit(_INLINE_TOKENS), F.lit(0))
    return F.when(payload.contains("{") & payload.contains("="), F.aggregate(tokens, zero, step, finish))


def inline_tables_of(payload: Column, fold: Column) -> Column:
    """The counts of a fold; the few texts that were too deep for it are scanned in Python."""
    return F.coalesce(fold["counts"], _toml_inline_tables(F.when(fold["deep"], payload)))


def toml_inline_tables(payload: Column) -> Column:
    """Inline tables outside strings: all, after ``=``, as array items. Null if there are none."""
    return inline_tables_of(payload, inline_fold(payload))


def _any_json(texts: list[str] | None) -> bool:
    for text in texts or ():
        try:
            json.loads(text)
        except Exception:  # not JSON: look at the next string
            continue
        return True
    return False


@F.arrow_udf(T.BooleanType())
def any_json(texts: pa.Array) -> pa.Array:
    return pa.array([_any_json(t) for t in texts.to_pylist()], pa.bool_())


@F.arrow_udf(T.StringType())
def six_decimals(rate: pa.Array) -> pa.Array:
    """C-style ``%.6f``: Java's formatter rounds ties the other way."""
    return pa.array([None if r is None else f"{r:.6f}" for r in rate.to_pylist()], pa.string())


def toml_json_candidates(payload: Column) -> Column:
    """Unescaped string contents that start like JSON; null when there are none."""
    long = F.regexp_extract_all(payload, F.lit(r'(?s)"""(.*?)"""'), F.lit(1))
    short = F.regexp_extract_all(payload, F.lit(r'"((?:[^"\\]++|\\.)*+)"'), F.lit(1))

    def plain(text: Column) -> Column:
        quotes = F.replace(text, F.lit(r"\""), F.lit('"'))
        return strip(F.replace(quotes, F.lit(r"\\"), F.lit("\\")))

    like_json = F.filter(
        F.transform(F.concat(long, short), plain), lambda s: s.startswith("{") | s.startswith("[")
    )
    has_open = payload.contains("{") | payload.contains("[")
    return F.when(has_open & payload.contains('"') & (F.size(like_json) > 0), like_json)


def toml_structure(lines: Column) -> Column:
    """Header counts of a TOML text (with unix line breaks): ``STRUCT`` of the five fields."""
    # Possessive, so a line is read once whatever it holds; blanks of the path go afterwards.
    header = rf"(?md)^{BLANK}*+\[(\[?[^\]\n]++)\]\]?{BLANK}*+$"

    def split(found: Column) -> Column:
        is_array = found.startswith("[") & (F.length(found) > 1)
        path = F.when(is_array, F.substr(found, F.lit(2))).otherwise(found)
        return F.struct(is_array.alias("is_array"), F.regexp_replace(path, SPACE, "").alias("path"))

    headers = F.transform(F.regexp_extract_all(lines, F.lit(header), F.lit(1)), split)

    def step(seen: Column, h: Column) -> Column:
        is_array, path = h["is_array"], h["path"]
        depth = F.size(F.filter(F.split(path, r"\."), lambda part: part != ""))
        child = ~is_array & (seen["last"] != "") & path.startswith(F.concat(seen["last"], F.lit(".")))
        as_int = lambda flag: flag.cast("int")
        return F.struct(
            (seen["array_table_headers"] + as_int(is_array)).alias("array_table_headers"),
            (seen["array_table_headers_with_dot"] + as_int(is_array & path.contains("."))).alias(
                "array_table_headers_with_dot"
            ),
            (seen["table_headers"] + as_int(~is_array)).alias("table_headers"),
            F.greatest(seen["max_header_depth"], depth).alias("max_header_depth"),
            (seen["child_tables_under_array"] + as_int(child)).alias("child_tables_under_array"),
            F.when(is_array, path).otherwise(seen["last"]).alias("last"),
        )

    zero = F.struct(*[F.lit(0).alias(f) for f in STRUCTURE_FIELDS], F.lit("").alias("last"))
    return F.aggregate(
        headers, zero, step, lambda seen: F.struct(*[seen[f].alias(f) for f in STRUCTURE_FIELDS])
    )


def escape_entries(fmt: Column, payload: Column, inline: Column) -> Column:
    """``ARRAY<STRUCT<escape_type, occurrences>>`` of every type checked for the row's format."""

    def entries(counts: dict[str, Column]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(name).alias("escape_type"), F.coalesce(n, F.lit(0)).alias("occurrences"))
                for name, n in counts.items()
            ]
        )

    chosen = F
    for name in ESCAPE_TEXTS:
        more = {t: inline[field] for t, field in INLINE_TABLE_TYPES.items()} if name == "TOML" else {}
        chosen = chosen.when(fmt == name, with_counts(payload, name, lambda counts, more=more: entries(counts | more)))
    return chosen


def escape_totals(df: DataFrame, entries: str = "escapes") -> DataFrame:
    """Per (dataset, format, type): examples and occurrences, of all and of usable rows.

    The empty type counts every record, so one pass over the texts serves both the
    totals and the types; only non-zero counts are aggregated.
    """
    record = F.array(F.struct(F.lit("").alias("escape_type"), F.lit(0).alias("occurrences")))
    usable = F.col("usable")
    return (
        df.select(
            "dataset",
            "format",
            "usable",
            F.inline(F.concat(record, F.coalesce(F.col(entries), F.slice(record, 1, 0)))),
        )
        .where("escape_type = '' OR occurrences > 0")
        .groupBy("dataset", "format", "escape_type")
        .agg(
            F.count(F.lit(1)).alias("examples_with_escape_total"),
            F.count_if(usable).alias("examples_with_escape_usable"),
            F.sum("occurrences").cast("bigint").alias("occurrences_total"),
            F.sum(F.when(usable, F.col("occurrences")).otherwise(0)).cast("bigint").alias(
                "occurrences_usable"
            ),
        )
    )


ESCAPE_MEASURES = (
    "examples_with_escape_total",
    "examples_with_escape_usable",
    "occurrences_total",
    "occurrences_usable",
)


def escape_stats(df: DataFrame, entries: str = "escapes") -> DataFrame:
    """Only the escape types that occur."""
    return escape_totals(df, entries).where("escape_type <> ''")


def escape_report(df: DataFrame, entries: str = "escapes") -> DataFrame:
    """One row per (dataset, format, checked type), zeros included, sorted."""
    checked = F
    for fmt, types in CHECKED_TYPES.items():
        checked = checked.when(F.col("format") == fmt, F.array(*map(F.lit, types)))
    found = F.map_from_entries(
        F.collect_list(  # at most one entry per checked type
            F.struct("escape_type", F.struct(*ESCAPE_MEASURES))
        )
    )
    measured = F.col("_found")[F.col("escape_type")]
    return (
        escape_totals(df, entries)
        .groupBy("dataset", "format")
        .agg(found.alias("_found"))
        .withColumn("_all", F.col("_found")[""])
        .withColumn("escape_type", F.explode(checked.otherwise(F.array(F.lit(NO_CHECKS)))))
        .select(
            "dataset",
            "format",
            "escape_type",
            F.col("_all.examples_with_escape_total").alias("examples_total"),
            F.col("_all.examples_with_escape_usable").alias("examples_usable"),
            *[F.coalesce(measured[m], F.lit(0)).alias(m) for m in ESCAPE_MEASURES],
        )
        .orderBy("dataset", "format", "escape_type")
    )


def toml_structure_stats(df: DataFrame) -> DataFrame:
    """Per dataset averages of TOML structure; null measures where its first family has none.

    Needs ``dataset, family, usable, pos, structure, json_stringified_like`` of TOML rows.
    """
    paired = F.col("family") == PAIRED
    measures = {f"_{f}": F.sum(F.when(paired, F.col(f"structure.{f}"))) for f in STRUCTURE_FIELDS}
    measures["_max_header_depth"] = F.max(F.when(paired, F.col("structure.max_header_depth")))
    by_family = df.groupBy("dataset", "family").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("usable").alias("_usable"),
        F.min("pos").alias("_first"),
        F.count_if(paired & F.col("json_stringified_like")).alias("_json"),
        *[c.alias(n) for n, c in measures.items()],
    )
    first_family = F.min_by("family", "_first")
    totals = by_family.groupBy("dataset").agg(
        first_family.alias("family"),
        F.sum("_rows").alias("examples_total"),
        F.sum("_usable").alias("examples_usable"),
        F.sum("_json").alias("_json"),
        *[
            (F.max(n) if n == "_max_header_depth" else F.sum(n)).alias(n)
            for n in measures
        ],
    )
    known = F.col("family") == PAIRED
    average = lambda n: F.when(known, F.col(n) / F.col("examples_total"))
    return totals.select(
        "dataset",
        F.lit("TOML").alias("format"),
        "family",
        "examples_total",
        "examples_usable",
        average("_array_table_headers").alias("avg_array_table_headers"),
        average("_array_table_headers_with_dot").alias("avg_array_table_headers_with_dot"),
        average("_table_headers").alias("avg_table_headers"),
        F.when(known, F.col("_max_header_depth")).alias("max_header_depth_max"),
        average("_child_tables_under_array").alias("avg_child_tables_under_array"),
        F.when(known, F.col("_json")).alias("examples_with_json_stringified_like"),
        average("_json").alias("rate_json_stringified_like"),
    ).orderBy("dataset")


def inline_table_sample(df: DataFrame, rows: int = SAMPLE_ROWS, chars: int = EXCERPT_CHARS) -> DataFrame:
    """The first TOML rows with inline tables, with an excerpt of the payload.

    Needs ``dataset_pos, pos`` for the order and ``inline`` counts.
    """
    found = df.where((F.col("output_format") == "TOML") & (F.col("inline.total") > 0))
    chunk = F.struct("dataset_pos", F.floor(F.col("pos.i") / CHUNK_ROWS))
    return (
        first_rows(found, rows, ["dataset_pos", "pos"], chunk)
        .select(
            "dataset_pos",
            "pos",
            "dataset",
            "split",
            "idx",
            "task_key",
            "task_schema",
            "task_kind",
            F.col("inline.total").alias("inline_table_count"),
            F.col("inline.after_eq").alias("inline_table_after_eq"),
            F.col("inline.in_array").alias("inline_table_in_array"),
            F.substring("payload", 1, chars).alias("payload_excerpt"),
        )
        .orderBy("dataset_pos", "pos")
        .drop("dataset_pos", "pos")
    )


TASK_PARTS = ("family", "output_format", "task_kind", "task_schema")


def task_error_reasons(df: DataFrame) -> DataFrame:
    """Counts per (task, reason, dataset), the base of the task statistics.

    Needs ``task_key``, its parts, ``dataset, dataset_pos, pos, usable, reason``. One hash
    aggregation over numbers and short texts; reasons stay in rows, as there is no
    bound on how many distinct parser messages a task has.
    """
    return df.groupBy(
        "task_key", *TASK_PARTS, "dataset", "dataset_pos",
        F.when(F.col("usable"), F.lit(None)).otherwise(F.col("reason")).alias("reason"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
    )


def task_stats(df: DataFrame) -> DataFrame:
    """Per task: totals, usable rate, dataset list and most frequent error (ties: first seen)."""
    counts = task_error_reasons(df)
    same_reason = Window.partitionBy("task_key", "reason")
    ranked = counts.withColumns(
        {
            "_n": F.sum("rows").over(same_reason),
            "_first": F.min(F.struct("dataset_pos", "first_pos")).over(same_reason),
        }
    )
    is_error = F.col("reason").isNotNull()
    earlier = [-F.col(f"_first.{c}") for c in ("dataset_pos", "first_pos.i", "first_pos.j")]
    rank = F.struct("_n", *earlier)
    parts = F.max_by(F.struct(*TASK_PARTS), F.struct("dataset_pos", "last_pos"))
    return (
        ranked.groupBy("task_key")
        .agg(
            parts.alias("_parts"),
            F.sum("rows").alias("total"),
            F.coalesce(F.sum(F.when(is_error, F.col("rows"))), F.lit(0)).alias("errors"),
            F.array_join(F.array_sort(F.collect_set("dataset")), ";").alias("datasets"),
            F.coalesce(F.max_by("reason", F.when(is_error, rank)), F.lit("")).alias("top_error"),
        )
        .withColumn("usable", F.col("total") - F.col("errors"))
        .select(
            "task_key",
            *[F.col(f"_parts.{p}").alias(p) for p in TASK_PARTS],
            "total",
            "errors",
            "usable",
            six_decimals(F.col("usable") / F.col("total")).alias("usable_rate"),
            "datasets",
            "top_error",
        )
        .orderBy("output_format", "task_key")
    )


ROUTED = (
    "dataset", "split", "idx", "family", "task_key", "output_format", "task_kind", "task_schema",
)


def route_rows(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Rows with common columns and ``status`` (usable or errors) to write by."""
    ok = F.col("usable")
    return df.select(
        F.when(ok, "usable").otherwise("errors").alias("status"),
        *ROUTED,
        ok.alias("is_valid"),
        F.when(ok, "").otherwise(F.col("reason")).alias("error_reason"),
        messages,
    )
