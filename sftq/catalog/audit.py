"""Queries on the audit reports."""

from pyspark.sql import functions as F

from sftq.catalog.registry import query
from sftq.functions.whitespace import unix_lines
from sftq.operators import audit as A
from sftq.plans.audit import audit_members, audit_records, measure_records
from sftq.sources.jsonl import parse_records as parsed


def audited(t):
    return audit_records(parsed(t.audit_raw))


def audited_toml(t):
    """The audit of TOML members only: the others are dropped before they are parsed."""
    return measure_records(audit_members(parsed(t.audit_raw)).where("output_format = 'TOML'"))


def escaped(t):
    """Payloads with their counts. The fixture's usable flag stands in for the verdict."""
    rows = t.escape_texts.withColumns(
        {"assistant_text": F.col("text"), "family": F.lit("u10bei"), "flag": F.col("usable")}
    )
    return measure_records(rows).withColumn("usable", F.col("flag"))


def _counted_sql(fmt):
    """One row per text and checked type: columns that differ in case only cannot be written."""
    counts = {
        name: f"(length(text) - length(replace(text, '{found.replace(chr(39), chr(39) * 2)}', ''))) // {len(found)}"
        for name, found in A.ESCAPE_TEXTS[fmt].items()
    }
    patterns = {name: p.replace(r"\p{Nd}", "[0-9]") for name, p in A.ESCAPE_PATTERNS[fmt].items()}
    # RE2 has neither lookahead nor possessive repeats.
    bare = patterns.pop("xml_bare_amp", None)
    if "csv_quoted_newline" in patterns:
        patterns["csv_quoted_newline"] = r'"[^"]*\n[^"]*"'
    counts |= {name: f"len(regexp_extract_all(text, '{p}'))" for name, p in patterns.items()}
    if bare:
        valid = "&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);"
        counts["xml_bare_amp"] = (
            "length(text) - length(replace(text, '&', '')) - "
            f"len(regexp_extract_all(text, '{valid}'))"
        )
    return " UNION ALL ".join(
        f"SELECT record_id, dataset, '{name}' AS escape_type, CAST({count} AS INT) AS occurrences "
        f"FROM $escape_texts e WHERE output_format = '{fmt}'"
        for name, count in counts.items()
    )


def _counts(fmt):
    def counts(t):
        rows = t.escape_texts.where(F.col("output_format") == fmt)
        entries = [
            F.struct(F.lit(name).alias("escape_type"), count.alias("occurrences"))
            for name, count in A.escape_counts(F.col("text"), fmt).items()
        ]
        return rows.select("record_id", "dataset", F.inline(F.array(*entries)))

    return counts


for _fmt in A.ESCAPE_TEXTS:
    query(f"escape_counts_{_fmt.lower()}", _counted_sql(_fmt))(_counts(_fmt))


@query(
    "toml_inline_tables",
    """SELECT record_id, 4 AS total, 2 AS after_eq, 2 AS in_array FROM $escape_texts e WHERE output_format = 'TOML'
       UNION ALL SELECT record_id + 1000000000, 1, 1, 0 FROM $sft_records r WHERE expect_format = 'TOML'""",
)
def toml_inline_tables(t):
    texts = t.escape_texts.where("output_format = 'TOML'").select("record_id", "text")
    payloads = t.sft_payloads.where("fmt = 'TOML'").select(F.col("doc_id") + 1000000000, "payload")
    counts = texts.union(payloads).withColumn("n", A.toml_inline_tables(F.col("text")))
    return counts.select("record_id", "n.total", "n.after_eq", "n.in_array")


@query(
    "toml_inline_tables_varied",
    """SELECT record_id, 2 * items + 2 * nested AS total, 2 * nested AS after_eq, 2 * items AS in_array FROM $toml_varied v
       WHERE items + nested > 0""",
)
def toml_inline_tables_varied(t):
    counts = t.toml_varied.where("items + nested > 0").withColumn("n", A.toml_inline_tables(F.col("text")))
    return counts.select("record_id", "n.total", "n.after_eq", "n.in_array")


@query(
    "toml_structure_varied",
    """SELECT record_id, arrays AS array_table_headers, CASE WHEN name = 'r.q' THEN arrays ELSE 0 END AS array_table_headers_with_dot,
         tables + CASE WHEN child THEN 1 ELSE 0 END AS table_headers,
         greatest(CASE WHEN tables > 0 THEN 2 ELSE 0 END, CASE WHEN arrays > 0 THEN CASE WHEN name = 'r.q' THEN 2 ELSE 1 END ELSE 0 END,
           CASE WHEN child THEN CASE WHEN name = 'r.q' THEN 3 ELSE 2 END ELSE 0 END) AS max_header_depth,
         CASE WHEN child AND arrays > 0 THEN 1 ELSE 0 END AS child_tables_under_array
       FROM $toml_varied v""",
)
def toml_structure_varied(t):
    return t.toml_varied.select("record_id", A.toml_structure(unix_lines(F.col("text"))).alias("s")).select("record_id", "s.*")


@query(
    "toml_structure",
    """SELECT record_id, 1 AS array_table_headers, 1 AS array_table_headers_with_dot, 1 AS table_headers, 3 AS max_header_depth,
         1 AS child_tables_under_array, true AS json_stringified_like
       FROM $sft_records r WHERE expect_format = 'TOML'""",
)
def toml_structure(t):
    payload = F.col("payload")
    rows = t.sft_payloads.where("fmt = 'TOML'").select(F.col("doc_id").alias("record_id"), "payload")
    rows = rows.withColumn("_strings", A.toml_json_candidates(payload)).withColumns(
        {"s": A.toml_structure(unix_lines(payload)), "json_stringified_like": A.any_json(F.col("_strings"))}
    )
    return rows.select("record_id", "s.*", "json_stringified_like")


_ESCAPE_LONG = " UNION ALL ".join(
    f"SELECT '{fmt}' AS format, escape_type, record_id, dataset, occurrences FROM ({_counted_sql(fmt)}) u"
    for fmt in A.ESCAPE_TEXTS
) + "".join(
    f" UNION ALL SELECT 'TOML', '{name}', record_id, dataset, {n} FROM $escape_texts e WHERE output_format = 'TOML'"
    for name, n in zip(A.INLINE_TABLE_TYPES, (4, 2, 2))
)
_ESCAPE_STATS = f"""SELECT l.dataset, format, escape_type, count(*) AS examples_with_escape_total, count(*) FILTER (WHERE usable) AS examples_with_escape_usable,
  CAST(sum(occurrences) AS BIGINT) AS occurrences_total, CAST(coalesce(sum(occurrences) FILTER (WHERE usable), 0) AS BIGINT) AS occurrences_usable
FROM ({_ESCAPE_LONG}) l JOIN $escape_texts t ON t.record_id = l.record_id AND t.dataset = l.dataset
WHERE occurrences > 0 GROUP BY ALL"""


@query("escape_stats", _ESCAPE_STATS)
def escape_stats(t):
    return A.escape_stats(escaped(t))


_CHECKED = ", ".join(
    f"('{fmt}', '{name}')" for fmt, names in [*A.CHECKED_TYPES.items(), ("INI", [A.NO_CHECKS])] for name in names
)


@query(
    "escape_report",
    f"""SELECT b.dataset, b.format, c.escape_type, examples_total, examples_usable,
          {', '.join(f'coalesce({m}, 0) AS {m}' for m in A.ESCAPE_MEASURES)}
        FROM (SELECT dataset, output_format AS format, count(*) AS examples_total, count(*) FILTER (WHERE usable) AS examples_usable
              FROM $escape_texts e GROUP BY ALL) b
        JOIN (VALUES {_CHECKED}) AS c(format, escape_type) ON c.format = b.format
        LEFT JOIN ({_ESCAPE_STATS}) s ON s.dataset = b.dataset AND s.format = b.format AND s.escape_type = c.escape_type""",
)
def escape_report(t):
    return A.escape_report(escaped(t))


# Each dataset's TOML records mix families; the first one decides (Q30).
@query(
    "toml_structure_stats",
    """SELECT dataset, 'TOML' AS format, arg_min(family, pos) AS family, count(*) AS examples_total, count(*) FILTER (WHERE usable) AS examples_usable,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') / count(*) END AS avg_array_table_headers,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') / count(*) END AS avg_array_table_headers_with_dot,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') / count(*) END AS avg_table_headers,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN 3 END AS max_header_depth_max,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') / count(*) END AS avg_child_tables_under_array,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') END AS examples_with_json_stringified_like,
         CASE WHEN arg_min(family, pos) = 'u10bei' THEN count(*) FILTER (WHERE family = 'u10bei') / count(*) END AS rate_json_stringified_like
       FROM $audit_expected e WHERE output_format = 'TOML' GROUP BY dataset""",
)
def toml_structure_stats(t):
    return A.toml_structure_stats(audited_toml(t))


@query(
    "inline_table_sample",
    """SELECT dataset, split, idx, task_key, task_schema, task_kind, 1 AS inline_table_count, 1 AS inline_table_after_eq, 0 AS inline_table_in_array,
         substr(payload, 1, 2000) AS payload_excerpt
       FROM $audit_expected e WHERE output_format = 'TOML' ORDER BY dataset_pos, pos LIMIT 2000""",
)
def inline_table_sample(t):
    return A.inline_table_sample(audited_toml(t))


@query(
    "task_stats",
    """SELECT task_key, any_value(family) AS family, any_value(output_format) AS output_format, any_value(task_kind) AS task_kind, any_value(task_schema) AS task_schema,
         CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (WHERE reason <> 'ok'), 0) AS BIGINT) AS errors, CAST(coalesce(sum(n) FILTER (WHERE reason = 'ok'), 0) AS BIGINT) AS usable,
         printf('%.6f', CAST(coalesce(sum(n) FILTER (WHERE reason = 'ok'), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS usable_rate,
         array_to_string(list_sort(list_distinct(flatten(list(sets)))), ';') AS datasets,
         coalesce(arg_max(reason, rank) FILTER (WHERE reason <> 'ok'), '') AS top_error
       FROM (SELECT *, row_number() OVER (PARTITION BY task_key ORDER BY n, first DESC) AS rank FROM (
         SELECT task_key, family, output_format, task_kind, task_schema, reason, count(*) AS n, min(dataset_pos * 1000000000000000 + pos) AS first, list(DISTINCT dataset) AS sets
         FROM $audit_expected e GROUP BY ALL) a) b GROUP BY task_key""",
)
def task_stats(t):
    return A.task_stats(audited(t))


@query(
    "task_error_reasons",
    """SELECT task_key, dataset, reason, count(*) AS rows FROM $audit_expected e WHERE NOT usable GROUP BY ALL""",
)
def task_error_reasons(t):
    counts = A.task_error_reasons(audited(t)).where("reason IS NOT NULL")
    return counts.select("task_key", "dataset", "reason", "rows")


@query(
    "route_rows",
    """SELECT CASE WHEN usable THEN 'usable' ELSE 'errors' END AS status, dataset, split, idx, family, task_key, output_format, task_kind, task_schema,
         usable AS is_valid, CASE WHEN usable THEN '' ELSE reason END AS error_reason
       FROM $audit_expected e""",
)
def route_rows(t):
    return A.route_rows(audited(t)).drop("messages")
