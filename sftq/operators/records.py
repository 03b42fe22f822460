"""Record shapes: family, training pair, declared format, bundle members, task key.

Raw records are VARIANT columns (one JSON object each), since their shape differs
from row to row. Typed columns have their own functions below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftq.functions.formats import norm_format
from sftq.functions.loose import as_dict, as_list, has_key, item, text_or_empty
from sftq.functions.whitespace import strip

# Family labels.
PAIRED, CHAT, UNKNOWN = "u10bei", "daichira", "unknown"


def detect_family(record: Column) -> Column:
    """By shape: metadata with prompt and output, else a messages list."""
    paired = has_key(record, "metadata.prompt") & has_key(record, "metadata.output")
    return (
        F.when(paired, PAIRED)
        .when(as_list(item(record, "messages")).isNotNull(), CHAT)
        .otherwise(UNKNOWN)
    )


def detect_family_audit(record: Column) -> Column:
    """By the presence of top-level keys."""
    messages = has_key(record, "messages")
    return (
        F.when(has_key(record, "metadata") & messages, PAIRED)
        .when(has_key(record, "category") & has_key(record, "subcategory") & messages, CHAT)
        .otherwise(UNKNOWN)
    )


def last_role_content(messages: Column, role: str) -> Column:
    """Content of the role's last message in ``ARRAY<STRUCT<role, content>>``, empty if none."""
    last = F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))
    return F.coalesce(last["content"], F.lit(""))


def last_role_value(messages: Column, role: str) -> Column:
    """The same on ``ARRAY<VARIANT>`` of message objects, as VARIANT."""
    said = F.filter(messages, lambda m: F.try_variant_get(m, "$.role", "string") == role)
    return item(F.try_element_at(said, F.lit(-1)), "content")


def last_turn(role: str, text: str = "text", turn: str = "turn", role_col: str = "role") -> Column:
    """Aggregate for a table of one row per turn: the role's last text, empty if none.

    ``max_by`` merges partial results, so a conversation of any length reaches the
    shuffle as one row per map task.
    """
    # A null text still counts as the last one; a null order value is skipped.
    said = F.when(F.col(role_col) == role, F.col(turn))
    return F.coalesce(F.max_by(F.coalesce(F.col(text), F.lit("")), said), F.lit(""))


def extract_pair(df: DataFrame, record: str = "record") -> DataFrame:
    """Add ``family, prompt, output, output_format``."""
    r, family = F.col(record), F.col("family")

    def found(key: str, role: str) -> Column:
        return F.when(family == PAIRED, item(r, f"metadata.{key}")).when(
            family == CHAT, last_role_value(F.col("_messages"), role)
        )

    return (
        df.withColumn("family", detect_family(r))
        .withColumn("_messages", F.when(family == CHAT, as_list(item(r, "messages"))))
        .withColumns(
            {
                "_prompt": found("prompt", "user"),
                "_output": found("output", "assistant"),
                "_label": item(r, "output_format"),
            }
        )
        .withColumns(
            {
                "prompt": text_or_empty(F.col("_prompt")),
                "output": text_or_empty(F.col("_output")),
                "output_format": text_or_empty(F.col("_label")),
            }
        )
        .drop("_messages", "_prompt", "_output", "_label")
    )


def infer_format_from_category(subcategory: Column, category: Column) -> Column:
    """The ``_to_<fmt>`` ending of the subcategory, else the category."""
    target = F.regexp_extract(strip(F.coalesce(subcategory, F.lit(""))), r"_to_([A-Za-z0-9]+)$", 1)
    return norm_format(F.coalesce(F.nullif(target, F.lit("")), category))


def or_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(UNKNOWN))


def task_key(family: Column, fmt: Column, kind: Column, schema: Column) -> Column:
    return F.concat_ws("|", family, fmt, kind, schema)


def explode_bundles(
    df: DataFrame, metadata: str = "metadata", messages: str = "messages", pos: str = "j"
) -> DataFrame:
    """One row per bundle member for typed arrays; the shorter array decides how many."""
    pairs = F.arrays_zip(F.col(metadata).alias("a"), F.col(messages).alias("b"))
    size = F.least(F.size(metadata), F.size(messages))
    keep = [c for c in df.columns if c not in (metadata, messages)]
    return (
        df.select(*keep, size.alias("_n"), F.posexplode(pairs).alias(pos, "_m"))
        .where(F.col(pos) < F.col("_n"))
        .select(*keep, pos, F.col("_m.a").alias(metadata), F.col("_m.b").alias(messages))
    )


def split_members(df: DataFrame, record: str = "record") -> DataFrame:
    """Split bundled records: adds ``family, j, metadata, messages`` (``j`` null if not bundled)."""
    md, ms, md_list, ms_list = (F.col(c) for c in ("_md", "_ms", "_md_list", "_ms_list"))
    first = F.get(ms_list, F.lit(0))
    nested = F.coalesce(as_list(first).isNotNull(), F.lit(False))
    paired = F.col("family") == PAIRED
    size = F.least(F.size(md_list), F.size(ms_list))

    def member(j: Column, metadata: Column, messages: Column) -> Column:
        return F.struct(j.alias("j"), metadata.alias("metadata"), messages.alias("messages"))

    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1))
    many = F.transform(positions, lambda j: member(j, F.get(md_list, j), F.get(ms_list, j)))
    one_md = F.when(as_dict(md).isNotNull(), md).otherwise(F.get(md_list, F.lit(0)))
    one = F.array(
        member(F.lit(None).cast("int"), one_md, F.when(paired & nested, first).otherwise(ms))
    )
    r = F.col(record)
    return (
        df.withColumn("family", detect_family_audit(r))
        .withColumns({"_md": item(r, "metadata"), "_ms": item(r, "messages")})
        .withColumns({"_md_list": as_list(md), "_ms_list": as_list(ms)})
        .withColumn("_bundled", paired & md_list.isNotNull() & nested)
        .withColumn("_m", F.explode(F.when(F.col("_bundled"), many).otherwise(one)))
        .withColumns({c: F.col(f"_m.{c}") for c in ("j", "metadata", "messages")})
        .drop("_m", "_md", "_ms", "_md_list", "_ms_list", "_bundled")
    )


def record_infos(df: DataFrame, record: str = "record", row: str = "i") -> DataFrame:
    """Members with ``idx, output_format, task_kind, task_schema, task_key, assistant_text``.

    The record itself is dropped before the split: a bundle must not be copied once per member.
    """
    r, family, md = F.col(record), F.col("family"), F.col("metadata")
    fields = ("subcategory", "category", "task")
    subcategory, category, task = (F.col(f"_text_{f}") for f in fields)
    about = lambda name: text_or_empty(item(md, name))

    def by_family(paired: Column, chat: Column, other: str) -> Column:
        return F.when(family == PAIRED, paired).when(family == CHAT, chat).otherwise(other)

    df = df.withColumns({f"_item_{f}": item(r, f) for f in fields})
    df = df.withColumns({f"_text_{f}": text_or_empty(F.col(f"_item_{f}")) for f in fields})
    return (
        split_members(df, record)
        .drop(record, *[f"_item_{f}" for f in fields])
        .withColumn("_said", last_role_value(as_list(F.col("messages")), "assistant"))
        .withColumns(
            {
                "idx": F.concat_ws(":", F.col(row).cast("string"), F.col("j").cast("string")),
                "output_format": by_family(
                    norm_format(about("format")),
                    infer_format_from_category(subcategory, category),
                    "UNKNOWN",
                ),
                "task_kind": by_family(or_unknown(about("type")), or_unknown(task), UNKNOWN),
                "task_schema": by_family(
                    or_unknown(about("schema")), or_unknown(subcategory), UNKNOWN
                ),
                "assistant_text": text_or_empty(F.col("_said")),
            }
        )
        .withColumn(
            "task_key",
            task_key(family, F.col("output_format"), F.col("task_kind"), F.col("task_schema")),
        )
        .drop("_said", *[f"_text_{f}" for f in fields])
    )
