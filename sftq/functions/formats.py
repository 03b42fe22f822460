"""Format labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftq.functions.whitespace import strip

# The formats that have a parser.
FORMATS = ("JSON", "YAML", "TOML", "XML", "CSV")


def upper_label(fmt: Column) -> Column:
    """Stripped upper-case label, empty for null. Aliases are kept as they are."""
    return F.upper(strip(F.coalesce(fmt, F.lit(""))))


def norm_format(fmt: Column) -> Column:
    """Canonical label: YML is YAML, TSV is CSV, one leading ``C_`` is dropped."""
    label = upper_label(fmt)
    return (
        F.when(label == "YML", "YAML")
        .when(label == "TSV", "CSV")
        .otherwise(F.regexp_replace(label, "^C_", ""))
    )
