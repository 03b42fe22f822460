"""Loosely typed JSON values: the text, truth and integer that a Python reader sees.

Arguments named ``value`` are VARIANT columns. Missing and JSON null count alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftq.functions.whitespace import strip

BIGGEST = 2**63 - 1


def item(value: Column, path: str) -> Column:
    """The value at a dotted path of keys; null where one is missing or not an object's."""
    return F.variant_get(value, f"$.{path}", "variant")


def has_key(value: Column, name: str) -> Column:
    """Is ``value`` an object with this key (whatever it holds)?"""
    return item(value, name).isNotNull()


def as_list(value: Column) -> Column:
    """``ARRAY<VARIANT>``, null when the value is not a JSON array."""
    return F.try_variant_get(value, "$", "array<variant>")


def as_dict(value: Column) -> Column:
    """``MAP<STRING,VARIANT>``, null when the value is not a JSON object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _type(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _is_missing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def text_or_empty(value: Column) -> Column:
    """``str(value or "")``. Objects and arrays keep their JSON spelling."""
    kind, text = _type(value), _text(value)
    return (
        F.when(_is_missing(value), "")
        .when(kind == "STRING", text)
        .when(kind == "BOOLEAN", F.when(text == "true", "True").otherwise(""))
        .when(text.isin("{}", "[]"), "")
        .when(_number(value) == 0, "")
        .otherwise(text)
    )


def truth(value: Column) -> Column:
    """``bool(value)``: any non-empty text is true, also ``"false"``."""
    kind, text = _type(value), _text(value)
    return (
        F.when(_is_missing(value), False)
        .when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(text.isin("{}", "[]"), False)
        .otherwise(F.coalesce(_number(value) != 0, F.lit(True)))
    )


def int_from_text(text: Column) -> Column:
    """``int(text)``, null where that fails; beyond 64 bits it saturates."""
    digits = F.regexp_extract(strip(text), r"^([+-]?[0-9]+(?:_[0-9]+)*+)$", 1)
    plain = F.nullif(F.regexp_replace(digits, "_", ""), F.lit(""))
    limit = F.when(plain.startswith("-"), -BIGGEST).otherwise(BIGGEST)
    return F.when(plain.isNotNull(), F.coalesce(plain.try_cast("bigint"), limit))


def int_or_null(value: Column) -> Column:
    """``int(value)``, null where that fails: numbers truncate, text must be an integer."""
    kind, text, number = _type(value), _text(value), _number(value)
    whole = F.when(number >= float(BIGGEST), BIGGEST).when(number <= -float(BIGGEST), -BIGGEST)
    return (
        F.when(_is_missing(value), F.lit(None))
        .when(kind == "STRING", int_from_text(text))
        .when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0))
        .when(kind == "BIGINT", text.try_cast("bigint"))
        .when(F.isnan(number) | (F.abs(number) == float("inf")), F.lit(None))
        .otherwise(F.coalesce(whole, number.try_cast("bigint")))
    )
