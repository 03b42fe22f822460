"""Registration of queries and rendering of their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sftq.catalog.fixtures import FIXTURES

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_NAME = re.compile(r"\$(\w+)")


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(sql)))


class Tables:
    """The driver's tables and the fixtures derived from them, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in FIXTURES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = FIXTURES[name]
        for used in _names(sql):
            getattr(self, used).createOrReplaceTempView(f"sftq_{used}")
        return self.spark.sql(_NAME.sub(r"sftq_\1", sql))


def oracle(sql: str) -> str:
    """The DuckDB text: fixtures become common table expressions."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in _names(text):
            if name in FIXTURES and name not in needed:
                add(FIXTURES[name])
                needed[name] = FIXTURES[name]

    add(sql)
    tables = ",\n".join(f"{name} AS ({text})" for name, text in needed.items())
    return _NAME.sub(r"\1", f"WITH {tables}\n{sql}" if tables else sql)


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its oracle SQL if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return register
