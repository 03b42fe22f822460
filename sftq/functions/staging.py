"""Keeping costly columns computed once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value``, marked so that Spark computes it in its own projection only.

    Catalyst pushes a filter below a projection by copying the column's whole
    expression into it, and a filter shares no work between copies: a parsed record
    read five times would be parsed five times. A condition on the partition id, which
    always holds, makes the column non-deterministic, so filters stay above it.
    Filters on plain columns belong before the call for the same reason.
    """
    return F.when(F.spark_partition_id() >= 0, value)
