"""Grouping for the small side of a join whose other side may have hot keys.

Adaptive execution splits a hot join key only where a shuffle lies directly
below the join. An aggregate on the join keys takes that shuffle away: its
output is already partitioned by them, so the join is planned on top of it and
a hot key stays in one task. Grouping by the keys packed into one struct gives
the same rows, but in a partitioning the join does not recognise; the few
grouped rows are shuffled once more (or broadcast), and splitting works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _packed(keys: Sequence[str]) -> Column:
    return F.struct(*keys).alias("_packed")


def group_apart(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggregates)`` for use as a join side."""
    grouped = df.groupBy(_packed(keys)).agg(*aggregates)
    return grouped.select("_packed.*", *[c for c in grouped.columns if c != "_packed"])


def distinct_apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df.select(*keys).distinct()`` for use as a join side."""
    return df.select(_packed(keys)).distinct().select("_packed.*")
