"""Ratios of aggregates; an empty denominator gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * F.lit(100.0)


def with_share(groups: DataFrame, count: str, share: str, whole: Column | None = None) -> DataFrame:
    """Add each group's percentage of ``whole``, by default the total of ``count``.

    The default total is a scalar subquery over the same grouped rows. When ``count`` is
    their only aggregate it reuses their exchange, so the input is read once.
    """
    if whole is None:
        whole = groups.agg(F.sum(count)).scalar()
    return groups.withColumn(share, percent(F.col(count), whole))
