"""Keys that hold very many rows, and aggregates that treat them apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task handles without trouble.
HOT_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, as ``_hot``.

    At most ``rows / hot_rows`` keys qualify, so the result may be broadcast. Counting them
    reads the key column alone and combines on the map side.
    """
    counted = rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    return counted.filter(F.col("_rows") > hot_rows).select("_hot")


def distinct_by_heat(
    rows: DataFrame,
    key: str,
    aggregate: Callable[[DataFrame, Callable[[str], Column]], DataFrame],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Group rows by ``key`` with several exact distinct counts.

    ``aggregate`` gets rows and the distinct count to use. With ``count_distinct`` on
    several columns Spark shuffles one copy of each row per column, which spreads a hot key
    over all tasks but is far more than an ordinary key needs. Keys with at most
    ``hot_rows`` rows therefore collect their distinct values, at most that many, in one
    aggregate; only hot keys, whose copies mostly combine on the map side, take the other
    way. Without hot keys adaptive execution drops that branch. A null key is a key too.
    """
    listed = hot_keys(rows, key, hot_rows)
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    ordinary = rows.join(F.broadcast(listed), is_hot, "left_anti")
    hot = rows.join(F.broadcast(listed), is_hot, "left_semi")
    return aggregate(ordinary, _set_size).unionByName(aggregate(hot, F.count_distinct))


def _set_size(name: str) -> Column:
    return F.size(F.collect_set(name)).cast("bigint")
