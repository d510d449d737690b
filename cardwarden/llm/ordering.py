"""Positions and running totals over a whole ordered table, without ordering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.storage import stored


def with_running_totals(rows: DataFrame, order: list[Column], totals: dict[str, str]) -> DataFrame:
    """Adds for each ``name: column`` the sum of that bigint column over all rows before this one.

    Rows are range-partitioned by ``order`` and summed within partitions; the totals of the
    partitions, one row each, are summed up apart. Rows that ``order`` doesn't tell apart come
    in any order. An empty table stays empty.
    """
    sums = list(totals.items())
    parts = stored(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        "ordered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(*[F.sum(column).alias(f"_sum_{name}") for name, column in sums])
        .select("_part", *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_off_{name}") for name, _ in sums])
    )
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumns({name: F.coalesce(F.sum(column).over(within), F.lit(0)) for name, column in sums})
        .join(offsets, "_part")
        .withColumns({name: F.col(name) + F.col(f"_off_{name}") for name, _ in sums})
        .drop("_part", "_row", *[f"_off_{name}" for name, _ in sums])
    )
