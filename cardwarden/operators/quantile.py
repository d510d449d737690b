"""Exact discrete quantile of a number column from its value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits that one step finds: no running sum has more rows than about 2^BITS.
BITS = 18
# Bins of the logarithm of a value, and steps after the one that finds such a bin.
_RATIO, _STEPS = 128, 2


def value_counts(rows: DataFrame, name: str) -> DataFrame:
    """Distinct non-null values ``v``, as doubles, with their number of rows ``n``."""
    return rows.filter(F.col(name).isNotNull()).groupBy(F.col(name).cast("double").alias("v")).agg(
        F.count("*").alias("n")
    )


def exact_quantile(counts: DataFrame, q: float, bits: int = BITS) -> Column:
    """Smallest value with at least the fraction ``q`` of all rows at or below it.

    A scalar subquery over value counts. Each value has a whole number that never falls where
    the value rises: its logarithm, finely divided, so that an outlier doesn't push the others
    together. The leading bits of the number at the rank are found by a running sum over bins, then the
    next ones among the values that agree in those, and at last the value itself among the few
    hundred that agree in all. A step keeps the values below and above as one bin each, so that
    it needs no more from the step before than the bits found.
    """
    depth = _STEPS * bits
    number = F.signum("v") * F.floor(F.log1p(F.least(F.abs("v"), F.lit(1e295)) * 1e12) * (_RATIO * 2.0**depth))
    keyed = counts.select("v", "n", number.cast("bigint").alias("k"))
    prefix = _at_rank(keyed.select(F.shiftright("k", depth).alias("bin"), F.shiftright("k", depth).alias("value"), "n"), q)
    width = float(1 << bits)
    for step in range(_STEPS - 1, -1, -1):
        finer = F.shiftright("k", step * bits)
        place = F.width_bucket((finer - prefix * (1 << bits)).cast("double"), F.lit(0.0), F.lit(width), F.lit(1 << bits))
        prefix = _at_rank(keyed.select(place.alias("bin"), finer.alias("value"), "n"), q)
    ends = F.array(F.lit(float("-inf")), F.col("v"), F.lit(float("inf")))
    value = F.get(ends, (F.signum((F.col("k") - prefix).cast("double")) + 1).cast("int"))
    return _at_rank(keyed.select(value.alias("bin"), F.col("v").alias("value"), "n"), q)


def _at_rank(rows: DataFrame, q: float) -> Column:
    """The smallest ``value`` in the bin that holds the rank, for rows (bin, value, n)."""
    sums = rows.groupBy("bin").agg(F.sum("n").alias("n"), F.min("value").alias("value"))
    in_order = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reached = sums.withColumns({"upto": F.sum("n").over(in_order), "total": F.sum("n").over(everything)})
    reached = reached.filter(F.col("upto") >= F.greatest(F.ceil(F.col("total") * q), F.lit(1)))
    return reached.agg(F.min_by("value", "bin")).scalar()
