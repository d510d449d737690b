"""Policy tiers and levels folded into one CASE expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.policy import Levels, Tiers


def tier_points(value: Column, tiers: Tiers) -> Column:
    """Points of the first tier that ``value`` exceeds; 0 for none or a null value."""
    return _first(((value > bound, points) for bound, points in tiers), 0.0)


def level_of(score: Column, levels: Levels, floor: str) -> Column:
    """Label of the first level that ``score`` reaches, else ``floor``."""
    return _first(((score >= bound, label) for bound, label in levels), floor)


def _first(cases, otherwise) -> Column:
    folded = reduce(lambda chain, case: chain.when(case[0], F.lit(case[1])), cases, F)
    return folded.otherwise(F.lit(otherwise))
