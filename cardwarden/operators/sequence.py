"""Previous row of the same key, safe for a key that holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.functions.calendar import hour_number
from cardwarden.operators.skew import HOT_ROWS, hot_keys

# A dense hour or moment of a hot key is cut into this many pieces per HOT_ROWS rows.
_PIECES = 8
# Cuts that are looked for in a dense hour or moment; its pieces are that many at most.
_CUTS = 128
# Ranks of the cuts are off by no more than this share of its rows.
_ACCURACY = 20_000

#: What makes a window group, in the order of a key's rows.
GROUP = ("_hour", "_piece", "_step", "_part")


def with_previous(
    rows: DataFrame,
    key: str,
    moment: str,
    tie: str,
    carried: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``previous``: a struct of ``carried`` taken from the row before, or null.

    Rows are ordered by ``moment`` and then ``tie``, a number, within ``key``. Rows without key or
    moment have no place in the order; they are kept with a null ``previous``.

    An ordinary key is one window group. A key with more than ``hot_rows`` rows has a group
    per hour. An hour that still has more is cut at quantiles of the time, and a single
    moment that has more at quantiles of ``tie``, into up to ``_CUTS`` pieces.
    The first row of such a group takes its predecessor from the last row of the group
    before, which an aggregate over the hot keys alone finds. There are at most
    ``rows / hot_rows`` hot keys, dense hours and crowded moments, with ``2 * _PIECES`` cuts for each ``hot_rows``
    rows, so all lists may be broadcast;
    without hot keys adaptive execution drops all but the main branch. Rows without a place
    are spread over fixed groups by their ``tie``, since they too may be many.
    """
    placed = F.col(key).isNotNull() & F.col(moment).isNotNull()
    grouped = with_groups(rows, key, moment, tie, hot_rows)
    last_of_group = (
        grouped.filter(placed & F.col("_hot").isNotNull())
        .groupBy("_hot", *GROUP)
        .agg(F.max_by(F.struct(*carried), F.struct(moment, tie)).alias("_last"))
    )
    groups_of_key = Window.partitionBy("_hot").orderBy(*GROUP)
    before_group = last_of_group.select(
        F.col("_hot").alias("_key"),
        *[F.col(g).alias(f"_key{g}") for g in GROUP],
        F.lag("_last").over(groups_of_key).alias("_before"),
    )
    in_group = Window.partitionBy(key, *GROUP).orderBy(moment, tie)
    # One lag per column rather than of a struct, which would be shuffled as a second copy.
    sequenced = grouped.withColumns(
        {
            "_follows": F.lag(F.lit(True)).over(in_group),
            **{f"_lag_{name}": F.lag(name).over(in_group) for name in carried},
        }
    )
    in_group_row = F.struct(*[F.col(f"_lag_{name}").alias(name) for name in carried])
    same_group = F.col(key) == F.col("_key")
    for g in GROUP:
        same_group &= F.col(g) == F.col(f"_key{g}")
    return (
        sequenced.join(before_group, same_group, "left")
        .withColumn(
            "previous",
            F.when(placed, F.coalesce(F.when(F.col("_follows"), in_group_row), F.col("_before"))),
        )
        .select(*rows.columns, "previous")
    )


def with_groups(rows: DataFrame, key: str, moment: str, tie: str, hot_rows: int) -> DataFrame:
    """Rows with their window group, the columns ``GROUP``; ``_hot`` is null but for hot keys.

    Groups of a key follow each other in the order of its rows: by hour, by piece of a dense
    hour, by step before, at or after the crowded moments of that hour, and by part of such a moment.
    """
    placed = F.col(key).isNotNull() & F.col(moment).isNotNull()
    hour = hour_number(F.col(moment), F.hour(moment))
    second = F.minute(moment) * 60 + F.extract(F.lit("SECOND"), F.col(moment)).cast("double")
    listed = F.broadcast(hot_keys(rows.filter(placed), key, hot_rows))
    timed = rows.filter(placed).select(key, F.col(moment).alias("_at"), F.col(tie).alias("_tie"), hour.alias("_hour"), second.alias("_second"))
    hot = timed.join(listed, F.col(key) == F.col("_hot"))
    many, rows_of = F.col("_rows") > hot_rows, F.count("*").alias("_rows")
    dense = hot.groupBy("_hot", "_hour").agg(rows_of, _cuts("_second", hot_rows).alias("_cuts")).filter(many)
    moments = (
        hot.groupBy("_hot", "_hour", "_at")
        .agg(rows_of, _cuts("_tie", hot_rows).alias("cuts"))
        .filter(many)
        .groupBy("_hot", "_hour")
        .agg(F.collect_list(F.struct(F.col("_at").alias("at"), "cuts")).alias("_moments"))
    )
    placement = dense.drop("_rows").join(moments, ["_hot", "_hour"], "left").select(
        F.col("_hot").alias("_dense"), F.col("_hour").alias("_dense_hour"), "_cuts", "_moments"
    )
    here = F.filter("_moments", lambda m: m["at"] == F.col(moment))
    before = F.size(F.filter("_moments", lambda m: m["at"] < F.col(moment)))
    number = F.lit(0)
    return (
        rows.join(listed, F.col(key) == F.col("_hot"), "left")
        .join(
            F.broadcast(placement),
            (F.col("_hot") == F.col("_dense")) & (hour == F.col("_dense_hour")),
            "left",
        )
        .withColumns(
            {
                "_hour": F.when(~placed, -1 - F.pmod(F.xxhash64(tie), F.lit(4096)))
                .when(F.col("_hot").isNotNull(), hour)
                .otherwise(number.cast("bigint")),
                "_piece": F.when(F.col("_cuts").isNotNull(), _below("_cuts", second)).otherwise(number),
                "_step": F.when(F.col("_moments").isNotNull(), before * 2 + F.size(here)).otherwise(number),
                "_part": F.when(F.size(here) > 0, _below(here[0]["cuts"], F.col(tie))).otherwise(number),
            }
        )
        .drop("_dense", "_dense_hour", "_cuts", "_moments")
    )


def _cuts(value: str, hot_rows: int) -> Column:
    """Aggregate: quantiles of the values, as many as the number of rows asks for."""
    ranks = ", ".join(f"{i / _CUTS}D" for i in range(1, _CUTS))  # one text instead of as many columns
    every = F.expr(f"percentile_approx({value}, array({ranks}), {_ACCURACY})")
    wanted = F.least(F.lit(_CUTS), F.ceil(F.count("*") * _PIECES / hot_rows))
    step = F.greatest(F.floor(F.lit(_CUTS) / wanted), F.lit(1))
    return F.array_distinct(F.filter(every, lambda _, i: (i + 1) % step == 0))


def _below(cuts: Column | str, value: Column) -> Column:
    """Number of the cuts below a value."""
    return F.size(F.filter(cuts, lambda c: c < value))
