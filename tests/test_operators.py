"""Shared operators against plain Python on small data, with a hot key among it."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.dimensions import mcc_dimension, with_category
from cardwarden.operators.quantile import exact_quantile, value_counts
from cardwarden.operators.ranking import first_rows, top_k
from cardwarden.operators.sequence import GROUP, with_groups, with_previous
from cardwarden.plans import sequences
from cardwarden.functions.ratios import with_share


def sequence_rows(n=1200, seed=1):
    """Half of the rows belong to key 1; some have no key or no moment; many tie in time."""
    rng = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(n):
        key = None if rng.random() < 0.1 else 1 if rng.random() < 0.5 else rng.randint(2, 30)
        # A third of the rows in one hour, the others over a week.
        minutes = rng.randint(0, 59) if rng.random() < 0.33 else rng.randint(0, 7 * 1440)
        moment = start + dt.timedelta(minutes=minutes, seconds=30 * rng.randint(0, 1))
        moment = None if rng.random() < 0.1 else moment
        rows.append((i, key, moment, rng.choice(["a", "b", None])))
    return rows


def expected_previous(rows):
    order = sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2], r[0]))
    found = {r[0]: None for r in rows}
    for before, row in zip(order, order[1:]):
        if before[1] == row[1]:
            found[row[0]] = (before[0], before[3])
    return found


@pytest.mark.parametrize("hot_rows", [5, 50, 150, 400, 10_000])
def test_previous_row(spark, hot_rows):
    rows = sequence_rows()
    frame = spark.createDataFrame(rows, "id long, k long, at timestamp_ntz, place string").repartition(7)
    result = with_previous(frame, "k", "at", "id", ["id", "place"], hot_rows)
    assert result.columns == ["id", "k", "at", "place", "previous"]
    got = {
        r["id"]: r["previous"] and (r["previous"]["id"], r["previous"]["place"])
        for r in result.collect()
    }
    assert got == expected_previous(rows)


@pytest.mark.parametrize("distinct_moments", [1, 60, 10_000])
def test_previous_row_of_one_hot_second(spark, distinct_moments):
    """A dense second is cut too; rows of one moment stay together and still come out right."""
    rows = [
        (i, 1, dt.datetime(2020, 1, 1, 0, 0, 0, i * 37 % distinct_moments), "a") for i in range(200)
    ]
    frame = spark.createDataFrame(rows, "id long, k long, at timestamp_ntz, place string")
    got = {
        r["id"]: r["previous"] and (r["previous"]["id"], r["previous"]["place"])
        for r in with_previous(frame, "k", "at", "id", ["id", "place"], 20).collect()
    }
    assert got == expected_previous(rows)


@pytest.mark.parametrize("shape", ["one moment", "two moments", "a burst", "far ids"])
def test_no_group_is_larger_than_a_hot_key_may_be(spark, shape):
    """4 000 rows of one card, all at once, at two moments among others, within a second, or with ids far apart."""
    start, n, hot_rows = dt.datetime(2020, 1, 1, 5), 4000, 100
    rows = []
    for i in range(n):
        at = start
        if shape == "two moments":
            at += dt.timedelta(minutes=[7, 7, 7, 30, i % 50][i % 5])
        elif shape == "a burst":
            at += dt.timedelta(microseconds=i * 37 % 900_000 if i % 10 else 3_000_000_000)
        rows.append((i if shape != "far ids" or i % 2 else i - 10**15, 1, at, "a"))
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, k long, at timestamp_ntz, place string").repartition(5)
    sizes = with_groups(frame, "k", "at", "id", hot_rows).groupBy("k", *GROUP).count()
    assert sizes.agg(F.max("count")).first()[0] <= hot_rows
    got = {r["id"]: r["previous"] and (r["previous"]["id"], r["previous"]["place"]) for r in with_previous(frame, "k", "at", "id", ["id", "place"], hot_rows).collect()}
    assert got == expected_previous(rows)


def test_velocity_is_the_same_with_and_without_hot_keys(spark, sf_dir):
    from cardwarden.fixtures import Inputs

    tx = Inputs(spark, sf_dir).tx
    plain = sorted(map(tuple, sequences.velocity(tx).collect()))
    assert sorted(map(tuple, sequences.velocity(tx, hot_rows=5).collect())) == plain


def test_impossible_travel_is_the_same_with_and_without_hot_keys(spark, sf_dir):
    from cardwarden.fixtures import Inputs

    d = Inputs(spark, sf_dir)
    plain = sorted(map(tuple, sequences.impossible_travel(d.tx, d.places).collect()))
    hot = sequences.impossible_travel(d.tx, d.places, hot_rows=5).collect()
    assert plain and sorted(map(tuple, hot)) == plain


def test_simultaneous_distant_transactions_are_impossible(spark, make_tx):
    at = dt.datetime(2020, 1, 1)
    tx = make_tx(
        dict(id=1, card_id=1, date=at, merchant_city="x"),
        dict(id=2, card_id=1, date=at, merchant_city="y"),
        dict(id=3, card_id=1, date=at, merchant_city="y"),
    )
    places = spark.createDataFrame(
        [("x", 0.0, 0.0), ("y", 0.0, 90.0)], "merchant_city string, latitude double, longitude double"
    )
    rows = sequences.impossible_travel(tx, places).collect()
    assert [(r["previous_id"], r["id"]) for r in rows] == [(1, 2)]
    assert abs(rows[0]["distance_km"] - 10007.5) < 1


@pytest.mark.parametrize("keys", [
    list(range(500)),
    [i * i for i in range(500)],
    [-(2**40) + i for i in range(250)] + [2**40 + i for i in range(250)],
    [7],
    [-(2**63) + i for i in range(300)] + [2**63 - 1 - i for i in range(300)],
    [-i * 1000 for i in range(400)],
])
@pytest.mark.parametrize("n", [1, 37, 500, 900])
def test_first_rows(spark, keys, n):
    shuffled = keys[:]
    random.Random(3).shuffle(shuffled)
    frame = spark.createDataFrame([(k, str(k)) for k in shuffled], "id long, t string").repartition(5)
    got = [r["id"] for r in first_rows(frame, "id", n).collect()]
    assert got == sorted(keys)[:n]


def test_first_rows_of_nothing(spark):
    assert first_rows(spark.createDataFrame([], "id long"), "id", 5).count() == 0


@pytest.mark.parametrize("q", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(5)
    values = [int(rng.gauss(0, 40_000)) for _ in range(301)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").repartition(4)
    got = spark.range(1).select(exact_quantile(value_counts(frame, "v"), q)).first()[0]
    rank = max(1, -(-len(values) * q // 1))
    assert got == sorted(values)[int(rank) - 1]


def test_exact_quantile_of_a_wide_range(spark):
    """Few bins and an outlier: the later steps find the value."""
    values = [Decimal(i) / 100 for i in range(400)] + [Decimal(10) ** 25]
    frame = spark.createDataFrame([(v,) for v in values], "v decimal(38,6)").repartition(4)
    got = spark.range(1).select(exact_quantile(value_counts(frame, "v"), 0.5)).first()[0]
    assert got == float(values[200])


@pytest.mark.parametrize("values", [
    [1.7e308, -1.7e308, 5e-324, 0.0, 1.0],
    [1e200 * (1 + i * 2.0**-52) for i in range(300)] + [-1e300] * 3,
    [100 + i * 1e-9 for i in range(999)],
    [-0.0001 * i for i in range(500)] + [1e18],
    [7.0],
])
def test_exact_quantile_of_any_doubles(spark, values):
    """Also for values that differ in their last digits only, and with few bins for each step."""
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    for q in (0.0, 0.3, 0.5, 1.0):
        rank = max(1, -(-len(values) * q // 1))
        for bits in (18, 6):
            assert spark.range(1).select(exact_quantile(value_counts(frame, "v"), q, bits)).first()[0] == sorted(values)[int(rank) - 1]
    assert spark.range(1).select(exact_quantile(value_counts(frame.limit(0), "v"), 0.5)).first()[0] is None


def test_no_running_sum_sees_many_values(spark):
    """One outlier doesn't put the other values into one bin."""
    counts = value_counts(spark.range(300_000).select((F.col("id") / 100).alias("v")).unionByName(spark.createDataFrame([(1e25,)], "v double")), "v")
    result = spark.range(1).select(exact_quantile(counts, 0.5))
    assert result.first()[0] == 1500.0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= 10
    magnitude = F.floor(F.log1p(F.col("v") * 1e12) * 128)
    assert counts.groupBy(magnitude).count().agg(F.max("count")).first()[0] < 1 << 12


def test_first_rows_keeps_rows_without_a_key(spark):
    frame = spark.createDataFrame([(2, "b"), (None, "x"), (1, "a"), (None, "y")], "id long, t string")
    assert [r["id"] for r in first_rows(frame, "id", 2).collect()] == [1, 2]
    kept = [[tuple(r) for r in first_rows(frame.repartition(p, "t"), "id", 3).collect()] for p in (1, 3)]
    assert kept[0] == kept[1] and kept[0][:2] == [(1, "a"), (2, "b")] and kept[0][2][0] is None
    assert first_rows(frame, "id", 9).count() == 4


def test_top_k_ties_do_not_depend_on_partitions(spark):
    base = spark.range(40).select("id", (F.col("id") % 2).alias("n"))
    results = {
        tuple(r["id"] for r in top_k(base.repartition(p), 5, F.desc("n"), F.col("id")).collect())
        for p in (1, 3, 8)
    }
    assert results == {(1, 3, 5, 7, 9)}


def test_category_codes(spark):
    codes = spark.createDataFrame(
        [("5411", "Grocery"), ("05411", "Also grocery"), ("x12", "odd"), ("12345", "five digits"), (None, "none")],
        "mcc string, merchant_category string",
    )
    assert sorted(map(tuple, mcc_dimension(codes).collect())) == [(5411, "Also grocery"), (12345, "five digits")]
    rows = spark.createDataFrame([(1, 5411), (2, 12345), (3, None)], "id long, mcc int")
    joined = {r["id"]: r["merchant_category"] for r in with_category(rows, codes).collect()}
    assert joined == {1: "Also grocery", 2: "five digits", 3: None}


def test_share_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, n long")
    assert with_share(empty, "n", "share").count() == 0
