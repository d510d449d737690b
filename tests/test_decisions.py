"""Edge semantics, one test per decision."""

import datetime as dt
from decimal import Decimal
import math

import pytest
from pyspark.sql import functions as F

from cardwarden.functions import money
from cardwarden.functions.calendar import WEEKDAYS, hour_start, month_year, weekday_name
from cardwarden.functions.tiers import level_of, tier_points
from cardwarden.plans import alerts, errors, evaluation, features, profiling, quality, rollups, scoring, segments
from cardwarden.policy import RiskPolicy

DAY = dt.datetime(2020, 1, 1, 12)


def card_days(spark, *rows):
    """Card-days: card, day of January, transactions, cities, cents."""
    schema = "card_id long, tx_day date, tx_count long, city_count long, amount string"
    data = [(card, dt.date(2020, 1, day), n, c, None if cents is None else str(Decimal(cents) / 100)) for card, day, n, c, cents in rows]
    return spark.createDataFrame(data, schema).withColumn("day_exact", money.to_exact(F.col("amount"))).drop("amount")


def test_worst_level_follows_severity_not_spelling(spark, make_tx):
    rows = []
    # Day 1: volume only. Day 2: all three criteria. Day 3: volume and cities.
    for day, cities, amount in ((1, 1, "$1"), (2, 5, "$500"), (3, 5, "$1")):
        for i in range(11):
            rows.append(
                dict(id=len(rows), card_id=1, date=dt.datetime(2020, 1, day, i),
                     merchant_city=f"c{i % cities}", amount=amount)
            )
    tx = make_tx(*rows)
    levels = {r["tx_day"].day: r["alert_level"] for r in alerts.suspicious_card_days(rollups.daily_totals(tx)).collect()}
    assert levels == {1: "MODERATE", 2: "CRITICAL", 3: "HIGH"}
    assert alerts.top_suspicious_cards(rollups.daily_totals(tx)).first()["risk_level_max"] == "CRITICAL"
    as_words = alerts.top_suspicious_cards(rollups.daily_totals(tx), RiskPolicy(lexical_level_max=True)).first()
    assert as_words["risk_level_max"] == "HIGH"


def test_empty_segment_keeps_its_row(spark, make_tx):
    tx = make_tx(dict(id=1, card_id=1, date=DAY, amount="$5", merchant_city="a"))
    nobody = spark.createDataFrame([], "card_id long")
    rows = {r["segment"]: r for r in segments.segment_comparison(tx, nobody).collect()}
    assert set(rows) == {"SUSPECT", "NORMAL"}
    empty = rows["SUSPECT"]
    assert (empty["tx_count"], empty["city_count"]) == (0, 0)
    assert empty["mean_amount"] is None and empty["tx_per_day"] is None
    assert rows["NORMAL"]["tx_count"] == 1


def test_segment_with_only_null_days(spark, make_tx):
    tx = make_tx(dict(id=1, card_id=1, amount="$5"))
    suspects = spark.createDataFrame([(1,)], "card_id long")
    rows = {r["segment"]: r for r in segments.segment_comparison(tx, suspects).collect()}
    assert rows["SUSPECT"]["tx_per_day"] is None and rows["SUSPECT"]["tx_count"] == 1


@pytest.mark.parametrize(
    "text, number",
    [("$14.57", 14.57), ("$-77.00", -77.0), ("$1,200.50", 1200.5), ("n/a", None), ("", None),
     (None, None), ("abc", None), (" $3 ", 3.0), ("NaN", None), ("Infinity", None),
     ("$10000000000000", 1e13), ("$0.125", 0.125), ("$0.025", 0.025), ("$0.005", 0.005),
     ("$1e32", 1e32), ("$-1e300", -1e300), ("$0.0000004", 4e-7), ("$-0.000001", -1e-6),
     ("$8388607.999999", 8388607.999999), ("$8388608", 8388608.0), ("$-8388608.01", -8388608.01),
     ("$999999999999999.5", 999999999999999.5), ("$1e15", 1e15), ("$1.0000001", 1.0000001)],
)
def test_money_text(spark, text, number):
    row = spark.createDataFrame([(text,)], "t string").select(
        money.to_number(F.col("t")).alias("n"), money.units(money.to_exact(F.col("t"))).alias("e")
    )
    assert tuple(row.first()) == (number, number)


def test_unknown_sum_does_not_meet_the_amount_criterion(spark):
    row = alerts.flagged_days(card_days(spark, (1, 1, 12, 1, None))).first()
    assert row["criteria_count"] == 1 and row["alert_level"] == "MODERATE"
    assert row["crit_amount"] is False


def test_sums_are_exact_in_any_order(spark, make_tx):
    rows = [dict(id=i, card_id=1, date=DAY, amount="$0.10") for i in range(10)]
    assert alerts.card_daily_stats(rollups.daily_totals(make_tx(*rows, parts=5))).first()["day_amount"] == 1.0


@pytest.mark.parametrize("amounts, total", [
    (["$6e31", "$6e31"], 1.2e32),
    (["$1e32", "$-1e32", "$1"], 1.0),
    (["$1e308", "$1e308"], float("inf")),
    (["$0.0000004"] * 10, 4e-6),
    (["$0.000000000001", "$8388608.5", "$0.10"], 8388608.600000000001),
    (["$9007199254740993"], 9007199254740992.0),
    (["$8388607.99"] * 300, 2516582397.0),
    (["$-0.01"] * 7 + ["$0.07"], 0.0),
])
def test_sums_never_fail(spark, make_tx, amounts, total):
    rows = [dict(id=i, card_id=i % 2, date=DAY, amount=a, mcc=1) for i, a in enumerate(amounts)]
    tx = make_tx(*rows, parts=3)
    assert profiling.tx_by_month(tx).first()["amount_total"] == total
    again = rollups.daily_totals(tx).groupBy().agg(money.total(F.col("day_exact")).alias("t")).first()["t"]
    assert again == total
    stats = profiling.amount_stats_exact(tx).first()
    assert stats["mean_amount"] == total / len(amounts) or total == float("inf")
    assert {r["amount_max"] for r in scoring.card_risk_features(tx).collect()} <= {float(a[1:]) for a in amounts}


def test_spread_of_amounts(spark, make_tx):
    for amounts in (["$1", "$2", "$4"], ["$1000000.01", "$1000000.02", "$1000000.03"], ["$1e16", "$3e16"], ["$0.0000001", "$1"]):
        tx = make_tx(*[dict(id=i, card_id=i, date=DAY, amount=a) for i, a in enumerate(amounts)])
        nobody = spark.createDataFrame([], "card_id long")
        got = {r["segment"]: r["stddev_amount"] for r in segments.segment_comparison(tx, nobody).collect()}
        values = [Decimal(a[1:]) for a in amounts]
        mean = sum(values) / len(values)
        expected = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)).sqrt()
        assert got["SUSPECT"] is None and abs(got["NORMAL"] - float(expected)) <= 1e-9 * float(expected)


def test_scored_segments_are_those_of_written_suspects(spark, make_tx):
    rows = [dict(id=i, card_id=i % 5 if i % 6 else None, date=dt.datetime(2020, 1, 1 + i % 9), merchant_city=f"c{i % (3 * (i % 5) + 1)}",
                 amount=f"${i * 7 % 50}.25", errors="Bad PIN" if i % 5 == 4 and i % 3 else None) for i in range(200)]
    tx, policy = make_tx(*rows), RiskPolicy(high_risk_score=25.0)
    suspects = scoring.high_risk_cards(scoring.card_scores(tx, policy), policy)
    assert 0 < suspects.filter("card_id is not null").count() < 5
    expected = sorted(map(tuple, segments.segment_comparison(tx, suspects).collect()))
    assert sorted(map(tuple, segments.scored_segments(tx, policy).collect())) == expected
    levels = {r["card_id"]: (r["risk_score"], r["risk_level"], r["total_transactions"]) for r in scoring.card_levels(tx, policy).collect()}
    assert levels == {r["card_id"]: (r["risk_score"], r["risk_level"], r["total_transactions"]) for r in scoring.card_scores(tx, policy).collect()}


def test_contradicting_labels(spark):
    given = [(1, True), (1, False), (2, False), (2, False), (3, None), (3, False), (4, None), (4, None), (5, None), (5, True), (None, True)]
    labels = spark.createDataFrame(given, "transaction_id long, is_fraud boolean").repartition(3)
    got = dict(map(tuple, evaluation.single_labels(labels).collect()))
    assert got == {1: True, 2: False, 3: False, 4: None, 5: True}


def test_repeated_labels_count_once(spark, make_tx):
    tx = make_tx(dict(id=1, card_id=1, date=DAY), dict(id=2, card_id=1, date=DAY))
    labels = spark.createDataFrame([(1, False), (1, True), (1, True), (2, False), (2, False)], "transaction_id long, is_fraud boolean")
    row = evaluation.fraud_label_eval(tx, labels, scoring.card_levels(tx)).filter("risk_level = 'NORMAL'").first()
    assert (row["labelled_tx"], row["fraud_tx"], row["true_positive"], row["false_positive"]) == (2, 1, 1, 1)


def test_day_criteria_are_strict(spark):
    at_bound = card_days(spark, (1, 1, 10, 3, 100_000))
    above = card_days(spark, (1, 1, 11, 3, 0), (2, 1, 1, 4, 0), (3, 1, 1, 1, 100_001))
    assert alerts.flagged_days(at_bound).count() == 0
    found = {r["card_id"]: r for r in alerts.flagged_days(above).collect()}
    assert found[1]["crit_volume"] and found[2]["crit_cities"] and found[3]["crit_amount"]
    assert all(r["criteria_count"] == 1 for r in found.values())


def test_days_without_readable_amounts(make_tx):
    tx = make_tx(
        dict(id=1, card_id=1, date=DAY, amount="n/a"),
        dict(id=2, card_id=2, date=DAY, amount="$2"),
        dict(id=3, card_id=2, date=DAY, amount=None),
    )
    days = rollups.daily_totals(tx)
    assert [(r["card_id"], r["tx_count"]) for r in alerts.tx_per_card_day(days).collect()] == [(1, 1), (2, 2)]
    rows = [(r["card_id"], r["amount_total"], r["tx_count"]) for r in alerts.amount_per_card_day(days).collect()]
    assert rows == [(2, 2.0, 1)]


def test_exact_median_is_discrete(spark, make_tx):
    tx = make_tx(*[dict(id=i, amount=f"${i}") for i in (1, 2, 3, 4)])
    assert profiling.amount_stats_exact(tx).first()["median_amount"] == 2.0


def test_error_means_neither_null_nor_empty(spark, make_tx):
    tx = make_tx(
        dict(id=1, errors=None), dict(id=2, errors=""), dict(id=3, errors="Bad PIN")
    )
    assert {r["id"]: r["has_error"] for r in tx.collect()} == {1: False, 2: False, 3: True}
    row = errors.error_transactions(tx).first()
    assert (row["error_count"], row["error_pct"]) == (1, 33.33)


def test_transactions_without_card_are_normal(spark, make_tx):
    tx = make_tx(dict(id=1, card_id=None, amount="$1"), dict(id=2, card_id=1, amount="$2"))
    suspects = spark.createDataFrame([(1,), (None,)], "card_id long")
    rows = {r["segment"]: r["tx_count"] for r in segments.segment_comparison(tx, suspects).collect()}
    assert rows == {"SUSPECT": 1, "NORMAL": 1}


def test_transactions_without_card_form_one_scored_group(make_tx):
    tx = make_tx(dict(id=1, card_id=None, amount="$1"), dict(id=2, card_id=None, amount="$2"))
    assert [(r["card_id"], r["total_transactions"]) for r in scoring.card_scores(tx).collect()] == [(None, 2)]


def test_null_date_stays_null(make_tx):
    row = make_tx(dict(id=1)).select("tx_hour", "tx_weekday", "tx_day", weekday_name(F.col("tx_weekday"))).first()
    assert list(row) == [None] * 4


def test_weekdays(spark, make_tx):
    # 2023-01-01 was a Sunday.
    tx = make_tx(*[dict(id=d, date=dt.datetime(2023, 1, d)) for d in range(1, 8)])
    rows = [(r["tx_weekday"], r["weekday_name"]) for r in profiling.tx_by_weekday(tx).collect()]
    assert rows == list(enumerate(WEEKDAYS, start=1))


def test_null_feature_scores_nothing(make_tx):
    row = scoring.card_scores(make_tx(dict(id=1, card_id=1, date=DAY, amount="n/a"))).first()
    assert row["amount_max"] is None and row["score_amount"] == 0.0
    assert row["risk_level"] == "NORMAL"


def test_card_without_any_day(make_tx):
    row = scoring.card_scores(make_tx(dict(id=1, card_id=1, amount="$1"))).first()
    assert row["tx_per_active_day"] is None and row["score_volume"] == 0.0


def test_amount_buckets(make_tx):
    amounts = ["9.99", "10", "50", "50.01", "200", "200.01", "n/a"]
    tx = make_tx(*[dict(id=i, amount=f"${a}") for i, a in enumerate(amounts)])
    counts = {r["amount_bucket"]: r["tx_count"] for r in profiling.amount_buckets(tx).collect()}
    assert counts == {"<10": 1, "10-50": 2, "50-200": 2, ">200": 1}


POLICY = RiskPolicy()


@pytest.mark.parametrize(
    "tiers",
    [POLICY.volume_tiers, POLICY.city_tiers, POLICY.amount_tiers, POLICY.error_tiers],
)
def test_tier_bounds_are_strict(spark, tiers):
    values = [b for bound, _ in tiers for b in (bound, bound + 1e-6)]
    expected = []
    for i, (_, points) in enumerate(tiers):
        lower = tiers[i + 1][1] if i + 1 < len(tiers) else 0.0
        expected += [lower, points]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert [r[0] for r in frame.select(tier_points(F.col("v"), tiers)).collect()] == expected


def test_score_levels(spark):
    scores = [14.9, 15.0, 30.0, 50.0, 70.0]
    frame = spark.createDataFrame([(s,) for s in scores], "s double")
    level = level_of(F.col("s"), POLICY.score_levels, POLICY.score_floor)
    assert [r[0] for r in frame.select(level).collect()] == [
        "NORMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"
    ]


def test_highest_possible_score_is_100(make_tx):
    rows = [
        dict(id=i, card_id=1, date=DAY, merchant_city=f"c{i}", amount="$6000", errors="Bad PIN")
        for i in range(16)
    ]
    row = scoring.card_scores(make_tx(*rows)).first()
    assert row["risk_score"] == 100.0 and row["risk_level"] == "CRITICAL"


def test_min_counts(make_tx):
    tx = make_tx(*[dict(id=i, card_id=i // 5, errors="Bad PIN") for i in range(9)])
    assert [r["card_id"] for r in errors.error_rate_by_card(rollups.card_totals(tx)).collect()] == [0]
    assert errors.error_ratio_by_card(rollups.card_totals(tx)).count() == 0


def test_distinct_count_of_ids_counts_null(spark, make_tx):
    ids = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    tx = make_tx(dict(id=1, merchant_id=None), dict(id=2, merchant_id=5), dict(id=3, merchant_id=5))
    row = quality.volumetry(tx, ids, ids).first()
    assert row.asDict() == {"transactions": 3, "users": 2, "cards": 2, "merchants": 2}


def test_unmatched_cards_share_a_null_client(spark, make_tx):
    tx = make_tx(*[dict(id=i, card_id=i % 4, client_id=9) for i in range(40)])
    cards = spark.createDataFrame([(0, 7), (1, 7)], "id long, client_id long")
    rows = {r["client_id"]: r for r in errors.error_rate_by_client(rollups.card_totals(tx), cards).collect()}
    assert set(rows) == {7, None}
    assert rows[7]["card_count"] == 2 and rows[None]["total_transactions"] == 20


def test_typed_cards(spark):
    cards = spark.createDataFrame(
        [(1, "$24,295", "YES", "No", "02/2024", "09/2002"), (2, "x", "?", "Yes", "13/2024", None)],
        "id long, credit_limit string, has_chip string, card_on_dark_web string, expires string,"
        " acct_open_date string",
    )
    one, two = features.typed_cards(cards).orderBy("id").collect()
    assert (one["credit_limit"], one["has_chip"], one["card_on_dark_web"]) == (24295.0, True, False)
    assert one["expires"] == dt.date(2024, 2, 29) and one["acct_open_date"] == dt.date(2002, 9, 1)
    assert (two["credit_limit"], two["has_chip"], two["expires"]) == (None, None, None)


def test_month_year_text(spark):
    frame = spark.createDataFrame([("7/2020",), ("07/2020",), ("2020",)], "t string")
    read = [r[0] for r in frame.select(month_year(F.col("t"))).collect()]
    assert read[1] == dt.date(2020, 7, 1) and read[2] is None


def test_hour_numbers_before_1970(spark):
    frame = spark.createDataFrame([(-1,), (0,), (25,)], "n long")
    assert [r[0] for r in frame.select(hour_start(F.col("n"))).collect()] == [
        dt.datetime(1969, 12, 31, 23), dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2, 1)
    ]


def test_wall_clock_ignores_the_session_zone(spark, make_tx):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 does not exist there on this day.
        tx = make_tx(dict(id=1, card_id=1, date=dt.datetime(2021, 3, 14, 2, 30)))
        assert tx.select("tx_hour").first()[0] == 2
        assert profiling.card_hour_peaks(tx).first()["peak_hour"] == dt.datetime(2021, 3, 14, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dark_web_forces_the_worst_level(spark, make_tx):
    scores = scoring.card_scores(make_tx(dict(id=1, card_id=1), dict(id=2, card_id=2)))
    cards = spark.createDataFrame([(1, True), (2, None)], "id long, card_on_dark_web boolean")
    rows = {r["card_id"]: r["final_level"] for r in scoring.dark_web_cards(scores, cards).collect()}
    assert rows == {1: "CRITICAL", 2: "NORMAL"}


def test_stddev_of_one_value_is_null(make_tx):
    assert profiling.amount_dispersion(make_tx(dict(id=1, card_id=1, amount="$1"))).first()["stddev_amount"] is None


def test_score_is_the_sum_of_its_parts(spark, sf_dir):
    from cardwarden.fixtures import FIXTURE_POLICY, Inputs

    rows = scoring.card_scores(Inputs(spark, sf_dir).tx, FIXTURE_POLICY).collect()
    for r in rows:
        parts = r["score_volume"] + r["score_geo"] + r["score_amount"] + r["score_error"]
        assert r["risk_score"] == parts and 0 <= parts <= 100 and not math.isnan(parts)


def test_policy_bounds_must_fall():
    with pytest.raises(ValueError, match="city_tiers"):
        RiskPolicy(city_tiers=((3, 10.0), (5, 20.0)))


def test_labels_come_from_the_policy(make_tx):
    policy = RiskPolicy(score_levels=((50, "high"), (15, "some")), score_floor="none")
    assert policy.level_names == ("high", "some", "none")
    row = scoring.card_scores(make_tx(dict(id=1, card_id=1, errors="Bad PIN")), policy).first()
    assert (row["risk_score"], row["risk_level"]) == (30.0, "some")
