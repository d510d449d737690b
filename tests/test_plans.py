"""Shape of the physical plans, and whole results under a key with a third of all rows."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden.catalog import all_queries
from cardwarden.fixtures import FIXTURE_POLICY, Inputs
from cardwarden.plans import alerts, errors, export, features, profiling, rollups, scoring, segments, sequences
from cardwarden.plans.features import with_features
from cardwarden.policy import RiskPolicy

FILE_QUERIES = {"export_all", "read_results"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    """Transactions as plain Parquet, so that plans show the analysis and not the mapping."""
    path = str(tmp_path_factory.mktemp("staged") / "raw")
    Inputs(spark, sf_dir).raw.write.parquet(path)
    return with_features(spark.read.parquet(path))


@pytest.mark.parametrize("name", sorted(set(all_queries()) - FILE_QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(all_queries()[name](spark, sf_dir))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_card_day_counts_need_one_exchange_before_the_sort(staged):
    plan = plan_of(alerts.tx_per_card_day(rollups.daily_totals(staged)))
    assert plan.count("hashpartitioning") == 1 and plan.count("rangepartitioning") == 1


def test_scans_read_only_the_needed_columns(staged):
    plan = plan_of(profiling.tx_by_hour(staged))
    assert re.search(r"ReadSchema: struct<date:timestamp_ntz>", plan)
    plan = plan_of(errors.error_types(staged))
    assert "ReadSchema: struct<errors:string>" in plan
    assert re.search(r"PushedFilters: \[IsNotNull\(errors\)", plan)


def test_category_join_is_a_broadcast_of_bounded_size(spark, sf_dir, staged):
    codes = Inputs(spark, sf_dir).codes
    plan = plan_of(features.enriched_transactions(staged, codes))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_categories_are_aggregated_before_the_join(spark, sf_dir, staged):
    plan = plan_of(profiling.top_categories(rollups.code_totals(staged), Inputs(spark, sf_dir).codes))
    # The join sits above the aggregation by code.
    assert plan.index("BroadcastHashJoin") < plan.index("hashpartitioning(mcc")
    assert "TakeOrderedAndProject" in plan


def test_cards_are_broadcast_only_by_their_size(spark, sf_dir, staged):
    cards = Inputs(spark, sf_dir).cards
    assert "BroadcastHashJoin" in plan_of(errors.error_rate_by_client(rollups.card_totals(staged), cards))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(errors.error_rate_by_client(rollups.card_totals(staged), cards))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_share_reuses_the_grouping(staged):
    frame = errors.error_types(staged)
    frame.collect()
    assert "ReusedExchange" in plan_of(frame)


# A card with a third of all rows -------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """9 000 transactions: a third on card 1, a tenth without card, the rest on 200 cards."""
    start = F.lit("2020-01-01").cast("date").cast("timestamp_ntz")
    i = F.col("id")
    h = F.pmod(F.xxhash64("id"), F.lit(86400 * 20)).cast("int")
    rows = spark.range(9000).repartition(6).select(
        "id",
        (start + F.make_dt_interval(secs=h.cast("decimal(18,6)"))).alias("date"),
        (i % 40).alias("client_id"),
        F.when(i % 3 == 0, 1).when(i % 10 != 1, i % 200 + 2).cast("bigint").alias("card_id"),
        F.concat(F.lit("$"), (i % 3000).cast("string"), F.lit(".5")).alias("amount"),
        F.lit("Chip Transaction").alias("use_chip"),
        (i % 30).alias("merchant_id"),
        F.when(i % 7 != 0, F.concat(F.lit("c"), (i % 23).cast("string"))).alias("merchant_city"),
        F.lit("S").alias("merchant_state"),
        F.lit("1").alias("zip"),
        (i % 50).cast("int").alias("mcc"),
        F.when(i % 11 == 0, "Bad PIN").alias("errors"),
    )
    return with_features(rows)


@pytest.fixture(scope="module")
def by_hand(skewed):
    return [r.asDict() for r in skewed.collect()]


@pytest.mark.parametrize("hot_rows", [0, 50, 1000, 10**6])
def test_features_of_skewed_cards(skewed, by_hand, hot_rows):
    got = {r["card_id"]: r for r in scoring.card_risk_features(skewed, hot_rows).collect()}
    groups = {}
    for r in by_hand:
        groups.setdefault(r["card_id"], []).append(r)
    assert set(got) == set(groups) and None in groups
    for card, rows in groups.items():
        mine = got[card]
        assert mine["total_transactions"] == len(rows)
        assert mine["city_count"] == len({r["merchant_city"] for r in rows} - {None})
        assert mine["active_days"] == len({r["tx_day"] for r in rows})
        assert mine["mcc_count"] == len({r["mcc"] for r in rows})
        assert mine["amount_total"] == float(sum(Decimal(r["amount"][1:]) for r in rows))
        assert mine["error_count"] == sum(r["has_error"] for r in rows)


def test_no_second_pass_without_hot_cards(staged):
    frame = scoring.card_risk_features(staged)
    frame.collect()
    final = plan_of(frame).split("Initial Plan")[0]
    # Only the branch of ordinary cards is left, and it needs one exchange.
    assert "collect_set" in final and "Expand" not in final and "Union" not in final


def _jobs_started(spark, build) -> int:
    """Jobs that Spark started while something was built."""
    tracker, group = spark.sparkContext.statusTracker(), f"planning-{id(build)}"
    spark.sparkContext.setJobGroup(group, "planning")
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


#: Queries that write a table and read it back.
SINKS = FILE_QUERIES | {"export_with_a_broken_sink", "partitioned_write", "lineitem_partitioned_write", "lineitem_one_month_again",
                        "csv_transactions_scan", "csv_cards_scan", "csv_users_scan", "mcc_json_scan",
                        "fraud_labels_scan", "fraud_labels_document_scan"}


def test_broken_export_works_its_results_out_once(spark, sf_dir, monkeypatch):
    """Both runs, also the failing one, read stored results."""
    given, export_all = [], export.export_all
    monkeypatch.setattr(export, "export_all", lambda results, *rest: given.append(results) or export_all(results, *rest))
    assert all_queries()["export_with_a_broken_sink"](spark, sf_dir).count() == 6
    assert len(given) == 2
    for name in ("error_rates", "levels"):
        assert all(f"broken-export-{name}-" in file for results in given for file in results[name].inputFiles())


def test_no_job_runs_while_a_query_is_planned(spark, sf_dir):
    for name in sorted(set(all_queries()) - SINKS):
        assert _jobs_started(spark, lambda: all_queries()[name](spark, sf_dir)) == 0, name
    assert _jobs_started(spark, lambda: all_queries()["partitioned_write"](spark, sf_dir)) > 0


def _scans(node) -> list[str]:
    """The scans of an executed plan and its subqueries, without those of a reused exchange or subquery."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _scans(node.executedPlan())
    if "QueryStage" in name:
        return _scans(node.plan())
    if name.startswith("Reused"):
        return []
    found = [node.simpleString(1000)] if name.startswith("Scan parquet") else []
    for below in (node.children(), node.subqueries()):
        for i in range(below.size()):
            found += _scans(below.apply(i))
    return found


def _transaction_scans(frame) -> int:
    frame.collect()
    return sum("merchant_id#" in s or "card_id#" in s for s in _scans(frame._jdf.queryExecution().executedPlan()))


def test_segments_are_one_pass(staged):
    frame = segments.scored_segments(staged, FIXTURE_POLICY)
    assert _transaction_scans(frame) == 1
    assert "Expand" not in plan_of(frame)


def test_summary_reads_transactions_twice(spark, sf_dir, staged):
    from cardwarden.plans import summary

    d = Inputs(spark, sf_dir)
    frame = summary.summary(staged, d.users, d.cards, scoring.card_levels(staged))
    assert _transaction_scans(frame) == 2


@pytest.mark.parametrize("anti", [False, True])
def test_a_heavy_suspect_card_is_split(spark, skewed, by_hand, anti):
    """Without broadcast, the join to planned suspects shuffles, and adaptive execution splits card 1."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        policy = RiskPolicy(high_risk_score=25.0)
        suspects = scoring.high_risk_cards(scoring.card_levels(skewed, policy), policy)
        known = {r["card_id"] for r in suspects.collect()}
        chosen = (segments.normal_transactions if anti else segments.suspect_transactions)(skewed, suspects)
        got = {r["id"] for r in chosen.collect()}
        plan = plan_of(chosen).split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert 1 in known and "skew=true" in plan
    inside = lambda r: r["card_id"] is not None and r["card_id"] in known
    assert got == {r["id"] for r in by_hand if inside(r) != anti}


def test_sketches_of_card_days_give_quantiles(skewed, by_hand):
    sketches = rollups.amount_sketches(skewed)
    quantiles = (0.1, 0.5, 0.9)
    everything = profiling.amount_quantiles(sketches, quantiles)
    assert all(r["within"] for r in profiling.quantile_ranks(skewed, everything, rollups.RANK_ERROR).collect())
    far = everything.withColumn("estimate", F.col("estimate") * 1.2)
    assert not any(r["within"] for r in profiling.quantile_ranks(skewed, far, rollups.RANK_ERROR).filter("quantile > 0.2").collect())
    cards = {(r["card_id"], r["quantile"]): r["estimate"] for r in profiling.amount_quantiles(sketches, quantiles, "card_id").collect()}
    for card in (7, 12):
        amounts = sorted(r["amount_num"] for r in by_hand if r["card_id"] == card)
        assert min(amounts) <= cards[card, 0.5] <= max(amounts)
        below = sum(a < cards[card, 0.5] for a in amounts) / len(amounts)
        assert below <= 0.5 + 1 / len(amounts)


def test_previous_row_without_hot_cards_is_one_window(staged):
    frame = sequences.velocity(staged)
    frame.collect()
    final = plan_of(frame).split("Initial Plan")[0]
    assert "Window [" in final and "max_by" not in final and "SortMergeJoin" not in final


def test_alerts_of_skewed_cards(skewed, by_hand):
    days = {}
    for r in by_hand:
        days.setdefault((r["card_id"], r["tx_day"]), []).append(r)
    expected = {}
    for key, rows in days.items():
        met = (
            (len(rows) > 10)
            + (len({r["merchant_city"] for r in rows} - {None}) > 3)
            + (sum(Decimal(r["amount"][1:]) for r in rows) > 1000)
        )
        if met:
            expected[key] = met
    got = alerts.suspicious_card_days(rollups.daily_totals(skewed)).collect()
    assert {(r["card_id"], r["tx_day"]): r["criteria_count"] for r in got} == expected
    levels = {r["alert_level"]: r for r in alerts.alerts_by_level(rollups.daily_totals(skewed)).collect()}
    names = {3: "CRITICAL", 2: "HIGH", 1: "MODERATE"}
    for number, name in names.items():
        keys = [k for k, met in expected.items() if met == number and k[0] is not None]
        if keys:
            assert levels[name]["suspicious_days"] == len(keys)
            assert levels[name]["card_count"] == len({k[0] for k in keys})


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_segments_with_and_without_broadcast(spark, skewed, by_hand, threshold):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    suspects = spark.createDataFrame([(1,), (5,)], "card_id long")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = {r["segment"]: r for r in segments.segment_comparison(skewed, suspects).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for name, rows in (
        ("SUSPECT", [r for r in by_hand if r["card_id"] in (1, 5)]),
        ("NORMAL", [r for r in by_hand if r["card_id"] not in (1, 5)]),
    ):
        assert got[name]["tx_count"] == len(rows)
        assert got[name]["city_count"] == len({r["merchant_city"] for r in rows} - {None})
        mean = float(sum(Decimal(r["amount"][1:]) for r in rows)) / len(rows)
        assert got[name]["mean_amount"] == mean
        spread = (sum((r["amount_num"] - mean) ** 2 for r in rows) / (len(rows) - 1)) ** 0.5
        assert abs(got[name]["stddev_amount"] - spread) < 1e-6
    assert got["SUSPECT"]["tx_count"] + got["NORMAL"]["tx_count"] == len(by_hand)


def test_rollups_give_the_same_reports(spark, skewed):
    calendar = rollups.calendar_totals(skewed)
    for report in (profiling.tx_by_hour, profiling.hour_shares, profiling.tx_by_weekday, profiling.tx_by_month):
        assert report(calendar).collect() == report(skewed).collect()
    totals, scores = rollups.card_totals(skewed), scoring.card_scores(skewed)
    cards = spark.range(150).select("id", (F.col("id") % 9).alias("client_id"))
    for report in (
        profiling.tx_per_card,
        errors.error_ratio_by_card,
        errors.error_rate_by_card,
        lambda t: errors.error_rate_by_client(t, cards),
    ):
        assert report(scores).collect() == report(totals).collect()


def test_buckets_and_levels_add_up(spark, sf_dir):
    tx = Inputs(spark, sf_dir).tx
    buckets = profiling.amount_buckets(tx).agg(F.sum("tx_count")).first()[0]
    assert buckets == tx.filter("amount_num IS NOT NULL").count()
    scores = scoring.card_scores(tx)
    assert scoring.risk_distribution(scores).agg(F.sum("card_count")).first()[0] == scores.count()
    days = rollups.daily_totals(tx)
    found = alerts.suspicious_card_days(days)
    fired = alerts.alerts_by_criterion(days).first()
    assert sum(fired) >= found.count()
    assert found.filter("criteria_count < 1 OR criteria_count > 3").count() == 0


LEVELS = ("CRITICAL", "HIGH", "MODERATE", "LOW", "NORMAL")


@pytest.mark.parametrize(
    "scale, buckets, error_counts, days, levels, fixture_days, fixture_levels",
    [
        ("sf0.001", (206, 426, 353, 15), (28, 52, 31), (337, 60, 0, 0), (0, 0, 15, 0, 0),
         (322, 49, 18, 8), (2, 2, 7, 2, 2)),
        ("sf0.01", (2221, 4288, 3324, 167), (306, 620, 282), (3445, 561, 0, 0), (0, 6, 138, 6, 0),
         (3223, 524, 189, 70), (6, 39, 62, 29, 14)),
    ],
)
def test_known_figures(
    spark, sf_dir, scale, buckets, error_counts, days, levels, fixture_days, fixture_levels
):
    """Counts that were measured independently on the same mapping."""
    tx = Inputs(spark, sf_dir.replace("sf0.001", scale)).tx
    assert {r["amount_bucket"]: r["tx_count"] for r in profiling.amount_buckets(tx).collect()} == dict(
        zip(("<10", "10-50", "50-200", ">200"), buckets)
    )
    assert {r["errors"]: r["error_count"] for r in errors.error_types(tx).collect()} == dict(
        zip(("Bad PIN", "Insufficient Balance", "Technical Glitch"), error_counts)
    )
    totals = rollups.daily_totals(tx)
    features_of_cards = scoring.card_risk_features(tx)
    for policy, by_criteria, by_level in (
        (RiskPolicy(), days, levels),
        (FIXTURE_POLICY, fixture_days, fixture_levels),
    ):
        flagged = alerts.flagged_days(totals, policy).groupBy("criteria_count").count().collect()
        found = {r["criteria_count"]: r["count"] for r in flagged}
        assert tuple(found.get(n, 0) for n in (1, 2, 3)) == by_criteria[1:]
        assert totals.count() - sum(found.values()) == by_criteria[0]
        scores = scoring.score_cards(features_of_cards, policy)
        found = {r["risk_level"]: r["card_count"] for r in scoring.risk_distribution(scores).collect()}
        assert tuple(found.get(name, 0) for name in LEVELS) == by_level
