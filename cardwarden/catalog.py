"""Every analysis by name, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import fixtures
from cardwarden.fixtures import FIXTURE_POLICY, Inputs
from cardwarden.functions import money
from cardwarden.operators.ranking import first_rows
from cardwarden.plans import (
    alerts,
    errors,
    evaluation,
    export,
    features,
    profiling,
    quality,
    rollups,
    scoring,
    segments,
    sequences,
    summary,
)
from cardwarden.policy import RiskPolicy
from cardwarden.schemas import FRAUD_LABELS
from cardwarden.sources import files
from cardwarden.sources.shared import shared_folder, shared_table

Query = Callable[[SparkSession, str], DataFrame]

DEFAULT = RiskPolicy()


def _rounded(rows: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round values whose last digits depend on the order of floating-point sums."""
    return rows.withColumns({name: F.round(name, digits) for name in names})


# Rule analyses, run under both policies ---------------------------------------------------


def _alerts_by_policy(policy: RiskPolicy) -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        "suspicious_card_days": lambda d: alerts.suspicious_card_days(d.days, policy),
        "alerts_by_criterion": lambda d: alerts.alerts_by_criterion(d.days, policy),
        "alerts_by_level": lambda d: alerts.alerts_by_level(d.days, policy),
        "top_suspicious_cards": lambda d: alerts.top_suspicious_cards(d.days, policy),
        "top_suspicious_cards_lexical": lambda d: alerts.top_suspicious_cards(
            d.days, replace(policy, lexical_level_max=True)
        ),
    }


def _scores_by_policy(policy: RiskPolicy) -> dict[str, Callable[[Inputs], DataFrame]]:
    def scores(d: Inputs) -> DataFrame:
        return scoring.card_levels(d.tx, policy)

    return {
        "card_risk_score": lambda d: scoring.card_risk_score(d.tx, policy),
        "risk_distribution": lambda d: scoring.risk_distribution(scores(d)),
        "high_risk_cards": lambda d: scoring.high_risk_cards(scores(d), policy),
        "segment_comparison": lambda d: _segments(d.tx, policy),
        "suspect_transactions": lambda d: segments.suspect_transactions(
            d.raw, scoring.high_risk_cards(scores(d), policy)
        ),
        "normal_transactions": lambda d: segments.normal_transactions(
            d.raw, scoring.high_risk_cards(scores(d), policy)
        ),
        "summary": lambda d: summary.summary(d.tx, d.users, d.cards, scores(d), policy),
        "dark_web_cards": lambda d: scoring.dark_web_cards(scores(d), d.typed_cards, policy),
        "fraud_label_eval": lambda d: evaluation.fraud_label_eval(
            d.tx, d.labels, scores(d), policy
        ),
    }


def _segments(tx: DataFrame, policy: RiskPolicy) -> DataFrame:
    return _rounded(segments.scored_segments(tx, policy), 6, "stddev_amount")


# Analyses without policy or with the default one -------------------------------------------

QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
# Amounts beyond the range of exact sums, and one below a millionth.
EXTREMES = ("$1e32", "$6e31", "$0.0000004", "$123456789012.25")


def _approximate_stats(tx: DataFrame) -> DataFrame:
    """Mean, ends, and whether the approximate median has a rank near the middle."""
    stats = profiling.amount_stats(tx, approximate=True)
    median = stats.select(F.lit(0.5).alias("quantile"), F.col("median_amount").alias("estimate"))
    within = profiling.quantile_ranks(tx, median, 0.001).agg(F.bool_and("within")).scalar()
    return stats.drop("median_amount").withColumn("median_within", within)


def _extreme_totals(raw: DataFrame) -> DataFrame:
    """Totals per channel where some amounts are extreme, rounded where doubles were added."""
    number = (F.col("id") % 1000).cast("int")
    extreme = F.get(F.array(*map(F.lit, EXTREMES)), number)
    tx = features.with_features(raw.withColumn("amount", F.coalesce(extreme, F.col("amount"))))
    kind = F.when(number < len(EXTREMES), number).otherwise(F.lit(-1))
    exact = F.col("amount_exact")
    sums = tx.groupBy(kind.alias("kind")).agg(
        F.count(exact).alias("amount_count"),
        money.total(exact).alias("amount_total"),
        F.max("amount_num").alias("amount_max"),
    )
    return sums.withColumn("amount_total", F.format_string("%.9e", "amount_total"))


def _contradicted(labels: DataFrame) -> DataFrame:
    """The labels, some of them again with the opposite answer or with none."""
    id_ = F.col("transaction_id")
    again = labels.filter(id_ % 7 == 0).withColumn("is_fraud", ~F.col("is_fraud"))
    unanswered = labels.filter(id_ % 11 == 0).withColumn("is_fraud", F.lit(None).cast("boolean"))
    return labels.unionByName(again).unionByName(unanswered).unionByName(again)


_PLAIN: dict[str, Callable[[Inputs], DataFrame]] = {
    "schema_report": lambda d: quality.schema_report(
        {"cards": d.cards, "transactions": d.raw, "users": d.users, "mcc_codes": d.codes}
    ),
    "volumetry": lambda d: quality.volumetry(d.tx, d.users, d.cards),
    "transaction_profile": lambda d: quality.transaction_profile(d.tx),
    "null_counts": lambda d: quality.null_counts(d.raw),
    "clean_amounts": lambda d: features.clean_amounts(d.tx),
    "non_positive_amounts": lambda d: quality.non_positive_amounts(d.tx),
    "missing_mcc": lambda d: quality.missing_mcc(d.raw),
    "amount_stats": lambda d: profiling.amount_stats(d.tx),
    "amount_stats_exact": lambda d: profiling.amount_stats_exact(d.tx),
    "amount_stats_approximate": lambda d: _approximate_stats(d.tx),
    "amount_quantiles": lambda d: profiling.quantile_ranks(
        d.tx, profiling.amount_quantiles(rollups.amount_sketches(d.tx), QUANTILES), rollups.RANK_ERROR
    ),
    "extreme_amount_totals": lambda d: _extreme_totals(d.raw),
    "fraud_label_conflicts": lambda d: evaluation.single_labels(_contradicted(d.labels)),
    "amount_buckets": lambda d: profiling.amount_buckets(d.tx),
    "time_features": lambda d: features.time_features(d.tx),
    "tx_by_hour": lambda d: profiling.tx_by_hour(d.tx),
    "tx_by_weekday": lambda d: profiling.tx_by_weekday(d.tx),
    "enriched_transactions": lambda d: features.enriched_transactions(d.tx, d.codes),
    "enriched_sample": lambda d: first_rows(
        features.enriched_transactions(d.tx, d.codes), "id", DEFAULT.sample_rows
    ),
    "enriched_sample_fixture_policy": lambda d: first_rows(
        features.enriched_transactions(d.tx, d.codes), "id", FIXTURE_POLICY.sample_rows
    ),
    "top_categories": lambda d: profiling.top_categories(d.code_totals, d.codes),
    "avg_amount_by_category": lambda d: profiling.avg_amount_by_category(d.code_totals, d.codes),
    "tx_per_card_day": lambda d: alerts.tx_per_card_day(d.days),
    "amount_per_card_day": lambda d: alerts.amount_per_card_day(d.days),
    "cities_per_card": lambda d: profiling.cities_per_card(d.tx),
    "error_ratio_global": lambda d: errors.error_ratio_global(d.tx),
    "error_ratio_by_card": lambda d: errors.error_ratio_by_card(d.card_totals),
    "card_daily_stats": lambda d: alerts.card_daily_stats(d.days),
    "error_transactions": lambda d: errors.error_transactions(d.tx),
    "error_types": lambda d: errors.error_types(d.tx),
    "error_rate_by_card": lambda d: errors.error_rate_by_card(d.card_totals),
    "error_rate_by_client": lambda d: errors.error_rate_by_client(d.card_totals, d.cards),
    "error_rate_by_category": lambda d: errors.error_rate_by_category(d.code_totals, d.codes),
    "card_risk_features": lambda d: scoring.card_risk_features(d.tx),
    "tx_per_card": lambda d: profiling.tx_per_card(d.card_totals),
    "tx_per_client": lambda d: profiling.tx_per_client(d.tx),
    "tx_per_merchant": lambda d: profiling.tx_per_merchant(d.tx),
    "amount_bucket_shares": lambda d: profiling.amount_bucket_shares(d.tx),
    "night_activity": lambda d: profiling.night_activity(d.tx),
    "night_activity_by_card": lambda d: profiling.night_activity_by_card(d.tx),
    "hour_shares": lambda d: profiling.hour_shares(d.tx),
    "low_risk_categories": lambda d: errors.low_risk_categories(d.code_totals, d.codes),
    "low_risk_categories_fixture_policy": lambda d: errors.low_risk_categories(
        d.code_totals, d.codes, FIXTURE_POLICY
    ),
    "amount_dispersion": lambda d: _rounded(
        profiling.amount_dispersion(d.tx), 6, "stddev_amount"
    ),
    "tx_per_card_hour": lambda d: profiling.tx_per_card_hour(d.tx),
    "card_hour_peaks": lambda d: profiling.card_hour_peaks(d.tx),
    "impossible_travel": lambda d: _rounded(
        sequences.impossible_travel(d.tx, d.places), 3, "distance_km"
    ),
    "channel_profile": lambda d: profiling.channel_profile(d.tx),
    "velocity": lambda d: sequences.velocity(d.tx),
    "client_context": lambda d: errors.client_context(d.card_totals, d.cards, d.users),
    "card_age": lambda d: sequences.card_age(d.tx, d.typed_cards),
    "typed_cards": lambda d: d.typed_cards,
    "typed_users": lambda d: d.typed_users,
    "tx_by_month": lambda d: profiling.tx_by_month(d.tx),
    "online_geography": lambda d: quality.online_geography(d.raw),
}


# Files -------------------------------------------------------------------------------------


def _results(d: Inputs) -> dict[str, tuple[DataFrame, str]]:
    """The results that a run saves, with a figure of each."""
    return {
        "card_risk_scores": (scoring.card_risk_score(d.tx), "risk_score"),
        "suspicious_cards": (alerts.suspicious_card_days(d.days), "day_amount"),
        "error_rates": (errors.error_rate_by_card(d.card_totals), "error_rate"),
        export.ENRICHED: (features.enriched_transactions(d.tx, d.codes), "amount_num"),
    }


def _export_all(d: Inputs) -> DataFrame:
    """Write all eight sinks, read each back and count its rows."""
    spark = d.spark
    results = {name: rows for name, (rows, _) in _results(d).items()}
    enriched = results.pop(export.ENRICHED)
    statuses = export.export_all(results, enriched, shared_folder(spark, "export"), FIXTURE_POLICY)
    saved = {}
    for status in statuses:
        reader = spark.read.option("header", True)
        read = reader.csv if status.file_format == "csv" else reader.parquet
        rows = read(status.path)
        saved[f"{status.file_format}:{status.sink}"] = rows
    return export.row_counts(saved)


def _read_results(d: Inputs) -> DataFrame:
    """The four Parquet results, written and read back: the figure of each of their rows."""
    folder = shared_folder(d.spark, "results")
    figures = {name: figure for name, (_, figure) in _results(d).items()}
    for name, (rows, _) in _results(d).items():
        export.write_parquet(rows, f"{folder}/parquet/{name}")
    saved = export.read_results(d.spark, folder, list(figures))
    union = None
    for name, rows in saved.items():
        part = rows.select(F.lit(name).alias("result"), "card_id", F.col(figures[name]).cast("double").alias("figure"))
        union = part if union is None else union.unionByName(part)
    return union


def _partitioned_write(d: Inputs) -> DataFrame:
    return _by_month(features.enriched_transactions(d.tx, d.codes))


def _by_month(rows: DataFrame) -> DataFrame:
    """Transactions written by month, read back and counted per month."""
    spark = rows.sparkSession
    path = shared_folder(spark, "by-month")
    export.write_parquet(rows, path, "tx_month")
    return spark.read.parquet(path).groupBy("tx_month").agg(F.count("*").alias("tx_count"))


def _one_month_again(d: Inputs) -> DataFrame:
    """Line items by month, of which one month is replaced, read back by months."""
    tx = features.with_features(fixtures.lineitem_transactions(d.spark, d.folder))
    path = shared_folder(d.spark, "month-again")
    export.write_parquet(tx.select("id", "amount_num", "tx_month"), path, "tx_month")
    again = tx.filter(F.col("tx_month") == 3).select("id", (F.col("amount_num") * 2).alias("amount_num"), "tx_month")
    export.replace_partitions(again.filter(F.col("id") % 2 == 0), path, "tx_month")
    saved = d.spark.read.parquet(path).filter(F.col("tx_month").isin(2, 3, 4))
    return saved.groupBy("tx_month").agg(F.count("*").alias("tx_count"), F.max("amount_num").alias("amount_max"))


def _broken_export(d: Inputs) -> DataFrame:
    """Results saved twice, where the second run of one fails: status of each sink, and the rows that can be read."""
    spark, folder = d.spark, shared_folder(d.spark, "broken-export")
    results = {"error_rates": errors.error_rate_by_card(d.card_totals), "levels": scoring.card_levels(d.tx)}
    # Four sinks of two runs read each of them, so it is worked out once.
    results = {name: shared_table(rows, f"broken-export-{name}") for name, rows in results.items()}
    enriched = features.enriched_transactions(d.tx, d.codes)
    export.export_all(results, enriched, folder, FIXTURE_POLICY)
    failing = results["levels"].withColumn("risk_level", F.raise_error(F.lit("no such thing")).cast("string"))
    try:
        statuses = export.export_all({**results, "levels": failing}, enriched, folder, FIXTURE_POLICY)
    except export.ExportError as error:
        statuses = error.statuses
    saved = {}
    for s in statuses:
        read = spark.read.option("header", True).csv if s.file_format == "csv" else spark.read.parquet
        saved[f"{s.file_format}:{s.sink}"] = read(s.path)
    name = F.concat_ws(":", "file_format", "sink")
    failed = F.col("error").contains("no such thing")
    told = export.statuses_frame(spark, statuses).select(name.alias("sink"), F.coalesce(failed, F.lit(False)).alias("failed"))
    return told.join(export.row_counts(saved), "sink")


def _csv_round_trip(rows: DataFrame, label: str, read: Callable) -> DataFrame:
    path = shared_folder(rows.sparkSession, label)
    export.csv_writer(rows).csv(path)
    return read(rows.sparkSession, path)


def _mcc_json(d: Inputs) -> DataFrame:
    """The code table as JSON documents of some thousand codes each, read back."""
    path = shared_folder(d.spark, "mcc-json")
    entries = F.map_from_entries(F.collect_list(F.struct("mcc", "merchant_category")))
    _write_documents(d.codes, "mcc", F.to_json(entries), path)
    return files.read_mcc_codes(d.spark, path)


def _write_documents(rows: DataFrame, key: str, document: Column, path: str) -> None:
    """One JSON document per file; their number grows with the rows."""
    number = F.floor(rows.agg(F.count("*")).scalar() / 5_000) + 1
    dealt = rows.withColumn("document", F.pmod(F.xxhash64(key), number))
    texts = dealt.groupBy("document").agg(document.alias("value"))
    texts.write.partitionBy("document").text(path)


def _labels_document(d: Inputs) -> DataFrame:
    """The labels as JSON documents over several lines, read with a schema."""
    path = shared_folder(d.spark, "labels-document")
    rows = F.collect_list(F.struct("transaction_id", "is_fraud"))
    _write_documents(d.labels, "transaction_id", F.to_json(rows, {"pretty": "true"}), path)
    return files.read_json_document(d.spark, path, FRAUD_LABELS).select(*FRAUD_LABELS.fieldNames())


def _labels_json(d: Inputs) -> DataFrame:
    spark = d.spark
    path = shared_folder(spark, "labels-json")
    answer = F.when(F.col("is_fraud"), "Yes").otherwise("No")
    line = F.format_string('"%d": "%s",', F.col("transaction_id"), answer)
    d.labels.select(line.alias("value")).write.text(path)
    return files.read_fraud_labels(spark, path)


_FILES: dict[str, Callable[[Inputs], DataFrame]] = {
    "csv_transactions_scan": lambda d: _csv_round_trip(d.raw, "tx-csv", files.read_transactions),
    "csv_cards_scan": lambda d: _csv_round_trip(d.cards, "cards-csv", files.read_cards),
    "csv_users_scan": lambda d: _csv_round_trip(d.users, "users-csv", files.read_users),
    "mcc_json_scan": _mcc_json,
    "fraud_labels_scan": _labels_json,
    "fraud_labels_document_scan": _labels_document,
    "export_all": _export_all,
    "read_results": _read_results,
    "partitioned_write": _partitioned_write,
    "lineitem_one_month_again": _one_month_again,
    "export_with_a_broken_sink": _broken_export,
}


# Line items as transactions, the larger table of the bench ---------------------------------


def _on_lineitem(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(
        features.with_features(fixtures.lineitem_transactions(spark, folder))
    )


_LINEITEM: dict[str, Query] = {
    "lineitem_card_daily_stats": _on_lineitem(
        lambda tx: alerts.card_daily_stats(rollups.daily_totals(tx))
    ),
    "lineitem_suspicious_card_days": _on_lineitem(
        lambda tx: alerts.suspicious_card_days(rollups.daily_totals(tx))
    ),
    "lineitem_card_risk_score": _on_lineitem(scoring.card_risk_score),
    "lineitem_tx_by_month": _on_lineitem(profiling.tx_by_month),
    "lineitem_partitioned_write": _on_lineitem(_by_month),
    "lineitem_segment_comparison": _on_lineitem(lambda tx: _segments(tx, DEFAULT)),
}


def _on_events(plan: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: plan(Inputs(spark, folder))


def all_queries() -> dict[str, Query]:
    plans = {**_PLAIN, **_FILES}
    for suffix, policy in (("", DEFAULT), ("_fixture_policy", FIXTURE_POLICY)):
        for name, plan in {**_alerts_by_policy(policy), **_scores_by_policy(policy)}.items():
            plans[name + suffix] = plan
    return {**{name: _on_events(plan) for name, plan in plans.items()}, **_LINEITEM}
