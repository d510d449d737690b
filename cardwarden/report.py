"""The whole run: stage the inputs, compute every analysis, save the results.

The shared intermediates (card-days, card scores, suspect cards, code and calendar totals)
are written once to the shared folder, so that the text inputs are parsed once, each rollup
is computed once, and some twenty analyses read a rollup instead of the transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

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
from cardwarden.sources.files import SourcePaths
from cardwarden.sources.shared import shared_table
from cardwarden.sources.staging import Tables, open_sources, open_staged, stage


def analyses(
    tables: Tables, policy: RiskPolicy = RiskPolicy(), places: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every analysis by name, as DataFrames that are computed when used.

    The shared rollups are computed and written by this call.

    ``places`` holds city positions; without it there is no ``impossible_travel``.
    """
    tx, cards, users, codes = tables.tx, tables.cards, tables.users, tables.codes
    raw = tx.drop(*features.FEATURES)
    days = shared_table(rollups.daily_totals(tx), "card-days")
    per_code = shared_table(rollups.code_totals(tx), "code-totals")
    calendar = shared_table(rollups.calendar_totals(tx), "calendar")
    scores = shared_table(scoring.card_scores(tx, policy), "card-scores")
    suspects = shared_table(scoring.high_risk_cards(scores, policy), "suspects")
    results = {
        "schema_report": quality.schema_report(
            {"cards": cards, "transactions": raw, "users": users, "mcc_codes": codes}
        ),
        "volumetry": quality.volumetry(tx, users, cards),
        "transaction_profile": quality.transaction_profile(tx),
        "null_counts": quality.null_counts(raw),
        "online_geography": quality.online_geography(raw),
        "amount_stats": profiling.amount_stats(tx),
        "amount_bucket_shares": profiling.amount_bucket_shares(tx),
        "amount_dispersion": profiling.amount_dispersion(tx),
        "hour_shares": profiling.hour_shares(calendar),
        "tx_by_weekday": profiling.tx_by_weekday(calendar),
        "tx_by_month": profiling.tx_by_month(calendar),
        "night_activity": profiling.night_activity(tx, policy),
        "night_activity_by_card": profiling.night_activity_by_card(tx, policy),
        "tx_per_card_hour": profiling.tx_per_card_hour(tx),
        "card_hour_peaks": profiling.card_hour_peaks(tx),
        "enriched_transactions": features.enriched_transactions(tx, codes),
        "top_categories": profiling.top_categories(per_code, codes, policy),
        "avg_amount_by_category": profiling.avg_amount_by_category(per_code, codes),
        "tx_per_card": profiling.tx_per_card(scores),
        "tx_per_client": profiling.tx_per_client(tx),
        "tx_per_merchant": profiling.tx_per_merchant(tx),
        "channel_profile": profiling.channel_profile(tx),
        "cities_per_card": profiling.cities_per_card(tx),
        "tx_per_card_day": alerts.tx_per_card_day(days),
        "amount_per_card_day": alerts.amount_per_card_day(days),
        "card_daily_stats": alerts.card_daily_stats(days),
        "suspicious_card_days": alerts.suspicious_card_days(days, policy),
        "alerts_by_criterion": alerts.alerts_by_criterion(days, policy),
        "alerts_by_level": alerts.alerts_by_level(days, policy),
        "top_suspicious_cards": alerts.top_suspicious_cards(days, policy),
        "error_ratio_by_card": errors.error_ratio_by_card(scores, policy),
        "error_types": errors.error_types(tx),
        "error_rate_by_card": errors.error_rate_by_card(scores, policy),
        "error_rate_by_client": errors.error_rate_by_client(scores, cards, policy),
        "error_rate_by_category": errors.error_rate_by_category(per_code, codes, policy),
        "low_risk_categories": errors.low_risk_categories(per_code, codes, policy),
        "client_context": errors.client_context(scores, cards, users, policy),
        "card_risk_score": scores.orderBy(scores["risk_score"].desc(), "card_id"),
        "risk_distribution": scoring.risk_distribution(scores),
        "high_risk_cards": suspects,
        "dark_web_cards": scoring.dark_web_cards(scores, cards, policy),
        "suspect_transactions": segments.suspect_transactions(raw, suspects),
        "normal_transactions": segments.normal_transactions(raw, suspects),
        "segment_comparison": segments.segment_comparison(tx, suspects),
        "velocity": sequences.velocity(tx),
        "card_age": sequences.card_age(tx, cards),
        "fraud_label_eval": evaluation.fraud_label_eval(tx, tables.labels, scores, policy),
        "summary": summary.summary(tx, users, cards, scores, policy),
    }
    if places is not None:
        results["impossible_travel"] = sequences.impossible_travel(tx, places, policy)
    return results


def run(
    spark: SparkSession,
    sources: SourcePaths,
    folder: str,
    policy: RiskPolicy = RiskPolicy(),
    places: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Stage the sources under ``folder``, compute every analysis and save the main results."""
    stage(open_sources(spark, sources), f"{folder}/staged")
    results = analyses(open_staged(spark, f"{folder}/staged"), policy, places)
    saved = {
        "card_risk_scores": results["card_risk_score"],
        "suspicious_cards": results["suspicious_card_days"],
        "error_rates": results["error_rate_by_card"],
    }
    export.export_all(saved, results["enriched_transactions"], folder, policy)
    return results
