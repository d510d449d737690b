"""One-row summary of the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.ratios import percent
from cardwarden.plans.quality import volumetry
from cardwarden.policy import RiskPolicy


def summary(
    tx: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    scores: DataFrame,
    policy: RiskPolicy = RiskPolicy(),
) -> DataFrame:
    risk = scores.agg(
        F.struct(
            F.count_if(F.col("risk_score") >= policy.high_risk_score).alias("high"),
            F.count("*").alias("all"),
        )
    ).scalar()
    return volumetry(tx, users, cards).withColumns(
        {
            "high_risk_cards": risk["high"],
            "scored_cards": risk["all"],
            "high_risk_pct": F.round(percent(risk["high"], risk["all"]), 2),
        }
    )
