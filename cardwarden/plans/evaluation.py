"""Risk levels against known fraud labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.policy import RiskPolicy


def single_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled transaction, so that a repeated label doesn't count twice.

    Of labels that contradict each other, fraud wins: a report of fraud is kept until someone
    takes it back in the data. Labels without an answer don't count against one with an answer; an id
    with no answer at all stays null, and counts as labelled and not as fraud. Labels without an id go.
    """
    named = labels.filter(F.col("transaction_id").isNotNull())
    return named.groupBy("transaction_id").agg(F.bool_or("is_fraud").alias("is_fraud"))


def fraud_label_eval(
    tx: DataFrame, labels: DataFrame, scores: DataFrame, policy: RiskPolicy = RiskPolicy()
) -> DataFrame:
    """Per risk level: labelled and fraudulent transactions, and the quality of a cut there.

    The confusion matrix takes every transaction of a card at this level or a worse one as
    predicted fraud. Labels meet transactions on the unique transaction id; the rest works
    on one row per card.
    """
    per_card = (
        tx.select(F.col("id").alias("transaction_id"), "card_id")
        .join(single_labels(labels), "transaction_id")
        .groupBy("card_id")
        .agg(F.count("*").alias("n"), F.count_if("is_fraud").alias("fraud"))
    )
    levels = scores.select(F.col("card_id").alias("_card"), "risk_level")
    per_level = (
        per_card.join(levels, F.col("card_id").eqNullSafe(F.col("_card")))
        .groupBy("risk_level")
        .agg(F.sum("n").alias("n"), F.sum("fraud").alias("fraud"))
    )
    named = tx.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(n) for n in policy.level_names])).alias("rank", "risk_level")
    )
    filled = named.join(F.broadcast(per_level), "risk_level", "left").fillna(0, ["n", "fraud"])
    # Five rows, one per level.
    worse = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    overall = Window.orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return (
        filled.withColumns(
            {
                "true_positive": F.sum("fraud").over(worse),
                "_predicted": F.sum("n").over(worse),
                "_fraud": F.sum("fraud").over(overall),
                "_all": F.sum("n").over(overall),
            }
        )
        .withColumns(
            {
                "false_positive": F.col("_predicted") - F.col("true_positive"),
                "false_negative": F.col("_fraud") - F.col("true_positive"),
            }
        )
        .select(
            "risk_level",
            F.col("n").alias("labelled_tx"),
            F.col("fraud").alias("fraud_tx"),
            "true_positive",
            "false_positive",
            "false_negative",
            (F.col("_all") - F.col("_predicted") - F.col("false_negative")).alias("true_negative"),
            F.try_divide("true_positive", "_predicted").alias("precision"),
            F.try_divide("true_positive", "_fraud").alias("recall"),
        )
        .orderBy("rank")
    )
