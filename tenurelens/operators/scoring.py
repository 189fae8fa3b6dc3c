"""Batch scoring: survival at fixed horizons, median, hazard and risk segment per customer.

A score is a handful of column expressions over the feature matrix; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.functions import scalars as S
from tenurelens.operators.cox import CoxModel
from tenurelens.operators.drift import fixed_histogram
from tenurelens.sources.schemas import HORIZONS, SCORE_COLUMNS


def active(features: DataFrame, event: str = "is_churned") -> DataFrame:
    return features.where(F.col(event) == 0)


def score(
    features: DataFrame, model: CoxModel, score_date: str, high: float = 0.30, medium: float = 0.60,
    id_col: str = "customer_id", how: str = "nearest",
) -> DataFrame:
    if id_col not in features.columns:
        features = features.withColumn(id_col, F.monotonically_increasing_id().cast("string"))
    hazard = F.col("partial_hazard")
    groups = [] if model.strata in (None, "customer_id") else [model.strata]
    ready = features.select(
        F.col(id_col).alias("customer_id"), *groups, model.partial_hazard(features).alias("partial_hazard")
    )
    scored = model.with_median(ready, "median_survival_days", "customer_id", hazard).withColumn(
        "score_date", F.lit(score_date)
    )
    scored = model.with_survival(scored, HORIZONS, how, hazard)
    segment = S.risk_segment(F.col("survival_prob_90d"), high, medium)
    return scored.withColumn("churn_risk_segment", segment).select(*SCORE_COLUMNS)


def segment_shares(scores: DataFrame) -> DataFrame:
    """Customers and share per score date and risk segment."""
    counts = scores.groupBy("score_date", "churn_risk_segment").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy("score_date").agg(F.sum("n").alias("_all"))
    return counts.join(whole, on="score_date").select(
        "score_date", "churn_risk_segment", "n", (F.col("n") / F.col("_all")).alias("share")
    )


def score_histogram(scores: DataFrame, column: str = "survival_prob_90d", bins: int = 10) -> DataFrame:
    return fixed_histogram(scores, column, [k / bins for k in range(bins + 1)])
