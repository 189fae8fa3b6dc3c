"""Realised model performance over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenurelens.operators.concordance import concordance, concordance_by
from tenurelens.operators.evaluate import brier_terms
from tenurelens.sources.tables import read_parquet, write_parquet

C_INDEX_MIN = 0.70
MAX_DROP = 0.02

RECORD = (
    "run_date string, c_index double, brier_score double, n_customers bigint, n_churned bigint, "
    "below_threshold boolean"
)


def realised(scores: DataFrame, outcomes: DataFrame, score_date: str, id_col: str = "customer_id") -> DataFrame:
    """Scores of one past date with what has become of the customers since."""
    past = scores.where(F.col("score_date") == F.lit(score_date))
    return past.join(outcomes, on=id_col)


def evaluate(
    realised_rows: DataFrame, run_date: str, survival: str = "survival_prob_90d",
    duration: str = "duration_days", event: str = "is_churned", horizon: float = 90,
    c_index_min: float = C_INDEX_MIN,
) -> DataFrame:
    """One unrounded performance record."""
    known, error = brier_terms(survival, horizon, duration, event)
    brier, n, churned = realised_rows.agg(
        F.avg(F.when(known, error)), F.count(F.lit(1)), F.coalesce(F.sum(event), F.lit(0)).cast("bigint")
    ).first()
    scored = realised_rows.select((1.0 - F.col(survival)).alias("risk"), duration, event)
    c = concordance(scored, "risk", duration, event)["c_index"]
    row = (run_date, c, brier, n, churned, None if c is None else c < c_index_min)
    return realised_rows.sparkSession.createDataFrame([row], RECORD)


def evaluate_runs(
    realised_rows: DataFrame, run: str = "run_date", survival: str = "survival_prob_90d",
    duration: str = "duration_days", event: str = "is_churned", horizon: float = 90,
    c_index_min: float = C_INDEX_MIN,
) -> DataFrame:
    """One unrounded performance record per value of `run`, all of them from one job."""
    known, error = brier_terms(survival, horizon, duration, event)
    sums = realised_rows.groupBy(F.col(run).cast("string").alias("run_date")).agg(
        F.avg(F.when(known, error)).alias("brier_score"), F.count(F.lit(1)).alias("n_customers"),
        F.coalesce(F.sum(event), F.lit(0)).cast("bigint").alias("n_churned"),
    )
    scored = realised_rows.select(
        F.col(run).cast("string").alias("_run"), (1.0 - F.col(survival)).alias("risk"), duration, event
    )
    found = concordance_by(scored, "_run", "risk", duration, event).select("_run", "c_index")
    return sums.join(found, F.col("run_date").eqNullSafe(F.col("_run"))).select(
        "run_date", "c_index", "brier_score", "n_customers", "n_churned",
        (F.col("c_index") < c_index_min).alias("below_threshold"),
    )


def append_history(record: DataFrame, path: str) -> None:
    write_parquet(record.coalesce(1), path, mode="append")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path)


def with_alerts(
    history: DataFrame, max_drop: float = MAX_DROP, baseline: float | None = None
) -> DataFrame:
    """Adds the drop from the previous run (or from a fixed baseline) and the alert.

    The history has one row per run, so one ordered window over it is small.
    """
    by_run = Window.partitionBy(F.lit(0)).orderBy("run_date")
    before = F.lag("c_index").over(by_run) if baseline is None else F.lit(float(baseline))
    drop = before - F.col("c_index")
    return history.select(
        "*", before.alias("previous_c_index"), F.coalesce(drop > max_drop, F.lit(False)).alias("degradation_alert")
    )


def report(history: DataFrame, max_drop: float = MAX_DROP) -> DataFrame:
    """History with rounded measures."""
    return with_alerts(history, max_drop).select(
        "run_date", F.round("c_index", 4).alias("c_index"), F.round("brier_score", 4).alias("brier_score"),
        "n_customers", "n_churned", "below_threshold", "degradation_alert",
    )


def should_retrain(history: DataFrame, max_drop: float = MAX_DROP) -> DataFrame:
    """One row: does the latest run call for retraining? False without history."""
    signal = F.coalesce("below_threshold", F.lit(False)) | F.col("degradation_alert")
    return with_alerts(history, max_drop).agg(
        F.coalesce(F.max_by(signal, "run_date"), F.lit(False)).alias("should_retrain")
    )
