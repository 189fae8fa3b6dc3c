"""Discrimination and calibration measures, splits, and model comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.operators.concordance import concordance
from tenurelens.operators.prefix import rank_by_hash, running_sums

C_INDEX_GATE = 0.68


def one_row(df: DataFrame, values: dict, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(values.values())], schema)


def c_index_report(
    df: DataFrame, risk: str = "risk", duration: str = "duration_days", event: str = "is_churned"
) -> DataFrame:
    counts = concordance(df, risk, duration, event)
    return one_row(df, counts, "comparable decimal(38,0), concordant decimal(38,0), tied decimal(38,0), c_index double")


def brier_terms(survival: str, horizon: float, duration: str, event: str):
    """(evaluable?, squared error) at the horizon; censored before it is not evaluable."""
    known = (F.col(duration) >= horizon) | (F.col(event) == 1)
    happened = ((F.col(event) == 1) & (F.col(duration) <= horizon)).cast("double")
    return known, F.pow(happened - (1.0 - F.col(survival)), 2)


def brier(
    df: DataFrame, survival: str = "survival_prob_90d", horizon: float = 90,
    duration: str = "duration_days", event: str = "is_churned",
) -> DataFrame:
    known, error = brier_terms(survival, horizon, duration, event)
    return df.where(known).agg(F.avg(error).alias("brier_score"), F.count(F.lit(1)).alias("n_evaluated"))


def integrated_brier(
    df: DataFrame, survival: dict[float, str],
    duration: str = "duration_days", event: str = "is_churned",
) -> DataFrame:
    """Trapezoid mean of the Brier score over a grid of horizons, in one pass.

    `survival` maps each horizon to the column with its predicted S.
    """
    grid = sorted(survival)
    aggs = []
    for k, h in enumerate(grid):
        known, error = brier_terms(survival[h], h, duration, event)
        aggs.append(F.avg(F.when(known, error)).alias(f"_b{k}"))
    area = sum(
        ((F.col(f"_b{k}") + F.col(f"_b{k + 1}")) / 2.0 * float(grid[k + 1] - grid[k])
         for k in range(len(grid) - 1)),
        F.lit(0.0),
    )
    return df.agg(*aggs).select(
        *[F.col(f"_b{k}").alias(f"brier_{h:g}d") for k, h in enumerate(grid)],
        (area / float(grid[-1] - grid[0])).alias("integrated_brier"),
    )


def auc_at(
    df: DataFrame, horizon: float, risk: str = "risk",
    duration: str = "duration_days", event: str = "is_churned",
) -> DataFrame:
    """AUC of events up to the horizon against rows followed beyond it (rank sum)."""
    case = (F.col(event) == 1) & (F.col(duration) <= horizon)
    control = F.col(duration) > horizon
    by_risk = (
        df.where((case | control) & F.col(risk).isNotNull())
        .groupBy(F.col(risk).cast("double").alias("r"))
        .agg(F.count_if(case).alias("cases"), F.count_if(control).alias("controls"))
    )
    ranked = running_sums(by_risk, "r", {"so_far": "controls"})
    below = F.col("so_far") - F.col("controls")
    wins = F.sum(F.col("cases") * (below + 0.5 * F.col("controls")))
    n_case, n_control = F.sum("cases"), F.sum("controls")
    return ranked.agg(
        F.lit(float(horizon)).alias("horizon"),
        F.coalesce(n_case, F.lit(0)).alias("cases"),
        F.coalesce(n_control, F.lit(0)).alias("controls"),
        F.try_divide(wins, n_case.cast("double") * n_control).alias("auc"),
    )


def temporal_split(
    df: DataFrame, cutoff: str, date_col: str = "first_purchase_date"
) -> tuple[DataFrame, DataFrame]:
    """Customers acquired on or before the cutoff, and those acquired after it."""
    d, mark = F.col(date_col).cast("date"), F.lit(cutoff).cast("date")
    return df.where(d <= mark), df.where(d > mark)


def split_summary(
    df: DataFrame, cutoff: str, date_col: str = "first_purchase_date", event: str = "is_churned"
) -> DataFrame:
    is_train = (F.col(date_col).cast("date") <= F.lit(cutoff).cast("date")).cast("int")
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(is_train.alias("is_train"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(event).alias("churn_rate"))
    )


def with_folds(
    df: DataFrame, k: int = 5, stratify: str = "segment", event: str = "is_churned",
    id_col: str = "customer_id", seed: int = 42,
) -> DataFrame:
    """Add `fold` 0..k-1, spread evenly inside every stratum of segment and label."""
    label = F.concat_ws(
        "_", F.coalesce(F.col(stratify).cast("string"), F.lit("nan")),
        F.coalesce(F.col(event).cast("string"), F.lit("nan")),
    )
    ranked = rank_by_hash(df.withColumn("_stratum", label), id_col, seed, ("_stratum",), "_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_stratum")


def cv_summary(folds: DataFrame, metric: str = "c_index") -> DataFrame:
    """Mean, population deviation, minimum and maximum over folds."""
    return folds.groupBy("model").agg(
        F.count(F.lit(1)).cast("int").alias("cv_folds"),
        F.round(F.avg(metric), 4).alias(f"{metric}_mean"),
        F.round(F.stddev_pop(metric), 4).alias(f"{metric}_std"),
        F.round(F.min(metric), 4).alias(f"{metric}_min"),
        F.round(F.max(metric), 4).alias(f"{metric}_max"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("fold", metric))),
            lambda r: F.round(r[metric], 4),
        ).alias(f"{metric}s"),
    )


def sample_rows(df: DataFrame, n: int, id_col: str = "customer_id", seed: int = 42) -> DataFrame:
    """At most n rows, chosen by a seeded hash of the id."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), F.col(id_col)).limit(n)


def ranked_report(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc_nulls_last("concordance_index"), "model")


def champion(report: DataFrame) -> DataFrame:
    """The covariate model with the highest concordance."""
    return report.where(F.col("model") != "kaplan_meier").agg(
        F.max_by("model", F.struct("concordance_index", "model")).alias("champion"),
        F.max("concordance_index").alias("concordance_index"),
    )


def parametric_champion(report: DataFrame) -> DataFrame:
    """The parametric family with the lowest AIC."""
    return report.where(F.col("model").startswith("parametric_")).agg(
        F.min_by("model", F.struct("aic", "model")).alias("champion"), F.min("aic").alias("aic")
    )


def final_champion(report: DataFrame) -> DataFrame:
    """Best parametric family by AIC against the Cox model on concordance."""
    best = report.where(F.col("model").startswith("parametric_")).agg(F.min("aic")).scalar()
    finalists = report.where((F.col("model") == "cox_ph") | (F.col("aic") == best))
    return finalists.agg(
        F.max_by("model", F.struct("concordance_index", "model")).alias("champion"),
        F.max("concordance_index").alias("concordance_index"),
    )


def passes_gate(report: DataFrame, model: str = "cox_ph", gate: float = C_INDEX_GATE) -> DataFrame:
    return report.where(F.col("model") == model).select(
        "model", "concordance_index",
        F.coalesce(F.col("concordance_index") >= gate, F.lit(False)).alias("register"),
    )
