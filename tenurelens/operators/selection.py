"""Fitting and comparing all models; cross-validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.operators import aft, cox, evaluate
from tenurelens.operators import lifetable as LT
from tenurelens.operators.concordance import concordance, concordance_by
from tenurelens.sources.schemas import AFT_COVARIATES, COX_CATEGORICAL, COX_NUMERIC

REPORT = (
    "model string, concordance_index double, aic double, bic double, median_survival_days double, "
    "survival_prob_90d double, penalizer double, n_events_train bigint"
)


def round_to(value: float | None, places: int) -> float | None:
    return None if value is None else round(value, places)


def compare_models(
    train: DataFrame, test: DataFrame, duration: str = "duration_days", event: str = "is_churned",
    numeric=None, categorical=None, aft_covariates=None, penalizer: float = 0.1, horizon: float = 90,
) -> DataFrame:
    """Kaplan-Meier, Cox and the parametric families, fitted on train and ranked on test.

    Of both tables the columns that the models read are kept for all of them.
    """
    numeric = COX_NUMERIC if numeric is None else numeric
    categorical = COX_CATEGORICAL if categorical is None else categorical
    aft_covariates = AFT_COVARIATES if aft_covariates is None else aft_covariates
    wanted = ("customer_id", duration, event, *numeric, *categorical, *aft_covariates)
    train, test = (df.select(*dict.fromkeys(c for c in wanted if c in df.columns)).persist() for df in (train, test))
    try:
        rows = _compared(train, test, duration, event, numeric, categorical, aft_covariates, penalizer, horizon)
    finally:
        train.unpersist()
        test.unpersist()
    return evaluate.ranked_report(train.sparkSession.createDataFrame(rows, REPORT))


def _compared(
    train: DataFrame, test: DataFrame, duration: str, event: str, numeric, categorical, aft_covariates, penalizer: float, horizon: float
) -> list[tuple]:
    km = LT.km_summary(LT.kaplan_meier(train, duration, event), horizons=(90,), never=None).first()
    # a constant prediction ties on every comparable pair; without one there is no index
    same = test.select(F.lit(0.0).alias("risk"), duration, event)
    constant = concordance(same, "risk", duration, event)["c_index"]
    rows = [("kaplan_meier", constant, None, None, km[0], km[1], None, None)]

    model = cox.fit_cox(train, duration, event, numeric, categorical, penalizer)
    c = model.concordance_index(test, duration, event, horizon)
    rows.append(("cox_ph", round_to(c, 4), None, None, None, None, penalizer, model.n_events))

    for family, m in aft.fit_all_aft(train, duration, event, aft_covariates).items():
        c = m.concordance_index(test, duration, event, horizon)
        rows.append((
            f"parametric_{family}", round_to(c, 4), round(m.aic, 2), round(m.bic, 2), None, None, None, None,
        ))
    return rows


def cross_validate(
    df: DataFrame, model: str = "cox_ph", k: int = 5, duration: str = "duration_days",
    event: str = "is_churned", stratify: str = "segment", id_col: str = "customer_id", seed: int = 42,
    numeric=None, categorical=None, aft_covariates=None, penalizer: float = 0.1, horizon: float = 90,
) -> DataFrame:
    """One row per fold (model, fold, c_index); summarise with `evaluate.cv_summary`."""
    if model != "cox_ph" and model.removeprefix("parametric_") not in aft.FAMILIES:
        raise ValueError(f"cross-validation is not available for {model}")
    folds = evaluate.with_folds(df, k, stratify, event, id_col, seed).persist()
    schema = "model string, fold int, c_index double"
    try:
        if model == "cox_ph":
            fitted = cox.fit_cox_folds(folds, k, duration, event, numeric, categorical, penalizer, horizon=horizon)
            scored = folds.select("fold", fitted.held_out_risk(folds).alias("risk"), duration, event)
        else:
            scored = None
            family = model.removeprefix("parametric_")
            for fold in range(k):
                train, held = folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)
                fitted = aft.fit_aft(train, family, duration, event, aft_covariates)
                one = held.select("fold", (1.0 - fitted.survival(held, horizon)).alias("risk"), duration, event)
                scored = one if scored is None else scored.unionByName(one)
        found = dict(concordance_by(scored, "fold", "risk", duration, event).select("fold", "c_index").collect())
    finally:
        folds.unpersist()
    return df.sparkSession.createDataFrame([(model, fold, found.get(fold)) for fold in range(k)], schema)
