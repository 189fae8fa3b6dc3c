import numpy as np
import pandas as pd
import pytest

from tenurelens.operators import evaluate as E
from tenurelens.operators.concordance import concordance


def brute(risk, t, e):
    ok = (e[:, None] == 1) & ((t[:, None] < t[None, :]) | ((t[:, None] == t[None, :]) & (e[None, :] == 0)))
    lower, same = risk[None, :] < risk[:, None], risk[None, :] == risk[:, None]
    return int(ok.sum()), int((ok & lower).sum()), int((ok & same).sum())


@pytest.mark.parametrize("risks, times, per_line", [(40, 30, 50_000), (40, 30, 15), (900, 4, 10), (1, 20, 10), (5, 300, 8)])
def test_matches_all_pairs_with_hot_values(spark, risks, times, per_line):
    rng = np.random.default_rng(risks + times)
    n = 400
    risk = rng.integers(0, risks, n) / risks
    t, e = rng.integers(1, times + 1, n), rng.integers(0, 2, n)
    risk[: n // 3] = risk[0]
    t[n // 4 : n // 2] = times
    df = spark.createDataFrame(pd.DataFrame({"risk": risk, "duration_days": t, "is_churned": e}))
    got = concordance(df, points_per_line=per_line)
    assert (got["comparable"], got["concordant"], got["tied"]) == brute(risk, t, e)


def test_no_pair_gives_none(spark):
    df = spark.createDataFrame([(0.1, 5, 0), (0.2, 6, 0)], "risk double, duration_days int, is_churned int")
    assert concordance(df)["c_index"] is None


def test_auc_matches_all_pairs(spark):
    rng = np.random.default_rng(8)
    n = 300
    risk, t, e = rng.integers(0, 30, n) / 7, rng.integers(1, 100, n), rng.integers(0, 2, n)
    df = spark.createDataFrame(pd.DataFrame({"risk": risk, "duration_days": t, "is_churned": e}))
    case, control = risk[(e == 1) & (t <= 50)], risk[t > 50]
    want = ((case[:, None] > control) + 0.5 * (case[:, None] == control)).mean()
    row = E.auc_at(df, 50).first()
    assert (row["cases"], row["controls"]) == (len(case), len(control))
    assert row["auc"] == pytest.approx(want)
    assert E.auc_at(df, 1000).first()["auc"] is None


def test_brier(spark):
    df = spark.createDataFrame(
        [(30, 1, 0.2), (200, 0, 0.9), (50, 0, 0.5), (120, 1, 0.6)], "duration_days int, is_churned int, s double"
    )
    row = E.brier(df, "s", 90).first()
    assert row["n_evaluated"] == 3
    assert row["brier_score"] == pytest.approx(np.mean([(1 - 0.8) ** 2, 0.1**2, 0.4**2]))
    assert E.brier(df.where("duration_days = 50"), "s", 90).first()["brier_score"] is None
    both = E.integrated_brier(df, {90: "s", 100: "s"}).first()
    assert both["integrated_brier"] == pytest.approx(row["brier_score"])


def test_folds_are_even_and_repeatable(spark):
    df = spark.range(1003).selectExpr("id AS customer_id", "cast(id % 3 AS string) AS segment", "cast(id % 2 AS int) AS is_churned")
    folds = E.with_folds(df, 5)
    sizes = folds.groupBy("segment", "is_churned", "fold").count().toPandas()
    spread = sizes.groupby(["segment", "is_churned"])["count"].agg(["min", "max"])
    assert ((spread["max"] - spread["min"]) <= 1).all() and len(sizes) == 30
    again = E.with_folds(df.repartition(7), 5)
    assert folds.exceptAll(again.select(folds.columns)).count() == 0
    assert folds.count() == 1003


def test_sample_and_champions(spark):
    assert E.sample_rows(spark.range(100).withColumnRenamed("id", "customer_id"), 7).count() == 7
    report = spark.createDataFrame(
        [("kaplan_meier", 0.9, None), ("cox_ph", 0.7, None), ("parametric_weibull", 0.6, 10.0), ("parametric_log_normal", 0.8, 20.0)],
        "model string, concordance_index double, aic double",
    )
    assert E.champion(report).first()[0] == "parametric_log_normal"
    assert E.parametric_champion(report).first()[0] == "parametric_weibull"
    assert E.final_champion(report).first()[0] == "cox_ph"
    assert E.passes_gate(report).first()["register"]
    assert E.ranked_report(report).first()["model"] == "kaplan_meier"
