import numpy as np
import pandas as pd
import pytest

from tenurelens.operators import monitor as M
from tenurelens.operators import selection


def history(spark, *values):
    rows = [(f"2024-0{k}-01", c, 0.1, 10, 3, c < 0.7) for k, c in enumerate(values, 1)]
    return spark.createDataFrame(rows, M.RECORD)


def test_evaluate_and_store(spark, tmp_path):
    scores = spark.createDataFrame(
        [("a", "2024-01-01", 0.2), ("b", "2024-01-01", 0.9), ("c", "2024-02-01", 0.5)],
        "customer_id string, score_date string, survival_prob_90d double",
    )
    outcomes = spark.createDataFrame(
        [("a", 30, 1), ("b", 120, 0), ("c", 5, 1)], "customer_id string, duration_days int, is_churned int"
    )
    record = M.evaluate(M.realised(scores, outcomes, "2024-01-01"), "2024-04-01")
    row = record.first()
    assert (row["c_index"], row["n_customers"], row["n_churned"], row["below_threshold"]) == (1.0, 2, 1, False)
    assert row["brier_score"] == pytest.approx((0.2**2 + 0.1**2) / 2)
    M.append_history(record, str(tmp_path / "h"))
    M.append_history(record, str(tmp_path / "h"))
    assert M.read_history(spark, str(tmp_path / "h")).count() == 2


def test_alerts_compare_with_the_previous_run(spark):
    rows = M.report(history(spark, 0.75, 0.74, 0.71, 0.72)).orderBy("run_date").collect()
    assert [r["degradation_alert"] for r in rows] == [False, False, True, False]
    fixed = M.with_alerts(history(spark, 0.75, 0.72), baseline=0.75).orderBy("run_date").collect()
    assert [r["degradation_alert"] for r in fixed] == [False, True]


@pytest.mark.parametrize("values, want", [((0.75, 0.72), True), ((0.75, 0.74), False), ((0.6,), True), ((), False)])
def test_should_retrain(spark, values, want):
    assert M.should_retrain(history(spark, *values)).first()["should_retrain"] is want


def test_compare_and_cross_validate(spark):
    rng = np.random.default_rng(6)
    n = 300
    u = rng.normal(size=n)
    t = np.ceil(rng.exponential(40 * np.exp(-0.8 * u))) + 1
    pdf = pd.DataFrame({"customer_id": range(n), "u": u, "segment": rng.choice(list("ab"), n), "duration_days": t,
                        "is_churned": (rng.random(n) < 0.7).astype(int)})
    df = spark.createDataFrame(pdf)
    report = selection.compare_models(
        df.where("customer_id < 200"), df.where("customer_id >= 200"), numeric=["u"], categorical=["segment"],
        aft_covariates=["u"], horizon=30,
    ).toPandas().set_index("model")
    assert report.loc["kaplan_meier", "concordance_index"] == 0.5
    assert (report.drop("kaplan_meier").concordance_index > 0.6).all() and len(report) == 5
    folds = selection.cross_validate(df, "parametric_weibull", k=3, aft_covariates=["u"], horizon=30)
    assert folds.count() == 3
    with pytest.raises(ValueError):
        selection.cross_validate(df, "kaplan_meier")
