import numpy as np
import pandas as pd
import pytest

from tenurelens.operators import models as M


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(9)
    n = 200
    u = rng.normal(size=n)
    return spark.createDataFrame(pd.DataFrame({
        "customer_id": range(n), "u": u, "segment": rng.choice(list("ab"), n),
        "duration_days": np.ceil(rng.exponential(60 * np.exp(-0.5 * u))) + 1, "is_churned": rng.integers(0, 2, n),
    }))


MODELS = [
    M.KaplanMeier(), M.CoxPH(numeric=["u"], categorical=["segment"]),
    *[M.ParametricAFT(d, covariates=["u"]) for d in ("weibull", "log_normal", "log_logistic")],
]


@pytest.mark.parametrize("model", MODELS, ids=lambda m: m.name)
def test_contract(df, model):
    assert not model.is_fitted()
    with pytest.raises(M.NotFitted):
        model.survival_at_horizons(df)
    assert model.fit(df).is_fitted()
    for r in model.survival_at_horizons(df, (30, 90)).collect():
        assert 1 >= r["survival_prob_30d"] >= r["survival_prob_90d"] >= 0
    assert model.predict_median_survival(df).where("median_survival_days <= 0").count() == 0
    assert model.get_model_params()["model_type"] == model.name


def test_extras(df):
    cox = M.CoxPH(numeric=["u"], categorical=[]).fit(df)
    assert cox.predict_partial_hazard(df).where("partial_hazard <= 0").count() == 0
    aft = M.ParametricAFT("weibull", covariates=["u"]).fit(df)
    assert aft.predict_expectation(df).where("expected_days <= 0").count() == 0
    assert M.KaplanMeier().fit(df).summary().columns[0] == "median_survival_days"
    with pytest.raises(ValueError):
        M.ParametricAFT("gamma")


def test_time_varying_fit_predicts(df):
    long = df.selectExpr("customer_id", "0D AS start", "duration_days AS stop", "is_churned", "u")
    model = M.CoxPH().fit_time_varying(long, ["u"])
    assert model.survival_at_horizons(long, (30,)).count() == df.count()


def test_compared_models_read_each_table_once(spark):
    from tenurelens.operators import selection

    shape = "customer_id int, duration_days int, is_churned int, u double"
    rows = [(k, 1 + (k * 37) % 90, int(k % 3 > 0), float((k * 13) % 17)) for k in range(240)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, shape).mapInArrow(counted, shape)
    report = selection.compare_models(
        df.where("customer_id < 160"), df.where("customer_id >= 160"), numeric=["u"], categorical=[], aft_covariates=["u"]
    )
    assert report.count() == 5
    assert read.value == 2 * 240
