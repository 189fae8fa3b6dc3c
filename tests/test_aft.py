import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import functions as F

from tenurelens.functions import scalars as S
from tenurelens.operators import aft as A

NOISE = {
    "weibull": lambda rng, n: np.log(rng.exponential(size=n)),
    "log_normal": lambda rng, n: rng.normal(size=n),
    "log_logistic": lambda rng, n: rng.logistic(size=n),
}


def sample(spark, family, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 2)) * [10, 1] + [50, 0]
    mu = 2 + x @ [0.03, -0.4]
    t = np.exp(mu + 0.7 * NOISE[family](rng, n))
    c = rng.exponential(2 * np.exp(mu.mean()), n)
    e = (t <= c).astype(int)
    t = np.minimum(t, c)
    pdf = pd.DataFrame({"customer_id": range(n), "u": x[:, 0], "v": x[:, 1], "duration_days": t, "is_churned": e})
    return x, t, e, spark.createDataFrame(pdf)


def likelihood(family, theta, x, t, e):
    sigma = math.exp(theta[-1])
    z = (np.log(t) - x @ theta[:2] - theta[2]) / sigma
    if family == "weibull":
        f, s = z - np.exp(z), -np.exp(z)
    elif family == "log_logistic":
        f, s = z - 2 * np.log1p(np.exp(z)), -np.log1p(np.exp(z))
    else:
        f = -z * z / 2 - 0.5 * math.log(2 * math.pi)
        s = np.array([math.log(0.5 * math.erfc(q / math.sqrt(2))) for q in z])
    return (e * (f - theta[-1] - np.log(t)) + (1 - e) * s).sum()


@pytest.mark.parametrize("family", A.FAMILIES)
def test_fit_is_the_maximum(spark, family):
    x, t, e, df = sample(spark, family)
    m = A.fit_aft(df, family, covariates=["u", "v"])
    theta = np.concatenate([m.beta, [m.intercept, math.log(m.sigma)]])
    assert m.log_likelihood == pytest.approx(likelihood(family, theta, x, t, e), rel=1e-9)
    for k, h in enumerate((1e-6, 1e-5, 1e-5, 1e-5)):
        step = np.eye(4)[k] * h
        slope = (likelihood(family, theta + step, x, t, e) - likelihood(family, theta - step, x, t, e)) / (2 * h)
        assert abs(slope) * (0.01 if k == 0 else 1) < 2e-3
    assert m.beta == pytest.approx([0.03, -0.4], abs=0.12)
    assert m.aic == pytest.approx(8 - 2 * m.log_likelihood)
    assert m.bic == pytest.approx(4 * math.log(400) - 2 * m.log_likelihood)
    assert m.concordance_index(df, horizon=30) > 0.5


def test_weibull_agrees_with_mllib(spark):
    _, _, _, df = sample(spark, "weibull")
    m = A.fit_aft(df, "weibull", covariates=["u", "v"])
    data = VectorAssembler(inputCols=["u", "v"], outputCol="f").transform(df).withColumn("ev", F.col("is_churned").cast("double"))
    q = AFTSurvivalRegression(labelCol="duration_days", censorCol="ev", featuresCol="f", maxIter=500, tol=1e-10).fit(data)
    assert m.beta == pytest.approx(list(q.coefficients), abs=1e-4)
    assert (m.intercept, m.sigma) == pytest.approx((q.intercept, q.scale), abs=1e-3)


@pytest.mark.parametrize("family", A.FAMILIES)
def test_predictions_agree_with_integration(spark, family):
    m = A.AftModel(family, ["u"], np.array([0.2]), 3.0, 0.5, 0.0, 1, spark)
    df = spark.createDataFrame([(1.0,)], "u double")
    grid = np.exp(np.linspace(-8, 14, 4001))
    times = spark.createDataFrame([(1.0, float(t)) for t in grid], "u double, t double")
    s = np.array([r[0] for r in times.orderBy("t").select(m.survival(times, F.col("t"))).collect()])
    median, mean = df.select(m.median(df), m.expectation(df)).first()
    assert np.interp(0.5, s[::-1], grid[::-1]) == pytest.approx(median, rel=1e-3)
    assert np.trapezoid(s, grid) + grid[0] == pytest.approx(mean, rel=2e-3)
    assert (np.diff(s) <= 1e-12).all()


def test_heavy_log_logistic_has_no_mean(spark):
    m = A.AftModel("log_logistic", [], np.array([]), 3.0, 1.5, 0.0, 1, spark)
    assert spark.range(1).select(m.expectation(spark.range(1))).first()[0] == math.inf


def test_normal_tail_in_both_forms(spark):
    z = np.concatenate([np.linspace(-9, 9, 181), [20.0, 30.0]])
    want = np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in z])
    df = spark.createDataFrame([(float(v),) for v in z], "z double")
    got = np.array([r[0] for r in df.select(S.normal_upper_tail(F.col("z"))).collect()])
    assert np.allclose(got, want, rtol=1e-8, atol=1e-300)
    log_tail, hazard = A.normal_tail_terms(z)
    assert np.allclose(log_tail, np.log(want), rtol=1e-8)
    assert np.allclose(hazard, np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / want, rtol=1e-7)


def test_all_families_report_save_and_mean_curve(spark, tmp_path):
    *_, df = sample(spark, "weibull")
    models = A.fit_all_aft(df, covariates=["u", "v"])
    report = A.aft_report(models).toPandas().set_index("model")
    assert report.aic.idxmin() in ("parametric_weibull", "parametric_log_logistic")
    m = models["weibull"]
    m.save(str(tmp_path))
    back = A.AftModel.load(spark, str(tmp_path))
    assert np.allclose(back.beta, m.beta) and back.sigma == pytest.approx(m.sigma)
    curve = m.mean_curve(df, [1, 10, 100, 1000], n=30).orderBy("time").collect()
    assert [r["n"] for r in curve] == [30] * 4
    assert all(a["survival"] >= z["survival"] for a, z in zip(curve, curve[1:]))
    wide = m.survival_at_horizons(df)
    assert wide.columns == ["customer_id"] + [f"survival_prob_{h}d" for h in (30, 60, 90, 180)]


def test_unknown_family_is_rejected(spark):
    with pytest.raises(ValueError):
        A.fit_aft(spark.range(1), "gamma")


def test_families_side_by_side_read_the_rows_once(spark, monkeypatch):
    rows = [(k, float(1 + (k * 37) % 90), k % 3 > 0, float(k % 7)) for k in range(200)]
    df = spark.createDataFrame(rows, "customer_id int, duration_days double, is_churned boolean, u double")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    jobs = []
    plain = A.likelihood_sums
    monkeypatch.setattr(A, "likelihood_sums", lambda *a, **b: jobs.append(1) or plain(*a, **b))
    found = A.fit_all_aft(df.withColumn("is_churned", df.is_churned.cast("int")).mapInArrow(
        counted, "customer_id int, duration_days double, is_churned int, u double"
    ), covariates=["u"])
    assert read.value == 200
    rounds = len(jobs)
    assert rounds < sum(m.steps for m in found.values())
    for family, model in found.items():
        one = A.fit_aft(df.withColumn("is_churned", df.is_churned.cast("int")), family, covariates=["u"])
        assert np.allclose(one.beta, model.beta, atol=1e-9) and one.log_likelihood == pytest.approx(model.log_likelihood)
