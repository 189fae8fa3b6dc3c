import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenurelens.operators import cox as X
from tenurelens.operators.design import category_levels
from tenurelens.operators import scoring
from tenurelens.sources.schemas import SCORE_COLUMNS

N = 250


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(N, 2))
    seg = rng.choice(list("abc"), N)
    t = np.ceil(rng.exponential(15 / np.exp(x @ [0.5, -0.3]))).astype("int32") + 1
    e = (rng.random(N) < 0.7).astype("int32")
    return x, seg, t, e


@pytest.fixture(scope="module")
def frame(spark, data):
    x, seg, t, e = data
    pdf = pd.DataFrame({"customer_id": range(N), "u": x[:, 0], "v": x[:, 1], "segment": seg,
                        "duration_days": t, "is_churned": e})
    df = spark.createDataFrame(pdf)
    return df.withColumn("duration_days", F.col("duration_days").cast("int")).persist()


@pytest.fixture(scope="module")
def model(frame):
    return X.fit_cox(frame, numeric=["u", "v"], categorical=["segment"])


def design(data):
    x, seg, _, _ = data
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    return np.column_stack([z, seg == "b", seg == "c"]).astype(float)


def partial_likelihood(data, beta, ties):
    """Log partial likelihood, gradient and information by explicit risk sets."""
    _, _, t, e = data
    z = design(data)
    w = np.exp(z @ beta)
    p = z.shape[1]
    ll, grad, info = 0.0, np.zeros(p), np.zeros((p, p))
    for at in np.unique(t[e == 1]):
        dead, risk = (t == at) & (e == 1), t >= at
        d = dead.sum()
        ll += (z[dead] @ beta).sum()
        grad += z[dead].sum(0)
        for k in range(d):
            f = k / d if ties == "efron" else 0.0
            c = w * risk - f * w * dead
            phi, mean = c.sum(), c @ z / c.sum()
            ll -= math.log(phi)
            grad -= mean
            info += (z * c[:, None]).T @ z / phi - np.outer(mean, mean)
    return ll, grad, info


@pytest.mark.parametrize("ties, penalty", [("efron", "sum"), ("breslow", "sum"), ("efron", "mean")])
def test_fit_is_the_penalised_optimum(frame, data, ties, penalty):
    m = X.fit_cox(frame, numeric=["u", "v"], categorical=["segment"], ties=ties, penalty=penalty)
    strength = 0.1 * (N if penalty == "mean" else 1)
    ll, grad, info = partial_likelihood(data, m.beta, ties)
    assert m.log_likelihood == pytest.approx(ll, rel=1e-9)
    assert np.abs(grad - strength * m.beta).max() < 1e-5
    assert np.allclose(m.covariance, np.linalg.inv(info + strength * np.eye(4)), atol=1e-8)
    assert m.design.terms == ["u", "v", "segment_b", "segment_c"] and m.n_rows == N


def test_breslow_baseline_and_prediction(frame, data, model):
    _, _, t, e = data
    w = np.exp(design(data) @ model.beta)
    times = np.unique(t)
    steps = [((t == at) & (e == 1)).sum() / w[t >= at].sum() for at in times]
    base = model.baseline.orderBy("time").toPandas()
    assert base.time.tolist() == [0, *times]
    assert np.allclose(base.cum_hazard, np.concatenate([[0], np.cumsum(steps)]))
    s = model.survival_at_horizons(frame, (10,)).orderBy("customer_id").toPandas()
    near = np.cumsum(steps)[np.flatnonzero(times == 10)[0]] if 10 in times else None
    if near is not None:
        assert np.allclose(s.survival_prob_10d, np.exp(-near * w))
    med = model.with_median(frame).orderBy("customer_id").toPandas().median_survival_days
    for k in range(0, N, 17):
        under = times[np.exp(-np.cumsum(steps) * w[k]) <= 0.5]
        assert med[k] == (under[0] if len(under) else math.inf)


def test_median_is_the_same_for_any_chunks(frame, model):
    direct = model.with_median(frame).select("customer_id", "median_survival_days")
    cut = model.with_median(frame, chunks=7, salts=3)
    assert set(cut.columns) == {*frame.columns, "median_survival_days"} and cut.count() == N
    assert direct.exceptAll(cut.select("customer_id", "median_survival_days")).count() == 0


def test_median_mostly_out_of_reach(spark, frame, model):
    weak = frame.withColumn("h", F.when(F.col("customer_id") % 7 == 0, F.lit(50.0)).otherwise(1e-9))
    found = model.with_median(weak, hazard=F.col("h"))
    endless = F.count_if(F.col("median_survival_days") == float("inf"))
    got = found.groupBy("h").agg(endless.alias("n"), F.count(F.lit(1)).alias("all")).collect()
    assert {r.h: r.n in (0, r.all) and r.n == (r.all if r.h < 1 else 0) for r in got} == {50.0: True, 1e-9: True}
    assert model.with_median(frame.limit(0)).count() == 0


def test_null_events_are_censored_and_null_durations_refused(spark):
    rows = [(k, 5 + k % 11, None if k % 3 == 0 else 1, float(k % 5)) for k in range(60)]
    shape = "customer_id int, duration_days int, is_churned int, u double"
    df = spark.createDataFrame(rows, shape)
    zero = df.fillna({"is_churned": 0})
    a, b = (X.fit_cox(d, numeric=["u"], categorical=[]) for d in (df, zero))
    assert a.n_rows == 60 and np.allclose(a.beta, b.beta)
    broken = df.unionAll(spark.createDataFrame([(99, None, 1, 0.0)], shape))
    with pytest.raises(ValueError, match="1 rows have a null duration"):
        X.fit_cox(broken, numeric=["u"], categorical=[])


def test_intervals_are_checked(spark):
    shape = "customer_id int, start int, stop int, is_churned int, u double"
    df = spark.createDataFrame([(1, 0, 5, 1, 1.0), (2, 4, 4, 0, 0.5)], shape)
    with pytest.raises(ValueError, match="1 rows have an interval"):
        X.fit_cox_intervals(df, ["u"])


def test_six_hundred_levels(spark):
    df = spark.range(1200).select((F.col("id") % 600).cast("string").alias("k"))
    assert len(category_levels(df, ["k"])["k"]) == 600


def test_intervals_reproduce_the_static_fit(spark, frame, data):
    x, _, t, e = data
    rows = []
    for k in range(N):
        cuts = [0, 4, 9, int(t[k])] if t[k] > 9 else [0, int(t[k])]
        for a, z in zip(cuts, cuts[1:]):
            rows.append((k, a, z, int(e[k]) if z == t[k] else 0, float(x[k, 0]), float(x[k, 1])))
    long = spark.createDataFrame(rows, "customer_id int, start int, stop int, is_churned int, u double, v double")
    split = X.fit_cox_intervals(long, ["u", "v"], penalizer=0.0, standardise=False)
    whole = X.fit_cox(frame, numeric=["u", "v"], categorical=[], penalizer=0.0)
    assert np.allclose(split.beta, whole.beta / x.std(0, ddof=1), atol=1e-6)
    assert split.survival_at_horizons(long, (10,)).count() == len(rows)


def test_ph_test_matches_schoenfeld_residuals(data, model):
    _, _, t, e = data
    z = design(data)
    w = np.exp(z @ model.beta)
    order = np.sort(t[e == 1])
    residuals, ranks = [], []
    for at in np.unique(order):
        dead, risk = (t == at) & (e == 1), t >= at
        d = dead.sum()
        mean = np.mean([(w * risk - k / d * w * dead) @ z / (w * risk - k / d * w * dead).sum() for k in range(d)], axis=0)
        for row in z[dead]:
            residuals.append(row - mean)
            ranks.append(np.flatnonzero(order == at).mean() + 1)
    g = np.array(ranks) - np.mean(ranks)
    num = (model.covariance @ (np.array(residuals) * g[:, None]).sum(0)) ** 2
    want = len(order) * num / ((g**2).sum() * np.diag(model.covariance))
    got = {r["covariate"]: r["test_statistic"] for r in model.ph_test().collect()}
    assert np.allclose([got[k] for k in model.design.terms], want)


def test_elastic_net_shrinks_to_zero(frame):
    m = X.fit_cox(frame, numeric=["u", "v"], categorical=["segment"], penalizer=20.0, l1_ratio=1.0)
    assert (m.beta == 0).any() and m.beta[0] > 0
    assert (X.fit_cox(frame, numeric=["u"], categorical=[], penalizer=1e4, l1_ratio=1.0).beta == 0).all()


def test_odd_covariates(spark, frame, model):
    odd = frame.withColumn("flat", F.lit(3.0)).withColumn(
        "wild", F.when(F.col("customer_id") == 0, float("inf")).when(F.col("customer_id") == 1, float("nan"))
        .when(F.col("customer_id") > 2, F.col("u"))
    )
    m = X.fit_cox(odd, numeric=["flat", "wild", "absent"], categorical=["nowhere"])
    assert m.design.terms == ["wild"] and np.isfinite(m.beta).all()
    unseen = spark.createDataFrame([(1, "zzz", 0.0)], "customer_id int, segment string, u double")
    base = spark.createDataFrame([(1, "a", 0.0)], "customer_id int, segment string, u double")
    one, two = (d.select(model.partial_hazard(d)).first()[0] for d in (unseen, base))
    assert one == two > 0


def test_tables_report_and_scores(spark, frame, model, tmp_path):
    ratios = model.hazard_ratios().collect()
    assert all(r["coef_lower_95"] < r["coef"] < r["coef_upper_95"] and 0 <= r["p"] <= 1 for r in ratios)
    assert model.top_hazard_ratios(2).count() == 2
    assert model.concordance_index(frame, horizon=10) > 0.55
    model.save(str(tmp_path))
    back = X.CoxModel.load(spark, str(tmp_path))
    scores = scoring.score(scoring.active(frame), back, "2024-01-01")
    assert scores.columns == SCORE_COLUMNS
    rows = scores.collect()
    assert len(rows) == frame.where("is_churned = 0").count()
    for r in rows:
        assert 1 >= r["survival_prob_30d"] >= r["survival_prob_180d"] >= 0 and r["partial_hazard"] > 0
        assert r["churn_risk_segment"] == ("High" if r["survival_prob_90d"] < 0.3 else "Medium" if r["survival_prob_90d"] < 0.6 else "Low")
    assert scoring.score(frame.limit(0), back, "2024-01-01").count() == 0
    assert scoring.score(frame.drop("customer_id"), back, "2024-01-01").select("customer_id").distinct().count() == N
    assert scoring.segment_shares(scores).agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    assert scoring.score_histogram(scores).agg(F.sum("n")).first()[0] == len(rows)
    with pytest.raises(RuntimeError):
        back.ph_test()


def test_a_good_start_takes_fewer_steps(frame, model):
    again = X.fit_cox(frame, numeric=["u", "v"], categorical=["segment"], first=model)
    assert again.steps < model.steps and np.allclose(again.beta, model.beta, atol=1e-6)


def test_bad_ties_are_rejected(frame):
    with pytest.raises(ValueError):
        X.fit_cox(frame, numeric=["u"], categorical=[], ties="exact")
