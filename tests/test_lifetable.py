import numpy as np
import pandas as pd
import pytest

from tenurelens.operators import lifetable as LT

# Remission times of a published leukaemia trial (6-MP arm), a standard textbook example.
SIX_MP = [(6, 1), (6, 1), (6, 1), (6, 0), (7, 1), (9, 0), (10, 1), (10, 0), (11, 0), (13, 1), (16, 1),
          (17, 0), (19, 0), (20, 0), (22, 1), (23, 1), (25, 0), (32, 0), (32, 0), (34, 0), (35, 0)]
PLACEBO = [(t, 1) for t in (1, 1, 2, 2, 3, 4, 4, 5, 5, 8, 8, 8, 8, 11, 11, 12, 12, 15, 17, 22, 23)]
DDL = "duration_days int, is_churned int"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def test_textbook_curve(spark):
    curve = {r["time"]: r["survival"] for r in LT.kaplan_meier(frame(spark, SIX_MP)).collect()}
    for t, s in {0: 1.0, 6: 0.8571, 7: 0.8067, 10: 0.7529, 13: 0.6902, 16: 0.6275, 22: 0.5378, 23: 0.4482}.items():
        assert curve[t] == pytest.approx(s, abs=5e-5)


def test_median_and_horizons(spark):
    row = LT.km_summary(LT.kaplan_meier(frame(spark, SIX_MP)), horizons=(8, 100)).first()
    assert row["median_survival_days"] == 23
    assert row["survival_prob_8d"] == pytest.approx(0.8067, abs=5e-5)  # 7 and 9 tie: the later
    step = LT.km_summary(LT.kaplan_meier(frame(spark, SIX_MP)), horizons=(12,), how="step").first()
    assert step["survival_prob_12d"] == pytest.approx(0.7529, abs=5e-5)


def test_greenwood_band(spark):
    rows = {r["time"]: r for r in LT.kaplan_meier(frame(spark, SIX_MP), alpha=0.05).collect()}
    r = rows[10]
    assert np.sqrt(r["greenwood"]) * r["survival"] == pytest.approx(0.0963, abs=5e-5)
    assert r["ci_lower"] < r["survival"] < r["ci_upper"]
    assert rows[0]["ci_lower"] == rows[0]["ci_upper"] == 1.0


def test_log_rank_textbook(spark):
    both = frame(spark, [(*r, "a") for r in SIX_MP] + [(*r, "b") for r in PLACEBO], DDL + ", g string")
    t = LT.logrank_test(both, "g")
    assert t.statistic == pytest.approx(16.79, abs=0.01)
    assert t.observed.tolist() == [9, 21] and t.expected == pytest.approx([19.25, 10.75], abs=0.01)
    assert t.p_value < 1e-4 and t.significant_at_05
    rows = {r["g"]: r["expected"] for r in LT.logrank_groups(both, "g").collect()}
    assert rows["a"] == pytest.approx(t.expected[0])


def test_log_rank_many_groups_matches_numpy(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({
        "duration_days": rng.integers(1, 25, n).astype("int32"),
        "is_churned": rng.integers(0, 2, n).astype("int32"), "g": rng.choice(list("pqr"), n),
    })
    o, e, v = np.zeros(3), np.zeros(3), np.zeros((3, 3))
    for t in np.unique(pdf.duration_days):
        risk = np.array([((pdf.g == g) & (pdf.duration_days >= t)).sum() for g in "pqr"])
        dead = np.array([((pdf.g == g) & (pdf.duration_days == t) & (pdf.is_churned == 1)).sum() for g in "pqr"])
        m, d = risk.sum(), dead.sum()
        o, e = o + dead, e + d * risk / m
        if m > 1:
            v += d * (m - d) / (m - 1) * (np.diag(risk / m) - np.outer(risk, risk) / m**2)
    z = (o - e)[:2]
    got = LT.logrank_test(spark.createDataFrame(pdf), "g")
    assert got.statistic == pytest.approx(z @ np.linalg.solve(v[:2, :2], z))
    assert got.degrees == 2


@pytest.mark.parametrize("rows, last", [
    ([(5, 0), (7, 0)], 1.0), ([(5, 1)], 0.0), ([(5, 1), (5, 1), (5, 0)], 1 / 3), ([(3, 0), (9, 1)], 0.0),
])
def test_edges(spark, rows, last):
    curve = LT.kaplan_meier(frame(spark, rows), alpha=0.05).orderBy("time").collect()
    assert curve[0]["survival"] == 1.0 and curve[-1]["survival"] == pytest.approx(last)


def test_all_censored_has_no_median(spark):
    row = LT.km_summary(LT.kaplan_meier(frame(spark, [(5, 0), (7, 0)]))).first()
    assert row["median_survival_days"] == float("inf")
    assert LT.kaplan_meier(frame(spark, [])).count() == 0


def test_curve_is_monotone_and_long_time_columns_agree(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({
        "duration_days": rng.integers(1, 400, 900).astype("int32"),
        "is_churned": rng.integers(0, 2, 900).astype("int32"), "g": rng.choice(list("uv"), 900),
    })
    df = spark.createDataFrame(pdf).selectExpr("cast(duration_days as int) duration_days", "is_churned", "g")
    days = LT.kaplan_meier(df, strata=("g",), alpha=0.1).orderBy("g", "time").toPandas()
    other = LT.kaplan_meier(
        df.selectExpr("cast(duration_days as double) duration_days", "is_churned", "g"), strata=("g",), alpha=0.1
    ).orderBy("g", "time").toPandas()
    assert np.allclose(days.drop(columns="g").astype(float), other.drop(columns="g").astype(float), equal_nan=True)
    for _, g in days.groupby("g"):
        assert (g.survival.diff().dropna() <= 1e-15).all() and g.survival.between(0, 1).all()


def test_three_hundred_groups(spark):
    df = spark.range(3000).selectExpr(
        "id % 300 AS g", "cast(1 + (id * 7919) % 97 AS int) AS duration_days", "cast(id % 4 = 0 AS int) AS is_churned"
    )
    rows = LT.logrank_groups(df, "g").toPandas()
    assert len(rows) == 300
    assert np.isclose(rows.observed.sum(), 750) and np.isclose(rows.expected.sum(), 750)
    t = LT.logrank_test(df, "g")
    assert t.degrees == 299
    by_label = rows.assign(g=rows.g.astype(int)).sort_values("g").expected
    assert np.allclose(by_label, t.expected)
