"""Stored profiles, checks observed while writing, log-rank and records of many groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenurelens.operators import drift, monitor, profiles, quality
from tenurelens.operators import lifetable as LT


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(4)
    a = pd.DataFrame({"u": rng.normal(size=4000), "n": rng.integers(0, 900, 4000).astype(float), "k": rng.choice(list("abc"), 4000)})
    b = pd.DataFrame({"u": rng.normal(0.3, 1.2, size=3000), "n": rng.integers(0, 700, 3000).astype(float), "k": rng.choice(list("abd"), 3000)})
    a.loc[::50, "u"] = np.nan
    return tuple(spark.createDataFrame(x).replace(float("nan"), None).persist() for x in (a, b))


def test_lattice_is_at_or_below_within_its_error(spark):
    values = [0.0, 1.0, 2.0, 3.0, 1023.0, 2047.0, 0.1, 7.3, 1e-12, 1e200, -5.5, -0.3, 2.0**52, 1 / 3, 8.0, float("inf"), None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", profiles.lattice(F.col("v")).alias("x")).collect()
    for v, x in got:
        if v is None or v in (0.0, float("inf")):
            assert x == v
        else:
            assert 0 <= v - x < abs(v) * 2.0**-profiles.BITS
            if v == int(v) and abs(v) < 2048:
                assert x == v


def test_profile_drift_is_within_the_stated_error(sides):
    a, b = sides
    exact = drift.numeric_drift(a, b, ["u", "n"]).toPandas().set_index("feature")
    stored = [profiles.profile(x, ["u", "n"], ["k"], bits=5) for x in sides]
    coarse = profiles.numeric_drift(*stored, ["u", "n"]).toPandas().set_index("feature")
    error = profiles.lattice_error(*stored).toPandas().set_index("feature").ks_error
    for feature in ("u", "n"):
        assert 0 <= exact.ks_stat[feature] - coarse.ks_stat[feature] <= error[feature] < 0.06
        assert coarse.psi[feature] == pytest.approx(exact.psi[feature], rel=0.1)
        assert (coarse.ref_n[feature], coarse.cur_n[feature]) == (exact.ref_n[feature], exact.cur_n[feature])
    fine = profiles.numeric_drift(*[profiles.profile(x, ["n"], []) for x in sides], ["n"]).first()
    assert fine["ks_stat"] == exact.ks_stat["n"] and fine["psi"] == pytest.approx(exact.psi["n"])
    cats = [t.toPandas().iloc[0] for t in (drift.categorical_drift(a, b, ["k"]), profiles.categorical_drift(*stored, ["k"]))]
    assert cats[0].chi2_stat == pytest.approx(cats[1].chi2_stat) and cats[0].psi == pytest.approx(cats[1].psi)


def test_profiles_add_up_and_are_stored(spark, sides, tmp_path):
    a, _ = sides
    halves = [a.where(F.xxhash64("u", "n", "k") % 2 == s) for s in (0, 1)]
    halves[1] = a.exceptAll(halves[0])
    whole = profiles.profile(a, ["u", "n"], ["k", "absent"])
    merged = profiles.merge(*[profiles.profile(h, ["u", "n"], ["k"]) for h in halves])
    assert whole.exceptAll(merged).count() == 0 and merged.count() == whole.count()
    profiles.write_profile(whole, str(tmp_path), "2024-01-01")
    back = profiles.read_profile(spark, str(tmp_path), "2024-01-01")
    assert back.agg(F.sum("n")).first()[0] == 3 * a.count() - a.where("u is null").count()
    row = profiles.batch_drift(back, a, "u").first()
    assert row["psi"] == 0 and row["ks_stat"] == 0 and not row["drift_detected"]
    assert profiles.batch_drift(back, a.withColumn("u", F.col("u") + 3), "u").first()["drift_detected"]
    assert profiles.batch_drift(back, a.limit(0), "u").first()["drift_detected"] is False
    with pytest.raises(ValueError):
        profiles.profile(a, ["nowhere"], [])


RULES = [("id", "int", False, True, []), ("amount", "double", False, False, [("gt", 0)])]


def test_checks_while_writing_equal_a_second_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, -1.0, None), (2, None, "b")], "id int, amount double, k string")
    path = str(tmp_path / "t")
    got = quality.write_checked(df, "orders", path, min_rows=5, rules=RULES, partition_by=("k",))
    want = quality.scan_checks(df, "orders", 5, RULES)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(quality.DataValidationError, match="orders"):
        quality.write_checked(df, "orders", path, min_rows=5, rules=RULES, raise_on_failure=True)
    empty = quality.write_checked(df.limit(0), "orders", str(tmp_path / "e"), min_rows=0, rules=RULES)
    assert empty.where("not passed").count() == 0


def test_the_write_is_the_only_scan(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(40).select(counted.asNondeterministic()(F.col("id").cast("int")).alias("id"), F.lit(1.0).alias("amount"))
    report = quality.write_checked(df, "orders", str(tmp_path), min_rows=1, rules=RULES)
    assert report.where("not passed").count() == 0 and seen.value == 40


def test_log_rank_of_two_thousand_groups(spark):
    df = spark.range(8000).selectExpr(
        "id % 2000 AS g", "1 + (id * 7919) % 97 AS duration_days", "cast(id % 3 = 0 AS int) AS is_churned"
    )
    t = LT.logrank_test(df, "g", times=16)
    rows = {int(r.g): (r.observed, r.expected) for r in LT.logrank_groups(df, "g").collect()}
    assert t.degrees == 1999 and len(rows) == 2000
    assert np.allclose([rows[g] for g in t.groups], np.column_stack([t.observed, t.expected]))
    assert np.allclose(t.covariance.sum(0), 0, atol=1e-8) and 0 < t.statistic < 1999 and 0 < t.p_value <= 1


def test_log_rank_of_groups_never_at_risk_together(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 5, 1), ("b", 6, 0), ("c", 1, 0)], "g string, duration_days int, is_churned int")
    t = LT.logrank_test(df, "g")
    assert np.isfinite(t.statistic) and t.statistic >= 0
    with pytest.raises(ValueError):
        LT.logrank_test(df.where("g = 'a'"), "g")


def test_records_of_all_runs_equal_single_ones(spark):
    rng = np.random.default_rng(8)
    n = 300
    df = spark.createDataFrame(pd.DataFrame({
        "run_date": rng.choice(["2024-01-01", "2024-02-01", "2024-03-01"], n), "survival_prob_90d": np.round(rng.random(n), 2),
        "duration_days": rng.integers(1, 200, n), "is_churned": rng.integers(0, 2, n),
    }))
    got = {r.run_date: r for r in monitor.evaluate_runs(df).collect()}
    assert len(got) == 3
    for run, row in got.items():
        one = monitor.evaluate(df.where(F.col("run_date") == run), run).first()
        for name in one.asDict():
            assert row[name] == (pytest.approx(one[name]) if isinstance(one[name], float) else one[name])
    assert monitor.evaluate_runs(df.limit(0)).count() == 0
