"""Risk-set sums over laid-out rows, strata, folds, moving covariates and as-of joins."""

import math
import pickle
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenurelens.operators import cox, episodes, evaluate, selection
from tenurelens.operators import risksets as R
from tenurelens.operators.asof import asof_join
from tenurelens.operators.concordance import concordance, concordance_by
from tenurelens.operators.ties import digamma, log_gamma, tie_sums, trigamma

N = 400


def by_loop(d, s, e):
    f = np.arange(int(d)) / d
    phi = s - f * e
    return np.array([
        math.fsum(np.log(phi)), math.fsum(1 / phi), math.fsum(f / phi), math.fsum(1 / phi**2),
        math.fsum(f / phi**2), math.fsum(f**2 / phi**2),
    ])


@pytest.mark.parametrize("d", [1, 2, 17, 64, 65, 66, 200, 5_000, 200_000])
def test_ties_in_closed_form_equal_the_loop(d):
    rng = np.random.default_rng(d)
    e = d * rng.uniform(0.01, 50, 40)
    r = np.concatenate([[1.0, 1 - 1e-9, 0.999, 0.5, 0.5 + 1e-12, 0.49, 1e-3, 1e-6, 1e-9], rng.uniform(0, 1, 31)])
    s = e / r
    got = tie_sums(np.full(40, float(d)), s, e, True)
    want = np.stack([by_loop(d, a, b) for a, b in zip(s, e)], axis=1)
    scale = np.maximum(np.abs(want), 1e-300)
    # the logarithm may pass through 0
    scale[0] = np.maximum(scale[0], d)
    assert (np.abs(got - want) / scale).max() < 1e-10


def test_ties_without_events_or_by_breslow():
    assert (tie_sums(np.zeros(3), np.ones(3), np.zeros(3), True) == 0).all()
    got = tie_sums(np.array([3.0, 0.0]), np.array([2.0, 0.0]), np.array([1.0, 0.0]), False)
    assert np.allclose(got[:, 0], [3 * math.log(2), 1.5, 0, 0.75, 0, 0]) and (got[:, 1] == 0).all()


def test_gamma_functions():
    x = np.array([1.0, 1.5, 2.0, 10.0, 1e3, 1e8])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-14, atol=1e-13)
    assert digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-14)
    assert trigamma(np.array([1.0]))[0] == pytest.approx(math.pi**2 / 6, abs=1e-14)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(N, 3))
    t = np.ceil(rng.exponential(12 / np.exp(x @ [0.6, -0.3, 0.0]))).astype("int32") + 1
    # a third of the rows is censored on one day
    t[: N // 3] = 30
    e = (rng.random(N) < 0.7).astype("int32")
    e[: N // 3] = 0
    return pd.DataFrame({
        "customer_id": range(N), "u": x[:, 0], "v": x[:, 1], "w": x[:, 2], "segment": rng.choice(["a", "b", "c", None], N),
        "duration_days": t, "is_churned": e, "fold": rng.integers(0, 3, N), "start": np.minimum(rng.integers(0, 9, N), t - 1),
    })


@pytest.fixture(scope="module")
def frame(spark, data):
    df = spark.createDataFrame(data)
    return df.withColumn("duration_days", F.col("duration_days").cast("int")).persist()


def likelihood(z, start, stop, event, strata, beta, ties="efron"):
    """Log-likelihood, gradient, information with explicit risk sets."""
    p, w = z.shape[1], np.exp(z @ beta)
    ll, grad, info = 0.0, np.zeros(p), np.zeros((p, p))
    for g in np.unique(strata):
        mine = strata == g
        for at in np.unique(stop[mine & (event == 1)]):
            dead = mine & (stop == at) & (event == 1)
            risk = mine & (stop >= at) & (start < at)
            d = dead.sum()
            ll += (z[dead] @ beta).sum()
            grad += z[dead].sum(0)
            for k in range(d):
                c = w * risk - (k / d if ties == "efron" else 0) * w * dead
                mean = c @ z / c.sum()
                ll -= math.log(c.sum())
                grad -= mean
                info += (z * c[:, None]).T @ z / c.sum() - np.outer(mean, mean)
    return ll, grad, info


def prepared(frame, *more):
    return frame.select(
        F.col("duration_days").alias("stop"), F.col("is_churned").cast("double").alias("event"),
        F.col("u").alias("x0"), F.col("v").alias("x1"), F.col("w").alias("x2"), *more,
    )


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
@pytest.mark.parametrize("timed", [False, True])
@pytest.mark.parametrize("stratified", [False, True])
def test_sums_equal_explicit_risk_sets(frame, data, parts, timed, stratified):
    more = [F.col("start")] if timed else []
    if stratified:
        more.append(F.coalesce(F.ascii("segment"), F.lit(-5)).alias("g"))
    beta = np.array([0.4, -0.2, 0.1])
    layout = R.lay_out(prepared(frame, *more), 3, parts=parts)
    ll, grad, info = R.evaluate(layout, [beta])[0]
    layout.drop()
    z = data[["u", "v", "w"]].to_numpy()
    start = data.start.to_numpy() if timed else np.full(N, -1)
    strata = data.segment.fillna("").to_numpy().astype(str) if stratified else np.zeros(N)
    want = likelihood(z, start, data.duration_days.to_numpy(), data.is_churned.to_numpy(), strata, beta)
    assert ll == pytest.approx(want[0], rel=1e-10)
    assert np.allclose(grad, want[1], atol=1e-8) and np.allclose(info, want[2], atol=1e-8)


def test_a_step_shuffles_nothing(spark, frame):
    """Above the stored blocks there is a map and no Exchange, also without broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layout = R.lay_out(prepared(frame), 3, parts=5)
        sent = spark.sparkContext.broadcast([np.zeros(3)])
        frames = spark.sparkContext.broadcast({})
        for step in (R._ends(layout, sent, [0]), R._insides(layout, sent, [0], frames, True)):
            plan = step._jdf.queryExecution().executedPlan().toString()
            above = plan[: plan.index("InMemoryRelation")]
            assert "MapInArrow" in above and "Exchange" not in above and "Join" not in above
        layout.drop()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_day_is_cut(frame):
    layout = R.lay_out(prepared(frame, F.xxhash64("customer_id").alias("salt")), 3, parts=8)
    sizes = [len(r["t"]) // 8 for r in layout.blocks.collect()]
    layout.drop()
    assert sum(sizes) == N and max(sizes) < N // 4


def test_stratified_fit_and_baselines(spark, frame, data, tmp_path):
    model = cox.fit_cox(frame, numeric=["u", "v"], categorical=["segment"], penalizer=0.1, strata="segment", parts=5)
    assert model.design.terms == ["u", "v"]
    z = data[["u", "v"]].to_numpy()
    z = (z - z.mean(0)) / z.std(0, ddof=1)
    stop, event = data.duration_days.to_numpy(), data.is_churned.to_numpy()
    strata = data.segment.fillna("").to_numpy().astype(str)
    ll, grad, info = likelihood(z, np.full(N, -1), stop, event, strata, model.beta)
    assert np.abs(grad - 0.1 * model.beta).max() < 1e-5 and model.log_likelihood == pytest.approx(ll, rel=1e-9)
    assert np.allclose(model.covariance, np.linalg.inv(info + 0.1 * np.eye(2)), atol=1e-8)
    w = np.exp(z @ model.beta)
    curve = model.baseline.toPandas()
    assert curve.columns.tolist() == ["segment", "time", "hazard", "cum_hazard", "survival"]
    medians = model.with_median(frame).toPandas().set_index("customer_id").median_survival_days
    scores = model.survival_at_horizons(frame.withColumn("customer_id", F.col("customer_id")), (10,)).toPandas()
    for value, mine in [("a", strata == "a"), ("b", strata == "b"), (None, strata == "")]:
        part = curve[curve.segment.isna() if value is None else curve.segment == value].sort_values("time")
        times = np.unique(stop[mine])
        steps = [(mine & (stop == at) & (event == 1)).sum() / w[mine & (stop >= at)].sum() for at in times]
        assert part.time.tolist() == [0, *times]
        assert np.allclose(part.cum_hazard, np.r_[0, np.cumsum(steps)])
        for k in np.flatnonzero(mine)[::9]:
            under = times[np.exp(-np.cumsum(steps) * w[k]) <= 0.5]
            assert medians[k] == (under[0] if len(under) else math.inf)
    assert len(scores) == N and scores.survival_prob_10d.between(0, 1).all()
    model.save(str(tmp_path))
    back = cox.CoxModel.load(spark, str(tmp_path))
    assert back.strata == "segment"
    other = frame.withColumn("segment", F.lit("never seen"))
    assert back.survival_at_horizons(other, (10,)).where("survival_prob_10d is null").count() == N
    assert back.with_median(other).where("median_survival_days is null").count() == N
    assert model.with_risk(frame, 10).select("risk").count() == N and model.ph_test().count() == 2
    with pytest.raises(ValueError):
        model.baseline_at((10,))


def test_one_stratum_is_the_plain_fit(frame):
    one = cox.fit_cox(frame.withColumn("k", F.lit(1)), numeric=["u"], categorical=[], strata="k")
    plain = cox.fit_cox(frame, numeric=["u"], categorical=[])
    assert np.allclose(one.beta, plain.beta, atol=1e-9)
    a, b = one.ph_test().collect()[0], plain.ph_test().collect()[0]
    assert a.test_statistic == pytest.approx(b.test_statistic)


def test_folds_side_by_side_equal_single_fits(spark, frame, data):
    wide = frame.withColumn("segment", F.when(F.col("fold") == 1, F.coalesce("segment", F.lit("only1"))).otherwise(F.col("segment")))
    folds = cox.fit_cox_folds(wide, 3, numeric=["u", "v"], categorical=["segment"], penalizer=2.0, horizon=10, parts=4)
    z = folds.design
    for m in range(3):
        train = wide.where(F.col("fold") != m)
        single = cox.fit_cox(train, numeric=["u", "v"], categorical=["segment"], penalizer=2.0)
        assert folds.n_rows[m] == single.n_rows
        mine = dict(zip(single.design.terms, single.beta))
        std = {c: s for c, _, s in single.design.numeric}
        for term, b in zip(z.terms, folds.betas[m]):
            scale = next((s for c, _, s in z.numeric if c == term), None)
            want = mine.get(term, 0.0) * (scale / std[term] if scale else 1.0)
            assert b == pytest.approx(want, abs=1e-5)
        held = wide.where(F.col("fold") == m)
        risk = held.select("customer_id", folds.held_out_risk(held).alias("risk")).orderBy("customer_id").toPandas()
        other = single.with_risk(held, 10).orderBy("customer_id").toPandas()
        assert (risk.risk.rank() - other.risk.rank()).abs().max() < 1e-9


def test_cross_validation_is_held_out_concordance(frame):
    got = selection.cross_validate(frame, k=3, numeric=["u", "v"], categorical=["segment"], horizon=10).toPandas()
    folds = evaluate.with_folds(frame, 3)
    for fold, c in zip(got.fold, got.c_index):
        model = cox.fit_cox(folds.where(F.col("fold") != fold), numeric=["u", "v"], categorical=["segment"])
        assert c == pytest.approx(model.concordance_index(folds.where(F.col("fold") == fold), horizon=10), abs=1e-9)


def test_split_rows_and_moving_covariates(spark, frame, data):
    small = frame.where("customer_id % 4 = 0").persist()
    pdf = data[data.customer_id % 4 == 0]
    times = np.unique(pdf.duration_days[pdf.is_churned == 1])
    split = episodes.split_at(small, episodes.event_times(small)).toPandas()
    want = [(r.customer_id, t) for r in pdf.itertuples() for t in times if t <= r.duration_days]
    assert sorted(zip(split.customer_id, split.stop)) == sorted(want)
    before = {t: b for t, b in zip(times, [0, *times[:-1]])}
    assert all(before[a] == b for a, b in zip(split.stop, split.start)) and split.happened.sum() == pdf.is_churned.sum()

    fitted = episodes.fit_time_effects(small, ["u"], numeric=["u", "v"], categorical=[], penalizer=0.5, parts=3)
    assert fitted.terms == ["u", "v", "u*log(t)"]
    z = {c: (pdf[c] - pdf[c].mean()) / pdf[c].std(ddof=1) for c in "uv"}
    rows = [
        (int(before[t]), int(t), int(r.is_churned and t == r.duration_days), float(z["u"][r.Index]), float(z["v"][r.Index]),
         float(z["u"][r.Index]) * math.log(t))
        for r in pdf.itertuples() for t in times if t <= r.duration_days
    ]
    by_hand = spark.createDataFrame(rows, "start int, stop int, is_churned int, a double, b double, c double")
    model = cox.fit_cox_intervals(by_hand, ["a", "b", "c"], penalizer=0.5, standardise=False)
    assert np.allclose(fitted.model.beta, model.beta, atol=1e-6)
    assert np.allclose(fitted.model.covariance, model.covariance, atol=1e-7)
    ratios = {r.time: r.hazard_ratio for r in fitted.ratios_at([1.0, 20.0]).collect()}
    assert ratios[1.0] == pytest.approx(math.exp(fitted.model.beta[0]))
    assert ratios[20.0] == pytest.approx(math.exp(fitted.model.beta[0] + fitted.model.beta[2] * math.log(20)))
    assert fitted.hazard_ratios().count() == 3 and fitted.model.baseline.count() == len(times) + 1
    sums = episodes.risk_set_sums(small, {"ulog": F.col("u") * F.ln("stop")}).toPandas().set_index("time")
    for t in times:
        risk = pdf[pdf.duration_days >= t]
        assert sums.at_risk[t] == len(risk) and sums.ulog[t] == pytest.approx(risk.u.sum() * math.log(t))


def test_moving_covariates_refuse_what_has_no_log(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (3, 1, 2.0), (4, 0, 0.0)], "duration_days int, is_churned int, u double")
    with pytest.raises(ValueError, match="1 rows have an event at time 0"):
        episodes.fit_time_effects(df, ["u"], numeric=[], categorical=[])
    assert episodes.split_at(df, episodes.at_times(spark, [2, 3])).count() == 4


@pytest.mark.parametrize("per_line", [50_000, 7])
def test_concordance_of_groups_equals_one_by_one(spark, per_line):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({
        "run": rng.choice(["x", "y", None, "z"], n, p=[0.6, 0.2, 0.15, 0.05]), "risk": np.round(rng.random(n), 1),
        "duration_days": rng.integers(1, 15, n), "is_churned": rng.integers(0, 2, n),
    })
    df = spark.createDataFrame(pdf).unionAll(spark.createDataFrame([("none", None, 3, 1), ("one", 0.5, 3, 1)], "run string, risk double, duration_days bigint, is_churned bigint"))
    got = {r.run: r for r in concordance_by(df, "run", points_per_line=per_line).collect()}
    assert set(got) == {"x", "y", None, "z", "none", "one"}
    for run, row in got.items():
        one = concordance(df.where(F.col("run").eqNullSafe(F.lit(run))), points_per_line=per_line)
        assert (row.comparable, row.concordant, row.tied) == (one["comparable"], one["concordant"], one["tied"])
        assert row.c_index == (None if one["c_index"] is None else pytest.approx(one["c_index"]))
    assert concordance_by(df.limit(0), "run").count() == 0


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("later", [True, False])
def test_asof_equals_search(spark, direction, later):
    rng = np.random.default_rng(9)
    left = [(int(i), None if i % 41 == 0 else int(rng.integers(-5, 60)), ["p", "q", None][i % 3]) for i in range(200)]
    left += [(1000 + i, 30, "p") for i in range(80)]
    right = [(int(t), float(t) + 0.5, k) for k, n in (("p", 12), (None, 3), ("r", 4)) for t in rng.choice(50, n, replace=False)]
    right += [(right[0][0], right[0][1] + 7, right[0][2]), (None, 99.0, "p")]
    a = spark.createDataFrame(left, "id int, at int, k string")
    b = spark.createDataFrame(right, "t int, value double, k string")
    got = {r.id: r["m_value"] for r in asof_join(a, b, "at", "t", ["value"], ["k"], direction, later, "m_").collect()}
    assert len(got) == len(left)
    for i, at, k in left:
        mine = {}
        for t, v, key in right:
            if key == k and t is not None:
                mine[t] = max(v, mine.get(t, v))
        times = sorted(mine)
        want = None
        if at is not None:
            behind = max((t for t in times if t <= at), default=None)
            ahead = min((t for t in times if t >= at), default=None)
            if direction == "backward":
                want = behind
            elif direction == "forward":
                want = ahead
            elif behind is None or ahead is None:
                want = behind if ahead is None else ahead
            else:
                want = min((behind, ahead), key=lambda t: (abs(t - at), -t if later else t))
        assert got[i] == (None if want is None else mine[want]), (i, at, k)
    with pytest.raises(ValueError):
        asof_join(a, b, "at", "t", ["value"], ["k"], "sideways")


def test_a_fit_with_moving_covariates_makes_no_split_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    n = 300
    pdf = pd.DataFrame({
        "customer_id": np.arange(n), "duration_days": rng.integers(1, 40, n), "is_churned": rng.integers(0, 2, n),
        "u": rng.normal(size=n), "v": rng.normal(size=n),
    })
    df = spark.createDataFrame(pdf)
    plain = episodes.fit_time_effects(df, ["u"], "sqrt", numeric=["v"], categorical=[], penalizer=0.5)

    def never(*_, **__):
        raise AssertionError("rows were split")

    monkeypatch.setattr(episodes, "split_at", never)
    # small pieces and chunks: several of both in every part
    monkeypatch.setattr(episodes, "HELD", 64)
    monkeypatch.setattr(episodes, "CHUNK", 3)
    cut = episodes.fit_time_effects(df, ["u"], "sqrt", numeric=["v"], categorical=[], penalizer=0.5, parts=5)
    assert np.allclose(cut.model.beta, plain.model.beta, atol=1e-9) and cut.model.log_likelihood == pytest.approx(plain.model.log_likelihood)
    z = {c: ((pdf[c] - pdf[c].mean()) / pdf[c].std(ddof=1)).to_numpy() for c in "uv"}
    t, e = pdf.duration_days.to_numpy(), pdf.is_churned.to_numpy()

    def loss(beta):
        total = 0.25 * beta @ beta
        for time in np.unique(t[e > 0]):
            at_risk, tied = t >= time, (t == time) & (e > 0)
            eta = beta[0] * z["v"] + beta[1] * z["u"] * math.sqrt(time)
            w, d = np.exp(eta), int(tied.sum())
            total -= eta[tied].sum() - sum(math.log(w[at_risk].sum() - k / d * w[tied].sum()) for k in range(d))
        return total

    best, beta = loss(cut.model.beta), cut.model.beta
    for step in np.vstack([np.eye(2), -np.eye(2)]) * 1e-3:
        assert loss(beta + step) > best
    assert cut.model.log_likelihood == pytest.approx(0.25 * beta @ beta - best)


def test_rows_of_one_part_are_split_in_many(spark):
    df = spark.range(200, numPartitions=1).select(F.col("id").alias("customer_id"), (F.col("id") % 20 + 1).cast("int").alias("duration_days"), F.lit(1).alias("is_churned"))
    split = episodes.split_at(df, episodes.event_times(df))
    assert split.select(F.spark_partition_id()).distinct().count() > 4
    assert split.count() == 10 * sum(range(1, 21))


# ---------------------------------------------------------------- what a pass over the parts costs


def test_blocks_are_small(spark):
    p = 8
    rows = spark.range(20_000).select(
        (F.col("id") % 50).alias("stop"), (F.col("id") % 3 == 0).cast("double").alias("event"),
        *[F.rand(k).alias(f"x{k}") for k in range(p)],
    )
    layout = R.lay_out(rows, p, parts=2)
    sizes = [(r["part"], r["seq"], len(r["x"])) for r in layout.blocks.select("part", "seq", "x").collect()]
    layout.drop()
    assert max(s for _, _, s in sizes) <= 256 << 10
    assert len({s[:2] for s in sizes}) == len(sizes) and sum(s for _, _, s in sizes) == 20_000 * 8 * p


def test_parts_fill_whole_rounds_of_tasks():
    assert R.part_count(10 << 20, 100_000, 12) == 12
    assert R.part_count(100, 5, 12) == 1
    # 5.4 million rows of 42 terms
    assert R.part_count(5_400_000 * 8 * 47, 5_400_000, 12) == 36


@pytest.mark.parametrize("strata", [1, 7])
def test_sums_of_several_blocks_and_stripes(frame, data, monkeypatch, strata):
    monkeypatch.setattr(R, "BLOCK_BYTES", 8 * 8 * 10)
    monkeypatch.setattr(R, "STRIPE", 48)
    beta = np.array([0.4, -0.2, 0.1])
    layout = R.lay_out(prepared(frame, (F.col("customer_id") % strata).alias("g"), F.col("start")), 3, parts=3)
    n = layout.blocks.count()
    ll, grad, info = R.evaluate(layout, [beta])[0]
    layout.drop()
    assert n > 3 * 10
    want = likelihood(
        data[["u", "v", "w"]].to_numpy(), data.start.to_numpy(), data.duration_days.to_numpy(),
        data.is_churned.to_numpy(), data.customer_id.to_numpy() % strata, beta,
    )
    assert ll == pytest.approx(want[0], rel=1e-10)
    assert np.allclose(grad, want[1], atol=1e-8) and np.allclose(info, want[2], atol=1e-8)


def entries(n, p, times):
    rng = np.random.default_rng(n)
    return R.Entries(
        np.zeros(n, np.int64), np.sort(rng.integers(0, times, n)).astype(float), (rng.random(n) < 0.3) * 1.0,
        np.ones(n), np.full(n, R.EVERY, np.int32), rng.normal(size=(n, p)),
    )


@pytest.mark.parametrize("times", [200, 100_000])
def test_a_pass_makes_no_copy_of_its_part(times):
    rows = entries(100_000, 20, times)
    cut, (w, e) = R._cuts(rows), R._weights(rows, np.full(20, 0.1), 0)
    tracemalloc.start()
    inside = R._inside(rows, cut, w, e, np.zeros(21))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = sum(a.nbytes for a in inside)
    assert peak < 0.6 * rows.x.nbytes + 3 * held
    here = slice(cut.first, cut.last)
    at = np.searchsorted(inside.t, rows.t[here])
    for got, weight in ((inside.e1, w * e), (inside.v, e)):
        want = np.zeros((len(inside.t), 20))
        np.add.at(want, at, weight[here, None] * rows.x[here])
        assert np.allclose(got, want, atol=1e-9)
    assert np.allclose(inside.risk[0, 1:], w[here] @ rows.x[here], atol=1e-8)


def test_batches_are_small_while_passes_run_only(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with R.small_batches(spark):
        assert spark.conf.get(name) == str(1 << 20)
    assert spark.conf.get(name) == before


def test_broadcast_sums_need_no_package_in_the_tasks():
    p, k = 2, 1
    sums = np.arange(2.0 * (3 + 3 * p) + 2 * (1 + p)) + 1
    ends = [{"part": 0, "g_first": 0, "t_first": 1.0, "g_last": 0, "t_last": 5.0, "one": False, "payload": sums.tobytes()}]
    sequence = R._sequence(ends, p, k)
    R._carry_back(sequence, p, True)
    assert b"tenurelens" not in pickle.dumps(R._frames(ends, sequence))


def test_kept_rows_are_not_kept_twice(spark, frame, monkeypatch):
    kept, persist = [], type(frame).persist
    monkeypatch.setattr(type(frame), "persist", lambda df, *a: kept.append(df.columns) or persist(df, *a))
    model = cox.fit_cox(frame, numeric=["u", "v", "w"], categorical=[])
    # only the blocks of the layout
    assert [c for c in kept if "x" not in c] == []
    again = cox.fit_cox(frame.select("*"), numeric=["u", "v", "w"], categorical=[])
    assert [c for c in kept if "x" not in c] != [] and np.allclose(model.beta, again.beta, atol=1e-12)
