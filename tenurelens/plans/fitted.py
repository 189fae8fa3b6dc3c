"""Queries of fitted models, with Newton's method spelled out in SQL as their twins."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.operators import aft, cox, drift, episodes, features, labels, profiles, quality, scoring
from tenurelens.operators import lifetable as LT
from tenurelens.operators.concordance import concordance_by
from tenurelens.operators.design import fit_design
from tenurelens.plans import testviews as V
from tenurelens.plans.oracle import AS_OF, VIEWS, with_views
from tenurelens.plans.queries import (
    CATEGORY_DRIFT, CATEGORY_SIDES, MATRIX_SQL, NUMERIC_DRIFT, NUMERIC_SIDES, ORACLES, VIEW_RULES, b, cox_views, filled,
    fixed_cox, fixed_design, km_views, order_sides, pick, query, r, side_views, survival_sql, tidy,
)
from tenurelens.sources import tables
from tenurelens.sources.schemas import AFT_COVARIATES, COX_CATEGORICAL, COX_NUMERIC, DRIFT_CATEGORICAL, DRIFT_NUMERIC

ROUNDS = 12
RIDGE = 0.1
ONE = "product_price_inr"


def newton_sql(points: str, rounds: int = ROUNDS) -> str:
    """CTEs of one-parameter Newton steps with Efron ties.

    `points` has (m, s, t, e, x, l2): model, stratum, time, event, covariate, ridge weight. The
    last CTE, `b{rounds}`, has (m, b, info).
    """
    out = [f"pts AS MATERIALIZED ({points})", "b0 AS (SELECT m, 0.0::DOUBLE AS b, max(l2) AS l2, 0.0::DOUBLE AS info FROM pts GROUP BY m)"]
    for k in range(rounds):
        out += [
            f"""t{k} AS MATERIALIZED (SELECT m, s, t, sum(e) AS d, sum(w) AS w0, sum(w * x) AS w1, sum(w * x * x) AS w2,
  sum(e * w) AS e0, sum(e * w * x) AS e1, sum(e * w * x * x) AS e2, sum(e * x) AS v
  FROM (SELECT pts.m, s, t, e, x, exp(b * x) AS w FROM pts JOIN b{k} USING (m)) GROUP BY ALL)""",
            f"""r{k} AS MATERIALIZED (SELECT m, CAST(d AS BIGINT) AS d, e0, e1, e2, v,
  sum(w0) OVER o AS r0, sum(w1) OVER o AS r1, sum(w2) OVER o AS r2 FROM t{k} WINDOW o AS (PARTITION BY m, s ORDER BY t DESC))""",
            f"""g{k} AS MATERIALIZED (SELECT m, sum((r1 - f * e1) / (r0 - f * e0)) AS mean,
  sum((r2 - f * e2) / (r0 - f * e0) - pow((r1 - f * e1) / (r0 - f * e0), 2)) AS i
  FROM (SELECT *, unnest(range(d)) / CAST(d AS DOUBLE) AS f FROM r{k} WHERE d > 0) GROUP BY m)""",
            f"""b{k + 1} AS MATERIALIZED (SELECT m, b + ((SELECT sum(v) FROM r{k} q WHERE q.m = g{k}.m) - mean - l2 * b) / (i + l2) AS b,
  l2, i + l2 AS info FROM g{k} JOIN b{k} USING (m))""",
        ]
    return ",\n".join(out)


Z = f"({ONE} - (SELECT avg({ONE}) FROM customers)) / (SELECT stddev_samp({ONE}) FROM customers)"


def newton_views(points: str, select: str) -> str:
    """The customer views, Newton's steps on points made of them, and a query on the last one."""
    sql = with_views("", "customers").rstrip() + ",\n" + newton_sql(points) + "\n" + select
    # the customers are read by every step
    return sql.replace("customers AS (", "customers AS MATERIALIZED (", 1)


COEF = f"SELECT round(b, 6) AS coef, round(sqrt(1 / info), 6) AS se FROM b{ROUNDS}"


def one_coefficient(model: cox.CoxModel) -> DataFrame:
    return tidy(model.hazard_ratios().select("coef", "se"))


@query(newton_views(f"SELECT 0 AS m, 0 AS s, duration_days AS t, is_churned AS e, {Z} AS x, {RIDGE} AS l2 FROM customers", COEF))
def cox_fit_one(spark, root):
    """One covariate, Efron ties, ridge."""
    return one_coefficient(cox.fit_cox(V.customers(spark, root), numeric=[ONE], categorical=[], penalizer=RIDGE))


@query(newton_views(f"SELECT 0 AS m, segment AS s, duration_days AS t, is_churned AS e, {Z} AS x, {RIDGE} AS l2 FROM customers", COEF))
def cox_stratified_fit(spark, root):
    """One covariate, risk sets within market segments."""
    return one_coefficient(
        cox.fit_cox(V.customers(spark, root), numeric=[ONE], categorical=[], penalizer=RIDGE, strata="segment")
    )


@query(newton_views(
    f"SELECT 0 AS m, u.t AS s, u.t, CAST(c.is_churned = 1 AND c.duration_days = u.t AS INT) AS e, {Z} * ln(u.t) AS x, {RIDGE} AS l2 "
    "FROM customers c JOIN (SELECT DISTINCT duration_days AS t FROM customers WHERE is_churned = 1) u ON c.duration_days >= u.t", COEF))
def cox_time_effect(spark, root):
    """The only term is z * log(t), so it changes along the risk sets."""
    fitted = episodes.fit_time_effects(V.customers(spark, root), [ONE], "log", numeric=[], categorical=[], penalizer=RIDGE)
    return tidy(fitted.hazard_ratios().select("coef", "se"))


FOLDS = 3


@query(newton_views(
    f"SELECT k AS m, 0 AS s, duration_days AS t, is_churned AS e, {Z} AS x, {RIDGE} * pow((SELECT stddev_samp({ONE}) FROM customers o WHERE o.customer_id % {FOLDS} <> k)"
    f" / (SELECT stddev_samp({ONE}) FROM customers), 2) AS l2 FROM customers, (SELECT unnest(range({FOLDS})) AS k) WHERE customer_id % {FOLDS} <> k",
    f""", held AS (SELECT m, duration_days AS t, is_churned AS e, b * {ONE} AS risk FROM customers JOIN b{ROUNDS} ON customer_id % {FOLDS} = m)
SELECT CAST(m AS BIGINT) AS fold, round(any_value(b), 6) AS coef, round(any_value(c), 6) AS c_index FROM b{ROUNDS} JOIN (
  SELECT i.m, (count(*) FILTER (j.risk < i.risk) + 0.5 * count(*) FILTER (j.risk = i.risk)) / CAST(count(*) AS DOUBLE) AS c
  FROM held i JOIN held j ON i.m = j.m AND i.e = 1 AND (j.t > i.t OR (j.t = i.t AND j.e = 0)) GROUP BY 1) USING (m) GROUP BY m"""))
def cox_folds(spark, root):
    """Three models side by side, each without the customers of one fold, and their held-out concordance."""
    people = V.customers(spark, root).withColumn("fold", (F.col("customer_id") % FOLDS).cast("int"))
    fitted = cox.fit_cox_folds(people, FOLDS, numeric=[ONE], categorical=[], penalizer=RIDGE, horizon=1500)
    coefs = spark.createDataFrame([(m, float(x[0])) for m, x in enumerate(fitted.betas)], "fold int, coef double")
    scored = people.select("fold", fitted.held_out_risk(people).alias("risk"), "duration_days", "is_churned")
    return tidy(coefs.join(concordance_by(scored, "fold").select("fold", "c_index"), "fold"))


@query(with_views("SELECT CAST(t AS BIGINT) AS time, count(*) AS at_risk, CAST(count(*) FILTER (c.is_churned = 1 AND c.duration_days = u.t) AS BIGINT) AS events, "
                  "round(sum(warranty_months * ln(t)), 4) AS warranty_log, round(sum(product_price_inr), 2) AS price FROM customers c "
                  "JOIN (SELECT DISTINCT duration_days AS t FROM customers WHERE is_churned = 1) u ON c.duration_days >= u.t GROUP BY 1", "customers"))
def risk_set_sums(spark, root):
    """Per event time: who is at risk, and sums of a moving and of a fixed covariate over them."""
    values = {"warranty_log": F.col("warranty_months") * F.ln("stop"), "price": F.col("product_price_inr")}
    sums = episodes.risk_set_sums(V.customers(spark, root), values)
    return sums.select(
        F.col("time").cast("bigint").alias("time"), "at_risk", "events",
        F.round("warranty_log", 4).alias("warranty_log"), F.round("price", 2).alias("price"),
    )


STRATUM_BASE = """
, tierends AS (SELECT city_tier, duration_days AS time, sum(is_churned) AS d, sum(ph) AS w FROM hazards GROUP BY 1, 2),
tiersteps AS (SELECT city_tier, time, CASE WHEN d > 0 THEN d / sum(w) OVER (PARTITION BY city_tier ORDER BY time DESC) ELSE 0.0 END AS hazard FROM tierends),
tierbase AS (SELECT city_tier, time, hazard, sum(hazard) OVER (PARTITION BY city_tier ORDER BY time) AS cum_hazard FROM tiersteps
  UNION ALL SELECT city_tier, 0, 0.0, 0.0 FROM (SELECT city_tier, min(time) AS t0 FROM tiersteps GROUP BY 1) WHERE t0 > 0)
"""


def by_tier(spark, root) -> tuple[DataFrame, cox.CoxModel]:
    people = V.customers(spark, root)
    design, beta = fixed_design(people)
    return people, cox.fixed_model(people, design, beta, strata="city_tier")


@query(cox_views(f"SELECT {b('city_tier')}, {b('time')}, {r('hazard', places=9)}, {r('cum_hazard')}, {r('exp(-cum_hazard)', 'survival')} FROM tierbase", STRATUM_BASE))
def cox_stratified_baseline(spark, root):
    """Given coefficients, one Breslow baseline per city tier."""
    _, model = by_tier(spark, root)
    return model.baseline.select(
        F.col("city_tier").cast("bigint").alias("city_tier"), F.col("time").cast("bigint").alias("time"),
        F.round("hazard", 9).alias("hazard"), F.round("cum_hazard", 6).alias("cum_hazard"), F.round("survival", 6).alias("survival"),
    )


@query(cox_views(f"""
SELECT customer_id, {r("exp(-(SELECT arg_min(cum_hazard, abs(time - 1500) - time / 1e6) FROM tierbase t WHERE t.city_tier = h.city_tier) * ph)", 'survival_prob_1500d')},
  (SELECT CAST(min(time) AS DOUBLE) FROM tierbase t WHERE t.city_tier = h.city_tier AND cum_hazard >= ln(2.0) / ph AND hazard > 0) AS median_survival_days FROM hazards h""", STRATUM_BASE))
def cox_stratified_score(spark, root):
    """Survival and median of every customer on the baseline of the own city tier."""
    people, model = by_tier(spark, root)
    m = F.col("median_survival_days")
    scored = model.with_survival(model.with_median(people), (1500,))
    return tidy(scored.select("customer_id", "survival_prob_1500d", F.when(m < float("inf"), m).alias("median_survival_days")))


# ---------------------------------------------------------------- curves at own times, log-rank tests

OWN = "CAST(age_years * 40 AS INT)"


@query(km_views(
    f"SELECT customer_id, {b('own')}, {r('survival')} FROM (SELECT customer_id, segment, {OWN} AS own FROM customers) c "
    "ASOF LEFT JOIN curve k ON c.segment = k.segment AND c.own >= k.time", "segment"))
def survival_at_own_time(spark, root):
    """The segment's curve at a time of each customer's own (null for customers without age)."""
    people = V.customers(spark, root).select("customer_id", "segment", (F.col("age_years") * 40).cast("int").alias("own"))
    curve = LT.kaplan_meier(V.customers(spark, root), strata=("segment",))
    return tidy(LT.survival_at(people, curve, "own", ["segment"]).select("customer_id", "own", "survival"))


@query(km_views(
    f"SELECT customer_id, {b('own')}, round((SELECT arg_min(survival, abs(k.time - own) - k.time / 1e6) FROM curve k WHERE k.segment = c.segment AND own IS NOT NULL), 6) AS survival "
    f"FROM (SELECT customer_id, segment, {OWN} AS own FROM customers) c", "segment"))
def survival_nearest_own_time(spark, root):
    people = V.customers(spark, root).select("customer_id", "segment", (F.col("age_years") * 40).cast("int").alias("own"))
    curve = LT.kaplan_meier(V.customers(spark, root), strata=("segment",))
    return tidy(LT.survival_at(people, curve, "own", ["segment"], how="nearest").select("customer_id", "own", "survival"))


def logrank_full_sql(group: str, k: int) -> str:
    """Log-rank over k groups: eliminate k - 1 of them one by one, which adds up z' V^-1 z."""
    pairs = [(i, j) for i in range(1, k) for j in range(i, k)]
    cells = f"""
, marks AS (SELECT {group} AS g, row_number() OVER (ORDER BY {group}) AS k FROM (SELECT DISTINCT {group} FROM customers WHERE {group} IS NOT NULL)),
times AS (SELECT duration_days AS t, count(*) FILTER (is_churned = 1) AS d FROM customers WHERE {group} IS NOT NULL GROUP BY 1),
wide AS (SELECT t, d, {", ".join(f"CAST(sum(n{i}) OVER o AS DOUBLE) AS n{i}, d{i}" for i in range(1, k + 1))} FROM (
  SELECT t, any_value(d) AS d, {", ".join(f"count(*) FILTER (k = {i}) AS n{i}, count(*) FILTER (k = {i} AND is_churned = 1) AS d{i}" for i in range(1, k + 1))}
  FROM customers JOIN marks ON g = {group} JOIN times ON t = duration_days GROUP BY t) WINDOW o AS (ORDER BY t DESC)),
sp AS (SELECT *, {" + ".join(f"n{i}" for i in range(1, k + 1))} AS n FROM wide),
sc AS (SELECT *, CASE WHEN n > 1 THEN d * (n - d) / (n - 1) ELSE 0 END AS c FROM sp),
m1 AS (SELECT 0.0::DOUBLE AS stat, {", ".join(f"sum(d{i} - d * n{i} / n) AS z{i}" for i in range(1, k))},
  {", ".join(f"sum(c * ({f'n{i} / n' if i == j else '0'} - n{i} * n{j} / (n * n))) AS a{i}_{j}" for i, j in pairs)} FROM sc)"""
    steps = ""
    for p in range(1, k):
        keep = [(i, j) for i, j in pairs if i > p]
        columns = [f"stat + z{p} * z{p} / a{p}_{p} AS stat"]
        columns += [f"z{i} - a{p}_{i} * z{p} / a{p}_{p} AS z{i}" for i in range(p + 1, k)]
        columns += [f"a{i}_{j} - a{p}_{i} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" for i, j in keep]
        steps += f",\nm{p + 1} AS (SELECT {', '.join(columns)} FROM m{p})"
    return cells + steps


def even_chi2_sql(x: str, degrees: int) -> str:
    """P(chi-square > x) for an even number of degrees."""
    terms, term = ["1"], "1"
    for j in range(1, degrees // 2):
        term = f"{term} * ({x}) / 2 / {j}"
        terms.append(term)
    return f"exp(-({x}) / 2) * ({' + '.join(terms)})"


def logrank_views(group: str, k: int) -> str:
    p = even_chi2_sql("stat", k - 1)
    text = logrank_full_sql(group, k) + (
        f"\nSELECT 'multivariate' AS test, {r('stat', 'test_statistic')}, {b(str(k - 1), 'degrees')}, {r(p, 'p_value')}, {p} < 0.05 AS significant_at_05 FROM m{k}"
    )
    return with_views(text.lstrip(), "customers").replace("\n, marks AS", ",\nmarks AS")


@query(logrank_views("segment", 5))
def logrank_pvalue(spark, root):
    return tidy(LT.logrank_report(V.customers(spark, root), "segment"))


@query(logrank_views("gender", 3))
def logrank_gender(spark, root):
    return tidy(LT.logrank_report(V.customers(spark, root), "gender"))


# ---------------------------------------------------------------- drift

def ks_tail_sql(d: str, n: str, m: str) -> str:
    """The limiting distribution of the two-sample statistic, its argument corrected for size."""
    en = f"({n} * {m} / CAST({n} + {m} AS DOUBLE))"
    x = f"({d} * sqrt{en} + 1 / (6 * sqrt{en}) + ({d} * sqrt{en} - 1) / (4 * {en}))"
    inner = f"list_sum([exp(-pow(2 * k - 1, 2) * pi() * pi() / (8 * {x} * {x})) for k in range(1, 60)])"
    return f"(CASE WHEN {d} <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0, 1 - sqrt(2 * pi()) / {x} * {inner})) END)"


REPORT_SQL = f"""
, nums AS (SELECT s.feature, s.psi, k.ks, {ks_tail_sql('ks', 'n0', 'n1')} AS p FROM (SELECT feature, sum((p1 - p0) * ln(p1 / p0)) AS psi FROM shares GROUP BY 1) s
  JOIN (SELECT feature, max(abs(gap)) AS ks FROM ecdf GROUP BY 1) k USING (feature) JOIN sizes USING (feature))"""
BAND_SQL = "CASE WHEN psi < 0.1 THEN 'none' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band"
NUMERIC_REPORT = (
    "SELECT feature, 'numeric' AS type, round(psi, 4) AS psi, round(ks, 4) AS ks_stat, round(p, 4) AS ks_pvalue, "
    f"CAST(NULL AS DOUBLE) AS chi2_stat, CAST(NULL AS DOUBLE) AS chi2_pvalue, psi > 0.2 OR p < 0.05 AS is_drifted, {BAND_SQL} FROM nums"
)
CATEGORY_P = f"(CASE degrees WHEN 4 THEN {even_chi2_sql('chi2', 4)} WHEN 2 THEN {even_chi2_sql('chi2', 2)} END)"
CATEGORY_REPORT = (
    "SELECT feature, 'categorical', round(psi, 4), NULL, NULL, round(chi2, 4), "
    f"round({CATEGORY_P}, 4), psi > 0.2 OR {CATEGORY_P} < 0.05, {BAND_SQL} FROM cstats"
)


@query(side_views(f"{REPORT_SQL}\n{NUMERIC_REPORT} UNION ALL {CATEGORY_REPORT}", NUMERIC_SIDES, CATEGORY_SIDES))
def drift_pvalues(spark, root):
    return drift.drift_report(*order_sides(spark, root), NUMERIC_DRIFT, CATEGORY_DRIFT)


def lattice_sql(v: str) -> str:
    step = f"pow(2.0, floor(log2(abs({v}))) - {profiles.BITS})"
    return f"(CASE WHEN {v} = 0 THEN 0.0 ELSE floor({v} / {step}) * {step} END)"


ON_LATTICE = NUMERIC_SIDES.replace("o_totalprice AS v", f"{lattice_sql('o_totalprice')} AS v").replace(
    "day(o_orderdate),", f"{lattice_sql('day(o_orderdate)')},"
)


@query(side_views(f"{REPORT_SQL}\n{NUMERIC_REPORT} UNION ALL {CATEGORY_REPORT}", ON_LATTICE, CATEGORY_SIDES))
def profile_drift(spark, root):
    """Drift from two stored profiles, written and read again."""
    folder = f"{tables.shared_folder(spark).rstrip('/')}/profiles-{uuid.uuid4().hex}"
    for name, side in zip(("reference", "current"), order_sides(spark, root), strict=True):
        profiles.write_profile(profiles.profile(side, NUMERIC_DRIFT, CATEGORY_DRIFT), folder, name)
    sides = [profiles.read_profile(spark, folder, name) for name in ("reference", "current")]
    return profiles.drift_report(*sides, NUMERIC_DRIFT, CATEGORY_DRIFT)


# ---------------------------------------------------------------- validation while writing

@query(f"SELECT * FROM ({ORACLES['quality_report']}) WHERE \"check\" NOT IN ('unique', 'orphan_pct')")
def write_checked(spark, root):
    """The row rules of the order table, observed while it is written."""
    path = f"{tables.shared_folder(spark).rstrip('/')}/checked-{uuid.uuid4().hex}"
    return tidy(quality.write_checked(
        V.transactions(spark, root), "transactions", path, min_rows=1000, rules=VIEW_RULES["transactions"]
    ))


CUSTOMER_TABLES = ("customers", "transactions")


def all_checks_sql() -> str:
    report = " UNION ALL ".join(
        f"SELECT dataset, severity, passed FROM ({sql})" for sql in (ORACLES["quality_report"], ORACLES["customer_checks"])
    )
    return (
        f"SELECT dataset, bool_and(passed OR severity <> 'error') AS passed, count(*) FILTER (NOT passed AND severity = 'error') AS errors "
        f"FROM ({report}) GROUP BY 1"
    )


@query(all_checks_sql())
def validate_all(spark, root):
    """Both tables at once: does any fail a hard check?"""
    report = quality.validate_all(
        {"customers": V.clickstream(spark, root).select("customer_id"), "transactions": V.transactions(spark, root)},
        raise_on_failure=False, min_rows={"transactions": 1000, "customers": 1}, rules={**VIEW_RULES, "customers": []},
    ).where(F.col("dataset") == "transactions")
    people = quality.validate(V.customers(spark, root), "customers", min_rows=1)
    report = report.unionByName(people.where(F.col("check").isin("churn_rate", "non_positive", "unique")))
    return quality.passed_summary(report).select("dataset", "passed", "errors")


@query(ORACLES["churn_label"])
def churn_label_lagged(spark, root):
    """Labels for a date, judged 30 days later."""
    v = V.views(spark, root, keep_without_orders=True)
    judged = labels.label_at(v.customers, v.transactions, v.clickstream, v.support_tickets, "2001-07-02", 30)
    return tidy(judged.select("customer_id", "churn_label"))


ODD = """
, odd AS (SELECT *, 3.0::DOUBLE AS flat, CASE WHEN customer_id % 7 = 0 THEN 'inf'::DOUBLE WHEN customer_id % 11 = 0 THEN 'nan'::DOUBLE
  WHEN customer_id % 5 <> 0 THEN product_price_inr END AS wild FROM customers)
"""


def clean(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 ELSE {c} END"


@query(with_views(ODD.lstrip() + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({clean(c)}), 4) AS mean, round(stddev_samp({clean(c)}), 4) AS std FROM odd HAVING stddev_samp({clean(c)}) > 1e-6"
    for c in ("flat", "wild", "product_price_inr")), "customers").replace("\n, odd AS", ",\nodd AS"))
def design_terms(spark, root):
    """Infinite, missing and constant values in covariates: what a fit keeps of them."""
    key, price = F.col("customer_id"), F.col("product_price_inr")
    odd = V.customers(spark, root).withColumn("flat", F.lit(3.0)).withColumn(
        "wild", F.when(key % 7 == 0, float("inf")).when(key % 11 == 0, float("nan")).when(key % 5 != 0, price)
    )
    design = fit_design(odd, ["flat", "wild", "product_price_inr", "absent"], [])
    return spark.createDataFrame(design.numeric, "`column` string, mean double, std double").select(
        "column", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


@query(cox_views(f"SELECT count(*) AS n, count(*) AS ids, {r(f'avg({survival_sql(180)})', 'mean_survival')} FROM hazards WHERE is_churned = 0"))
def score_without_ids(spark, root):
    """A table without an id column gets positions, one per row; a table without rows gives none."""
    people, model = fixed_cox(spark, root)
    active = scoring.active(people)
    scores = scoring.score(active.drop("customer_id"), model, "2001-08-01").unionByName(
        scoring.score(active.where("false"), model, "2001-08-01").withColumn("customer_id", F.col("customer_id").cast("string"))
    )
    return tidy(scores.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id").alias("ids"), F.avg("survival_prob_180d").alias("mean_survival")
    ))


# ---------------------------------------------------------------- the whole feature matrix

EARLIER = "2000-08-01"


def matrix_sql(as_of: str) -> str:
    """The filled and rounded feature matrix of a date; what the customers are stays that of AS_OF."""
    text = with_views(pick(filled(MATRIX_SQL), "matrix"), "matrix")
    kept = VIEWS["everyone"]
    return text.replace(kept, "@everyone@").replace(AS_OF, f"DATE '{as_of}'").replace("@everyone@", kept)


def matrix_at(spark, root, as_of: str) -> DataFrame:
    v = V.views(spark, root, keep_without_orders=True)
    return tidy(features.feature_matrix(v.customers, v.transactions, v.clickstream, v.support_tickets, as_of))


def both_sides(columns: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {kind}) AS v, {side} AS side FROM {table} WHERE {c} IS NOT NULL"
        for c in columns for side, table in enumerate(("ref", "cur"))
    )


FEATURE_SIDES = (
    f"WITH ref AS ({matrix_sql(EARLIER)}),\ncur AS ({matrix_sql(V.AS_OF)}),\nsides AS ({both_sides(DRIFT_NUMERIC, 'DOUBLE')}),\n"
    + NUMERIC_SIDES[NUMERIC_SIDES.index("sizes AS"):].replace("WHERE v >= e[1]", "WHERE len(e) >= 2 AND v >= e[1]").rstrip()
    + f",\ncsides AS ({both_sides(DRIFT_CATEGORICAL, 'VARCHAR')}),\n" + CATEGORY_SIDES[CATEGORY_SIDES.index("cells AS"):].rstrip()
)
FEATURE_REPORT = REPORT_SQL.replace(
    "(SELECT feature, sum((p1 - p0) * ln(p1 / p0)) AS psi FROM shares GROUP BY 1) s",
    "(SELECT feature, coalesce(sum((p1 - p0) * ln(p1 / p0)), 0) AS psi FROM sizes LEFT JOIN shares USING (feature) GROUP BY 1) s",
)


@query(f"{FEATURE_SIDES}{FEATURE_REPORT}\n{NUMERIC_REPORT} UNION ALL {CATEGORY_REPORT}")
def drift_features(spark, root):
    """The watched features of two feature matrices, a year apart."""
    return drift.drift_report(matrix_at(spark, root, EARLIER), matrix_at(spark, root, V.AS_OF))


def fit_matrix(spark, root) -> DataFrame:
    v = V.views(spark, root)
    return features.feature_matrix(v.customers, v.transactions, v.clickstream, v.support_tickets, V.AS_OF)


@query()
def cox_fit_matrix(spark, root):
    """All covariates of the model on the feature matrix."""
    return cox.fit_cox(fit_matrix(spark, root)).hazard_ratios()


def terms_sql() -> str:
    numeric = " UNION ALL ".join(f"SELECT '{c}' AS covariate FROM m HAVING stddev_samp(coalesce({c}, 0)) > 1e-6" for c in COX_NUMERIC)
    levels = " UNION ALL ".join(
        f"SELECT '{c}_' || v FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM m WHERE {c} IS NOT NULL) WHERE v > (SELECT min(CAST({c} AS VARCHAR)) FROM m)"
        for c in COX_CATEGORICAL
    )
    return (
        f"WITH m AS (SELECT * FROM ({with_views('SELECT * FROM matrix', 'matrix')}) WHERE first_purchase_date IS NOT NULL) "
        f"SELECT covariate, true AS at_optimum FROM ({numeric} UNION ALL {levels})"
    )


@query(terms_sql())
def cox_matrix_optimum(spark, root):
    """The terms of that fit, and whether the penalised score, summed anew by time, vanishes in each."""
    rows = cox.needed(fit_matrix(spark, root), ["duration_days", "is_churned", *COX_NUMERIC, *COX_CATEGORICAL]).persist()
    try:
        model = cox.fit_cox(rows)
        score = cox.score_vector(model, rows) - model.penalizer * model.beta
    finally:
        rows.unpersist()
    return spark.createDataFrame(
        [(t, bool(abs(g) < 1e-4)) for t, g in zip(model.design.terms, score.tolist(), strict=True)], "covariate string, at_optimum boolean"
    )


@query()
def aft_fit_matrix(spark, root):
    """The Weibull model on its covariates of the feature matrix."""
    return aft.fit_aft(fit_matrix(spark, root), "weibull", covariates=AFT_COVARIATES, penalizer=RIDGE).coefficients()


# ---------------------------------------------------------------- accelerated failure times

AFT_ONE = "warranty_months"
#: how each family walks: where it begins, z, what it sums (gradient and minus Hessian), and how its
#: parameters a, b, s become slope, intercept and ln sigma; `longest` bounds a step. The Weibull likelihood is concave in
#: 1 / sigma and the coefficients over -sigma, so Newton's steps are safe there.
AFT_WALKS = {
    "weibull": {
        "begin": "SELECT 0.0::DOUBLE AS a, -avg(t) / stddev_pop(t) AS b, 1 / stddev_pop(t) AS s FROM pts",
        "z": "s * t + b + a * x",
        "sums": """sum(x * (e - w)) AS ga, sum(e - w) AS gb, sum(t * (e - w) + e / s) AS gs, sum(w * x * x) AS aa, sum(w * x) AS ab,
  sum(w * x * t) AS ac, sum(w) AS bb, sum(w * t) AS bc, sum(w * t * t + e / (s * s)) AS cc FROM (SELECT *, exp(z) AS w FROM""",
        "end": "-a / s AS a, -b / s AS b, -ln(s) AS s",
        "ll": "e * z - exp(z)",
        "longest": 5.0,
    },
    "log_logistic": {
        "begin": "SELECT 0.0::DOUBLE AS a, avg(t) AS b, ln(stddev_pop(t)) AS s FROM pts",
        "z": "(t - b - a * x) / exp(s)",
        "sums": """sum(-g * x / sg) AS ga, sum(-g / sg) AS gb, sum(-g * z - e) AS gs, -sum(h * x * x / (sg * sg)) AS aa,
  -sum(h * x / (sg * sg)) AS ab, -sum(x * (h * z + g) / sg) AS ac, -sum(h / (sg * sg)) AS bb, -sum((h * z + g) / sg) AS bc, -sum(h * z * z + g * z) AS cc
  FROM (SELECT *, exp(s) AS sg, e - (1 + e) / (1 + exp(-z)) AS g, -(1 + e) * (1 / (1 + exp(-z))) * (1 - 1 / (1 + exp(-z))) AS h FROM""",
        "end": "a, b, s",
        "ll": "e * z - (1 + e) * ln(1 + exp(z))",
        "longest": 0.5,
    },
}


def aft_newton_sql(family: str, rounds: int = 25) -> str:
    """One covariate (standardised), an intercept and the log of sigma, by Newton steps of bounded length."""
    walk = AFT_WALKS[family]
    x = f"({AFT_ONE} - (SELECT avg({AFT_ONE}) FROM customers)) / (SELECT stddev_samp({AFT_ONE}) FROM customers)"
    out = [
        f"pts AS MATERIALIZED (SELECT ln(duration_days) AS t, CAST(is_churned AS DOUBLE) AS e, {x} AS x FROM customers)",
        f"th0 AS ({walk['begin']})",
    ]
    for k in range(rounds):
        out += [
            f"h{k} AS MATERIALIZED (SELECT {walk['sums']} (SELECT pts.*, s, {walk['z']} AS z FROM pts, th{k})))",
            f"""d{k} AS MATERIALIZED (SELECT (ga * (bb * cc - bc * bc) - ab * (gb * cc - bc * gs) + ac * (gb * bc - bb * gs)) / det AS da,
  (aa * (gb * cc - bc * gs) - ga * (ab * cc - bc * ac) + ac * (ab * gs - gb * ac)) / det AS db,
  (aa * (bb * gs - gb * bc) - ab * (ab * gs - gb * ac) + ga * (ab * bc - bb * ac)) / det AS ds
  FROM (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM h{k}))""",
            f"""th{k + 1} AS MATERIALIZED (SELECT a + f * da AS a, b + f * db AS b, s + f * ds AS s
  FROM th{k}, (SELECT *, least(1.0, {walk['longest']} / greatest(abs(da), abs(db), abs(ds), 1e-300)) AS f FROM d{k}))""",
        ]
    out.append(f"last AS MATERIALIZED (SELECT {walk['end']} FROM th{rounds})")
    select = f"""
, fin AS (SELECT a / sd AS beta, b - a / sd * m AS intercept, s,
  (SELECT sum({walk['ll']} - e * (s + t)) FROM (SELECT pts.*, (t - b - a * x) / exp(s) AS z, s FROM pts, last)) AS ll
  FROM last, (SELECT avg({AFT_ONE}) AS m, stddev_samp({AFT_ONE}) AS sd FROM customers))
SELECT round(beta, 5) AS coef, round(intercept, 5) AS intercept, round(s, 5) AS log_sigma, round(ll, 4) AS log_likelihood,
  round(6 - 2 * ll, 4) AS aic FROM fin"""
    sql = with_views("", "customers").rstrip() + ",\n" + ",\n".join(out) + select
    return sql.replace("customers AS (", "customers AS MATERIALIZED (", 1)


def one_aft(spark, root, family: str) -> DataFrame:
    m = aft.fit_aft(V.customers(spark, root), family, covariates=[AFT_ONE], tolerance=1e-9)
    row = (float(m.beta[0]), m.intercept, math.log(m.sigma), m.log_likelihood, m.aic)
    found = spark.createDataFrame([row], "coef double, intercept double, log_sigma double, log_likelihood double, aic double")
    places = {"log_likelihood": 4, "aic": 4}
    return found.select(*[F.round(c, places.get(c, 5)).alias(c) for c in found.columns])


@query(aft_newton_sql("weibull"))
def aft_weibull_one(spark, root):
    """One covariate, against Newton's method in SQL."""
    return one_aft(spark, root, "weibull")


@query(aft_newton_sql("log_logistic"))
def aft_loglogistic_one(spark, root):
    return one_aft(spark, root, "log_logistic")
