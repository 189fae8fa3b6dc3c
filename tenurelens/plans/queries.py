"""Every operator as a named query on the given tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, ShortType

from tenurelens.functions import scalars as S
from tenurelens.operators import aft, cox, drift, evaluate, features, labels, monitor, quality, scoring, selection
from tenurelens.operators import lifetable as LT
from tenurelens.operators.concordance import concordance
from tenurelens.operators.design import Design, covariate_stats, fit_design
from tenurelens.plans import testviews as V
from tenurelens.plans.oracle import AS_OF, with_views
from tenurelens.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, whole numbers as bigint, so that both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DoubleType):
            c = F.round(c, places)
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, name: str | None = None, places: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {places}) AS {name or expr}"


def b(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


# ---------------------------------------------------------------- feature blocks

RFM_SQL = [
    "customer_id", b("total_transactions"), r("total_spend_inr"), r("avg_transaction_value_inr"),
    b("days_since_last_transaction"), r("months_since_last_transaction"),
]
TXW_SQL = [
    x for n in (30, 60, 90, 180) for x in (b(f"tx_count_{n}d"), r(f"tx_amount_{n}d"))
]
WEBW_SQL = [
    x for n in (30, 90) for x in (
        b(f"active_days_{n}d"), b(f"total_events_{n}d"), r(f"avg_session_dur_s_{n}d"),
        r(f"avg_pages_{n}d"), b(f"product_comparison_events_{n}d"),
        b(f"wishlist_add_events_{n}d"), r(f"avg_weekly_sessions_{n}d"),
    )
] + [b("days_since_last_web_visit")]
SUPPORT_SQL = [
    b("total_support_tickets"), r("avg_resolution_days"), r("escalation_rate"),
    r("avg_satisfaction"), b("days_since_last_support_contact"), b("support_tickets_30d"),
    b("support_tickets_90d"),
]
STATIC_SQL = [
    "customer_id", "segment", b("city_tier"), "gender", b("age_years"), "acquisition_channel",
    "product_category", r("product_price_inr"), b("warranty_months"), b("amc_active"),
    "first_purchase_date", "observation_end_date", b("is_churned"), b("duration_days"),
    b("tenure_days"), "warranty_expiry_date", b("warranty_remaining_days"), b("is_warranty_expired"),
]


def pick(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


def matrix(spark: SparkSession, root: str, **kw) -> DataFrame:
    v = V.views(spark, root, keep_without_orders=True)
    return features.feature_matrix(
        v.customers, v.transactions, v.clickstream, v.support_tickets, V.AS_OF, **kw
    )


@query(with_views(pick(RFM_SQL, "rfm"), "rfm"))
def rfm_features(spark, root):
    return tidy(features.rfm_features(V.transactions(spark, root), V.AS_OF))


@query(with_views(pick(["customer_id", *TXW_SQL], "txw"), "txw"))
def tx_windows(spark, root):
    return tidy(features.windowed_transactions(V.transactions(spark, root), V.AS_OF))


@query(with_views(pick(STATIC_SQL, "static WHERE first_purchase_date IS NOT NULL"), "static"))
def static_lifecycle(spark, root):
    return tidy(features.static_features(V.customers(spark, root), V.AS_OF))


@query(with_views(pick(["customer_id", *WEBW_SQL], "webw"), "webw"))
def behavior_windows(spark, root):
    return tidy(features.behavior_features(V.clickstream(spark, root), V.AS_OF))


@query(with_views(f"""
SELECT customer_id, {r(f"count(DISTINCT event_date) FILTER (event_date >= {AS_OF} - 10) / 10.0 - count(DISTINCT event_date) FILTER (event_date BETWEEN {AS_OF} - 30 AND {AS_OF} - 21) / 10.0", "session_frequency_trend_90d")}
FROM web WHERE event_date >= {AS_OF} - 10 OR event_date BETWEEN {AS_OF} - 30 AND {AS_OF} - 21 GROUP BY 1""", "web"))
def session_trend(spark, root):
    """The test events span 30 days, so the periods are 10 days long here."""
    return tidy(features.session_trend(V.clickstream(spark, root), V.AS_OF, (30, 21), 10, 10.0))


@query(with_views(f"SELECT customer_id, {b(f'{AS_OF} - max(event_date)', 'days_since_last_web_visit')} FROM web GROUP BY 1", "web"))
def last_visit(spark, root):
    return tidy(features.last_visit(V.clickstream(spark, root), V.AS_OF))


@query(with_views(pick(["customer_id", *SUPPORT_SQL], "support"), "support"))
def support_features(spark, root):
    return tidy(features.support_features(V.support_tickets(spark, root), V.AS_OF))


@query(with_views(f"SELECT customer_id, {b('rfm_recency_score')}, {b('rfm_frequency_score')}, {b('rfm_monetary_score')}, {b('rfm_score')} FROM matrix", "matrix"))
def rfm_scores(spark, root):
    return tidy(matrix(spark, root).select(
        "customer_id", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score", "rfm_score"
    ))


@query(with_views(f"SELECT customer_id, {r('engagement_score')} FROM matrix", "matrix"))
def engagement_score(spark, root):
    return tidy(matrix(spark, root).select("customer_id", "engagement_score"))


def filled(columns: list[str]) -> list[str]:
    """Wrap numeric expressions of the matrix in the zero fill."""
    keep = {"is_churned", "duration_days", "age_years"}
    out = []
    for c in columns:
        name = c.rsplit(" AS ", 1)[-1]
        if " AS " not in c or name in keep:
            out.append(c)
        elif c.startswith("round"):
            out.append(f"round(CAST(coalesce({name}, 0) AS DOUBLE), 6) AS {name}")
        else:
            out.append(f"CAST(coalesce({name}, 0) AS BIGINT) AS {name}")
    return out


MATRIX_SQL = [
    *STATIC_SQL, *RFM_SQL[1:], *TXW_SQL, *WEBW_SQL, r("session_frequency_trend_90d"), *SUPPORT_SQL,
    b("rfm_recency_score"), b("rfm_frequency_score"), b("rfm_monetary_score"), b("rfm_score"),
    r("engagement_score"),
]


@query(with_views(pick(filled(MATRIX_SQL), "matrix"), "matrix"))
def feature_matrix(spark, root):
    return tidy(matrix(spark, root))


@query(with_views(f"SELECT {b('count(*)', 'n_rows')}, {r('avg(tenure_days)', 'avg_tenure')}, {b('sum(rfm_score)', 'rfm_total')} FROM matrix WHERE is_churned = 0", "matrix"))
def active_customers(spark, root):
    m = scoring.active(matrix(spark, root))
    return tidy(m.agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("tenure_days").alias("avg_tenure"),
        F.sum("rfm_score").alias("rfm_total"),
    ))


@query("""
SELECT part, count(*) AS n_rows, round(sum(o_totalprice), 2) AS amount FROM (
  SELECT o_totalprice, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1998-06-30' THEN 'train'
         WHEN CAST(o_orderdate AS DATE) > DATE '1998-07-01' THEN 'score' END AS part FROM orders)
WHERE part IS NOT NULL GROUP BY 1""")
def train_score_windows(spark, root):
    tx = V.transactions(spark, root)
    train = tables.up_to(tx, "transaction_date", "1998-06-30").withColumn("part", F.lit("train"))
    score = tables.after(tx, "transaction_date", "1998-07-01").withColumn("part", F.lit("score"))
    return train.unionAll(score).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount_inr"), 2).alias("amount")
    )


def silent(column: str, days: int) -> str:
    return f"coalesce({column} >= {days}, true)"


@query(with_views(f"""
SELECT customer_id, {b(f"{silent('days_since_last_transaction', 270)} AND coalesce(avg_weekly_sessions_90d, 0) <= 0.5 AND {silent('days_since_last_support_contact', 180)}", 'churn_label')}
FROM blocks""", "blocks"))
def churn_label(spark, root):
    return tidy(labels.churn_label(matrix(spark, root, fill=False)).select("customer_id", "churn_label"))


@query(with_views("""
, days AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) - first_purchase_date AS start,
         count(*) AS orders_today, max(o_totalprice) AS top_amount
  FROM orders JOIN customers ON o_custkey = customer_id GROUP BY 1, 2),
points AS (
  SELECT d.customer_id, d.start, d.orders_today, d.top_amount, c.duration_days, c.is_churned
  FROM days d JOIN customers c USING (customer_id) WHERE d.start >= 0 AND d.start < c.duration_days)
SELECT customer_id, CAST(start AS BIGINT) AS start,
       CAST(coalesce(lead(start) OVER w, duration_days) AS BIGINT) AS stop,
       CAST(CASE WHEN lead(start) OVER w IS NULL THEN is_churned ELSE 0 END AS BIGINT) AS is_churned,
       CAST(orders_today AS BIGINT) AS orders_today, round(top_amount, 6) AS top_amount
FROM points WINDOW w AS (PARTITION BY customer_id ORDER BY start)""".lstrip(), "customers").replace("\n, days AS", ",\ndays AS"))
def counting_process(spark, root):
    return tidy(interval_rows(spark, root))


def interval_rows(spark, root) -> DataFrame:
    people = V.customers(spark, root)
    starts = people.select("customer_id", "first_purchase_date")
    changes = V.transactions(spark, root).join(starts, on="customer_id").select(
        "customer_id", F.datediff("transaction_date", "first_purchase_date").alias("day"), "amount_inr"
    )
    covariates = {"orders_today": F.count(F.lit(1)), "top_amount": F.max("amount_inr")}
    return labels.counting_process(people, changes, covariates)


# ---------------------------------------------------------------- quality

VIEW_RULES = {
    "transactions": [
        ("transaction_id", "bigint", False, True, []),
        ("customer_id", "bigint", False, False, []),
        ("transaction_date", "date", False, False, [("ge", "1995-01-01")]),
        ("transaction_type", "string", False, False, [("isin", ("1-URGENT", "2-HIGH", "3-MEDIUM"))]),
        ("amount_inr", "double", False, False, [("gt", 1500)]),
        ("is_returned", "int", False, False, [("isin", (0, 1))]),
    ],
    "support_tickets": [
        ("ticket_id", "bigint", False, True, []),
        ("ticket_date", "date", False, False, [("ge", "1996-01-01")]),
        ("resolution_days", "int", False, False, [("ge", 5), ("le", 45)]),
        ("is_escalated", "int", False, False, [("isin", (0, 1))]),
    ],
}


def rule_row(check, column, value, threshold, severity, passed) -> str:
    name = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT 'transactions' AS dataset, '{check}' AS \"check\", CAST({name} AS VARCHAR) AS \"column\", "
        f"CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, "
        f"{severity} AS severity, {passed} AS passed FROM transactions"
    )


def count_row(check, column, condition) -> str:
    n = f"count(*) FILTER ({condition})"
    return rule_row(check, column, n, 0, "'error'", f"{n} = 0")


TX_COLUMNS = ["transaction_id", "customer_id", "transaction_date", "transaction_type", "amount_inr", "is_returned"]
ORPHANS = "(SELECT 100.0 * count(*) FILTER (u.customer_id IS NULL) / count(*) FROM (SELECT DISTINCT customer_id FROM transactions) t LEFT JOIN (SELECT DISTINCT customer_id FROM clickstream) u USING (customer_id))"


@query(with_views("\nUNION ALL\n".join([
    rule_row("min_rows", None, "count(*)", 1000, "'error'", "count(*) >= 1000"),
    *[count_row("not_null", c, f"{c} IS NULL") for c in TX_COLUMNS],
    count_row("ge", "transaction_date", "transaction_date < DATE '1995-01-01'"),
    count_row("isin", "transaction_type", "transaction_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    count_row("gt", "amount_inr", "amount_inr <= 1500"),
    count_row("isin", "is_returned", "is_returned NOT IN (0, 1)"),
    *[rule_row("null_pct", c, f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2)", 5, "'warning'",
               f"100.0 * count(*) FILTER ({c} IS NULL) / count(*) <= 5") for c in TX_COLUMNS],
    count_row("non_positive", "amount_inr", "amount_inr <= 0"),
    rule_row("unique", "transaction_id", "count(*) - count(DISTINCT transaction_id)", 0, "'error'",
             "count(*) = count(DISTINCT transaction_id)"),
    f"SELECT 'transactions', 'orphan_pct', 'customer_id', round({ORPHANS}, 6), 1.0, CASE WHEN {ORPHANS} > 1 THEN 'error' ELSE 'warning' END, {ORPHANS} = 0",
]), "transactions", "clickstream"))
def quality_report(spark, root):
    """Orders checked against the customers seen on the web."""
    report = quality.validate(
        V.transactions(spark, root), "transactions", V.clickstream(spark, root).select("customer_id"),
        1000, VIEW_RULES["transactions"],
    )
    return tidy(report)


PEOPLE_COLUMNS = [
    "customer_id", "registration_date", "first_purchase_date", "segment", "city", "state", "city_tier", "gender",
    "age_years", "acquisition_channel", "product_category", "product_price_inr", "warranty_months", "amc_active",
    "is_churned", "churn_date", "observation_end_date", "duration_days",
]


@query(with_views("\nUNION ALL\n".join(
    f"SELECT 'customers' AS dataset, 'null_pct' AS \"check\", '{c}' AS \"column\", "
    f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS value, CAST(5 AS DOUBLE) AS threshold, "
    f"'warning' AS severity, 100.0 * count(*) FILTER ({c} IS NULL) / count(*) <= 5 AS passed FROM everyone"
    for c in PEOPLE_COLUMNS
), "everyone"))
def null_audit(spark, root):
    return quality.null_audit(V.customers(spark, root, keep_without_orders=True), "customers")


@query(with_views(f"""
SELECT 'customers' AS dataset, 'churn_rate' AS "check", 'is_churned' AS "column", round(avg(is_churned), 6) AS value,
       CAST({quality.CHURN_RANGE[1]} AS DOUBLE) AS threshold, 'warning' AS severity,
       avg(is_churned) BETWEEN {quality.CHURN_RANGE[0]} AND {quality.CHURN_RANGE[1]} AS passed FROM customers
UNION ALL
SELECT 'customers', 'non_positive', 'duration_days', CAST(count(*) FILTER (duration_days <= 0) AS DOUBLE), 0.0, 'error',
       count(*) FILTER (duration_days <= 0) = 0 FROM customers
UNION ALL
SELECT 'customers', 'unique', 'customer_id', CAST(count(*) - count(DISTINCT customer_id) AS DOUBLE), 0.0, 'error',
       count(*) = count(DISTINCT customer_id) FROM customers""", "customers"))
def customer_checks(spark, root):
    """What the validation of the customer table checks beyond its columns' rules."""
    report = quality.validate(V.customers(spark, root), "customers", min_rows=1)
    return tidy(report.where(F.col("check").isin("churn_rate", "non_positive", "unique")))


@query(with_views("SELECT DISTINCT customer_id FROM transactions WHERE customer_id NOT IN (SELECT customer_id FROM clickstream)", "transactions", "clickstream"))
def orphans(spark, root):
    return quality.orphans(V.transactions(spark, root), V.clickstream(spark, root))


@query(with_views("""
SELECT count(*) FILTER (u.customer_id IS NULL) AS orphan_ids, count(*) AS distinct_ids,
       round(100.0 * count(*) FILTER (u.customer_id IS NULL) / count(*), 6) AS orphan_pct
FROM (SELECT DISTINCT customer_id FROM transactions) t
LEFT JOIN (SELECT DISTINCT customer_id FROM clickstream) u USING (customer_id)""", "transactions", "clickstream"))
def referential_integrity(spark, root):
    return tidy(quality.orphan_summary(V.transactions(spark, root), V.clickstream(spark, root)))


@query(with_views("SELECT ticket_id, count(*) AS n FROM support_tickets GROUP BY 1 HAVING count(*) > 1", "support_tickets"))
def duplicate_keys(spark, root):
    return quality.duplicate_keys(V.support_tickets(spark, root), "ticket_id")


@query(with_views("""
SELECT ticket_id, customer_id, ticket_date, CAST(resolution_days AS BIGINT) AS resolution_days,
       CAST(ticket_date < DATE '1996-01-01' AS BIGINT) + CAST(resolution_days < 5 OR resolution_days > 45 AS BIGINT) AS n_violations
FROM support_tickets WHERE ticket_date < DATE '1996-01-01' OR resolution_days < 5 OR resolution_days > 45""", "support_tickets"))
def quarantine(spark, root):
    bad = quality.quarantine(V.support_tickets(spark, root), "support_tickets", VIEW_RULES["support_tickets"])
    return tidy(bad.select(
        "ticket_id", "customer_id", "ticket_date", "resolution_days", F.size("violations").alias("n_violations")
    ))


@query(with_views("""
SELECT day, n, previous_n, round(CAST(n - previous_n AS DOUBLE) / previous_n, 6) AS change,
       coalesce(abs(CAST(n - previous_n AS DOUBLE) / previous_n) > 0.05, false) AS alert
FROM (SELECT event_date AS day, count(*) AS n, lag(count(*)) OVER (ORDER BY event_date) AS previous_n
      FROM clickstream GROUP BY 1)""", "clickstream"))
def volume_change(spark, root):
    return tidy(quality.volume_change(V.clickstream(spark, root), "event_timestamp", 0.05))


# ---------------------------------------------------------------- splits and folds

@query(with_views(f"""
SELECT CAST(first_purchase_date <= DATE '{V.SPLIT}' AS BIGINT) AS is_train, count(*) AS n_rows,
       {r('avg(is_churned)', 'churn_rate')} FROM customers GROUP BY 1""", "customers"))
def temporal_split(spark, root):
    return tidy(evaluate.split_summary(V.customers(spark, root), V.SPLIT))


@query(with_views("""
, sizes AS (SELECT segment, is_churned, count(*) AS n FROM customers GROUP BY 1, 2)
SELECT segment, CAST(is_churned AS BIGINT) AS is_churned, CAST(fold AS BIGINT) AS fold,
       (n - fold + 4) // 5 AS n_rows
FROM sizes, (SELECT unnest([0, 1, 2, 3, 4]) AS fold) WHERE n > fold""".lstrip(), "customers").replace("\n, sizes AS", ",\nsizes AS"))
def kfold_sizes(spark, root):
    folds = evaluate.with_folds(V.customers(spark, root))
    return tidy(folds.groupBy("segment", "is_churned", "fold").agg(F.count(F.lit(1)).alias("n_rows")))


@query("""
SELECT o_orderstatus AS model, CAST(count(*) AS BIGINT) AS cv_folds, round(avg(m), 4) AS c_index_mean,
       round(stddev_pop(m), 4) AS c_index_std, round(min(m), 4) AS c_index_min, round(max(m), 4) AS c_index_max
FROM (SELECT o_orderstatus, o_orderpriority, avg(o_totalprice) / 100000 AS m FROM orders GROUP BY 1, 2) GROUP BY 1""")
def fold_summary(spark, root):
    """Summary over groups, here mean order values by status and priority."""
    folds = V.table(spark, root, "orders").groupBy(
        F.col("o_orderstatus").alias("model"), F.col("o_orderpriority").alias("fold")
    ).agg((F.avg("o_totalprice") / 100000).alias("c_index"))
    return evaluate.cv_summary(folds).select(
        "model", F.col("cv_folds").cast("bigint").alias("cv_folds"),
        "c_index_mean", "c_index_std", "c_index_min", "c_index_max",
    )


@query("""
SELECT run_id, status, round(concordance_index, 4) AS concordance_index FROM (
  SELECT o_orderpriority || '/' || o_orderstatus AS run_id,
         CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         avg(o_totalprice) AS concordance_index FROM orders GROUP BY o_orderpriority, o_orderstatus)
WHERE status = 'FINISHED' ORDER BY 3 DESC, 1 LIMIT 1""")
def best_run(spark, root):
    runs = V.table(spark, root, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.avg("o_totalprice").alias("concordance_index")
    ).select(
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("run_id"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("FINISHED").alias("status"),
        "concordance_index",
    )
    return tidy(tables.best_run(runs), 4)


# ---------------------------------------------------------------- survival curves

def life_sql(strata: str = "") -> str:
    """Life table and Kaplan-Meier curve per stratum."""
    s = f"{strata}, " if strata else ""
    part = f"PARTITION BY {strata}" if strata else ""
    group = f"{strata}, " if strata else ""
    origin = f"SELECT {s}0, 0, 0, n_all, 1.0, 0.0 FROM (SELECT {s}count(*) AS n_all, min(duration_days) AS t0 FROM customers {'GROUP BY ' + strata if strata else ''}) WHERE t0 > 0"
    return f"""
, ends AS (SELECT {s}duration_days AS time, sum(is_churned) AS events, count(*) AS exits
           FROM customers GROUP BY {group}duration_days),
atrisk AS (SELECT *, sum(exits) OVER ({part} ORDER BY time DESC) AS at_risk FROM ends),
curve AS (SELECT {s}time, events, exits, at_risk,
  CASE WHEN events = at_risk THEN 0.0 ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / CAST(at_risk AS DOUBLE)) END) OVER ({part} ORDER BY time)) END AS survival,
  sum(CASE WHEN events < at_risk THEN events / (CAST(at_risk AS DOUBLE) * (at_risk - events)) END) OVER ({part} ORDER BY time) AS greenwood
  FROM atrisk UNION ALL {origin})
"""


def km_views(select: str, strata: str = "") -> str:
    return with_views(life_sql(strata).lstrip() + select, "customers").replace("\n, ends AS", ",\nends AS")


CURVE_SQL = f"{b('time')}, {b('events')}, {b('exits')}, {b('at_risk')}, {r('survival')}"


@query(km_views(f"SELECT {CURVE_SQL} FROM curve"))
def km_curve(spark, root):
    return tidy(LT.kaplan_meier(V.customers(spark, root)))


@query(km_views(f"SELECT segment, {CURVE_SQL} FROM curve", "segment"))
def km_by_segment(spark, root):
    return tidy(LT.kaplan_meier(V.customers(spark, root), strata=("segment",)))


@query(km_views(f"SELECT city_tier, {CURVE_SQL} FROM curve", "city_tier").replace("SELECT city_tier, CAST", "SELECT CAST(city_tier AS BIGINT) AS city_tier, CAST"))
def km_by_city_tier(spark, root):
    return tidy(LT.kaplan_meier(V.customers(spark, root), strata=("city_tier",)))


KM_HORIZONS = (90, 180, 365, 1500)


@query(km_views(
    "SELECT segment, CAST(min(time) FILTER (survival <= 0.5) AS DOUBLE) AS median_survival_days, "
    + ", ".join(f"round(arg_min(survival, abs(time - {h}) - time / 1e6), 6) AS survival_prob_{h}d" for h in KM_HORIZONS)
    + " FROM curve GROUP BY 1", "segment"))
def km_summary(spark, root):
    curve = LT.kaplan_meier(V.customers(spark, root), strata=("segment",))
    return tidy(LT.km_summary(curve, ("segment",), KM_HORIZONS, never=None))


@query(km_views(f"""
SELECT {b('time')}, {r('survival')}, {r('greenwood', places=9)},
  CASE WHEN survival >= 1 - 1e-15 THEN 1.0 WHEN survival > 0 THEN round(pow(survival, exp(-1.959963984540054 * sqrt(greenwood) / ln(survival))), 6) END AS ci_lower,
  CASE WHEN survival >= 1 - 1e-15 THEN 1.0 WHEN survival > 0 THEN round(pow(survival, exp(1.959963984540054 * sqrt(greenwood) / ln(survival))), 6) END AS ci_upper
FROM curve"""))
def km_ci(spark, root):
    c = LT.kaplan_meier(V.customers(spark, root), alpha=0.05)
    return c.select(
        F.col("time").cast("bigint").alias("time"), F.round("survival", 6).alias("survival"),
        F.round("greenwood", 9).alias("greenwood"), F.round("ci_lower", 6).alias("ci_lower"),
        F.round("ci_upper", 6).alias("ci_upper"),
    )


def logrank_sql(group: str) -> str:
    """Per event time and group: events and numbers at risk."""
    return f"""
, times AS (SELECT DISTINCT duration_days AS t FROM customers WHERE is_churned = 1),
cells AS (SELECT t, g, count(*) FILTER (c.duration_days >= t) AS n_g,
                 count(*) FILTER (c.duration_days = t AND c.is_churned = 1) AS d_g
          FROM times, (SELECT DISTINCT {group} AS g FROM customers) LEFT JOIN customers c ON c.{group} = g GROUP BY 1, 2),
whole AS (SELECT *, sum(n_g) OVER (PARTITION BY t) AS n, sum(d_g) OVER (PARTITION BY t) AS d FROM cells)
"""


@query(with_views(logrank_sql("segment").lstrip() + f"""
SELECT g AS segment, {b('sum(d_g)', 'observed')}, {r('sum(d * CAST(n_g AS DOUBLE) / n)', 'expected')}
FROM whole GROUP BY 1""", "customers").replace("\n, times AS", ",\ntimes AS"))
def logrank_multi(spark, root):
    return tidy(LT.logrank_groups(V.customers(spark, root), "segment"))


@query(with_views(logrank_sql("amc_active").lstrip() + f"""
SELECT '0_vs_1' AS test, {r("pow(sum(d_g) - sum(d * CAST(n_g AS DOUBLE) / n), 2) / sum(CASE WHEN n > 1 THEN d * (CAST(n_g AS DOUBLE) / n) * (1 - CAST(n_g AS DOUBLE) / n) * (n - d) / CAST(n - 1 AS DOUBLE) END)", 'test_statistic')}
FROM whole WHERE g = 0""", "customers").replace("\n, times AS", ",\ntimes AS"))
def logrank_two(spark, root):
    return tidy(LT.logrank_report(V.customers(spark, root), "amc_active").select("test", "test_statistic"))


# ---------------------------------------------------------------- models with given parameters

# Coefficients of the demonstration model.
FIXED_NUMERIC = {"product_price_inr": 0.35, "warranty_months": -0.2, "amc_active": -0.4}
FIXED_LEVELS = {("segment", "BUILDING"): 0.25, ("segment", "MACHINERY"): -0.15}


def fixed_design(df: DataFrame) -> tuple[Design, list[float]]:
    stats = {row["column"]: row for row in covariate_stats(df, list(FIXED_NUMERIC)).collect()}
    design = Design(
        [(c, stats[c]["mean"], stats[c]["std"]) for c in FIXED_NUMERIC], list(FIXED_LEVELS)
    )
    return design, [*FIXED_NUMERIC.values(), *FIXED_LEVELS.values()]


def fixed_cox(spark, root) -> tuple[DataFrame, cox.CoxModel]:
    people = V.customers(spark, root)
    design, beta = fixed_design(people)
    return people, cox.fixed_model(people, design, beta)


COX_SQL = """
, stats AS (SELECT """ + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in FIXED_NUMERIC) + """ FROM customers),
hazards AS (SELECT c.*, exp(""" + " + ".join(
    [f"{w} * ({c} - {c}_m) / {c}_s" for c, w in FIXED_NUMERIC.items()]
    + [f"{w} * CAST({c} = '{level}' AS INT)" for (c, level), w in FIXED_LEVELS.items()]
) + """) AS ph FROM customers c, stats),
bytime AS (SELECT duration_days AS time, sum(is_churned) AS d, sum(ph) AS w FROM hazards GROUP BY 1),
steps AS (SELECT time, CASE WHEN d > 0 THEN d / sum(w) OVER (ORDER BY time DESC) ELSE 0.0 END AS hazard FROM bytime),
base AS (SELECT time, hazard, sum(hazard) OVER (ORDER BY time) AS cum_hazard FROM steps
         UNION ALL SELECT 0, 0.0, 0.0 FROM (SELECT min(time) AS t0 FROM steps) WHERE t0 > 0)
"""


def cox_views(select: str, more: str = "") -> str:
    return with_views(COX_SQL.lstrip() + more + select, "customers").replace("\n, stats AS", ",\nstats AS")


def at(h: float) -> str:
    return f"(SELECT arg_min(cum_hazard, abs(time - {h}) - time / 1e6) FROM base)"


def survival_sql(h: float) -> str:
    return f"exp(-{at(h)} * ph)"


MEDIAN_SQL = "(SELECT CAST(min(time) AS DOUBLE) FROM base WHERE cum_hazard >= ln(2.0) / ph AND hazard > 0)"
LONG = (500, 1000, 1500, 2000)


@query(cox_views(f"SELECT {b('time')}, {r('hazard', places=9)}, {r('cum_hazard')}, {r('exp(-cum_hazard)', 'survival')} FROM base"))
def baseline_breslow(spark, root):
    _, model = fixed_cox(spark, root)
    return model.baseline.select(
        F.col("time").cast("bigint").alias("time"), F.round("hazard", 9).alias("hazard"),
        F.round("cum_hazard", 6).alias("cum_hazard"), F.round("survival", 6).alias("survival"),
    )


@query(cox_views("SELECT customer_id, " + ", ".join(r(survival_sql(h), f"survival_prob_{h}d") for h in LONG) + " FROM hazards"))
def cox_score_fixed(spark, root):
    people, model = fixed_cox(spark, root)
    return tidy(model.survival_at_horizons(people, LONG))


@query(cox_views(f"SELECT customer_id, {r('ph', 'partial_hazard')}, {MEDIAN_SQL} AS median_survival_days FROM hazards"))
def cox_median(spark, root):
    people, model = fixed_cox(spark, root)
    out = model.with_median(people).withColumn("partial_hazard", model.partial_hazard(people))
    m = F.col("median_survival_days")
    return tidy(out.select(
        "customer_id", "partial_hazard", F.when(m < float("inf"), m).alias("median_survival_days")
    ))


@query(cox_views(
    "SELECT customer_id, '2001-08-01' AS score_date, "
    + ", ".join(r(survival_sql(h), f"survival_prob_{h}d") for h in (30, 60, 90, 180))
    + f", {MEDIAN_SQL} AS median_survival_days, CASE WHEN {survival_sql(90)} < 0.998 THEN 'High' WHEN {survival_sql(90)} < 0.999 THEN 'Medium' ELSE 'Low' END AS churn_risk_segment, "
    + r("ph", "partial_hazard") + " FROM hazards WHERE is_churned = 0"))
def score_table(spark, root):
    people, model = fixed_cox(spark, root)
    scores = scoring.score(scoring.active(people), model, "2001-08-01", 0.998, 0.999)
    m = F.col("median_survival_days")
    return tidy(scores.withColumn("median_survival_days", F.when(m < float("inf"), m)))


@query(cox_views(f"""
SELECT score_date, churn_risk_segment, count(*) AS n, round(count(*) / sum(CAST(count(*) AS DOUBLE)) OVER (), 6) AS share FROM (
  SELECT '2001-08-01' AS score_date, CASE WHEN {survival_sql(2000)} < 0.55 THEN 'High' WHEN {survival_sql(2000)} < 0.7 THEN 'Medium' ELSE 'Low' END AS churn_risk_segment
  FROM hazards) GROUP BY 1, 2"""))
def risk_segments(spark, root):
    people, model = fixed_cox(spark, root)
    s = model.survival_at_horizons(people, (2000,)).select(
        F.lit("2001-08-01").alias("score_date"),
        S.risk_segment(F.col("survival_prob_2000d"), 0.55, 0.7).alias("churn_risk_segment"),
    )
    return tidy(scoring.segment_shares(s))


@query(cox_views(f"""
SELECT CAST(bin AS BIGINT) AS bin, round(bin / 10.0, 6) AS lower, round((bin + 1) / 10.0, 6) AS upper,
       (SELECT count(*) FROM hazards WHERE least(9, floor({survival_sql(2000)} * 10)) = bin) AS n
FROM (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS bin)"""))
def score_histogram(spark, root):
    people, model = fixed_cox(spark, root)
    s = model.survival_at_horizons(people, (2000,))
    return tidy(scoring.score_histogram(s, "survival_prob_2000d"))


@query(with_views("SELECT 'product_price_inr' AS \"column\", round(avg(product_price_inr), 4) AS mean, round(stddev_samp(product_price_inr), 4) AS std FROM customers UNION ALL SELECT 'warranty_months', round(avg(warranty_months), 4), round(stddev_samp(warranty_months), 4) FROM customers UNION ALL SELECT 'duration_days', round(avg(duration_days), 4), round(stddev_samp(duration_days), 4) FROM customers", "customers"))
def zscore_stats(spark, root):
    return tidy(covariate_stats(V.customers(spark, root), ["product_price_inr", "warranty_months", "duration_days"]), 4)


LEVEL_COLUMNS = [("segment", x) for x in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")] + [
    ("city_tier", x) for x in ("2", "3", "4", "5")]


@query(with_views("SELECT customer_id, round((product_price_inr - avg(product_price_inr) OVER ()) / stddev_samp(product_price_inr) OVER (), 6) AS product_price_inr, " + ", ".join(
    f"CAST(CAST({c} AS VARCHAR) = '{x}' AS DOUBLE) AS {c}_{x}" for c, x in LEVEL_COLUMNS) + " FROM customers", "customers"))
def onehot(spark, root):
    people = V.customers(spark, root)
    design = fit_design(people, ["product_price_inr"], ["segment", "city_tier"])
    return tidy(people.select(
        "customer_id", *[c.alias(t) for t, c in zip(design.terms, design.columns(people))]
    ))


# Parameters of the demonstration AFT models.
AFT_BETA = {"warranty_months": 0.01, "amc_active": 0.2}
AFT_INTERCEPT, AFT_SIGMA = 7.5, 0.4


def fixed_aft(spark, family: str) -> aft.AftModel:
    return aft.AftModel(
        family, list(AFT_BETA), list(AFT_BETA.values()), AFT_INTERCEPT, AFT_SIGMA, float("nan"), 0, spark
    )


AFT_MU = f"({AFT_INTERCEPT} + 0.01 * warranty_months + 0.2 * amc_active)"
AFT_Z = f"(ln(1000.0) - {AFT_MU}) / {AFT_SIGMA}"


@query(with_views(f"""
SELECT customer_id, {r(f'exp(-exp({AFT_Z}))', 'weibull_s')}, {r(f'exp({AFT_MU} + {AFT_SIGMA} * ln(ln(2.0)))', 'weibull_median', 4)},
  {r(f'exp({AFT_MU}) * gamma(1 + {AFT_SIGMA})', 'weibull_mean', 4)}, {r(f'1 / (1 + exp({AFT_Z}))', 'log_logistic_s')},
  {r(f'exp({AFT_MU})', 'log_logistic_median', 4)}, {r(f'exp({AFT_MU}) * pi() * {AFT_SIGMA} / sin(pi() * {AFT_SIGMA})', 'log_logistic_mean', 4)},
  {r(f'exp({AFT_MU})', 'log_normal_median', 4)}, {r(f'exp({AFT_MU} + {AFT_SIGMA} * {AFT_SIGMA} / 2)', 'log_normal_mean', 4)}
FROM customers""", "customers"))
def aft_predict_fixed(spark, root):
    people = V.customers(spark, root)
    w, l, n = (fixed_aft(spark, f) for f in ("weibull", "log_logistic", "log_normal"))
    return people.select(
        "customer_id",
        F.round(w.survival(people, 1000), 6).alias("weibull_s"),
        F.round(w.median(people), 4).alias("weibull_median"),
        F.round(w.expectation(people), 4).alias("weibull_mean"),
        F.round(l.survival(people, 1000), 6).alias("log_logistic_s"),
        F.round(l.median(people), 4).alias("log_logistic_median"),
        F.round(l.expectation(people), 4).alias("log_logistic_mean"),
        F.round(n.median(people), 4).alias("log_normal_median"),
        F.round(n.expectation(people), 4).alias("log_normal_mean"),
    )


@query()
def log_normal_survival(spark, root):
    people = V.customers(spark, root)
    return fixed_aft(spark, "log_normal").survival_at_horizons(people, LONG)


@query(with_views(f"""
SELECT time, {r(f'avg(exp(-exp((ln(time) - {AFT_MU}) / {AFT_SIGMA})))', 'survival')}, count(*) AS n
FROM customers, (SELECT CAST(unnest(range(100, 2500, 100)) AS DOUBLE) AS time) GROUP BY time""", "customers"))
def aft_mean_curve(spark, root):
    people = V.customers(spark, root)
    return tidy(fixed_aft(spark, "weibull").mean_curve(people, range(100, 2500, 100)))


# ---------------------------------------------------------------- evaluation

PAIRS_SQL = """
SELECT CAST(sum(comparable) AS BIGINT) AS comparable, CAST(sum(concordant) AS BIGINT) AS concordant,
       CAST(sum(tied) AS BIGINT) AS tied, round((sum(concordant) + 0.5 * sum(tied)) / sum(comparable), 6) AS c_index
FROM (SELECT count(*) AS comparable, count(*) FILTER (j.risk < i.risk) AS concordant, count(*) FILTER (j.risk = i.risk) AS tied
      FROM scored i JOIN scored j ON i.is_churned = 1 AND (j.duration_days > i.duration_days OR (j.duration_days = i.duration_days AND j.is_churned = 0)))"""


def price_step(spark, root) -> DataFrame:
    """Customers with a coarse risk (first order value in steps), so that risks tie."""
    return V.customers(spark, root).withColumn("risk", F.floor(F.col("product_price_inr") / 5000).cast("double"))


@query(with_views(", scored AS (SELECT floor(product_price_inr / 5000) AS risk, duration_days, is_churned FROM customers)" + PAIRS_SQL, "customers").replace("\n, scored AS", ",\nscored AS"))
def c_index(spark, root):
    counts = concordance(price_step(spark, root))
    return tidy(spark.createDataFrame(
        [(counts["comparable"], counts["concordant"], counts["tied"], counts["c_index"])],
        "comparable bigint, concordant bigint, tied bigint, c_index double",
    ))


SCORED = ", scored AS (SELECT floor(product_price_inr / 5000) AS risk, duration_days, is_churned FROM customers)"


@query(with_views(SCORED + PAIRS_SQL, "customers").replace("\n, scored AS", ",\nscored AS"))
def c_index_grid(spark, root):
    """The same count through a grid of many lines."""
    counts = concordance(price_step(spark, root), points_per_line=40)
    return tidy(spark.createDataFrame(
        [(counts["comparable"], counts["concordant"], counts["tied"], counts["c_index"])],
        "comparable bigint, concordant bigint, tied bigint, c_index double",
    ))


@query(with_views(
    SCORED + f" SELECT 'cox_ph' AS model, c_index AS concordance_index, c_index >= {evaluate.C_INDEX_GATE} AS register FROM ({PAIRS_SQL})",
    "customers",
).replace("\n, scored AS", ",\nscored AS"))
def quality_gate(spark, root):
    """May a model of this concordance be registered?"""
    index = round(concordance(price_step(spark, root))["c_index"], 6)
    report = spark.createDataFrame([("cox_ph", index)], "model string, concordance_index double")
    return evaluate.passes_gate(report)


@query(with_views("""
, scored AS (SELECT floor(product_price_inr / 5000) AS risk, duration_days, is_churned FROM customers),
n AS (SELECT count(*) FILTER (is_churned = 1 AND duration_days <= 1500) AS cases, count(*) FILTER (duration_days > 1500) AS controls FROM scored)
SELECT CAST(1500 AS DOUBLE) AS horizon, cases, controls, round(wins / cases / controls, 6) AS auc FROM n,
 (SELECT sum(CASE WHEN j.risk < i.risk THEN 1.0 WHEN j.risk = i.risk THEN 0.5 ELSE 0 END) AS wins
  FROM scored i JOIN scored j ON i.is_churned = 1 AND i.duration_days <= 1500 AND j.duration_days > 1500)""".lstrip(), "customers").replace("\n, scored AS", ",\nscored AS"))
def auc_horizon(spark, root):
    return tidy(evaluate.auc_at(price_step(spark, root), 1500))


def brier_sql(h: int) -> str:
    return f"avg(pow(CAST(is_churned = 1 AND duration_days <= {h} AS INT) - (1 - s{h}), 2)) FILTER (duration_days >= {h} OR is_churned = 1)"


PREDICTED = ", predicted AS (SELECT customer_id, is_churned, duration_days, " + ", ".join(f"{survival_sql(h)} AS s{h}" for h in LONG) + " FROM hazards)\n"


@query(cox_views(f"SELECT {r(brier_sql(1500), 'brier_score')}, count(*) FILTER (duration_days >= 1500 OR is_churned = 1) AS n_evaluated FROM predicted", PREDICTED))
def brier(spark, root):
    people, model = fixed_cox(spark, root)
    scored = people.select("*", *model.survival_columns(people, (1500,)))
    return tidy(evaluate.brier(scored, "survival_prob_1500d", 1500))


@query(cox_views("SELECT " + ", ".join(r(brier_sql(h), f"brier_{h}d") for h in LONG) + ", "
                 + r("(" + " + ".join(f"({brier_sql(a)} + {brier_sql(z)}) / 2 * {z - a}" for a, z in zip(LONG, LONG[1:])) + f") / {LONG[-1] - LONG[0]}", "integrated_brier")
                 + " FROM predicted", PREDICTED))
def integrated_brier(spark, root):
    people, model = fixed_cox(spark, root)
    scored = people.select("*", *model.survival_columns(people, LONG))
    return tidy(evaluate.integrated_brier(scored, {h: f"survival_prob_{h}d" for h in LONG}))


# ---------------------------------------------------------------- drift

def order_sides(spark, root) -> tuple[DataFrame, DataFrame]:
    """Orders before and from the middle of the period."""
    o = V.table(spark, root, "orders").select(
        "o_totalprice", F.dayofmonth("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("d"),
    )
    mark = F.lit("1998-07-01").cast("date")
    return o.where(F.col("d") < mark), o.where(F.col("d") >= mark)


NUMERIC_SIDES = """
, sides AS (SELECT 'o_totalprice' AS feature, o_totalprice AS v, CAST(CAST(o_orderdate AS DATE) >= DATE '1998-07-01' AS INT) AS side FROM orders
            UNION ALL SELECT 'day', day(o_orderdate), CAST(CAST(o_orderdate AS DATE) >= DATE '1998-07-01' AS INT) FROM orders),
sizes AS (SELECT feature, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1 FROM sides GROUP BY 1),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM sides WHERE side = 0 GROUP BY 1),
binned AS (SELECT s.feature, s.side, CASE WHEN v = e[len(e)] THEN len(e) - 1 ELSE len([x for x in e if x <= v]) END AS bin
           FROM sides s JOIN edges USING (feature) WHERE v >= e[1] AND v <= e[len(e)]),
shares AS (SELECT feature, bin, greatest(1e-6, count(*) FILTER (side = 0) / CAST(any_value(n0) AS DOUBLE)) AS p0, greatest(1e-6, count(*) FILTER (side = 1) / CAST(any_value(n1) AS DOUBLE)) AS p1
           FROM binned JOIN sizes USING (feature) GROUP BY 1, 2),
ecdf AS (SELECT feature, v, sum(count(*) FILTER (side = 0)) OVER (PARTITION BY feature ORDER BY v) / CAST(any_value(n0) AS DOUBLE)
         - sum(count(*) FILTER (side = 1)) OVER (PARTITION BY feature ORDER BY v) / CAST(any_value(n1) AS DOUBLE) AS gap
         FROM sides JOIN sizes USING (feature) GROUP BY 1, 2)
"""


CATEGORY_SIDES = """
, csides AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS v, CAST(CAST(o_orderdate AS DATE) >= DATE '1998-07-01' AS INT) AS side FROM orders
            UNION ALL SELECT 'o_orderstatus', o_orderstatus, CAST(CAST(o_orderdate AS DATE) >= DATE '1998-07-01' AS INT) FROM orders),
cells AS (SELECT feature, v, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS a, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS b FROM csides GROUP BY 1, 2),
csizes AS (SELECT *, sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM cells),
cstats AS (SELECT feature, sum((greatest(1e-6, b / nb) - greatest(1e-6, a / na)) * ln(greatest(1e-6, b / nb) / greatest(1e-6, a / na))) AS psi,
   sum(pow(a - (a + b) * na / (na + nb), 2) / ((a + b) * na / (na + nb)) + pow(b - (a + b) * nb / (na + nb), 2) / ((a + b) * nb / (na + nb))) AS chi2, count(*) - 1 AS degrees
   FROM csizes GROUP BY 1)
"""


def side_views(select: str, *parts: str) -> str:
    text = "".join(parts).strip()
    return "WITH " + text.removeprefix(",").strip().replace("\n, csides AS", ",\ncsides AS") + "\n" + select


NUMERIC_DRIFT = ["o_totalprice", "day"]
CATEGORY_DRIFT = ["o_orderpriority", "o_orderstatus"]


@query(side_views(f"SELECT feature, {r('sum((p1 - p0) * ln(p1 / p0))', 'psi')} FROM shares GROUP BY 1", NUMERIC_SIDES))
def psi_numeric(spark, root):
    return tidy(drift.numeric_drift(*order_sides(spark, root), NUMERIC_DRIFT).select("feature", "psi"))


@query(side_views(f"SELECT feature, {r('sum(p1 * ln(p1 / p0))', 'kl')} FROM shares GROUP BY 1", NUMERIC_SIDES))
def kl_divergence(spark, root):
    return tidy(drift.numeric_drift(*order_sides(spark, root), NUMERIC_DRIFT).select("feature", "kl"))


@query(side_views(f"SELECT feature, {r('max(abs(gap))', 'ks_stat')}, {b('any_value(n0)', 'ref_n')}, {b('any_value(n1)', 'cur_n')} FROM ecdf JOIN sizes USING (feature) GROUP BY 1", NUMERIC_SIDES))
def ks_stat(spark, root):
    sides = order_sides(spark, root)
    return tidy(drift.numeric_drift(*sides, NUMERIC_DRIFT).select("feature", "ks_stat", "ref_n", "cur_n"))


@query(side_views(f"SELECT feature, {r('psi')} FROM cstats", CATEGORY_SIDES))
def psi_categorical(spark, root):
    return tidy(drift.categorical_drift(*order_sides(spark, root), CATEGORY_DRIFT).select("feature", "psi"))


@query(side_views(f"SELECT feature, {r('chi2', 'chi2_stat')}, {b('degrees')} FROM cstats", CATEGORY_SIDES))
def chi2_stat(spark, root):
    return tidy(drift.categorical_drift(*order_sides(spark, root), CATEGORY_DRIFT).select("feature", "chi2_stat", "degrees"))


@query(side_views("""
, report AS (SELECT s.feature, 'numeric' AS type, s.psi, k.ks AS ks_stat, CAST(NULL AS DOUBLE) AS chi2_stat
  FROM (SELECT feature, sum((p1 - p0) * ln(p1 / p0)) AS psi FROM shares GROUP BY 1) s JOIN (SELECT feature, max(abs(gap)) AS ks FROM ecdf GROUP BY 1) k USING (feature)
  UNION ALL SELECT feature, 'categorical', psi, NULL, chi2 FROM cstats)
SELECT feature, type, round(psi, 4) AS psi, round(ks_stat, 4) AS ks_stat, round(chi2_stat, 4) AS chi2_stat,
  CASE WHEN psi < 0.1 THEN 'none' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band FROM report""", NUMERIC_SIDES, CATEGORY_SIDES))
def drift_report(spark, root):
    report = drift.drift_report(*order_sides(spark, root), NUMERIC_DRIFT, CATEGORY_DRIFT)
    return report.select("feature", "type", "psi", "ks_stat", "chi2_stat", "psi_band")


def score_batches(spark, root) -> DataFrame:
    """Scores of three dates, made from the values of the events of each third of the month."""
    day = F.dayofmonth("ts")
    return V.table(spark, root, "events").select(
        F.col("user_id").alias("customer_id"),
        F.when(day <= 10, "2024-01-10").when(day <= 20, "2024-01-20").otherwise("2024-01-31").alias("score_date"),
        F.exp(-F.col("value") / 10).alias("survival_prob_90d"),
    )


BATCHES = "batches AS (SELECT user_id AS customer_id, CASE WHEN day(ts) <= 10 THEN '2024-01-10' WHEN day(ts) <= 20 THEN '2024-01-20' ELSE '2024-01-31' END AS score_date, exp(-value / 10) AS survival_prob_90d FROM events)"


@query(f"WITH {BATCHES} SELECT score_date, count(*) AS n, round(sum(survival_prob_90d), 4) AS total FROM batches WHERE score_date = (SELECT max(score_date) FROM batches WHERE score_date < '2024-01-31') GROUP BY 1")
def previous_scores(spark, root):
    before = tables.scores_before(score_batches(spark, root), "2024-01-31")
    return before.groupBy("score_date").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("survival_prob_90d"), 4).alias("total")
    )


SCORE_SIDES = f"""
WITH {BATCHES},
sides AS (SELECT survival_prob_90d AS v, CAST(score_date = '2024-01-31' AS INT) AS side FROM batches WHERE score_date IN ('2024-01-20', '2024-01-31')),
sizes AS (SELECT CAST(count(*) FILTER (side = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS n1 FROM sides),
edges AS (SELECT list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM sides WHERE side = 0),
shares AS (SELECT CASE WHEN v = e[len(e)] THEN len(e) - 1 ELSE len([x for x in e if x <= v]) END AS bin,
    greatest(1e-6, count(*) FILTER (side = 0) / any_value(n0)) AS p0, greatest(1e-6, count(*) FILTER (side = 1) / any_value(n1)) AS p1
    FROM sides, edges, sizes WHERE v >= e[1] AND v <= e[len(e)] GROUP BY 1)
"""


@query(with_views(
    f", {BATCHES} SELECT customer_id, score_date, {r('survival_prob_90d')}, {b('duration_days')}, {b('is_churned')} "
    "FROM batches JOIN customers USING (customer_id) WHERE score_date = '2024-01-10'",
    "customers",
).replace("\n, batches AS", ",\nbatches AS"))
def realised_join(spark, root):
    """Scores of a past date with what has become of the customers since."""
    outcomes = V.customers(spark, root).select("customer_id", "duration_days", "is_churned")
    return tidy(monitor.realised(score_batches(spark, root), outcomes, "2024-01-10"))


@query(SCORE_SIDES + "SELECT sum((p1 - p0) * ln(p1 / p0)) > 0.2 AS drift_detected FROM shares")
def batch_drift(spark, root):
    return drift.batch_drift(score_batches(spark, root), "2024-01-31")


@query(SCORE_SIDES + """
, gaps AS (SELECT v, sum(count(*) FILTER (side = 0)) OVER (ORDER BY v) / any_value(n0) - sum(count(*) FILTER (side = 1)) OVER (ORDER BY v) / any_value(n1) AS gap FROM sides, sizes GROUP BY v)
SELECT (SELECT round(sum((p1 - p0) * ln(p1 / p0)), 4) FROM shares) AS psi, round(max(abs(gap)), 4) AS ks_stat,
       (SELECT sum((p1 - p0) * ln(p1 / p0)) > 0.2 FROM shares) AS is_drifted FROM gaps""")
def score_drift(spark, root):
    scores = score_batches(spark, root)
    check = drift.score_drift(tables.scores_on(scores, "2024-01-20"), tables.scores_on(scores, "2024-01-31"))
    return check.select("psi", "ks_stat", "is_drifted")


# ---------------------------------------------------------------- monitoring

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def history(spark, root) -> DataFrame:
    """One evaluation run per market segment."""
    people = V.customers(spark, root).withColumn(
        "survival_prob_90d", F.exp(-F.floor(F.col("product_price_inr") / 5000) / 100)
    )
    dates = F.create_map(*[F.lit(x) for k, segment in enumerate(SEGMENTS, 1) for x in (segment, f"2001-0{k}-01")])
    runs = people.where(F.col("segment").isin(*SEGMENTS)).withColumn("run_date", F.element_at(dates, F.col("segment")))
    return monitor.evaluate_runs(runs, horizon=1500)


HISTORY = """
, scored AS (SELECT segment, 1 - exp(-floor(product_price_inr / 5000) / 100) AS risk, duration_days, is_churned FROM customers),
pairs AS (SELECT i.segment, (count(*) FILTER (j.risk < i.risk) + 0.5 * count(*) FILTER (j.risk = i.risk)) / CAST(count(*) AS DOUBLE) AS c
  FROM scored i JOIN scored j ON i.segment = j.segment AND i.is_churned = 1 AND (j.duration_days > i.duration_days OR (j.duration_days = i.duration_days AND j.is_churned = 0)) GROUP BY 1),
runs AS (SELECT segment, '2001-0' || row_number() OVER (ORDER BY segment) || '-01' AS run_date, c AS c_index,
  (SELECT avg(pow(CAST(s.is_churned = 1 AND s.duration_days <= 1500 AS INT) - s.risk, 2)) FROM scored s WHERE s.segment = p.segment AND (s.duration_days >= 1500 OR s.is_churned = 1)) AS brier_score,
  (SELECT count(*) FROM scored s WHERE s.segment = p.segment) AS n_customers, (SELECT sum(is_churned) FROM scored s WHERE s.segment = p.segment) AS n_churned FROM pairs p)
"""


def history_views(select: str) -> str:
    return with_views(HISTORY.lstrip() + select, "customers").replace("\n, scored AS", ",\nscored AS")


ALERT = "coalesce(lag(c_index) OVER (ORDER BY run_date) - c_index > 0.02, false)"


@query(history_views(f"""
SELECT run_date, round(c_index, 4) AS c_index, round(brier_score, 4) AS brier_score, {b('n_customers')}, {b('n_churned')},
       c_index < 0.7 AS below_threshold, {ALERT} AS degradation_alert FROM runs"""))
def perf_history(spark, root):
    return monitor.report(history(spark, root))


@query(history_views(f"SELECT arg_max(c_index < 0.7 OR alert, run_date) AS should_retrain FROM (SELECT *, {ALERT} AS alert FROM runs)"))
def retrain_signal(spark, root):
    return monitor.should_retrain(history(spark, root))


# ---------------------------------------------------------------- fitted models (no SQL form)

FIT_NUMERIC = ["product_price_inr", "warranty_months", "amc_active", "city_tier", "age_years"]
FIT_CATEGORICAL = ["segment", "product_category"]


def fitted_cox(spark, root) -> cox.CoxModel:
    return cox.fit_cox(V.customers(spark, root), numeric=FIT_NUMERIC, categorical=FIT_CATEGORICAL)


@query()
def cox_fit(spark, root):
    model = fitted_cox(spark, root)
    return spark.createDataFrame(
        [(model.log_likelihood, model.n_rows, model.n_events, model.steps)],
        "log_likelihood double, n_rows bigint, n_events bigint, steps int",
    )


@query()
def hazard_ratios(spark, root):
    return fitted_cox(spark, root).hazard_ratios()


@query()
def top_hazard_ratios(spark, root):
    return fitted_cox(spark, root).top_hazard_ratios(5)


@query()
def ph_test(spark, root):
    return fitted_cox(spark, root).ph_test()


@query()
def cox_elastic_net(spark, root):
    return cox.fit_cox(
        V.customers(spark, root), numeric=FIT_NUMERIC, categorical=FIT_CATEGORICAL, penalizer=5.0, l1_ratio=0.5
    ).hazard_ratios()


@query()
def cox_tvc_fit(spark, root):
    rows = interval_rows(spark, root).fillna({"orders_today": 0, "top_amount": 0.0})
    return cox.fit_cox_intervals(rows, ["orders_today", "top_amount"]).hazard_ratios()


def fitted_aft(spark, root, family: str) -> DataFrame:
    return aft.fit_aft(V.customers(spark, root), family, covariates=FIT_NUMERIC).coefficients()


@query()
def aft_weibull(spark, root):
    return fitted_aft(spark, root, "weibull")


@query()
def aft_lognormal(spark, root):
    return fitted_aft(spark, root, "log_normal")


@query()
def aft_loglogistic(spark, root):
    return fitted_aft(spark, root, "log_logistic")


@query()
def aft_comparison(spark, root):
    return aft.aft_report(aft.fit_all_aft(V.customers(spark, root), covariates=FIT_NUMERIC))


def model_table(spark, root) -> DataFrame:
    train, test = evaluate.temporal_split(V.customers(spark, root), "1995-06-30")
    return selection.compare_models(
        train, test, numeric=FIT_NUMERIC, categorical=FIT_CATEGORICAL, aft_covariates=FIT_NUMERIC, horizon=1500
    )


@query()
def model_report(spark, root):
    return model_table(spark, root)


@query()
def model_champion(spark, root):
    report = model_table(spark, root)
    return evaluate.champion(report).withColumn("kind", F.lit("best_concordance")).unionByName(
        evaluate.final_champion(report).withColumn("kind", F.lit("aic_then_concordance"))
    )


@query()
def cross_validate(spark, root):
    folds = selection.cross_validate(
        V.customers(spark, root), numeric=FIT_NUMERIC, categorical=FIT_CATEGORICAL, horizon=1500
    )
    return evaluate.cv_summary(folds)
