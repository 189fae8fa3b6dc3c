"""SQL text of the stand-in views and of every query that plain SQL can express."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

VIEWS = {
    "transactions": """
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS transaction_date, o_orderpriority AS transaction_type,
       o_totalprice AS amount_inr, CAST(o_orderstatus = 'F' AS INT) AS is_returned
FROM orders""",
    "clickstream": """
SELECT event_id, user_id AS customer_id, ts - INTERVAL 8218 DAY AS event_timestamp,
       CAST(ts - INTERVAL 8218 DAY AS DATE) AS event_date,
       CASE event_type WHEN 'view' THEN 'product_comparison' WHEN 'signup' THEN 'wishlist_add'
            ELSE event_type END AS event_type,
       CAST(floor(value) AS INT) AS session_duration_s,
       1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS pages_in_session
FROM events""",
    "support_tickets": """
SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS customer_id,
       CAST(l_shipdate AS DATE) AS ticket_date, CAST(l_quantity AS INT) AS resolution_days,
       CAST(l_linestatus = 'F' AS INT) AS is_escalated, 1 AS is_resolved,
       CAST(l_discount <= 0.05 AS INT) AS customer_satisfied
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "firsts": """
SELECT * FROM (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS first_purchase_date,
         o_orderpriority AS product_category, o_totalprice AS product_price_inr,
         o_orderstatus AS acquisition_channel,
         CAST(max(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) AS last_date,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""",
    "everyone": f"""
SELECT c_custkey AS customer_id, first_purchase_date AS registration_date, first_purchase_date,
       c_mktsegment AS segment, n_name AS city, CAST(n_regionkey AS VARCHAR) AS state,
       n_regionkey + 1 AS city_tier,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
       CASE WHEN c_acctbal >= 0 THEN CAST(18 + c_custkey % 60 AS INT) END AS age_years,
       acquisition_channel, product_category, product_price_inr,
       CASE WHEN c_custkey % 2 = 0 THEN 12 ELSE 24 END AS warranty_months,
       CAST(c_custkey % 3 = 0 AS INT) AS amc_active,
       CAST(last_date <= {AS_OF} - 270 AS INT) AS is_churned,
       CASE WHEN last_date <= {AS_OF} - 270 THEN last_date END AS churn_date,
       {AS_OF} AS observation_end_date,
       CASE WHEN last_date IS NULL THEN NULL
            WHEN last_date <= {AS_OF} - 270 THEN greatest(1, last_date - first_purchase_date)
            ELSE greatest(1, {AS_OF} - first_purchase_date) END AS duration_days
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN firsts ON c_custkey = customer_id""",
    "customers": "SELECT * FROM everyone WHERE first_purchase_date IS NOT NULL",
    "tx": f"SELECT * FROM transactions WHERE transaction_date <= {AS_OF}",
    "rfm": f"""
SELECT customer_id, count(*) AS total_transactions, sum(amount_inr) AS total_spend_inr,
       avg(amount_inr) AS avg_transaction_value_inr,
       {AS_OF} - max(transaction_date) AS days_since_last_transaction,
       ({AS_OF} - max(transaction_date)) / 30.44 AS months_since_last_transaction
FROM tx GROUP BY 1""",
    "txw": "SELECT customer_id, " + ", ".join(
        f"count(*) FILTER (transaction_date >= {AS_OF} - {n}) AS tx_count_{n}d, "
        f"sum(amount_inr) FILTER (transaction_date >= {AS_OF} - {n}) AS tx_amount_{n}d"
        for n in (30, 60, 90, 180)
    ) + f" FROM tx WHERE transaction_date >= {AS_OF} - 180 GROUP BY 1",
    "web": f"SELECT * FROM clickstream WHERE event_date <= {AS_OF}",
    "webw": "SELECT customer_id, " + ", ".join(
        f"count(DISTINCT event_date) FILTER (event_date >= {AS_OF} - {n}) AS active_days_{n}d, "
        f"count(*) FILTER (event_date >= {AS_OF} - {n}) AS total_events_{n}d, "
        f"avg(session_duration_s) FILTER (event_date >= {AS_OF} - {n}) AS avg_session_dur_s_{n}d, "
        f"avg(pages_in_session) FILTER (event_date >= {AS_OF} - {n}) AS avg_pages_{n}d, "
        f"count(*) FILTER (event_date >= {AS_OF} - {n} AND event_type = 'product_comparison') AS product_comparison_events_{n}d, "
        f"count(*) FILTER (event_date >= {AS_OF} - {n} AND event_type = 'wishlist_add') AS wishlist_add_events_{n}d, "
        f"count(DISTINCT event_date) FILTER (event_date >= {AS_OF} - {n}) / ({n} / 7.0) AS avg_weekly_sessions_{n}d"
        for n in (30, 90)
    ) + f", {AS_OF} - max(event_date) AS days_since_last_web_visit FROM web GROUP BY 1",
    "trend": f"""
SELECT customer_id,
       count(DISTINCT event_date) FILTER (event_date >= {AS_OF} - 30) / 30.0
       - count(DISTINCT event_date) FILTER (event_date BETWEEN {AS_OF} - 90 AND {AS_OF} - 61) / 30.0
         AS session_frequency_trend_90d
FROM web WHERE event_date >= {AS_OF} - 30 OR event_date BETWEEN {AS_OF} - 90 AND {AS_OF} - 61
GROUP BY 1""",
    "support": f"""
SELECT customer_id, count(ticket_id) AS total_support_tickets,
       avg(resolution_days) AS avg_resolution_days, avg(is_escalated) AS escalation_rate,
       avg(customer_satisfied) AS avg_satisfaction,
       {AS_OF} - max(ticket_date) AS days_since_last_support_contact,
       count(*) FILTER (ticket_date >= {AS_OF} - 30) AS support_tickets_30d,
       count(*) FILTER (ticket_date >= {AS_OF} - 90) AS support_tickets_90d
FROM support_tickets WHERE ticket_date <= {AS_OF} GROUP BY 1""",
    "static": f"""
SELECT customer_id, segment, city_tier, gender, age_years, acquisition_channel, product_category,
       product_price_inr, warranty_months, amc_active, first_purchase_date, observation_end_date,
       is_churned, duration_days, {AS_OF} - first_purchase_date AS tenure_days,
       CAST(first_purchase_date + CAST(warranty_months * 30 AS INT) AS DATE) AS warranty_expiry_date,
       first_purchase_date + CAST(warranty_months * 30 AS INT) - {AS_OF} AS warranty_remaining_days,
       CAST(first_purchase_date + CAST(warranty_months * 30 AS INT) - {AS_OF} < 0 AS INT) AS is_warranty_expired
FROM everyone""",
    "blocks": """
SELECT * FROM static LEFT JOIN rfm USING (customer_id) LEFT JOIN txw USING (customer_id)
LEFT JOIN webw USING (customer_id) LEFT JOIN trend USING (customer_id)
LEFT JOIN support USING (customer_id)""",
    "matrix": """
SELECT *, rfm_recency_score + rfm_frequency_score + rfm_monetary_score AS rfm_score FROM (
  SELECT *,
    CASE WHEN days_since_last_transaction <= 30 THEN 5 WHEN days_since_last_transaction <= 90 THEN 4
         WHEN days_since_last_transaction <= 180 THEN 3 WHEN days_since_last_transaction <= 270 THEN 2
         ELSE 1 END AS rfm_recency_score,
    CASE WHEN total_transactions >= 10 THEN 5 WHEN total_transactions >= 6 THEN 4
         WHEN total_transactions >= 4 THEN 3 WHEN total_transactions >= 2 THEN 2 ELSE 1 END AS rfm_frequency_score,
    CASE WHEN total_spend_inr >= 200000 THEN 5 WHEN total_spend_inr >= 100000 THEN 4
         WHEN total_spend_inr >= 60000 THEN 3 WHEN total_spend_inr >= 30000 THEN 2 ELSE 1 END AS rfm_monetary_score,
    least(1.0, greatest(0.0, 0.5 * coalesce(avg_weekly_sessions_90d, 0) / 5.0
      + 0.3 * coalesce(avg_satisfaction, 0.5)
      + 0.2 * (1.0 - least(1.0, coalesce(days_since_last_transaction, 365) / 365.0)))) AS engagement_score
  FROM blocks)""",
}

NEEDS = {
    "everyone": ["firsts"], "customers": ["everyone"], "tx": ["transactions"], "rfm": ["tx"],
    "txw": ["tx"], "web": ["clickstream"], "webw": ["web"], "trend": ["web"],
    "support": ["support_tickets"], "static": ["everyone"],
    "blocks": ["static", "rfm", "txw", "webw", "trend", "support"], "matrix": ["blocks"],
}


def with_views(sql: str, *names: str, **more: str) -> str:
    """Prefix the named views (with what they need) and further CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n]})" for n in ordered] + [f"{k} AS ({v})" for k, v in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql
