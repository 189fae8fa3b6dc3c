"""Fixed layouts: raw tables, score table, and the row rules each raw table must meet.

The names, types, value sets and limits below are fixed values of the data model.
"""

from __future__ import annotations

RAW_SCHEMAS = {
    "customers": """
        customer_id STRING, registration_date DATE, first_purchase_date DATE,
        segment STRING, city STRING, state STRING, city_tier INT, gender STRING,
        age_years INT, acquisition_channel STRING, product_category STRING,
        product_price_inr DOUBLE, warranty_months INT, amc_active INT,
        is_churned INT, churn_date DATE, observation_end_date DATE, duration_days INT
    """,
    "transactions": """
        transaction_id STRING, customer_id STRING, transaction_date DATE,
        transaction_type STRING, product_category STRING, amount_inr DOUBLE,
        channel STRING, is_returned INT
    """,
    "clickstream": """
        event_id STRING, customer_id STRING, event_timestamp BIGINT, event_type STRING,
        session_duration_s INT, pages_in_session INT, device_type STRING, utm_source STRING
    """,
    "support_tickets": """
        ticket_id STRING, customer_id STRING, ticket_date DATE, category STRING,
        resolution_days INT, is_escalated INT, is_resolved INT,
        customer_satisfied INT, channel STRING
    """,
}

SCORE_COLUMNS = [
    "customer_id",
    "score_date",
    "survival_prob_30d",
    "survival_prob_60d",
    "survival_prob_90d",
    "survival_prob_180d",
    "median_survival_days",
    "churn_risk_segment",
    "partial_hazard",
]

# (column, type, nullable, unique, checks); a check is (kind, argument)
FLAG = [("isin", (0, 1))]
COLUMN_RULES = {
    "customers": [
        ("customer_id", "string", False, True, []),
        ("registration_date", "date", False, False, [("ge", "2022-01-01")]),
        ("first_purchase_date", "date", False, False, []),
        ("segment", "string", False, False,
         [("isin", ("student", "gamer", "professional", "smb", "creative"))]),
        ("city", "string", False, False, []),
        ("state", "string", False, False, []),
        ("city_tier", "int", False, False, [("isin", (1, 2, 3))]),
        ("gender", "string", False, False, [("isin", ("M", "F", "Other"))]),
        ("age_years", "int", True, False, [("ge", 18), ("le", 80)]),
        ("acquisition_channel", "string", False, False, []),
        ("product_category", "string", False, False,
         [("isin", ("budget_pc", "mid_range_pc", "gaming_pc", "workstation"))]),
        ("product_price_inr", "double", False, False, [("gt", 0)]),
        ("warranty_months", "int", False, False, [("isin", (12, 24))]),
        ("amc_active", "int", False, False, FLAG),
        ("is_churned", "int", False, False, FLAG),
        ("duration_days", "int", False, False, [("gt", 0)]),
    ],
    "transactions": [
        ("transaction_id", "string", False, True, []),
        ("customer_id", "string", False, False, []),
        ("transaction_date", "date", False, False, []),
        ("transaction_type", "string", False, False, []),
        ("amount_inr", "double", False, False, [("gt", 0)]),
        ("is_returned", "int", False, False, FLAG),
    ],
    "clickstream": [
        ("event_id", "string", False, False, []),
        ("customer_id", "string", False, False, []),
        ("event_timestamp", "timestamp", False, False, []),
        ("event_type", "string", False, False, []),
        ("session_duration_s", "int", False, False, [("ge", 0)]),
        ("pages_in_session", "int", False, False, [("gt", 0)]),
    ],
    "support_tickets": [
        ("ticket_id", "string", False, False, []),
        ("customer_id", "string", False, False, []),
        ("ticket_date", "date", False, False, []),
        ("resolution_days", "int", False, False, [("ge", 0)]),
        ("is_escalated", "int", False, False, FLAG),
        ("is_resolved", "int", False, False, FLAG),
    ],
}

MIN_ROWS = {
    "customers": 40_000,
    "transactions": 100_000,
    "clickstream": 400_000,
    "support_tickets": 50_000,
}

# Covariates of the proportional-hazards model.
COX_NUMERIC = [
    "tenure_days", "product_price_inr", "warranty_months", "amc_active",
    "total_transactions", "total_spend_inr", "days_since_last_transaction",
    "avg_transaction_value_inr", "tx_count_30d", "tx_count_90d", "tx_amount_30d",
    "tx_amount_90d", "avg_weekly_sessions_30d", "avg_weekly_sessions_90d",
    "avg_session_dur_s_90d", "product_comparison_events_30d",
    "days_since_last_web_visit", "session_frequency_trend_90d",
    "total_support_tickets", "support_tickets_30d", "support_tickets_90d",
    "avg_resolution_days", "escalation_rate", "days_since_last_support_contact",
    "rfm_score", "engagement_score", "warranty_remaining_days", "is_warranty_expired",
]
COX_CATEGORICAL = ["segment", "city_tier", "product_category", "acquisition_channel"]

# Covariates of the accelerated-failure-time models.
AFT_COVARIATES = [
    "tenure_days", "product_price_inr", "warranty_months", "amc_active",
    "total_transactions", "days_since_last_transaction", "avg_transaction_value_inr",
    "tx_count_30d", "tx_count_90d", "tx_amount_90d", "avg_weekly_sessions_90d",
    "days_since_last_web_visit", "session_frequency_trend_90d", "total_support_tickets",
    "escalation_rate", "rfm_score", "engagement_score", "is_warranty_expired",
]

# Features watched for drift.
DRIFT_NUMERIC = [
    "days_since_last_transaction", "total_transactions", "avg_weekly_sessions_90d",
    "session_frequency_trend_90d", "total_support_tickets", "engagement_score",
    "rfm_score", "product_price_inr", "days_since_last_web_visit",
]
DRIFT_CATEGORICAL = ["segment", "city_tier", "product_category", "acquisition_channel"]

HORIZONS = (30, 60, 90, 180)

# Columns of the feature matrix by kind.
FEATURE_CATALOGUE = {
    "static": [
        "customer_id", "segment", "city_tier", "gender", "age_years", "acquisition_channel",
        "product_category", "product_price_inr", "warranty_months", "amc_active",
        "first_purchase_date", "observation_end_date", "is_churned", "duration_days",
    ],
    "lifecycle": [
        "tenure_days", "warranty_expiry_date", "warranty_remaining_days", "is_warranty_expired",
    ],
    "rfm": [
        "total_transactions", "total_spend_inr", "avg_transaction_value_inr",
        "days_since_last_transaction", "months_since_last_transaction",
    ],
    "windowed": [f"tx_{kind}_{n}d" for n in (30, 60, 90, 180) for kind in ("count", "amount")],
    "behavioural": [
        f"{name}_{n}d"
        for n in (30, 90)
        for name in (
            "active_days", "total_events", "avg_session_dur_s", "avg_pages",
            "product_comparison_events", "wishlist_add_events", "avg_weekly_sessions",
        )
    ] + ["days_since_last_web_visit"],
    "trend": ["session_frequency_trend_90d"],
    "support": [
        "total_support_tickets", "avg_resolution_days", "escalation_rate", "avg_satisfaction",
        "days_since_last_support_contact", "support_tickets_30d", "support_tickets_90d",
    ],
    "derived": [
        "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score", "rfm_score",
        "engagement_score",
    ],
}
