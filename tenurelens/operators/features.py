"""Point-in-time feature blocks and the feature matrix (one row per customer).

Each event table is read once and aggregated once per key: every trailing window is a
condition inside the aggregate, not a scan of its own. All aggregates combine before the
shuffle, so one very active customer does not make a hot task. A trailing window of N days
is closed on both ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from tenurelens.functions import scalars as S
from tenurelens.sources.schemas import FEATURE_CATALOGUE

TX_WINDOWS = (30, 60, 90, 180)
WEB_WINDOWS = (30, 90)
SUPPORT_WINDOWS = (30, 90)

STATIC_COLUMNS = FEATURE_CATALOGUE["static"]


def in_window(d: Column, as_of: str, days: int) -> Column:
    return d >= F.date_sub(S.day(as_of), days)


def static_features(customers: DataFrame, as_of: str, cut_customers: bool = False) -> DataFrame:
    base = customers.select(*STATIC_COLUMNS)
    if cut_customers:
        base = base.where(F.col("first_purchase_date") <= S.day(as_of))
    expiry = S.warranty_expiry(F.col("first_purchase_date"), F.col("warranty_months"))
    return base.select(
        "*",
        S.days_since(as_of, F.col("first_purchase_date")).alias("tenure_days"),
        expiry.alias("warranty_expiry_date"),
        F.datediff(expiry, S.day(as_of)).alias("warranty_remaining_days"),
        (F.datediff(expiry, S.day(as_of)) < 0).cast("int").alias("is_warranty_expired"),
    )


def rfm_aggregates(as_of: str) -> list[Column]:
    recency = S.days_since(as_of, F.max("transaction_date"))
    return [
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount_inr").alias("total_spend_inr"),
        F.avg("amount_inr").alias("avg_transaction_value_inr"),
        recency.alias("days_since_last_transaction"),
        (recency / 30.44).cast("double").alias("months_since_last_transaction"),
    ]


def tx_window_aggregates(as_of: str, windows=TX_WINDOWS) -> list[Column]:
    out = []
    for n in windows:
        inside = in_window(F.col("transaction_date"), as_of, n)
        out.append(F.count_if(inside).alias(f"tx_count_{n}d"))
        out.append(F.sum(F.when(inside, F.col("amount_inr"))).alias(f"tx_amount_{n}d"))
    return out


def known_transactions(transactions: DataFrame, as_of: str) -> DataFrame:
    return transactions.where(F.col("transaction_date") <= S.day(as_of))


def rfm_features(transactions: DataFrame, as_of: str) -> DataFrame:
    """Lifetime recency, frequency and monetary value."""
    return known_transactions(transactions, as_of).groupBy("customer_id").agg(*rfm_aggregates(as_of))


def windowed_transactions(transactions: DataFrame, as_of: str, windows=TX_WINDOWS) -> DataFrame:
    """Counts and amounts per trailing window, for customers active in the widest one."""
    recent = known_transactions(transactions, as_of).where(
        in_window(F.col("transaction_date"), as_of, max(windows))
    )
    return recent.groupBy("customer_id").agg(*tx_window_aggregates(as_of, windows))


def transaction_block(transactions: DataFrame, as_of: str, windows=TX_WINDOWS) -> DataFrame:
    """Both of the above in one pass."""
    return (
        known_transactions(transactions, as_of)
        .groupBy("customer_id")
        .agg(*rfm_aggregates(as_of), *tx_window_aggregates(as_of, windows))
    )


def web_days(clickstream: DataFrame, as_of: str) -> DataFrame:
    """One row per customer and active day; distinct days become plain counts after it."""
    when = F.col("event_timestamp").cast("date")
    return (
        clickstream.where(when <= S.day(as_of))
        .groupBy("customer_id", when.alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("session_duration_s").alias("dur_sum"),
            F.count("session_duration_s").alias("dur_n"),
            F.sum("pages_in_session").alias("pages_sum"),
            F.count("pages_in_session").alias("pages_n"),
            F.count_if(F.col("event_type") == "product_comparison").alias("comparisons"),
            F.count_if(F.col("event_type") == "wishlist_add").alias("wishlists"),
        )
    )


def web_window_aggregates(as_of: str, windows=WEB_WINDOWS) -> list[Column]:
    out = []
    for n in windows:
        inside = in_window(F.col("event_date"), as_of, n)

        def total(name: str) -> Column:
            return F.sum(F.when(inside, F.col(name)))

        active = F.count_if(inside)
        out += [
            active.alias(f"active_days_{n}d"),
            F.coalesce(total("events"), F.lit(0)).alias(f"total_events_{n}d"),
            F.try_divide(total("dur_sum"), total("dur_n")).alias(f"avg_session_dur_s_{n}d"),
            F.try_divide(total("pages_sum"), total("pages_n")).alias(f"avg_pages_{n}d"),
            F.coalesce(total("comparisons"), F.lit(0)).alias(f"product_comparison_events_{n}d"),
            F.coalesce(total("wishlists"), F.lit(0)).alias(f"wishlist_add_events_{n}d"),
            (active / F.lit(n / 7.0)).alias(f"avg_weekly_sessions_{n}d"),
        ]
    return out


def last_visit_aggregate(as_of: str) -> Column:
    return S.days_since(as_of, F.max("event_date")).alias("days_since_last_web_visit")


def trend_aggregates(
    as_of: str, early: tuple[int, int] = (90, 61), late: int = 30, per: float = 30.0
) -> list[Column]:
    d = F.col("event_date")
    is_early = d.between(F.date_sub(S.day(as_of), early[0]), F.date_sub(S.day(as_of), early[1]))
    is_late = in_window(d, as_of, late)
    slope = F.count_if(is_late) / F.lit(per) - F.count_if(is_early) / F.lit(per)
    seen = F.count_if(is_late | is_early) > 0
    return [F.when(seen, slope).alias("session_frequency_trend_90d")]


def behavior_features(clickstream: DataFrame, as_of: str, windows=WEB_WINDOWS) -> DataFrame:
    return (
        web_days(clickstream, as_of)
        .groupBy("customer_id")
        .agg(*web_window_aggregates(as_of, windows), last_visit_aggregate(as_of))
    )


def session_trend(
    clickstream: DataFrame, as_of: str, early: tuple[int, int] = (90, 61), late: int = 30,
    per: float = 30.0,
) -> DataFrame:
    """Late minus early active days per day, for customers with activity in either period."""
    return (
        web_days(clickstream, as_of)
        .where(in_window(F.col("event_date"), as_of, max(early[0], late)))
        .groupBy("customer_id")
        .agg(*trend_aggregates(as_of, early, late, per))
        .where(F.col("session_frequency_trend_90d").isNotNull())
    )


def last_visit(clickstream: DataFrame, as_of: str) -> DataFrame:
    when = F.col("event_timestamp").cast("date")
    return (
        clickstream.where(when <= S.day(as_of))
        .select("customer_id", when.alias("event_date"))
        .groupBy("customer_id")
        .agg(last_visit_aggregate(as_of))
    )


def web_block(clickstream: DataFrame, as_of: str, windows=WEB_WINDOWS) -> DataFrame:
    return (
        web_days(clickstream, as_of)
        .groupBy("customer_id")
        .agg(
            *web_window_aggregates(as_of, windows),
            last_visit_aggregate(as_of),
            *trend_aggregates(as_of),
        )
    )


def support_features(tickets: DataFrame, as_of: str, windows=SUPPORT_WINDOWS) -> DataFrame:
    d = F.col("ticket_date")
    return (
        tickets.where(d <= S.day(as_of))
        .groupBy("customer_id")
        .agg(
            F.count("ticket_id").alias("total_support_tickets"),
            F.avg("resolution_days").alias("avg_resolution_days"),
            F.avg("is_escalated").alias("escalation_rate"),
            F.avg("customer_satisfied").alias("avg_satisfaction"),
            S.days_since(as_of, F.max(d)).alias("days_since_last_support_contact"),
            *[
                F.count(F.when(in_window(d, as_of, n), F.col("ticket_id"))).alias(
                    f"support_tickets_{n}d"
                )
                for n in windows
            ],
        )
    )


def with_scores(df: DataFrame) -> DataFrame:
    """RFM scores (1-5 each, summed) and the engagement score."""
    r = S.recency_score(F.col("days_since_last_transaction"))
    f = S.frequency_score(F.col("total_transactions"))
    m = S.monetary_score(F.col("total_spend_inr"))
    return df.select(
        "*",
        r.alias("rfm_recency_score"),
        f.alias("rfm_frequency_score"),
        m.alias("rfm_monetary_score"),
        (r + f + m).alias("rfm_score"),
        S.engagement(
            F.col("avg_weekly_sessions_90d"),
            F.col("avg_satisfaction"),
            F.col("days_since_last_transaction"),
        ).alias("engagement_score"),
    )


UNFILLED = ("customer_id", "is_churned", "duration_days", "age_years")


def fill_missing(df: DataFrame, recency_fill: int = 0) -> DataFrame:
    """Numeric nulls become 0; recencies take `recency_fill`."""
    fill = {}
    for field in df.schema.fields:
        if field.name in UNFILLED:
            continue
        if isinstance(field.dataType, (DoubleType, IntegerType, LongType)):
            is_recency = "_since_last_" in field.name
            fill[field.name] = recency_fill if is_recency else 0
    return df.fillna(fill)


def feature_matrix(
    customers: DataFrame,
    transactions: DataFrame,
    clickstream: DataFrame,
    support_tickets: DataFrame,
    as_of: str,
    windows: dict[str, tuple[int, ...]] | None = None,
    fill: bool = True,
    recency_fill: int = 0,
    cut_customers: bool = False,
) -> DataFrame:
    """All blocks joined on the customer, derived scores added, nulls filled.

    Blocks are unique per customer before they are joined, so no join can be skewed.
    """
    w = windows or {}
    asked = {
        "transactions": w.get("transactions", TX_WINDOWS),
        "clickstream": w.get("clickstream", WEB_WINDOWS),
        "support": w.get("support", SUPPORT_WINDOWS),
    }
    # the engagement score is made of 90-day figures, whatever windows are asked for
    web_windows = tuple(dict.fromkeys((*asked["clickstream"], 90)))
    web = web_block(clickstream, as_of, web_windows)
    inner = [c for c in web.columns if 90 not in asked["clickstream"] and c.endswith("_90d")]
    df = (
        static_features(customers, as_of, cut_customers)
        .join(
            transaction_block(transactions, as_of, asked["transactions"]),
            on="customer_id", how="left",
        )
        .join(
            web,
            on="customer_id", how="left",
        )
        .join(
            support_features(support_tickets, as_of, asked["support"]),
            on="customer_id", how="left",
        )
    )
    df = with_scores(df).drop(*inner)
    return fill_missing(df, recency_fill) if fill else df


def missing_features(matrix: DataFrame) -> dict[str, list[str]]:
    """Catalogue columns a feature table lacks, by kind (empty when complete)."""
    absent = {
        kind: [c for c in columns if c not in matrix.columns]
        for kind, columns in FEATURE_CATALOGUE.items()
    }
    return {kind: columns for kind, columns in absent.items() if columns}
