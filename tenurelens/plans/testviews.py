"""The four customer tables as views on the given star-schema tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"
SPLIT = "1996-01-01"
CHURN_SILENCE_DAYS = 270
EVENT_SHIFT_DAYS = 8218


@dataclass
class Views:
    customers: DataFrame
    transactions: DataFrame
    clickstream: DataFrame
    support_tickets: DataFrame


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.col("o_totalprice").alias("amount_inr"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_returned"),
    )


def clickstream(spark: SparkSession, root: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, root, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        (F.col("ts") - F.expr(f"INTERVAL '{EVENT_SHIFT_DAYS}' DAY")).alias("event_timestamp"),
        F.when(kind == "view", "product_comparison")
        .when(kind == "signup", "wishlist_add")
        .otherwise(kind)
        .alias("event_type"),
        F.floor("value").cast("int").alias("session_duration_s"),
        (1 + F.get_json_object("props", "$.k").cast("int") % 5).alias("pages_in_session"),
    )


def support_tickets(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").where(F.col("l_returnflag") == "R")
    owners = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("ticket_date"),
        F.col("l_quantity").cast("int").alias("resolution_days"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_escalated"),
        F.lit(1).alias("is_resolved"),
        (F.col("l_discount") <= 0.05).cast("int").alias("customer_satisfied"),
    )


def customers(spark: SparkSession, root: str, keep_without_orders: bool = False) -> DataFrame:
    """Customer attributes with the first and last order folded in by one aggregate."""
    placed = F.col("o_orderdate").cast("date")
    spans = (
        table(spark, root, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.min(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice",
                           "o_orderstatus")).alias("first"),
            F.max(placed).alias("last_date"),
        )
        .select(
            "customer_id",
            F.col("first.o_orderdate").cast("date").alias("first_purchase_date"),
            F.col("first.o_orderpriority").alias("product_category"),
            F.col("first.o_totalprice").alias("product_price_inr"),
            F.col("first.o_orderstatus").alias("acquisition_channel"),
            "last_date",
        )
    )
    people = table(spark, root, "customer").join(
        table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    as_of = F.lit(AS_OF).cast("date")
    churned = F.col("last_date") <= F.date_sub(as_of, CHURN_SILENCE_DAYS)
    lived = F.when(churned, F.datediff("last_date", "first_purchase_date")).otherwise(
        F.datediff(as_of, F.col("first_purchase_date"))
    )
    return people.join(
        spans, key == F.col("customer_id"), "left" if keep_without_orders else "inner"
    ).select(
        key.alias("customer_id"),
        F.col("first_purchase_date").alias("registration_date"),
        "first_purchase_date",
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").cast("string").alias("state"),
        (F.col("n_regionkey") + 1).alias("city_tier"),
        F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").otherwise("Other").alias("gender"),
        F.when(F.col("c_acctbal") >= 0, (18 + key % 60).cast("int")).alias("age_years"),
        "acquisition_channel",
        "product_category",
        "product_price_inr",
        F.when(key % 2 == 0, 12).otherwise(24).alias("warranty_months"),
        (key % 3 == 0).cast("int").alias("amc_active"),
        churned.cast("int").alias("is_churned"),
        F.when(churned, F.col("last_date")).alias("churn_date"),
        as_of.alias("observation_end_date"),
        F.when(lived.isNotNull(), F.greatest(F.lit(1), lived)).alias("duration_days"),
    )


def views(spark: SparkSession, root: str, keep_without_orders: bool = False) -> Views:
    return Views(
        customers(spark, root, keep_without_orders),
        transactions(spark, root),
        clickstream(spark, root),
        support_tickets(spark, root),
    )
