"""Churn labels and counting-process rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.operators import features as X


def churn_label(
    unfilled: DataFrame,
    transaction_silence: int = 270,
    web_threshold: float = 0.5,
    support_silence: int = 180,
) -> DataFrame:
    """Churned when silent in purchases, web and support at once.

    Takes a feature matrix built with `fill=False`: a customer without any event of a kind
    counts as silent there.
    """
    silent_tx = F.coalesce(F.col("days_since_last_transaction") >= transaction_silence, F.lit(True))
    silent_web = F.coalesce(F.col("avg_weekly_sessions_90d"), F.lit(0.0)) <= web_threshold
    silent_support = F.coalesce(
        F.col("days_since_last_support_contact") >= support_silence, F.lit(True)
    )
    return unfilled.withColumn(
        "churn_label", (silent_tx & silent_web & silent_support).cast("int")
    )


def label_at(
    customers: DataFrame, transactions: DataFrame, clickstream: DataFrame,
    support_tickets: DataFrame, as_of: str, lag_days: int = 30, **rule,
) -> DataFrame:
    """Labels for `as_of`, judged `lag_days` later so that late records can still arrive."""
    judged = (dt.date.fromisoformat(as_of) + dt.timedelta(days=lag_days)).isoformat()
    matrix = X.feature_matrix(
        customers, transactions, clickstream, support_tickets, judged, fill=False
    )
    return churn_label(matrix, **rule)


def counting_process(
    subjects: DataFrame,
    changes: DataFrame,
    covariates: dict,
    id_col: str = "customer_id",
    day_col: str = "day",
    duration: str = "duration_days",
    event: str = "is_churned",
) -> DataFrame:
    """Rows (id, start, stop, event, covariates) over half-open intervals (start, stop].

    `subjects` has one row per id; `changes` has any number of rows per id with the day
    (since the id's origin) they took effect; `covariates` maps a column to an aggregate over
    the rows of one day. Changes are first reduced to one row per id and day, so an id has at
    most as many intervals as days followed. A covariate holds until its next change and is
    null before its first. The event sits on the last interval.
    """
    names = list(covariates)
    daily = changes.groupBy(id_col, F.col(day_col).cast("int").alias("start")).agg(
        *[agg.alias(name) for name, agg in covariates.items()]
    )
    followed = subjects.select(
        id_col, F.col(duration).cast("int").alias("_end"), F.col(event).cast("int").alias("_event")
    )
    known = daily.join(followed, on=id_col).where(
        (F.col("start") >= 0) & (F.col("start") < F.col("_end"))
    )
    origin = followed.where(F.col("_end") > 0).select(
        id_col,
        F.lit(0).alias("start"),
        *[F.lit(None).cast(daily.schema[n].dataType).alias(n) for n in names],
        "_end",
        "_event",
    )
    points = known.unionByName(origin).groupBy(id_col, "start").agg(
        *[F.max(n).alias(n) for n in names],
        F.max("_end").alias("_end"),
        F.max("_event").alias("_event"),
    )
    by_id = Window.partitionBy(id_col).orderBy("start")
    carried = by_id.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead("start").over(by_id)
    return points.select(
        id_col,
        "start",
        F.coalesce(following, F.col("_end")).alias("stop"),
        F.when(following.isNull(), F.col("_event")).otherwise(0).alias(event),
        *[F.last(n, ignorenulls=True).over(carried).alias(n) for n in names],
    )
