import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenurelens.operators import features as X
from tenurelens.operators import labels
from tenurelens.sources.schemas import FEATURE_CATALOGUE

AS_OF = "2024-06-30"
D = dt.date.fromisoformat


def days_before(n):
    return D(AS_OF) - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def raw(spark):
    people = spark.createDataFrame(
        [
            (c, "gamer", 1, "M", None if c == "c" else 30, "web", "gaming_pc", 1000.0, 12, 1,
             D("2023-06-30"), D(AS_OF), 0, 366)
            for c in "abc"
        ],
        "customer_id string, segment string, city_tier int, gender string, age_years int, "
        "acquisition_channel string, product_category string, product_price_inr double, "
        "warranty_months int, amc_active int, first_purchase_date date, observation_end_date date, "
        "is_churned int, duration_days int",
    )
    tx = spark.createDataFrame(
        [
            ("t1", "a", days_before(30), 100.0),
            ("t2", "a", days_before(31), 50.0),
            ("t3", "a", days_before(-1), 999.0),
            ("t4", "b", days_before(200), 40_000.0),
        ],
        "transaction_id string, customer_id string, transaction_date date, amount_inr double",
    )
    at = lambda n, h: dt.datetime.combine(days_before(n), dt.time(h))
    web = spark.createDataFrame(
        [
            ("e1", "a", at(5, 1), "product_comparison", 10, 2),
            ("e2", "a", at(5, 23), "view", 30, 4),
            ("e3", "a", at(0, 23), "wishlist_add", 20, 1),
            ("e4", "a", at(75, 3), "view", 8, 1),
            ("e5", "b", at(45, 3), "view", 8, 1),
            ("e6", "a", at(-1, 0), "view", 8, 1),
        ],
        "event_id string, customer_id string, event_timestamp timestamp, event_type string, "
        "session_duration_s int, pages_in_session int",
    )
    tickets = spark.createDataFrame(
        [("s1", "a", days_before(90), 4, 1, 1), ("s2", "a", days_before(10), 2, 0, None)],
        "ticket_id string, customer_id string, ticket_date date, resolution_days int, "
        "is_escalated int, customer_satisfied int",
    )
    return people, tx, web, tickets


@pytest.fixture(scope="module")
def rows(raw):
    return {r["customer_id"]: r for r in X.feature_matrix(*raw, AS_OF).collect()}


def test_windows_are_closed_on_both_ends(rows):
    a = rows["a"]
    assert (a["tx_count_30d"], a["tx_count_60d"], a["total_transactions"]) == (1, 2, 2)
    assert a["tx_amount_30d"] == 100.0 and a["total_spend_inr"] == 150.0
    assert a["days_since_last_transaction"] == 30
    assert a["support_tickets_90d"] == 2 and a["support_tickets_30d"] == 1


def test_web_block(rows):
    a = rows["a"]
    assert (a["active_days_30d"], a["total_events_30d"], a["active_days_90d"]) == (2, 3, 3)
    assert a["avg_session_dur_s_30d"] == 20.0
    assert a["product_comparison_events_30d"] == 1 and a["wishlist_add_events_90d"] == 1
    assert a["avg_weekly_sessions_30d"] == pytest.approx(2 / (30 / 7))
    assert a["days_since_last_web_visit"] == 0
    assert a["session_frequency_trend_90d"] == pytest.approx(2 / 30 - 1 / 30)
    assert rows["b"]["session_frequency_trend_90d"] == 0.0


def test_missing_events_fill_with_zero_but_age_stays_null(rows):
    c = rows["c"]
    assert c["total_transactions"] == 0 and c["days_since_last_transaction"] == 0
    assert c["avg_satisfaction"] == 0.0 and c["age_years"] is None
    assert c["rfm_score"] == 3
    assert c["engagement_score"] == pytest.approx(0.3 * 0.5)


def test_scores(rows):
    a, b = rows["a"], rows["b"]
    assert (a["rfm_recency_score"], a["rfm_frequency_score"], a["rfm_monetary_score"]) == (5, 2, 1)
    assert (b["rfm_recency_score"], b["rfm_monetary_score"]) == (2, 2)
    assert 0 <= a["engagement_score"] <= 1


def test_matrix_has_the_59_catalogue_columns(raw):
    matrix = X.feature_matrix(*raw, AS_OF)
    assert len(matrix.columns) == 59
    assert set(matrix.columns) == {c for columns in FEATURE_CATALOGUE.values() for c in columns}
    assert X.missing_features(matrix) == {}
    assert X.missing_features(matrix.drop("rfm_score")) == {"derived": ["rfm_score"]}


def test_warranty(rows):
    a = rows["a"]
    assert a["tenure_days"] == 366
    assert a["warranty_remaining_days"] == 360 - 366 and a["is_warranty_expired"] == 1


def test_custom_windows_and_customer_cut(raw):
    people, tx, web, tickets = raw
    w = X.feature_matrix(people, tx, web, tickets, AS_OF, windows={"transactions": (7, 365)})
    assert "tx_count_365d" in w.columns and "tx_count_30d" not in w.columns
    assert X.static_features(people, "2020-01-01", cut_customers=True).count() == 0


def test_churn_label_counts_absence_as_silence(raw):
    got = labels.churn_label(X.feature_matrix(*raw, AS_OF, fill=False))
    label = {r["customer_id"]: r["churn_label"] for r in got.collect()}
    assert label == {"a": 0, "b": 0, "c": 1}
    later = labels.label_at(*raw, AS_OF, lag_days=100)
    assert {r["customer_id"]: r["churn_label"] for r in later.collect()}["b"] == 1


def test_counting_process(spark):
    subjects = spark.createDataFrame(
        [(1, 270, 1), (2, 50, 0)], "customer_id int, duration_days int, is_churned int"
    )
    changes = spark.createDataFrame(
        [(1, 90, 5.0), (1, 90, 7.0), (1, 180, 1.0), (1, 300, 9.0), (2, 0, 2.0)],
        "customer_id int, day int, x double",
    )
    got = labels.counting_process(subjects, changes, {"x": F.max("x")}).orderBy("customer_id", "start")
    assert [tuple(r) for r in got.collect()] == [
        (1, 0, 90, 0, None), (1, 90, 180, 0, 7.0), (1, 180, 270, 1, 1.0), (2, 0, 50, 0, 2.0),
    ]


def test_own_windows_keep_the_score(raw):
    own = X.feature_matrix(*raw, AS_OF, windows={"clickstream": (7, 30)})
    assert "engagement_score" in own.columns and "avg_weekly_sessions_90d" not in own.columns
    assert own.count() == 3
