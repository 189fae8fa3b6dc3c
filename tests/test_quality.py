import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenurelens.operators import quality as Q

DDL = (
    "customer_id string, registration_date date, first_purchase_date date, segment string, city string, "
    "state string, city_tier int, gender string, age_years int, acquisition_channel string, "
    "product_category string, product_price_inr double, warranty_months int, amc_active int, "
    "is_churned int, duration_days int"
)


def people(spark, n=20, **changes):
    day = dt.date(2023, 1, 1)
    rows = [
        (f"c{i}", day, day, "gamer", "x", "y", 1, "M", 40, "web", "workstation", 10.0, 12, 1, int(i % 4 == 0), 5)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, DDL)
    for name, value in changes.items():
        df = df.withColumn(name, F.expr(value) if isinstance(value, str) else value)
    return df


def failed(report):
    return {(r["check"], r["column"]): r["severity"] for r in report.where("NOT passed").collect()}


def test_clean_customers_pass(spark):
    report = Q.validate(people(spark), "customers", min_rows=10)
    assert failed(report) == {}
    assert Q.passed_summary(report).first()["passed"]


@pytest.mark.parametrize("change, expected", [
    ({"duration_days": "0"}, {("gt", "duration_days"), ("non_positive", "duration_days")}),
    ({"segment": "'astronaut'"}, {("isin", "segment")}),
    ({"customer_id": "'same'"}, {("unique", "customer_id")}),
    ({"age_years": "12"}, {("ge", "age_years")}),
    ({"city": "cast(null AS string)"}, {("not_null", "city"), ("null_pct", "city")}),
    ({"amc_active": "'maybe'"}, {("type_int", "amc_active")}),
    ({"registration_date": "DATE '2021-12-31'"}, {("ge", "registration_date")}),
])
def test_each_bad_column_is_reported(spark, change, expected):
    assert set(failed(Q.validate(people(spark, **change), "customers", min_rows=1))) == expected


def test_rows_and_churn_rate(spark):
    report = failed(Q.validate(people(spark, is_churned=F.lit(0)), "customers"))
    assert report == {("min_rows", None): "error", ("churn_rate", "is_churned"): "warning"}


def test_null_share_is_a_warning(spark):
    aged = people(spark, age_years=F.when(F.col("customer_id").isin("c1", "c2"), None).otherwise(30))
    report = Q.validate(aged, "customers", min_rows=1)
    assert failed(report) == {("null_pct", "age_years"): "warning"}
    assert report.where("check = 'null_pct' AND column = 'age_years'").first()["value"] == 10.0


def orders(spark, customer="c1", amount=5.0, n=10):
    return spark.createDataFrame(
        [(f"t{i}", customer, dt.date(2024, 1, 1), "sale", amount, 0) for i in range(n)],
        "transaction_id string, customer_id string, transaction_date date, transaction_type string, "
        "amount_inr double, is_returned int",
    )


def test_orphans(spark):
    everyone = people(spark)
    assert failed(Q.validate(orders(spark), "transactions", everyone, 1)) == {}
    bad = Q.validate(orders(spark, "ghost"), "transactions", everyone, 1)
    assert failed(bad) == {("orphan_pct", "customer_id"): "error"}
    assert [r[0] for r in Q.orphans(orders(spark, "ghost"), everyone).collect()] == ["ghost"]
    few = people(spark, 200).select("customer_id").withColumn("customer_id", F.regexp_replace("customer_id", "^c7$", "ghost"))
    row = Q.orphan_check(few, people(spark, 200), "x").first()
    assert (row["severity"], row["passed"], row["value"]) == ("warning", False, 0.5)


def test_validate_all_raises_with_the_failing_tables(spark):
    least = {"customers": 1, "transactions": 1}
    good = {"customers": people(spark), "transactions": orders(spark)}
    assert Q.validate_all(good, min_rows=least).where("NOT passed").count() == 0
    bad = {"customers": people(spark), "transactions": orders(spark, amount=-100.0)}
    with pytest.raises(Q.DataValidationError, match="transactions"):
        Q.validate_all(bad, min_rows=least)
    report = Q.validate_all(bad, raise_on_failure=False, min_rows=least)
    assert ("non_positive", "amount_inr") in failed(report)


def test_unknown_table_and_empty_table(spark):
    assert failed(Q.validate(spark.range(3), "mystery")) == {("schema_known", None): "warning"}
    empty = Q.validate(people(spark).limit(0), "customers", min_rows=0)
    assert ("not_null", "city") not in failed(empty)
    nothing = Q.orphan_summary(orders(spark).limit(0), people(spark)).first()
    assert nothing["orphan_pct"] is None


def test_missing_column(spark):
    assert ("column_present", "city") in failed(Q.validate(people(spark).drop("city"), "customers", min_rows=1))


def test_quarantine_names_the_rules(spark):
    df = people(spark, segment=F.when(F.col("customer_id") == "c3", "x").otherwise("smb"))
    rows = Q.quarantine(df, "customers").collect()
    assert [(r["customer_id"], r["violations"]) for r in rows] == [("c3", ["segment:isin"])]


def test_volume_change(spark):
    df = spark.sql(
        "SELECT date_add(DATE '2024-01-01', d) AS day FROM VALUES (0, 10), (1, 11), (2, 20) AS v(d, n) "
        "LATERAL VIEW explode(sequence(1, n)) e AS k"
    )
    got = Q.volume_change(df, "day").orderBy("day").collect()
    assert [(r["n"], r["alert"]) for r in got] == [(10, False), (11, False), (20, True)]


def test_duplicates_are_rows_beyond_the_first(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "k string")
    assert Q.unique_check(df, "t", "k").first()["value"] == 2
