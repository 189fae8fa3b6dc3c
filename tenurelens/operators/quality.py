"""Validation of the raw tables: declarative column rules, null audit, volume, keys.

All row rules, null shares and counters of a table are conditions inside one aggregate, so a
table is scanned once for them; uniqueness and referential integrity need one shuffle each.
Every report has the columns (dataset, check, column, value, threshold, severity, passed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tenurelens.sources.schemas import COLUMN_RULES, MIN_ROWS

NULL_LIMIT = 5.0
ORPHAN_LIMIT = 1.0
CHURN_RANGE = (0.10, 0.55)


class DataValidationError(RuntimeError):
    """Some table fails a hard check."""


def violation(kind: str, value: Column, argument) -> Column:
    """True where a non-null value breaks the check."""
    if kind == "isin":
        return ~value.isin(*argument)
    limit = F.lit(argument)
    bad = {"ge": value < limit, "le": value > limit, "gt": value <= limit}[kind]
    return F.coalesce(bad, F.lit(False))


def row_rules(df: DataFrame, rules) -> list[tuple[str, str, Column]]:
    """(check, column, broken?) for every rule that one row alone can break."""
    out = []
    for name, dtype, nullable, _, checks in rules:
        if name not in df.columns:
            continue
        raw = F.col(name)
        same = df.schema[name].dataType.simpleString() == dtype
        value = raw if same else raw.try_cast(dtype)
        if not same:
            out.append((f"type_{dtype}", name, raw.isNotNull() & value.isNull()))
        if not nullable:
            out.append(("not_null", name, raw.isNull()))
        for kind, argument in checks:
            broken = violation(kind, value, argument)
            out.append((kind, name, F.coalesce(broken, F.lit(False))))
    return out


def report_row(check, column, value, threshold, severity, passed) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        (value if isinstance(value, Column) else F.lit(value)).cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"),
        F.coalesce(passed if isinstance(passed, Column) else F.lit(passed), F.lit(False)).alias("passed"),
    )


def melt_report(one_row: DataFrame, dataset: str, rows: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*rows)).alias("_r")).select(
        F.lit(dataset).alias("dataset"), "_r.*"
    )


def null_percent(df: DataFrame, column: str) -> Column:
    """Aggregate: percentage of nulls, null for an empty table."""
    return F.try_divide(100.0 * F.count_if(F.col(column).isNull()), F.count(F.lit(1)))


def null_audit(df: DataFrame, dataset: str, limit: float = NULL_LIMIT) -> DataFrame:
    """One row per column with its null percentage."""
    summary = df.agg(*[F.round(null_percent(df, c), 2).alias(c) for c in df.columns])
    rows = [
        report_row("null_pct", c, F.col(c), limit, "warning", F.coalesce(F.col(c) <= limit, F.lit(True)))
        for c in df.columns
    ]
    return melt_report(summary, dataset, rows)


def scan_plan(df: DataFrame, dataset: str, min_rows: int, rules) -> tuple[list[Column], list[Column]]:
    """The aggregates of one scan, and the report rows made of them."""
    checks = row_rules(df, rules)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(broken).alias(f"_rule{k}") for k, (_, _, broken) in enumerate(checks)]
    aggs += [F.round(null_percent(df, c), 2).alias(f"_null{k}") for k, c in enumerate(df.columns)]
    rows = [report_row("min_rows", None, F.col("_n"), min_rows, "error", F.col("_n") >= min_rows)]
    rows += [
        report_row(check, name, F.col(f"_rule{k}"), 0, "error", F.col(f"_rule{k}") == 0)
        for k, (check, name, _) in enumerate(checks)
    ]
    rows += [
        report_row("null_pct", c, F.col(f"_null{k}"), NULL_LIMIT, "warning",
                   F.coalesce(F.col(f"_null{k}") <= NULL_LIMIT, F.lit(True)))
        for k, c in enumerate(df.columns)
    ]
    for name, *_ in rules:
        if name not in df.columns:
            rows.append(report_row("column_present", name, 0, 1, "error", False))
    if not rules:
        rows.append(report_row("schema_known", None, 0, 1, "warning", False))
    if dataset == "customers" and "is_churned" in df.columns:
        aggs.append(F.avg("is_churned").alias("_churn"))
        rows.append(report_row("churn_rate", "is_churned", F.col("_churn"), CHURN_RANGE[1], "warning",
                               F.col("_churn").between(*CHURN_RANGE)))
    counter = {"customers": "duration_days", "transactions": "amount_inr"}.get(dataset)
    if counter in df.columns:
        aggs.append(F.count_if(F.col(counter) <= 0).alias("_nonpositive"))
        rows.append(report_row("non_positive", counter, F.col("_nonpositive"), 0, "error", F.col("_nonpositive") == 0))
    return aggs, rows


def scan_checks(df: DataFrame, dataset: str, min_rows: int, rules) -> DataFrame:
    """Row rules, null shares, row count and dataset-specific counters in one aggregate."""
    aggs, rows = scan_plan(df, dataset, min_rows, rules)
    return melt_report(df.agg(*aggs), dataset, rows)


def write_checked(
    df: DataFrame, dataset: str, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = (),
    min_rows: int | None = None, rules=None, raise_on_failure: bool = False,
) -> DataFrame:
    """Write a table and return the report of `scan_checks` on what was written.

    The rules are observed metrics of the write itself, so the table is computed and read once.
    Uniqueness and orphans need a shuffle and are left to `validate`. With `raise_on_failure` a
    failed hard check raises after the write; the rows stay for inspection.
    """
    rules = COLUMN_RULES.get(dataset, []) if rules is None else rules
    least = MIN_ROWS.get(dataset, 0) if min_rows is None else min_rows
    aggs, rows = scan_plan(df, dataset, least, rules)
    kinds = df.limit(0).agg(*aggs).schema
    seen = Observation()
    writer = df.observe(seen, *aggs).write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    found = seen.get
    summary = df.sparkSession.createDataFrame([tuple(found.get(f.name) for f in kinds)], kinds)
    report = melt_report(summary, dataset, rows)
    if raise_on_failure and not report.where(~F.col("passed") & (F.col("severity") == "error")).isEmpty():
        raise DataValidationError(f"failed tables: {[dataset]}")
    return report


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_check(df: DataFrame, dataset: str, key: str) -> DataFrame:
    """Rows too many: those beyond the first one of each key."""
    extra = duplicate_keys(df.where(F.col(key).isNotNull()), key).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("_n"))
    return melt_report(extra, dataset, [report_row("unique", key, F.col("_n"), 0, "error", F.col("_n") == 0)])


def orphans(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct child keys without a parent row."""
    keys = child.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(parent.select(key), on=key, how="left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """(orphan_ids, distinct_ids, orphan_pct); the percentage is null without any id."""
    known = parent.select(key, F.lit(True).alias("_known")).distinct()
    ids = child.select(key).where(F.col(key).isNotNull()).distinct().join(known, on=key, how="left")
    missing = F.count_if(F.col("_known").isNull())
    return ids.agg(
        missing.alias("orphan_ids"), F.count(F.lit(1)).alias("distinct_ids"),
        F.try_divide(100.0 * missing, F.count(F.lit(1))).alias("orphan_pct"),
    )


def orphan_check(child: DataFrame, parent: DataFrame, dataset: str, key: str = "customer_id") -> DataFrame:
    over = F.col("orphan_pct") > ORPHAN_LIMIT
    severity = F.when(over, "error").otherwise("warning")
    row = report_row("orphan_pct", key, F.col("orphan_pct"), ORPHAN_LIMIT, severity, F.col("orphan_ids") == 0)
    return melt_report(orphan_summary(child, parent, key), dataset, [row])


def validate(
    df: DataFrame, dataset: str, customers: DataFrame | None = None,
    min_rows: int | None = None, rules=None,
) -> DataFrame:
    """Every check of one table, failures and passes alike."""
    rules = COLUMN_RULES.get(dataset, []) if rules is None else rules
    least = MIN_ROWS.get(dataset, 0) if min_rows is None else min_rows
    parts = [scan_checks(df, dataset, least, rules)]
    parts += [unique_check(df, dataset, r[0]) for r in rules if r[3] and r[0] in df.columns]
    if dataset != "customers" and customers is not None and "customer_id" in df.columns:
        parts.append(orphan_check(df, customers, dataset))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def validate_all(
    datasets: dict[str, DataFrame], raise_on_failure: bool = True,
    min_rows: dict[str, int] | None = None, rules: dict | None = None,
) -> DataFrame:
    """Reports of all tables; raises when any table fails a hard check."""
    least, own = min_rows or {}, rules or {}
    report = None
    for name, df in datasets.items():
        part = validate(df, name, datasets.get("customers"), least.get(name), own.get(name))
        report = part if report is None else report.unionByName(part)
    if raise_on_failure:
        report = report.persist()
        failed = [
            r[0] for r in report.where(~F.col("passed") & (F.col("severity") == "error"))
            .select("dataset").distinct().orderBy("dataset").collect()
        ]
        report.unpersist()
        if failed:
            raise DataValidationError(f"failed tables: {failed}")
    return report


def passed_summary(report: DataFrame) -> DataFrame:
    """Per table: did it pass, and how many errors and warnings."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    return report.groupBy("dataset").agg(
        (errors == 0).alias("passed"), errors.alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    )


def quarantine(df: DataFrame, dataset: str, rules=None) -> DataFrame:
    """Rows that break a row rule, with the names of the rules they break."""
    rules = COLUMN_RULES.get(dataset, []) if rules is None else rules
    marks = [
        F.when(broken, F.lit(f"{name}:{check}")) for check, name, broken in row_rules(df, rules)
    ]
    broken = F.array_compact(F.array(*marks))
    return df.withColumn("violations", broken).where(F.size("violations") > 0)


def volume_change(df: DataFrame, date_col: str, limit: float = 0.20) -> DataFrame:
    """Rows per day against the previous day with rows; flags a change beyond the limit.

    One row per calendar day is left before the ordered window.
    """
    daily = (
        df.where(F.col(date_col).isNotNull())
        .groupBy(F.col(date_col).cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    previous = F.lag("n").over(Window.partitionBy(F.lit(0)).orderBy("day"))
    change = F.try_divide((F.col("n") - previous).cast("double"), previous)
    return daily.select("day", "n", previous.alias("previous_n"), change.alias("change")).withColumn(
        "alert", F.coalesce(F.abs("change") > limit, F.lit(False))
    )
