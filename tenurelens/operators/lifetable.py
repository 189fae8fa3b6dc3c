"""Kaplan-Meier curves and log-rank tests from life tables.

Rows are first reduced to one per stratum and distinct duration; everything after works on
that table with running sums, so no task ever sorts the raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenurelens.functions.tails import chi2_tail, normal_quantile
from tenurelens.operators.asof import asof_join
from tenurelens.operators.partials import SLOT_SCHEMA, collect_slots, pack_upper, slot_batch, unpack_upper
from tenurelens.operators.prefix import running_sums



def exits_by_time(df: DataFrame, duration: str, event: str, strata=()) -> DataFrame:
    known = df.where(F.col(duration).isNotNull())
    for s in strata:
        known = known.where(F.col(s).isNotNull())
    return known.groupBy(*strata, F.col(duration).alias("time")).agg(
        F.coalesce(F.sum(F.col(event).cast("bigint")), F.lit(0)).alias("events"),
        F.count(F.lit(1)).alias("exits"),
    )


def life_table(
    df: DataFrame, duration: str = "duration_days", event: str = "is_churned", strata=()
) -> DataFrame:
    """(strata, time, events, exits, at_risk), one row per distinct duration."""
    table = running_sums(
        exits_by_time(df, duration, event, strata),
        "time", {"_gone": "exits"}, tuple(strata), totals=True,
    )
    at_risk = F.col("_gone_total") - F.col("_gone") + F.col("exits")
    return table.withColumn("at_risk", at_risk).drop("_gone", "_gone_total")


def kaplan_meier(
    df: DataFrame,
    duration: str = "duration_days",
    event: str = "is_churned",
    strata=(),
    alpha: float | None = None,
) -> DataFrame:
    """Survival curve per stratum, starting with S = 1 at time 0.

    With `alpha`, adds Greenwood's variance and the log-log confidence band (null where
    S is 0).
    """
    strata = tuple(strata)
    table = life_table(df, duration, event, strata)
    d, n = F.col("events"), F.col("at_risk")
    survive = F.when(d < n, F.log1p(-d / n))
    spread = F.when(d < n, d / (n * (n - d)))
    sums = {"_log_s": "_step", "_seen": "exits"}
    table = table.withColumn("_step", survive)
    if alpha is not None:
        table = table.withColumn("_spread", spread)
        sums["greenwood"] = "_spread"
    curve = running_sums(table, "time", sums, strata)
    extra = ["greenwood"] if alpha is not None else []
    columns = ["time", "events", "exits", "at_risk", "survival", *extra]
    curve = curve.withColumn("survival", F.when(d == n, 0.0).otherwise(F.exp("_log_s")))
    row = F.struct(*columns)
    types = {f.name: f.dataType for f in curve.schema.fields}
    start = {"survival": F.lit(1.0), "at_risk": n}
    origin = F.struct(
        *[start.get(c, F.lit(0)).cast(types[c]).alias(c) for c in columns]
    )
    is_first = (F.col("_seen") == F.col("exits")) & (F.col("time") > 0)
    rows = F.when(is_first, F.array(origin, row)).otherwise(F.array(row))
    curve = curve.select(*strata, F.explode(rows).alias("_r")).select(*strata, "_r.*")
    if alpha is None:
        return curve
    z = normal_quantile(1.0 - alpha / 2.0)
    s = F.col("survival")
    inner = s.between(1e-300, 1.0 - 1e-15)
    reach = F.lit(z) * F.sqrt("greenwood") / F.ln(F.when(inner, s))

    def bound(sign: int) -> Column:
        edge = F.pow(s, F.exp(sign * reach))
        return F.when(s >= 1.0 - 1e-15, 1.0).when(inner, edge)

    return curve.select("*", bound(-1).alias("ci_lower"), bound(1).alias("ci_upper"))


def nearest_value(value: str, at: float, time: str = "time") -> Column:
    """Aggregate: the value at the time nearest to `at`; a tie goes to the later time."""
    return F.min_by(value, F.struct(F.abs(F.col(time) - F.lit(at)), -F.col(time)))


def step_value(value: str, at: float, time: str = "time") -> Column:
    """Aggregate: the value at the last time not after `at`."""
    return F.max_by(value, F.when(F.col(time) <= F.lit(at), F.col(time)))


def median_time(never: float | None = float("inf")) -> Column:
    """Aggregate: the smallest time with S <= 1/2."""
    first = F.min(F.when(F.col("survival") <= 0.5, F.col("time"))).cast("double")
    return first if never is None else F.coalesce(first, F.lit(float(never)))


def km_summary(
    curve: DataFrame, strata=(), horizons=(90, 180, 365), how: str = "nearest",
    never: float | None = float("inf"),
) -> DataFrame:
    pick = nearest_value if how == "nearest" else step_value
    return curve.groupBy(*strata).agg(
        median_time(never).alias("median_survival_days"),
        *[pick("survival", h).alias(f"survival_prob_{h}d") for h in horizons],
    )


def group_labels(df: DataFrame, group: str) -> list:
    """One value per group: the test's covariance is a groups x groups matrix on the driver."""
    return sorted(r[0] for r in df.select(group).where(F.col(group).isNotNull()).distinct().collect())


def logrank_groups(
    df: DataFrame, group: str, duration: str = "duration_days", event: str = "is_churned"
) -> DataFrame:
    """Observed and expected events per group, for any number of groups.

    Expected events of a group are the sum, over its members, of the pooled cumulative hazard
    at the end of their time, so groups stay rows and no column per group is needed.
    """
    known = df.where(F.col(group).isNotNull() & F.col(duration).isNotNull())
    cells = known.groupBy(F.col(group).cast("string").alias(group), F.col(duration).alias("time")).agg(
        F.count_if(F.col(event) == 1).alias("d"), F.count(F.lit(1)).alias("x")
    )
    pooled = cells.groupBy("time").agg(F.sum("d").alias("d"), F.sum("x").alias("x"))
    at_risk = running_sums(pooled, "time", {"n": "x"}, descending=True)
    steps = at_risk.select("time", (F.col("d") / F.col("n")).alias("h"))
    hazard = running_sums(steps, "time", {"cum": "h"}).select("time", "cum")
    return cells.join(hazard, on="time").groupBy(group).agg(
        F.sum("d").alias("observed"), F.sum(F.col("x") * F.col("cum")).alias("expected")
    )


@dataclass
class LogRank:
    groups: list
    observed: np.ndarray
    expected: np.ndarray
    covariance: np.ndarray
    statistic: float
    degrees: int
    p_value: float

    @property
    def significant_at_05(self) -> bool:
        return self.p_value < 0.05


class Exits(NamedTuple):
    """Events and exits per (time, group number) in ranges of time, and those at risk after each range."""

    cells: DataFrame
    after: dict[int, np.ndarray]


def _exits_in_order(df: DataFrame, group: str, labels: list, duration: str, event: str) -> Exits:
    """One row per time and group, sorted by time in ranges; a time lies in one range."""
    spark, k = df.sparkSession, len(labels)
    numbers = spark.createDataFrame(list(enumerate(labels)), f"_k int, _label {df.schema[group].dataType.simpleString()}")
    known = df.where(F.col(group).isNotNull() & F.col(duration).isNotNull())
    cells = known.groupBy(F.col(group).alias("_label"), F.col(duration).cast("double").alias("t")).agg(
        F.count_if(F.col(event) == 1).cast("double").alias("d"), F.count(F.lit(1)).cast("double").alias("x")
    )
    ordered = (
        cells.join(numbers, "_label").select("t", "_k", "d", "x")
        .repartitionByRange("t").sortWithinPartitions("t").withColumn("part", F.spark_partition_id()).persist()
    )
    sums: dict[int, np.ndarray] = {}
    for part, number, x in ordered.groupBy("part", "_k").agg(F.sum("x")).toLocalIterator():
        sums.setdefault(part, np.zeros(k))[number] = x
    carry, after = np.zeros(k), {}
    for part in sorted(sums, reverse=True):
        after[part], carry = carry, carry + sums[part]
    return Exits(ordered, after)


def _logrank_sums(batches, after, k: int, times: int):
    """Observed, expected and upper covariance of a range, some times at once from its end."""
    parts = [np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("t", "_k", "d", "x", "part")]) for b in batches]
    total = np.zeros(2 * k + k * (k + 1) // 2)
    rows = np.concatenate(parts) if parts else np.empty((0, 5))
    if len(rows):
        at_risk = after.value[int(rows[0, 4])].copy()
        distinct, place = np.unique(rows[:, 0], return_inverse=True)
        number = rows[:, 1].astype(int)
        v = np.zeros((k, k))
        for end in range(len(distinct), 0, -times):
            begin = max(0, end - times)
            on = slice(*np.searchsorted(place, [begin, end]))
            d, n = np.zeros((end - begin, k)), np.zeros((end - begin, k))
            np.add.at(d, (place[on] - begin, number[on]), rows[on, 2])
            np.add.at(n, (place[on] - begin, number[on]), rows[on, 3])
            n = np.cumsum(n[::-1], axis=0)[::-1] + at_risk
            at_risk = n[0]
            dead, all_ = d.sum(1), n.sum(1)
            share = n / all_[:, None]
            spread = np.where(all_ > 1, dead * (all_ - dead) / np.maximum(all_ - 1, 1), 0.0)
            v += np.diag(spread @ share) - (share * spread[:, None]).T @ share
            total[:k] += d.sum(0)
            total[k : 2 * k] += dead @ share
        total[2 * k :] = pack_upper(v)
    return total


def logrank_test(
    df: DataFrame, group: str, duration: str = "duration_days", event: str = "is_churned", times: int = 256
) -> LogRank:
    """Log-rank test over all groups (two or more).

    Groups stay rows, so the plan is the same for any number of them. Rows are sorted into ranges
    of time once; each range is told how many of every group are at risk after it and adds up its
    share of the covariance, `times` times at once. The covariance is a groups x groups matrix
    in each task and on the driver; nothing else grows with the groups there.
    """
    labels = group_labels(df, group)
    k = len(labels)
    if k < 2:
        raise ValueError(f"{group} needs at least two groups")
    cells, after = _exits_in_order(df, group, labels, duration, event)
    sent = df.sparkSession.sparkContext.broadcast(after)
    size = 2 * k + k * (k + 1) // 2

    def sums(batches):
        yield slot_batch(_logrank_sums(batches, sent, k, times))

    try:
        slots = collect_slots(cells.mapInArrow(sums, SLOT_SCHEMA), size)
    finally:
        cells.unpersist()
        sent.destroy()
    observed, expected = slots[:k], slots[k : 2 * k]
    cov = unpack_upper(slots[2 * k :], k)
    diff, inner = (observed - expected)[:-1], cov[:-1, :-1]
    try:
        root = np.linalg.cholesky(inner)
        full = root.diagonal().min() > 1e-6 * root.diagonal().max()
    except np.linalg.LinAlgError:
        full = False
    if full:
        stat = float((np.linalg.solve(root, diff) ** 2).sum())
    else:
        # groups that are never at risk together with another leave the matrix without full rank
        stat = float(diff @ np.linalg.pinv(inner, hermitian=True) @ diff)
    return LogRank(labels, observed, expected, cov, stat, k - 1, chi2_tail(stat, k - 1))


def survival_at(
    df: DataFrame, curve: DataFrame, time: str, strata: tuple[str, ...] | list[str] = (), how: str = "step",
    value: str = "survival", out: str | None = None,
) -> DataFrame:
    """The rows with the curve's value at each row's own time, from the curve of their stratum.

    `step` takes the last time not after it, `nearest` the nearest one (of two the later). Null
    where the time is null, before the curve or of a stratum without one.
    """
    found = asof_join(df, curve, time, "time", [value], strata, "backward" if how == "step" else "nearest", prefix="_at_")
    return found.withColumnRenamed(f"_at_{value}", out or value)


def logrank_report(df: DataFrame, group: str, **columns) -> DataFrame:
    t = logrank_test(df, group, **columns)
    name = f"{t.groups[0]}_vs_{t.groups[1]}" if len(t.groups) == 2 else "multivariate"
    return df.sparkSession.createDataFrame(
        [(name, t.statistic, t.degrees, t.p_value, t.significant_at_05)],
        "test string, test_statistic double, degrees int, p_value double, significant_at_05 boolean",
    )
