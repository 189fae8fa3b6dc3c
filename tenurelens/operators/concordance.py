"""Exact concordance of a risk score with censored durations, without forming pairs.

A pair (i, j) is comparable when i had the event and j was still followed: T_j > T_i, or
T_j = T_i with j censored. It counts 1 when i had the higher risk and 1/2 when the risks tie.

Points are first reduced to distinct (risk, time, event) with counts and then cut into a grid
at quantiles of risk and of time. A quantile mark is a cell line of its own, so a value shared
by any part of the rows sits alone in its line and needs no work inside it. Pairs fall apart:

* different time lines and different risk lines, or equal risk on a mark: from cell totals;
* same open time line: counted inside that line;
* same open risk line but different time lines: counted inside that risk line.

Each inside count is a sweep in O(m log m) over one line's points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.functions.scalars import count_below, count_below_in, double_array
from tenurelens.sources.tables import cut_lineage

POINTS_PER_LINE = 50_000


def earlier_smaller(order_key, y, value, weight, asked) -> int:
    """Sum over i of asked_i times the weight of points j with y_j > y_i, value_j < value_i.

    All arguments are arrays; `order_key` is value's dense rank.
    """
    idx = np.lexsort((-y,))
    rank = order_key[idx]
    total = 0
    for bit in range(max(1, int(order_key.max()).bit_length()) - 1, -1, -1):
        node = rank >> (bit + 1)
        high = (rank >> bit) & 1
        by_node = np.argsort(node, kind="stable")
        idx, rank, node, high = idx[by_node], rank[by_node], node[by_node], high[by_node]
        low_weight = np.where(high == 0, weight[idx], 0)
        before = np.concatenate([[0], np.cumsum(low_weight)[:-1]])
        new_node = np.concatenate([[True], node[1:] != node[:-1]])
        yy = y[idx]
        new_run = new_node | np.concatenate([[True], yy[1:] != yy[:-1]])
        node_base = before[np.flatnonzero(new_node)][np.cumsum(new_node) - 1]
        run_base = before[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
        total += int(np.sum(asked[idx] * high * (run_base - node_base)))
    return total


def later_within(group, y, weight, asked) -> int:
    """Sum over i of asked_i times the weight of points j of the same group with y_j > y_i."""
    idx = np.lexsort((-y, group))
    g, yy, w = group[idx], y[idx], weight[idx]
    before = np.concatenate([[0], np.cumsum(w)[:-1]])
    new_group = np.concatenate([[True], g[1:] != g[:-1]])
    new_run = new_group | np.concatenate([[True], yy[1:] != yy[:-1]])
    base = before[np.flatnonzero(new_group)][np.cumsum(new_group) - 1]
    run = before[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
    return int(np.sum(asked[idx] * (run - base)))


def followed_rank(t: np.ndarray, censored: np.ndarray) -> np.ndarray:
    """Dense rank of (time, events before censored)."""
    idx = np.lexsort((censored, t))
    tt, cc = t[idx], censored[idx]
    step = np.concatenate([[False], (tt[1:] != tt[:-1]) | (cc[1:] != cc[:-1])])
    rank = np.empty(len(t), dtype=np.int64)
    rank[idx] = np.cumsum(step)
    return rank


def dense_rank(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def line_marks(points: DataFrame, column: str, lines: int) -> list[float]:
    if lines == 1:
        return []
    share = [k / lines for k in range(1, lines)]
    return sorted(set(points.agg(F.percentile_approx(column, share, 10 * lines)).first()[0] or []))


def concordance(
    df: DataFrame,
    risk: str = "risk",
    duration: str = "duration_days",
    event: str = "is_churned",
    points_per_line: int = POINTS_PER_LINE,
) -> dict:
    """Counts of comparable, concordant and tied pairs, and the index (None if no pair)."""
    # filtering the stored points, not the rows: a filter on the rows would repeat the risk formula
    stored = (
        df.groupBy(
            F.col(risk).cast("double").alias("r"),
            F.col(duration).cast("double").alias("t"),
            (F.coalesce(F.col(event).cast("int"), F.lit(0)) != 1).cast("int").alias("c"),
        )
        .agg(F.count(F.lit(1)).alias("w"))
        .persist()
    )
    points = stored.where(F.col("r").isNotNull() & ~F.isnan("r") & F.col("t").isNotNull())
    try:
        size = points.count()
        lines = max(1, -(-size // points_per_line))
        rm, tm = line_marks(points, "r", lines), line_marks(points, "t", lines)
        r_below, t_below = count_below(F.col("r"), rm), count_below(F.col("t"), tm)
        on_r = F.coalesce(F.array_contains(double_array(rm), F.col("r")), F.lit(False)) if rm else F.lit(False)
        on_t = F.coalesce(F.array_contains(double_array(tm), F.col("t")), F.lit(False)) if tm else F.lit(False)
        placed = points.select(
            "r", "t", "c", "w",
            (2 * r_below + on_r.cast("int")).alias("a"),
            (3 * t_below + F.when(on_t, F.col("c") + 1).otherwise(0)).alias("b"),
        )
        result = _count(placed, 2 * len(rm) + 1, 3 * len(tm) + 1)
    finally:
        stored.unpersist()
    comparable, concordant, tied = result
    index = (concordant + 0.5 * tied) / comparable if comparable else None
    return {
        "comparable": comparable, "concordant": concordant, "tied": tied, "c_index": index,
    }


def _inside_time_line(pdf: pd.DataFrame) -> pd.DataFrame:
    y = followed_rank(pdf["t"].to_numpy(), pdf["c"].to_numpy())
    a, w = pdf["a"].to_numpy(np.int64), pdf["w"].to_numpy(np.int64)
    asked = np.where(pdf["c"].to_numpy() == 0, w, 0)
    mark = a % 2 == 1
    return pd.DataFrame(
        {
            "comparable": [later_within(np.zeros(len(a), dtype=np.int64), y, w, asked)],
            "concordant": [earlier_smaller(dense_rank(a), y, a, w, asked)],
            "tied": [later_within(a[mark], y[mark], w[mark], asked[mark]) if mark.any() else 0],
        }
    )


def _inside_risk_line(pdf: pd.DataFrame) -> pd.DataFrame:
    y = followed_rank(pdf["t"].to_numpy(), pdf["c"].to_numpy())
    w = pdf["w"].to_numpy(np.int64)
    asked = np.where(pdf["c"].to_numpy() == 0, w, 0)
    rank = dense_rank(pdf["r"].to_numpy())
    return pd.DataFrame(
        {
            "comparable": [0],
            "concordant": [earlier_smaller(rank, y, rank, w, asked)],
            "tied": [later_within(rank, y, w, asked)],
        }
    )


COUNTS = "comparable bigint, concordant bigint, tied bigint"


def _count(placed: DataFrame, rows: int, cols: int) -> tuple[int, int, int]:
    spark = placed.sparkSession
    in_time = placed.where(F.col("b") % 3 == 0).groupBy("b").applyInPandas(
        _inside_time_line, COUNTS
    )
    in_risk = placed.where(F.col("a") % 2 == 0).groupBy("a").applyInPandas(
        _inside_risk_line, COUNTS
    )
    cells = placed.groupBy("a", "b").agg(
        F.sum("w").alias("n"), F.sum(F.when(F.col("c") == 0, F.col("w")).otherwise(0)).alias("e")
    )
    # every cell of the grid, so that running sums meet in each
    grid = (
        spark.range(rows * cols)
        .select((F.col("id") % rows).cast("int").alias("a"), F.floor(F.col("id") / rows).cast("int").alias("b"))
        .join(cells, on=["a", "b"], how="left")
        .select("a", "b", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("e", F.lit(0)).alias("e"))
    )
    lower = Window.partitionBy("b").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("b")
    later = Window.partitionBy("a").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    across = (
        grid.withColumn("low", F.sum("n").over(lower))
        .withColumn("all", F.sum("n").over(whole))
        .select(
            "a", "e",
            F.sum("low").over(later).alias("low_later"),
            F.sum("all").over(later).alias("all_later"),
            F.sum("n").over(later).alias("same_later"),
        )
        .where(F.col("e") > 0)
        .select(
            (F.col("e").cast("decimal(19,0)") * F.coalesce("all_later", F.lit(0)).cast("decimal(19,0)")).alias("comparable"),
            (F.col("e").cast("decimal(19,0)") * F.coalesce("low_later", F.lit(0)).cast("decimal(19,0)")).alias("concordant"),
            F.when(
                F.col("a") % 2 == 1,
                F.col("e").cast("decimal(19,0)") * F.coalesce("same_later", F.lit(0)).cast("decimal(19,0)"),
            ).otherwise(F.lit(0).cast(big)).alias("tied"),
        )
    )
    parts = [
        p.select(*[F.col(c).cast(big).alias(c) for c in ("comparable", "concordant", "tied")])
        for p in (in_time, in_risk, across)
    ]
    row = (
        parts[0].unionAll(parts[1]).unionAll(parts[2])
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("comparable", "concordant", "tied")])
        .first()
    )
    return int(row[0]), int(row[1]), int(row[2])


# ---------------------------------------------------------------- many groups in one job

GROUP_COUNTS = "_g {kind}, " + COUNTS


def _by_group(sweep):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = sweep(pdf)
        out.insert(0, "_g", [key[0]])
        return out

    return run


def concordance_by(
    df: DataFrame,
    group: str,
    risk: str = "risk",
    duration: str = "duration_days",
    event: str = "is_churned",
    points_per_line: int = POINTS_PER_LINE,
) -> DataFrame:
    """(group, comparable, concordant, tied, c_index) of every group; c_index is null without a pair.

    All groups are counted from one table of distinct points and share every shuffle: each has a
    grid of its own, with as many lines as its points ask for (a power of two). A null group is one.
    """
    kind = df.schema[group].dataType.simpleString()
    stored = (
        df.groupBy(
            F.col(group).alias("_g"),
            F.col(risk).cast("double").alias("r"),
            F.col(duration).cast("double").alias("t"),
            (F.coalesce(F.col(event).cast("int"), F.lit(0)) != 1).cast("int").alias("c"),
        )
        .agg(F.count(F.lit(1)).alias("w"))
        .persist()
    )
    try:
        usable = F.col("r").isNotNull() & ~F.isnan("r") & F.col("t").isNotNull()
        sizes = stored.groupBy("_g").agg(F.count_if(usable).alias("n"))
        asked = F.greatest(F.lit(1.0), F.ceil(F.col("n") / points_per_line))
        sizes = sizes.withColumn("_lines", F.pow(F.lit(2.0), F.ceil(F.log2(asked))).cast("int"))
        steps = sorted(r[0] for r in sizes.select("_lines").distinct().collect())
        points = stored.where(usable)
        lined = _join_group(points, sizes.select("_g", "_lines"))
        marks = None
        for lines in steps:
            share = [k / lines for k in range(1, lines)]

            def quantiles(column: str):
                if not share:
                    return F.array().cast("array<double>")
                return F.array_sort(F.array_distinct(F.percentile_approx(column, share, 10 * lines)))

            some = lined.where(F.col("_lines") == lines).groupBy("_g").agg(
                *([F.count(F.lit(1)).alias("_n")] if not share else []),
                quantiles("r").alias("rm"), quantiles("t").alias("tm"),
            ).select("_g", "rm", "tm")
            marks = some if marks is None else marks.unionAll(some)
        grids = cut_lineage(sizes.select("_g").limit(0).selectExpr("_g", "array(0D) AS rm", "array(0D) AS tm") if marks is None else marks)
        counted = cut_lineage(_count_groups(points, sizes.select("_g"), grids, max(steps, default=1), kind))
    finally:
        stored.unpersist()
    # as doubles: a product of two such decimals would lose its whole digits
    comparable, concordant, tied = (F.col(c).cast("double") for c in ("comparable", "concordant", "tied"))
    index = F.when(comparable > 0, (concordant + 0.5 * tied) / comparable)
    return counted.select(F.col("_g").alias(group), "comparable", "concordant", "tied", index.alias("c_index"))


def _join_group(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnRenamed("_g", "_other")
    return left.join(other, F.col("_g").eqNullSafe(F.col("_other"))).drop("_other")


def _count_groups(points: DataFrame, groups: DataFrame, marks: DataFrame, most: int, kind: str) -> DataFrame:
    """(_g, comparable, concordant, tied); a grid per group, as in `_count`."""
    marked = _join_group(points, marks)
    r_below = F.when(F.size("rm") > 0, count_below_in(F.col("r"), F.col("rm"), most)).otherwise(F.lit(0))
    t_below = F.when(F.size("tm") > 0, count_below_in(F.col("t"), F.col("tm"), most)).otherwise(F.lit(0))
    placed = marked.select(
        "_g", "r", "t", "c", "w",
        (2 * r_below + F.array_contains("rm", F.col("r")).cast("int")).alias("a"),
        (3 * t_below + F.when(F.array_contains("tm", F.col("t")), F.col("c") + 1).otherwise(0)).alias("b"),
    )
    schema = GROUP_COUNTS.format(kind=kind)
    in_time = placed.where(F.col("b") % 3 == 0).groupBy("_g", "b").applyInPandas(_by_group(_inside_time_line), schema)
    in_risk = placed.where(F.col("a") % 2 == 0).groupBy("_g", "a").applyInPandas(_by_group(_inside_risk_line), schema)
    cells = placed.groupBy("_g", "a", "b").agg(
        F.sum("w").alias("n"), F.sum(F.when(F.col("c") == 0, F.col("w")).otherwise(0)).alias("e")
    )
    # every cell of every grid, so that running sums meet in each
    empty = marks.select("_g", F.explode(F.sequence(F.lit(0), 2 * F.size("rm"))).alias("a"), F.size("tm").alias("_m")).select(
        "_g", "a", F.explode(F.sequence(F.lit(0), 3 * F.col("_m"))).alias("b"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("e"),
    )
    grid = cells.unionByName(empty).groupBy("_g", "a", "b").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    lower = Window.partitionBy("_g", "b").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g", "b")
    later = Window.partitionBy("_g", "a").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    big, factor = "decimal(38,0)", "decimal(19,0)"

    def times(column: str):
        return F.col("e").cast(factor) * F.coalesce(column, F.lit(0)).cast(factor)

    across = (
        grid.withColumn("low", F.sum("n").over(lower))
        .withColumn("all", F.sum("n").over(whole))
        .select(
            "_g", "a", "e",
            F.sum("low").over(later).alias("low_later"),
            F.sum("all").over(later).alias("all_later"),
            F.sum("n").over(later).alias("same_later"),
        )
        .where(F.col("e") > 0)
        .select(
            "_g", times("all_later").alias("comparable"), times("low_later").alias("concordant"),
            F.when(F.col("a") % 2 == 1, times("same_later")).otherwise(F.lit(0).cast(big)).alias("tied"),
        )
    )
    counts = ("comparable", "concordant", "tied")
    none = groups.select("_g", *[F.lit(0).cast(big).alias(c) for c in counts])
    parts = [
        part.select("_g", *[F.col(c).cast(big).alias(c) for c in counts]) for part in (in_time, in_risk, across)
    ]
    return (
        none.unionAll(parts[0]).unionAll(parts[1]).unionAll(parts[2])
        .groupBy("_g").agg(*[F.sum(c).cast(big).alias(c) for c in counts])
    )
