"""Running sums over a table that holds one row per group and order value.

An int order column is a day count: a group has at most as many rows as days were observed
(36,525 in a century), so a plain window per group is small whatever the number of raw rows.
Any other order column may be as long as the data. Such a table is cut into buckets at
approximate quantiles of itself: sums inside a bucket come from a window per bucket, and what
precedes the bucket from a window over bucket totals, of which there are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

from tenurelens.functions.scalars import count_below_in

def bucket_count(spark: SparkSession) -> int:
    """Four buckets per shuffle partition, the knob that already follows the cluster's size."""
    return max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_bucket(df: DataFrame, order: str) -> DataFrame:
    buckets = bucket_count(df.sparkSession)
    marks = [k / buckets for k in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(order, marks, 10 * buckets)).scalar()
    return (
        df.withColumn("_bounds", bounds)
        # never null, or the join on it would test the bucket on every row below the aggregate
        .withColumn(
            "_bucket", F.coalesce(count_below_in(F.col(order), F.col("_bounds"), buckets), F.lit(0))
        )
        .drop("_bounds")
    )


def counts_days(df: DataFrame, order: str) -> bool:
    return isinstance(df.schema[order].dataType, (ByteType, ShortType, IntegerType))


def running_sums(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    groups: tuple[str, ...] = (),
    descending: bool = False,
    totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums `{new column: summed column}` per group.

    `order` must be unique within a group (aggregate ties first) and group keys not null.
    With `totals`, `<new column>_total` holds the sum over the whole group. There may be many
    sums, so the expressions are given as SQL text, one call per table.
    """
    way = "DESC" if descending else "ASC"

    def quoted(columns) -> list[str]:
        return [f"`{c}`" for c in columns]

    def over(partition, by, frame: str) -> str:
        return f"OVER (PARTITION BY {', '.join(partition) or '0'} ORDER BY {by} {way} ROWS BETWEEN {frame})"

    so_far = "UNBOUNDED PRECEDING AND CURRENT ROW"
    everything = "UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    if counts_days(df, order):
        inside = over(quoted(groups), f"`{order}`", so_far)
        whole = over(quoted(groups), f"`{order}`", everything)
        return df.selectExpr(
            "*",
            *[f"sum(`{c}`) {inside} AS `{new}`" for new, c in sums.items()],
            *[f"sum(`{c}`) {whole} AS `{new}_total`" for new, c in sums.items() if totals],
        )

    key = [*groups, "_bucket"]
    table = with_bucket(df, order)
    bucket_sums = group_sums(table, key, {f"_sum_{new}": c for new, c in sums.items()})
    earlier = over(quoted(groups), "`_bucket`", "UNBOUNDED PRECEDING AND 1 PRECEDING")
    whole = over(quoted(groups), "`_bucket`", everything)
    offsets = bucket_sums.selectExpr(
        *quoted(key),
        *[f"sum(`_sum_{new}`) {earlier} AS `_before_{new}`" for new in sums],
        *[f"sum(`_sum_{new}`) {whole} AS `{new}_total`" for new in sums if totals],
    )
    inside = over(quoted(key), f"`{order}`", so_far)
    local = table.selectExpr(
        *quoted(df.columns), "_bucket",
        *[f"sum(`{c}`) {inside} AS `_local_{new}`" for new, c in sums.items()],
    )
    return local.join(offsets, on=key).selectExpr(
        *quoted(df.columns),
        *[
            f"CASE WHEN `_before_{new}` IS NULL THEN `_local_{new}` "
            f"ELSE `_before_{new}` + coalesce(`_local_{new}`, 0) END AS `{new}`"
            for new in sums
        ],
        *[f"`{new}_total`" for new in sums if totals],
    )


def group_sums(df: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """`GROUP BY keys` with one sum per `{new column: summed column}`."""
    by = ", ".join(f"`{k}`" for k in keys)
    wanted = ", ".join(f"sum(`{c}`) AS `{new}`" for new, c in sums.items())
    return df.sparkSession.sql(f"SELECT {by}, {wanted} FROM {{rows}} GROUP BY {by}", rows=df)


def rank_by_hash(
    df: DataFrame, id_col: str, seed: int, strata: tuple[str, ...] = (), out: str = "rank",
    slice_bits: int = 10,
) -> DataFrame:
    """1-based position of each row in a seeded shuffle of its stratum.

    The hash is uniform, so its leading bits are an even cut of any stratum; `slice_bits` says
    into how many slices, each of which is ordered in one task.
    """
    strata = list(strata)
    key = [*strata, "_slice"]
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(id_col))).withColumn(
        "_slice", F.shiftright("_hash", 64 - slice_bits).cast("int")
    )
    earlier = (
        Window.partitionBy(*strata)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*key, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*key).orderBy("_hash", id_col)
    return (
        hashed.withColumn("_local", F.row_number().over(inside))
        .join(offsets, on=key)
        .select(*df.columns, (F.col("_before") + F.col("_local")).alias(out))
    )
