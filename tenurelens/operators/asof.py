"""As-of joins: for every left row the right row at, before, after or nearest to its own time.

Only the distinct (key, time) pairs of the left side take part in the search. They are merged
with the right side into one timeline per key, cut into buckets at quantiles of the times. A
window inside a bucket carries the last (or next) right row; what comes from other buckets is
carried over one summary row per key and bucket. A key with any share of the rows is thus cut by
time, and a time shared by many left rows is searched once and met again by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.operators.prefix import with_bucket

DIRECTIONS = ("backward", "forward", "nearest")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _carried(line: DataFrame, keys: list[str], forward: bool) -> DataFrame:
    """`_found`: the last (or next) `_right` of the same key, in this bucket or beyond it."""
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_t")
    across = Window.partitionBy(*keys).orderBy("_bucket")
    take = F.first if forward else F.last
    rows = (0, Window.unboundedFollowing) if forward else (Window.unboundedPreceding, 0)
    others = (1, Window.unboundedFollowing) if forward else (Window.unboundedPreceding, -1)
    pick = F.min_by if forward else F.max_by
    # only right rows have a value, so a time without one does not count
    edge = F.when(F.col("_right").isNotNull(), F.col("_t"))
    ends = line.groupBy(*keys, "_bucket").agg(pick("_right", edge).alias("_edge"))
    ends = ends.select(
        *[F.col(k).alias(f"_key{n}") for n, k in enumerate(keys)], F.col("_bucket").alias("_b"),
        take("_edge", ignorenulls=True).over(across.rowsBetween(*others)).alias("_far"),
    )
    near = line.withColumn("_near", take("_right", ignorenulls=True).over(inside.rangeBetween(*rows)))
    on = F.col("_bucket") == F.col("_b")
    for n, k in enumerate(keys):
        on = on & _same(F.col(k), F.col(f"_key{n}"))
    return near.where("_asked").join(ends, on, "left").select(*keys, "_t", F.coalesce("_near", "_far").alias("_found"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    columns: list[str],
    by: list[str] | tuple[str, ...] = (),
    direction: str = "backward",
    later: bool = True,
    prefix: str = "",
) -> DataFrame:
    """All left rows with `columns` of the right row that is last at or before their time
    (`backward`), first at or after it (`forward`), or `nearest` (of two at the same distance the
    later one, or the earlier one with later=False), within equal `by` keys.

    Null keys equal each other. A left row without a time, or without a right row on the asked
    side, gets nulls; right rows without a time count for nothing. Several right rows of one key
    and time count as one, the largest by `columns`. The added columns are named prefix + name.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}, got {direction!r}")
    keys = [f"_by{n}" for n in range(len(by))]
    times = right.where(F.col(right_time).isNotNull()).groupBy(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(right_time).alias("_t")
    ).agg(F.max(F.struct(*columns)).alias("_value"))
    asked = left.where(F.col(left_time).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(left_time).alias("_t")
    ).distinct()
    line = with_bucket(
        times.select(*keys, "_t", F.struct("_t", "_value").alias("_right"), F.lit(False).alias("_asked")).unionByName(
            asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True
        ),
        "_t",
    )
    if direction != "nearest":
        found = _carried(line, keys, direction == "forward")
    else:
        sides = {way: _carried(line, keys, way == "forward") for way in ("backward", "forward")}
        after = sides["forward"].select(
            *[F.col(k).alias(f"_a{k}") for k in keys], F.col("_t").alias("_at"), F.col("_found").alias("_after")
        )
        on = F.col("_t") == F.col("_at")
        for k in keys:
            on = on & _same(F.col(k), F.col(f"_a{k}"))
        ahead, behind = F.col("_after._t") - F.col("_t"), F.col("_t") - F.col("_found._t")
        closer = ahead <= behind if later else ahead < behind
        found = sides["backward"].join(after, on).select(
            *keys, "_t",
            F.when(F.col("_found").isNull() | closer, F.col("_after")).otherwise(F.col("_found")).alias("_found"),
        )
        # without a right row ahead the comparison is null and the one behind stays
    values = found.select(
        *[F.col(k).alias(f"_met{n}") for n, k in enumerate(keys)], F.col("_t").alias("_met"),
        *[F.col(f"_found._value.{c}").alias(f"_out{n}") for n, c in enumerate(columns)],
    )
    on = left[left_time] == F.col("_met")
    for n, c in enumerate(by):
        on = on & _same(left[c], F.col(f"_met{n}"))
    added = [F.col(f"_out{n}").alias(f"{prefix}{c}") for n, c in enumerate(columns)]
    return left.join(values, on, "left").select(*[left[c] for c in left.columns], *added)
