"""Covariate preparation: cleaning, z-scores, level flags, with everything frozen at fit time."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tenurelens.functions import scalars as S

LOW_VARIANCE = 1e-6


@dataclass
class Design:
    """`numeric` holds (column, mean, std), `levels` holds (column, level)."""

    numeric: list[tuple[str, float, float]] = field(default_factory=list)
    levels: list[tuple[str, str]] = field(default_factory=list)

    @property
    def terms(self) -> list[str]:
        return [c for c, _, _ in self.numeric] + [f"{c}_{level}" for c, level in self.levels]

    def columns(self, df: DataFrame) -> list[Column]:
        """One column per term; a numeric column the table lacks counts as 0."""
        out = []
        for name, mean, std in self.numeric:
            value = F.col(name) if name in df.columns else F.lit(0.0)
            out.append(S.zscore(value, mean, std))
        for name, level in self.levels:
            out.append(S.level_flag(F.col(name), level) if name in df.columns else F.lit(0.0))
        return out

    def matrix(self, df: DataFrame, keep: list[Column]) -> DataFrame:
        """Kept columns plus the terms as x0, x1, ..."""
        return df.select(*keep, *[c.alias(f"x{k}") for k, c in enumerate(self.columns(df))])

    def linear(self, df: DataFrame, beta) -> Column:
        return S.weighted_sum(list(zip(self.columns(df), beta)))


def covariate_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std) of cleaned numeric columns, from one pass."""
    cleaned = {c: S.finite_or_zero(F.col(c)) for c in columns}
    aggs = []
    for c, v in cleaned.items():
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__std")]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in columns
    ])
    return df.agg(*aggs).select(F.explode(rows).alias("_r")).select("_r.*")


def category_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels per categorical column; the first one is the base level.

    Every level becomes a coefficient on the driver, so their number bounds what is collected.
    """
    if not columns:
        return {}
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns
    ])
    found = (
        df.select(F.explode(pairs).alias("_p")).select("_p.*")
        .where(F.col("level").isNotNull()).distinct().collect()
    )
    out = {}
    for c in columns:
        levels = [r["level"] for r in found if r["column"] == c]
        numeric = isinstance(df.schema[c].dataType, NumericType)
        out[c] = sorted(levels, key=float if numeric else None)
    return out


def fit_design(df: DataFrame, numeric: list[str], categorical: list[str]) -> Design:
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    kept = []
    if numeric:
        for name, mean, std in covariate_stats(df, numeric).collect():
            if std is not None and std > LOW_VARIANCE:
                kept.append((name, mean, std))
    levels = [
        (c, level)
        for c, found in category_levels(df, categorical).items()
        for level in found[1:]
    ]
    return Design(kept, levels)


def happened(event: str) -> Column:
    """A null event is censored, here as in the life tables."""
    return F.coalesce(F.col(event).cast("double"), F.lit(0.0))


def refuse(rows: DataFrame, broken: Column, what: str) -> None:
    """No row is left out silently: rows that cannot be used stop the fit, with their number."""
    n = rows.agg(F.count_if(broken)).first()[0]
    if n:
        raise ValueError(f"{n} rows have {what}")
