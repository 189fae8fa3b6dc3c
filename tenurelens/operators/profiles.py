"""Stored profiles of a batch, so that drift against it needs no row of it again.

A profile counts the values of each feature: categories as they are, numbers on a lattice that
keeps `bits` binary digits after the leading one. Whole numbers below 2^(bits + 1) and short
fractions lie on it exactly; any other value moves down by less than 2^-bits of itself, so a
profile has a bounded number of rows (2^bits per power of two that occurs) whatever the batch.

Profiles of parts of a batch add up to the profile of the batch. Distances between distribution
functions differ from the exact ones by at most the largest share of rows on one lattice point
of either side, which `lattice_error` returns; PSI uses edges that are lattice points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurelens.operators import drift
from tenurelens.sources.schemas import DRIFT_CATEGORICAL, DRIFT_NUMERIC
from tenurelens.sources.tables import read_parquet, write_parquet

BITS = 10
NUMERIC, CATEGORICAL = "numeric", "categorical"


def lattice(value: Column, bits: int = BITS) -> Column:
    """The lattice point at or below a number; zero, infinities and nulls as they are."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # the logarithm may be off by one next to a power of two; powers of two are exact
    exponent = guess + (size >= F.pow(F.lit(2.0), guess + 1)).cast("int") - (size < F.pow(F.lit(2.0), guess)).cast("int")
    step = F.pow(F.lit(2.0), exponent - bits)
    usable = (size > 1e-290) & (size < 1e290)
    return F.when(usable, F.floor(value / step).cast("double") * step).otherwise(F.when(size <= 1e-290, F.lit(0.0)).otherwise(value))


def profile(
    df: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None, bits: int = BITS
) -> DataFrame:
    """(feature, kind, number, level, n) of the batch; nulls and NaN are not counted, absent columns left out."""
    numeric = [c for c in (DRIFT_NUMERIC if numeric is None else numeric) if c in df.columns]
    categorical = [c for c in (DRIFT_CATEGORICAL if categorical is None else categorical) if c in df.columns]
    parts = []
    if numeric:
        long = drift.melt(df, numeric, "double")
        parts.append(long.select("feature", F.lit(NUMERIC).alias("kind"), lattice(F.col("value"), bits).alias("number"), F.lit(None).cast("string").alias("level")))
    if categorical:
        long = drift.melt(df, categorical, "string")
        parts.append(long.select("feature", F.lit(CATEGORICAL).alias("kind"), F.lit(None).cast("double").alias("number"), F.col("value").alias("level")))
    if not parts:
        raise ValueError("none of the features is in the table")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy("feature", "kind", "number", "level").agg(F.count(F.lit(1)).alias("n"))


def merge(*profiles: DataFrame) -> DataFrame:
    """The profile of all batches together."""
    rows = profiles[0]
    for other in profiles[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("feature", "kind", "number", "level").agg(F.sum("n").alias("n"))


def write_profile(counts: DataFrame, root: str, batch: str) -> None:
    """Store the profile of one batch below `root`, in place of an earlier one."""
    write_parquet(counts, f"{root.rstrip('/')}/batch={batch}")


def read_profile(spark: SparkSession, root: str, batch: str) -> DataFrame:
    return read_parquet(spark, f"{root.rstrip('/')}/batch={batch}")


def _counted(reference: DataFrame, current: DataFrame, kind: str, value: str) -> DataFrame:
    sides = [
        p.where(F.col("kind") == kind).select(
            "feature", F.col(value).alias("value"),
            (F.col("n") if side == 0 else F.lit(0)).alias("n_ref"), (F.col("n") if side == 1 else F.lit(0)).alias("n_cur"),
        )
        for side, p in enumerate((reference, current))
    ]
    return sides[0].unionAll(sides[1]).groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = drift.BINS) -> DataFrame:
    """(feature, psi, kl, ks_stat, ref_n, cur_n) from two profiles."""
    return drift.numeric_figures(_counted(reference, current, NUMERIC, "number"), columns, bins)


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, psi, chi2_stat, degrees) from two profiles; exact."""
    return drift.categorical_figures(_counted(reference, current, CATEGORICAL, "level"), columns)


def lattice_error(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, ks_error): how far ks_stat may be from that of the rows.

    Inside a lattice cell only its own share is unknown; a cell that holds one value has no
    error, but a profile does not know that.
    """
    shares = None
    for side in (reference, current):
        numbers = side.where(F.col("kind") == NUMERIC)
        part = numbers.groupBy("feature").agg((F.max("n") / F.sum("n")).alias("share"))
        shares = part if shares is None else shares.unionAll(part)
    return shares.groupBy("feature").agg(F.max("share").alias("ks_error"))


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None,
    psi_limit: float = drift.PSI_LIMIT, alpha: float = drift.ALPHA, bins: int = drift.BINS,
) -> DataFrame:
    """`drift.drift_report` from two profiles."""
    numeric = DRIFT_NUMERIC if numeric is None else numeric
    categorical = DRIFT_CATEGORICAL if categorical is None else categorical
    return drift.verdicts(
        numeric_drift(reference, current, numeric, bins) if numeric else None,
        categorical_drift(reference, current, categorical) if categorical else None, psi_limit, alpha,
    )


def batch_drift(
    reference: DataFrame, batch: DataFrame, column: str = "survival_prob_90d", psi_limit: float = drift.PSI_LIMIT
) -> DataFrame:
    """One row: did a batch of scores drift from the stored profile? Only the batch's rows are read."""
    figures = numeric_drift(reference, profile(batch, [column], []), [column])
    return figures.select(
        F.round("psi", 4).alias("psi"), F.round("ks_stat", 4).alias("ks_stat"), F.round("kl", 4).alias("kl"),
        F.coalesce(F.col("psi") > psi_limit, F.lit(False)).alias("drift_detected"),
    )
