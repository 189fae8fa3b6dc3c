"""Accelerated failure time regressions: Weibull, log-normal and log-logistic.

With z = (ln T - mu) / sigma and mu = b + x beta, an event adds log f(z) - ln sigma - ln T and
a censored row log S(z). Covariates are standardised inside the fit and mapped back after it.

Rows are read once and packed into blocks of about 16 MB a part. Tasks sum the log-likelihood, its
gradient and Hessian in (beta, b, ln sigma) over their block; one Newton step is one such map
without a shuffle, and families fitted together share it. The driver sees (p + 3)(p + 4) / 2
numbers per part and family.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurelens.functions import scalars as S
from tenurelens.operators.concordance import concordance
from tenurelens.operators.cox import needed
from tenurelens.operators.design import Design, fit_design, happened, refuse
from tenurelens.operators.evaluate import sample_rows
from tenurelens.operators.partials import columns_of, pack_upper, unpack_upper
from tenurelens.operators.risksets import LEAST_ENTRIES, PART_BYTES
from tenurelens.sources.schemas import AFT_COVARIATES, HORIZONS
from tenurelens.sources.tables import read_parquet, write_parquet

FAMILIES = ("weibull", "log_normal", "log_logistic")


def normal_tail_terms(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log P(Z > z) and the hazard pdf / P(Z > z), stable far into the tail."""
    a = np.abs(z)
    near = S.horner(a, S.HART_TOP) / S.horner(a, S.HART_BOTTOM)
    far = S.tail_ratio_far(np.maximum(a, 1.0)) / 2.506628274631
    ratio = np.where(a < S.HART_LIMIT, near, far)
    small = np.exp(-0.5 * a * a) * ratio
    log_tail = np.where(z > 0, -0.5 * a * a + np.log(ratio), np.log1p(-small))
    hazard = np.exp(-0.5 * z * z - 0.5 * math.log(2 * math.pi) - log_tail)
    return log_tail, hazard


def family_terms(family: str, z: np.ndarray, event: np.ndarray):
    """Log-likelihood part in z with its first and second derivative."""
    if family == "weibull":
        ez = np.exp(np.minimum(z, 700.0))
        return event * z - ez, event - ez, -ez
    if family == "log_logistic":
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
        soft = np.logaddexp(0.0, z)
        times = 1.0 + event
        return event * z - times * soft, event - times * p, -times * p * (1 - p)
    log_tail, hazard = normal_tail_terms(z)
    density = -0.5 * z * z - 0.5 * math.log(2 * math.pi)
    is_event = event > 0
    return (
        np.where(is_event, density, log_tail),
        np.where(is_event, -z, -hazard),
        np.where(is_event, -1.0, -hazard * (hazard - z)),
    )


class Prepared(NamedTuple):
    """Packed rows (log_t, event, x0..), their design, number, and mean and deviation of log_t."""

    rows: DataFrame
    design: Design
    n: int
    mean: float | None
    spread: float | None


def pack(rows: DataFrame, p: int, n: int) -> DataFrame:
    """Rows (log_t, event, x0.., _salt) as blocks of numbers, kept until the caller drops them."""
    spark = rows.sparkSession
    parts = max(
        math.ceil(n * 8 * (p + 2) / PART_BYTES), min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_ENTRIES)), 1,
    )
    columns = ["log_t", "event", *[f"x{k}" for k in range(p)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array([columns_of(batch, columns).tobytes()], pa.binary())], names=["block"])

    return rows.repartition(parts, "_salt").select(columns).mapInArrow(run, "block binary").persist()


def likelihood_sums(rows: DataFrame, p: int, asked: list[tuple[str, np.ndarray]]):
    """(log-likelihood, gradient, Hessian) of every family at its parameters, from packed rows."""
    size = 1 + (p + 2) + (p + 2) * (p + 3) // 2

    def block_sums(block: np.ndarray, family: str, theta: np.ndarray) -> np.ndarray:
        total, hess = np.zeros(size), np.zeros((p + 2, p + 2))
        sigma = math.exp(theta[-1])
        design = np.hstack([block[:, 2:], np.ones((len(block), 1))])
        log_t, event = block[:, 0], block[:, 1]
        z = (log_t - design @ theta[:-1]) / sigma
        ll, g, h = family_terms(family, z, event)
        total[0] = float(ll.sum() - (event * (theta[-1] + log_t)).sum())
        total[1 : p + 2] = design.T @ (-g / sigma)
        total[p + 2] = float((-g * z - event).sum())
        hess[: p + 1, : p + 1] = (design * (h / sigma**2)[:, None]).T @ design
        mixed = design.T @ ((h * z + g) / sigma)
        hess[: p + 1, p + 1] = mixed
        hess[p + 1, : p + 1] = mixed
        hess[p + 1, p + 1] = float((h * z * z + g * z).sum())
        total[p + 3 :] = pack_upper(hess)
        return total

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(asked), size))
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                for packed in batch.column("block"):
                    block = np.frombuffer(packed.as_buffer()).reshape(-1, p + 2)
                    total += np.stack([block_sums(block, family, theta) for family, theta in asked])
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    total = np.zeros((len(asked), size))
    for row in rows.mapInArrow(sums, "sums binary").collect():
        total += np.frombuffer(row["sums"]).reshape(total.shape)
    return [(float(s[0]), s[1 : p + 3], unpack_upper(s[p + 3 :], p + 2)) for s in total]


def ascent_direction(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Newton step with the Hessian's eigenvalues made negative where they are not."""
    values, vectors = np.linalg.eigh(-hess)
    floor = 1e-10 * max(1.0, float(np.max(np.abs(values))))
    return vectors @ ((vectors.T @ grad) / np.maximum(np.abs(values), floor))


@dataclass
class AftModel:
    family: str
    covariates: list[str]
    beta: np.ndarray
    intercept: float
    sigma: float
    log_likelihood: float
    n_rows: int
    spark: SparkSession
    penalizer: float = 0.0
    steps: int = 0

    @property
    def n_params(self) -> int:
        return len(self.beta) + 2

    @property
    def shape(self) -> float:
        return 1.0 / self.sigma

    @property
    def aic(self) -> float:
        return 2.0 * self.n_params - 2.0 * self.log_likelihood

    @property
    def bic(self) -> float:
        return self.n_params * math.log(self.n_rows) - 2.0 * self.log_likelihood

    def params(self) -> dict:
        return {
            "model_type": f"parametric_{self.family}", "distribution": self.family,
            "penalizer": self.penalizer, "n_covariates": len(self.beta), "aic": self.aic, "bic": self.bic,
        }

    def location(self, df: DataFrame) -> Column:
        """mu = E-location of ln T."""
        terms = [(S.finite_or_zero(F.col(c)), b) for c, b in zip(self.covariates, self.beta)]
        return F.lit(float(self.intercept)) + S.weighted_sum(terms)

    def survival(self, df: DataFrame, t: float | Column) -> Column:
        log_t = F.ln(t) if isinstance(t, Column) else F.lit(math.log(t))
        z = (log_t - self.location(df)) / F.lit(float(self.sigma))
        if self.family == "weibull":
            return F.exp(-F.exp(z))
        if self.family == "log_logistic":
            return 1.0 / (1.0 + F.exp(z))
        return S.normal_upper_tail(z)

    def median(self, df: DataFrame) -> Column:
        shift = self.sigma * math.log(math.log(2.0)) if self.family == "weibull" else 0.0
        return F.exp(self.location(df) + F.lit(shift))

    def expectation(self, df: DataFrame) -> Column:
        """E[T | x]; infinite for a log-logistic with shape <= 1."""
        mu, s = self.location(df), self.sigma
        if self.family == "weibull":
            return F.exp(mu) * F.lit(math.gamma(1.0 + s))
        if self.family == "log_normal":
            return F.exp(mu + F.lit(s * s / 2.0))
        if s >= 1.0:
            return F.lit(float("inf"))
        return F.exp(mu) * F.lit(math.pi * s / math.sin(math.pi * s))

    def survival_at_horizons(self, df: DataFrame, horizons=HORIZONS, id_col: str = "customer_id") -> DataFrame:
        ids = [id_col] if id_col in df.columns else []
        return df.select(*ids, *[self.survival(df, h).alias(f"survival_prob_{h:g}d") for h in horizons])

    def mean_curve(self, df: DataFrame, horizons, n: int | None = None, seed: int = 42, id_col: str = "customer_id") -> DataFrame:
        """Mean survival over a grid of times, of all rows or of a seeded sample of n."""
        sample = df if n is None else sample_rows(df, n, id_col, seed)
        at = F.explode(F.array(*[F.lit(float(h)) for h in horizons])).alias("time")
        grid = sample.select("*", at)
        return grid.groupBy("time").agg(
            F.avg(self.survival(grid, F.col("time"))).alias("survival"), F.count(F.lit(1)).alias("n")
        )

    def concordance_index(
        self, df: DataFrame, duration: str = "duration_days", event: str = "is_churned", horizon: float = 90
    ) -> float | None:
        scored = df.select((1.0 - self.survival(df, horizon)).alias("risk"), duration, event)
        return concordance(scored, "risk", duration, event)["c_index"]

    def coefficients(self) -> DataFrame:
        rows = [(c, float(b), math.exp(b)) for c, b in zip(self.covariates, self.beta)]
        rows += [("intercept", float(self.intercept), None), ("log_sigma", math.log(self.sigma), None)]
        return self.spark.createDataFrame(rows, "term string, coef double, time_ratio double")

    def save(self, path: str) -> None:
        table = self.coefficients().select(
            "term", "coef", F.lit(self.family).alias("family"),
            F.lit(self.log_likelihood).alias("log_likelihood"), F.lit(self.n_rows).alias("n_rows"),
            F.lit(float(self.penalizer)).alias("penalizer"),
        )
        write_parquet(table.coalesce(1), f"{path}/coefficients")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "AftModel":
        rows = read_parquet(spark, f"{path}/coefficients").collect()
        coef = {r["term"]: r["coef"] for r in rows}
        terms = [r["term"] for r in rows if r["term"] not in ("intercept", "log_sigma")]
        first = rows[0]
        return cls(
            first["family"], terms, np.array([coef[t] for t in terms]), coef["intercept"],
            math.exp(coef["log_sigma"]), first["log_likelihood"], first["n_rows"], spark, first["penalizer"],
        )


def prepare(df: DataFrame, design: Design, duration: str, event: str) -> DataFrame:
    return design.matrix(
        df, [F.ln(F.col(duration).cast("double")).alias("log_t"), F.col(event).cast("double").alias("event"), F.col("_salt")]
    )


def walk(
    prepared: Prepared, penalizer: float, max_steps: int, tolerance: float
) -> Generator[np.ndarray, tuple, tuple[np.ndarray, float, int]]:
    """Newton's method: yields parameters, is sent what `likelihood_sums` has for them, returns the optimum."""
    p = len(prepared.design.terms)
    theta = np.concatenate([np.zeros(p), [prepared.mean or 0.0, math.log(max(prepared.spread or 1.0, 1e-3))]])
    ridge = np.concatenate([np.full(p, penalizer), [0.0, 0.0]])

    def penalised(at, value):
        ll, grad, hess = value
        return ll, ll - 0.5 * float(ridge @ (at * at)), grad - ridge * at, hess - np.diag(ridge)

    ll, objective, grad, hess = penalised(theta, (yield theta))
    taken = 0
    while taken < max_steps:
        direction = ascent_direction(grad, hess)
        scale, trial = 1.0, None
        for _ in range(40):
            at = theta + scale * direction
            trial = penalised(at, (yield at))
            if np.isfinite(trial[1]) and trial[1] >= objective - 1e-10 * abs(objective):
                break
            scale, trial = scale / 2.0, None
        if trial is None:
            break
        gain = trial[1] - objective
        theta = theta + scale * direction
        ll, objective, grad, hess = trial
        taken += 1
        if np.max(np.abs(scale * direction)) < tolerance or abs(gain) < 1e-11 * (abs(objective) + 1.0):
            break
    return theta, ll, taken


def maximise(prepared: Prepared, families, penalizer: float, max_steps: int, tolerance: float) -> dict[str, tuple]:
    """(parameters, log-likelihood, steps) per family; one round evaluates all families that are not done."""
    p, found = len(prepared.design.terms), {}
    walks = {f: walk(prepared, penalizer, max_steps, tolerance) for f in families}
    asked = {f: next(w) for f, w in walks.items()}
    while asked:
        values = likelihood_sums(prepared.rows, p, list(asked.items()))
        for family, value in zip(list(asked), values, strict=True):
            try:
                asked[family] = walks[family].send(value)
            except StopIteration as end:
                found[family] = end.value
                del asked[family]
    return found


def fit_aft(
    df: DataFrame,
    family: str = "weibull",
    duration: str = "duration_days",
    event: str = "is_churned",
    covariates: list[str] | None = None,
    penalizer: float = 0.0,
    max_steps: int = 100,
    tolerance: float = 1e-7,
) -> AftModel:
    """Covariates without variance are left out."""
    return fit_families(df, [family], duration, event, covariates, penalizer, max_steps, tolerance)[family]


def fit_families(
    df: DataFrame, families, duration: str, event: str, covariates: list[str] | None, penalizer: float,
    max_steps: int = 100, tolerance: float = 1e-7,
) -> dict[str, AftModel]:
    """The families on rows prepared once, side by side."""
    for family in families:
        if family not in FAMILIES:
            raise ValueError(f"family must be one of {FAMILIES}, got {family!r}")
    prepared = shared_rows(df, duration, event, covariates)
    try:
        found = maximise(prepared, families, penalizer, max_steps, tolerance)
    finally:
        prepared.rows.unpersist()
    numeric = prepared.design.numeric
    mean = np.array([m for _, m, _ in numeric])
    std = np.array([s for _, _, s in numeric])
    models = {}
    for family in families:
        theta, ll, taken = found[family]
        beta = theta[:-2] / std if len(std) else theta[:-2]
        intercept = float(theta[-2] - (beta @ mean if len(std) else 0.0))
        models[family] = AftModel(
            family, [c for c, _, _ in numeric], beta, intercept, float(math.exp(theta[-1])),
            ll, prepared.n, df.sparkSession, penalizer, taken,
        )
    return models


def shared_rows(df: DataFrame, duration: str, event: str, covariates: list[str] | None) -> Prepared:
    covariates = AFT_COVARIATES if covariates is None else covariates
    used = needed(df, [duration, event, *covariates]).persist()
    try:
        refuse(used, ~F.coalesce(F.col(duration) > 0, F.lit(False)), "a null or non-positive duration")
        known = used.withColumn(event, happened(event))
        design = fit_design(known, covariates, [])
        rows = prepare(known, design, duration, event)
        mean, spread, n = rows.agg(F.avg("log_t"), F.stddev_pop("log_t"), F.count(F.lit(1))).first()
        packed = pack(rows, len(design.terms), n)
        packed.count()
    finally:
        used.unpersist()
    return Prepared(packed, design, n, mean, spread)


def fit_all_aft(
    df: DataFrame, duration: str = "duration_days", event: str = "is_churned",
    covariates: list[str] | None = None, penalizer: float = 0.0,
) -> dict[str, AftModel]:
    """All three families on one prepared table."""
    return fit_families(df, FAMILIES, duration, event, covariates, penalizer)


def aft_report(models: dict[str, AftModel]) -> DataFrame:
    spark = next(iter(models.values())).spark
    rows = [
        (f"parametric_{f}", m.intercept, m.sigma, m.log_likelihood, m.aic, m.bic, len(m.beta))
        for f, m in models.items()
    ]
    return spark.createDataFrame(
        rows, "model string, intercept double, sigma double, log_likelihood double, aic double, "
        "bic double, n_covariates int",
    )
