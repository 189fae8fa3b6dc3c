"""Cox proportional hazards, static or with (start, stop] rows.

Rows are put into time order once (`risksets`); a Newton step is then two maps over them and
shuffles nothing. Risk sets come from running sums over the times, and the information matrix is
split into a part per time and a part per row, so that no risk set is ever built:

    information = sum_j c_j x_j x_j'  -  sum_t sum_l z z' / phi^2

with, for time t of d tied events and share f = l/d (l = 0..d-1, or f = 0 for Breslow),
phi = S0 - f D0 and z = S1 - f D1, where S and D sum exp(x b) and x exp(x b) over those at
risk and over the tied events, and c_j = w_j (A(stop) - A(start) - event_j B(stop)) with
A(t) = sum_{s<=t} sum_l 1/phi and B(t) = sum_l f/phi. With strata every such sum runs within a
stratum, and each stratum has a baseline of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

from tenurelens.functions import scalars as S
from tenurelens.functions.tails import chi2_tail, normal_quantile, normal_two_sided
from tenurelens.operators import lifetable as LT
from tenurelens.operators.concordance import concordance
from tenurelens.operators.design import LOW_VARIANCE, Design, category_levels, fit_design, happened, refuse
from tenurelens.operators import risksets as R
from tenurelens.operators.asof import asof_join
from tenurelens.operators.partials import SLOT_SCHEMA, collect_slots, columns_of, slot_batch
from tenurelens.operators.prefix import group_sums, running_sums
from tenurelens.operators.ties import tie_sums
from tenurelens.sources.schemas import COX_CATEGORICAL, COX_NUMERIC, HORIZONS
from tenurelens.sources.tables import cut_lineage, read_parquet, write_parquet

FLUSH_TIMES = 100_000
#: buckets of the baseline curve, and copies of each, in the search for medians
CHUNKS, SALTS = 256, 8
#: keys over which rows that no chunk can serve are spread
NOWHERE = 4096


def sum_by_key(keys: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[first], np.add.reduceat(block[order], first, axis=0)


def names(prefix: str, p: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(p)]


def time_type(df: DataFrame, column: str) -> str:
    whole = isinstance(df.schema[column].dataType, (ByteType, ShortType, IntegerType))
    return "int" if whole else "double"


def risk_table(rows: DataFrame, beta: np.ndarray) -> DataFrame:
    """Per time: events d, at-risk sums r0, r*, tied-event sums e0, e*, event sums v*.

    `rows` has stop, event, x* and, for counting-process data, start.
    """
    p = len(beta)
    kind = time_type(rows, "stop")
    timed = "start" in rows.columns
    fields = ["d", "w0", "e0", *names("w", p + 1)[1:], *names("e", p + 1)[1:], *names("v", p + 1)[1:]]
    schema = f"time {kind}, " + ", ".join(f"{f} double" for f in fields)
    arrow_time = pa.int32() if kind == "int" else pa.float64()

    def emit(keys, sums):
        arrays = [pa.array(keys.astype(np.int32 if kind == "int" else np.float64), arrow_time)]
        arrays += [pa.array(np.ascontiguousarray(sums[:, k])) for k in range(sums.shape[1])]
        return pa.RecordBatch.from_arrays(arrays, ["time", *fields])

    def partials(batches):
        keys, sums = np.empty(0), np.empty((0, len(fields)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = columns_of(batch, names("x", p))
            stop, event = columns_of(batch, ["stop", "event"]).T
            w = np.exp(x @ beta)
            e, we = event[:, None], (w * event)[:, None]
            block = np.hstack([e, w[:, None], we, w[:, None] * x, we * x, e * x])
            key = stop
            if timed:
                start = columns_of(batch, ["start"])[:, 0]
                out = np.zeros_like(block)
                out[:, 1] = -w
                out[:, 3 : 3 + p] = -w[:, None] * x
                key, block = np.concatenate([stop, start]), np.vstack([block, out])
            keys, sums = sum_by_key(np.concatenate([keys, key]), np.vstack([sums, block]))
            if len(keys) > FLUSH_TIMES:
                yield emit(keys, sums)
                keys, sums = np.empty(0), np.empty((0, len(fields)))
        if len(keys):
            yield emit(keys, sums)

    by_time = group_sums(rows.mapInArrow(partials, schema), ["time"], {f: f for f in fields})
    at_risk = {f"r{k}": f"w{k}" for k in range(p + 1)}
    table = running_sums(by_time, "time", at_risk, descending=True)
    return table.drop(*names("w", p + 1))


def ratio_table(spark: SparkSession, terms: list[str], beta, covariance, alpha: float) -> DataFrame:
    """One row per term: coefficient, hazard ratio, deviation, Wald p-value and limits."""
    z = normal_quantile(1 - alpha / 2)
    rows = []
    for k, term in enumerate(terms):
        b, se = float(beta[k]), float(math.sqrt(max(covariance[k, k], 0.0)))
        p = normal_two_sided(b / se) if se > 0 else None
        rows.append((term, b, math.exp(b), se, p, b - z * se, b + z * se))
    return spark.createDataFrame(
        rows,
        "covariate string, coef double, hazard_ratio double, se double, p double, "
        f"`coef_lower_{100 * (1 - alpha):g}` double, `coef_upper_{100 * (1 - alpha):g}` double",
    )


@dataclass
class CoxModel:
    design: Design
    beta: np.ndarray
    covariance: np.ndarray
    baseline: DataFrame
    log_likelihood: float = float("nan")
    n_rows: int = 0
    n_events: int = 0
    steps: int = 0
    penalizer: float = 0.1
    l1_ratio: float = 0.0
    ties: str = "efron"
    risk: DataFrame | None = None
    strata: str | None = None

    # -- parameters

    def params(self) -> dict:
        return {
            "model_type": "cox_ph", "penalizer": self.penalizer, "l1_ratio": self.l1_ratio,
            "baseline_estimation_method": "breslow", "n_covariates": len(self.beta),
        }

    def hazard_ratios(self, alpha: float = 0.05) -> DataFrame:
        return ratio_table(self.spark, self.design.terms, self.beta, self.covariance, alpha)

    def top_hazard_ratios(self, n: int = 20) -> DataFrame:
        """The n largest coefficients, ties kept."""
        ratios = self.hazard_ratios()
        cut = ratios.orderBy(F.desc("coef")).limit(n).agg(F.min("coef")).scalar()
        return ratios.where(F.col("coef") >= cut).orderBy(F.desc("coef"))

    @property
    def spark(self) -> SparkSession:
        return self.baseline.sparkSession

    # -- prediction: plain column expressions

    def partial_hazard(self, df: DataFrame) -> Column:
        return F.exp(self.design.linear(df, self.beta))

    def baseline_at(self, horizons, how: str = "nearest") -> dict[float, float]:
        """Baseline cumulative hazard at a few horizons."""
        if self.strata is not None:
            raise ValueError("a stratified model has one baseline per stratum: use baselines_at")
        row = self.baselines_at(horizons, how).first()
        return dict(zip(horizons, row))

    def baselines_at(self, horizons, how: str = "nearest") -> DataFrame:
        """h0, h1, ...: baseline cumulative hazard at the horizons, one row (per stratum)."""
        pick = LT.nearest_value if how == "nearest" else LT.step_value
        groups = [] if self.strata is None else [self.strata]
        return self.baseline.groupBy(*groups).agg(
            *[pick("cum_hazard", h).alias(f"h{k}") for k, h in enumerate(horizons)]
        )

    def survival_columns(
        self, df: DataFrame, horizons=HORIZONS, how: str = "nearest", hazard: Column | None = None
    ) -> list[Column]:
        hazard = self.partial_hazard(df) if hazard is None else hazard
        return [
            F.exp(-F.lit(float(h0)) * hazard).alias(f"survival_prob_{h:g}d")
            for h, h0 in self.baseline_at(horizons, how).items()
        ]

    def with_survival(
        self, df: DataFrame, horizons=HORIZONS, how: str = "nearest", hazard: Column | None = None
    ) -> DataFrame:
        """The rows with one survival column per horizon; null for a stratum the fit did not have."""
        if self.strata is None:
            return df.select("*", *self.survival_columns(df, horizons, how, hazard))
        hazard = self.partial_hazard(df) if hazard is None else hazard
        mine = self.baselines_at(horizons, how).select(
            F.col(self.strata).alias("_stratum"), *[F.col(f"h{k}").alias(f"_h{k}") for k in range(len(horizons))]
        )
        met = df.join(mine, F.col(self.strata).eqNullSafe(F.col("_stratum")), "left")
        return met.select(
            *df.columns,
            *[F.exp(-F.col(f"_h{k}") * hazard).alias(f"survival_prob_{h:g}d") for k, h in enumerate(horizons)],
        )

    def survival_at_horizons(
        self, df: DataFrame, horizons=HORIZONS, id_col: str = "customer_id", how: str = "nearest"
    ) -> DataFrame:
        ids = [id_col] if id_col in df.columns else []
        groups = [F.col(self.strata).alias(self.strata)] if self.strata is not None else []
        ready = df.select(*[c for c in ids if c != self.strata], *groups, self.partial_hazard(df).alias("_hazard"))
        wanted = [f"survival_prob_{h:g}d" for h in horizons]
        return self.with_survival(ready, horizons, how, F.col("_hazard")).select(*ids, *wanted)

    def with_median(
        self, df: DataFrame, out: str = "median_survival_days", id_col: str = "customer_id",
        hazard: Column | None = None, chunks: int = CHUNKS, salts: int = SALTS,
    ) -> DataFrame:
        """The smallest time with S <= 1/2, infinite when the curve stays above.

        Rows that need more hazard than the whole curve has are infinite at once. The others
        meet one chunk of the curve, a sorted array, and search it; chunks are copied per salt,
        so that a chunk many rows need is met in several places. Rows need no id. Rows of a
        stratified model search the curve of their stratum by an as-of join; a stratum the fit
        did not have gives null.
        """
        if self.strata is not None:
            return self._with_median_by_stratum(df, out, hazard)
        needed = F.lit(math.log(2.0)) / (self.partial_hazard(df) if hazard is None else hazard)
        rising = self.baseline.where(F.col("hazard") > 0).select(
            F.col("cum_hazard").alias("h"), F.col("time").cast("double").alias("t")
        )
        share = [k / chunks for k in range(1, chunks)]
        marks, top = rising.agg(F.percentile_approx("h", share, 10 * chunks), F.max("h")).first()
        ready = df.withColumn("_needed", needed)
        if top is None:
            return ready.drop("_needed").withColumn(out, F.lit(float("inf")))
        ends = sorted(set(marks))
        parts = rising.groupBy(S.count_below(F.col("h"), ends).alias("_part")).agg(
            F.sort_array(F.collect_list(F.struct("h", "t"))).alias("_steps")
        )
        longest = parts.agg(F.max(F.size("_steps"))).first()[0]
        copies = parts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
            "_part", "_salt", F.col("_steps.h").alias("_h"), F.col("_steps.t").alias("_t")
        )
        reachable = F.col("_needed") <= F.lit(float(top))
        spread = F.xxhash64("_needed", F.monotonically_increasing_id())
        placed = ready.withColumn("_spread", spread).withColumn(
            # rows out of reach meet no chunk; keys of many values keep them from a few tasks
            "_part",
            F.when(reachable, S.count_below(F.col("_needed"), ends)).otherwise(
                (-1 - F.pmod("_spread", F.lit(NOWHERE))).cast("int")
            ),
        ).withColumn("_salt", F.pmod("_spread", F.lit(salts)).cast("int"))
        found = F.get("_t", S.count_below_in(F.col("_needed"), F.col("_h"), longest))
        return placed.join(copies, on=["_part", "_salt"], how="left").withColumn(
            out, F.coalesce(found, F.lit(float("inf")))
        ).drop("_part", "_salt", "_spread", "_needed", "_h", "_t")

    def _with_median_by_stratum(self, df: DataFrame, out: str, hazard: Column | None) -> DataFrame:
        needed = F.lit(math.log(2.0)) / (self.partial_hazard(df) if hazard is None else hazard)
        rising = self.baseline.where(F.col("hazard") > 0).select(
            self.strata, "cum_hazard", F.col("time").cast("double").alias("_median")
        )
        known = self.baseline.select(F.col(self.strata).alias("_stratum"), F.lit(True).alias("_known")).distinct()
        met = asof_join(
            df.withColumn("_needed", needed), rising, "_needed", "cum_hazard", ["_median"], [self.strata], "forward"
        ).join(known, F.col(self.strata).eqNullSafe(F.col("_stratum")), "left")
        median = F.when(F.col("_known"), F.coalesce("_median", F.lit(float("inf"))))
        return met.withColumn(out, median).select(*[c for c in df.columns if c != out], out)

    def with_risk(self, df: DataFrame, horizon: float = 90, out: str = "risk") -> DataFrame:
        if self.strata is None:
            return df.withColumn(out, 1.0 - self.survival_columns(df, (horizon,))[0])
        survival = f"survival_prob_{horizon:g}d"
        own = df.drop(survival)
        scored = self.with_survival(own, (horizon,)).withColumn(out, 1.0 - F.col(survival)).select(*own.columns, out)
        return scored

    def concordance_index(
        self, df: DataFrame, duration: str = "duration_days", event: str = "is_churned", horizon: float = 90
    ) -> float | None:
        scored = self.with_risk(df, horizon).select("risk", duration, event)
        return concordance(scored, "risk", duration, event)["c_index"]

    # -- proportional-hazards test

    def ph_test(self, p_limit: float = 0.05) -> DataFrame:
        """Schoenfeld residuals of the training rows against the rank of event time.

        Tied events share their mean rank.
        """
        if self.risk is None:
            raise RuntimeError("the test needs the model as fitted, not one read back")
        p = len(self.beta)
        efron = self.ties == "efron"
        if self.strata is None:
            ranked = running_sums(self.risk, "time", {"so_far": "d"}, totals=True).withColumn("tied", F.col("d"))
        else:
            # events of one time share a rank whatever their stratum
            times = group_sums(self.risk, ["time"], {"tied": "d"})
            ranked = self.risk.join(running_sums(times, "time", {"so_far": "tied"}, totals=True), "time")

        def sums(batches):
            total = np.zeros(p + 1)
            for batch in batches:
                d, s0, e0, so_far, n = columns_of(batch, ["d", "r0", "e0", "so_far", "so_far_total"]).T
                tied = columns_of(batch, ["tied"])[:, 0]
                s1 = columns_of(batch, names("r", p + 1)[1:])
                e1 = columns_of(batch, names("e", p + 1)[1:])
                v = columns_of(batch, names("v", p + 1)[1:])
                _, a, b, *_ = tie_sums(d, s0, e0, efron)
                residual = v - (s1 * a[:, None] - e1 * b[:, None])
                g = so_far - (tied - 1) / 2.0 - (n + 1) / 2.0
                total[:p] += (residual * g[:, None])[d > 0].sum(axis=0)
                total[p] += float((d * g * g).sum())
            yield slot_batch(total)

        slots = collect_slots(ranked.mapInArrow(sums, SLOT_SCHEMA), p + 1)
        scaled = self.covariance @ slots[:p]
        rows = []
        for k, term in enumerate(self.design.terms):
            spread = slots[p] * self.covariance[k, k]
            stat = float(self.n_events * scaled[k] ** 2 / spread) if spread > 0 else None
            pv = None if stat is None else chi2_tail(stat, 1)
            rows.append((term, stat, pv, None if pv is None else pv < p_limit))
        return self.spark.createDataFrame(
            rows, "covariate string, test_statistic double, p double, violates_ph boolean"
        )

    # -- storage: two tables

    def save(self, path: str) -> None:
        rows, terms = [], self.design.terms
        for k, (c, mean, std) in enumerate(self.design.numeric):
            rows.append((k, terms[k], "numeric", c, None, mean, std, float(self.beta[k])))
        for k, (c, level) in enumerate(self.design.levels, len(self.design.numeric)):
            rows.append((k, terms[k], "level", c, level, None, None, float(self.beta[k])))
        covariance = [row.tolist() for row in self.covariance]
        rows = [
            (*r, covariance[r[0]], self.penalizer, self.l1_ratio, self.ties, self.log_likelihood,
             self.n_rows, self.n_events)
            for r in rows
        ]
        coefficients = self.spark.createDataFrame(
            rows,
            "position int, term string, kind string, source string, level string, mean double, "
            "std double, coef double, covariance array<double>, penalizer double, l1_ratio double, "
            "ties string, log_likelihood double, n_rows bigint, n_events bigint",
        ).withColumn("strata", F.lit(self.strata).cast("string"))
        write_parquet(coefficients.coalesce(1), f"{path}/coefficients")
        write_parquet(self.baseline, f"{path}/baseline")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CoxModel":
        rows = sorted(read_parquet(spark, f"{path}/coefficients").collect(), key=lambda r: r["position"])
        design = Design(
            [(r["source"], r["mean"], r["std"]) for r in rows if r["kind"] == "numeric"],
            [(r["source"], r["level"]) for r in rows if r["kind"] == "level"],
        )
        first = rows[0]
        return cls(
            design, np.array([r["coef"] for r in rows]),
            np.array([r["covariance"] for r in rows]), read_parquet(spark, f"{path}/baseline"),
            first["log_likelihood"], first["n_rows"], first["n_events"], 0,
            first["penalizer"], first["l1_ratio"], first["ties"], strata=first["strata"],
        )


def breslow_baseline(risk: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """(time, hazard, cum_hazard, survival) from a risk table, starting at time 0.

    With the numbers of strata, one curve per stratum and its column first.
    """
    groups = () if numbers is None else ("g",)
    step = F.when(F.col("d") > 0, F.col("d") / F.col("r0")).otherwise(0.0).alias("hazard")
    steps = risk.select(*groups, "time", step)
    curve = running_sums(steps, "time", {"cum_hazard": "hazard"}, groups)
    kind = curve.schema["time"].dataType
    origin = steps.groupBy(*groups).agg(F.min("time").alias("_first")).where(F.col("_first") > 0).select(
        *groups, F.lit(0).cast(kind).alias("time"), F.lit(0.0).alias("hazard"), F.lit(0.0).alias("cum_hazard")
    )
    curve = curve.unionByName(origin).withColumn("survival", F.exp(-F.col("cum_hazard")))
    if numbers is None:
        return curve
    name = next(c for c in numbers.columns if c != "g")
    return curve.join(numbers, "g").select(name, *[c for c in curve.columns if c != "g"])


def fit_rows(
    rows: DataFrame, p: int, penalizer: float = 0.1, l1_ratio: float = 0.0, ties: str = "efron",
    penalty: str = "sum", max_steps: int = 500, tolerance: float = 1e-7, max_halvings: int = 30,
    first: np.ndarray | None = None, parts: int | None = None,
):
    """Newton iterations over prepared rows (stop, event, x*[, start, g]), from 0 or from `first`."""
    if ties not in ("efron", "breslow"):
        raise ValueError("ties must be 'efron' or 'breslow'")
    kind = time_type(rows, "stop")
    layout = R.lay_out(rows, p, parts=parts)
    try:
        strength = penalizer * (layout.n_rows[0] if penalty == "mean" else 1.0)
        begin = np.zeros(p) if first is None or len(first) != p else np.array(first, dtype=float)
        problem = R.Problem(strength * l1_ratio, np.full(p, strength * (1.0 - l1_ratio)), np.ones(p, bool), begin)
        found = R.solve(layout, [problem], ties == "efron", max_steps, tolerance, max_halvings)[0]
        risk = R.risk_tables(layout, [found.beta]).drop("model", *([] if "g" in rows.columns else ["g"]))
        kept = cut_lineage(risk.withColumn("time", F.col("time").cast(kind)))
    finally:
        layout.drop()
    return (
        found.beta, np.linalg.pinv(found.information), kept, found.log_likelihood,
        layout.n_rows[0], layout.n_events[0], found.steps,
    )


def build(design, fitted, penalizer, l1_ratio, ties, strata=None, numbers=None) -> CoxModel:
    beta, covariance, risk, ll, n_rows, n_events, taken = fitted
    baseline = cut_lineage(breslow_baseline(risk, numbers))
    return CoxModel(
        design, beta, covariance, baseline, ll, n_rows, n_events, taken, penalizer, l1_ratio, ties, risk, strata
    )


def needed(df: DataFrame, columns, id_col: str = "customer_id") -> DataFrame:
    """The columns a fit reads, once each, and a hash that tells rows of one day apart."""
    have = list(dict.fromkeys(c for c in columns if c in df.columns))
    told = [id_col] if id_col in df.columns else []
    return df.select(*have, F.xxhash64(*dict.fromkeys([*told, *have])).alias("_salt"))


def with_strata(df: DataFrame, strata: str | None) -> tuple[list[Column], DataFrame | None]:
    """The column that numbers the strata, and the table of numbers."""
    if strata is None:
        return [], None
    numbers, seed = R.stratum_numbers(df, strata)
    return [F.xxhash64(F.lit(seed), F.col(strata)).alias("g")], cut_lineage(numbers)


def fit_cox(
    df: DataFrame,
    duration: str = "duration_days",
    event: str = "is_churned",
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    penalizer: float = 0.1,
    l1_ratio: float = 0.0,
    ties: str = "efron",
    penalty: str = "sum",
    max_steps: int = 500,
    first: "CoxModel | None" = None,
    strata: str | None = None,
    parts: int | None = None,
) -> CoxModel:
    """Fit on one row per subject. The ridge weight applies to the summed likelihood
    (`penalty="sum"`) or to the mean one (`penalty="mean"`). A model of the same terms given
    as `first` is where the iterations begin. With `strata` rows are at risk only with rows of
    the same value of that column (null is one of them), and every value has its own baseline.
    Rows that the caller keeps (`persist`) are read there and not kept a second time.
    `parts` sets the number of parts the rows are laid out in."""
    numeric = COX_NUMERIC if numeric is None else numeric
    categorical = COX_CATEGORICAL if categorical is None else categorical
    used = needed(df, [duration, event, *numeric, *categorical, *([] if strata is None else [strata])])
    if not df.is_cached:
        used.persist()
    try:
        design = fit_design(used, [c for c in numeric if c != strata], [c for c in categorical if c != strata])
        number, numbers = with_strata(used, strata)
        keep = [F.col(duration).alias("stop"), happened(event).alias("event"), *number, F.col("_salt").alias("salt")]
        rows = design.matrix(used, keep)
        known_terms = first is not None and first.design.terms == design.terms
        refuse(rows, F.col("stop").isNull(), "a null duration")
        fitted = fit_rows(
            rows, len(design.terms), penalizer, l1_ratio, ties, penalty, max_steps,
            first=first.beta if known_terms else None, parts=parts,
        )
    finally:
        if used.is_cached:
            used.unpersist()
    return build(design, fitted, penalizer, l1_ratio, ties, strata, numbers)


def score_vector(
    model: CoxModel, df: DataFrame, duration: str = "duration_days", event: str = "is_churned"
) -> np.ndarray:
    """The gradient of the log partial likelihood of df at the model's coefficients, without penalty.

    It is summed over a table per time (`risk_table`) and shares nothing with the laid-out rows
    of the fit, so it can check one. Not for strata.
    """
    p, efron = len(model.beta), model.ties == "efron"
    rows = model.design.matrix(df, [F.col(duration).alias("stop"), happened(event).alias("event")])

    def sums(batches):
        total = np.zeros(p)
        for batch in batches:
            d, s0, e0 = columns_of(batch, ["d", "r0", "e0"]).T
            s1, e1, v = (columns_of(batch, names(c, p + 1)[1:]) for c in "rev")
            _, a, b, *_ = tie_sums(d, s0, e0, efron)
            total += v.sum(0) - a @ s1 + b @ e1
        yield slot_batch(total)

    return collect_slots(risk_table(rows, model.beta).mapInArrow(sums, SLOT_SCHEMA), p)


@dataclass
class Folds:
    """Models that left out one fold each, over one design; `scale` is their own deviation over its."""

    design: Design
    betas: np.ndarray
    baseline_hazard: list[float]
    n_rows: list[int]
    steps: list[int]

    def held_out_risk(self, df: DataFrame, fold: str = "fold") -> Column:
        """1 - S(horizon) of every row by the model that did not see its fold."""
        own = [F.get(F.array(*[F.lit(float(b)) for b in column]), F.col(fold)) for column in self.betas.T]
        linear = sum((w * x for w, x in zip(own, self.design.columns(df), strict=True)), F.lit(0.0))
        base = F.get(F.array(*[F.lit(float(h)) for h in self.baseline_hazard]), F.col(fold))
        return 1.0 - F.exp(-base * F.exp(linear))


def fold_designs(df: DataFrame, k: int, numeric: list[str], categorical: list[str], fold: str = "fold"):
    """The design of all rows, and per fold's training rows the terms it has and their scale.

    A model of a fold would standardise by the deviation of its own rows and leave out what is
    constant in them. In the terms of the common design that is a factor on its penalty, and a
    coefficient that stays 0.
    """
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    design = fit_design(df, numeric, categorical)
    scale, active = np.ones((k, len(design.terms))), np.zeros((k, len(design.terms)), bool)
    if design.numeric:
        spread = df.agg(*[
            F.stddev_samp(F.when(F.col(fold) != m, S.finite_or_zero(F.col(c)))) for m in range(k) for c, _, _ in design.numeric
        ]).first()
        own = np.array([0.0 if v is None else v for v in spread]).reshape(k, len(design.numeric))
        active[:, : len(design.numeric)] = own > LOW_VARIANCE
        scale[:, : len(design.numeric)] = own / np.array([std for _, _, std in design.numeric])
    if design.levels:
        columns = sorted({c for c, _ in design.levels})
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
        seen = {
            (r["c"], r["v"]): set(r["folds"])
            for r in df.select(fold, pairs.alias("p")).where(F.col("p.v").isNotNull())
            .groupBy("p.c", "p.v").agg(F.collect_set(fold).alias("folds")).collect()
        }
        order = category_levels(df, columns)
        for m in range(k):
            for c in columns:
                # a level is among the training rows if any other fold has it; the first one is the base
                there = [v for v in order[c] if seen.get((c, v), set()) - {m}]
                for n, (column, level) in enumerate(design.levels, len(design.numeric)):
                    if column == c:
                        active[m, n] = level in there[1:]
    return design, scale, active


def fit_cox_folds(
    df: DataFrame, k: int, duration: str = "duration_days", event: str = "is_churned", numeric=None,
    categorical=None, penalizer: float = 0.1, l1_ratio: float = 0.0, ties: str = "efron", penalty: str = "sum",
    max_steps: int = 500, horizon: float = 90, how: str = "nearest", fold: str = "fold", parts: int | None = None,
) -> Folds:
    """The k models that leave out the rows of one fold each, fitted side by side.

    `fold` is 0..k-1. Rows are laid out once, and one Newton round of all models is one pass.
    """
    numeric = COX_NUMERIC if numeric is None else numeric
    categorical = COX_CATEGORICAL if categorical is None else categorical
    used = needed(df, [duration, event, fold, *numeric, *categorical]).persist()
    layout = None
    try:
        design, scale, active = fold_designs(used, k, numeric, categorical, fold)
        p = len(design.terms)
        keep = [F.col(duration).alias("stop"), happened(event).alias("event"), F.col(fold).alias("fold"), F.col("_salt").alias("salt")]
        rows = design.matrix(used, keep)
        refuse(rows, F.col("stop").isNull(), "a null duration")
        refuse(rows, ~F.coalesce(F.col("fold").between(0, k - 1), F.lit(False)), "no fold")
        layout = R.lay_out(rows, p, folds=k, parts=parts)
        problems = []
        for m in range(k):
            strength = penalizer * (layout.n_rows[m] if penalty == "mean" else 1.0)
            problems.append(R.Problem(
                strength * l1_ratio * scale[m], strength * (1 - l1_ratio) * scale[m] ** 2, active[m], np.zeros(p)
            ))
        found = R.solve(layout, problems, ties == "efron", max_steps)
        risk = R.risk_tables(layout, [s.beta for s in found])
        step = F.when(F.col("d") > 0, F.col("d") / F.col("r0")).otherwise(0.0).alias("hazard")
        # times of left-out rows stand on the curves as well, with hazard 0
        curve = running_sums(risk.select("model", "time", step), "time", {"cum_hazard": "hazard"}, ("model",))
        pick = LT.nearest_value if how == "nearest" else LT.step_value
        at = dict(curve.groupBy("model").agg(pick("cum_hazard", horizon)).collect())
    finally:
        used.unpersist()
        if layout is not None:
            layout.drop()
    return Folds(
        design, np.stack([s.beta for s in found]), [at.get(m) or 0.0 for m in range(k)], layout.n_rows,
        [s.steps for s in found],
    )


def fit_cox_intervals(
    df: DataFrame,
    covariates: list[str] | None = None,
    start: str = "start",
    stop: str = "stop",
    event: str = "is_churned",
    penalizer: float = 0.1,
    l1_ratio: float = 0.0,
    ties: str = "efron",
    penalty: str = "sum",
    max_steps: int = 500,
    standardise: bool = True,
    strata: str | None = None,
    parts: int | None = None,
) -> CoxModel:
    """Fit on counting-process rows (start, stop]; covariates may differ between rows."""
    covariates = covariates or [c for c in COX_NUMERIC if c in df.columns]
    kind = time_type(df, stop)
    used = needed(df, [start, stop, event, *covariates, *([] if strata is None else [strata])]).persist()
    try:
        design = fit_design(used, covariates, []) if standardise else Design([(c, 0.0, 1.0) for c in covariates])
        number, numbers = with_strata(used, strata)
        rows = design.matrix(
            used,
            [F.col(start).cast(kind).alias("start"), F.col(stop).cast(kind).alias("stop"),
             happened(event).alias("event"), *number, F.col("_salt").alias("salt")],
        )
        broken = F.col("start").isNull() | F.col("stop").isNull() | (F.col("start") >= F.col("stop"))
        refuse(rows, broken, "an interval that does not end after its start")
        fitted = fit_rows(rows, len(design.terms), penalizer, l1_ratio, ties, penalty, max_steps, parts=parts)
    finally:
        used.unpersist()
    return build(design, fitted, penalizer, l1_ratio, ties, strata, numbers)


def fixed_model(
    df: DataFrame, design: Design, beta, duration: str = "duration_days", event: str = "is_churned",
    strata: str | None = None, parts: int | None = None,
) -> CoxModel:
    """Given coefficients with the Breslow baseline of the given rows, one per value of `strata`."""
    beta = np.asarray(beta, dtype=float)
    if strata is not None:
        columns = [c for c, *_ in (*design.numeric, *design.levels)]
        used = needed(df, [duration, event, strata, *columns])
        number, numbers = with_strata(used, strata)
        keep = [F.col(duration).alias("stop"), happened(event).alias("event"), *number, F.col("_salt").alias("salt")]
        rows = design.matrix(used, keep)
        layout = R.lay_out(rows, len(beta), parts=parts)
        try:
            risk = R.risk_tables(layout, [beta]).withColumn("time", F.col("time").cast(time_type(rows, "stop")))
            baseline = cut_lineage(breslow_baseline(risk, numbers))
        finally:
            layout.drop()
        return CoxModel(design, beta, np.zeros((len(beta), len(beta))), baseline, strata=strata)
    rows = design.matrix(df, [F.col(duration).alias("stop"), happened(event).alias("event")])
    baseline = cut_lineage(breslow_baseline(risk_table(rows, beta)))
    return CoxModel(design, beta, np.zeros((len(beta), len(beta))), baseline)
