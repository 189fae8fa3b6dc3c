"""Covariates that change along the risk sets: rows split at event times, and Cox fits on them.

A row counts at every event time up to its own end, so the work is rows times times. The rows a
split gives are made where they are used and never shuffled: all times stand in every task
(16 bytes each), and rows are dealt out evenly before they are split. A given short list of times
bounds their number.

A fit makes no split rows at all. Rows are packed once, without times; a task weighs a piece of
its rows at all their times as one matrix and keeps sums per time. A Newton step is two such maps:

1. `_time_sums` adds up risk and event sums per time, in chunks of times, over the parts; the
   chunks return their share of likelihood, gradient and information, and the hazards of their times.
2. `_gram` adds the rows' part of the information, for which a row needs three sums over its
   times (hazards times 1, g and g squared).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.functions import scalars as S
from tenurelens.operators import cox
from tenurelens.operators import risksets as R
from tenurelens.operators.design import fit_design, happened, refuse
from tenurelens.operators.partials import SLOT_SCHEMA, collect_slots, columns_of, pack_upper, slot_batch, unpack_upper
from tenurelens.operators.prefix import bucket_count
from tenurelens.operators.ties import tie_sums
from tenurelens.sources.schemas import COX_CATEGORICAL, COX_NUMERIC
from tenurelens.sources.tables import cut_lineage

#: tasks per core that split rows, weights a task holds at once, times in a chunk, weights of a part
TASKS, HELD, CHUNK, PART_WEIGHTS = 4, 1 << 18, 256, 1 << 27

def event_times(df: DataFrame, duration: str = "duration_days", event: str = "is_churned") -> DataFrame:
    """(time, before): distinct times of events, and the one before each (0 for the first)."""
    times = df.where(happened(event) > 0).select(F.col(duration).alias("time")).where(F.col(duration).isNotNull()).distinct()
    return _with_before(times)


def _marks(times: DataFrame) -> list[float]:
    buckets = bucket_count(times.sparkSession)
    share = [k / buckets for k in range(1, buckets)]
    return sorted(set(times.agg(F.percentile_approx(F.col("time").cast("double"), share, 10 * buckets)).first()[0] or []))


def _with_before(times: DataFrame) -> DataFrame:
    marks = _marks(times)
    placed = times.withColumn("_b", S.count_below(F.col("time").cast("double"), marks))
    ends = placed.groupBy("_b").agg(F.max("time").alias("_end"))
    ends = ends.select(
        F.col("_b"), F.last("_end").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried")
    )
    inside = F.lag("time").over(Window.partitionBy("_b").orderBy("time"))
    zero = F.lit(0).cast(times.schema["time"].dataType)
    return placed.withColumn("_near", inside).join(ends, "_b").select("time", F.coalesce("_near", "_carried", zero).alias("before"))


def split_at(df: DataFrame, times: DataFrame, duration: str = "duration_days", event: str = "is_churned") -> DataFrame:
    """One row per row of df and time up to its duration: df's columns, start, stop, happened.

    (start, stop] runs from the time before (`before` of `times`) to the time; `happened` is 1
    where the row's event falls on stop; own columns of these names give way. What lies after the last time is in no risk set and
    left out, and so is a row that ends before the first time or has no duration.
    """
    # one row that holds all times, so it is broadcast
    held = times.agg(F.collect_list(F.struct("time", "before")).alias("_times"))
    # tables of few bytes come in few parts, but the work is in the rows they are split into
    dealt = df.where(F.col(duration).isNotNull()).repartition(
        TASKS * df.sparkSession.sparkContext.defaultParallelism, F.xxhash64(*df.columns)
    )
    met = dealt.crossJoin(F.broadcast(held)).select(*df.columns, F.explode("_times").alias("_time"))
    met = met.where(F.col("_time.time") <= F.col(duration))
    last = (F.col("_time.time") == F.col(duration)) & (happened(event) > 0)
    own = [c for c in df.columns if c not in ("start", "stop", "happened")]
    return met.select(
        *own, F.col("_time.before").alias("start"), F.col("_time.time").alias("stop"), last.cast("int").alias("happened")
    )


def at_times(spark, times: list) -> DataFrame:
    """The (time, before) table of a given list of times."""
    ordered = sorted(set(times))
    kind = "int" if all(isinstance(t, int) for t in ordered) else "double"
    rows = list(zip(ordered, [0, *ordered[:-1]], strict=True))
    return spark.createDataFrame([(t, type(t)(b)) for t, b in rows], f"time {kind}, before {kind}")


@dataclass
class TimeEffects:
    """A Cox model with terms x * g(t); `model` holds all terms, the last ones are the effects."""

    model: cox.CoxModel
    effects: list[str]
    transform: str
    terms: list[str]

    def hazard_ratios(self, alpha: float = 0.05) -> DataFrame:
        return cox.ratio_table(self.model.spark, self.terms, self.model.beta, self.model.covariance, alpha)

    def ratios_at(self, times: list[float]) -> DataFrame:
        """(covariate, time, hazard_ratio): exp(coef + effect * g(time)) of each effect."""
        g = {"log": math.log, "identity": float, "sqrt": math.sqrt}[self.transform]
        base = dict(zip(self.terms, self.model.beta.tolist(), strict=True))
        rows = [
            (c, float(t), math.exp(base.get(c, 0.0) + base[f"{c}*{self.transform}(t)"] * g(t))) for c in self.effects for t in times
        ]
        return self.model.spark.createDataFrame(rows, "covariate string, time double, hazard_ratio double")


class Layout(NamedTuple):
    """Rows without times, longest first in every part: `still` terms of `p` do not move; g of the event times."""

    blocks: DataFrame
    p: int
    still: int
    times: np.ndarray
    g: np.ndarray


BLOCKS = "u binary, e binary, x binary"


def lay_out(rows: DataFrame, p: int, still: int, times: np.ndarray, g: np.ndarray, n_rows: int, parts: int | None = None) -> Layout:
    """Pack rows (stop, event, salt, x0..); the terms from `still` on act times g(time)."""
    spark = rows.sparkSession
    if parts is None:
        parts = max(
            math.ceil(n_rows * 8 * (p + 2) / R.PART_BYTES), math.ceil(n_rows * len(times) / PART_WEIGHTS),
            min(spark.sparkContext.defaultParallelism, math.ceil(n_rows / R.LEAST_ENTRIES)), 1,
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, e = columns_of(batch, ["stop", "event"]).T
            u = np.searchsorted(times, t, "right")
            x = columns_of(batch, R.names("x", p))
            if (kept := np.flatnonzero(u)).size:
                fields = [u[kept].astype(np.int64), np.ascontiguousarray(e[kept]), x[kept]]
                yield pa.record_batch([pa.array([f.tobytes()], pa.binary()) for f in fields], names=["u", "e", "x"])

    ready = rows.select(F.col("stop").cast("double").alias("stop"), "event", "salt", *R.names("x", p))
    blocks = ready.repartition(parts, "salt").mapInArrow(pack, BLOCKS).persist()
    return Layout(blocks, p, still, times, g)


class Rows(NamedTuple):
    """Rows of a part: how many event times they reach, whether an event ends them, and their terms."""

    u: np.ndarray
    e: np.ndarray
    x: np.ndarray


def _read(batches: Iterator[pa.RecordBatch], p: int) -> Rows | None:
    pieces = [
        (np.frombuffer(u.as_buffer(), np.int64), np.frombuffer(e.as_buffer()), np.frombuffer(x.as_buffer()))
        for batch in batches for u, e, x in zip(*[batch.column(c) for c in "uex"], strict=True)
    ]
    if not pieces:
        return None
    u, e, x = (np.concatenate(column) for column in zip(*pieces, strict=True))
    order = np.argsort(-u, kind="stable")
    return Rows(u[order], e[order], x.reshape(len(u), p)[order])


def _weighed(rows: Rows, beta: np.ndarray, still: int, g: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Pieces of the rows with their weights at all times the piece reaches, 0 after a row's own end."""
    fixed, slope = rows.x[:, :still] @ beta[:still], rows.x[:, still:] @ beta[still:]
    at = 0
    while at < len(rows.u):
        longest = int(rows.u[at])
        piece = slice(at, at + max(1, HELD // longest))
        u = rows.u[piece]
        w = np.multiply.outer(slope[piece], g[:longest])
        w += fixed[piece, None]
        np.exp(w, out=w)
        shortest = int(u[-1])
        w[:, shortest:][np.arange(shortest, longest) >= u[:, None]] = 0.0
        yield piece, w
        at = piece.stop


def _events(rows: Rows, beta: np.ndarray, still: int, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Time, count, terms then and weight of the rows that end with an event."""
    on = np.flatnonzero(rows.e)
    k, x = rows.u[on] - 1, rows.x[on].copy()
    x[:, still:] *= g[k, None]
    return k, rows.e[on], x, np.exp(x @ beta)


def _time_sums(layout: Layout, beta: np.ndarray) -> DataFrame:
    """(chunk, payload) of every part: d, e0, e1.., v1.., r0, r1.. of the times of a chunk."""
    _, p, still, _, g = layout

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _read(batches, p)
        if rows is None:
            return
        sums = np.zeros((len(g), 3 + 3 * p))
        with np.errstate(all="ignore"):
            block = np.column_stack([np.ones(len(rows.u)), rows.x])
            for piece, w in _weighed(rows, beta, still, g):
                sums[: w.shape[1], 2 + 2 * p :] += w.T @ block[piece]
            sums[:, 3 + 2 * p + still :] *= g[:, None]
            k, e, x, w = _events(rows, beta, still, g)
            we = e * w
            np.add.at(sums[:, : 2 + 2 * p], k, np.column_stack([e, we, we[:, None] * x, e[:, None] * x]))
        starts = np.arange(0, len(g), CHUNK)
        yield pa.record_batch(
            [pa.array(starts // CHUNK, pa.int32()), pa.array([sums[i : i + CHUNK].tobytes() for i in starts], pa.binary())],
            names=["chunk", "payload"],
        )

    return layout.blocks.mapInArrow(run, "chunk int, payload binary")


def _added(table: pa.Table, p: int) -> tuple[int, np.ndarray]:
    """The chunk's number and its sums over the parts."""
    total = 0.0
    for payload in table.column("payload"):
        total = total + np.frombuffer(payload.as_buffer()).reshape(-1, 3 + 3 * p)
    return table.column("chunk")[0].as_py(), total


def _gram(layout: Layout, beta: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over times of a times the risk set's, less b times the tied events', weighted products of terms."""
    _, p, still, _, g = layout
    powers = np.column_stack([a, a * g, a * g * g])
    half = p * (p + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _read(batches, p)
        if rows is None:
            return
        out = np.zeros((p, p))
        with np.errstate(all="ignore"):
            for piece, w in _weighed(rows, beta, still, g):
                hazard, x = w @ powers[: w.shape[1]], rows.x[piece]
                fixed, moving = x[:, :still], x[:, still:]
                out[:still, :still] += (fixed * hazard[:, :1]).T @ fixed
                out[:still, still:] += (fixed * hazard[:, 1:2]).T @ moving
                out[still:, still:] += (moving * hazard[:, 2:]).T @ moving
            k, e, x, w = _events(rows, beta, still, g)
            out -= (x * (e * w * b[k])[:, None]).T @ x
        yield slot_batch(pack_upper(out))

    return unpack_upper(collect_slots(layout.blocks.mapInArrow(run, SLOT_SCHEMA), half), p)


def _value(layout: Layout, beta: np.ndarray, efron: bool) -> tuple[float, np.ndarray, np.ndarray]:
    p = layout.p

    def shares(table: pa.Table) -> pa.Table:
        chunk, sums = _added(table, p)
        d, e0, e1, v, risk = sums[:, 0], sums[:, 1], sums[:, 2 : 2 + p], sums[:, 2 + p : 2 + 2 * p], sums[:, 2 + 2 * p :]
        with np.errstate(all="ignore"):
            ties = tie_sums(d, risk[:, 0], e0, efron)
            ll, grad, zz = R._time_sums(d, e0, e1, v, risk, ties, beta)
        fields = [np.concatenate([[ll], grad, pack_upper(zz)]), ties[1], ties[2]]
        return pa.table({"chunk": pa.array([chunk], pa.int32())} | {
            c: pa.array([np.ascontiguousarray(f).tobytes()], pa.binary()) for c, f in zip(("sums", "a", "b"), fields, strict=True)
        })

    found = _time_sums(layout, beta).groupBy("chunk").applyInArrow(shares, "chunk int, sums binary, a binary, b binary")
    chunks = sorted(found.collect(), key=lambda r: r["chunk"])
    a, b = (np.concatenate([np.frombuffer(r[c]) for r in chunks]) if chunks else np.zeros(0) for c in "ab")
    total = sum((np.frombuffer(r["sums"]) for r in chunks), np.zeros(1 + p + p * (p + 1) // 2))
    return float(total[0]), total[1 : 1 + p], _gram(layout, beta, a, b) - unpack_upper(total[1 + p :], p)


def evaluate(
    layout: Layout, betas: list[np.ndarray], models: list[int] | None = None, efron: bool = True
) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(log-likelihood, gradient, information) at each of the coefficients."""
    return [_value(layout, beta, efron) for beta in betas]


def risk_table(layout: Layout, beta: np.ndarray, kind: str) -> DataFrame:
    """The sums of every event time, as `cox.risk_table` has them."""
    p, times = layout.p, layout.times
    fields = R.risk_fields(p)

    def rows(table: pa.Table) -> pa.Table:
        chunk, s = _added(table, p)
        t = times[chunk * CHUNK : chunk * CHUNK + len(s)]
        columns = np.column_stack([s[:, 0], s[:, 2 + 2 * p], s[:, 1], s[:, 3 + 2 * p :], s[:, 2 : 2 + 2 * p]])
        return pa.table({"time": pa.array(t)} | {f: pa.array(np.ascontiguousarray(c)) for f, c in zip(fields, columns.T, strict=True)})

    schema = "time double, " + ", ".join(f"{f} double" for f in fields)
    return _time_sums(layout, beta).groupBy("chunk").applyInArrow(rows, schema).withColumn("time", F.col("time").cast(kind))


def fit_time_effects(
    df: DataFrame,
    effects: list[str],
    transform: str = "log",
    duration: str = "duration_days",
    event: str = "is_churned",
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    penalizer: float = 0.1,
    ties: str = "efron",
    max_steps: int = 500,
    parts: int | None = None,
) -> TimeEffects:
    """Cox fit in which each column of `effects` also acts as its z-score times g(time).

    Each event time is a stratum of its own: a row is at risk there with the value its terms have
    at that time. `numeric` and `categorical` are the terms without time; an effect need not be
    among them. The log is taken of positive times only: an event at time 0 or before stops the fit.
    The work is rows times event times; nothing of that size is stored or shuffled.
    """
    if ties not in ("efron", "breslow"):
        raise ValueError("ties must be 'efron' or 'breslow'")
    numeric = COX_NUMERIC if numeric is None else numeric
    categorical = COX_CATEGORICAL if categorical is None else categorical
    used = cox.needed(df, [duration, event, *numeric, *categorical, *effects]).persist()
    layout = None
    try:
        design = fit_design(used, numeric, categorical)
        moving = fit_design(used, effects, [])
        refuse(used, F.col(duration).isNull(), "a null duration")
        if transform == "log":
            refuse(used, (F.col(duration) <= 0) & (happened(event) > 0), "an event at time 0 or before")
        ended = used.where(happened(event) > 0).select(F.col(duration).cast("double").alias("time")).distinct()
        times = np.sort(ended.toArrow().column("time").to_numpy())
        g = {"log": np.log, "identity": np.asarray, "sqrt": np.sqrt}[transform](times)
        n_rows, n_events = used.agg(F.count(F.lit(1)), F.sum(happened(event))).first()
        terms = [*design.terms, *[f"{c}*{transform}(t)" for c in moving.terms]]
        rows = used.select(
            F.col(duration).alias("stop"), happened(event).alias("event"), F.col("_salt").alias("salt"),
            *[c.alias(f"x{k}") for k, c in enumerate([*design.columns(used), *moving.columns(used)])],
        )
        p = len(terms)
        layout = lay_out(rows, p, len(design.terms), times, g, n_rows, parts)
        problem = R.Problem(0.0, np.full(p, float(penalizer)), np.ones(p, bool), np.zeros(p))
        found = R.solve(layout, [problem], ties == "efron", max_steps, evaluate=evaluate)[0]
        risk = cut_lineage(risk_table(layout, found.beta, cox.time_type(df, duration)))
    finally:
        used.unpersist()
        if layout is not None:
            layout.blocks.unpersist()
    fitted = (
        found.beta, np.linalg.pinv(found.information), risk, found.log_likelihood, int(n_rows), int(n_events or 0), found.steps,
    )
    return TimeEffects(cox.build(design, fitted, penalizer, 0.0, ties), moving.terms, transform, terms)


def risk_set_sums(df: DataFrame, values: dict[str, Column], duration: str = "duration_days", event: str = "is_churned") -> DataFrame:
    """Per event time: at_risk, events and the sum of each value over the risk set.

    The values may use `stop`, the time of the risk set.
    """
    episodes = split_at(df, event_times(df, duration, event), duration, event)
    return episodes.groupBy("stop").agg(
        F.count(F.lit(1)).alias("at_risk"), F.sum("happened").cast("bigint").alias("events"),
        *[F.sum(v).alias(name) for name, v in values.items()],
    ).withColumnRenamed("stop", "time")

