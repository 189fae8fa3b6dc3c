"""Sums over risk sets from rows that were put into time order once.

`lay_out` sorts the rows by (stratum, time) into parts of bounded size: one range shuffle on
(stratum, time, hash of the row), so that a day on which a third of all rows end is cut as well.
A part keeps its rows as blocks of packed numbers. After that nothing is shuffled any more:

1. `_ends` sums each part: its first and its last (stratum, time), which neighbours may share,
   and what lies between. The driver merges shared times and carries the sums backwards, so that
   it knows the risk sums at every shared time and what each part has to add to its own.
2. `_insides` turns a part into its share of likelihood, gradient and information. Hazards
   before the part are not known there yet, so it also returns the matrix they go with.

Both passes are maps over the parts; the driver sees a few sums per part and model. Several
models may be fitted side by side: model m leaves out the rows whose `fold` is m.

A row counts for the times t with start < t <= stop. Without starts it is one entry; with
starts it is an entry at stop and one of opposite sign at start, as S(t) sums entries from t on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurelens.operators.partials import columns_of, pack_upper, unpack_upper
from tenurelens.operators.ties import tie_sums

#: packed rows of a part: of other fits, and of a layout
PART_BYTES = 16 << 20
LAYOUT_BYTES = 64 << 20
#: a block of a part, and an Arrow batch of blocks: larger ones are copied from fresh memory each time they are read
BLOCK_BYTES = 256 << 10
BATCH_BYTES = 1 << 20
LEAST_ENTRIES = 4096
#: entries whose products stay in a core's cache
STRIPE = 2048
EVERY = -1

BLOCKS = "part int, seq int, g binary, t binary, e binary, s binary, f binary, x binary"


class Layout(NamedTuple):
    """Entries in time order: p terms a row, `models` to be fitted, the number of rows and events of each."""

    blocks: DataFrame
    p: int
    models: int
    n_rows: list[int]
    n_events: list[int]

    def drop(self) -> None:
        self.blocks.unpersist()


class Entries(NamedTuple):
    """The entries of a part: stratum, time, event, sign, fold and terms."""

    g: np.ndarray
    t: np.ndarray
    e: np.ndarray
    s: np.ndarray
    f: np.ndarray
    x: np.ndarray


def names(prefix: str, p: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(p)]


def part_count(size: int, entries: int, cores: int) -> int:
    """Parts of LAYOUT_BYTES at most, as whole rounds of tasks: every pass pays for each of its rounds."""
    parts = max(math.ceil(size / LAYOUT_BYTES), min(cores, math.ceil(entries / LEAST_ENTRIES)), 1)
    return parts if parts <= cores else cores * math.ceil(parts / cores)


def lay_out(rows: DataFrame, p: int, folds: int = 0, parts: int | None = None) -> Layout:
    """Put rows (stop, event, x0.., and where wanted start, g, fold, salt) into time order.

    `g` numbers the strata, `fold` 0..folds-1 says which model a row is kept from, `salt` is any
    hash that spreads rows of one time. The caller drops the layout when done.
    """
    spark = rows.sparkSession
    have = set(rows.columns)
    ready = rows.select(
        (F.col("g").cast("long") if "g" in have else F.lit(0).cast("long")).alias("g"),
        F.col("stop").cast("double").alias("t"),
        F.col("event").cast("double").alias("e"),
        *([F.col("start").cast("double").alias("start")] if "start" in have else []),
        (F.col("fold").cast("int") if folds else F.lit(EVERY)).alias("f"),
        (F.col("salt") if "salt" in have else F.xxhash64(*rows.columns)).alias("salt"),
        *names("x", p),
    )
    kept = [(F.col("f") != m) for m in range(folds)] or [F.lit(True)]
    counts = ready.agg(
        F.min(F.when(F.col("e") > 0, F.col("t"))),
        *[F.count_if(k) for k in kept],
        *[F.coalesce(F.sum(F.when(k, F.col("e"))), F.lit(0.0)) for k in kept],
    ).first()
    first_event, n_rows, n_events = counts[0], list(counts[1 : 1 + len(kept)]), [int(c) for c in counts[1 + len(kept) :]]
    entries = ready.withColumn("s", F.lit(1.0))
    if "start" in have:
        # a start before the first event belongs to no risk set
        opened = ready.where(F.col("start") >= F.lit(first_event)).withColumn("t", F.col("start"))
        opened = opened.withColumn("e", F.lit(0.0)).withColumn("s", F.lit(-1.0))
        entries = entries.unionByName(opened)
    if parts is None:
        size = max(counts[1 : 1 + len(kept)]) * (2 if "start" in have else 1)
        parts = part_count(size * 8 * (p + 5), size, spark.sparkContext.defaultParallelism)
    ordered = entries.repartitionByRange(parts, "g", "t", "salt").sortWithinPartitions("g", "t")

    height = max(BLOCK_BYTES // (8 * (p + 5)), 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            fields = [batch.column("g").to_numpy(), *[columns_of(batch, [c])[:, 0] for c in ("t", "e", "s")]]
            fields += [columns_of(batch, ["f"])[:, 0].astype(np.int32), columns_of(batch, names("x", p))]
            for i in range(0, batch.num_rows, height):
                yield pa.record_batch(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                     *[pa.array([f[i : i + height].tobytes()], pa.binary()) for f in fields]],
                    names=["part", "seq", "g", "t", "e", "s", "f", "x"],
                )
                seq += 1

    blocks = ordered.select("g", "t", "e", "s", "f", *names("x", p)).mapInArrow(pack, BLOCKS).persist()
    return Layout(blocks, p, max(folds, 1), n_rows, n_events)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_BYTES, or of a lower limit that is set, for the jobs run inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    limit = before.lower().rstrip("b")
    if limit.lstrip("-").isdigit() and 0 < int(limit) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _read(batches: Iterator[pa.RecordBatch], p: int) -> tuple[int, Entries] | None:
    """The part's number and its entries."""
    pieces, part = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.column("part")[i].as_py()
            g, t, e, s, x = (
                np.frombuffer(batch.column(c)[i].as_buffer(), np.int64 if c == "g" else np.float64) for c in "gtesx"
            )
            f = np.frombuffer(batch.column("f")[i].as_buffer(), np.int32)
            pieces.append((batch.column("seq")[i].as_py(), g, t, e, s, f, x.reshape(len(g), p)))
    if not pieces:
        return None
    pieces.sort(key=lambda piece: piece[0])
    if len(pieces) == 1:
        return part, Entries(*pieces[0][1:])
    return part, Entries(*[np.concatenate([piece[k] for piece in pieces]) for k in range(1, 7)])


class Cuts(NamedTuple):
    """Where the first time of a part ends, the last begins, and the strata between them change."""

    first: int
    last: int
    stratum_end: int
    stratum_begin: int


def _cuts(rows: Entries) -> Cuts:
    n = len(rows.g)
    first_key = (rows.g == rows.g[0]) & (rows.t == rows.t[0])
    first = n if first_key.all() else int(np.argmin(first_key))
    last_key = (rows.g == rows.g[-1]) & (rows.t == rows.t[-1])
    last = n if first == n else n - int(np.argmin(last_key[::-1])) if not last_key.all() else 0
    # strata are sorted, so both ends of a stratum are found by search
    end = min(int(np.searchsorted(rows.g, rows.g[0], "right")), last)
    begin = max(int(np.searchsorted(rows.g, rows.g[-1], "left")), first)
    return Cuts(first, last, max(end, first), min(begin, last))


def _weights(rows: Entries, beta: np.ndarray, model: int) -> tuple[np.ndarray, np.ndarray]:
    """Signed weights and events of the entries, 0 for those the model leaves out."""
    with np.errstate(over="ignore", invalid="ignore"):
        kept = (rows.f != model).astype(float)
        return np.exp(rows.x @ beta) * rows.s * kept, rows.e * kept


def _key_sums(rows: Entries, w: np.ndarray, e: np.ndarray, where: slice) -> np.ndarray:
    """d, e0, e1.., v1.., r0, r1.. of the entries of one time (risk sums of these entries only)."""
    w, e, x = w[where], e[where], rows.x[where]
    we = w * e
    return np.concatenate([[e.sum(), we.sum()], we @ x, e @ x, [w.sum()], w @ x])


def _risk_sums(rows: Entries, w: np.ndarray, where: slice) -> np.ndarray:
    return np.concatenate([[w[where].sum()], w[where] @ rows.x[where]])


ENDS = "part int, g_first long, t_first double, g_last long, t_last double, one boolean, payload binary"


def _ends(layout: Layout, betas, models: list[int]) -> DataFrame:
    p = layout.p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _read(batches, p)
        if got is None:
            return
        part, rows = got
        cut = _cuts(rows)
        sums = []
        for beta, model in zip(betas.value, models, strict=True):
            w, e = _weights(rows, beta, model)
            sums += [
                _key_sums(rows, w, e, slice(0, cut.first)), _key_sums(rows, w, e, slice(cut.last, None)),
                _risk_sums(rows, w, slice(cut.first, cut.stratum_end)),
                _risk_sums(rows, w, slice(cut.stratum_begin, cut.last)),
            ]
        values = [part, rows.g[0], rows.t[0], rows.g[-1], rows.t[-1], cut.first == len(rows.g), np.concatenate(sums).tobytes()]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_(), pa.binary()]
        yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=_columns(ENDS))

    return layout.blocks.mapInArrow(run, ENDS)


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


@dataclass
class Key:
    """A time that begins or ends a part: its own sums, then the risk sums from it on."""

    g: int
    t: float
    own: np.ndarray
    risk: np.ndarray = field(default_factory=lambda: np.empty(0))
    ties: np.ndarray = field(default_factory=lambda: np.empty(0))


@dataclass
class Between:
    """The entries of one stratum inside a part, between its first and its last time."""

    g: int
    part: int
    own: np.ndarray
    risk: np.ndarray = field(default_factory=lambda: np.empty(0))


class Frame(NamedTuple):
    """What a part is told: risk sums after its inside, and hazards (a, b) of its two end times."""

    carry: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _sequence(ends: list, p: int, models: int) -> list[Key | Between]:
    """All end times and insides in order, neighbours' shares of one time merged."""
    key, risk = 3 + 3 * p, 1 + p
    out: list[Key | Between] = []

    def add(g: int, t: float, own: np.ndarray) -> None:
        before = out[-1] if out else None
        if isinstance(before, Key) and before.g == g and before.t == t:
            before.own = before.own + own
        else:
            out.append(Key(g, t, own))

    for row in sorted(ends, key=lambda r: r["part"]):
        sums = np.frombuffer(row["payload"]).reshape(models, 2 * key + 2 * risk)
        add(row["g_first"], row["t_first"], sums[:, :key])
        if row["one"]:
            continue
        head, tail = sums[:, 2 * key : 2 * key + risk], sums[:, 2 * key + risk :]
        out.append(Between(row["g_first"], row["part"], head))
        if row["g_first"] != row["g_last"]:
            out.append(Between(row["g_last"], row["part"], tail))
        add(row["g_last"], row["t_last"], sums[:, key : 2 * key])
    return out


def _carry_back(sequence: list[Key | Between], p: int, efron: bool) -> None:
    """Risk sums from every end time on, and after every inside; hazards at the end times."""
    carry, g = 0.0, None
    for item in reversed(sequence):
        if item.g != g:
            carry, g = 0.0, item.g
        if isinstance(item, Key):
            carry = item.risk = item.own[:, 2 + 2 * p :] + carry
            with np.errstate(all="ignore"):
                item.ties = tie_sums(item.own[:, 0], item.risk[:, 0], item.own[:, 1], efron)
        else:
            item.risk = np.zeros_like(item.own) + carry
            carry = item.own + carry


def _frames(ends: list, sequence: list[Key | Between]) -> dict[int, tuple]:
    """The `Frame` of each part as a plain tuple: broadcasts are pickled by reference, and executors have no copy of this package."""
    keys = {(k.g, k.t): k for k in sequence if isinstance(k, Key)}
    after = {(b.part, b.g): b.risk for b in sequence if isinstance(b, Between)}
    out = {}
    for row in ends:
        first, last = keys[row["g_first"], row["t_first"]], keys[row["g_last"], row["t_last"]]
        carry = after.get((row["part"], row["g_last"]), np.zeros_like(first.risk))
        out[row["part"]] = tuple(Frame(carry, first.ties[1:3].T, last.ties[1:3].T))
    return out


def _segments(g: np.ndarray) -> list[tuple[int, int]]:
    edges = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)] if len(g) else np.zeros(1, np.int64)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


class Inside(NamedTuple):
    """Per time between the ends of a part: stratum, time, and the sums of the risk table."""

    begin: np.ndarray
    g: np.ndarray
    t: np.ndarray
    d: np.ndarray
    e0: np.ndarray
    e1: np.ndarray
    v: np.ndarray
    risk: np.ndarray


def _sums_by_time(x: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of weight * x (times x weights x p) over the entries of each time; `begin` says where times begin.

    A time of many entries is a product; short ones are summed stripe by stripe. Neither makes a copy
    of the part.
    """
    out, ends = np.empty((len(begin), len(weights), x.shape[1])), np.r_[begin[1:], len(x)]
    i = 0
    while i < len(begin):
        # the times that end within a stripe, or a single longer one
        j = max(int(np.searchsorted(ends, begin[i] + STRIPE, "right")), i + 1)
        a, b = int(begin[i]), int(ends[j - 1])
        if 16 * (j - i) <= b - a or j == i + 1:
            for k in range(i, j):
                here = slice(begin[k], ends[k])
                out[k] = weights[:, here] @ x[here]
        else:
            for m, w in enumerate(weights):
                out[i:j, m] = np.add.reduceat(w[a:b, None] * x[a:b], begin[i:j] - a, axis=0)
        i = j
    return out


def _gram(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of weight * x x' over the entries, stripe by stripe."""
    out = np.zeros((x.shape[1], x.shape[1]))
    for i in range(0, len(x), STRIPE):
        stripe = x[i : i + STRIPE]
        out += (stripe * weights[i : i + STRIPE, None]).T @ stripe
    return out


def _inside(rows: Entries, cut: Cuts, w: np.ndarray, e: np.ndarray, carry: np.ndarray) -> Inside:
    where = slice(cut.first, cut.last)
    g, t, x = rows.g[where], rows.t[where], rows.x[where]
    begin = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (t[1:] != t[:-1])]) if len(g) else np.zeros(0, np.int64)
    w, e = w[where], e[where]
    weights = np.stack([e, w * e, w])
    sums = np.add.reduceat(weights, begin, axis=1) if len(g) else np.zeros((3, 0))
    moved = _sums_by_time(x, weights, begin)
    risk = np.column_stack([sums[2], moved[:, 2]])
    g = g[begin]
    for i, j in _segments(g):
        risk[i:j] = np.cumsum(risk[i:j][::-1], axis=0)[::-1]
        if g[i] == rows.g[-1]:
            risk[i:j] += carry
    return Inside(begin, g, t[begin], sums[0], sums[1], moved[:, 1], moved[:, 0], risk)


def _time_sums(d, e0, e1, v, risk, ties, beta) -> tuple[float, np.ndarray, np.ndarray]:
    """What times add to log-likelihood, gradient and (with a minus) information."""
    log_phi, a, b, q0, q1, q2 = ties
    s1 = risk[:, 1:]
    cross = (s1 * q1[:, None]).T @ e1
    zz = (s1 * q0[:, None]).T @ s1 - cross - cross.T + (e1 * q2[:, None]).T @ e1
    return float((v @ beta).sum() - log_phi.sum()), v.sum(0) - a @ s1 + b @ e1, zz


def _insides(layout: Layout, betas, models: list[int], frames, efron: bool) -> DataFrame:
    p = layout.p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _read(batches, p)
        if got is None:
            return
        part, rows = got
        cut, frame, out = _cuts(rows), Frame(*frames.value[part]), []
        n, head, tail = len(rows.g), int(rows.g[0]), int(rows.g[-1])
        for m, (beta, model) in enumerate(zip(betas.value, models, strict=True)):
            w, e = _weights(rows, beta, model)
            with np.errstate(all="ignore"):
                inside = _inside(rows, cut, w, e, frame.carry[m])
                ties = tie_sums(inside.d, inside.risk[:, 0], inside.e0, efron)
                ll, grad, zz = _time_sums(inside.d, inside.e0, inside.e1, inside.v, inside.risk, ties, beta)
                a, b = ties[1], ties[2]
                a_first, b_first = frame.first[m]
                a_last, b_last = frame.last[m]
                upto, mids = np.empty(len(a)), {head: 0.0, tail: 0.0}
                for i, j in _segments(inside.g):
                    upto[i:j] = np.cumsum(a[i:j]) + (a_first if inside.g[i] == head else 0.0)
                    if int(inside.g[i]) in mids:
                        mids[int(inside.g[i])] = float(a[i:j].sum())
                size = np.diff(np.r_[inside.begin, cut.last - cut.first])
                before_last = mids[tail] + (a_first if head == tail else 0.0)
                ends = n - cut.last
                hazard = np.concatenate([
                    np.full(cut.first, a_first), np.repeat(upto, size), np.full(ends, before_last + a_last)
                ])
                own = np.concatenate([np.full(cut.first, b_first), np.repeat(b, size), np.full(ends, b_last)])
                gram = _gram(rows.x, w * (hazard - e * own))
                # the entries whose stratum may have begun in an earlier part
                stratum = slice(0, int(np.searchsorted(rows.g, head, "right")))
                shift = _gram(rows.x[stratum], w[stratum])
            out += [[ll], grad, pack_upper(gram - zz), pack_upper(shift), [mids[head], mids[tail]]]
        yield pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([np.concatenate(out).tobytes()], pa.binary())], names=["part", "payload"]
        )

    return layout.blocks.mapInArrow(run, "part int, payload binary")


def evaluate(
    layout: Layout, betas: list[np.ndarray], models: list[int] | None = None, efron: bool = True
) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(log-likelihood, gradient, information) of each model at its coefficients."""
    spark, p, k = layout.blocks.sparkSession, layout.p, len(betas)
    models = list(range(k)) if models is None else models
    sent = spark.sparkContext.broadcast([np.asarray(b, dtype=float) for b in betas])
    with small_batches(spark):
        ends = _ends(layout, sent, models).collect()
        sequence = _sequence(ends, p, k)
        _carry_back(sequence, p, efron)
        frames = spark.sparkContext.broadcast(_frames(ends, sequence))
        found = {r["part"]: r["payload"] for r in _insides(layout, sent, models, frames, efron).collect()}
    frames.destroy()
    sent.destroy()
    half = p * (p + 1) // 2
    parts = {n: np.frombuffer(v).reshape(k, 3 + p + 2 * half) for n, v in found.items()}
    keys = [item for item in sequence if isinstance(item, Key)]
    own, risk, ties = (np.stack([getattr(i, c) for i in keys]) if keys else None for c in ("own", "risk", "ties"))
    out = []
    for m in range(k):
        ll, grad, info = 0.0, np.zeros(p), np.zeros((p, p))
        if keys:
            o, s = own[:, m], risk[:, m]
            with np.errstate(all="ignore"):
                ll, grad, zz = _time_sums(
                    o[:, 0], o[:, 1], o[:, 2 : 2 + p], o[:, 2 + p : 2 + 2 * p], s, ties[:, :, m].T, betas[m]
                )
            info = -zz
        so_far, g, seen = 0.0, None, set()
        starts: dict[int, float] = {}
        for item in sequence:
            if item.g != g:
                so_far, g = 0.0, item.g
            if isinstance(item, Key):
                starts[id(item)] = so_far
                so_far += item.ties[1, m]
            else:
                # two insides of one part belong to its first and its last stratum
                so_far += parts[item.part][m][-1 if item.part in seen else -2]
                seen.add(item.part)
        first = {(i.g, i.t): starts[id(i)] for i in keys}
        for row in ends:
            sums = parts[row["part"]][m]
            ll += sums[0]
            grad = grad + sums[1 : 1 + p]
            packed = sums[1 + p : 1 + p + half] + first[row["g_first"], row["t_first"]] * sums[1 + p + half : 1 + p + 2 * half]
            info = info + unpack_upper(packed, p)
        out.append((float(ll), grad, info))
    return out


def risk_fields(p: int) -> list[str]:
    return ["d", "r0", "e0", *names("r", p + 1)[1:], *names("e", p + 1)[1:], *names("v", p + 1)[1:]]


def risk_tables(layout: Layout, betas: list[np.ndarray]) -> DataFrame:
    """Per model, stratum g and time: events d, risk sums r0, r*, tied-event sums e0, e*, event sums v*."""
    spark, p, k = layout.blocks.sparkSession, layout.p, len(betas)
    models = list(range(k))
    sent = spark.sparkContext.broadcast([np.asarray(b, dtype=float) for b in betas])
    ends = _ends(layout, sent, models).collect()
    sequence = _sequence(ends, p, k)
    _carry_back(sequence, p, False)
    frames = spark.sparkContext.broadcast(_frames(ends, sequence))
    fields = risk_fields(p)
    schema = "model int, g long, time double, " + ", ".join(f"{f} double" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _read(batches, p)
        if got is None:
            return
        part, rows = got
        cut = _cuts(rows)
        for m, beta in enumerate(sent.value):
            inside = _inside(rows, cut, *_weights(rows, beta, m), Frame(*frames.value[part]).carry[m])
            columns = np.column_stack([inside.d, inside.risk[:, 0], inside.e0, inside.risk[:, 1:], inside.e1, inside.v])
            yield pa.record_batch(
                [pa.array(np.full(len(inside.g), m, np.int32)), pa.array(inside.g), pa.array(inside.t),
                 *[pa.array(np.ascontiguousarray(c)) for c in columns.T]],
                names=["model", "g", "time", *fields],
            )

    shared = [
        (m, int(i.g), float(i.t), *map(float, np.concatenate([
            [i.own[m, 0], i.risk[m, 0], i.own[m, 1]], i.risk[m, 1:], i.own[m, 2 : 2 + 2 * p]
        ])))
        for i in sequence if isinstance(i, Key) for m in models
    ]
    return layout.blocks.mapInArrow(run, schema).unionAll(spark.createDataFrame(shared, schema))


# ---------------------------------------------------------------- Newton's method, models side by side


@dataclass
class Problem:
    """One model: l1 weight, l2 weight per term, terms it has, and where to begin."""

    l1: float
    l2: np.ndarray
    active: np.ndarray
    beta: np.ndarray


@dataclass
class Solution:
    beta: np.ndarray
    information: np.ndarray
    log_likelihood: float
    steps: int


def newton_direction(grad, info, beta, l1) -> np.ndarray:
    """Step for the quadratic model, with an l1 penalty (a number or one per term) by coordinate descent when asked."""
    l1 = np.broadcast_to(l1, beta.shape)
    if not (l1 > 0).any():
        return np.linalg.lstsq(info, grad, rcond=None)[0]
    target = beta.copy()
    linear = grad + info @ beta
    for _ in range(1000):
        before = target.copy()
        for k in range(len(beta)):
            if info[k, k] <= 0:
                continue
            rest = linear[k] - info[k] @ target + info[k, k] * target[k]
            target[k] = np.sign(rest) * max(abs(rest) - l1[k], 0.0) / info[k, k]
        if np.max(np.abs(target - before)) < 1e-12:
            break
    return target - beta


class _State:
    def __init__(self, problem: Problem):
        self.problem, self.beta = problem, problem.beta.copy()
        self.trial, self.scale, self.halvings, self.steps = self.beta, 1.0, 0, 0
        self.value, self.objective, self.direction, self.done = None, -math.inf, None, False

    def penalised(self, beta, value):
        ll, grad, info = value
        q = self.problem
        objective = ll - 0.5 * float(q.l2 @ beta**2) - float(np.broadcast_to(q.l1, beta.shape) @ np.abs(beta))
        return objective, grad - q.l2 * beta, info + np.diag(q.l2)

    def take(self, value, max_steps: int, tolerance: float, max_halvings: int) -> None:
        """Accept the trial or halve the step; then choose the next trial."""
        objective, grad, info = self.penalised(self.trial, value)
        first = self.value is None
        if first or (np.isfinite(objective) and objective >= self.objective - 1e-9 * abs(self.objective)):
            gain = objective - self.objective
            self.beta, self.value, self.objective = self.trial, (value[0], grad, info), objective
            if not first:
                self.steps += 1
                if abs(gain) < 1e-11 * (abs(objective) + 1.0):
                    self.done = True
                    return
            on = np.flatnonzero(self.problem.active)
            l1 = np.broadcast_to(self.problem.l1, self.beta.shape)[on]
            self.direction = np.zeros_like(self.beta)
            if len(on):
                self.direction[on] = newton_direction(grad[on], info[np.ix_(on, on)], self.beta[on], l1)
            self.scale, self.halvings = 1.0, 0
            if np.max(np.abs(self.direction), initial=0.0) < tolerance or self.steps >= max_steps:
                self.done = True
                return
        else:
            self.scale, self.halvings = self.scale / 2, self.halvings + 1
            if self.halvings >= max_halvings:
                self.done = True
                return
        self.trial = self.beta + self.scale * self.direction


def solve(
    layout: Layout, problems: list[Problem], efron: bool = True, max_steps: int = 500,
    tolerance: float = 1e-7, max_halvings: int = 30, evaluate=evaluate,
) -> list[Solution]:
    """Every model's penalised optimum; one round evaluates all models that are not done.

    `evaluate` may be that of rows laid out in another way.
    """
    states = [_State(q) for q in problems]
    while True:
        open_ = [m for m, s in enumerate(states) if not s.done]
        if not open_:
            break
        for m, value in zip(open_, evaluate(layout, [states[m].trial for m in open_], open_, efron), strict=True):
            states[m].take(value, max_steps, tolerance, max_halvings)
    return [Solution(s.beta, s.value[2], s.value[0], s.steps) for s in states]


def stratum_numbers(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(g, value) of the distinct strata, and the seed of the hash that numbers them.

    No two strata share a number: the hash is tried with other seeds until they differ.
    """
    seed = 0
    while True:
        numbered = df.select(F.col(column)).distinct().select(F.xxhash64(F.lit(seed), column).alias("g"), column)
        shared = numbered.groupBy("g").count().where(F.col("count") > 1).isEmpty()
        if shared:
            return numbered, seed
        seed += 1

