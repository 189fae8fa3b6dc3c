"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact check.

1. One pass over the texts gives each document the size and digest of its set of k-word
   shingles and its band keys. Documents with the same digest are one class from here on,
   so a group of exact copies costs one row however large it is.
2. Classes that share a band key are candidates. Each bucket first compares its members with
   its smallest one (a star, never all pairs). Links found so join classes to components.
3. A bucket whose members are still in several components may hide more links. Its members
   outside the bucket's largest component are compared with all its other members, in blocks
   of bounded size; a block gives back one exactly checked link per component, not pairs.
4. Components of all links, spread to the copies.

A comparison reads signatures in steps. After each step, with a uniform prior, the posterior
of the similarity after m matches of n is Beta(m + 1, n - m + 1); the pair is dropped when
P(similarity >= threshold) < `miss`. Survivors are checked on their full shingle sets.

With 30 bands of 5 a pair at similarity 0.8 shares no band with probability 7e-6.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.graph import components
from tenurelens.llm.scratch import cut

HASH_BLOCK = 1 << 15


class Plan(NamedTuple):
    """What near duplicates are: `size`-word shingles, 100 * shared >= `percent` * union."""

    size: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5
    #: a pair is dropped early when its posterior chance to be a link is below this
    miss: float = 1e-6
    #: hashes compared between two looks at the posterior
    step: int = 30
    #: most members in one side of a block
    block: int = 512
    seed: int = 20

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def least_matches(plan: Plan) -> list[tuple[int, int]]:
    """(n, fewest matches of the first n hashes that keep a pair alive), step by step."""
    t, out = plan.percent / 100, []
    for n in range(plan.step, plan.hashes + 1, plan.step):
        # P(Beta(m + 1, n - m + 1) >= t) is the chance of at most m successes in n + 1 trials
        tail, m = 0.0, -1
        while tail < plan.miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def multipliers(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(plan.seed)
    a = draw.integers(0, 1 << 32, plan.hashes, dtype=np.uint32) | np.uint32(1)
    return a, draw.integers(0, 1 << 32, plan.hashes, dtype=np.uint32)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct 64-bit shingle hashes per text) slice by slice."""
    odd = [np.uint64(2 * 0x9E3779B97F4A7C15 * i + 1 & 0xFFFFFFFFFFFFFFFF) for i in range(1, size + 1)]
    for first, data, offsets in batches.slices(column):
        data = batches.LOWER[data]
        found = batches.words(data, offsets)
        hashes = batches.span_hashes(data, found.start, found.end)
        runs = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
        for i in range(size):
            runs += hashes[i : i + len(runs)] * odd[i]
        runs = batches.mix(runs)
        sets = []
        for begin, end in zip(found.bound[:-1].tolist(), found.bound[1:].tolist(), strict=True):
            if end - begin >= size:
                sets.append(np.unique(runs[begin : end - size + 1]))
            elif end > begin:
                few = hashes[begin:end] * np.array(odd[: end - begin], np.uint64)
                sets.append(batches.mix(few.sum(keepdims=True) + np.uint64(end - begin)))
            else:
                sets.append(np.empty(0, np.uint64))
        yield first, sets


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash signatures (one row per set, 32 bits per hash) of sets that are not empty."""
    out = np.full((len(sets), len(a)), 0xFFFFFFFF, np.uint32)
    if not sets:
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    for begin in range(0, len(values), HASH_BLOCK):
        part, own = values[begin : begin + HASH_BLOCK], owner[begin : begin + HASH_BLOCK]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rows = own[starts]
        for k in range(len(a)):
            low = np.minimum.reduceat(part * a[k] + b[k], starts)
            out[rows, k] = np.minimum(out[rows, k], low)
    return out


def band_keys(sig: np.ndarray, plan: Plan) -> np.ndarray:
    parts = sig.astype(np.uint64).reshape(len(sig), plan.bands, plan.rows)
    odd = batches.mix(np.arange(1, plan.rows + 1, dtype=np.uint64)) | np.uint64(1)
    key = (parts * odd).sum(axis=2, dtype=np.uint64) + np.arange(plan.bands, dtype=np.uint64)
    return batches.mix(key).view(np.int64)


def _fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a 2-d array as binary values."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def fingerprint(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set (null if empty), band keys (null if empty)."""
    a, b = multipliers(plan)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, sets in shingle_sets(part.column(1), plan.size):
                ids = part.column(0).slice(first, len(sets))
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(signatures([sets[i] for i in full], a, b), plan)
                at = dict(zip(full, range(len(full)), strict=True))
                yield pa.record_batch(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(
                            [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                            pa.binary(),
                        ),
                        pa.array([keys[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "digest", "keys"],
                )

    return batches.bounded(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, keys array<bigint>"
    )


def payload(docs: DataFrame, plan: Plan) -> DataFrame:
    """id, sig, shingles (both packed) of documents that are candidates."""
    a, b = multipliers(plan)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, sets in shingle_sets(part.column(1), plan.size):
                yield pa.record_batch(
                    [
                        part.column(0).slice(first, len(sets)),
                        _fixed(signatures(sets, a, b)),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["id", "sig", "shingles"],
                )

    return batches.bounded(docs).select("doc_id", "text").mapInArrow(run, "id long, sig binary, shingles binary")


def alive(x: np.ndarray, y: np.ndarray, looks: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the rows of x and y whose posterior never falls below the bound."""
    left = np.arange(len(x))
    done, hits = 0, np.zeros(len(x), np.int32)
    for n, least in looks:
        hits += (x[left, done:n] == y[left, done:n]).sum(axis=1, dtype=np.int32)
        stay = hits >= least
        left, hits, done = left[stay], hits[stay], n
    return left


def is_link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _unpack(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in column.to_pylist()]


def check_pairs(pairs: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b, with both payloads) that are links."""
    looks = least_matches(plan)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            x, y = (np.stack(_unpack(part.column(c), np.uint32)) for c in (2, 3))
            keep = [
                i
                for i in alive(x, y, looks).tolist()
                if is_link(
                    np.frombuffer(part.column(4)[i].as_buffer(), np.uint64),
                    np.frombuffer(part.column(5)[i].as_buffer(), np.uint64),
                    plan.percent,
                )
            ]
            yield pa.record_batch([part.column(0), part.column(1)], names=["a", "b"]).take(
                pa.array(keep, pa.int64())
            )

    return batches.bounded(pairs).select("a", "b", "sig_a", "sig_b", "set_a", "set_b").mapInArrow(run, "a long, b long")


#: shingles (8 bytes each) of the members of a block, on average
BLOCK_SHINGLES = 1 << 20


def block_links(left: list, right: list, plan: Plan, looks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links between two lists of (id, component, sig, set): one per pair of merged components."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    links = []
    n_right = np.array([len(m[3]) for m in right])
    sigs = np.stack([m[2] for m in right])
    for ident, comp, sig, shingles in left:
        n = len(shingles)
        fits = np.flatnonzero(
            (100 * np.minimum(n_right, n) >= plan.percent * np.maximum(n_right, n))
            & np.array([root(m[1]) != root(comp) for m in right])
        )
        if not len(fits):
            continue
        near = fits[alive(np.broadcast_to(sig, (len(fits), len(sig))), sigs[fits], looks)]
        for j in near.tolist():
            other = right[j]
            if root(other[1]) != root(comp) and is_link(shingles, other[3], plan.percent):
                links.append((ident, other[0]))
                parent[root(other[1])] = root(comp)
    return links


def cross_links(members: DataFrame, plan: Plan) -> DataFrame:
    """Links between components inside buckets, group by group of two blocks."""
    looks = least_matches(plan)

    def run(group: pa.Table) -> pa.Table:
        rows = list(
            zip(
                group["side"].to_pylist(), group["id"].to_pylist(), group["component"].to_pylist(),
                _unpack(group["sig"], np.uint32), _unpack(group["shingles"], np.uint64),
                strict=True,
            )
        )
        left = sorted((r[1:] for r in rows if not r[0]), key=lambda r: r[0])
        right = sorted((r[1:] for r in rows if r[0]), key=lambda r: r[0])
        found = block_links(left, right, plan, looks) if left and right else []
        return pa.table(
            {"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())}
        )

    return members.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text).

    A component is named by its smallest doc_id; `kept` holds where the two agree. Texts
    without words have no shingles and are linked with nothing. Rows that share a doc_id are
    one node of the graph. A null doc_id cannot be linked: such rows are kept, with a null
    component. An empty table gives an empty result; other columns are ignored.
    """
    prints = cut(fingerprint(docs, plan))
    known = prints.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # rows are found by their own id, so that a large class is no hot key of a join
    heads = cut(
        known.select("doc_id", "digest", "n_shingles", "keys")
        .join(classes.withColumnRenamed("digest", "d"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("d")))
        .select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "keys")
        .dropDuplicates(["id", "keys"])
    )
    slots = heads.select("id", "n", F.explode("keys").alias("key"))
    # adaptive execution splits a frequent key in a join of two plain tables, not of an aggregate
    buckets = cut(slots.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1"))
    members = cut(slots.join(buckets, "key").select("key", "hub", "m", "id", "n"))
    wanted = members.select("id").distinct()
    texts = docs.select("doc_id", "text").join(
        _small(wanted).withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"
    )
    # a doc_id with several texts has several payloads; all of them are compared
    loads = cut(payload(texts, plan))

    sizes = members.where("id = hub").select("key", F.col("n").alias("hub_n"))
    stars = (
        members.join(sizes, "key")
        .where((F.col("id") != F.col("hub")))
        .where(100 * F.least("n", "hub_n") >= plan.percent * F.greatest("n", "hub_n"))
        .select(F.col("hub").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    loaded = stars.join(
        loads.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b")), "b"
    ).join(loads.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a")), "a")
    first = cut(check_pairs(loaded, plan).distinct())
    grouped = components(first)

    labelled = members.where("m > 2").join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", "m", F.coalesce("component", "id").alias("component")
    )
    shares = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("size"))
    largest = F.max(F.struct("c", "component", "size"))
    mixed = cut(
        shares.groupBy("key")
        .agg(largest.alias("x"), F.sum("c").alias("all"), F.sum("size").alias("whole"))
        .select("key", "all", "whole", F.col("x.component").alias("major"), F.col("x.c").alias("most"), F.col("x.size").alias("size"))
        .where("most < all")
    )
    open_members = labelled.join(mixed, "key").drop("n")
    # a block holds a bounded number of members and of shingles
    left_blocks = F.ceil(F.greatest(
        (F.col("all") - F.col("most")) / plan.block, (F.col("whole") - F.col("size")) / BLOCK_SHINGLES
    )).cast("int")
    right_blocks = F.ceil(F.greatest(F.col("all") / plan.block, F.col("whole") / BLOCK_SHINGLES)).cast("int")
    minors = (
        open_members.where("component != major")
        .withColumn("i", F.pmod(F.xxhash64("id"), left_blocks).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), right_blocks - 1)))
        .select("key", "i", "j", "id", "component", F.lit(0).alias("side"))
    )
    others = (
        open_members.withColumn("j", F.pmod(F.xxhash64("id", F.lit(1)), right_blocks).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), left_blocks - 1)))
        .select("key", "i", "j", "id", "component", F.lit(1).alias("side"))
    )
    second = cross_links(minors.unionAll(others).join(loads, "id"), plan)
    twice = known.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y")
    same_id = known.join(twice.select("doc_id"), "doc_id", "left_semi").join(classes, "digest").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    )
    final = components(first.unionAll(second).unionAll(same_id))

    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    joined = _spread(prints.select("doc_id", "n_shingles", "digest"), named)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of docs of which one document per component stays, the one of smallest doc_id.

    Of rows that share a doc_id one stays, too. Rows without a doc_id all stay.
    """
    found = cut(near_duplicates(docs, plan))
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.join(_small(gone), "doc_id", "left_anti").select(*docs.columns)
    again = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = cut(again)
    if again.isEmpty():
        return rows
    again = _small(again)
    return rows.join(again, "doc_id", "left_anti").select(*docs.columns).unionAll(
        rows.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )


#: ids that are broadcast at most (8 bytes each); beyond, the join shuffles
BROADCAST_IDS = 4_000_000


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast a column of ids if a count shows that it is small enough."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _spread(rows: DataFrame, named: DataFrame, salts: int = 64) -> DataFrame:
    """Join rows to one line per digest; digests of many rows are met in `salts` places."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    places = salted.where(F.col("digest").isNotNull()).groupBy("digest", "salt").agg(F.lit(1).alias("one"))
    lines = places.groupBy("digest").agg(F.collect_set("salt").alias("salts")).join(named, "digest")
    lines = lines.select("digest", F.explode("salts").alias("salt"), "component_id")
    return salted.join(lines, ["digest", "salt"], "left")
