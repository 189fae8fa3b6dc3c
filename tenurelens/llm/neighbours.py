"""Exact k best inner products by a Voronoi join of queries and data.

Rows go to the cell of their nearest pivot; pivots are a bounded sample of the rows. A cell's
summary is its size, its largest distance from the pivot and the k + 1 rows next to the pivot.
Scores against those rows give every query q a limit t(q) that its k-th best score cannot fall
below, and with |x - p| = d no row x of the cell of p scores more than q.p + |q| d. So a group
of queries needs only the rows with d >= min over its q of (t(q) - q.p) / |q|. Rows are copied to
the groups that need them, in units of bounded size, and solved there; the same bound with the
limits reached so far skips queries cell by cell. One window joins the k best of all units.

Components are floor(1024 x), kept as 2, 4 or 8 bytes each, whichever holds the whole row. Rows
whose sums a double can hold exactly are `plain`; the others, and rows of a length that no pivot
has, lie in the cell OTHER, which no bound prunes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut

OTHER = -1
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: 2**20 * 2**20 * 2**13 = 2**53: sums of such products are exact in doubles
PLAIN_SIZE, PLAIN_LENGTH = 1 << 20, 1 << 13
#: rows and queries whose scores are in memory together
TILE = 2048

ROW = "vec_id long, length int, plain boolean, v binary"


class Cells(NamedTuple):
    """The pivots of each length: cells first[length] onwards, one pivot per row of the matrix."""

    first: dict[int, int]
    pivots: dict[int, np.ndarray]


class Near(NamedTuple):
    """Rows of one length next to their pivots: ids and components."""

    ids: np.ndarray
    rows: np.ndarray


def encode(rows: np.ndarray) -> list[bytes]:
    """Each row by itself in the smallest of three widths, so equal rows have equal bytes."""
    size = np.abs(rows).max(1, initial=0.0)
    out: list[bytes] = [b""] * len(rows)
    width = np.where(size < 2**15, 2, np.where(size < 2**31, 4, 8))
    for w, kind in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
        for i, row in zip(np.flatnonzero(width == w).tolist(), rows[width == w].astype(kind), strict=True):
            out[i] = row.tobytes()
    return out


def decode(blobs: list[bytes], length: int) -> np.ndarray:
    out = np.zeros((len(blobs), length))
    if length:
        width = np.fromiter(map(len, blobs), np.int64, len(blobs)) // length
        for w, kind in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
            at = np.flatnonzero(width == w)
            out[at] = np.frombuffer(b"".join([blobs[i] for i in at.tolist()]), kind).reshape(len(at), length)
    return out


def _parse(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, components) of the rows that take part, by length."""
    ids, lists = part.column(0), part.column(1).cast(pa.large_list(pa.float64()))
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    values = np.floor(1024 * flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64))
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    end = np.cumsum(size)
    good = (ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
            & (bad[end] == bad[end - size]))
    numbers = ids.fill_null(0).to_numpy()
    for length in np.unique(size[good]).tolist():
        at = np.flatnonzero(good & (size == length))
        yield numbers[at], values[(end - size)[at][:, None] + np.arange(length)]


def _plain(rows: np.ndarray) -> np.ndarray:
    return (np.abs(rows).max(1, initial=0.0) <= PLAIN_SIZE) & (rows.shape[1] <= PLAIN_LENGTH)


def vectors(df: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows that take part: vec_id, length, plain, v (encoded components)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for ids, rows in _parse(part):
                yield pa.record_batch(
                    [pa.array(ids), pa.array(np.full(len(ids), rows.shape[1], np.int32)), pa.array(_plain(rows)),
                     pa.array(encode(rows), pa.binary())],
                    names=["vec_id", "length", "plain", "v"],
                )

    return batches.bounded(df.select(F.col(ident).cast("long"), vector)).mapInArrow(run, ROW)


def _by_length(table: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, components) of encoded rows."""
    length = table.column("length").to_numpy()
    blobs = table.column("v").to_pylist()
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        yield n, at, decode([blobs[i] for i in at.tolist()], n)


def pick(rows: DataFrame, pivots: int) -> Cells:
    """At most `pivots` different plain rows, the first ones by a hash of their ids."""
    sample = rows.where("plain").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    by_length: dict[int, set[bytes]] = {}
    for row in sample:
        by_length.setdefault(row["length"], set()).add(bytes(row["v"]))
    first, matrices, n = {}, {}, 0
    for length, blobs in sorted(by_length.items()):
        first[length], matrices[length] = n, decode(sorted(blobs), length)
        n += len(blobs)
    return Cells(first, matrices)


def assign(rows: DataFrame, cells) -> DataFrame:
    """The rows with `cell` and the distance `far` from its pivot (0 in the cell OTHER)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pivots = cells.value
        for part in parts:
            cell = np.full(part.num_rows, OTHER, np.int32)
            far = np.zeros(part.num_rows)
            plain = part.column("plain").to_numpy(zero_copy_only=False)
            for length, at, x in _by_length(part):
                if length in pivots:
                    p = pivots[length]
                    x, at = x[plain[at]], at[plain[at]]
                    for i in range(0, len(at), TILE):
                        y = x[i : i + TILE]
                        square = (y * y).sum(1)[:, None] - 2 * (y @ p.T) + (p * p).sum(1)[None]
                        cell[at[i : i + TILE]] = first[length] + square.argmin(1)
                        far[at[i : i + TILE]] = np.sqrt(np.maximum(square.min(1), 0))
            yield pa.record_batch([*part.columns, pa.array(cell), pa.array(far)], names=[*part.schema.names, "cell", "far"])

    return rows.mapInArrow(run, f"{ROW}, cell int, far double")


def kth_best(score: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; LOWEST where there are fewer."""
    if score.shape[1] < k:
        return np.full(len(score), LOWEST, np.int64)
    return -np.partition(-score, k - 1, axis=1)[:, k - 1]


def limits(ids: np.ndarray, q: np.ndarray, near: Near | None, k: int) -> np.ndarray:
    """A score that each query's k-th best is not below, from the rows next to the pivots."""
    if near is None or not len(ids):
        return np.full(len(ids), LOWEST, np.int64)
    out = []
    for i in range(0, len(ids), TILE):
        score = (q[i : i + TILE] @ near.rows.T).astype(np.int64)
        score[ids[i : i + TILE, None] == near.ids[None]] = LOWEST + 1
        out.append(kth_best(score, k))
    limit = np.concatenate(out)
    return np.where(limit <= LOWEST + 1, LOWEST, limit)


def reach(limit: np.ndarray, at_pivot: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """The distance from a pivot from which on rows can matter, a little less for rounding."""
    gap = limit.astype(np.float64) - 1 - at_pivot
    with np.errstate(divide="ignore", invalid="ignore"):
        far = gap / norm
    far -= 1e-9 * np.abs(far) + 1e-6
    return np.where((limit == LOWEST) | (norm == 0), -np.inf, far)


def _needs(queries: DataFrame, cells, near, k: int) -> DataFrame:
    """(block, cell, least): the rows of a cell that the queries of a block need."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pivots = cells.value
        least: dict[tuple[int, int], float] = {}
        for part in parts:
            block, home = part.column("block").to_numpy(), part.column("cell").to_numpy()
            ids = part.column("vec_id").to_numpy()
            for b in np.unique(block).tolist():
                least[b, OTHER] = -np.inf
            for length, at, q in _by_length(part):
                if length not in pivots:
                    continue
                p = pivots[length]
                limit = np.where(home[at] == OTHER, LOWEST, limits(ids[at], q, near.value.get(length), k))
                norm = np.sqrt((q * q).sum(1))
                for i in range(0, len(at), TILE):
                    s = slice(i, i + TILE)
                    far = reach(limit[s, None], q[s] @ p.T, norm[s, None])
                    for b in np.unique(block[at[s]]).tolist():
                        row = far[block[at[s]] == b].min(0)
                        for c, f in enumerate(row.tolist(), first[length]):
                            least[b, c] = min(least.get((b, c), np.inf), f)
        if least:
            keys = np.array(list(least), np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(list(least.values()), pa.float64())],
                names=["block", "cell", "least"],
            )

    found = queries.mapInArrow(run, "block long, cell long, least double")
    return found.groupBy("block", "cell").agg(F.min("least").alias("least"))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products beyond doubles in whole numbers; those beyond 64 bits become the outermost ones."""
    whole = [[int(c) for c in row] for row in x.tolist()]
    out = np.empty((len(q), len(x)), np.int64)
    for i, row in enumerate(q.tolist()):
        mine = [int(c) for c in row]
        for j, other in enumerate(whole):
            out[i, j] = min(max(sum(a * b for a, b in zip(mine, other, strict=True)), LOWEST + 1), HIGHEST)
    return out


class Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, n: int, k: int, limit: np.ndarray):
        self.k, self.limit = k, limit.copy()
        self.query, self.ids, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.n = n

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = np.r_[self.query, query], np.r_[self.ids, ids], np.r_[self.score, score]
        order = np.lexsort((ids, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[place < self.k]
        self.query, self.ids, self.score = query[place < self.k], ids[kept], score[kept]
        full = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.limit[self.query[full]] = np.maximum(self.limit[self.query[full]], self.score[full])


def solve(queries: pa.Table, data: pa.Table, cells: Cells, near: dict[int, Near], k: int) -> Iterator[tuple]:
    """(query numbers, ids, scores) of the k best rows of `data` for each of `queries`."""
    rows = {length: (at, x) for length, at, x in _by_length(data)}
    home, far = data.column("cell").to_numpy(), data.column("far").to_numpy()
    row_ids = data.column("vec_id").to_numpy()
    numbers, ids = queries.column("q").to_numpy(), queries.column("vec_id").to_numpy()
    origin = queries.column("cell").to_numpy()
    for length, at, q in _by_length(queries):
        if length not in rows:
            continue
        where, x = rows[length]
        plain = origin[at] != OTHER
        if length not in cells.pivots:
            plain = _plain(q)
        for safe, mine in ((True, at[plain]), (False, at[~plain])):
            for i in range(0, len(mine), TILE):
                tile = mine[i : i + TILE]
                y = q[np.searchsorted(at, tile)]
                limit = limits(ids[tile], y, near.get(length), k) if safe else np.full(len(tile), LOWEST, np.int64)
                best = Best(len(tile), k, limit)
                norm = np.sqrt((y * y).sum(1))
                for c in np.unique(home[where]).tolist():
                    group = np.flatnonzero(home[where] == c)
                    group = group[np.argsort(-far[where[group]], kind="stable")]
                    for j in range(0, len(group), TILE):
                        part = group[j : j + TILE]
                        on = np.arange(len(tile))
                        exact = safe and bool(_plain(x[part]).all())
                        if exact and c != OTHER:
                            pivot = cells.pivots[length][c - cells.first[length]]
                            on = np.flatnonzero(reach(best.limit, y @ pivot, norm) <= far[where[part[0]]])
                            if not len(on):
                                break
                        score = (y[on] @ x[part].T).astype(np.int64) if exact else exact_scores(y[on], x[part])
                        take = (score >= best.limit[on][:, None]) & (ids[tile[on]][:, None] != row_ids[where[part]][None])
                        a, b = np.nonzero(take)
                        best.add(on[a], row_ids[where[part[b]]], score[a, b])
                yield numbers[tile[best.query]], best.ids, best.score


def _pack(sizes: list[tuple[int, int]], limit: int) -> list[tuple[int, int, int]]:
    """(cell, first bin, bins): neighbouring cells share a bin of about `limit`, larger ones are split."""
    out, bin_, filled = [], 0, 0
    for cell, size in sizes:
        parts = -(-size // limit)
        if parts > 1:
            bin_ += filled > 0
            out.append((cell, bin_, parts))
            bin_, filled = bin_ + parts, 0
            continue
        if filled and filled + size > limit:
            bin_, filled = bin_ + 1, 0
        out.append((cell, bin_, 1))
        filled += size
    return out


def nearest(
    df: DataFrame,
    k: int = 10,
    every: int = 100,
    ident: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 128,
    unit_bytes: int = 16 << 20,
) -> DataFrame:
    """The k rows of largest integer inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by `every`, candidates all rows but those of the
    query's own id; equal scores go by ascending id, and fewer than k candidates are all listed.
    Rows without id, null vectors and vectors with null or non-finite components (also after the
    factor 1024) take no part. Only vectors of one length are compared; empty vectors score 0.
    A repeated id is a candidate as often as it has rows; as a query, equal rows are one and
    different vectors of one id are ranked by themselves. Scores beyond 64 bits become the
    outermost 64-bit numbers. An empty table gives no rows; other columns are not read.
    `unit_bytes` bounds the encoded rows, and the queries, that one task solves.
    """
    spark = df.sparkSession
    raw = vectors(df, ident, vector)
    picked = pick(raw, pivots)
    cells = spark.sparkContext.broadcast(picked)
    rows = cut(assign(raw, cells))
    summary = rows.groupBy("cell").agg(
        F.sum(F.octet_length("v") + F.lit(32)).alias("bytes"),
        F.sum(F.when(F.col("vec_id") % every == 0, F.octet_length("v") + F.lit(32))).alias("asking"),
        F.max("far").alias("far"),
    ).orderBy("cell").collect()
    total = sum(r["bytes"] for r in summary)
    spread = max(1, min(unit_bytes, math.ceil(total / (2 * spark.sparkContext.defaultParallelism))))
    units = _pack([(r["cell"], r["bytes"]) for r in summary], spread)
    blocks = _pack([(r["cell"], r["asking"]) for r in summary if r["asking"]], unit_bytes)

    close = Window.partitionBy("cell").orderBy("far", "vec_id", "v")
    kept = rows.where(F.col("cell") != OTHER).withColumn("nth", F.row_number().over(close)).where(F.col("nth") <= k + 1)
    chosen: dict[int, list] = {}
    for r in kept.select("vec_id", "length", "v").collect():
        chosen.setdefault(r["length"], []).append((r["vec_id"], bytes(r["v"])))
    near = spark.sparkContext.broadcast(
        {n: Near(np.array([i for i, _ in s], np.int64), decode([b for _, b in s], n)) for n, s in chosen.items()}
    )

    asking = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    homes = spark.createDataFrame(blocks, "cell int, first long, parts long")
    queries = cut(
        asking.join(F.broadcast(homes), "cell")
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")))
        .select("vec_id", "length", "cell", "v", "block", F.monotonically_increasing_id().alias("q"))
    )
    farthest = {r["cell"]: r["far"] for r in summary}
    where = {c: (first, parts) for c, first, parts in units}
    needs = [
        (b, c, f, *where[c]) for b, c, f in _needs(queries, cells, near, k).toLocalIterator()
        if c in where and f <= farthest[c]
    ]
    wanted = spark.createDataFrame(needs, "block long, cell int, least double, first long, parts long")
    visited = sorted({(b, u) for b, _, _, first, parts in needs for u in range(first, first + parts)})
    visits = spark.createDataFrame(visited, "block long, unit long")

    # the place of a row in the written table, so that repeated rows of one id spread as well
    placed = rows.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    left = queries.join(F.broadcast(visits), "block").select("block", "unit", "q", "vec_id", "length", "cell", "v")
    right = (
        placed.join(F.broadcast(wanted), "cell").where(F.col("far") >= F.col("least"))
        .withColumn("unit", F.col("first") + F.pmod("place", F.col("parts")))
        .select("block", "unit", "vec_id", "length", "cell", "far", "v")
        # names of its own for each side of the cogroup: both come from one written table
        .toDF("to_block", "to_unit", "vec_id", "length", "cell", "far", "v")
    )

    def run(asked: pa.Table, data: pa.Table) -> pa.Table:
        found = list(solve(asked, data, cells.value, near.value, k)) if asked.num_rows and data.num_rows else []
        columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["q", "vec_id", "score"])

    found = left.groupBy("block", "unit").cogroup(right.groupBy("to_block", "to_unit")).applyInArrow(
        run, "q long, vec_id long, score long"
    )
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = queries.select("q", F.col("vec_id").alias("query_id"))
    return best.join(names, "q").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.c, d.c), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id AND len(q.c) = len(d.c)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
