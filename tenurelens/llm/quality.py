"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and shares read from the text alone. Each feature is cut into bins at
quantiles of the training rows. Boosting goes round the features in turn: a tree of at most
three leaves on one feature's bins is fitted to the gradient of the log loss, and a small step
of it is added to that feature's lookup table. Then the pairs of features whose residuals
profit most from a cut in both get two-dimensional tables, boosted in the same way. A score is
the intercept plus one table entry per feature and pair.

The model is fitted on the driver from at most `sample` labelled rows (drawn by a hash of the
id); the features and scores of all documents are computed in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import aside
from tenurelens.llm.scratch import cut

FEATURES = (
    "words", "word_bytes", "upper", "symbols", "exclaims", "digits", "stops", "distinct_words", "top_word",
    "repeated_runs", "repeated_lines", "line_words", "capitalised", "short_words", "same_as_last", "common_words",
)

#: frequent words of English, French, German and Spanish
COMMON = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they "
    "which one you were her all she there would their we him been has when who will no more if out so what up said "
    "de la le et les des en un une du dans est que qui par pour sur au pas il se plus avec ce son ne sont "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "el y los las del por con para al lo como más su o pero sus este ya entre esta son dos"
).split()


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in characters]] = 1
    return out


UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
SYMBOLS = _table("#*$%&|<>")
EXCLAIMS = _table("!")
DIGITS = _table("0123456789")
STOPS = _table(".,;:?")
NOT_BREAK = np.ones(256, dtype=bool)
NOT_BREAK[10] = False


def _word_hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return np.unique(batches.span_hashes(data, ends - [len(w) for w in raw], ends))


COMMON_HASHES = _word_hashes(COMMON)


def _sums(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, 0 for empty ones."""
    out = np.add.reduceat(np.r_[values, 0], bound[:-1])
    out[bound[1:] == bound[:-1]] = 0
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; all are 0 for a text without words."""
    low = batches.LOWER[data]
    found = batches.words(low, offsets)
    hashes = batches.span_hashes(low, found.start, found.end)
    length = found.end - found.start
    lines = batches.words(low, offsets, NOT_BREAK)
    line_hashes = batches.span_hashes(low, lines.start, lines.end)
    n = np.diff(found.bound)
    n_lines = np.diff(lines.bound)
    size = np.maximum(_sums(length, found.bound), 1)
    some = np.maximum(n, 1)
    out = np.zeros((len(n), len(FEATURES)))
    out[:, 0] = np.log1p(n)
    out[:, 1] = size / some
    for column, table in ((2, UPPER), (3, SYMBOLS), (4, EXCLAIMS), (5, DIGITS), (6, STOPS)):
        out[:, column] = _sums(table[data], offsets) / size
    for t, (begin, end) in enumerate(zip(found.bound[:-1].tolist(), found.bound[1:].tolist(), strict=True)):
        if begin == end:
            continue
        mine = hashes[begin:end]
        counts = np.unique(mine, return_counts=True)[1]
        out[t, 7] = len(counts) / len(mine)
        out[t, 8] = counts.max() / len(mine)
        if len(mine) >= 3:
            runs = mine[:-2] * np.uint64(3) + mine[1:-1] * np.uint64(5) + mine[2:] * np.uint64(7)
            _, which, many = np.unique(runs, return_inverse=True, return_counts=True)
            again = np.r_[many[which] > 1, False, False]
            out[t, 9] = (again | np.r_[False, again[:-1]] | np.r_[False, False, again[:-2]]).mean()
        own = line_hashes[lines.bound[t] : lines.bound[t + 1]]
        out[t, 10] = 1 - len(np.unique(own)) / len(own)
    out[:, 11] = np.log1p(n / np.maximum(n_lines, 1))
    first = data[found.start] if len(found.start) else np.empty(0, np.uint8)
    out[:, 12] = _sums(UPPER[first], found.bound) / some
    out[:, 13] = _sums((length <= 3).astype(np.int64), found.bound) / some
    same = np.zeros(len(hashes), np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[found.bound[:-1][n > 0]] = 0
    out[:, 14] = _sums(same, found.bound) / some
    out[:, 15] = _sums(np.isin(hashes, COMMON_HASHES).astype(np.int64), found.bound) / some
    out[n == 0] = 0
    return out


class Model(NamedTuple):
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    squares: list[np.ndarray]

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self.bins(x, self.edges), strict=True):
            total += table[b]
        rough = self.bins(x, self.coarse)
        for (f, g), square in zip(self.pairs, self.squares, strict=True):
            total += square[rough[f], rough[g]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _stump(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values per bin of a tree grown best cut first on ordered bins."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best, where = 1e-9, None
        for b, e in parts:
            if e - b > 1:
                cg, ch = np.cumsum(g[b:e]), np.cumsum(h[b:e])
                gains = (
                    _gain(cg[:-1], ch[:-1], ridge)
                    + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], ridge)
                    - _gain(cg[-1], ch[-1], ridge)
                )
                i = int(np.argmax(gains))
                if gains[i] > best:
                    best, where = gains[i], (b, b + i + 1, e)
        if where is None:
            break
        parts.remove((where[0], where[2]))
        parts += [where[:2], where[1:]]
    out = np.empty(len(g))
    for b, e in parts:
        out[b:e] = g[b:e].sum() / (h[b:e].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cut of a square in both directions."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, where = 0.0, None
    if min(g.shape) > 1:
        corners = [
            (cg[:-1, :-1], ch[:-1, :-1]),
            (cg[:-1, -1:] - cg[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1]),
            (cg[-1:, :-1] - cg[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1]),
        ]
        rest = (cg[-1, -1] - sum(c[0] for c in corners), ch[-1, -1] - sum(c[1] for c in corners))
        gains = sum(_gain(a, b, ridge) for a, b in [*corners, rest]) - _gain(cg[-1, -1], ch[-1, -1], ridge)
        i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
        best, where = float(gains[i, j]), (i + 1, j + 1)
    out = np.zeros_like(g)
    if where:
        for rows in (slice(None, where[0]), slice(where[0], None)):
            for columns in (slice(None, where[1]), slice(where[1], None)):
                out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + ridge)
    return best, out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 32,
    coarse: int = 8,
    rounds: int = 60,
    pairs: int = 8,
    pair_rounds: int = 40,
    rate: float = 0.1,
    ridge: float = 4.0,
) -> Model:
    """Cyclic boosting of lookup tables; without rows every score is 0.5."""
    mean = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(mean / (1 - mean)))
    if not len(x):
        empty = [np.empty(0)] * len(FEATURES)
        return Model(intercept, empty, [np.zeros(1)] * len(FEATURES), empty, [], [])
    fine, rough = _edges(x, bins), _edges(x, coarse)
    b = [np.searchsorted(e, c, "right") for e, c in zip(fine, x.T, strict=True)]
    tables = [np.zeros(len(e) + 1) for e in fine]
    total = np.full(len(x), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(tables):
            g, h = slopes()
            step = rate * _stump(
                np.bincount(b[f], g, len(table)), np.bincount(b[f], h, len(table)), 3, ridge
            )
            table += step
            total += step[b[f]]
    r = [np.searchsorted(e, c, "right") for e, c in zip(rough, x.T, strict=True)]
    width = [len(e) + 1 for e in rough]

    def square(f: int, g: int) -> tuple[float, np.ndarray]:
        at, shape = r[f] * width[g] + r[g], (width[f], width[g])
        size = shape[0] * shape[1]
        down, curve = slopes()
        return _quadrants(
            np.bincount(at, down, size).reshape(shape), np.bincount(at, curve, size).reshape(shape), ridge
        )

    ranked = sorted(
        ((square(f, g)[0], f, g) for f in range(len(tables)) for g in range(f + 1, len(tables))), reverse=True
    )
    chosen = [(f, g) for gain, f, g in ranked[:pairs] if gain > 0]
    squares = [np.zeros((width[f], width[g])) for f, g in chosen]
    for _ in range(pair_rounds):
        for (f, g), table in zip(chosen, squares, strict=True):
            step = rate * square(f, g)[1]
            table += step
            total += step[r[f], r[g]]
    for f, table in enumerate(tables):  # tables are read as deviations from the intercept
        middle = float(table[b[f]].mean())
        table -= middle
        intercept += middle
    return Model(intercept, fine, tables, rough, chosen, squares)


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; documents of fold 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """The model of at most `sample` labelled rows outside the held-out fold.

    Several labels of a document count as their mean, null labels and ids not at all. Without
    labelled rows every score is 0.5.
    """
    marked = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(
        F.avg("quality").alias("y")
    )
    present = docs.select("doc_id").join(marked, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # `sample` ids at most
    chosen = F.broadcast(cut(present.dropDuplicates(["doc_id"])))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, data, offsets in batches.slices(part.column(1)):
                got = features(data, offsets)
                wide = pa.FixedSizeListArray.from_arrays(pa.array(got.ravel()), len(FEATURES))
                yield pa.record_batch(
                    [
                        part.column(0).slice(first, len(got)),
                        part.column(2).slice(first, len(got)),
                        wide.cast(pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "y", "features"],
                )

    vectors = batches.bounded(docs).select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "y")
    rows = vectors.mapInArrow(run, "doc_id long, y double, features array<double>").orderBy("doc_id", "features")
    rows = rows.limit(sample).collect()
    x = np.array([r["features"] for r in rows]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in rows], float))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs with `score` and `predicted`; own columns of these names are replaced."""
    own = docs.drop("score", "predicted")
    names = own.columns
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, data, offsets in batches.slices(part.column(names.index("text"))):
                rows = part.slice(first, len(offsets) - 1)
                scores = known.value.score(features(data, offsets))
                yield pa.record_batch(
                    [*rows.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    names=[*names, "score", "predicted"],
                )

    return batches.bounded(own).mapInArrow(run, f"{batches.ddl(own)}, score double, predicted int")


def score_documents(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text).

    Labels (doc_id, quality) are used as `learn` says. Null and empty texts are scored by
    features that are all 0; repeated rows are scored alike; a null doc_id is not held out. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = scored(docs.select("doc_id", "text"), learn(docs, labels, sample), threshold)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held_out, "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the model predicts to be good, with the columns of docs as they are.

    Own columns named `score` or `predicted` pass through like any other. Null and empty texts
    are judged by features that are all 0, rows with a null doc_id and repeated rows like others;
    an empty table gives an empty result.
    """
    other = aside(docs.columns, ("score", "predicted"))
    rows = scored(docs.withColumnsRenamed(other), learn(docs, labels, sample), threshold).where("predicted = 1")
    return rows.drop("score", "predicted").withColumnsRenamed({v: k for k, v in other.items()}).select(
        *[f"`{c}`" for c in docs.columns]
    )
