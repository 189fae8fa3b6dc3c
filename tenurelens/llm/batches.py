"""Texts of an Arrow batch as numpy arrays: bytes, word bounds, 64-bit word hashes.

A batch is cut into slices of about `SLICE_BYTES`, so that the arrays made per byte stay
small whatever the number of rows; a text is never cut. All delimiters used here are ASCII,
so working on UTF-8 bytes gives the same words as working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: words are runs of anything but space and \t \n \v \f \r
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

#: words are runs of ASCII letters, digits and everything beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Words(NamedTuple):
    """Word w covers bytes start[w]:end[w]; text t has the words bound[t]:bound[t + 1]."""

    start: np.ndarray
    end: np.ndarray
    bound: np.ndarray


def ddl(df: DataFrame) -> str:
    """The schema of a table as text, for operators that pass its columns through."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def bounded(df: DataFrame) -> DataFrame:
    """The table, in a session whose Arrow batches hold at most about BATCH_BYTES.

    Spark's own limit (64 MB by default) is per task, twice in the JVM and again in Python;
    a lower one that is set already stays.
    """
    conf = df.sparkSession.conf
    limit = conf.get("spark.sql.execution.arrow.maxBytesPerBatch").lower().rstrip("b")
    if not limit.lstrip("-").isdigit() or not 0 < int(limit) <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, n + 1 offsets into them) of consecutive rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        begin, end = offsets[first], offsets[last]
        yield first, data[begin:end], offsets[first : last + 1] - begin
        first = last
    del column, where, data, offsets
    pa.default_memory_pool().release_unused()


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE) -> Words:
    """Runs of bytes for which `kind` holds; a run ends where its text ends."""
    inside = kind[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for slot, base in enumerate((_BASE, _INVERSE)):
            run = np.full(n, base, np.uint64)
            run[0] = 1
            _POWERS[slot] = np.cumprod(run, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal content wherever it lies."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def same_bytes(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_start: np.ndarray, other_end: np.ndarray
) -> np.ndarray:
    """Whether each (non-empty) span of `data` spells the same as its partner in `other`."""
    same = (end - start) == (other_end - other_start)
    todo = np.flatnonzero(same)
    size = (end - start)[todo]
    for part in np.split(np.arange(len(todo)), np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1):
        if len(part):
            n = size[part]
            begin = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(begin, n)
            equal = data[np.repeat(start[todo[part]], n) + step] == other[np.repeat(other_start[todo[part]], n) + step]
            same[todo[part]] = np.logical_and.reduceat(equal, begin)
    return same
