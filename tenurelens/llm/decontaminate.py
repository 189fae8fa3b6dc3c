"""Benchmark passages in documents: Wu-Manber multi-pattern search over words.

The alphabet is the word: a text is the sequence of 64-bit hashes of its words, a pattern is a
window of consecutive item words. Patterns of one length m share the tables of the algorithm:

* shift: for a block of two words, how far the end of a candidate window may move on; a block
  that no pattern holds allows m - 1 words at once;
* suffix buckets: the patterns that end in a block with shift 0, looked up by that block;
* a candidate from a bucket is compared word by word, first by hash, then by its bytes.

Positions are scanned side by side: a text is cut into lanes of window ends, and numpy moves
all lanes at once by their own shifts, so probes are made only where the tables allow a match.

Items are taken in chunks of bounded size; each chunk is one broadcast and one pass over the
documents, which carry their spans from pass to pass. Nothing of the documents is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import aside, cut

TABLE_BITS = 20
LANE = 48


class Items(NamedTuple):
    """All words of the items, one after another: hashes, and where each lies in `text`.

    In `text` the words of an item are joined by one space, so a window is a piece of it.
    """

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: bytes
    names: list[str]


class Tables(NamedTuple):
    """Search tables of the patterns of one length; pattern p is the words from first[p] on and
    belongs to the items owner[bound[p]:bound[p + 1]]."""

    length: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray
    order: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    bound: np.ndarray
    items: Items


def _split(text: str) -> tuple[np.ndarray, list[bytes]]:
    raw = batches.LOWER[np.frombuffer(text.encode(), np.uint8)]
    found = batches.words(raw, np.array([0, len(raw)]), batches.ALNUM)
    hashes = batches.span_hashes(raw, found.start, found.end)
    whole = raw.tobytes()
    return hashes, [whole[s:e] for s, e in zip(found.start.tolist(), found.end.tolist(), strict=True)]


def _blocks(ends: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    return batches.mix(ends if before is None else ends * np.uint64(3) + before * np.uint64(7))


def build(items: list[tuple[str, str]], window: int) -> list[Tables]:
    """Tables for all windows of (item id, text); an item shorter than a window is one itself."""
    hashes, texts, sizes, names = [], [], [], []
    by_length: dict[int, dict[bytes, tuple[int, set[int]]]] = {}
    at = 0
    for ident, text in items:
        mine, tokens = _split(text or "")
        size = min(window, len(tokens))
        for i in range(len(tokens) - size + 1 if size else 0):
            key = b" ".join(tokens[i : i + size])
            by_length.setdefault(size, {}).setdefault(key, (at + i, set()))[1].add(len(names))
        if size:
            hashes.append(mine)
            texts.append(b" ".join(tokens))
            sizes.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
            names.append(ident)
            at += len(tokens)
    if not names:
        return []
    # words and items are one space apart
    size = np.concatenate(sizes)
    end = np.cumsum(size + 1) - 1
    whole = Items(np.concatenate(hashes), end - size, end, b" ".join(texts), names)
    out = []
    for length, patterns in sorted(by_length.items()):
        first = np.fromiter((p[0] for p in patterns.values()), np.int64, len(patterns))
        block = min(2, length)
        shift = np.full(1 << TABLE_BITS, length - block + 1, np.min_scalar_type(length))
        for j in range(block - 1, length):
            keys = _blocks(whole.hashes[first + j], whole.hashes[first + j - 1] if block == 2 else None)
            np.minimum.at(shift, (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64), shift.dtype.type(length - 1 - j))
        ends = first + length - 1
        last = _blocks(whole.hashes[ends], whole.hashes[ends - 1] if block == 2 else None)
        order = np.argsort(last, kind="stable")
        owners = [sorted(p[1]) for p in patterns.values()]
        owner = np.fromiter((i for mine in owners for i in mine), np.int32)
        bound = np.r_[0, np.cumsum([len(mine) for mine in owners])]
        out.append(Tables(length, block, shift, last[order], order, first, owner, bound, whole))
    return out


def search(hashes: np.ndarray, bound: np.ndarray, table: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(index of the last word, pattern) of every window whose word hashes equal a pattern's."""
    m = table.length
    first, stop = bound[:-1] + m - 1, bound[1:]
    lanes = np.maximum(-(-(stop - first) // LANE), 0)
    begin = np.repeat(first, lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    end = np.minimum(begin + LANE, np.repeat(stop, lanes))
    at, found_at, found = begin, [], []
    while len(at):
        key = _blocks(hashes[at], hashes[at - 1] if table.block == 2 else None)
        step = table.shift[(key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.int64)
        stops = np.flatnonzero(step == 0)
        if len(stops):
            low = np.searchsorted(table.suffix, key[stops], "left")
            many = np.searchsorted(table.suffix, key[stops], "right") - low
            where = np.repeat(at[stops], many)
            bucket = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pattern = table.order[bucket]
            for j in range(m):
                same = hashes[where - (m - 1) + j] == table.items.hashes[table.first[pattern] + j]
                where, pattern = where[same], pattern[same]
            found_at.append(where)
            found.append(pattern)
        at = at + np.maximum(step, 1)
        go = at < end
        at, end = at[go], end[go]
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found)


def scan(data: np.ndarray, offsets: np.ndarray, tables: list[Tables]) -> tuple[np.ndarray, list[list[int]], list[set[str]]]:
    """Per text: number of words, begins and ends (word numbers) of hit runs, flat, and item ids."""
    data = batches.LOWER[data]
    found = batches.words(data, offsets, batches.ALNUM)
    hashes = batches.span_hashes(data, found.start, found.end)
    n = len(offsets) - 1
    cover = np.zeros(len(hashes) + 1, np.int32)
    items: list[set[str]] = [set() for _ in range(n)]
    whole = data.tobytes() if tables else b""
    for table in tables:
        for last, pattern in zip(*(x.tolist() for x in search(hashes, found.bound, table)), strict=True):
            begin = last - table.length + 1
            spelled = b" ".join(
                whole[s:e] for s, e in zip(found.start[begin : last + 1].tolist(), found.end[begin : last + 1].tolist(), strict=True)
            )
            known, at = table.items, int(table.first[pattern])
            if spelled == known.text[known.start[at] : known.end[at + table.length - 1]]:
                cover[begin] += 1
                cover[last + 1] -= 1
                owners = table.owner[table.bound[pattern] : table.bound[pattern + 1]]
                items[int(np.searchsorted(found.bound, last, "right")) - 1].update(known.names[i] for i in owners)
    hit = np.cumsum(cover[:-1]) > 0
    spans: list[list[int]] = [[] for _ in range(n)]
    for t in np.flatnonzero(np.add.reduceat(np.r_[hit, False], found.bound[:-1]) > 0).tolist() if hit.any() else []:
        begin, end = found.bound[t], found.bound[t + 1]
        if begin < end:
            edge = np.diff(np.r_[0, hit[begin:end].astype(np.int8), 0])
            spans[t] = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1).ravel().tolist()
    return np.diff(found.bound), spans, items


def merge(x: list[int], y: list[int]) -> list[int]:
    """Union of two flat lists of half-open spans."""
    if not x or not y:
        return x or y
    out: list[int] = []
    for b, e in sorted(list(zip(x[::2], x[1::2], strict=True)) + list(zip(y[::2], y[1::2], strict=True))):
        if out and b <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [b, e]
    return out


def _pass(docs: DataFrame, chunk, state: str, text: str) -> DataFrame:
    """One search over all documents; `state` is the struct column that carries the findings."""
    names = [c for c in docs.columns if c != state]
    kind = "struct<n_words:bigint,spans:array<bigint>,items:array<string>>"
    shape = pa.struct(
        [("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = chunk.value
        for part in parts:
            for first, data, offsets in batches.slices(part.column(names.index(text))):
                rows = part.slice(first, len(offsets) - 1)
                counts, spans, items = scan(data, offsets, tables)
                old = rows.column(len(names)).to_pylist() if len(rows.columns) > len(names) else [None] * len(spans)
                new = [
                    {
                        "n_words": int(c),
                        "spans": merge(o["spans"], s) if o else s,
                        "items": sorted(i.union(o["items"]) if o else i),
                    }
                    for c, s, i, o in zip(counts, spans, items, old, strict=True)
                ]
                yield pa.record_batch([*rows.columns[: len(names)], pa.array(new, shape)], names=[*names, state])

    ordered = docs.select(*names, *([state] if state in docs.columns else []))
    return batches.bounded(ordered).mapInArrow(run, f"{batches.ddl(docs.select(*names))}, `{state}` {kind}")


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = 13,
    share: int = 20,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """Rows of `docs` with a struct column `found`.

    Its fields: n_words, n_hit (words inside occurrences), n_items, items (ids as strings,
    sorted), spans (begin, end word numbers, flat), contaminated (n_hit > 0 and
    share * n_hit >= n_words). Null and empty texts have no words and are never contaminated;
    an item without words matches nothing; a null item_id counts as ''; repeated items and
    documents keep their own rows. Other columns pass through, an own `found` is replaced.
    `chunk_bytes` bounds the item text in one broadcast; more items mean more passes.
    """
    spark = docs.sparkSession
    state = "found"
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    out = docs.drop(state)
    for c in range(chunks):
        mine = items.where(F.pmod(F.xxhash64("i"), F.lit(chunks)) == c) if chunks > 1 else items
        tables = build([(r[0], r[1]) for r in mine.toLocalIterator()], window)
        out = _pass(out, spark.sparkContext.broadcast(tables), state, text)
        if c + 1 < chunks:
            # else the tables of all passes would be in memory together
            out = cut(out)
    s = F.col(f"{state}.spans")
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size(s) - 2, F.lit(2)), F.lit(0).cast("long"), lambda a, i: a + F.get(s, i + 1) - F.get(s, i)
    )
    n_hit = F.when(F.size(s) > 0, hit).otherwise(F.lit(0).cast("long"))
    out = out.withColumn(state, F.col(state).withField("n_hit", n_hit))
    n_words, n_hit = F.col(f"{state}.n_words"), F.col(f"{state}.n_hit")
    return out.withColumn(
        state,
        F.col(state)
        .withField("n_items", F.size(f"{state}.items").cast("long"))
        .withField("contaminated", (n_hit > 0) & (share * n_hit >= n_words)),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs as they are.

    A column of docs named `found` passes through like any other. Null and empty texts and rows
    with a null doc_id stay, repeated rows are judged alike, without items all rows stay; an
    empty table gives an empty result.
    """
    other = aside(docs.columns, ("found",))
    kept = find_passages(docs.withColumnsRenamed(other), benchmark).where(~F.col("found.contaminated")).drop("found")
    return kept.withColumnsRenamed({v: k for k, v in other.items()}).select(*[f"`{c}`" for c in docs.columns])
