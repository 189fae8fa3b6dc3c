"""Repeated lines, paragraphs and sentences: the earliest occurrence stays, others are removed.

A unit is a line, a paragraph or, by default, a sentence (a line is also cut after . ! or ? at
the end of a word), so that a passage is found wherever in a line it was pasted. Very short sentences
are joined, very long ones cut at words whose hash is the least among their neighbours. Units are normalised (A-Z lowered, white space folded) and hashed; digests are grouped over all
documents, and a unit is repeated where its digest has an earlier place: in a document of
smaller doc_id, or further up in the same text. Removal is by runs: neighbouring repeated units
are one run, which goes if it has at least `least_words` words. Units below `unit_words` words
("See below.") repeat by chance, so they are not looked up; they go with a run around them.

Per digest and document one row is grouped, summed on the map side, so a line that a third of
all documents share is one row per task. Rows find their digest's first document in a join,
which adaptive execution splits when a digest is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut, unused

SHORT, JOINED, LONG, GAP = 4, 8, 32, 12

ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?"]] = True


def _evened(opens: np.ndarray, lines: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sentence starts with short neighbours joined and long stretches cut.

    Sentences below SHORT words that follow each other in a line are joined to groups of about
    JOINED words, counted from the last longer sentence. In sentences above LONG words a unit
    also starts at every word whose hash is the least, of equals the first, of the SHORT - 1
    words before and after it, wherever the sentence began; about every seventh word, so that
    repeated runs of words share their boundaries. Where none comes (words that alternate), a
    unit starts every GAP words. No unit of a long sentence is below SHORT words.
    """
    first = np.flatnonzero(opens)
    size = np.diff(np.r_[first, len(opens)])
    short = size < SHORT
    sync = ~short | np.r_[True, ~short[:-1]] | lines[first]
    start = np.maximum.accumulate(np.where(sync, first, 0))
    group = (first - start) // JOINED
    keep = sync | (group != np.r_[-1, group[:-1]])
    out = np.zeros_like(opens)
    out[first[keep]] = True
    n, stretch = len(opens), np.repeat(np.arange(len(first)), size)
    index = np.arange(n)
    inner = np.repeat(size > LONG, size)
    inner &= (index - first[stretch] >= SHORT) & (first[stretch] + size[stretch] - index >= SHORT)
    cuts = inner.copy()
    for d in range(1, SHORT):
        cuts[d:] &= (hashes[d:] < hashes[:-d]) | (stretch[d:] != stretch[:-d])
        cuts[:-d] &= (hashes[:-d] <= hashes[d:]) | (stretch[d:] != stretch[:-d])
    out |= cuts
    starts = np.flatnonzero(out)
    unit = np.searchsorted(starts, index, "right") - 1
    since, left = index - starts[unit], np.r_[starts[1:], n][unit] - index
    return out | (inner & (since > 0) & (since % GAP == 0) & (left >= SHORT))


def units(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """Per unit: text, first byte, end byte, words, digest. Units hold at least one word."""
    low = batches.LOWER[data]
    found = batches.words(low, offsets)
    n = len(found.start)
    if not n:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    breaks = np.r_[0, np.cumsum(low == 10)]
    between = breaks[found.start[1:]] - breaks[found.end[:-1]]
    opens = np.ones(n, dtype=bool)
    opens[1:] = between >= (2 if unit == "paragraph" else 1)
    if unit == "sentence":
        opens[1:] |= ENDS[low[found.end[:-1] - 1]]
    opens[found.bound[:-1][found.bound[:-1] < n]] = True
    hashes = batches.span_hashes(low, found.start, found.end)
    if unit == "sentence":
        lines = between >= 1
        lines = np.r_[True, lines]
        lines[found.bound[:-1][found.bound[:-1] < n]] = True
        opens = _evened(opens, lines, hashes)
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], n]
    up, down = batches.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    digest = batches.mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    text = np.searchsorted(found.bound, first, "right") - 1
    return text, found.start[first], found.end[last - 1], last - first, digest


def occurrences(docs: DataFrame, unit: str, unit_words: int) -> DataFrame:
    """doc_id, th, no, start, stop (code points), n, digest, again (seen further up the text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, data, offsets in batches.slices(part.column(1)):
                text, first, last, n, digest = units(data, offsets, unit)
                long = n >= unit_words
                text, first, last, n, digest = (x[long] for x in (text, first, last, n, digest))
                point = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                base = point[offsets[text]]
                order = np.lexsort((np.arange(len(text)), digest, text))
                again = np.zeros(len(text), dtype=bool)
                if len(text) > 1:
                    a, b = order[1:], order[:-1]
                    again[a] = (digest[a] == digest[b]) & (text[a] == text[b])
                begins = np.searchsorted(text, text, "left")
                at = pa.array(text + row, pa.int64())
                yield pa.record_batch(
                    [
                        part.column(0).take(at),
                        part.column(2).take(at),
                        pa.array(np.arange(len(text)) - begins, pa.int32()),
                        pa.array(point[first] - base, pa.int32()),
                        pa.array(point[last] - base, pa.int32()),
                        pa.array(n, pa.int32()),
                        pa.array(digest.view(np.int64), pa.int64()),
                        pa.array(again),
                    ],
                    names=["doc_id", "th", "no", "start", "stop", "n", "digest", "again"],
                )

    return batches.bounded(docs).select("doc_id", "text", text_hash().alias("th")).mapInArrow(
        run, "doc_id long, th long, no int, start int, stop int, n int, digest long, again boolean"
    )


def text_hash() -> Column:
    return F.xxhash64("text")


def repeated_runs(
    docs: DataFrame, unit: str = "sentence", least_words: int = 20, unit_words: int = 4
) -> DataFrame:
    """doc_id, th (hash of the text), spans: the runs to remove, as (start, stop, words) in order.

    Offsets are code points of the original text, stop exclusive. Only documents with a run
    have a row. Null and empty texts have none; a null doc_id ranks after all others. Rows that
    share a doc_id count as one document: they do not remove each other's units. An empty
    table gives an empty result; other columns are ignored.
    """
    found = cut(occurrences(docs, unit, unit_words))
    late = F.coalesce("doc_id", F.lit(2**63 - 1))
    firsts = cut(
        found.where(~F.col("again"))
        .groupBy("digest")
        .agg(F.min(late).alias("first"), F.max(late).alias("last"))
        .where("first < last")
    )
    elsewhere = found.join(firsts, "digest", "left").where(F.col("again") | (late > F.col("first")))
    own = Window.partitionBy("doc_id", "th").orderBy("no")
    lanes = elsewhere.select("doc_id", "th", "no", "start", "stop", "n").distinct()
    runs = (
        lanes.withColumn("run", F.col("no") - F.row_number().over(own))
        .groupBy("doc_id", "th", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n").alias("words"))
        .where(F.col("words") >= least_words)
    )
    return runs.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "words"))).alias("spans")
    )


def without(text: Column, spans: Column) -> Column:
    """The text without the spans (sorted, disjoint, code points)."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    cutter = F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            x["stop"].alias("at"),
            F.concat(s["kept"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).alias("kept"),
        ),
        lambda s: F.concat(s["kept"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])),
    )
    return F.when(F.size(spans) > 0, cutter).otherwise(text)


def remove_repeats(
    docs: DataFrame, unit: str = "sentence", least_words: int = 20, unit_words: int = 4
) -> DataFrame:
    """The rows of docs with repeated runs cut from `text`, and `removed`: their original spans.

    Every row stays, with an empty array where nothing was removed; an own column `removed` is
    replaced. Nulls, ties and repeated rows as in `repeated_runs`.
    """
    ident, th, cuts = (unused(docs.columns, name) for name in ("id", "th", "spans"))
    runs = repeated_runs(docs, unit, least_words, unit_words).select(
        F.col("doc_id").alias(ident), F.col("th").alias(th), F.col("spans").alias(cuts)
    )
    joined = docs.drop("removed").join(
        runs, F.col("doc_id").eqNullSafe(F.col(ident)) & (text_hash() == F.col(th)), "left"
    )
    spans = F.coalesce(cuts, F.array().cast("array<struct<start:int,stop:int,words:bigint>>"))
    columns = [
        without(F.col("text"), spans).alias("text") if c == "text" else F.col(f"`{c}`")
        for c in docs.columns
        if c != "removed"
    ]
    return joined.select(*columns, spans.alias("removed"))
