"""Ranked lexical search: term at a time with limited accumulators, over blocks of documents.

Two passes over the documents, neither of which moves a text. The first counts how many
documents hold each term of the items, the second scores. A task turns its documents block by
block into postings (term, document, tf) of the terms that are asked for and works through each
item's terms, rarest first. As soon as the best that the remaining terms can add lies below the
k-th best partial score, no document gets a new accumulator; those that have one are still
summed exactly. The k best of the blocks before count for that limit, so most items pass over
most blocks without a sum. A task ends with at most k rows per item, which one window ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut

DOCUMENTS, WORDS = -1, -2


class Terms(NamedTuple):
    """Distinct terms in the order of their hashes; term t is letters[start[t]:end[t]]."""

    hashes: np.ndarray
    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray


class Items(NamedTuple):
    """Item i asks for term[bound[i]:bound[i + 1]], rarest first, each weighing weight[...]."""

    bound: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def split(column: pa.Array) -> tuple[Terms, np.ndarray, np.ndarray]:
    """The distinct terms of texts, and per text the begin of its term numbers among all of them."""
    spelled: dict[bytes, int] = {}
    numbers: list[int] = []
    bound = [0]
    for _, data, offsets in batches.slices(column):
        data = batches.LOWER[data]
        found = batches.words(data, offsets, batches.ALNUM)
        whole = data.tobytes()
        numbers += [
            spelled.setdefault(whole[s:e], len(spelled))
            for s, e in zip(found.start.tolist(), found.end.tolist(), strict=True)
        ]
        base = bound[-1]
        bound += (base + found.bound[1:]).tolist()
    letters = np.frombuffer(b"".join(spelled), np.uint8)
    size = np.fromiter(map(len, spelled), np.int64, len(spelled))
    end = np.cumsum(size)
    hashes = batches.span_hashes(letters, end - size, end)
    order = np.argsort(hashes, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    terms = Terms(hashes[order], letters, (end - size)[order], end[order])
    return terms, number[np.array(numbers, np.int64)], np.array(bound, np.int64)


def lookup(data: np.ndarray, start: np.ndarray, end: np.ndarray, terms: Terms) -> np.ndarray:
    """The term that each span spells, or -1; equal hashes are confirmed letter by letter."""
    found = np.full(len(start), -1, np.int64)
    hashes = batches.span_hashes(data, start, end)
    at = np.searchsorted(terms.hashes, hashes)
    open_ = np.flatnonzero(at < len(terms.hashes))
    while len(open_):
        open_ = open_[at[open_] < len(terms.hashes)]
        open_ = open_[terms.hashes[at[open_]] == hashes[open_]]
        t = at[open_]
        same = batches.same_bytes(data, start[open_], end[open_], terms.letters, terms.start[t], terms.end[t])
        found[open_[same]] = t[same]
        open_ = open_[~same]
        at[open_] += 1
    return found


def _blocks(parts: Iterator[pa.RecordBatch], terms: Terms) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, words per document, document, term) of every word asked for, block by block."""
    for part in parts:
        for first, data, offsets in batches.slices(part.column(1)):
            data = batches.LOWER[data]
            found = batches.words(data, offsets, batches.ALNUM)
            n = np.diff(found.bound)
            term = lookup(data, found.start, found.end, terms)
            doc = np.repeat(np.arange(len(n)), n)[term >= 0]
            yield part.column(0).slice(first, len(n)), n, doc, term[term >= 0]


def census(docs: DataFrame, terms) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, documents holding each term asked for."""
    size = len(terms.value.hashes)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        documents = words = 0
        for _, n, doc, term in _blocks(parts, terms.value):
            documents += int((n > 0).sum())
            words += int(n.sum())
            held += np.bincount(np.unique(doc * size + term) % max(size, 1), minlength=size)
        some = np.flatnonzero(held)
        yield pa.record_batch(
            [np.r_[DOCUMENTS, WORDS, some], np.r_[documents, words, held[some]]], names=["term", "n"]
        )

    counted = batches.bounded(docs).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size, np.int64)
    total = {DOCUMENTS: 0, WORDS: 0}
    for term, n in counted.toLocalIterator():
        if term < 0:
            total[term] = n
        else:
            df[term] = n
    return total[DOCUMENTS], total[WORDS], df


def weigh(numbers: np.ndarray, bound: np.ndarray, df: np.ndarray, documents: int) -> Items:
    """The items with their terms rarest first; a term repeated in an item weighs as often."""
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    begin, term, total = [0], [], []
    for b, e in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        t, times = np.unique(numbers[b:e], return_counts=True)
        order = np.lexsort((t, df[t]))
        term.append(t[order])
        total.append((weight[t] * times)[order])
        begin.append(begin[-1] + len(t))
    flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (term, total)]
    return Items(np.array(begin, np.int64), *flat)


class Postings(NamedTuple):
    """Documents and impacts of a block, term after term; slot[t] is the run of term t or -1."""

    doc: np.ndarray
    impact: np.ndarray
    begin: np.ndarray
    slot: np.ndarray
    peak: np.ndarray


def postings(n: np.ndarray, doc: np.ndarray, term: np.ndarray, size: int, documents: int, words: int) -> Postings:
    code, tf = np.unique(term * len(n) + doc, return_counts=True)
    term, doc = code // len(n), code % len(n)
    length = 75 + 25 * n * documents // max(words, 1)
    impact = 10**9 * tf // (1000 * tf + 12 * length[doc])
    held, begin = np.unique(term, return_index=True)
    slot = np.full(size, -1, np.int64)
    slot[held] = np.arange(len(held))
    peak = np.zeros(size, np.int64)
    if len(held):
        peak[held] = np.maximum.reduceat(impact, begin)
    return Postings(doc, impact, np.r_[begin, len(doc)], slot, peak)


def accumulate(
    block: Postings, n_docs: int, term: np.ndarray, weight: np.ndarray, bound: np.ndarray, k: int, floor: int
) -> np.ndarray:
    """Scores by document: exact for all that can be among the k best, and at least `floor`.

    `bound` is the most that each term adds in this block. A document without an accumulator
    when those left cannot reach the k-th partial score is not among the k best.
    """
    score = np.zeros(n_docs, np.int64)
    live = np.zeros(n_docs, bool)
    rest, open_ = int(bound.sum()), True
    for t, w, most in zip(term.tolist(), weight.tolist(), bound.tolist(), strict=True):
        if not most:
            continue
        run = slice(block.begin[block.slot[t]], block.begin[block.slot[t] + 1])
        doc, gain = block.doc[run], w * block.impact[run]
        if open_:
            partial = score[live]
            kth = int(np.partition(partial, -k)[-k]) if len(partial) >= k else 0
            open_ = rest >= max(kth, floor)
            if not open_ and not len(partial):
                break
        if open_:
            live[doc] = True
        else:
            on = live[doc]
            doc, gain = doc[on], gain[on]
        score[doc] += gain
        rest -= most
    return score


def best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _search(docs: DataFrame, block: list[tuple[object, str | None]], k: int) -> DataFrame:
    """(item number, doc_id, score) of the k best rows of every task."""
    spark = docs.sparkSession
    spelled, numbers, bound = split(pa.array([text for _, text in block], pa.string()))
    terms = spark.sparkContext.broadcast(spelled)
    documents, words, df = census(docs, terms)
    asked = spark.sparkContext.broadcast(weigh(numbers, bound, df, documents))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, size = asked.value, len(terms.value.hashes)
        some = np.flatnonzero(np.diff(items.bound))
        top = {int(i): (np.empty(0, np.int64), np.empty(0, np.int64)) for i in some}
        floor = np.zeros(len(items.bound) - 1, np.int64)
        for ids, n, doc, term in _blocks(parts, terms.value):
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            on = named[doc]
            got = postings(n, doc[on], term[on], size, documents, words)
            most = items.weight * got.peak[items.term]
            total = np.add.reduceat(most, items.bound[some]) if len(some) else np.empty(0, np.int64)
            for i in some[(total > 0) & (total >= floor[some])].tolist():
                run_ = slice(items.bound[i], items.bound[i + 1])
                score = accumulate(got, len(n), items.term[run_], items.weight[run_], most[run_], k, int(floor[i]))
                kept = np.flatnonzero(score >= max(int(floor[i]), 1))
                if len(kept):
                    old = top[i]
                    top[i] = best(np.r_[old[0], ids[kept]], np.r_[old[1], score[kept]], k)
                    if len(top[i][0]) == k:
                        floor[i] = top[i][1][-1]
        for i, (ids, score) in top.items():
            if len(ids):
                yield pa.record_batch([np.full(len(ids), i), ids, score], names=["item", "doc_id", "score"])

    return batches.bounded(docs).mapInArrow(run, "item long, doc_id long, score long")


def _blocks_of_items(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[object, str | None]]]:
    block, size = [], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        block.append((item, text))
        size += len((text or "").encode()) + 64
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def rank(docs: DataFrame, benchmark: DataFrame, k: int = 20, chunk_bytes: int = 2 << 20) -> DataFrame:
    """The k documents of highest score for each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters, digits and all beyond ASCII, lower-cased in A-Z only; the
    score is the integer one of `postings` and `weigh`. Equal scores go by ascending doc_id;
    documents without a common term, or of score 0, are not listed. Null and empty texts have no
    terms. A row of docs is a document: a repeated doc_id is listed as often as its rows score;
    one without doc_id counts in all statistics but is not listed. A row of benchmark is an
    item: rows of one item_id (or of none) are ranked by themselves. Other columns are not read.
    `chunk_bytes` bounds the item text that is sent to tasks at once; more means more passes.
    """
    spark = docs.sparkSession
    mine = docs.select(F.col("doc_id").cast("long"), "text")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    out = None
    for block in _blocks_of_items(benchmark, chunk_bytes):
        found = _search(mine, block, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(block)], f"item long, item_id {kind}")
        part = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else cut(out).unionAll(cut(part))
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, row_number() OVER () AS q, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), total AS (
  SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d
), asked AS (
  SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(w) AS term FROM i) GROUP BY ALL
), tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times
    * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_words))))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) CROSS JOIN total
  WHERE doc_id IS NOT NULL GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
