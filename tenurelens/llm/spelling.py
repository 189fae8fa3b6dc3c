"""Spelling variants: words one edit apart, by a bit-sliced position index of the vocabulary.

For every position and letter a bitset holds the words that have this letter there. Reading a
word letter by letter, one AND per letter keeps the set of words that agree so far (no error),
and three sets with one error go along: `same` where a letter was replaced (same positions),
`less` where the read word has a letter more (one position back) and `more` where it has one
less (one position on). All words of one length in a task are read together.

Words that are one edit apart share their first half or their second half, halves taken by the
shorter length. So a word of n letters is looked up under four keys: its halves for the lengths
n and n - 1. Rows are counted by key first; a key of more rows than a unit holds is cut into
blocks, each of which meets each other block in a unit of its own. A pair is reported under the
first half where it agrees and else under the second, so every pair is counted once. Pairs
never leave a unit: it returns the number of near words and the best one of each word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut

#: letters: A-Z, a-z and the two-byte code points U+00C0 to U+00FF, which begin with 0xC3
LEAD = 0xC3
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[LEAD] = True

FRONT, BACK = 0, 1
MOST_LARGE = 1_000_000
#: words longer than this are checked with zlib one by one
VECTOR_BYTES = 64

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each span, continued from the crc32 `seed` of what comes before it."""
    size = end - start
    out = np.empty(len(size), np.uint32)
    short = np.flatnonzero(size <= VECTOR_BYTES)
    short = short[np.argsort(-size[short], kind="stable")]
    state, at = seed[short] ^ np.uint32(0xFFFFFFFF), start[short]
    ends = np.searchsorted(-size[short], -np.arange(size[short].max(initial=0)), "left")
    for j, n in enumerate(ends.tolist()):
        now = state[:n]
        state[:n] = _CRC[(now ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    out[short] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > VECTOR_BYTES).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(seed[i]))
    return out


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one span, number of spans) for spans that spell the same, compared by letters."""
    _, first, group = np.unique(batches.span_hashes(data, start, end), return_index=True, return_inverse=True)
    like = first[group]
    same = batches.same_bytes(data, start, end, data, start[like], end[like])
    count = np.bincount(group[same], minlength=len(first))
    odd = np.flatnonzero(~same)
    return np.r_[first, odd], np.r_[count, np.ones(len(odd), np.int64)]


def _counted(ids: list, column: pa.Array, least: int, every: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """(words, occurrences) of texts; a checksum that `every` divides costs its word one letter."""
    for first, data, offsets in batches.slices(column):
        data = batches.LOWER[data]
        kinds = data.copy()
        after = np.flatnonzero(data[:-1] == LEAD) + 1
        kinds[after] = LEAD
        found = batches.words(kinds, offsets, LETTER)
        letters = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        n = letters[found.end] - letters[found.start]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(found.bound))
        on = n >= least
        start, end, n, text = found.start[on], found.end[on], n[on], text[on]
        if not len(start):
            continue
        seeds = np.array(
            [zlib.crc32(b":" if i is None else b"%d:" % i) for i in ids[first : first + len(offsets) - 1]], np.uint32
        )
        crc = checksums(data, start, end, seeds[text])
        hit = crc % every == 0
        whole = data.tobytes()
        index, count = distinct(data, start[~hit], end[~hit])
        s, e = start[~hit][index], end[~hit][index]
        words = [whole[a:b].decode() for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        cut_ = []
        for a, b, size, h in zip(start[hit].tolist(), end[hit].tolist(), n[hit].tolist(), crc[hit].tolist(), strict=True):
            if size > least:
                word, i = whole[a:b].decode(), h % size
                cut_.append(word[:i] + word[i + 1 :])
        yield words + cut_, np.r_[count, np.ones(len(cut_), np.int64)]


def vocabulary(docs: DataFrame, least: int = 7, every: int = 31, copies: int = 2) -> DataFrame:
    """(word, n) of all words with at least `least` code points and `copies` occurrences."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for words, n in _counted(part.column(0).to_pylist(), part.column(1), least, every):
                yield pa.record_batch([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    found = batches.bounded(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= copies)


class Index(NamedTuple):
    """Bitsets over words: row[code] of `bits` for code = position * letters + letter, the last row is empty."""

    codes: np.ndarray
    bits: np.ndarray
    alphabet: np.ndarray


def bitsets(member: np.ndarray, group: np.ndarray, n_groups: int, width: int) -> np.ndarray:
    """One bitset of `width` 64-bit words per group, with the bits of its members."""
    out = np.zeros((n_groups, width), np.uint64)
    np.bitwise_or.at(out, (group, member >> 6), np.uint64(1) << (member & 63).astype(np.uint64))
    return out


def build(letters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Index:
    """The position index of words given as code points."""
    alphabet = np.unique(letters)
    word = np.repeat(np.arange(len(size)), size)
    position = np.arange(len(letters)) - np.repeat(begin, size)
    code = position * len(alphabet) + np.searchsorted(alphabet, letters)
    codes, group = np.unique(code, return_inverse=True)
    width = (len(size) + 63) // 64
    return Index(codes, np.r_[bitsets(word, group, len(codes), width), np.zeros((1, width), np.uint64)], alphabet)


def at(index: Index, position: int, letter: np.ndarray) -> np.ndarray:
    """The bitset of each letter at a position."""
    code = position * len(index.alphabet) + letter
    row = np.minimum(np.searchsorted(index.codes, code), len(index.codes) - 1)
    return index.bits[np.where((index.codes[row] == code) & (position >= 0), row, len(index.codes))]


def near(index: Index, words: np.ndarray, lengths: dict[int, np.ndarray], half: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitsets of the words one edit away from each read word, and of those that agree on its first `half` letters.

    `words` holds one read word per row (numbers in the alphabet), `lengths` the words of each length.
    """
    n, m = words.shape
    width = index.bits.shape[1]
    none = np.zeros((n, width), np.uint64)
    agree, same, less, more, front = ~none, none, none, none, ~none
    now, before = at(index, 0, words[:, 0]), none
    for i in range(m):
        after = at(index, i + 1, words[:, i])
        less = (less & before) | agree
        more = (more | agree) & after
        same = (same & now) | (agree & ~now)
        agree = agree & now
        if i + 1 == half:
            front = agree
        if i + 1 < m:
            now, before = at(index, i + 1, words[:, i + 1]), at(index, i, words[:, i + 1])
    empty = np.zeros(width, np.uint64)
    found = (same & lengths.get(m, empty)) | (less & lengths.get(m - 1, empty)) | ((more | agree) & lengths.get(m + 1, empty))
    return found, front


#: read words whose bitsets are in memory together
ROWS_BYTES = 4 << 20


def solve(table: pa.Table) -> Iterator[tuple[list[str], np.ndarray, list[str], np.ndarray]]:
    """(words, near words, best near word, its occurrences) by shorter length and unit; see `variants`."""
    words = table.column("word").to_pylist()
    n, short, side, unit, role = (table.column(c).to_numpy() for c in ("n", "short", "side", "unit", "role"))
    for s in np.unique(short).tolist():
        member = np.flatnonzero((short == s) & (role & 1 > 0)).tolist()
        asking = np.flatnonzero((short == s) & (role & 2 > 0))
        # the first bit of a bitset is its best word
        member.sort(key=lambda i: (-n[i], words[i]))
        member = np.array(member, np.int64)
        if not len(member) or not len(asking):
            continue
        size = np.array([len(words[i]) for i in member], np.int64)
        letters = np.frombuffer("".join([words[i] for i in member]).encode("utf-32-le"), np.uint32)
        index = build(letters, np.cumsum(size) - size, size)
        width = index.bits.shape[1]
        everyone = np.arange(len(member))
        lengths = {m: bitsets(everyone[size == m], np.zeros((size == m).sum(), np.int64), 1, width)[0] for m in (s, s + 1)}
        units, place = np.unique(unit[np.r_[member, asking]], return_inverse=True)
        mates = bitsets(everyone, place[: len(member)], len(units), width)
        step = max(1, ROWS_BYTES // (8 * width))
        long = np.array([len(words[i]) for i in asking], np.int64)
        for m in (s, s + 1):
            # a pair of two longer words meets under the keys of its own length
            others = {k: v for k, v in lengths.items() if k == s or m == s}
            mine = np.flatnonzero(long == m)
            for i in range(0, len(mine), step):
                part = mine[i : i + step]
                read = np.frombuffer("".join([words[j] for j in asking[part]]).encode("utf-32-le"), np.uint32)
                read = read.reshape(len(part), m)
                number = np.searchsorted(index.alphabet, read)
                known = index.alphabet[np.minimum(number, len(index.alphabet) - 1)] == read
                # a letter that no word has lies beyond all codes of the index
                number = np.where(known, number, len(index.codes) + int(index.codes[-1]) + 1)
                found, front = near(index, number, others, s // 2)
                front = np.where((side[asking[part]] == FRONT)[:, None], front, ~front)
                found &= front & mates[place[len(member) + part]]
                some = np.flatnonzero(found.any(1))
                bits = np.unpackbits(found[some].view(np.uint8), axis=1, bitorder="little")
                best = member[bits.argmax(1)]
                yield (
                    [words[j] for j in asking[part[some]]], bits.sum(1, dtype=np.int64), [words[j] for j in best], n[best],
                )


def _units(words: DataFrame, unit_rows: int) -> tuple[DataFrame, int]:
    """Rows (word, n, short, side, key, unit, role) and their number; role: 1 stands in the index, 2 is read."""
    length = F.char_length("word")
    keys = F.array(*[
        F.struct(
            F.lit(side).alias("side"), short.alias("short"),
            (F.substring("word", F.lit(1), half) if side == FRONT
             else F.substring("word", length - (short - half) + 1, short - half)).alias("piece"),
        )
        for short in (length, length - 1)
        for half in [F.floor(short / 2).cast("int")]
        for side in (FRONT, BACK)
    ])
    rows = (
        words.select("word", "n", F.explode(keys).alias("k"))
        .select("word", "n", "k.side", "k.short", F.xxhash64("k.side", "k.short", "k.piece").alias("key"))
    )
    sizes = rows.groupBy("key").count()
    blocks = F.ceil(F.col("count") / unit_rows).cast("int")
    n, most = sizes.agg(F.sum(F.col("count") * (2 * blocks - 1)), F.max(blocks)).first()
    if (most or 0) > 1:
        # at most one key per unit_rows rows; beyond a million of them Spark joins as it likes
        large = cut(sizes.where(blocks > 1).select("key", blocks.alias("blocks")))
        few = large.limit(MOST_LARGE + 1).count() <= MOST_LARGE
        rows = rows.join(F.broadcast(large) if few else large, "key", "left")
    else:
        rows = rows.withColumn("blocks", F.lit(None).cast("int"))
    # unit (i, j) indexes block i and reads block j
    mine, other = F.col("mine"), F.col("other")

    def place(i: Column, j: Column, role: int) -> Column:
        return F.struct(F.xxhash64("key", i, j).alias("unit"), F.lit(role).alias("role"))

    places = F.when(mine == other, F.array(place(mine, mine, 3))).otherwise(
        F.array(place(mine, other, 1), place(other, mine, 2))
    )
    count = F.coalesce("blocks", F.lit(1))
    split = rows.select(
        "word", "n", "side", "short", "key", F.pmod(F.xxhash64("word"), count).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("other"),
    )
    return split.select("word", "n", "side", "short", F.inline(places)), n or 0


def neighbours(words: DataFrame, unit_rows: int = 4096) -> DataFrame:
    """(word, n_near, best) of the words with near words; best is a struct (n, word)."""
    units, n = _units(words, unit_rows)
    bins = max(1, -(-n // unit_rows))

    def run(table: pa.Table) -> pa.Table:
        found = list(solve(table))
        return pa.table({
            "word": pa.array([w for f in found for w in f[0]], pa.string()),
            "n_near": pa.array([x for f in found for x in f[1].tolist()], pa.int64()),
            "best": pa.array([w for f in found for w in f[2]], pa.string()),
            "best_n": pa.array([x for f in found for x in f[3].tolist()], pa.int64()),
        })

    found = units.groupBy(F.pmod("unit", F.lit(bins)).alias("bin")).applyInArrow(
        run, "word string, n_near long, best string, best_n long"
    )
    # a smaller word wins a tie: order by falling count, then word
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def variants(docs: DataFrame, factor: int = 10, unit_rows: int = 4096) -> DataFrame:
    """The words of all texts with their forms: word, form, root, n, n_near, form_n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only; a run whose
    crc32 with its doc_id (nothing where that is null) 31 divides loses one letter. They have 7
    code points and 2 occurrences at least. Near words differ by one letter put in, left out or
    replaced. The form of a word is its most frequent near word (ties: the smallest) if that is
    `factor` times as frequent; the root is the end of the chain of forms, or the word itself.
    Null and empty texts have no words; repeated rows count as often as they come; an empty
    table gives no rows; columns other than doc_id and text are not read.
    """
    words = cut(vocabulary(docs))
    found = neighbours(words, unit_rows)
    form = (-F.col("best.n") >= factor * F.col("n"))
    table = cut(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(form, F.col("best.word")).alias("form"), F.when(form, -F.col("best.n")).alias("form_n"),
        )
    )
    # forms are ten times as frequent as their words, so chains end; every round doubles the steps
    chains = table.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        step = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = cut(chains.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        chains = longer.select("word", "root")
        if longer.where(F.col("next").isNotNull()).isEmpty():
            break
    return table.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(d || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS b
  FROM runs
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(b, lambda c, x:
    xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1]), 4294967295)) AS h
  FROM bytes CROSS JOIN crc
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0
      THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
      ELSE run END AS word, n FROM summed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
masks AS (SELECT word, i, left(word, i - 1) || '_' || substr(word, i + 1) AS m FROM places),
cuts AS (SELECT DISTINCT word, left(word, i - 1) || substr(word, i + 1) AS other FROM places),
pairs AS (
  SELECT a.word, b.word AS other FROM masks a JOIN masks b ON a.m = b.m AND a.word <> b.word
  UNION SELECT word, other FROM cuts WHERE other IN (SELECT word FROM v)
  UNION SELECT other, word FROM cuts WHERE other IN (SELECT word FROM v)
), best AS (
  SELECT p.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS top, max(o.n) AS top_n
  FROM pairs p JOIN v o ON o.word = p.other GROUP BY p.word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top_n >= 10 * v.n THEN top END AS form, CASE WHEN top_n >= 10 * v.n THEN top_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS last FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.last WHERE e.form IS NULL
"""
