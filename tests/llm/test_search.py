"""Ranked search, nearest vectors and spelling variants against plain Python."""

import collections
import math
import random
import re
import zlib

import pytest

from tenurelens.llm import neighbours, ranking, spelling
from tests.llm.helpers import SCHEMA, awkward, prose, row, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    split = [(d, collections.Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in split)
    n_words = sum(c.total() for _, c in split)
    df = collections.Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in split:
            m = 75 + (25 * c.total() * n_docs) // max(n_words, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t]
            )
            if score > 0 and d is not None:
                rows.append((-score, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score string, rank string")


def test_ranking_equals_all_scores(spark):
    more = [row(i, prose(i % 37, 20 + i % 50, 30)) for i in range(20, 200)]
    rows = awkward(more)
    items = [(1, prose(3, 12, 30)), (2, ""), (3, None), (3, prose(4, 9, 30) + " é 漢字"), (None, "one One ONE"),
             (5, "no such words"), (6, prose(1, 400))]
    for chunk in (1 << 21, 100):
        got = ranking.rank(table(spark, rows).repartition(3), items_of(spark, [(i, t, "s", "r") for i, t in items]), 7, chunk)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == ranked([(r[0], r[1]) for r in rows], items, 7)


def test_ranking_of_empty_tables(spark):
    docs, items = table(spark, awkward()), items_of(spark, [(1, "one two", "", "")])
    assert ranking.rank(docs.limit(0), items).count() == 0
    assert ranking.rank(docs, items.limit(0)).count() == 0
    assert ranking.rank(docs, items.select("item_id", "text").fillna("").where("false")).columns[0] == "item_id"


def test_accumulators_stop_but_scores_stay_exact(spark):
    """Rare terms fill the list; the frequent rest only updates it."""
    rows = [row(i, "common " * (1 + i % 5) + ("rare gem" if i % 60 == 0 else "other words")) for i in range(600)]
    items = [(1, "rare gem common"), (2, "common"), (3, "other rare")]
    got = ranking.rank(table(spark, rows), items_of(spark, [(i, t, "", "") for i, t in items]), 5)
    assert sorted(map(tuple, got.collect()), key=str) == ranked([(r[0], r[1]) for r in rows], items, 5)


def scaled(v):
    if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(1024 * x) for x in v):
        return None
    return tuple(math.floor(1024 * x) for x in v)


def closest(rows, k, every):
    kept = [(i, scaled(v)) for i, v in rows if i is not None and scaled(v) is not None]
    out = []
    for q, v in sorted({(i, v) for i, v in kept if i % every == 0}):
        scores = sorted(
            (-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63) + 1), 2**63 - 1), i)
            for i, w in kept if i != q and len(w) == len(v)
        )
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, "x", 1, 2.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, label string, q int, score double"
    )


def unit(draw, n):
    v = [draw.gauss(0, 1) for _ in range(n)]
    return [x / math.sqrt(sum(y * y for y in v)) for x in v]


@pytest.mark.parametrize("unit_bytes", [16 << 20, 2000])
def test_nearest_equals_all_products(spark, unit_bytes):
    draw = random.Random(5)
    hot = unit(draw, 12)
    rows = [(i, hot if i % 3 == 0 else unit(draw, 12)) for i in range(600)]
    rows += [(5, unit(draw, 12)), (10, unit(draw, 12)), (10, rows[10][1]), (None, unit(draw, 12)), (700, None), (710, []), (711, [])]
    rows += [(720, [float("nan")] * 12), (730, [None] * 12), (740, unit(draw, 5)), (741, unit(draw, 5)), (750, [0.0] * 12)]
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    got = neighbours.nearest(vectors(spark, rows, "double").repartition(5), 4, 10, pivots=16, unit_bytes=unit_bytes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == closest(rows, 4, 10)


def test_nearest_beyond_doubles(spark):
    draw = random.Random(6)
    rows = [(i, [draw.choice([1e3, 1e9, 1e200, -3e8]) * draw.random() for _ in range(3)]) for i in range(60)]
    rows += [(100 + i, [float(i), 1.0, 2.0]) for i in range(30)] + [(200, [1e308, 1.0, 1.0])]
    got = neighbours.nearest(vectors(spark, rows, "double"), 5, 10)
    want = [r for r in closest(rows, 5, 10)]
    assert sorted(map(tuple, got.collect())) == want


def test_nearest_of_few_rows(spark):
    assert neighbours.nearest(vectors(spark, [])).count() == 0
    assert neighbours.nearest(vectors(spark, [(1, [1.0])])).count() == 0
    assert neighbours.nearest(vectors(spark, [(100, [1.0])])).count() == 0
    assert [tuple(r) for r in neighbours.nearest(vectors(spark, [(100, [1.0]), (1, [-1.0])])).collect()] == [(100, 1, 1, -(1 << 20))]


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    count = collections.Counter()
    for d, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            i = h % len(run)
            word = run[:i] + run[i + 1 :] if h % 31 == 0 else run
            if len(word) >= 7:
                count[word] += 1
    return {w: n for w, n in count.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def grouped(words, factor=10):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = top if top is not None and words[top] >= factor * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=lambda r: r[0]
    )


def spelled(draw, word):
    i, letter = draw.randrange(len(word)), draw.choice("abzéÿ")
    return draw.choice([word[:i] + letter + word[i:], word[:i] + word[i + 1 :], word[:i] + letter + word[i + 1 :], word])


def variant_rows():
    draw = random.Random(7)
    stems = ["abcdefgh", "aaaaaaa", "aaaaaaaa", "éàüñöäß", "thousands", "z" * 300, "Ünterhaltung", "abcdefgi", "preformation"]
    rows = awkward([row(10**6 + i, " ".join(draw.choice(stems) for _ in range(60))) for i in range(60)])
    rows += [row(2 * 10**6 + i, " ".join(spelled(draw, spelled(draw, draw.choice(stems))) for _ in range(30))) for i in range(40)]
    return rows


@pytest.mark.parametrize("unit_rows", [4096, 3])
def test_variants_equal_all_pairs(spark, unit_rows):
    rows = variant_rows()
    want = grouped(counted([(r[0], r[1]) for r in rows]))
    assert len(want) > 100 and max(r[4] for r in want) > 10 and sum(r[1] != r[2] and r[1] is not None for r in want)
    got = spelling.variants(table(spark, rows).repartition(3), unit_rows=unit_rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(table(spark, [row(1, None), row(2, "short words only"), row(3, "singleton")])).count() == 0
