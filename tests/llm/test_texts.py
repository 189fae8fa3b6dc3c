"""Operators on single texts: licences, quality, rules, decontamination, personal data."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tenurelens.llm import decontaminate, licenses, pii, quality, rules

from .helpers import awkward, prose, row, table


def dice(a, b):
    x, y = set(licenses.bigrams(a)), set(licenses.bigrams(b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_licences_match_brute_force(spark):
    mit = licenses.TEMPLATES[0][1]
    more = [
        row(20, "Some words.\nReleased under the MIT License.\nMore words here."),
        row(21, "Intro text. Licensed under CC BY-NC 4.0. And on it goes"),
        row(22, "\n\n" + mit.replace(" the ", " teh ", 3).title() + "\n\nother paragraph"),
        row(23, "Licensed under CC BY 4.0"),
        row(24, "the license of this text is not given"),
    ]
    got = {(r.doc_id, r.license): r.dice for r in licenses.scan(table(spark, awkward(more))).collect()}
    want = {}
    for r in awkward(more):
        text = r[1] or ""
        units = {text, *re.split(r"\n\s*\n", text), *text.split("\n"), *re.split(r"(?<=[.!?])\s+", text)} if len(text) < 5000 else {text[:0]}
        for u in units:
            best = max(((dice(u, t), n) for n, t in licenses.TEMPLATES), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
            if best[0] >= 0.8:
                want[r[0], best[1]] = max(best[0], want.get((r[0], best[1]), 0))
    assert got == want and {d for d, _ in got} == {20, 21, 22, 23}
    assert licenses.scan(table(spark, [])).count() == 0


def test_licence_marks_lose_nothing():
    found = set(licenses.marks(0.8))
    for _, text in licenses.TEMPLATES:
        grams = licenses.bigrams(text)
        need = -(-len(grams) * 2 // 3)
        assert len([g for g in grams if g not in found]) < need


def test_rules_match_brute_force(spark):
    more = [row(30, ("a b c d " * 40).strip()), row(31, prose(9, 300)), row(32, "l one\n\nl one\nl one\n l one"), row(33, "#$% & |<>* " + prose(10, 60))]
    rows = awkward(more)
    got = {}
    for r in rules.judge(table(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
    want = {}
    for r in rows:
        text = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        many, cover = Counter(runs), set()
        for i, x in enumerate(runs):
            if many[x] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.setdefault(r[0], []).append(
            (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover),
             len(w) < 50 or 100 * len(cover) > 50 * len(w))
        )
    assert got == want
    assert rules.judge(table(spark, [])).count() == 0


def test_distance_bounds(spark):
    one = spark.range(1).select(
        rules.distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"),
        rules.distance(F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(0.5), F.lit(0.5))).alias("near"),
    ).first()
    assert abs(one.far - 1) < 1e-12 and one.near == 0


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_decontamination_matches_brute_force(spark):
    long_item, short_item = prose(50, 40), "Only Five words-here, são"
    items = [(1, long_item), (2, short_item), (3, None), (4, ""), (5, long_item), (None, prose(51, 20)), (6, "solo9")]
    more = [
        row(40, prose(52, 100) + " " + " ".join(long_item.upper().split()[5:25]) + " " + prose(53, 10)),
        row(41, "only five WORDS here são"), row(42, " ".join(long_item.split()[:12])), row(43, "a solo9 b"),
        row(44, prose(54, 400) + " " + long_item), row(45, prose(51, 20)),
    ]
    rows = awkward(more)
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for ident, text in items:
        w = lowered(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add("" if ident is None else str(ident))
    want = Counter()
    for r in rows:
        w, hit, found = lowered(r[1]), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        want[r[0], len(w), len(hit), len(found), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    for chunk in (1 << 20, 150):
        got = Counter(
            (r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated)
            for r in decontaminate.find_passages(table(spark, rows), bench, chunk_bytes=chunk).select("doc_id", "found.*").collect()
        )
        assert got == want
    clean = decontaminate.without_benchmark(table(spark, rows), bench)
    assert clean.columns == table(spark, rows).columns
    assert clean.count() == sum(v for k, v in want.items() if not k[-1])
    assert decontaminate.find_passages(table(spark, []), bench).count() == 0
    assert decontaminate.find_passages(table(spark, rows), bench.limit(0)).where("found.n_hit > 0").count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def test_personal_data_matches_brute_force(spark):
    odd = [
        "a@b.c_d@e.f x@y ..@--.- q%+@z.zz.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.4 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111",
        "+49 (0) 30 123456-78. +1 +12 34 5678 9", "é漢 mail@x.org token = \"abcdef0123456789abcd\" 10.0.0.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 +1234567890",
        "name [at] host [dot] org", "@@@@ + . 99999999999999999999999999.1.1.1",
    ]
    rows = awkward([row(60 + i, t) for i, t in enumerate(odd)])
    got = Counter()
    for r in pii.find(table(spark, rows)).collect():
        got[r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.found if s.base)] += 1
    want = Counter()
    for r in rows:
        spans = [
            (kind, m.start(), m.end())
            for kind, pattern in PATTERNS.items()
            for m in re.finditer(pattern, r[1] or "")
            if passes(kind, m.group())
        ] if len(r[1] or "") < 20_000 else []
        want[r[0], tuple(spans)] += 1
    assert got == want
    assert pii.find(table(spark, [])).count() == 0


def test_redaction(spark):
    rows = [row(1, "write to me@x.org or 10.0.0.1 now"), row(2, "nothing")]
    docs = table(spark, rows)
    joined = docs.join(pii.find(docs).withColumnRenamed("found", "spans"), "doc_id")
    text = {r.doc_id: r.t for r in joined.select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert text == {1: "write to [EMAIL] or [IP] now", 2: "nothing"}


def test_quality_learns_held_out_labels(spark):
    import zlib

    good = [row(i, prose(i, 100 + i % 50)) for i in range(1000, 1300)]
    bad = [row(i, " ".join(w + "###" for w in prose(i, 90).split()) if i % 2 else (prose(i, 3) + " ") * 40) for i in range(2000, 2200)]
    docs = table(spark, awkward(good + bad))
    labels = spark.createDataFrame(
        [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad] + [(None, 1, 0), (1, None, 0), (1000, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id >= 1000]
    assert np.mean([(r.predicted == 1) == (r.doc_id < 2000) for r in held]) > 0.97
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id >= 2000").count() < 10
    assert quality.score_documents(table(spark, []), labels).count() == 0
    blank = quality.score_documents(docs, labels.limit(0)).select("score").distinct().collect()
    assert [round(r.score, 9) for r in blank] == [0.5]


def test_digest_columns(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]
