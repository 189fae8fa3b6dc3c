"""Two views of personal data, spans inside spans, and time linear in the text."""

import random
import time

from pyspark.sql import functions as F

from tenurelens.llm import pii

from .helpers import awkward, row, table


def mixed(seed, n=300):
    draw = random.Random(seed)
    letters = "abcdefghkmnpqrsuvwxyzABCDEFGHKLMNPQRS23456789"
    rows = []
    for i in range(n):
        key = "".join(draw.choice(letters) for _ in range(32)) + "7"
        hexes = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        number = " ".join(str(draw.randrange(100, 999)) for _ in range(3 + i % 3))
        rows.append(row(1000 + i, draw.choice([
            f"the key = {key} ends", f"see {hexes} there", f"phone: {number} now", f"counted {number} things",
            f"password: {key}", "write me [at] host [dot] org", "plain words only", f"mail x{i}@y.org and +49 30 {number} 11",
            f"id 12-34-56 and path/{'x' * 30}1",
        ])))
    return rows


def test_no_tree_sees_its_own_label(spark):
    """Labels without any link to the features leave nothing to learn."""
    assert not {"named", "assigned", "opens"} & set(pii.FORMAT)
    assert not {"digits", "length", "luhn", "hexes"} & set(pii.CONTEXT)
    each = pii.candidates(table(spark, mixed(1))).select("doc_id", F.explode("found").alias("c")).select("doc_id", "c.*")
    found = pii.described(each).cache()
    for features, label in ((pii.FORMAT, "introduced"), (pii.CONTEXT, "label")):
        noise = found.withColumn(label, (F.xxhash64("doc_id", "kind", "start", F.lit(label)) % 2 == 0).cast("double"))
        spread = []
        for data in (found, noise):
            score = 1 / (1 + F.exp(-pii.train(data, 5000, 12, 2, features=features, label=label)))
            good, bad = (data.where(F.col(label) == y).agg(F.avg(score)).first()[0] for y in (1.0, 0.0))
            spread.append(good - bad)
        assert spread[0] > 2 * abs(spread[1]) and spread[0] > 0.2


def test_added_spans_and_their_columns(spark):
    rows = mixed(2) + awkward()
    got = [(r.doc_id, r.found) for r in pii.find(table(spark, rows)).collect()]
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    caught = {}
    for ident, found in got:
        for s in found:
            if ident is not None:
                assert texts[ident][s.start : s.stop] == s.value
        for s in found:
            if not s.base:
                # kept wider spans are inside no other span
                assert not any(o != s and o.start <= s.start and s.stop <= o.stop for o in found)
                caught.setdefault(s.kind, set()).add(ident)
    for kind, mark in (("secret", "password:"), ("spelled", "[at]")):
        planted = {i for i, t in texts.items() if t and mark in t}
        assert len(planted & caught[kind]) >= 0.9 * len(planted)
    plain = {i for i, t in texts.items() if t == "plain words only"}
    assert not any(i in plain and f for i, f in got)


def test_a_megabyte_of_numbers(spark):
    ips = " ".join(f"10.{i % 256}.{i // 256 % 256}.7" for i in range(90_000))
    assert len(ips) > 1_000_000
    begin = time.perf_counter()
    found = pii.candidates(table(spark, [row(1, ips)])).select(F.filter("found", lambda s: s["kind"] == "ip").alias("f"))
    n, last = found.select(F.size("f"), F.element_at("f", -1)["stop"]).first()
    assert (n, last) == (90_000, len(ips)) and time.perf_counter() - begin < 60
