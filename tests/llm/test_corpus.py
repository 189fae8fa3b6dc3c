"""Operators on the whole corpus: near duplicates, mixing, token ids, repeats, pages, pipeline."""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenurelens.llm import batches, graph, minhash, mixing, pages, passages, tokenids

from .helpers import awkward, prose, row, table


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute_components(rows, k):
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return Counter((d, len(x), None if d is None else find(d)) for d, x in sets)


def edited(text, every, offset, mark):
    w = text.split()
    return " ".join(f"{mark}{i}" if i % every == offset else x for i, x in enumerate(w))


def near_rows():
    base, other = prose(70, 300), prose(71, 200)
    rows = [row(100 + i, edited(base, 120, i % 120, f"e{i}")) for i in range(40)]
    rows += [row(200 + i, edited(base, 22 + i, 3, "z")) for i in range(25)]
    rows += [row(300 + i, other.upper() if i % 2 else other) for i in range(20)]
    rows += [row(400 + i, edited(other, 26 + i % 9, i, f"q{i}")) for i in range(30)]
    rows += [row(500 + i, prose(80 + i, 60) + " " + base[:900]) for i in range(20)]
    rows += [row(600, "one two"), row(601, "One  TWO"), row(602, "two one")]
    return rows


@pytest.mark.parametrize("block", [512, 6])
def test_components_match_brute_force(spark, block):
    rows = awkward(near_rows())
    got = minhash.near_duplicates(table(spark, rows), minhash.Plan(size=4, block=block)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays(spark):
    rows = awkward(near_rows())
    docs = table(spark, rows)
    kept = minhash.keep_one(docs)
    ids = [r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None]
    want = {c for (d, _, c) in brute_components(rows, 5) if d is not None}
    assert sorted(ids) == sorted(want) and kept.columns == docs.columns
    assert minhash.near_duplicates(table(spark, [])).count() == 0
    assert minhash.keep_one(table(spark, [])).count() == 0


def test_pruning_bounds_keep_links():
    plan = minhash.Plan()
    draw = np.random.default_rng(3)
    looks = minhash.least_matches(plan)
    assert looks[-1][0] == plan.hashes and all(b >= a for (_, a), (_, b) in zip(looks, looks[1:]))
    x = draw.integers(0, 1 << 30, (4000, plan.hashes), dtype=np.uint32)
    y = np.where(draw.random(x.shape) < 0.8, x, x + 1)
    z = np.where(draw.random(x.shape) < 0.3, x, x + 1)
    assert len(minhash.alive(x, y, looks)) >= 3999 and len(minhash.alive(x, z, looks)) == 0


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 902), (902, 901), (901, 900), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {500 + i: 500 for i in range(40)} | dict.fromkeys((900, 901, 902), 900)
    assert got == want


def filled(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing what stands above the limit, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, capped, out = sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(w[s] for s in open_)
        out = {s: most * sizes[s] for s in capped} | {s: left * w[s] / total for s in open_}
        over = [s for s in open_ if out[s] > most * sizes[s]]
        if not over:
            return out
        capped |= set(over)
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)


def mixed_rows():
    return awkward(
        [row(100 + i, prose(i, 20 + i % 60), source=f"src{i % 4}") for i in range(200)]
        + [row(1000 + i, prose(i, 15), source="tiny") for i in range(4)]
    )


def test_quotas(spark):
    rows = mixed_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    docs = table(spark, rows)
    got = mixing.quotas(docs).collect()
    want = filled(sizes)
    by_size = {v: k for k, v in sizes.items()}
    taken = Counter()
    for r in got:
        assert abs(r.target - want[by_size[r.source_size]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[by_size[r.source_size]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    again = mixing.quotas(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    assert mixing.quotas(table(spark, [])).count() == 0
    assert [r.target for r in mixing.quotas(table(spark, [row(1, None), row(2, " ")])).collect()] == [0, 0]


def test_mix_takes_what_the_quotas_say(spark):
    docs = table(spark, mixed_rows())
    quota, out = Counter(), Counter()
    for r in mixing.quotas(docs).collect():
        quota[r.doc_id] += r.taken
    shards = mixing.mix(docs, shards=5)
    assert shards.columns == [c for c in docs.columns if c not in ("copy", "words", "shard")] + ["copy", "words", "shard"]
    sizes = Counter()
    for r in shards.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert n == r.words and 0 <= r.shard < 5
        out[r.doc_id] += n
        sizes[r.shard] += 1
    assert +out == +quota and len(sizes) == 5
    assert mixing.mix(table(spark, [])).count() == 0


def test_mixing_query_sums_what_the_tree_deals(spark, tmp_path, monkeypatch):
    from tenurelens.llm import registry

    table(spark, mixed_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = Counter(map(tuple, mixing.quotas(docs).collect()))
    assert Counter(map(tuple, registry.op3_mixing(spark, str(tmp_path)).collect())) == want
    split = mixing.split_quotas

    def without_last(counts, shards, seed):
        drawn = split(counts, shards, seed)
        return drawn[:-1] + [[0] * len(counts)]

    monkeypatch.setattr(mixing, "split_quotas", without_last)
    fewer = registry.op3_mixing(spark, str(tmp_path)).collect()
    kept = sum(r.words for r in mixing.mix(docs).collect())
    assert len(fewer) == sum(want.values())
    assert sum(r.taken for r in fewer) == kept < sum(k[-1] * n for k, n in want.items())


def test_splitting_tree_is_exact():
    counts = [1, 0, 500, 37, 12_000]
    drawn = mixing.split_quotas(counts, 7, 3)
    assert [sum(x) for x in zip(*drawn)] == counts and len(drawn) == 7
    assert max(map(sum, drawn)) - min(map(sum, drawn)) <= 3
    assert drawn == mixing.split_quotas(counts, 7, 3) != mixing.split_quotas(counts, 7, 4)
    import random

    draws = [mixing.hypergeometric(random.Random(i), 30, 70, 20) for i in range(3000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.4


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 4, 5, 63, 64, 65, 1000):
        slots = tokenids.permute(np.arange(n), n, 11)
        assert sorted(slots.tolist()) == list(range(n))
        assert (tokenids.permute(slots, n, 11, undo=True) == np.arange(n)).all()
    assert (tokenids.permute(np.arange(1000), 1000, 1) != tokenids.permute(np.arange(1000), 1000, 2)).mean() > 0.9


def test_token_ids_round_trip(spark, tmp_path):
    import tiktoken

    vocab = tokenids.vocabulary()
    plain = tiktoken.Encoding("plain", pat_str=vocab.pattern, mergeable_ranks=vocab.ranks, special_tokens={})
    odd = [row(70, "a    b  c\n\n  d\t　x  "), row(71, "   "), row(72, "it's  'll\r\n\r\nwe've 12 345"), row(73, "\n\n\nx")]
    rows = [r for r in awkward(odd) if r[0] not in (9, 10)]
    order = tokenids.training_order(table(spark, rows), vocab, length=16, per_shard=50, key=5).cache()
    got = order.collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all((r.shard, r.stride) == divmod(r.slot, 50) and len(r.ids) == 2 * r.n_tokens for r in got)
    docs = {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.slot)):
        docs.setdefault((r.doc_id, r.part), []).append(r.ids)
    for r in rows:
        ids = plain.encode_ordinary(r[1] or "")
        want = ids + [vocab.end] if ids else []
        for i in range(0, len(want), 16):
            assert np.array(want[i : i + 16], np.uint16).tobytes() in docs[r[0], i // 16]
    target = f"file://{tmp_path}/shards"
    files = {r.shard: r for r in tokenids.write_shards(order, target, vocab, 16).collect()}
    assert sum(r.n for r in files.values()) == len(got)
    for s, f in files.items():
        stored = tokenids.read_shard(target, s, vocab.kind, 16)
        assert stored.shape == (f.n, 16)
        mine = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        for line, r in zip(stored, mine, strict=True):
            assert line[: r.n_tokens].tobytes() == r.ids and (line[r.n_tokens :] == vocab.end).all()
        assert (tokenids.read_shard(target, s, vocab.kind, 16, first=1) == stored[1:]).all()
    assert tokenids.training_order(table(spark, []), vocab).count() == 0


def test_repeated_lines_match_brute_force(spark):
    shared = prose(90, 25).replace("\n", " ").replace(".", "")
    rows = awkward([row(20, f"{prose(91, 30)}\n{shared}\nend of it"), row(21, f"{shared.upper()}\n{prose(92, 30)}\n{shared}"), row(22, f"short\n{shared}\nshort")])
    got = Counter()
    for r in passages.remove_repeats(table(spark, rows), unit="line", least_words=5, unit_words=2).collect():
        got[r.doc_id, r.text, tuple((s.start, s.stop) for s in r.removed)] += 1
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, want = {}, Counter()
    for i in order:
        doc_id, text = rows[i][0], rows[i][1]
        spans, run, at, inside = [], None, 0, set()
        for line in (text or "").split("\n"):
            words = line.lower().split()
            if len(words) >= 2:
                start, stop = at + len(line) - len(line.lstrip()), at + len(line.rstrip())
                key = tuple(words)
                late = key in inside or first.setdefault(key, doc_id) != doc_id
                inside.add(key)
                if late:
                    run = [start, stop, len(words)] if run is None else [run[0], stop, run[2] + len(words)]
                elif run:
                    spans.append(run)
                    run = None
            at += len(line) + 1
        spans += [run] if run else []
        spans = [(s, e) for s, e, n in spans if n >= 5]
        out, end = "", 0
        for s, e in spans:
            out, end = out + text[end:s], e
        want[doc_id, None if text is None else out + text[end:], tuple(spans)] += 1
    assert got == want
    assert passages.repeated_runs(table(spark, [])).count() == 0


def test_passages_inside_lines_are_found(spark):
    passage = prose(95, 70).replace("\n", " ")
    rows = [row(i, f"{prose(200 + i, 40 + i)} and then {passage} so on {prose(300 + i, 50)}") for i in range(12)] + [row(50, prose(400, 200))]
    found = {r.doc_id: r.spans for r in passages.repeated_runs(table(spark, rows)).collect()}
    assert set(found) == set(range(1, 12))
    assert all(sum(s.words for s in spans) >= 45 for spans in found.values())


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x="</p><article>no</article>";</script></head>
<body class="home"><header><h1>Site</h1></header><nav><ul><li><a href=/a>Home<li><a href=/b>News</ul></nav>
<!-- <p>hidden</p> --><div id="main">{lead}<article><h1>T &amp; {n}</h1><p>First <b>bold
 text</b> &#233;<br>more<p>Second &lt;p&gt;<div class="ad-box">Buy</div><form><p>mail<input name=q></form>
<p>{same}</p><aside>see also</aside><ul><li>x<li>y</ul></article><section class="comments"><p>nice!</p></section></div>
<footer><p>(c) me</p></footer></body></html>"""


def test_pages(spark):
    rows = [(i, f"http://Host.org/{i}", PAGE.format(n=i, lead="<p>lead</p>", same="Subscribe to our letter")) for i in range(12)]
    rows += [
        (20, "http://other.net/1", PAGE.format(n=20, lead="", same="Subscribe to our letter")), (21, None, "<p>a &nbsp; b<p>c"),
        (22, "nonsense", None), (23, "http://host.org/x", ""), (24, "http://host.org/y", "<article><p>open <script>never closed"),
        (24, "http://host.org/y", "plain text & more <"), (None, "http://host.org/z", "<div><nav>n</nav>" + "<div>" * 500 + "deep"),
    ]
    table_ = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2))
    got = {}
    for r in pages.main_text(table_).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, set()).add(r.text)
    for i in range(12):
        assert got[i] == {f"T & {i}"}  # the rest is the same on every page of the host
    assert got[20] == {"T & 20\nFirst bold text é more\nSecond <p>\nSubscribe to our letter\nx\ny"}
    assert got[21] == {"a b\nc"} and got[22] == {""} and got[23] == {""}
    assert got[24] == {"open", "plain text & more <"} and got[None] == {"deep"}
    assert pages.main_text(table_.limit(0)).count() == 0


def test_slices_cut_only_between_texts():
    texts = ["a b", None, "", "c" * 50, "dé f", "g"]
    for limit in (1, 10, 1000):
        seen = []
        for first, data, offsets in batches.slices(pa.array(texts)[1:], limit):
            assert first == len(seen)
            seen += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        assert seen == ["", "", "c" * 50, "dé f", "g"]
    assert html.unescape("&amp;") == "&"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_pipeline_runs_every_stage_on_what_is_left(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 1:
            kept = [(r.doc_id, r.text) for r in docs.collect()]
            assert len(brute_components([row(*r) for r in kept], 5)) == len({c for _, _, c in brute_components([row(*r) for r in kept], 5)})
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] > 0
    slots = [r.slot for r in corpus_pipeline.run(spark, corpus).collect()]
    assert sorted(slots) == list(range(seen[-1]))


def test_pipeline_takes_awkward_rows(spark, tmp_path):
    for name, rows in (("some", awkward([row(90 + i, prose(i, 60)) for i in range(6)])), ("none", [])):
        docs = table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(90, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(1, "no such thing")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        n = corpus_pipeline.run(spark, f"{tmp_path}/{name}").count()
        assert (n > 0) == bool(rows)
