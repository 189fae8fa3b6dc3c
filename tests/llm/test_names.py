"""Own columns keep their values, shards follow the words, references and tables stay small."""

import pickle

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tenurelens.llm import decontaminate, minhash, mixing, passages, quality, rules
from tenurelens.llm.scratch import aside, unused

from .helpers import prose, row, table


def clashing(spark, n=60):
    rows = [row(i, prose(i, 60 + i)) for i in range(n)]
    df = table(spark, rows)
    names = ("_id", "_th", "_spans", "_found", "predicted", "copy", "shard", "_score")
    return df.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names if c not in df.columns])


def same_values(before, after):
    keys = {r.doc_id: r for r in before.collect()}
    rows = after.collect()
    for r in rows:
        for c in before.columns:
            assert c == "text" or r[c] == keys[r.doc_id][c], c
    return rows


def test_own_columns_keep_their_values(spark):
    docs = clashing(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    same_values(docs, kept)
    bench = spark.createDataFrame([(1, prose(3, 20))], "item_id long, text string")
    clean = decontaminate.without_benchmark(docs, bench)
    assert clean.columns == docs.columns and len(same_values(docs, clean)) == 59
    once = passages.remove_repeats(docs.drop("removed"))
    assert len(same_values(docs.drop("removed"), once)) == 60
    mixed = corpus_pipeline.source_mixing(spark, docs, "")
    assert mixed.columns == docs.columns
    assert same_values(docs, mixed)


def test_names_that_are_free():
    assert unused(["a", "_X"], "x") == "__x" and unused(["a"], "x") == "_x"
    assert aside(["Score", "b", "_Score"], ["score"]) == {"Score": "__Score"}


def test_shards_follow_the_words(spark):
    rows = [row(i, prose(i, 40), source="ab"[i % 2]) for i in range(400)]
    out = mixing.mix(table(spark, rows).drop("words", "shard", "copy"), shards=70)
    parts = out.select("shard", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.shard for r in parts}) == len({r.p for r in parts}) == len(parts) > 60
    total = spark.createDataFrame([(10.0 * mixing.SHARD_WORDS,), (190.0 * mixing.SHARD_WORDS + 1,)], "target double")
    assert mixing.shard_count(total) == 201 and mixing.shard_count(total.limit(0)) == mixing.LEAST_SHARDS


def test_a_language_of_one_text_has_no_reference(spark):
    rows = [row(i, prose(i, 300)) for i in range(40)] + [row(99, "0x1f%%$$ " * 3 + " ".join(f"#{i}$%" for i in range(300)), lang="zz")]
    got = {r.doc_id: r for r in rules.judge(table(spark, rows)).collect()}
    assert got[1].kept and not got[99].kept and got[99].char_distance > 0.3
    alone = {r.doc_id: r for r in rules.judge(table(spark, rows[:5])).collect()}
    assert alone[1].kept and alone[1].char_distance is None


def test_tables_of_the_search_are_small():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(5000)]
    items = [(str(i), " ".join(rng.choice(words, 40))) for i in range(4000)]
    size = sum(len(t) for _, t in items)
    tables = decontaminate.build(items, 13)
    assert len(pickle.dumps(tables)) < 12 * size + (2 << 20)


def test_blocks_of_near_duplicates_by_shingles(spark, monkeypatch):
    rows = []
    for i in range(24):
        words = prose(i // 2, 400).split()
        words[5 * (i % 2)] = f"changed{i}"
        rows.append(row(i, " ".join(words)))
    docs = table(spark, rows)
    want = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == want
    assert {c for _, c in want} == set(range(0, 24, 2))
