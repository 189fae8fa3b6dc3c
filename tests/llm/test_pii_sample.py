"""The trees of personal data learn from all kinds and labels, however often one format occurs."""

import numpy as np
from pyspark.sql import functions as F

from tenurelens.llm import pii


def test_frequent_formats_leave_room_for_others(spark):
    texts = F.when(F.col("id") % 2 == 0, "write a@b.org now").otherwise("card 4111 1111 1111 1112 ends")
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    more = spark.createDataFrame([(9000, "ip 10.0.0.1 here"), (9001, "ip 300.0.0.1 here")], "doc_id long, text string")
    each = pii.candidates(docs.unionAll(more)).select("doc_id", F.explode("found").alias("c")).select("doc_id", "c.*")
    found = pii.described(each).cache()
    strata = found.select("label", "kind").distinct().count()
    for sample in (500, 3):
        rows = pii.training_rows(found, sample)
        assert {r[1] for r in rows} == {0.0, 1.0} and len(rows) <= max(sample, strata)
        assert {r[2 + pii.FEATURES.index("is_ip")] for r in rows} == {0.0, 1.0}
        assert pii.train(found, sample, 2, 2) is not None
    assert sum(r[0] for r in pii.training_rows(found, 500)) == found.count()


def test_weights_are_repetitions():
    draw = np.random.default_rng(1)
    x, y, w = draw.random((60, len(pii.FEATURES))), draw.integers(0, 2, 60).astype(float), draw.integers(1, 9, 60)
    few, many = (pii.boost(a, b, c, 3, 2) for a, b, c in (
        (x, y, w.astype(float)), (np.repeat(x, w, 0), np.repeat(y, w), np.ones(w.sum())),
    ))
    score = [first + sum(t.predict(x) for t in grown) for first, grown in (few, many)]
    assert np.allclose(*score)
    assert pii.shares({"a": 1, "b": 50, "c": 900}, 101) == {"a": 1, "b": 50, "c": 50}
