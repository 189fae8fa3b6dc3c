"""Wide generators take the whole of long tokens."""

from tenurelens.llm import pii

from .helpers import row, table


def test_long_tokens_are_whole_candidates(spark):
    key, secret = "aB" * 400 + "7", "xY3." * 200
    numbers = " ".join(["12 345"] * 40)
    spelled = f"{'n' * 90} [at] {'h' * 90} [dot] org"
    texts = {1: f"so {key} on", 2: f"password = {secret}", 3: f"no {numbers} end", 4: spelled, 5: "aB" * 200, 6: "12 34 56 12345"}
    docs = table(spark, [row(i, t) for i, t in texts.items()])
    found = {r.doc_id: {(s.kind, s.value) for s in r.found} for r in pii.candidates(docs).collect()}
    assert ("key", key) in found[1] and ("number", numbers) in found[3] and ("spelled", spelled) in found[4]
    assert any(k == "secret" and v.endswith(secret) for k, v in found[2])
    assert found[5] == set() and ("number", "12 34 56") in found[6]
