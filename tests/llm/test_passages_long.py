"""Passages without sentence ends are found inside running text."""

import numpy as np
import pyarrow as pa
import pytest

from tenurelens.llm import batches, passages


def boundaries(texts):
    """Per text the numbers of the words at which units start."""
    starts, sizes = [], []
    for _, data, offsets in batches.slices(pa.array(texts)):
        text, _, _, n, _ = passages.units(data, offsets, "sentence")
        for i in range(len(offsets) - 1):
            sizes.append(n[text == i])
            starts.append(np.cumsum(np.r_[0, sizes[-1][:-1]]))
    return starts, sizes


@pytest.mark.parametrize("vocabulary", [50, 3000])
def test_unpunctuated_passages_share_units(vocabulary):
    draw = np.random.default_rng(4)

    def some(n):
        return " ".join(f"w{x}" for x in draw.integers(0, vocabulary, n))

    texts, heads, passage_words = [], [], 51
    for _ in range(2000):
        passage = some(passage_words)
        for _ in range(2):
            head = int(draw.integers(5, 40))
            heads.append(head)
            texts.append(f"{some(head)} {passage} {some(int(draw.integers(5, 40)))}")
    starts, sizes = boundaries(texts)
    missed = 0
    for k in range(0, len(texts), 2):
        a, b = ({int(x) - heads[k + j] for x in starts[k + j]} for j in range(2))
        inside = sorted(x for x in a & b if 0 <= x <= passage_words)
        missed += not inside or inside[-1] - inside[0] < 20
    assert missed <= 6  # of 2,000; the rule itself misses about 1 in 1,000
    assert min(int(n.min()) for n in sizes) >= passages.SHORT


def test_alternating_words_are_cut():
    _, (sizes,) = boundaries([" ".join(["yes no"] * 60)])
    assert sizes.max() <= passages.GAP + passages.SHORT
