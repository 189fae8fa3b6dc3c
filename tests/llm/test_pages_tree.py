"""Template shares by brute force, deep nesting, and text that is markup elsewhere."""

import collections
import math
import random

import pytest

from tenurelens.llm import pages
from tenurelens.llm.pages import EVERY, Page, _digest


def corpus(seed):
    draw = random.Random(seed)
    out = []
    for host, m in (("a.org", 40), ("b.org", 12), ("c.org", 4), ("d.org", 7)):
        shared = [f"shared {host} {i}" for i in range(6)]
        for i in range(m):
            parts = []
            for k, text in enumerate(shared):
                if draw.random() < (0.2, 0.5, 0.74, 0.8, 0.95, 1.0)[k]:
                    parts.append(f"<div class=c{k % 3}><p>{text}</p></div>")
            parts += [f"<section id=s{draw.randrange(2)}><p>own {host} {i} {j}</p></section>" for j in range(draw.randrange(3))]
            if draw.random() < 0.5:
                parts.append("<div class=same><ul><li>x</li></ul></div>")
            draw.shuffle(parts)
            out.append((len(out), f"http://{host}/{i}", "<body>" + "".join(parts) + "</body>"))
    out += [(1000 + i, "http://a.org/0", out[0][2]) for i in range(30)]
    return out + [(2000, None, "<p>no host</p>"), (2001, "http://a.org/n", None), (2002, "http://a.org/e", "")]


def by_hand(rows, least=0.12, least_pages=5, weight=0.9):
    hosts = collections.defaultdict(dict)
    for _, url, source in rows:
        if url:
            page = Page(source or "")
            read = [(0, n, _digest(n, t)) for n, t, _ in page.content()]
            styles = {(1, n, _digest(n, " ".join(tags))) for n, tags in page.styles}
            hosts[url.split("/")[2]].setdefault(tuple(read), set()).update(set(read) | styles)
    gone = collections.defaultdict(set)
    for host, kinds in hosts.items():
        # pages that read the same are one page, with every presentation any of them has
        m = len(kinds)
        if m < least_pages:
            continue
        count = collections.Counter(key for keys in kinds.values() for key in keys)
        nodes = collections.defaultdict(list)
        for (kind, node, digest), k in count.items():
            own = max(0.0, 1 - k / (EVERY * m))
            nodes[node].append((kind, k, own))
            if kind == 0 and own < least:
                gone[host].add(digest)
        for node, entries in nodes.items():
            n = sum(k for kind, k, _ in entries if kind == 0)
            styles = [k for kind, k, _ in entries if kind == 1]
            if n >= 5:
                own = sum(k * o for kind, k, o in entries if kind == 0) / n
                shape = 0.0
                if len(styles) > 1:
                    s = sum(styles)
                    shape = (math.log(s) - sum(k * math.log(k) for k in styles) / s) / math.log(len(styles))
                if weight * own + (1 - weight) * shape < least:
                    gone[host].add(node)
    out = {}
    for ident, url, source in rows:
        page = Page(source or "")
        low = gone[url.split("/")[2]] if url else set()
        texts = []
        for node, text, element in page.content():
            above, nodes = element, []
            while True:
                nodes.append(page.elements[above][1])
                if above == 0:
                    break
                above = page.elements[above][0]
            if _digest(node, text) not in low and not low & set(nodes):
                texts.append(text)
        out[ident] = "\n".join(texts)
    return out


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_templates_equal_counts_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(pages, "BROADCAST_BYTES", limit)
    rows = corpus(3)
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    want = by_hand(rows)
    assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want
    assert any("shared" in t for t in want.values()) and not any("shared a.org 5" in t for t in want.values())


def test_thirty_thousand_nested_elements():
    page = Page("<div>x " * 30_000)
    assert len(page.content()) == 30_000 and len(page.kept({-1})) == 30_000
    assert page.kept({page.elements[3][1]}) == ["x", "x"]


def test_formulas_and_listings_stay():
    def texts(source):
        return [t for _, t, _ in Page(source).content()]

    assert texts("<p>area <math><mi>r</mi><msup><mi>x</mi><mn>2</mn></msup></math> grows</p>") == ["area rx2 grows"]
    assert texts("<article><p>a</p><xmp><b>raw</b> &amp; more</xmp><p>c</p></article>") == ["a", "<b>raw</b> &amp; more", "c"]
    assert texts("<p>a</p><xmp>never closed <i>") == ["a", "never closed <i>"]
