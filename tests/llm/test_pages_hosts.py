"""What counts as template does not depend on the size of a host."""

import pytest

from tenurelens.llm import pages


@pytest.mark.parametrize("m", [20, 400])
def test_shared_articles_stay(spark, m):
    shared = m * 3 // 5  # the same first block, then a text of their own
    rows = [(i, f"http://a.org/{i}", f"<p>{'shared' if i < shared else f'other {i}'}</p><p>own {i}</p><p>every</p>") for i in range(m)]
    rows += [(m + i, f"http://b.org/{i}", f"<p>{'copied' if i < m * 9 // 10 else f'other {i}'}</p><p>every</p>") for i in range(m * 11 // 10)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "shared\nown 0" and got[m - 1] == f"other {m - 1}\nown {m - 1}"
    assert got[m].startswith("copied") and got[len(rows) - 1].startswith("other")
