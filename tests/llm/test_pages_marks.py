"""Only real attributes and whole class tokens mark a part of a page."""

import pytest

from tenurelens.llm.pages import Page


@pytest.mark.parametrize("attributes", [
    ' style="overflow: hidden"', ' title="hidden gems"', " data-x='class=\"ad\"'", ' class="content with-sidebar"',
    ' class="no-sidebar"', ' id="post-header"', ' class="post has-sidebar" role=\'none\'',
])
def test_wrappers_are_read(attributes):
    assert [t for _, t, _ in Page(f"<body><div{attributes}><p>text</p></div>").content()] == ["text"]


def test_marked_parts():
    def texts(source):
        return [t for _, t, _ in Page(source).content()]

    for mark in ('class="ad-box"', 'class="x sidebar"', "id=main-nav", "hidden", 'role="navigation"', 'class="comments"'):
        assert texts(f"<p>a</p><div {mark}><p>b</p></div>") == ["a"]
    assert texts('<div class="banner"><p>x</p><article><p>a</p><div class="ad-box">no</div></article></div>') == ["a"]
    assert texts('<form id="sidebar"><main><p>a</p></main></form>') == ["a"]
    assert texts('<p>a</p><div class="comments"><article><p>no</p></article></div><aside><article>no</article></aside>') == ["a"]
