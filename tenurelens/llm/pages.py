"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of elements (tag, class and id),
and it knows in how many pages each of its presentations (sequence of child tags) and each of
its contents (normalised text of a block) occurs. On a host of m pages

* a content that k pages share has importance 1 - k / (0.85 m), at least 0: the share of pages
  that makes a template does not depend on the size of the host;
* a presentation node has the entropy of its presentations over the pages, to the base of their number;
* a node's importance is a mean of both, weighted towards content.

Pages of a host that read the same, block by block, are one page in these numbers, so that copies
of a page do not turn its article into a template.

Nodes and contents below `least` are template, and their branches are removed from each page.
Hosts with fewer than `least_pages` pages say nothing about templates. What an element is for
(its tag, or a class token or id that names it: menu, footer, advert, comments, ...) is part of the
presentation and removes its branch on any host, except a marked article or main part in a wrapper. If a page marks its article, or its main
part, only that is read.

The tree never exists in one place: pages give one row per node and content (digests of 64 bits,
no text), which are summed by key; only the digests of template nodes go back to the pages.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
#: one attribute with its value, so that quoted text is never read as a name
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe object svg select title noembed annotation annotation-xml".split())
#: their content is text as it stands
PLAINTEXT = frozenset(["xmp"])
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q s samp small span "
    "strike strong sub sup time tt u var wbr ruby rb rt rp "
    "math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd semantics".split()
)
#: elements whose content is never the article's
ASIDE = frozenset("head nav footer aside form button menu dialog fieldset audio video canvas".split())
#: an element closes these if they are open, up to one of the last set
CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
        "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(),
        frozenset(["p"]),
    ),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
    "body": frozenset(["head"]),
}
SCOPE = frozenset("html body div section article main aside nav table ul ol dl blockquote form header footer td th button".split())

#: parts of the page around an article; an article or main part inside them is read all the same
AROUND = frozenset("nav navbar navigation menu header masthead footer sidebar aside banner toolbar notice notices alert overlay skip search login".split())
#: parts that hold texts of their own kind, also articles
APART = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr popup modal "
    "share sharing social related recommended comment comments disqus respond replies breadcrumb breadcrumbs pagination pager "
    "newsletter subscribe subscription signup widget".split()
)
#: what a class token may say besides such a name; any other part (with-, no-, post-) makes it another name
PLAIN = frozenset(
    "site page main global primary secondary top bottom left right inner outer box bar area block wrap wrapper container "
    "section list item items links link posts buttons button form panel slot body text container unit group".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: a content that this share of pages has counts as on every page
EVERY = 0.85


def _marked(label: str) -> int:
    """0, or 1 if a class token or id names a part around an article, 2 if one apart from it."""
    found = 0
    for token in label.lower().split():
        parts = [p.rstrip("0123456789") for p in re.split("[-_]+", token)]
        if all(not p or p in AROUND or p in APART or p in PLAIN for p in parts):
            found = max([found, *(2 if p in APART else 1 for p in parts if p in AROUND or p in APART)])
    return found


def _digest(above: int, text: str) -> int:
    raw = above.to_bytes(8, "little", signed=True) + text.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


class Page:
    """Blocks of text in page order, and the presentations of elements."""

    def __init__(self, source: str):
        #: (node, text, in an article, in a main part, innermost element)
        self.blocks: list[tuple[int, str, bool, bool, int]] = []
        #: node -> tags of its children
        self.styles: list[tuple[int, list[str]]] = []
        #: (element above, node) of every element; the one above has the smaller number
        self.elements: list[tuple[int, int]] = [(0, 1)]
        # tag, node, out (not read), article, main, tags of children, element
        self.stack: list[tuple[str, int, int, bool, bool, list[str], int]] = [("", 1, 0, False, False, [], 0)]
        self.text: list[str] = []
        self.read(source)

    def flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            self.text = []
            _, node, out, article, main, *_ = self.block()
            if text and not out:
                self.blocks.append((node, text, article, main, self.stack[-1][6]))

    def block(self) -> tuple[str, int, int, bool, bool, list[str], int]:
        for element in reversed(self.stack):
            if element[0] not in INLINE:
                return element
        return self.stack[0]

    def close(self) -> None:
        element = self.stack.pop()
        if element[5]:
            self.styles.append((element[1], element[5]))

    def read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = TOKEN.search(source, at)
            if found is None:
                self.say(source[at:])
                break
            self.say(source[at : found.start()])
            at = found.end()
            tag = (found.group(2) or "").lower()
            if not tag:
                if found.group().startswith("<![CDATA["):
                    self.say(html.escape(found.group()[9:].removesuffix("]]>"), quote=False))
            elif found.group(1):
                self.end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            elif tag in PLAINTEXT:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                self.start(tag, found.group(3) or "")
                self.say(html.escape(source[at : close.start() if close else end], quote=False))
                self.end(tag)
                at = close.end() if close else end
            else:
                self.start(tag, found.group(3) or "")
        self.flush()
        while self.stack:
            self.close()

    def say(self, text: str) -> None:
        if text and not self.stack[-1][2]:
            self.text.append(text)

    def start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE and tag != "br":
            self.flush()
        elif tag == "br":
            self.text.append(" ")
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.stack[i][0]
            if name in CLOSES.get(tag, ()):
                while len(self.stack) > i:
                    self.close()
            elif name in SCOPE and tag not in ("body",):
                break
        if tag in VOID:
            return
        named: dict[str, str] = {}
        for k, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
            named.setdefault(k.lower(), a or b or c)  # of equal names the first counts
        label = f"{named.get('class', '')} {named.get('id', '')}".strip()
        _, node, out, article, main, children, element = self.stack[-1]
        children.append(tag)
        own = _digest(node, f"{tag}.{label}")
        role = named.get("role", "").lower()
        if tag == "article" or tag == "main" or role == "main":
            # out 1 is a wrapper around articles, 2 is not read whatever it holds
            out = 0 if out < 2 else 2
            if "hidden" in named or (tag == "article" and label and _marked(label) == 2):
                out = 2
        elif tag not in ("html", "body"):
            if "hidden" in named or role in ROLES or (tag in ASIDE and tag != "form"):
                out = 2
            elif tag == "form" or (tag == "header" and not article):
                out = max(out, 1)
            out = max(out, _marked(label)) if label else out
        article = article or (tag == "article" and not out)
        main = main or tag == "main" or role == "main"
        self.elements.append((element, own))
        self.stack.append((tag, own, out, article, main, [], len(self.elements) - 1))

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self.close()
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def content(self) -> list[tuple[int, str, int]]:
        """(node, text, innermost element) of the blocks that are read."""
        rows = self.blocks
        for flag in (2, 3):
            if any(b[flag] for b in rows):
                rows = [b for b in rows if b[flag]]
                break
        return [(node, text, element) for node, text, _, _, element in rows]

    def kept(self, gone: set[int]) -> list[str]:
        """The texts that are read and neither template themselves nor below a template node."""
        under: list[bool] = []
        for above, node in self.elements:
            under.append(node in gone or bool(under) and under[above])
        return [text for node, text, element in self.content() if not under[element] and _digest(node, text) not in gone]


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def tree(pages: DataFrame) -> DataFrame:
    """host, page (digest of what is read), kind (0 content, 1 presentation, 2 page), node, digest: once per page each."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows, same, kinds, nodes, digests = [], [], [], [], []
            for i, source in enumerate(part.column(1).to_pylist()):
                page = Page(source or "")
                read = [(0, node, _digest(node, text)) for node, text, _ in page.content()]
                whole = _digest(len(read), " ".join(str(digest) for _, _, digest in read))
                seen = {(2, 0, 0), *read}
                seen |= {(1, node, _digest(node, " ".join(tags))) for node, tags in page.styles}
                for kind, node, digest in seen:
                    rows.append(i)
                    same.append(whole)
                    kinds.append(kind)
                    nodes.append(node)
                    digests.append(digest)
            yield pa.record_batch(
                [
                    part.column(0).take(pa.array(rows, pa.int64())), pa.array(same, pa.int64()),
                    pa.array(kinds, pa.int32()), pa.array(nodes, pa.int64()), pa.array(digests, pa.int64()),
                ],
                names=["host", "page", "kind", "node", "digest"],
            )

    return batches.bounded(pages).mapInArrow(run, "host string, page long, kind int, node long, digest long")


def templates(pages: DataFrame, least: float, least_pages: int, weight: float) -> DataFrame:
    """host, low: digests of contents and nodes that are template on a host (host, html given)."""
    seen = tree(pages.where("host is not null").select("host", "html")).distinct()
    summed = cut(seen.groupBy("host", "kind", "node", "digest").agg(F.count(F.lit(1)).alias("k")))
    sizes = summed.where((F.col("kind") == 2) & (F.col("k") >= least_pages)).select("host", F.col("k").alias("m"))
    # whichever way they meet, no host has all its rows in one task
    counted = _with_host(summed.where("kind < 2"), sizes, sizes.count() * ROW_BYTES, ["kind", "node", "digest"], "inner")
    own = F.greatest(F.lit(0.0), 1 - F.col("k") / (EVERY * F.col("m")))
    contents = counted.where((F.col("kind") == 0) & (own < least)).select("host", F.col("digest").alias("low"))
    per_node = counted.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("k") * own)).alias("own"),
        F.sum(F.when(F.col("kind") == 0, F.col("k"))).alias("n"),
        F.sum(F.when(F.col("kind") == 1, F.col("k"))).alias("s"),
        F.sum(F.when(F.col("kind") == 1, F.col("k") * F.ln("k"))).alias("slog"),
        F.count_if(F.col("kind") == 1).alias("ways"),
    ).where("n >= 5")
    entropy = F.ln("s") - F.col("slog") / F.col("s")
    styles = F.when(F.col("ways") > 1, entropy / F.ln("ways")).otherwise(0.0)
    nodes = per_node.where(weight * F.col("own") / F.col("n") + (1 - weight) * styles < least).select(
        "host", F.col("node").alias("low")
    )
    return contents.unionAll(nodes).groupBy("host").agg(F.collect_set("low").alias("low"))


#: a table of hosts is broadcast up to this size, beyond it is copied to SALTS parts of each host
BROADCAST_BYTES, ROW_BYTES, SALTS = 32 << 20, 128, 64


def _with_host(rows: DataFrame, hosts: DataFrame, size: int, spread: list[str], how: str) -> DataFrame:
    """Join on `host` with a table of one row per host, `size` bytes long."""
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(hosts), "host", how)
    copies = hosts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["host", "_salt"], how).drop("_salt")


def main_text(
    pages: DataFrame, least: float = 0.12, least_pages: int = 5, weight: float = 0.9
) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html).

    Blocks of the main text in page order, white space folded, joined by a newline; references
    are decoded. Null and empty pages, and pages without text, give an empty text. Pages whose
    url is null or has no host are read without templates. Repeated rows are all
    read, and count once for templates. An empty table gives an empty result; other columns are ignored.
    """
    hosted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    low = cut(templates(hosted.select("host", "html"), least, least_pages, weight))
    size = low.agg(F.sum(8 * F.size("low") + F.octet_length("host") + F.lit(ROW_BYTES))).first()[0] or 0

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = []
            for source, template in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                page = Page(source or "")
                texts.append("\n".join(page.kept(set(template)) if template else [text for _, text, _ in page.content()]))
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    joined = _with_host(batches.bounded(hosted), low, size, ["page_id", "url"], "left")
    return joined.select("page_id", "url", "html", "low").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
