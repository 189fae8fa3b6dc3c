"""Personal data: generators of candidate spans, boosted trees over them, calibrated thresholds.

Generators are patterns of high recall whose spans may overlap: the base kinds (email, ip,
card, phone), and wider ones (secrets after an assignment, long keys, dotted or spaced number
groups, addresses spelled with "at" and "dot", account and document numbers). Every candidate
gets features of its format (lengths, shares of digits and letters, separators, Luhn) and of
its context (what stands before it). No labels exist, so gradient-boosted trees learn in two views
that check each other: trees on the format learn which spans a naming word introduces, and trees
on the context learn which spans pass the test of their format. No tree sees what its own label
is made of; the score joins both by their log-odds.

Candidates of one document in five train nothing. Per generator the threshold is the lowest
score at which those held-out candidates reach the precision asked for, counting as good what
is introduced or passes its test.

Spans of the base kinds are redacted whenever their test passes, whatever the trees say. Chosen
wider spans are kept unless they lie inside another span that is kept or redacted.

The trees are fitted on the driver. Candidates of equal label, kind and features are one row with
their number as its weight, so that all candidates count; of more rows than the driver takes, each
label and kind keeps its share, by priority sampling, where frequent rows stay and the others stand
for those left out. All texts and candidates are handled by DataFrame functions, the trees as
nested CASE expressions. Repetitions in the patterns are possessive and runs are entered at their
start only, and offsets are running sums over the rows of a text's matches, so the time is linear
in the text, also with a million numbers in it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenurelens.llm.scratch import cut

#: base kinds in the order of the report; each pattern is entered at the start of a run, or
#: where the match before it ended
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: wider generators; their spans are group 0, and no repetition of theirs ends before its run does
WIDE = {
    "secret": r"(?i)(?<![a-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)[ ]{0,3}[:=][ ]{0,3}[\"']?[A-Za-z0-9+/=_.-]{8,}+[\"']?",
    "key": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+",
    "spelled": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]++[ ]{0,2}[\[(]at[\])][ ]{0,2}[a-z0-9-]++(?:[ ]{0,2}[\[(]dot[\])][ ]{0,2}[a-z0-9-]++)++",
    "number": r"(?<![0-9A-Za-z])(?:[A-Z]{2})?[0-9]{2,4}+(?:[ .-][0-9]{2,4}+(?![0-9A-Za-z])){2,}+",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?![A-Za-z0-9])",
}

#: what a match must hold besides
NEEDS = {"key": lambda s: s["value"].rlike("[0-9]")}

KINDS = tuple(f"is_{kind}" for kind in (*BASE, "wide", *WIDE))
FORMAT = ("length", "digits", "letters", "uppers", "spaces", "dots", "dashes", "ats", "luhn", "hexes", "signed", *KINDS)
CONTEXT = ("named", "assigned", "opens", "begins", "spoken", "counted", *KINDS)
FEATURES = (*FORMAT, *(f for f in CONTEXT if f not in FORMAT))
#: characters before a span that are its context
REACH = 16

NAMING = r"(?i)(?:token|secret|password|passwd|key|auth|mail|phone|tel|fax|mobile|card|visa|account|iban|ssn|passport|id)[\"']?[ ]{0,3}[:=#]?[ ]{0,3}[\"']?$"


def matches(text: Column, kind: str, pattern: str) -> Column:
    """(kind, nth, gap, tail, value) of all leftmost non-overlapping matches.

    `gap` is the number of code points since the match before, `tail` the last of them.
    """
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # one piece more than values: the last one follows the last match
    zipped = F.zip_with(
        pieces, values, lambda p, v: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(REACH)).alias("tail"), v.alias("value"))
    )
    numbered = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), x["gap"].alias("gap"), x["tail"].alias("tail"), x["value"].alias("value")
        ),
    )
    return F.filter(numbered, lambda x: x["value"].isNotNull())


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    return F.call_function("luhn_check", digits(value))


def passes(kind: str, value: Column) -> Column:
    """The test of a base kind."""
    n = F.length(digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return n.between(16, 19) & luhn(value)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


#: a text is searched by a pattern only if it holds what every match of it holds
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.contains(t, F.lit(".")),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "spelled": lambda t: t.rlike(r"(?i)[\[(]at[\])]"),
}


MATCH = "array<struct<kind:string,nth:int,gap:int,tail:string,value:string>>"


def matched(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): the matches of all generators in every row of docs.

    `row` names the row of docs; it is fixed where it is written, so callers cut this table.
    """
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = []
    for kind, pattern in (BASE | WIDE).items():
        # without a digit only spelled addresses and letter-only emails can occur
        hint = HINTS.get(kind, lambda t: t.rlike("[0-9]"))(F.col("text"))
        found.append(F.when(hint, matches(F.col("text"), kind, pattern)).otherwise(F.array().cast(MATCH)))
    return known.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.flatten(F.array(*found)).alias("found"))


def located(rows: DataFrame) -> DataFrame:
    """One row per candidate: row, doc_id, kind, start, stop, value, before (the text before it).

    Offsets are code points, stop exclusive: running sums of gaps and lengths over a text's matches.
    """
    each = rows.select("row", "doc_id", F.explode("found").alias("m")).select("row", "doc_id", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("nth")
    upto = so_far.rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("value")
    placed = each.select(
        "row", "doc_id", "kind", F.sum(F.col("gap") + size).over(upto).cast("int").alias("stop"), "value",
        F.right(F.concat(F.coalesce(F.lag("value").over(so_far), F.lit("")), F.col("tail")), F.lit(REACH)).alias("before"),
    )
    needed = F.lit(True)
    for kind, holds in NEEDS.items():
        needed = needed & ((F.col("kind") != kind) | holds(F.struct("value")))
    return placed.where(needed).select(
        "row", "doc_id", "kind", (F.col("stop") - size).alias("start"), "stop", "value", "before"
    )


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, found: every candidate (kind, start, stop, value, before) of every row of docs, by kind and start."""
    rows = cut(matched(docs))
    spans = located(rows).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "stop", "value", "before"))).alias("spans")
    )
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,value:string,before:string>>")
    return rows.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("found"))


def format_test(kind: str, value: Column) -> Column:
    """The test of a kind: that of a base kind, and for wider ones whether the span has a usual format."""
    n = F.length(digits(value))
    if kind in BASE:
        return passes(kind, value)
    if kind == "number":
        return n.between(8, 19)
    if kind == "account":
        # the remainder that international account numbers have
        letters = F.upper(F.regexp_replace(value, " ", ""))
        turned = F.concat(F.substring(letters, F.lit(5), F.length(letters)), F.substring(letters, 1, 4))
        spelled_out = F.transform(
            F.split(turned, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)
        )
        rest = F.aggregate(
            F.split(F.array_join(spelled_out, ""), ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise((r * 10 + c.try_cast("int")) % 97)
        )
        return rest == 1
    if kind == "spelled":
        return value.rlike(r"(?i)[\[(]dot[\])][ ]{0,2}[a-z]{2,12}$")
    # secrets and keys: letters of both cases or hexadecimal, with digits
    body = F.regexp_replace(value, r"^[^:=]*[:=][ ]{0,3}", "")
    return body.rlike("[0-9]") & (body.rlike("^[\"']?[0-9a-fA-F]{16,}[\"']?$") | (body.rlike("[a-z]") & body.rlike("[A-Z]")) | body.rlike("[a-z].*[0-9].*[a-z]"))


def described(found: DataFrame) -> DataFrame:
    """Candidates with `ok` (base test passed), the features, and the labels of both views:
    `label` (the test of the format) and `introduced` (a naming word stands before it or begins it)."""
    v, n, before = F.col("value"), F.length("value"), F.col("before")

    def share(pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)) / n

    def tail(pattern: str) -> Column:
        return F.regexp_count(before, F.lit(pattern)) / float(REACH)

    tested = F.lit(False)
    for kind in BASE | WIDE:
        tested = F.when(F.col("kind") == kind, format_test(kind, v)).otherwise(tested)
    tested = F.coalesce(tested, F.lit(False))
    named = before.rlike(NAMING)
    columns = {
        "length": n.cast("double"),
        "digits": share("[0-9]"),
        "letters": share("[A-Za-z]"),
        "uppers": share("[A-Z]"),
        "spaces": share(" "),
        "dots": share(r"\."),
        "dashes": share("-"),
        "ats": share("@"),
        "luhn": luhn(v).cast("double"),
        "hexes": share("[0-9a-fA-F]"),
        "signed": v.startswith("+").cast("double"),
        "named": named.cast("double"),
        "assigned": before.rlike("[:=#][ \"']*$").cast("double"),
        "opens": before.rlike(r"(?:^|[\s(\[<\"':])$").cast("double"),
        "begins": (before == "").cast("double"),
        "spoken": tail("[A-Za-z]"),
        "counted": tail("[0-9]"),
        "is_wide": F.col("kind").isin(*WIDE).cast("double"),
        **{f"is_{kind}": (F.col("kind") == kind).cast("double") for kind in (*BASE, *WIDE)},
    }
    filled = {k: F.coalesce(columns[k], F.lit(0.0)) for k in FEATURES}
    introduced = F.coalesce(named, F.lit(False)) | (F.col("kind") == "secret")
    return found.withColumns({
        "ok": tested & F.col("kind").isin(*BASE), **filled, "label": tested.cast("double"), "introduced": introduced.cast("double"),
    })


class Tree(NamedTuple):
    """A leaf (feature is None) or a cut: rows with feature <= at go left."""

    value: float
    feature: int | None = None
    at: float = 0.0
    left: "Tree | None" = None
    right: "Tree | None" = None

    def column(self, features: tuple[str, ...]) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        left, right = self.left.column(features), self.right.column(features)
        return F.when(F.col(features[self.feature]) <= self.at, left).otherwise(right)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.at, self.left.predict(x), self.right.predict(x))


def quantiles(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The distinct lower 16-quantiles of x with every value repeated w times."""
    order = np.argsort(x, kind="stable")
    passed = np.cumsum(w[order])
    at = np.searchsorted(passed, np.floor(np.linspace(0, 1, 17) * (passed[-1] - 1)), "right")
    return np.unique(x[order][np.minimum(at, len(x) - 1)])


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray, depth: int, ridge: float = 1.0) -> Tree:
    """The regression tree of the gradients (summed over w) with the best cuts at up to 16 quantiles each."""
    value = float(g.sum() / (h.sum() + ridge))
    best, where = 1e-6, None
    if depth and len(x) > 1:
        whole = g.sum() ** 2 / (h.sum() + ridge)
        for f in range(x.shape[1]):
            for at in quantiles(x[:, f], w)[:-1]:
                low = x[:, f] <= at
                gl, hl = g[low].sum(), h[low].sum()
                gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - whole
                if gain > best:
                    best, where = gain, (f, float(at))
    if where is None:
        return Tree(value)
    low = x[:, where[0]] <= where[1]
    left, right = (grow(x[m], g[m], h[m], w[m], depth - 1, ridge) for m in (low, ~low))
    return Tree(value, where[0], where[1], left, right)


def boost(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int, depth: int, rate: float = 0.3
) -> tuple[float, list[Tree]]:
    """Log-odds to begin with, and trees whose values are added `rate` times; w are row weights."""
    mean = ((w * y).sum() + 1) / (w.sum() + 2)
    first = float(np.log(mean / (1 - mean)))
    total, out = np.full(len(y), first), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        out.append(grow(x, w * (y - p), w * p * (1 - p), w, depth))
        total += rate * out[-1].predict(x)
    return first, out


def shares(sizes: dict, most: int) -> dict:
    """How many of each stratum are taken: all of the small ones, the rest evenly, at least one."""
    out, left = {}, most
    for i, (name, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[name] = max(1, min(size, left // (len(sizes) - i)))
        left -= out[name]
    return out


def training_rows(
    found: DataFrame, sample: int, features: tuple[str, ...] = FEATURES, label: str = "label"
) -> list[tuple[float, ...]]:
    """(weight, label, features) rows that stand for all candidates, at most `sample` (one per stratum at least).

    Of a stratum (label and kind) with too many rows those with the highest n / u stay, u a hash
    in (0, 1]; their weight is n, or the next priority if that is more, which keeps sums unbiased.
    """
    vectors = found.groupBy(F.col(label).alias("label"), "kind", *features).agg(F.count(F.lit(1)).cast("double").alias("n"))
    u = (F.pmod(F.xxhash64("label", "kind", *features), F.lit(1 << 52)) + 1) / float(1 << 52)
    vectors = cut(vectors.withColumn("priority", F.col("n") / u))
    sizes = {(r["label"], r["kind"]): r["count"] for r in vectors.groupBy("label", "kind").count().collect()}
    columns = ("n", "label", *features)
    if sum(sizes.values()) <= sample:
        return sorted(tuple(r) for r in vectors.select(*columns).collect())
    out = []
    for (label, kind), share in sorted(shares(sizes, sample).items()):
        mine = vectors.where((F.col("label") == label) & (F.col("kind") == kind))
        rows = mine.orderBy(F.desc("priority"), *features).select("priority", *columns).limit(share + 1).collect()
        least = rows[share]["priority"] if len(rows) > share else 0.0
        out += [(max(r["n"], least), *r[2:]) for r in rows[:share]]
    return out


def train(
    found: DataFrame, sample: int, trees: int, depth: int, rate: float = 0.3,
    features: tuple[str, ...] = FEATURES, label: str = "label",
) -> Column | None:
    """The log-odds as a column, from at most `sample` weighted rows; None if only one class is there."""
    data = np.array(training_rows(found, sample, features, label)).reshape(-1, len(features) + 2)
    w, y, x = data[:, 0], data[:, 1], data[:, 2:]
    if len(np.unique(y)) < 2:
        return None
    first, grown = boost(x, y, w, trees, depth, rate)
    total = F.lit(first)
    for tree in grown:
        total = total + rate * tree.column(features)
    return total


def is_held_out() -> Column:
    """One document in five; its candidates train nothing."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0


def with_score(found: DataFrame, sample: int, trees: int, depth: int) -> DataFrame:
    """Candidates with the joint score of both views; a view of one class says nothing, and where
    both say nothing the labels decide."""
    learnt = found.where(~is_held_out())
    views = [
        train(learnt, sample, trees, depth, features=FORMAT, label="introduced"),
        train(learnt, sample, trees, depth, features=CONTEXT, label="label"),
    ]
    views = [v for v in views if v is not None]
    good = F.greatest("label", "introduced")
    if not views:
        return found.withColumn("score", good)
    total = views[0] if len(views) == 1 else views[0] + views[1]
    return found.withColumn("score", 1 / (1 + F.exp(-total)))


def thresholds(rated: DataFrame, precision: float) -> dict[str, float]:
    """Per kind, the lowest of 100 scores from which on held-out candidates reach the precision.

    A kind without held-out candidates is calibrated on all of its own.
    """
    good = F.greatest("label", "introduced")
    held = is_held_out()
    steps = rated.groupBy("kind", F.floor(F.col("score") * 100).alias("step")).agg(
        F.sum(F.when(held, good)).alias("good"), F.count_if(held).alias("all"),
        F.sum(good).alias("all_good"), F.count(F.lit(1)).alias("whole"),
    )
    rows: dict[str, list] = {}
    for r in steps.orderBy("kind", F.desc("step")).collect():  # at most 101 rows per kind
        rows.setdefault(r["kind"], []).append(r)
    out: dict[str, float] = {}
    for kind, mine in rows.items():
        names = ("good", "all") if sum(r["all"] for r in mine) else ("all_good", "whole")
        total = [0.0, 0.0]
        for r in mine:
            total[0] += r[names[0]] or 0.0
            total[1] += r[names[1]]
            if total[1] and total[0] >= precision * total[1]:
                out[kind] = r["step"] / 100
    return out


def find(
    docs: DataFrame,
    sample: int = 20_000,
    precision: float = 0.95,
    trees: int = 12,
    depth: int = 2,
) -> DataFrame:
    """doc_id, found: the redactions of every row, as (kind, start, stop, value, base) in order.

    Base spans come first by kind as listed, then the added ones; each kind by start. At most
    `sample` distinct weighted candidates train the trees; all are scored. Null and empty texts have no spans;
    repeated rows are searched alike, a null doc_id as well; an empty table gives an empty
    result; other columns are ignored. Where no view has two classes to learn, the labels decide.
    Kept wider spans may overlap each other and base spans; `redact` joins them.
    """
    rows = cut(matched(docs))
    features = cut(described(located(rows)).drop("before"))
    rated = with_score(features, sample, trees, depth).select(
        "row", "doc_id", "kind", "start", "stop", "value", "ok", "label", "introduced", "score"
    )
    limits = thresholds(rated, precision)
    enough = F.lit(False)
    for kind in WIDE:
        enough = F.when(F.col("kind") == kind, F.col("score") >= limits.get(kind, 2.0)).otherwise(enough)
    picked = rated.where(F.col("ok") | enough)
    order = F.lit(len(BASE))
    for i, kind in enumerate(BASE):
        order = F.when(F.col("ok") & (F.col("kind") == kind), i).otherwise(order)
    # a wider span inside one that begins before it, or with it and ends later, adds nothing
    before = Window.partitionBy("row").orderBy("start", F.desc("stop"), "rank", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reached = picked.withColumn("rank", order).withColumn("reached", F.max("stop").over(before))
    span = F.struct("rank", F.when(F.col("ok"), "").otherwise(F.col("kind")).alias("k"), "start", "stop", "kind", "value", F.col("ok").alias("base"))
    lists = reached.where(F.col("ok") | (F.coalesce("reached", F.lit(-1)) < F.col("stop"))).groupBy("row").agg(
        F.sort_array(F.collect_list(span)).alias("all")
    )
    final = F.transform(
        "all",
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), x["base"].alias("base")),
    )
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,value:string,base:boolean>>")
    done = lists.select("row", final.alias("spans"))
    return rows.select("row", "doc_id").join(done, "row", "left").select("doc_id", F.coalesce("spans", none).alias("found"))


def spelled(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def is_base(kind: str):
    """A filter for the base spans of one kind."""
    return lambda s: s["base"] & (s["kind"] == kind)


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by [KIND]; overlapping spans go as one."""
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))
    return F.aggregate(
        by_start,
        start,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["stop"]).alias("at"),
            F.when(
                x["start"] >= s["at"],
                F.concat(s["kept"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]")),
            ).otherwise(s["kept"]).alias("kept"),
        ),
        lambda s: F.concat(s["kept"], F.substring(text, s["at"] + 1, F.length(text))),
    )
