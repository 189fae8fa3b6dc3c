"""Quality rules: counts of a text, and its distance from its language's usual distributions.

Two histograms are taken of each text, of character classes and of frequent words. A language's
reference is the mean of the normalised histograms of its documents that pass the base rule and
are long enough, over the whole table. A document is compared with the references by the
Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1) and fails when even
the nearest reference is too far. Texts below the minimum lengths are not judged by it, as a
histogram of few counts says little.

Only DataFrame functions are used. A text is read once; from then on there are counts only.
References are summed per language, and reach the rows as one value of a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenurelens.llm.scratch import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: classes of characters beside SYMBOLS and the bytes beyond ASCII; the rest is mostly a-z
CLASSES = ("[A-Z]", "[0-9]", "[.,;:?'\"()-]", "[!=_@~^+/\\\\{}\\[\\]]")

#: frequent words, a dozen each of English, French, German and Spanish
WORDS = (
    "the of and to in is that for with was by it "
    "de la le les des que est un une qui dans pour "
    "der die und das den von mit ein ist nicht zu als "
    "el los las y en se del por con para no su"
).split()


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def windows(w: Column) -> Column:
    """Hashes of all windows of three words."""
    last = F.size(w) - 3
    hashed = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def repeat_words(h: Column) -> Column:
    """Words in three-word windows (given by their hashes) that occur twice or more.

    Texts without a repeat need no more. Else windows are sorted by 64-bit hash, equal neighbours marked, and the marked positions, in
    order, cover up to three words each: n log n whatever the text repeats.
    """
    hashed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    marked = let(
        F.sort_array(hashed),
        lambda s: F.filter(
            s,
            lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
        ),
    )
    places = F.array_sort(F.transform(marked, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(3), i - s["at"])).alias("n")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(h)) < F.size(h), covered).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the counts and both histograms of every row."""
    text = F.coalesce("text", F.lit(""))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    split = docs.select("doc_id", lang.alias("lang"), text.alias("text"), words(F.col("text")).alias("w"))
    split = split.withColumns(
        {"h": windows(F.col("w")), "found": F.transform(
            F.filter("w", lambda x: F.lower(x).isin(WORDS)), lambda x: F.lower(x)
        )}
    )
    symbols = F.regexp_count("text", F.lit(SYMBOLS))
    return split.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        dup_lines(F.col("text")).alias("n_dup_lines"),
        repeat_words(F.col("h")).alias("n_repeat_words"),
        F.array(
            symbols,
            (F.octet_length("text") - F.length("text")),
            *[F.regexp_count("text", F.lit(c)) for c in CLASSES],
        ).alias("chars"),
        F.array(*[F.size("found") - F.size(F.array_remove("found", word)) for word in WORDS]).alias("common"),
    )


def shares(counts: Column, total: Column) -> Column:
    """Counts over the total, with what is left as a last share."""
    rest = F.aggregate(counts, total.cast("long"), lambda a, x: a - x)
    return F.transform(F.concat(counts, F.array(F.greatest(rest, F.lit(0)).cast("int"))), lambda x: x / total)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def _references(usual: DataFrame, least: int) -> DataFrame:
    """chars, common: mean shares of each language with `least` documents, and of all others together.

    A language of few documents has no reference of its own, so junk cannot vouch for itself; nor
    have the others together if they are fewer than that.
    """
    n_chars, n_common = len(CLASSES) + 3, len(WORDS) + 1
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, n in (("p_chars", n_chars), ("p_common", n_common)) for i in range(n)]
    by_lang = usual.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *sums)
    own = F.when(F.col("n") >= least, F.struct("lang"))
    merged = by_lang.groupBy(own.alias("own")).agg(
        F.sum("n").alias("n"),
        *[F.sum(f"{c}{i}").alias(f"{c}{i}") for c, n in (("p_chars", n_chars), ("p_common", n_common)) for i in range(n)],
    ).where(F.col("n") >= least)
    return merged.select(
        F.array(*[F.col(f"p_chars{i}") / F.col("n") for i in range(n_chars)]).alias("chars"),
        F.array(*[F.col(f"p_common{i}") / F.col("n") for i in range(n_common)]).alias("common"),
    )


def judge(
    docs: DataFrame,
    least_words: int = 50,
    most_repeated: int = 50,
    char_words: int = 50,
    common_words: int = 100,
    reference_words: int = 200,
    reference_documents: int = 20,
    char_distance: float = 0.3,
    word_distance: float = 0.5,
) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): the counts, both distances, the verdicts.

    base_failed: fewer than `least_words` words, or more than `most_repeated` percent of them
    in repeated three-word windows. kept: not base_failed, and neither distance above its
    limit; a distance is null, and counts as passed, for texts below `char_words` or
    `common_words` words and when no language has a reference. Null and empty texts have counts
    of 0 and fail the base rule; null languages are a language of their own; a reference needs
    `reference_documents` usual documents, and languages with fewer share one; repeated rows are
    judged alike; an empty table gives an empty result; other columns are ignored.
    """
    rows = cut(measured(docs))
    chars = shares(F.col("chars"), F.greatest(F.col("word_chars"), F.lit(1)))
    common = shares(F.col("common"), F.greatest(F.col("n_words"), F.lit(1)))
    rows = rows.withColumn(
        "base_failed",
        (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")),
    ).withColumns({"p_chars": chars, "p_common": common})
    usual = rows.where(~F.col("base_failed") & (F.col("n_words") >= reference_words))
    references = _references(usual, reference_documents)
    rows = rows.withColumn("known", references.agg(F.collect_list(F.struct("chars", "common"))).scalar())

    def nearest(p: str, field: str) -> Column:
        # null without any reference
        return F.array_min(F.transform("known", lambda q: distance(F.col(p), q[field])))

    far = {
        "char_distance": F.when(F.col("n_words") >= char_words, nearest("p_chars", "chars")),
        "word_distance": F.when(F.col("n_words") >= common_words, nearest("p_common", "common")),
    }
    judged = rows.withColumns(far)
    usual_enough = F.coalesce(F.col("char_distance") <= char_distance, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= word_distance, F.lit(True)
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & usual_enough).alias("kept"), "char_distance", "word_distance",
    )


def oracle(
    char_distance: float = 0.3, word_distance: float = 0.5, reference_words: int = 200, reference_documents: int = 20
) -> str:
    """`judge` as DuckDB SQL, distances rounded to six digits."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    classes = ", ".join(f"len(regexp_extract_all(t, {quoted(c)}))" for c in CLASSES)
    listed = "[" + ", ".join(map(quoted, WORDS)) + "]"
    n_chars, n_common = len(CLASSES) + 3, len(WORDS) + 1

    def distances(p: str, q: str) -> str:
        def part(x: str, y: str) -> str:
            return f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"

        terms = f"{part('z[1]', 'z[2]')} + {part('z[2]', 'z[1]')}"
        return f"sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}), lambda z: {terms})) / 2))"

    sums = ", ".join(
        f"sum({c}[{i}]) AS {c}{i}" for c, n in (("p", n_chars), ("q", n_common)) for i in range(1, n + 1)
    )
    again = ", ".join(f"sum({c}{i}) AS {c}{i}" for c, n in (("p", n_chars), ("q", n_common)) for i in range(1, n + 1))
    means = ", ".join(
        "[" + ", ".join(f"{c}{i} / n" for i in range(1, n + 1)) + f"] AS r{c}" for c, n in (("p", n_chars), ("q", n_common))
    )
    return rf"""
WITH d AS (
  SELECT doc_id, lang, row_number() OVER () AS r, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY r),
lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS l FROM d
), c AS (
  SELECT d.doc_id, lang, d.r, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, [len(regexp_extract_all(t, '{SYMBOLS}')), strlen(t) - length(t), {classes}] AS chars,
    list_transform({listed}, lambda x: len(list_filter(w, lambda y: lower(y) = x))) AS common
  FROM d JOIN lines USING (r) LEFT JOIN rep USING (r)
), s AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    list_transform(list_append(chars, greatest(greatest(word_chars, 1) - list_sum(chars), 0)), lambda x: x / CAST(greatest(word_chars, 1) AS DOUBLE)) AS p,
    list_transform(list_append(common, greatest(greatest(n_words, 1) - list_sum(common), 0)), lambda x: x / CAST(greatest(n_words, 1) AS DOUBLE)) AS q
  FROM c
), langs AS (
  SELECT lang, CAST(count(*) AS DOUBLE) AS n, {sums} FROM s WHERE NOT base_failed AND n_words >= {reference_words} GROUP BY lang
), merged AS (
  SELECT CASE WHEN n >= {reference_documents} THEN coalesce('x' || lang, 'n') ELSE '' END AS own, n AS m, * FROM langs
), refs AS (
  SELECT {means} FROM (SELECT own, sum(m) AS n, {again} FROM merged GROUP BY own) WHERE n >= {reference_documents}
), far AS (
  SELECT s.r, min({distances('p', 'rp')}) AS dc, min({distances('q', 'rq')}) AS dw FROM s JOIN refs ON true GROUP BY s.r
), j AS (
  SELECT s.*, CASE WHEN n_words >= 50 THEN dc END AS dc, CASE WHEN n_words >= 100 THEN dw END AS dw FROM s LEFT JOIN far USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(dc <= {char_distance}, true) AND coalesce(dw <= {word_distance}, true) AS kept,
  round(dc, 6) AS char_distance, round(dw, 6) AS word_distance
FROM j
"""
