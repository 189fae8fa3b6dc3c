"""The dealt operators as queries over whole tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurelens.llm import (
    decontaminate, licenses, minhash, mixing, neighbours, pages, passages, pii, quality, ranking, rules, spelling, tokenids,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes over 4-word shingles at Jaccard 0.8."""
    docs = _read(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, minhash.Plan(size=4, percent=80))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in the shards of a mix with weights 1, 2, 3 over the sources."""
    return mixing.dealt_quotas(_read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_text(_read(spark, sf_dir, "pages"))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 512 ids in training order."""
    return tokenids.training_order(_read(spark, sf_dir, "documents"), tokenids.vocabulary())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and distance verdict of every document."""
    judged = rules.judge(_read(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    docs, items = (_read(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = decontaminate.find_passages(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        "found.n_items",
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        "found.contaminated",
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose repeated passages, with the original offsets of what goes."""
    runs = passages.repeated_runs(_read(spark, sf_dir, "documents"))
    spelled = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"]))
    return runs.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_removed"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"]).alias("removed_words"),
        F.array_join(spelled, ",").alias("spans"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find(_read(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    counts = [
        F.size(F.filter("found", pii.is_base(kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spelled(base).cast("binary"), 256).alias("base_sha256"),
        pii.spelled(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_spans"),
        (F.size("found") > 0).alias("has_personal"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return ranking.rank(*(_read(spark, sf_dir, t) for t in ("documents", "benchmark")))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest inner products of every hundredth vector with all others."""
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters and more, the forms they vary and the roots of those."""
    return spelling.variants(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_minhash": op2_minhash,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_html": op5_html,
    "op6_token_ids": op6_token_ids,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_pii": op10_pii,
    "op11_ranked_search": op11_ranked_search,
    "op12_nearest": op12_nearest,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op1_licenses": licenses.oracle(),
    "op2_minhash": r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM toks
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r
)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, m.component_id = t.doc_id AS kept
FROM toks t LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
""",
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source
), w AS (SELECT *, 1 + nth % 3 AS weight FROM s),
lv AS (
  SELECT *, CAST(sum(words) OVER () - coalesce(sum(words * 3) OVER o, 0) AS DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY words * 3 / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, least(3.0::DOUBLE * words, weight * coalesce((SELECT level FROM lv l WHERE l.level * l.weight <= l.words * 3
    ORDER BY l.words * 3 / l.weight, l.nth LIMIT 1), 0.0::DOUBLE)) AS target FROM w
), g AS (
  SELECT *, CAST(round(target) AS BIGINT) AS goal,
    greatest(1, CAST(ceil(sqrt(CAST(words AS DOUBLE))) AS BIGINT)) AS n_blocks FROM t
), e AS (
  SELECT *, CASE WHEN words > 0 THEN goal // words ELSE 0 END AS epochs FROM g
), d AS (
  SELECT sized.doc_id, sized.size, e.*,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM sized JOIN e ON sized.source IS NOT DISTINCT FROM e.source
), b AS (
  SELECT nth, h % n_blocks AS block, sum(size) AS bw FROM d GROUP BY 1, 2
), p AS (
  SELECT nth, block, coalesce(sum(bw) OVER (PARTITION BY nth
    ORDER BY CAST('0x' || substr(md5('mix:' || nth || ':' || block), 1, 15) AS BIGINT), block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
  FROM b
), f AS (
  SELECT d.*, d.goal - d.epochs * d.words - p.passed - coalesce(sum(d.size) OVER (
    PARTITION BY d.nth, p.block ORDER BY d.h, d.doc_id, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over
  FROM d JOIN p ON p.nth = d.nth AND p.block = d.h % d.n_blocks
)
SELECT doc_id, CAST(size AS BIGINT) AS size, words AS source_size, target,
  CAST(epochs * size + greatest(0, least(size, left_over)) AS BIGINT) AS taken
FROM f
""",
    "op7_quality_rules": rules.oracle(),
    "op8_decontaminate": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS m FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM iw))
), hits AS (SELECT doc_id, dw.m, k, item_id FROM dw JOIN iw USING (m, win)),
n AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + m)) AS pos FROM hits) GROUP BY doc_id
), s AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
""",
    "op11_ranked_search": ranking.ORACLE,
    "op12_nearest": neighbours.ORACLE,
    "op13_spelling": spelling.ORACLE,
}
