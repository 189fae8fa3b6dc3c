"""From documents to training sequences: filter, deduplicate, decontaminate, mix, tokenise."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tenurelens.llm import decontaminate, minhash, mixing, quality, tokenids
from tenurelens.llm.scratch import aside, shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go.

    Null and empty texts are judged like any other, rows with a null doc_id and repeated rows as
    well; without labels every score is one half and all rows stay. Own columns stay as they are.
    """
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked at similarity 0.8 over five-word shingles.

    It is the one of smallest doc_id. Null and empty texts and rows with a null doc_id stay, of
    rows that share a doc_id one stays; own columns stay as they are.
    """
    return minhash.keep_one(docs, minhash.Plan(size=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words one in twenty lies in a passage of the benchmark.

    Null and empty texts and rows with a null doc_id stay, repeated rows are judged alike, and
    without items all rows stay; own columns stay as they are.
    """
    return decontaminate.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a copy that is cut holds its first words.

    Null and empty texts have no words and are not taken; a null source is one, the last; rows
    with a null doc_id and repeated rows are taken like others; own columns stay as they are.
    """
    other = aside(docs.columns, ("copy", "words", "shard"))
    mixed = mixing.mix(docs.withColumnsRenamed(other)).drop("copy", "words", "shard")
    return mixed.withColumnsRenamed({v: k for k, v in other.items()}).select(*[f"`{c}`" for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids in training order.

    Null and empty texts give no sequence, rows with a null doc_id and repeated rows are encoded
    like others; the columns are those of `tokenids.training_order`, own ones are not read.
    """
    return tokenids.training_order(docs, tokenids.vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_ids),
]

#: MinHash components and boosted trees cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's rows are written to the shared folder and read again by the next one."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
