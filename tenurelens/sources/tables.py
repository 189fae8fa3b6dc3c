"""Reading and writing: raw tables, feature matrix, scores, reports, model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tenurelens.sources.schemas import RAW_SCHEMAS


def epoch_to_timestamp(raw: Column) -> Column:
    """Epoch micros or nanos (told apart by magnitude, row by row) as a timestamp."""
    micros = F.when(
        raw > F.lit(10**17), F.call_function("div", raw, F.lit(1000).cast("bigint"))
    ).otherwise(raw)
    return F.timestamp_micros(micros)


def read_raw(
    spark: SparkSession, root: str, dataset: str, register_view: bool = True
) -> DataFrame:
    """One raw Parquet table under its fixed layout; unknown names use the file's own."""
    reader = spark.read
    if dataset in RAW_SCHEMAS:
        reader = reader.schema(RAW_SCHEMAS[dataset])
    df = reader.parquet(f"{root.rstrip('/')}/{dataset}")
    if dataset == "clickstream" and isinstance(
        df.schema["event_timestamp"].dataType, LongType
    ):
        df = df.withColumn("event_timestamp", epoch_to_timestamp(F.col("event_timestamp")))
    if register_view:
        df.createOrReplaceTempView(dataset)
    return df


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, root, name) for name in RAW_SCHEMAS}


def up_to(df: DataFrame, date_col: str, cutoff: str) -> DataFrame:
    """Training window: rows dated on or before the cutoff."""
    return df.where(F.col(date_col) <= F.lit(cutoff).cast("date"))


def after(df: DataFrame, date_col: str, start: str) -> DataFrame:
    """Scoring window: rows dated strictly after the start."""
    return df.where(F.col(date_col) > F.lit(start).cast("date"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> int:
    """Write snappy Parquet; the row count is taken from the same job."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def has_parts(spark: SparkSession, path: str) -> bool:
    """Does a folder hold data files, itself or by partition?"""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(jvm_path, True)
    while files.hasNext():
        if files.next().getPath().getName().startswith("part-"):
            return True
    return False


def write_features(features: DataFrame, root: str) -> int:
    return write_parquet(features, f"{root.rstrip('/')}/features")


def read_features(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/features"
    if not path_exists(spark, path) or not has_parts(spark, path):
        raise FileNotFoundError(f"no feature matrix at {path}; build and write it first")
    return spark.read.parquet(path)


def write_scores(scores: DataFrame, path: str) -> int:
    """Replace only the score dates present in `scores`; other dates stay as they are."""
    seen = Observation()
    (
        scores.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("score_date")
        .parquet(path)
    )
    return seen.get["rows"]


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("score_date", F.col("score_date").cast("string"))


def scores_on(scores: DataFrame, score_date: str) -> DataFrame:
    return scores.where(F.col("score_date") == F.lit(score_date))


def scores_before(scores: DataFrame, score_date: str) -> DataFrame:
    """The newest score date earlier than the given one (empty when there is none)."""
    newest = (
        scores.where(F.col("score_date") < F.lit(score_date))
        .select("score_date")
        .distinct()
        .agg(F.max("score_date"))
        .scalar()
    )
    return scores.where(F.col("score_date") == newest)


def write_report(report: DataFrame, path: str) -> None:
    """Small report tables only: one row per model, feature or check."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export(df: DataFrame, fmt: str, target: str | None = None, mode: str = "append", **options) -> None:
    """Hand a table to any sink Spark knows."""
    df.write.format(fmt).mode(mode).options(**options).save(target)


def best_run(
    runs: DataFrame, metric: str = "concordance_index", higher_is_better: bool = True
) -> DataFrame:
    """Best finished run of a runs table (one row, or none)."""
    order = F.desc_nulls_last(metric) if higher_is_better else F.asc_nulls_last(metric)
    return runs.where(F.col("status") == "FINISHED").orderBy(order, "run_id").limit(1)


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, or a folder in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint a table in the folder that all executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
