import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tenurelens.sources import tables as T
from tenurelens.sources.schemas import RAW_SCHEMAS


@pytest.mark.parametrize("unit", ["ns", "us"])
def test_clickstream_epochs_in_either_unit(spark, tmp_path, unit):
    folder = tmp_path / "clickstream"
    folder.mkdir()
    stamp = np.array(["2024-03-01T12:00:00.000001"], dtype=f"datetime64[{unit}]")
    pq.write_table(
        pa.table({
            "event_id": ["e"], "customer_id": ["c"], "event_timestamp": stamp, "event_type": ["view"],
            "session_duration_s": pa.array([1], pa.int32()), "pages_in_session": pa.array([1], pa.int32()),
        }),
        folder / "p.parquet",
    )
    df = T.read_raw(spark, str(tmp_path), "clickstream")
    assert df.select(F.col("event_timestamp").cast("string")).first()[0] == "2024-03-01 12:00:00.000001"
    assert spark.table("clickstream").count() == 1


def test_read_all_and_unknown_table(spark, tmp_path):
    for name, ddl in RAW_SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))
    assert set(T.read_all(spark, str(tmp_path))) == set(RAW_SCHEMAS)
    spark.range(3).write.parquet(str(tmp_path / "other"))
    assert T.read_raw(spark, str(tmp_path), "other", register_view=False).count() == 3


def test_write_counts_rows_and_features_must_exist(spark, tmp_path):
    assert T.write_features(spark.range(7), str(tmp_path)) == 7
    assert T.read_features(spark, str(tmp_path)).count() == 7
    with pytest.raises(FileNotFoundError):
        T.read_features(spark, str(tmp_path / "nowhere"))


def test_scores_replace_only_their_own_date(spark, tmp_path):
    path = str(tmp_path / "scores")
    for date, n in (("2024-01-01", 3), ("2024-02-01", 4), ("2024-03-01", 5), ("2024-02-01", 2)):
        assert T.write_scores(spark.range(n).withColumn("score_date", F.lit(date)), path) == n
    scores = T.read_scores(spark, path)
    assert {r[0]: r[1] for r in scores.groupBy("score_date").count().collect()} == {
        "2024-01-01": 3, "2024-02-01": 2, "2024-03-01": 5,
    }
    assert T.scores_on(scores, "2024-03-01").count() == 5
    assert T.scores_before(scores, "2024-03-01").count() == 2
    assert T.scores_before(scores, "2024-01-01").count() == 0


def test_window_filters(spark):
    df = spark.sql("SELECT DATE '2024-06-30' AS d UNION ALL SELECT DATE '2024-07-01' UNION ALL SELECT DATE '2024-07-02'")
    assert T.up_to(df, "d", "2024-06-30").count() == 1
    assert T.after(df, "d", "2024-07-01").count() == 1


def test_report_export_and_best_run(spark, tmp_path):
    T.write_report(spark.range(2), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 2
    T.export(spark.range(3), "json", str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    runs = spark.createDataFrame(
        [("a", "FINISHED", 0.6), ("b", "FAILED", 0.9), ("c", "FINISHED", 0.7), ("d", "FINISHED", None)],
        "run_id string, status string, concordance_index double",
    )
    assert T.best_run(runs).first()["run_id"] == "c"
    assert T.best_run(runs, higher_is_better=False).first()["run_id"] == "a"
