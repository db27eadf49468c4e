import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.plans import scoring as SC
from lakeworks.plans import sql as P
from lakeworks.plans import tables as TB
from lakeworks.session import cut_lineage, scratch_path, work_dir
from lakeworks.sources import files as FS


def test_fetch_rules(spark):
    df = spark.range(3)
    assert len(P.fetch(df, fetch_all=True, fetch_one=True)) == 3
    assert P.fetch(df, fetch_one=True)["id"] == 0
    assert P.fetch(df) is None


def test_delete_files_and_listing(spark):
    base = scratch_path(spark, "del")
    spark.range(4).write.parquet(base + "/top")
    spark.range(4).write.parquet(base + "/top/nested_dir_not_partition")
    flat = FS.list_files(spark, base + "/top", recursive=False, glob="*.parquet").count()
    deep = FS.list_files(spark, base + "/top", recursive=True, glob="*.parquet").count()
    assert 0 < flat < deep
    assert TB.delete_files(spark, [base + "/top", base + "/missing"]) == 1
    assert not FS.has_files(spark, base + "/top")


def test_python_model_scoring_and_pipeline_round_trip(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))

    class Doubler:
        def predict(self, pdf: pd.DataFrame):
            return pdf["x"] * 2.0 + 1

    scored = SC.score_with_python_model(df, Doubler, ["x"]).collect()
    assert all(r["prediction"] == pytest.approx(r["y"]) for r in scored)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    path = SC.save_model(model, scratch_path(spark, "model"))
    out = SC.batch_score(path, df, keep=["y"]).collect()
    assert all(r["prediction"] == pytest.approx(r["y"], abs=1e-6) for r in out)


def test_cut_lineage_uses_checkpoint_dir(spark):
    assert work_dir(spark)
    df = cut_lineage(spark.range(10).withColumn("v", F.col("id") + 1))
    assert df.count() == 10


def test_local_frame_to_spark(spark):
    pdf = pd.DataFrame({"a": [1, 2], "b": ["x", "y"]})
    assert FS.to_spark(spark, pdf).count() == 2
    sdf = spark.range(2)
    assert FS.to_spark(spark, sdf) is sdf


def test_sql_over_files_and_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    spark.range(6).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(path)
    assert FS.read_parquet(spark, path).columns == ["id"]
    assert sorted(FS.read_parquet(spark, path, partition_columns=True).columns) == ["id", "k"]
    n = FS.sql_over_files(spark, "SELECT count(*) AS n FROM lw_files_v", lw_files_v=path).first()["n"]
    assert n == 6
    assert FS.first_parquet_schema(spark, path).fieldNames() == ["id"]


def test_pandas_period_columns_become_period_starts(spark, tmp_dir):
    import datetime as dt

    pdf = pd.DataFrame({"id": [1, 2, 3], "value": [10, 20, 30], "month": pd.period_range("2024-01", periods=3, freq="M")})
    path = os.path.join(tmp_dir, "periods.parquet")
    pdf.to_parquet(path)
    out = FS.read_parquet(spark, path).orderBy("id").collect()
    assert [r["month"] for r in out] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)]
    raw = FS.read_parquet(spark, path, periods=None).orderBy("id").first()["month"]
    assert raw == 648
    years = pd.DataFrame({"y": pd.period_range("2020", periods=2, freq="Y")})
    ypath = os.path.join(tmp_dir, "years.parquet")
    years.to_parquet(ypath)
    assert FS.read_parquet(spark, ypath).orderBy("y").first()["y"] == dt.datetime(2020, 1, 1)
