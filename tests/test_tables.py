import os

import pytest
from pyspark.sql import functions as F

from lakeworks.plans import tables as TB
from lakeworks.session import scratch_path, scratch_table
from lakeworks.sources import files as FS


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_paths():
    assert FS.join_path("s3://bucket", "root//a", "b") == "s3://bucket/root/a/b/"
    assert FS.join_path("/data", "x", "file.parquet") == "/data/x/file.parquet"
    assert FS.split_bucket_path("s3://bkt/k/p.csv") == ("bkt", "k/p.csv")
    assert FS.normalize_path("hdfs://nn//a///b") == "hdfs://nn/a/b"


def test_save_table_modes_and_self_overwrite(spark):
    t = scratch_table(spark, "t_modes")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    TB.save_table(df, t)
    with pytest.raises(ValueError):
        TB.save_table(df, t, mode="error")
    assert TB.save_table(spark.range(3), t, mode="ignore").count() == 10
    # overwrite with a frame that reads the target itself
    out = TB.save_table(spark.table(t).where("id < 4"), t, mode="overwrite")
    assert _rows(out) == [(i, 2 * i) for i in range(4)]
    with pytest.raises(ValueError):
        TB.save_table(df, t, mode="append", drop_existing=True)
    with pytest.raises(ValueError):
        TB.save_table(df, t, overwrite_schema=True, merge_schema=True)


def test_append_merge_schema(spark):
    t = scratch_table(spark, "t_merge")
    TB.save_table(spark.range(2), t)
    with pytest.raises(ValueError):
        TB.save_table(spark.range(2, 4).withColumn("x", F.lit("a")), t, mode="append")
    out = TB.save_table(spark.range(2, 4).withColumn("x", F.lit("a")), t, mode="append", merge_schema=True)
    assert _rows(out) == [(0, None), (1, None), (2, "a"), (3, "a")]


def test_comment_round_trip(spark):
    t = scratch_table(spark, "t_comment")
    TB.save_table(spark.range(1), t, comment="it's \"quoted\"")
    assert TB.table_comment(spark, t) == "it's \"quoted\""


def test_optimize_copy_upsert_preserve_content(spark):
    t = scratch_table(spark, "t_opt")
    df = spark.range(200).select("id", (F.col("id") % 7).alias("a"), (F.col("id") * 3 % 11).alias("b"))
    TB.save_table(df, t)
    assert _rows(TB.optimize_table(spark, t, "a, b")) == _rows(df)
    assert _rows(TB.optimize_table(spark, t, ["a"])) == _rows(df)
    dst = scratch_table(spark, "t_copy")
    with pytest.raises(ValueError):
        TB.copy_table(spark, t, t)
    assert _rows(TB.copy_table(spark, t, dst)) == _rows(df)
    src = spark.range(190, 210).select("id", F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"))
    up = _rows(TB.upsert_table(spark, t, src, ["id"]))
    assert len(up) == 210 and up[195] == (195, -1, -1) and up[5] == (5, 5, 4)


def test_identity_numbering(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "k").repartition(5)
    ordered = TB.with_identity(df, "id", order_by="k").orderBy("k").collect()
    assert [r["id"] for r in ordered] == list(range(1, len(ordered) + 1))
    scan = TB.with_identity(df, "row_id", start=100)
    ids = sorted(r["row_id"] for r in scan.collect())
    assert ids == list(range(101, 101 + df.count())) and scan.columns[0] == "row_id"
    assert TB.with_identity(scan, "ROW_ID").columns == scan.columns


def test_save_files_rules(spark, tmp_dir):
    df = spark.range(3)
    with pytest.raises(ValueError):
        TB.save_files(df, os.path.join(tmp_dir, "x"), "xlsx")
    with pytest.raises(ValueError):
        TB.save_files(df.limit(0), os.path.join(tmp_dir, "empty"))
    p = TB.save_files(df, os.path.join(tmp_dir, "d.parquet.parquet"), single_file=True)
    assert p.endswith("d.parquet") and spark.read.parquet(p).count() == 3


def test_export_prefix_and_file_size(spark):
    spark.range(500).createOrReplaceTempView("lw_export_src")
    base = scratch_path(spark, "exp")
    a = TB.export_query(spark, "SELECT id FROM lw_export_src", base, file_prefix="data", max_file_size_mb=0.0005)
    b = TB.export_query(spark, "lw_export_src", base, file_prefix="data2")
    TB.export_query(spark, "SELECT id FROM lw_export_src WHERE id < 5", base, file_prefix="data")
    assert spark.read.parquet(a).count() == 5 and spark.read.parquet(b).count() == 500
    files = FS.list_files(spark, b, glob="*.parquet").count()
    assert files >= 1


def test_load_csv_errors_and_headers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as fh:
        fh.write("# exported\nid,d,v\n1,2024-01-02,1.5\n2,bad-date,2.5\n3,2024-01-04,x\n4,2024-01-05,\n")
    types = {"id": "BIGINT", "d": "DATE", "v": "DOUBLE"}
    with pytest.raises(ValueError):
        FS.load_csv(spark, path, types, ignore_header=2, max_error=0)
    ok = FS.load_csv(spark, path, types, ignore_header=2, max_error=5)
    rows = sorted(tuple(r) for r in ok.collect())
    assert [r[0] for r in rows] == [1, 4] and rows[1][2] is None


def test_external_table_partitions(spark):
    path = scratch_path(spark, "ext")
    df = spark.range(30).select("id", (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 2).cast("string").alias("j"))
    df.write.partitionBy("k", "j").parquet(path)
    t = scratch_table(spark, "ext")
    ddl = TB.external_table(spark, t, path, [("k", "VARCHAR(2)"), ("j", "VARCHAR(2)")], return_query=True)
    assert "PARTITIONED BY" in ddl and "LOCATION" in ddl
    TB.external_table(spark, t, path, [("k", "VARCHAR(2)"), ("j", "VARCHAR(2)")], sync_partitions=False)
    assert spark.table(t).count() == 0
    TB.add_partition(spark, t, {"k": "0", "j": "0"}, f"{path}/k=0/j=0")
    assert spark.table(t).count() == 5
    res = TB.sync_partitions_from_files(spark, t, path, ["k", "j"])
    assert res["added"] == 6 and spark.table(t).count() == 30
    with pytest.raises(FileNotFoundError):
        TB.external_table(spark, scratch_table(spark, "none"), scratch_path(spark, "nothing"))


def test_partition_listing_skips_plain_dirs(spark):
    path = scratch_path(spark, "plist")
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(path + "/sub")
    found = {r["partition_path"].rstrip("/").split("/")[-1] for r in FS.list_partition_paths(spark, path + "/sub").collect()}
    assert found == {"k=0", "k=1"}


def test_load_files_to_table_identity(spark):
    path = scratch_path(spark, "load")
    spark.range(5).withColumnRenamed("id", "k").write.parquet(path)
    t = scratch_table(spark, "loaded")
    TB.create_table_like(spark, t, [("k", "BIGINT")], identity="rid")
    TB.load_files_to_table(spark, t, path, identity="rid", identity_order_by="k")
    out = TB.load_files_to_table(spark, t, path, identity="rid", identity_order_by="k")
    assert sorted(r["rid"] for r in out.collect()) == list(range(1, 11))
    with pytest.raises(ValueError):
        TB.load_files_to_table(spark, scratch_table(spark, "x"), path, "json")
