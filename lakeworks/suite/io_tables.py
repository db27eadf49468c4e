"""Sources, typing projections, sheet cells and table management (A, B, C items).

Queries that write do so under the shared scratch folder (``spark.checkpoint.dir``) or the
scratch database, with fresh names per call, and return a frame that reads what was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions import cells as CE
from lakeworks.functions import types as TY
from lakeworks.plans import tables as TB
from lakeworks.session import scratch_path, scratch_table
from lakeworks.sources import files as FS
from lakeworks.suite import register, round6, table

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# ----------------------------------------------------------------------------- A1-A5, A8


@register(
    "scan_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def q_scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Directory read of a ``k=v`` layout without partition columns."""
    path = scratch_path(spark, "scan")
    table(spark, d, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return FS.read_parquet(spark, path)


@register(
    "scan_parquet_partitioned",
    f"SELECT {ORDERS_COLS} FROM orders",
)
def q_scan_parquet_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """The same layout with partition discovery on (the key comes back as a column)."""
    path = scratch_path(spark, "scanp")
    table(spark, d, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return FS.read_parquet(spark, path, partition_columns=True).select(*ORDERS_COLS.split(", "))


@register(
    "period_start",
    """SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start,
              CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS year_start FROM orders""",
)
def q_period_start(spark: SparkSession, d: str) -> DataFrame:
    """Monthly / yearly period ordinals (as pandas stores them) back to start timestamps."""
    o = table(spark, d, "orders")
    ords = o.select(
        "o_orderkey",
        ((F.year("o_orderdate") - 1970) * 12 + F.month("o_orderdate") - 1).alias("m_ord"),
        (F.year("o_orderdate") - 1970).alias("y_ord"),
    )
    return ords.select(
        "o_orderkey", FS.period_start("m_ord", "M").alias("month_start"), FS.period_start("y_ord", "Y").alias("year_start")
    )


@register(
    "sql_over_files",
    """SELECT o_orderpriority, count(*) AS n_lines, round(sum(l_quantity), 2) AS qty
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def q_sql_over_files(spark: SparkSession, d: str) -> DataFrame:
    return FS.sql_over_files(
        spark,
        """SELECT o_orderpriority, count(*) AS n_lines, round(sum(l_quantity), 2) AS qty
           FROM li JOIN ord ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
        li=f"{d}/lineitem.parquet",
        ord=f"{d}/orders.parquet",
    )


_CSV_TYPES = {
    "l_orderkey": "BIGINT",
    "l_linenumber": "INT",
    "l_quantity": "DECIMAL(12,2)",
    "l_extendedprice": "DOUBLE PRECISION",
    "l_returnflag": "VARCHAR(1)",
    "l_shipdate": "DATE",
}


@register(
    "load_csv",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem""",
)
def q_load_csv(spark: SparkSession, d: str) -> DataFrame:
    """CSV with a header and a comment line (two header lines skipped), declared types."""
    path = scratch_path(spark, "csv")
    li = table(spark, d, "lineitem").select(
        *[c for c in _CSV_TYPES if c != "l_shipdate"], F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")
    )
    li.write.option("header", "true").csv(path)
    out = FS.load_csv(spark, path, _CSV_TYPES, ignore_header=1, max_error=0)
    return round6(out.withColumn("l_shipdate", F.col("l_shipdate").cast("string")))


@register("load_json", f"SELECT {ORDERS_COLS} FROM orders")
def q_load_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "json")
    o = table(spark, d, "orders")
    o.write.json(path)
    return FS.load_files(spark, path, "json", schema=o.schema).select(*ORDERS_COLS.split(", "))


@register("load_orc", f"SELECT {ORDERS_COLS} FROM orders")
def q_load_orc(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    table(spark, d, "orders").write.orc(path)
    return FS.load_files(spark, path, "orc").select(*ORDERS_COLS.split(", "))


@register("read_table", "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def q_read_table(spark: SparkSession, d: str) -> DataFrame:
    t = scratch_table(spark, "cust")
    TB.save_table(table(spark, d, "customer"), t)
    db, name = t.split(".")
    return round6(FS.read_table(spark, name, schema=db))


# ----------------------------------------------------------------------------- A10-A12 listings


def _orders_export(spark: SparkSession, d: str, partition_cols=()) -> str:
    """Orders written with a row cap per file, so the file count grows with the table."""
    path = scratch_path(spark, "files")
    o = table(spark, d, "orders").withColumn("o_month", F.date_format("o_orderdate", "yyyy-MM"))
    w = o.write.option("maxRecordsPerFile", 1000)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return path


def _listed_rows(spark: SparkSession, folder: str, recursive: bool) -> DataFrame:
    """Rows per listed file: ``name, length, n_rows`` (NULL rows: listed, but not part of the export)."""
    files = FS.list_files(spark, folder, recursive=recursive, glob="*.parquet")
    tail = lambda c: F.array_join(F.slice(F.split(c, "/"), -2, 2), "/")  # noqa: E731 - folder and name
    files = files.select(tail(F.col("path")).alias("name"), "length")
    rows = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = rows.select(tail(F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))).alias("_name"), "n_rows")
    return files.join(rows, F.col("name") == F.col("_name"), "left").select("name", "length", "n_rows")


@register("file_inventory", "SELECT count(*) AS n_rows, TRUE AS all_sized FROM orders")
def q_file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Recursive listing of a partitioned export: the rows of the files listed."""
    listed = _listed_rows(spark, _orders_export(spark, d, ("o_orderpriority",)), True)
    return listed.agg(F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("length") > 0).alias("all_sized"))


@register("file_inventory_flat", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_folders FROM orders")
def q_file_inventory_flat(spark: SparkSession, d: str) -> DataFrame:
    """Flat listing: all files of a flat export, none of a partitioned one."""
    flat = _listed_rows(spark, _orders_export(spark, d), False).agg(F.sum("n_rows").alias("n_rows"))
    folders = FS.list_files(spark, _orders_export(spark, d, ("o_orderpriority",)), recursive=False, glob="*.parquet")
    return flat.join(folders.agg(F.count(F.lit(1)).alias("n_in_folders")))


@register(
    "partition_inventory",
    "SELECT DISTINCT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS o_month, 'o_orderstatus,o_month' AS keys FROM orders",
)
def q_partition_inventory(spark: SparkSession, d: str) -> DataFrame:
    found = FS.list_partition_paths(spark, _orders_export(spark, d, ("o_orderstatus", "o_month")), depth=2)
    values = F.col("partition_values")
    return found.select(
        values[0]["value"].alias("o_orderstatus"), values[1]["value"].alias("o_month"), F.array_join(values["key"], ",").alias("keys")
    )


# ----------------------------------------------------------------------------- A14, C12, C13


def _ragged_rows(spark: SparkSession, d: str) -> DataFrame:
    """Sheet-like ragged rows built from conversations: header, then (conv, turn, role, words...)."""
    conv = table(spark, d, "conversations")
    data = conv.select(
        (F.col("conv_id") * 1000 + F.col("turn") + 1).alias("row_id"),
        F.concat(
            F.array(F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.col("role")),
            F.split(F.col("text"), " "),
        ).alias("cells"),
    )
    header = data.limit(0).unionByName(
        spark.range(1).select(
            F.lit(-1).cast("long").alias("row_id"),
            F.array(*[F.lit(h) for h in ["conv_id", "turn", "role", "w1", "w2", "w3"]]).alias("cells"),
        )
    )
    return header.unionByName(data)


_RAGGED_SQL = """SELECT conv_id * 1000 + turn + 1 AS row_id, CAST(conv_id AS VARCHAR) AS conv_id,
       CAST(turn AS VARCHAR) AS turn,
       CASE WHEN role IN ('None', 'none', 'null', 'NULL') THEN '' ELSE coalesce(role, '') END AS role,
       CASE WHEN coalesce(string_split(text, ' ')[1], '') IN ('None', 'none', 'null', 'NULL') THEN ''
            ELSE coalesce(string_split(text, ' ')[1], '') END AS w1,
       CASE WHEN coalesce(string_split(text, ' ')[2], '') IN ('None', 'none', 'null', 'NULL') THEN ''
            ELSE coalesce(string_split(text, ' ')[2], '') END AS w2,
       CASE WHEN coalesce(string_split(text, ' ')[3], '') IN ('None', 'none', 'null', 'NULL') THEN ''
            ELSE coalesce(string_split(text, ' ')[3], '') END AS w3
FROM conversations"""


@register("ragged_to_table", _RAGGED_SQL)
def q_ragged_to_table(spark: SparkSession, d: str) -> DataFrame:
    return CE.ragged_to_table(_ragged_rows(spark, d))


@register(
    "to_cells",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(o_orderstatus, '') AS o_orderstatus,
              CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) OR isinf(o_totalprice) THEN ''
                   ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""",
)
def q_to_cells(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return CE.to_cells(o)


@register(
    "format_display",
    """SELECT l_orderkey, l_linenumber, format('{:.1f}', l_discount * 100) || '%' AS l_discount,
              format('{:,.2f}', l_extendedprice) AS l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
       FROM lineitem""",
)
def q_format_display(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_extendedprice", "l_shipdate")
    return CE.format_display(li, percent=["l_discount"], number=[3], dates=["l_shipdate"])


# ----------------------------------------------------------------------------- C2-C11


@register(
    "cast_declared",
    """SELECT o_orderkey, TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice,
              CAST(TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END
                AS DATE) AS VARCHAR) AS o_orderdate,
              CAST(TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END
                AS INTEGER) AS DOUBLE) AS o_custkey,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
              o_orderpriority
       FROM orders""",
)
def q_cast_declared(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = o.select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("o_custkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    declared = {
        "o_totalprice": "DECIMAL(12,2)",
        "o_orderdate": "DATE",
        "o_custkey": "INT",
        "o_orderstatus": "VARCHAR(1)",
    }
    out = TY.cast_declared(text, declared)
    # nullable INT and DATE leave as DOUBLE / text so both engines hand pandas the same dtypes
    out = out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    return round6(out.withColumn("o_custkey", F.col("o_custkey").cast("double")))


@register(
    "null_columns",
    """SELECT o_orderkey, CAST(CAST(NULL AS DATE) AS VARCHAR) AS ship_note_date, CAST(NULL AS VARCHAR) AS remark
       FROM orders""",
)
def q_null_columns(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.lit(None).alias("ship_note_date"), F.lit(None).alias("remark"))
    typed = TY.type_null_columns(o, {"ship_note_date": "DATE"})
    return typed.withColumn("ship_note_date", F.col("ship_note_date").cast("string"))


@register(
    "schema_as_rows",
    """SELECT 0 AS position, 'l_orderkey' AS column_name, 'bigint' AS spark_type, 'BIGINT' AS declared_type, count(l_orderkey) AS n_non_null FROM lineitem
       UNION ALL SELECT 1 AS position, 'l_partkey' AS column_name, 'bigint' AS spark_type, 'BIGINT' AS declared_type, count(l_partkey) AS n_non_null FROM lineitem
       UNION ALL SELECT 2 AS position, 'l_suppkey' AS column_name, 'bigint' AS spark_type, 'BIGINT' AS declared_type, count(l_suppkey) AS n_non_null FROM lineitem
       UNION ALL SELECT 3 AS position, 'l_linenumber' AS column_name, 'int' AS spark_type, 'INT' AS declared_type, count(l_linenumber) AS n_non_null FROM lineitem
       UNION ALL SELECT 4 AS position, 'l_quantity' AS column_name, 'double' AS spark_type, 'DOUBLE PRECISION' AS declared_type, count(l_quantity) AS n_non_null FROM lineitem
       UNION ALL SELECT 5 AS position, 'l_extendedprice' AS column_name, 'double' AS spark_type, 'DOUBLE PRECISION' AS declared_type, count(l_extendedprice) AS n_non_null FROM lineitem
       UNION ALL SELECT 6 AS position, 'l_discount' AS column_name, 'double' AS spark_type, 'DOUBLE PRECISION' AS declared_type, count(l_discount) AS n_non_null FROM lineitem
       UNION ALL SELECT 7 AS position, 'l_tax' AS column_name, 'double' AS spark_type, 'DOUBLE PRECISION' AS declared_type, count(l_tax) AS n_non_null FROM lineitem
       UNION ALL SELECT 8 AS position, 'l_returnflag' AS column_name, 'string' AS spark_type, 'CHAR(1)' AS declared_type, count(l_returnflag) AS n_non_null FROM lineitem
       UNION ALL SELECT 9 AS position, 'l_linestatus' AS column_name, 'string' AS spark_type, 'VARCHAR(65535)' AS declared_type, count(l_linestatus) AS n_non_null FROM lineitem
       UNION ALL SELECT 10 AS position, 'l_shipdate' AS column_name, 'timestamp_ntz' AS spark_type, 'TIMESTAMP' AS declared_type, count(l_shipdate) AS n_non_null FROM lineitem""",
)
def q_schema_as_rows(spark: SparkSession, d: str) -> DataFrame:
    """Declared types inferred from the lineitem schema, with each column's non-NULL count."""
    li = table(spark, d, "lineitem")
    rows = TY.schema_rows(li, overrides={"l_returnflag": "CHAR(1)"})
    types = spark.createDataFrame(
        rows, "position int, column_name string, spark_type string, declared_type string"
    )
    counts = li.agg(*[F.count(F.col(c)).alias(c) for c in li.columns])
    stacked = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_non_null")) for c in li.columns])
        ).alias("s")
    ).select("s.*")
    return types.join(F.broadcast(stacked), "column_name").select(
        "position", "column_name", "spark_type", "declared_type", "n_non_null"
    )


@register(
    "lowercase_columns",
    "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status FROM orders",
)
def q_lowercase_columns(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ORDER_KEY"), F.col("o_custkey").alias("Cust_Key"), F.col("o_orderstatus").alias("STATUS")
    )
    return TY.lowercase_columns(o)


@register(
    "decimal_normalise",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber,
              round(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE), 6) AS l_extendedprice FROM lineitem""",
)
def q_decimal_normalise(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("decimal(38,0)").alias("l_orderkey"),
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice"),
    )
    return round6(TY.normalise_decimals(li))


@register(
    "align_schema",
    """SELECT c_custkey, c_name, CAST(CAST(NULL AS DATE) AS VARCHAR) AS c_since, round(c_acctbal, 6) AS c_acctbal
       FROM customer""",
)
def q_align_schema(spark: SparkSession, d: str) -> DataFrame:
    target = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_since", T.DateType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    out = TY.align_to(table(spark, d, "customer"), target)
    return round6(out.withColumn("c_since", F.col("c_since").cast("string")))


@register(
    "ints_to_double",
    """SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size,
              round(p_retailprice, 6) AS p_retailprice FROM part""",
)
def q_ints_to_double(spark: SparkSession, d: str) -> DataFrame:
    return round6(TY.ints_to_double(table(spark, d, "part")))


# ----------------------------------------------------------------------------- B1, B2, B4, B5


@register("save_files_roundtrip", f"SELECT {ORDERS_COLS} FROM orders UNION ALL SELECT {ORDERS_COLS} FROM orders")
def q_save_files_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(*ORDERS_COLS.split(", "))
    p1 = TB.save_files(o, scratch_path(spark, "b1") + ".parquet.parquet", "parquet")
    p2 = TB.save_files(o, scratch_path(spark, "b1csv"), "csv")
    back_csv = spark.read.schema(o.schema).option("header", "true").csv(p2)
    return spark.read.parquet(p1).unionByName(back_csv)


@register(
    "save_table_layout",
    "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition, 'orders by status' AS comment FROM orders",
)
def q_save_table_layout(spark: SparkSession, d: str) -> DataFrame:
    """Partitions and comment of a table after an overwrite and a compaction that name neither."""
    t = scratch_table(spark, "layout")
    o = table(spark, d, "orders").select(*ORDERS_COLS.split(", "))
    TB.save_table(o, t, partition_by=["o_orderstatus"], comment="orders by status")
    TB.save_table(o, t)
    TB.optimize_table(spark, t, "o_custkey")
    return spark.sql(f"SHOW PARTITIONS {t}").withColumn("comment", F.lit(TB.table_comment(spark, t)))


@register(
    "identity_unordered",
    """SELECT count(*) AS n, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id,
       count(DISTINCT l_orderkey) AS n_orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def q_identity_unordered(spark: SparkSession, d: str) -> DataFrame:
    """Ids in scan order over a joined frame: as many as rows, dense, no row lost."""
    joined = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    ided = TB.with_identity(joined.select("l_orderkey", "l_linenumber", "o_custkey"), "rid")
    return ided.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("rid").alias("n_ids"),
        F.min("rid").alias("first_id"),
        F.max("rid").alias("last_id"),
        F.count_distinct("l_orderkey").alias("n_orders"),
    )


@register("save_table_overwrite", f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderstatus = 'F'")
def q_save_table_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite a table with a frame that reads that same table (staged swap keeps it safe)."""
    t = scratch_table(spark, "ovw")
    TB.save_table(table(spark, d, "orders").select(*ORDERS_COLS.split(", ")), t)
    return TB.save_table(spark.table(t).where(F.col("o_orderstatus") == "F"), t, mode="overwrite")


@register(
    "save_table_append_merge",
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) FROM orders WHERE o_orderstatus <> 'O'""",
)
def q_save_table_append_merge(spark: SparkSession, d: str) -> DataFrame:
    t = scratch_table(spark, "app")
    o = table(spark, d, "orders")
    TB.save_table(o.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderstatus"), t)
    out = TB.save_table(
        o.where(F.col("o_orderstatus") != "O").select("o_orderkey", "o_orderstatus", "o_totalprice"),
        t,
        mode="append",
        merge_schema=True,
    )
    return round6(out)


@register(
    "table_comment",
    "SELECT 'customers, ''quoted'' text' AS comment, count(*) AS n_rows FROM customer",
)
def q_table_comment(spark: SparkSession, d: str) -> DataFrame:
    t = scratch_table(spark, "cmt")
    saved = TB.save_table(table(spark, d, "customer"), t, comment="customers, 'quoted' text")
    return saved.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(TB.table_comment(spark, t)).alias("comment"), "n_rows"
    )


@register("optimize_table", f"SELECT {ORDERS_COLS} FROM orders")
def q_optimize_table(spark: SparkSession, d: str) -> DataFrame:
    t = scratch_table(spark, "opt")
    TB.save_table(table(spark, d, "orders").select(*ORDERS_COLS.split(", ")), t)
    return TB.optimize_table(spark, t, "o_custkey, o_totalprice")


# ----------------------------------------------------------------------------- B6, B7, B8


@register(
    "export_query",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority""",
)
def q_export_query(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    path = scratch_path(spark, "exp")
    out = TB.export_query(
        spark,
        "CREATE OR REPLACE TEMP VIEW ord_f AS SELECT * FROM orders; "
        "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ord_f GROUP BY o_orderpriority",
        path,
        file_prefix="daily",
        fmt="csv",
        parallel=False,
    )
    return spark.read.schema("o_orderpriority string, n bigint, total double").option("header", "true").csv(out)


@register("export_partitioned", f"SELECT {ORDERS_COLS} FROM orders")
def q_export_partitioned(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    path = scratch_path(spark, "expp")
    out = TB.export_query(spark, "orders", path, partition_by=["o_orderstatus"], max_file_size_mb=0.05)
    return spark.read.parquet(out).select(*ORDERS_COLS.split(", "))


@register(
    "load_files_to_table",
    """SELECT row_number() OVER (ORDER BY o_orderkey) AS load_id, o_orderkey, o_custkey, o_orderstatus
       FROM orders""",
)
def q_load_files_to_table(spark: SparkSession, d: str) -> DataFrame:
    """Files -> new table with an identity column (ids follow the load order of o_orderkey)."""
    path = scratch_path(spark, "load")
    table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderkey").write.parquet(path)
    t = scratch_table(spark, "loaded")
    TB.load_files_to_table(
        spark,
        t,
        path,
        column_types={"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR(1)"},
        identity="load_id",
        identity_order_by="o_orderkey",
    )
    return spark.table(t)


@register(
    "create_table_from_frame",
    """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, CAST(CAST(NULL AS DATE) AS VARCHAR) AS delivered,
              CAST(NULL AS VARCHAR) AS note FROM orders""",
)
def q_create_table_from_frame(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.lit(None).alias("delivered"),
        F.lit(None).alias("note"),
    )
    t = scratch_table(spark, "frame")
    out = TB.create_table_from_frame(o, t, column_types={"delivered": "DATE"})
    return round6(out.withColumn("delivered", F.col("delivered").cast("string")))


# ----------------------------------------------------------------------------- B9-B12


def _partitioned_orders(spark: SparkSession, d: str, cols=("o_orderstatus",)) -> str:
    path = scratch_path(spark, "ext")
    table(spark, d, "orders").select(*ORDERS_COLS.split(", ")).write.partitionBy(*cols).parquet(path)
    return path


@register("external_table", f"SELECT {ORDERS_COLS} FROM orders")
def q_external_table(spark: SparkSession, d: str) -> DataFrame:
    path = _partitioned_orders(spark, d)
    t = scratch_table(spark, "ext")
    TB.external_table(spark, t, path, [("o_orderstatus", "VARCHAR(1)")])
    return spark.table(t).select(*ORDERS_COLS.split(", "))


@register("add_partition", f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderstatus = 'F'")
def q_add_partition(spark: SparkSession, d: str) -> DataFrame:
    path = _partitioned_orders(spark, d)
    t = scratch_table(spark, "extp")
    TB.external_table(spark, t, path, [("o_orderstatus", "VARCHAR(1)")], sync_partitions=False)
    TB.add_partition(spark, t, {"o_orderstatus": "F"}, f"{path}/o_orderstatus=F")
    return spark.table(t).select(*ORDERS_COLS.split(", "))


@register("sync_partitions", f"SELECT {ORDERS_COLS} FROM orders")
def q_sync_partitions(spark: SparkSession, d: str) -> DataFrame:
    path = _partitioned_orders(spark, d, ("o_orderstatus", "o_orderpriority"))
    t = scratch_table(spark, "exts")
    TB.external_table(
        spark, t, path, [("o_orderstatus", "VARCHAR(1)"), ("o_orderpriority", "VARCHAR(20)")], sync_partitions=False
    )
    TB.sync_partitions_from_files(spark, t, path, ["o_orderstatus", "o_orderpriority"])
    return spark.table(t).select(*ORDERS_COLS.split(", "))


@register("copy_table", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier")
def q_copy_table(spark: SparkSession, d: str) -> DataFrame:
    src = scratch_table(spark, "src")
    dst = scratch_table(spark, "dst")
    TB.save_table(table(spark, d, "supplier"), src)
    TB.save_table(table(spark, d, "supplier").limit(0), dst)
    return round6(TB.copy_table(spark, src, dst, replace=True))


@register(
    "table_stats",
    """SELECT count(*) AS n_rows, round(min(c_acctbal), 6) AS min_acctbal, round(max(c_acctbal), 6) AS max_acctbal,
              count(*) FILTER (WHERE c_acctbal IS NULL) AS null_acctbal FROM customer""",
)
def q_table_stats(spark: SparkSession, d: str) -> DataFrame:
    """ANALYZE a table, then read row count and column min/max/NULLs from the catalog statistics."""
    t = scratch_table(spark, "stats")
    TB.save_table(table(spark, d, "customer"), t)
    TB.analyze_table(spark, t)
    st = TB.column_stats(spark, t, "c_acctbal")
    row = (TB.table_row_count(spark, t), float(st["min"]), float(st["max"]), int(st["num_nulls"]))
    out = spark.createDataFrame([row], "n_rows long, min_acctbal double, max_acctbal double, null_acctbal long")
    return round6(out)


# ----------------------------------------------------------------------------- B15, B17-B19


@register(
    "identity_column",
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_custkey FROM orders",
)
def q_identity_column(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return TB.with_identity(o, "id", order_by="o_orderkey")


@register("sheet_to_files", _RAGGED_SQL.replace("SELECT conv_id * 1000 + turn + 1 AS row_id, ", "SELECT CAST(conv_id * 1000 + turn + 1 AS VARCHAR) AS row_id, "))
def q_sheet_to_files(spark: SparkSession, d: str) -> DataFrame:
    cells = CE.to_cells(CE.ragged_to_table(_ragged_rows(spark, d)))
    path = TB.save_files(cells, scratch_path(spark, "sheet"), "csv")
    schema = ", ".join(f"{c} string" for c in cells.columns)
    reader = spark.read.schema(schema).option("header", "true").option("multiLine", "true").option("emptyValue", "")
    return reader.csv(path).na.fill("")


@register(
    "cells_append",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier
       UNION ALL
       SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_nationkey < 10""",
)
def q_cells_append(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    t = scratch_table(spark, "cells")
    TB.write_cells(CE.to_cells(s.where(F.col("s_nationkey") > 100)), t, "overwrite")
    TB.write_cells(CE.to_cells(s), t, "overwrite")
    return TB.write_cells(CE.to_cells(s.where(F.col("s_nationkey") < 10)), t, "append")


@register(
    "upsert_table",
    """SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 6) AS o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P')
       UNION ALL
       SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) FROM orders WHERE o_orderstatus = 'F'""",
)
def q_upsert_table(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    t = scratch_table(spark, "ups")
    TB.save_table(o.where(F.col("o_orderstatus").isin("F", "O")), t)
    src = o.where(F.col("o_orderstatus").isin("O", "P")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return round6(TB.upsert_table(spark, t, src, ["o_orderkey"]))


@register(
    "upsert_partitions",
    """SELECT o_orderkey, round(o_totalprice * 2, 6) AS o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus
       FROM orders WHERE o_orderstatus IN ('O', 'P')
       UNION ALL SELECT o_orderkey, round(o_totalprice, 6), o_orderstatus FROM orders WHERE o_orderstatus = 'F'""",
)
def q_upsert_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Upsert into a partitioned table: one partition gets new rows, one loses all of its rows to it, one is not touched."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    t = scratch_table(spark, "upsp")
    TB.save_table(o, t, partition_by=["o_orderstatus"])
    src = o.where(F.col("o_orderstatus").isin("O", "P")).select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.replace("o_orderstatus", F.lit("P"), F.lit("O")).alias("o_orderstatus")
    )
    return round6(TB.upsert_table(spark, t, src, ["o_orderkey"]))


@register(
    "overwrite_external",
    "SELECT o_orderkey, round(o_totalprice / 2, 6) AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
)
def q_overwrite_external(spark: SparkSession, d: str) -> DataFrame:
    """An external table overwritten from itself: it stays external and where it is."""
    path = TB.save_files(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), scratch_path(spark, "ext"))
    t = scratch_table(spark, "extow")
    TB.external_table(spark, t, path)
    half = spark.table(t).where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    TB.save_table(half, t)
    return round6(spark.read.parquet(path).select("o_orderkey", "o_totalprice"))
