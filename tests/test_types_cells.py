import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions import cells as CE
from lakeworks.functions import types as TY


def test_base_types():
    assert TY.base_type("VARCHAR(100)") == "VARCHAR"
    assert TY.base_type("  DATE  ") == "DATE"
    assert TY.base_type("DECIMAL(12,2)") == "DECIMAL"
    assert TY.is_date_type("date") and TY.is_int_type("SMALLINT") and TY.is_float_type("numeric(3,1)")
    assert TY.is_string_type("text")
    assert isinstance(TY.target_int_type("BIGINT"), T.LongType)
    assert isinstance(TY.target_int_type("SMALLINT"), T.IntegerType)
    assert isinstance(TY.target_int_type("INT"), T.IntegerType)


def test_cast_declared_all_null_and_mixed(spark):
    df = spark.createDataFrame(
        [(1, "Alice", "2020-01-01", "50000"), (2, "Bob", None, None), (3, None, "not a date", "55000")],
        "id long, name string, hire_date string, salary string",
    )
    out = TY.cast_declared(df, {"id": "BIGINT", "name": "VARCHAR(100)", "hire_date": "DATE", "salary": "DECIMAL(12,2)"})
    types = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(types["id"], T.LongType) and isinstance(types["hire_date"], T.DateType)
    assert isinstance(types["salary"], T.DoubleType) and isinstance(types["name"], T.StringType)
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["hire_date"] == dt.date(2020, 1, 1) and rows[3]["hire_date"] is None
    assert rows[3]["salary"] == 55000.0


def test_small_ints_and_strings(spark):
    df = spark.createDataFrame([("1", "2", "3", "5551234", "")], "s string, m string, b string, phone string, e string")
    out = TY.cast_declared(df, {"s": "SMALLINT", "m": "INT", "b": "BIGINT", "phone": "VARCHAR(20)", "e": "VARCHAR(5)"})
    t = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(t["s"], T.IntegerType) and isinstance(t["m"], T.IntegerType) and isinstance(t["b"], T.LongType)
    r = out.first()
    assert r["phone"] == "5551234" and r["e"] is None


def test_null_columns_get_types(spark):
    a = spark.createDataFrame([(1,), (2,)], "id long").withColumn("hire_date", F.lit(None)).withColumn("salary", F.lit(None))
    out = TY.type_null_columns(a, {"hire_date": "DATE"})
    t = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(t["hire_date"], T.DateType) and isinstance(t["salary"], T.StringType)
    b = spark.createDataFrame([(1, None)], "id long, x string")
    assert TY.all_null_columns(b) == ["x"]
    assert isinstance(TY.type_null_columns(b, {"x": "BIGINT"}, by_value=True).schema["x"].dataType, T.LongType)


def test_infer_and_schema_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True)], "s string, i long, d double, b boolean")
    assert TY.infer_column_types(df, {"S": "CHAR(1)"}) == {
        "s": "CHAR(1)",
        "i": "BIGINT",
        "d": "DOUBLE PRECISION",
        "b": "BOOLEAN",
    }
    cols = TY.schema_to_columns(df.schema, partition_columns=["b"], overrides={"d": "REAL"})
    assert cols == [("s", "VARCHAR(65535)"), ("i", "BIGINT"), ("d", "REAL")]
    nested = T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType()))])
    with pytest.raises(ValueError):
        TY.schema_to_columns(nested, strict=True)


def test_lowercase_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "USER_ID long, NPC long")
    assert TY.lowercase_columns(df).columns == ["user_id", "npc"]
    with pytest.raises(ValueError):
        TY.lowercase_columns(spark.createDataFrame([(1, 2)], "`A` long, `b` long").toDF("A", "a"))


def test_reserved_words():
    with pytest.raises(ValueError):
        TY.check_reserved(["id", "select"], ["SELECT", "FROM"])
    TY.check_reserved(["id"], ["SELECT"])


def test_decimals(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(38,0)) AS user_id, CAST(1.5 AS DECIMAL(10,4)) AS score, 'x' AS `a.b`")
    out = TY.normalise_decimals(df)
    t = {f.name: f.dataType for f in out.schema.fields}
    assert isinstance(t["user_id"], T.LongType) and isinstance(t["score"], T.DoubleType)
    assert out.first()["a.b"] == "x"


def test_align(spark):
    df = spark.createDataFrame([(1, "x", 9)], "a long, b string, extra int")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.StringType()), T.StructField("a", T.IntegerType())])
    out = TY.align_to(df, target, exclude=["id"])
    assert out.columns == ["b", "a"] and isinstance(out.schema["a"].dataType, T.IntegerType)


def test_ints_to_double(spark):
    out = TY.ints_to_double(spark.createDataFrame([(1, 2, "x")], "a int, b long, c string"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "double", "string"]


def test_to_cells(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 2, 3, 4, 5), 1, "a", 1.0), (None, None, None, math.inf), (None, 2, "nan", math.nan)],
        "ts timestamp_ntz, n long, cat string, x double",
    )
    rows = [tuple(r) for r in CE.to_cells(df).collect()]
    assert rows[0] == ("2025-01-02 03:04:05", "1", "a", "1.0")
    assert rows[1] == ("", "", "", "")
    assert rows[2] == ("", "2", "", "")


def test_ragged_rows(spark):
    rows = spark.createDataFrame(
        [(0, ["a", "b", "c"]), (1, ["1"]), (2, ["1", "2", "3", "4"]), (3, ["None", None, "NULL"])],
        "row_id long, cells array<string>",
    )
    out = [tuple(r)[1:] for r in CE.ragged_to_table(rows).orderBy("row_id").collect()]
    assert out == [("1", "", ""), ("1", "2", "3"), ("", "", "")]


def test_format_display(spark):
    df = spark.createDataFrame([(0.123, 1234567.891, dt.date(2024, 3, 1))], "p double, v double, d date")
    r = CE.format_display(df, percent=["p"], number=[1], dates=["d"], date_pattern="dd/MM/yyyy").first()
    assert (r["p"], r["v"], r["d"]) == ("12.3%", "1,234,567.89", "01/03/2024")
    with pytest.raises(ValueError):
        CE.format_display(df, percent=["nope"])
    with pytest.raises(ValueError):
        CE.format_display(df, number=[7])
