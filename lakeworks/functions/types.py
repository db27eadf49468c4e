"""Declared (warehouse-style) column types and the projections that enforce them.

Every function here is a single ``select`` over the frame (no row leaves the executors), except
``all_null_columns``, which runs one aggregate whose result is one row of per-column counts.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Declared-type names the loaders understand, grouped by kind.
DATE_TYPES = {"DATE"}
TIMESTAMP_TYPES = {"TIMESTAMP", "TIMESTAMPTZ", "TIMESTAMP WITHOUT TIME ZONE", "TIMESTAMP WITH TIME ZONE"}
INT_TYPES = {"SMALLINT", "INT", "INTEGER", "INT2", "INT4", "INT8", "BIGINT"}
FLOAT_TYPES = {"DECIMAL", "NUMERIC", "FLOAT", "FLOAT4", "FLOAT8", "DOUBLE", "DOUBLE PRECISION", "REAL"}
STRING_TYPES = {"VARCHAR", "CHAR", "CHARACTER", "TEXT", "STRING", "BPCHAR", "NVARCHAR", "CHARACTER VARYING"}
BOOL_TYPES = {"BOOLEAN", "BOOL"}
BINARY_TYPES = {"VARBYTE", "VARBINARY", "BINARY"}

# Spark type -> declared type written to DDL (unknown types -> VARCHAR(65535)).
DEFAULT_VARCHAR = "VARCHAR(65535)"
SPARK_TO_DECLARED = {
    "string": "VARCHAR(65535)",
    "bigint": "BIGINT",
    "int": "INT",
    "smallint": "SMALLINT",
    "tinyint": "SMALLINT",
    "double": "DOUBLE PRECISION",
    "float": "REAL",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "binary": "VARBYTE(65535)",
}


def base_type(declared: str) -> str:
    """``"DECIMAL(12,2)" -> "DECIMAL"``, ``"  date  " -> "DATE"``."""
    return re.sub(r"\s*\(.*$", "", declared.strip()).upper()


def is_date_type(declared: str) -> bool:
    return base_type(declared) in DATE_TYPES


def is_timestamp_type(declared: str) -> bool:
    return base_type(declared) in TIMESTAMP_TYPES


def is_int_type(declared: str) -> bool:
    return base_type(declared) in INT_TYPES


def is_float_type(declared: str) -> bool:
    return base_type(declared) in FLOAT_TYPES


def is_string_type(declared: str) -> bool:
    return base_type(declared) in STRING_TYPES


def target_int_type(declared: str) -> T.DataType:
    """64-bit only for BIGINT/INT8; SMALLINT and INT are widened/kept at 32 bits."""
    return T.LongType() if base_type(declared) in ("BIGINT", "INT8") else T.IntegerType()


def spark_type(declared: str, decimal_as: str = "double") -> T.DataType:
    """Spark type that stores values of a declared type."""
    b = base_type(declared)
    if b in DATE_TYPES:
        return T.DateType()
    if b in TIMESTAMP_TYPES:
        return T.TimestampType() if "TZ" in b or "WITH TIME ZONE" in b else T.TimestampNTZType()
    if b in INT_TYPES:
        return target_int_type(declared)
    if b in ("DECIMAL", "NUMERIC") and decimal_as == "decimal":
        m = re.search(r"\((\d+)\s*,\s*(\d+)\)", declared)
        return T.DecimalType(int(m.group(1)), int(m.group(2))) if m else T.DecimalType(38, 18)
    if b in FLOAT_TYPES:
        return T.DoubleType()
    if b in BOOL_TYPES:
        return T.BooleanType()
    if b in BINARY_TYPES:
        return T.BinaryType()
    return T.StringType()


def cast_to_declared(col: Column, declared: str, decimal_as: str = "double") -> Column:
    """C2 for one column: bad dates/numbers -> NULL (``try_cast``), text ``""`` -> NULL."""
    target = spark_type(declared, decimal_as)
    if isinstance(target, T.StringType):
        s = col.cast("string")
        return F.when(s == "", F.lit(None).cast("string")).otherwise(s)
    if isinstance(target, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.try_cast(target)
    return col.try_cast(target)


def cast_declared(df: DataFrame, column_types: Mapping[str, str], decimal_as: str = "double") -> DataFrame:
    """Cast declared columns (case-insensitive names); undeclared columns are untouched."""
    lower = {k.lower(): v for k, v in column_types.items()}
    return df.select(
        *[
            cast_to_declared(F.col(quote(c)), lower[c.lower()], decimal_as).alias(c) if c.lower() in lower else F.col(quote(c))
            for c in df.columns
        ]
    )


def quote(name: str) -> str:
    """Backtick-quote names with dots, spaces or backticks."""
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        return name
    return "`" + name.replace("`", "``") + "`"


def all_null_columns(df: DataFrame) -> list[str]:
    """C3 detection by value: one aggregate of non-null counts (a single small result row)."""
    if not df.columns:
        return []
    counts = df.agg(*[F.count(F.col(quote(c))).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]


def type_null_columns(
    df: DataFrame,
    column_types: Mapping[str, str] | None = None,
    default: str = "string",
    by_value: bool = False,
) -> DataFrame:
    """Give columns of ``NullType`` (or, with ``by_value``, holding only NULLs) a real type:
    the declared one when given, else ``default``."""
    declared = {k.lower(): v for k, v in (column_types or {}).items()}
    nulls = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    if by_value:
        nulls |= set(all_null_columns(df))
    out = []
    for f in df.schema.fields:
        if f.name in nulls:
            if f.name.lower() in declared:
                target = spark_type(declared[f.name.lower()])
            elif by_value and not isinstance(f.dataType, T.NullType):
                target = f.dataType
            else:
                target = T._parse_datatype_string(default)
            out.append(F.lit(None).cast(target).alias(f.name))
        else:
            out.append(F.col(quote(f.name)))
    return df.select(*out)


def declared_type_of(dt: T.DataType) -> str | None:
    """Declared type for a Spark type; None for types a warehouse DDL cannot hold."""
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision}, {dt.scale})"
    if isinstance(dt, T.NullType):
        return DEFAULT_VARCHAR
    return SPARK_TO_DECLARED.get(dt.simpleString())


def infer_column_types(df: DataFrame, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """C4: declared types from the frame's schema; overrides first; unknown -> VARCHAR(65535)."""
    overrides = {k.lower(): v for k, v in (overrides or {}).items()}
    out = {}
    for f in df.schema.fields:
        if f.name.lower() in overrides:
            out[f.name] = overrides[f.name.lower()]
        else:
            out[f.name] = declared_type_of(f.dataType) or DEFAULT_VARCHAR
    return out


def schema_to_columns(
    schema: T.StructType,
    partition_columns: Sequence[str] = (),
    overrides: Mapping[str, str] | None = None,
    strict: bool = False,
) -> list[tuple[str, str]]:
    """File schema -> ``[(name, declared type)]``; partition columns removed; overrides win;
    nested types kept as Spark DDL unless ``strict`` (then skipped with a warning)."""
    overrides = overrides or {}
    parts = set(partition_columns)
    cols = []
    for f in schema.fields:
        if f.name in parts:
            continue
        if f.name in overrides:
            cols.append((f.name, overrides[f.name]))
            continue
        declared = declared_type_of(f.dataType)
        if declared is None:
            if strict:
                log.warning("column %s of type %s skipped", f.name, f.dataType.simpleString())
                continue
            declared = f.dataType.simpleString().upper()
        cols.append((f.name, declared))
    if not cols and schema.fields and not all(f.name in parts for f in schema.fields):
        raise ValueError("no column of the schema can be declared")
    if not schema.fields:
        raise ValueError("schema is empty")
    return cols


def ddl_of(columns: Sequence[tuple[str, str]]) -> str:
    """Spark DDL body for declared columns (types mapped to their Spark storage type)."""
    parts = []
    for name, declared in columns:
        b = base_type(declared)
        known = b in DATE_TYPES | TIMESTAMP_TYPES | INT_TYPES | FLOAT_TYPES | STRING_TYPES | BOOL_TYPES | BINARY_TYPES
        parts.append(f"{quote(name)} {spark_type(declared).simpleString() if known else declared}")
    return ", ".join(parts)


def check_reserved(columns: Sequence[str], reserved: Sequence[str]) -> None:
    """Raise when a column name is a reserved word (case-insensitive, opt-in list)."""
    words = {w.upper() for w in reserved}
    bad = [c for c in columns if c.upper() in words]
    if bad:
        raise ValueError(f"reserved words used as column names: {bad}")


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide raise."""
    lower = [c.lower() for c in df.columns]
    if len(set(lower)) != len(lower):
        dup = sorted({c for c in lower if lower.count(c) > 1})
        raise ValueError(f"lower-casing makes column names collide: {dup}")
    if lower == df.columns:
        return df
    return df.toDF(*lower)


def normalise_decimals(df: DataFrame) -> DataFrame:
    """DECIMAL with scale 0 -> BIGINT, other DECIMAL -> DOUBLE; names quoted safely."""
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("long" if f.dataType.scale == 0 else "double")
        out.append(c.alias(f.name))
    return df.select(*out)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """All DECIMAL columns -> DOUBLE (the default ``decimal_as="double"`` storage)."""
    return df.select(
        *[
            F.col(quote(f.name)).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(quote(f.name))
            for f in df.schema.fields
        ]
    )


def align_to(
    df: DataFrame,
    target: T.StructType | Sequence[tuple[str, T.DataType]],
    exclude: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Target column order; missing columns as typed NULL, extras dropped, types cast to the
    target's (the existing table schema wins); ``exclude`` (identity columns) never supplied. A value
    that does not fit becomes NULL, or raises with ``strict`` (under ANSI, the default)."""
    fields = [(f.name, f.dataType) for f in target.fields] if isinstance(target, T.StructType) else list(target)
    have = {c.lower(): c for c in df.columns}
    skip = {e.lower() for e in exclude}
    out = []
    for name, dt in fields:
        if name.lower() in skip:
            continue
        src = have.get(name.lower())
        if src is None:
            out.append(F.lit(None).cast(dt).alias(name))
        else:
            value = F.col(quote(src))
            out.append((value.cast(dt) if strict else value.try_cast(dt)).alias(name))
    return df.select(*out)


def ints_to_double(df: DataFrame) -> DataFrame:
    """C11: integer columns -> DOUBLE (as scoring signatures expect)."""
    ints = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return df.select(
        *[
            F.col(quote(f.name)).cast("double").alias(f.name) if isinstance(f.dataType, ints) else F.col(quote(f.name))
            for f in df.schema.fields
        ]
    )


def schema_rows(df: DataFrame, overrides: Mapping[str, str] | None = None) -> list[tuple[int, str, str, str]]:
    """C4 as rows: ``(position, column, spark type, declared type)``."""
    declared = infer_column_types(df, overrides)
    return [(i, f.name, f.dataType.simpleString(), declared[f.name]) for i, f in enumerate(df.schema.fields)]
