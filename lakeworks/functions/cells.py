"""Sheet-shaped data: ragged text rows to a table, and a table to display cells.

Sheets hold ragged ``list[list[str]]`` rows with the header first. Here a sheet is a frame with
a row order column and an ``ARRAY<STRING>`` of cells; the header row is the only row the driver
reads (it names the columns). Display cells are one string projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions.types import quote

# Cell texts read back from a sheet that mean "no value".
NULL_LIKE = ["None", "none", "null", "NULL"]
# Display formats.
DATETIME_CELL = "yyyy-MM-dd HH:mm:ss"
PERCENT_DECIMALS = 1  # pattern 0.0%
NUMBER_DECIMALS = 2  # pattern #,##0.00


def ragged_to_table(rows: DataFrame, order_col: str = "row_id", cells_col: str = "cells") -> DataFrame:
    """First row (lowest ``order_col``) is the header; shorter rows are padded with ``""``,
    longer rows truncated; NULL and null-like texts become ``""``. All columns are strings."""
    head = rows.agg(F.min(order_col).alias("id"), F.min_by(cells_col, order_col).alias("cells")).first()
    if head is None or head["id"] is None:
        return rows.sparkSession.createDataFrame([], T.StructType([]))
    header = [h if h is not None else "" for h in head["cells"]]
    first_id = head["id"]
    data = rows.where(F.col(order_col) != F.lit(first_id))
    cols = []
    for i, name in enumerate(header):
        cell = F.coalesce(F.get(F.col(cells_col), i), F.lit(""))
        cols.append(F.when(cell.isin(NULL_LIKE), F.lit("")).otherwise(cell).alias(name))
    return data.select(F.col(order_col), *cols)


def _is_blank_number(c: Column) -> Column:
    return c.isNull() | F.isnan(c) | (c == float("inf")) | (c == float("-inf"))


def _number_cell(c: Column) -> Column:
    """A double as plain digits, never in scientific notation (within 23 digits before the point, 15 behind)."""
    text = c.cast("string")
    digits = F.regexp_replace(c.try_cast("decimal(38,15)").cast("string"), r"0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(text.contains("E") & (F.abs(c) >= 1e-12), F.coalesce(plain, text)).otherwise(text)


def to_cells(df: DataFrame, include_headers: bool = False) -> DataFrame:
    """Every column as display text - timestamps ``yyyy-MM-dd HH:mm:ss``; NULL, NaN and
    +/-inf become ``""``; the texts ``nan`` and ``None`` become ``""``. ``include_headers`` puts a row
    with the column names first."""
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        dt = f.dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            s = F.date_format(c, DATETIME_CELL)
        elif isinstance(dt, (T.DoubleType, T.FloatType)):
            s = F.when(_is_blank_number(c), F.lit("")).otherwise(_number_cell(c))
        else:
            s = c.cast("string")
        s = F.coalesce(s, F.lit(""))
        out.append(F.when(s.isin("nan", "None"), F.lit("")).otherwise(s).alias(f.name))
    cells = df.select(*out)
    if not include_headers:
        return cells
    header = df.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in df.columns])
    return header.unionByName(cells)


def _resolve(df: DataFrame, columns: Sequence[str | int]) -> list[str]:
    names = []
    for c in columns:
        if isinstance(c, int):
            if c < 0 or c >= len(df.columns):
                raise ValueError(f"column index {c} out of range")
            names.append(df.columns[c])
        elif c in df.columns:
            names.append(c)
        else:
            raise ValueError(f"unknown column {c!r}")
    return names


def format_display(
    df: DataFrame,
    percent: Sequence[str | int] = (),
    number: Sequence[str | int] = (),
    dates: Sequence[str | int] = (),
    date_pattern: str = "yyyy-MM-dd",
) -> DataFrame:
    """Display formats on chosen columns (by name or 0-based index): percent ``0.0%``,
    number ``#,##0.00``, date by pattern. Other columns pass through."""
    pc, nc, dc = set(_resolve(df, percent)), set(_resolve(df, number)), set(_resolve(df, dates))
    out = []
    for name in df.columns:
        c = F.col(quote(name))
        if name in pc:
            c = F.concat(F.format_number(c * 100, PERCENT_DECIMALS), F.lit("%"))
        elif name in nc:
            c = F.format_number(c, NUMBER_DECIMALS)
        elif name in dc:
            c = F.date_format(c, date_pattern)
        out.append(c.alias(name))
    return df.select(*out)
