"""Exact deduplication by content-defined chunk recipes (native: DataFrame functions only).

A text is cut into chunks at places that its own characters define (never before ``MIN_CHUNK``
characters, always at ``MAX_CHUNK``), so equal texts have equal chunks and an inserted passage changes
only the chunks around it. A chunk's identifier is a 128-bit hash that is *verified*: the chunks are
deduplicated by content, and no two different contents may own one identifier. A text then is its
recipe, the ordered list of its chunk identifiers; texts are equal exactly when their recipes are. The
long texts move at most once (as chunks, deduplicated on the map side); everything after works on recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.session import scratch_path

MIN_CHUNK = 512
MAX_CHUNK = 8192
#: a boundary lies behind one of these characters and white space, before one of the others
BOUNDARY = r"(?<=[dghkyDGHKY,;]\s)(?=[aeA-E0-4])"
#: parts that the rows of one recipe are dealt over, so that a huge group of copies is split
SALTS = 64
_TRIES = 4


def chunk_pattern(low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> str:
    return rf"(?s)(?:.{{{low},{high - 1}}}?{BOUNDARY}|.{{{high}}}|.+)"


def chunks(text: Column) -> Column:
    """The text's chunks in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern()), F.lit(0))


def _identifier(chunk: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(F.lit(2 * seed), chunk).alias("a"), F.xxhash64(F.lit(2 * seed + 1), chunk, F.length(chunk)).alias("b")
    )


def verified_seed(docs: DataFrame, text_col: str = "text") -> int:
    """A seed under which every distinct chunk of ``docs`` has an identifier of its own.

    The chunks meet by content once; each seed then costs one count over identifiers. With 128 bits
    the first seed holds; should it not, the next is tried.
    """
    contents = docs.select(F.explode(chunks(F.col(text_col))).alias("_chunk")).distinct()
    for seed in range(_TRIES):
        shared = contents.groupBy(_identifier(F.col("_chunk"), seed).alias("_id")).count().where("count > 1")
        if shared.isEmpty():
            return seed
    raise RuntimeError("chunk identifiers collide under every seed")


def recipes(docs: DataFrame, seed: int, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``_recipe``, ``_sha256`` (lower-case hex of the UTF-8 text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [F.col(c) for c in docs.columns if c != text_col]
    return docs.select(
        *rest,
        F.transform(chunks(text), lambda c: _identifier(c, seed)).alias("_recipe"),
        F.sha2(text.cast("binary"), 256).alias("_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null text counts as empty. Of equal texts the row with the largest id stays; of rows that repeat
    this id and text, one stays. A null id never beats another; a group of null ids only has a null
    ``keep_id`` and keeps one row. Other columns, whatever their names, are ignored; an empty table
    gives no rows. Texts of any length are read whole.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    seed = verified_seed(own, "text")
    path = scratch_path(docs.sparkSession, "recipes")
    recipes(own, seed).write.parquet(path)
    spark = docs.sparkSession
    # rows that repeat id and recipe become one row with a count; copies of a text are dealt over salts
    rows = (
        spark.read.parquet(path)
        .groupBy("_recipe", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("_salt"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_sha256").alias("text_sha256"))
    )
    part = rows.groupBy("_recipe", "_salt").agg(F.max("doc_id").alias("_max"), F.sum("_n").alias("_rows"))
    whole = part.groupBy(F.col("_recipe").alias("_r")).agg(
        F.max("_max").alias("keep_id"), F.sum("_rows").alias("group_size")
    )
    group = part.join(whole, F.col("_recipe") == F.col("_r")).select(
        "_r", F.col("_salt").alias("_s"), "keep_id", "group_size"
    )
    out = rows.join(group, (F.col("_recipe") == F.col("_r")) & (F.col("_salt") == F.col("_s")))
    return out.select(
        "doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_i")
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"),
        "text_sha256",
    )
