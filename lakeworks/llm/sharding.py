"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each (record key, shard) pair draws a fixed number u in (0, 1) from a hash; the record goes to the shard
with the largest ``-weight / ln(u)``. The draw of a pair depends on nothing else, so a shard added takes
its share from all others and no record moves between old shards; a heavier weight only attracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.frames import aside, back, unused
from lakeworks.session import stored

#: parts of a shard that are numbered apart, so that no task holds a whole shard
SLOT_PARTS = 1024
#: hexadecimal digits of the draw; 13 digits are exact in a double
_DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """Uniform in (0, 1), from the MD5 of ``key/shard``."""
    digest = F.md5(F.concat(key, F.lit(f"/{shard}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 ..) of a record key; a weight of 0 takes nothing, ties go to the smallest shard.
    A null key counts as the text ``null``."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    scored = [
        F.struct((F.lit(-float(w)) / F.ln(draw(key, s))).alias("score"), F.lit(-s).alias("shard"))
        for s, w in enumerate(weights)
        if w > 0
    ]
    return -F.array_max(F.array(*scored))["shard"]


def with_slots(rows: DataFrame, shard_col: str, spread: Sequence[Column], order: Sequence[str], out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    A shard is numbered in ``SLOT_PARTS`` parts by a hash of ``spread``, which should tell rows apart that share an id;
    the parts' offsets are one small table of (shards x parts) rows, the only thing that is broadcast. All columns stay,
    ``out`` is added. ``rows`` are read twice, so they should be stored, or come from a scan.
    """
    part = unused(rows, "_part")
    rows = rows.withColumn(part, F.pmod(F.xxhash64(*spread), F.lit(SLOT_PARTS)))
    keys = (shard_col, *order, part)
    packed = aside(rows, keys).withColumnRenamed(part, "_part")
    rows = rows.drop(part)
    counts = packed.groupBy(F.col(shard_col).alias("_s"), F.col("_part").alias("_p")).agg(
        F.count(F.lit(1)).cast("long").alias("_n")
    )
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_s", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard_col, "_part").orderBy(*order)
    numbered = packed.withColumn("_place", F.row_number().over(inside))
    joined = numbered.join(F.broadcast(offsets), (F.col(shard_col) == F.col("_s")) & (F.col("_part") == F.col("_p")))
    return back(joined.withColumn(out, F.col("_offset") + F.col("_place") - 1), rows, out, keep=keys[:-1])


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown_weight: float = 1.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: id and weights alone decide; ``grown_shard`` is the shard once one more shard of
    ``grown_weight`` is added. ``size``: UTF-8 bytes of the text plus 1; null text counts as empty. Rows
    with a null id share the key ``null``; repeated ids share their shard and get slots of their own, in the order of
    their texts' checksums, equal rows in any. However many rows share an id, they are numbered in parts: by text, and
    rows without an id at random. Very long texts pass as any; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.col(id_col)
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).cast("int").alias("shard"),
        rendezvous(key, [*weights, grown_weight]).cast("int").alias("grown_shard"),
        F.when(key.isNull(), F.floor(F.rand(0) * SLOT_PARTS)).alias("salt"),
    )
    # stored: a draw must be the same for the counts and for the numbers
    rows = stored(rows, "shards")
    out = with_slots(rows, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("salt")], ["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")
