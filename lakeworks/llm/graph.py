"""Connected components of a link table, with DataFrames only (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.session import stored

#: rounds after which a component finder gives up (log-many in the component size are needed)
MAX_ROUNDS = 60


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``links`` (self links are
    ignored, repeated links count once).

    Alternating large-star and small-star rounds: each hangs the neighbours of a node on the smallest of
    them, so the link table never grows, a hub's rows are split by the skew-join handling, and the number
    of rounds is logarithmic. Only one count and one checksum reach the driver per round.
    """
    edges = stored(
        links.where(F.col(u) != F.col(v))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct(),
        "links",
    )
    seen = _fingerprint(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        hung = large.join(low, F.col("u") == F.col("c"))
        small = (
            hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        edges = stored(small, "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
