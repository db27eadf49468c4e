"""Joins Spark SQL has no keyword for: as-of (latest earlier row) and time-range joins.

Both are cut by time so that a hot key (one user with a third of all events) does not land in one
task:

* ``asof_join`` unions both sides, carries the latest right row forward inside (key, range of time)
  with ``last(..., ignorenulls)``, and fills rows whose range has no earlier right row from a small
  table of each range's last right row. The ranges are quantiles of the times, so they hold about
  as many rows each, however the times lie.
* ``range_join`` equi-joins on (key, time bucket) with the probe side replicated to the few
  buckets its window can touch, then refines with the exact range predicate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.common import epoch_micros, range_bounds, with_range


def _epoch_seconds(col: str):
    return epoch_micros(F.col(col)) / 1_000_000.0


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    right_cols: Sequence[str],
    *,
    buckets: int | None = None,
    prefix: str = "",
) -> DataFrame:
    """For each left row, attach ``right_cols`` of the latest right row with the same ``by`` keys
    and ``right_on <= left_on`` (NULLs when there is none; a NULL key or time matches nothing). Left rows are kept
    whole. Time is cut into ``buckets`` ranges of about equal numbers of rows, so a key whose events all fall on one day
    is spread as any other."""
    by = list(by)
    right_cols = list(right_cols)
    # a NULL key matches nothing: without the right rows that have one, the left ones find none
    right = right.dropna(subset=[*by, right_on])
    lcols = left.columns
    l_tagged = left.select(
        *by,
        F.struct(*[F.col(c) for c in lcols]).alias("_lw_left"),
        F.col(left_on).alias("_lw_t"),
        F.lit(1).alias("_lw_side"),
    )
    payload = F.struct(F.col(right_on).alias("_ts"), *[F.col(c) for c in right_cols])
    r_tagged = right.select(*by, F.col(right_on).alias("_lw_t"), F.lit(0).alias("_lw_side"), payload.alias("_lw_pay"))
    both = l_tagged.unionByName(r_tagged, allowMissingColumns=True)
    (bounds,) = range_bounds(both.select("_lw_t"), ["_lw_t"], buckets)
    ranged = with_range(both, "_lw_t", bounds, "_lw_range")
    dealt = ranged.withColumn("_lw_place", F.struct(*by, "_lw_range")).repartition("_lw_place")
    # right rows sort before left rows at the same instant, so equal times match
    inside = (
        Window.partitionBy("_lw_place").orderBy("_lw_t", "_lw_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = dealt.withColumn("_lw_local", F.last("_lw_pay", ignorenulls=True).over(inside)).where("_lw_side = 1")
    # the last right row of each range goes on to the ranges behind it: rows per key = its ranges, not its events
    ends = dealt.groupBy("_lw_place").agg(F.max_by("_lw_pay", F.when(F.col("_lw_side") == 0, F.col("_lw_t"))).alias("_lw_last"))
    before = (
        Window.partitionBy(*[F.col("_lw_place")[k] for k in by])
        .orderBy(F.col("_lw_place")["_lw_range"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    prior = ends.select(F.col("_lw_place").alias("_lw_at"), F.last("_lw_last", ignorenulls=True).over(before).alias("_lw_prior"))
    filled = local.join(prior, F.col("_lw_place") == F.col("_lw_at"))
    match = F.when(F.col("_lw_t").isNotNull(), F.coalesce("_lw_local", "_lw_prior"))
    return filled.select(
        *[F.col("_lw_left")[c].alias(c) for c in lcols],
        *[match[c].alias(prefix + c) for c in right_cols],
    )


def range_join(
    probe: DataFrame,
    build: DataFrame,
    by: Sequence[str],
    probe_on: str,
    build_on: str,
    before_seconds: int,
    after_seconds: int = 0,
    *,
    bucket_seconds: int | None = None,
    include_upper: bool = False,
) -> DataFrame:
    """Pairs (probe, build) with equal ``by`` keys and
    ``probe_on - before <= build_on < probe_on + after`` (``<=`` with ``include_upper``).

    The build side is keyed by its time bucket; each probe row is replicated to the buckets its
    window overlaps (window / bucket + 1 copies), so the join is an equi-join on (keys, bucket).
    """
    by = list(by)
    width = bucket_seconds or max(1, before_seconds + after_seconds)
    pt = _epoch_seconds(probe_on)
    lo = F.floor((pt - before_seconds) / width).cast("long")
    hi = F.floor((pt + after_seconds) / width).cast("long")
    p = probe.withColumn("_lw_b", F.explode(F.sequence(lo, hi)))
    b = build.withColumn("_lw_b", F.floor(_epoch_seconds(build_on) / width).cast("long"))
    cond = [p[k] == b[k] for k in by] + [p["_lw_b"] == b["_lw_b"]]
    bt, ptime = b[build_on], p[probe_on]
    lower = bt >= ptime - F.expr(f"INTERVAL {before_seconds} SECONDS")
    upper_edge = ptime + F.expr(f"INTERVAL {after_seconds} SECONDS")
    upper = bt <= upper_edge if include_upper else bt < upper_edge
    joined = p.join(b, cond + [lower, upper], "inner")
    return joined.drop(p["_lw_b"]).drop(b["_lw_b"])


def range_aggregate(
    probe: DataFrame,
    build: DataFrame,
    by: Sequence[str],
    probe_on: str,
    build_on: str,
    before_seconds: int,
    aggregates: Mapping[str, Callable],
    payload: Mapping[str, Column],
) -> DataFrame:
    """Each probe row with aggregates over the build rows of its keys in ``[probe_on - before, probe_on)``.

    No pairs are formed. Time is cut into buckets as long as the window; a build row goes to its own
    bucket and the next one, so a range window per (keys, bucket) sees all it needs, and a key with
    many rows is spread over its buckets. ``aggregates`` maps a name to ``f(column, window)``, where
    ``column(name)`` is a ``payload`` column of the build side (NULL on probe rows).
    """
    by = list(by)
    span = before_seconds * 1_000_000
    at = lambda c: epoch_micros(F.col(c)).cast("long")
    rest = [c for c in probe.columns if c not in by]
    none = F.lit(None)
    p = probe.select(
        *by, F.struct(*rest).alias("_lw_probe"), at(probe_on).alias("_lw_t"), F.floor(at(probe_on) / span).alias("_lw_b"),
        *[none.alias(f"_lw_p_{k}") for k in payload],
    )
    # a NULL key matches nothing: probe rows that have one see no build rows
    b = build.dropna(subset=[*by, build_on]).select(*by, at(build_on).alias("_lw_t"), *[v.alias(f"_lw_p_{k}") for k, v in payload.items()])
    own = F.floor(F.col("_lw_t") / span)
    b = b.withColumn("_lw_b", F.explode(F.array(own, own + 1)))
    both = b.unionByName(p, allowMissingColumns=True)
    window = Window.partitionBy(*by, "_lw_b").orderBy("_lw_t").rangeBetween(-span, -1)
    column = lambda k: F.col(f"_lw_p_{k}")
    out = both.select("*", *[f(column, window).alias(k) for k, f in aggregates.items()])
    out = out.where(F.col("_lw_probe").isNotNull())
    return out.select(*[c if c in by else F.col("_lw_probe")[c].alias(c) for c in probe.columns], *aggregates)
