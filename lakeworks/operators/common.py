"""Frame-level building blocks shared by the operators.

``running_totals`` is the workhorse: inclusive running sums along an order column within groups,
spread over range partitions so that one huge group (a third of all rows) never sorts in a single
task. ``exact_quantiles`` and everything curve-shaped (ROC/PR areas, Kaplan-Meier, deciles,
concordance, identity numbering) are built on it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.session import stored

#: number of ranges that a group is cut into (None: ``BUCKETS``)
DEFAULT_BUCKETS = None
ALL_KEY = "_lw_all"


def with_group_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Ungrouped work gets a constant key so every later join is an equi-join."""
    keys = list(keys)
    if keys:
        return df, keys
    return df.withColumn(ALL_KEY, F.lit(1)), [ALL_KEY]


def join_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False
) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the right copies of the keys are dropped.

    ``small=True`` broadcasts the right side - only for sides with a proven size bound (one row,
    or one row per bucket of an ungrouped computation). Otherwise AQE decides from the measured
    size, and its skew-join handling splits a hot key.
    """
    keys = list(keys)
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    if small:
        renamed = F.broadcast(renamed)
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def sorted_position(bounds: Column, value: Column, size: int) -> Column:
    """Number of elements of a sorted array (length ``size``) that are ``< value``, as a binary
    CASE tree: log2(size) comparisons per row and fully code-generated (a ``filter`` lambda would
    be interpreted row by row)."""

    def search(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.get(bounds, mid) < value, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, size)


def epoch_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp's wall-clock fields.

    Exact and monotonic for TIMESTAMP_NTZ in every session time zone (casting to TIMESTAMP would
    go through the zone and fold at daylight-saving changes)."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60
    micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return days * 86_400_000_000 + secs * 1_000_000 + micros


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are non-NULL; NULL when a side is constant.
    (``corr`` raises DIVIDE_BY_ZERO under ANSI mode for a constant side.)"""
    xm = F.when(y.isNotNull(), x.cast("double"))
    ym = F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


#: ranges that one group is cut into by default
BUCKETS = 64


def order_proxy(df: DataFrame, col: str) -> Column | None:
    """A double that does not fall as ``col`` rises, for cutting it into ranges; None for types without one."""
    kind = df.schema[col].dataType.typeName()
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal", "boolean"):
        return F.col(col).cast("double")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return epoch_micros(F.col(col)).cast("double")
    return None


def range_bounds(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> list[list[float]]:
    """Per column at most ``buckets - 1`` values that cut it into ranges of about equal numbers of rows: one pass over
    ``df`` (a stored histogram, as a rule), one row of numbers to the driver."""
    n = max(1, buckets or BUCKETS)
    proxies = [order_proxy(df, c) for c in cols]
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    if n == 1:
        return [[] for _ in cols]
    finite = [F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x) for x in proxies]
    row = df.agg(*[F.percentile_approx(x, probs, F.lit(20 * n)).alias(f"b{i}") for i, x in enumerate(finite)]).first()
    return [sorted(set(row[f"b{i}"] or [])) for i in range(len(cols))]


def with_range(df: DataFrame, col: str, bounds: Sequence[float], out: str, descending: bool = False) -> DataFrame:
    """``df`` with the number of the range that a row's ``col`` lies in, in the order of a sort (NULL first, last if
    descending). A tree of comparisons as SQL text: one call, and compact generated code."""

    def search(lo: int, hi: int) -> str:
        mid = (lo + hi) // 2
        if lo >= hi:
            return str(len(bounds) - lo if descending else lo)
        return f"IF({out} > {bounds[mid]!r}D, {search(mid + 1, hi)}, {search(lo, mid)})"

    null = len(bounds) + 1 if descending else -1
    return df.withColumn(out, order_proxy(df, col)).withColumn(out, F.expr(f"IF({out} IS NULL, {null}, {search(0, len(bounds))})"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_cols: Sequence[str],
    bounds: Sequence[float],
    *,
    descending: bool = False,
    prefix: str = "cum_",
    totals_prefix: str | None = None,
    combine: dict[str, Column] | None = None,
) -> DataFrame:
    """Running sums without a stored step: one exchange of the rows, by group and range of ``order_col``.

    Each range is summed on its own (``combine`` first aggregates rows of equal keys and order in it). Its sums, one
    row per (group, range), become offsets of the ranges behind it, and are joined to the ranges where they lie. ``df``
    is read twice, so it should be a stored table or cheap.
    """
    keys, value_cols = list(keys), list(value_cols)
    # one non-null struct, so that groups of NULL keys meet and the join needs no second exchange
    ranged = with_range(df, order_col, bounds, "_lw_range", descending)
    dealt = ranged.withColumn("_lw_place", F.struct(*keys, "_lw_range")).drop("_lw_range").repartition("_lw_place")
    if combine:
        dealt = dealt.groupBy("_lw_place", *keys, order_col).agg(*[c.alias(k) for k, c in combine.items()])
    columns = [c for c in dealt.columns if c != "_lw_place"]
    sums = dealt.groupBy("_lw_place").agg(*[F.sum(v).alias(f"_lw_s_{v}") for v in value_cols])
    group = [F.col("_lw_place")[k] for k in keys]
    before = Window.partitionBy(*group).orderBy(F.col("_lw_place")["_lw_range"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_lw_place").alias("_lw_at"),
        *[F.coalesce(F.sum(f"_lw_s_{v}").over(before), F.lit(0)).alias(f"_lw_off_{v}") for v in value_cols],
        *([F.sum(f"_lw_s_{v}").over(Window.partitionBy(*group)).alias(f"_lw_gt_{v}") for v in value_cols] if totals_prefix else []),
    )
    ordered = F.col(order_col).desc() if descending else F.col(order_col).asc()
    inside = Window.partitionBy("_lw_place").orderBy(ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = dealt.select("*", *[F.sum(v).over(inside).alias(f"_lw_in_{v}") for v in value_cols])
    return inner.join(offsets, F.col("_lw_place") == F.col("_lw_at")).select(
        *columns,
        *[(F.col(f"_lw_in_{v}") + F.col(f"_lw_off_{v}")).alias(prefix + v) for v in value_cols],
        *([F.col(f"_lw_gt_{v}").alias(totals_prefix + v) for v in value_cols] if totals_prefix else []),
    )


def ordered_products(
    df: DataFrame, keys: Sequence[str], order_col: str, left: str, products: dict[str, str], bounds: Sequence[float]
) -> DataFrame:
    """``keys`` and, per entry ``out -> right`` of ``products``, the sum over the rows of ``right`` times the ``left`` of
    all rows before them (by ``order_col``; rows of equal order do not see each other). Exact decimals.

    Partial states merge: a range's own products, its sums of ``left`` and ``right``. As the products grow by
    ``offset x sum of right`` when a range moves behind others, no offset goes back to the rows, and only one row per
    (group, range) leaves a range.
    """
    keys = list(keys)
    dec = "decimal(38,0)"
    rights = sorted(set(products.values()))
    ranged = with_range(df, order_col, bounds, "_lw_range")
    dealt = ranged.withColumn("_lw_place", F.struct(*keys, "_lw_range")).repartition("_lw_place")
    cells = dealt.groupBy("_lw_place", order_col).agg(*[F.sum(c).cast("long").alias(c) for c in sorted({left, *rights})])
    inside = Window.partitionBy("_lw_place").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    seen = cells.withColumn("_lw_seen", F.coalesce(F.sum(left).over(inside), F.lit(0)).cast(dec))
    states = seen.groupBy("_lw_place").agg(
        F.sum(left).cast(dec).alias("_lw_left"),
        *[F.sum(F.col(r).cast(dec)).cast(dec).alias(f"_lw_r_{r}") for r in rights],
        *[F.sum(F.col(r).cast(dec) * F.col("_lw_seen")).cast(dec).alias(f"_lw_p_{r}") for r in rights],
    )
    group = [F.col("_lw_place")[k] for k in keys]
    before = Window.partitionBy(*group).orderBy(F.col("_lw_place")["_lw_range"]).rowsBetween(Window.unboundedPreceding, -1)
    placed = states.withColumn("_lw_off", F.coalesce(F.sum("_lw_left").over(before), F.lit(0)).cast(dec))
    whole = {r: F.col(f"_lw_p_{r}") + F.col("_lw_off") * F.col(f"_lw_r_{r}") for r in rights}
    out = placed.groupBy(*[g.alias(k) for g, k in zip(group, keys)])
    return out.agg(*[F.sum(whole[r]).cast(dec).alias(name) for name, r in products.items()])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value_cols: Sequence[str],
    *,
    descending: bool = False,
    buckets: int | None = None,
    prefix: str = "cum_",
    totals_prefix: str | None = None,
    held: bool = False,
) -> DataFrame:
    """Add ``cum_<v>``: inclusive running sum of each ``v`` ordered by ``order_col`` within ``keys``
    (and, with ``totals_prefix``, the group total ``<totals_prefix><v>``).

    Rows should be unique per (keys, order_col) - histogram rows (ties are summed in an arbitrary
    order). One algorithm for every size: the rows are stored once (unless ``held``: they are a stored table) and cut
    into ranges of the order column, ``buckets`` at most, so a group of any size is spread by its values; see
    :func:`running`. Text and other types that have no percentiles are range-partitioned by Spark instead.
    """
    keys = list(keys)
    drop_all = not keys
    if drop_all:
        df, keys = with_group_key(df, keys)
    if order_proxy(df, order_col) is None:
        out = _ranged_totals(df, keys, order_col, list(value_cols), descending, buckets, prefix, totals_prefix)
    else:
        rows = df if held else stored(df, "running")
        (bounds,) = range_bounds(rows, [order_col], buckets)
        out = running(rows, keys, order_col, value_cols, bounds, descending=descending, prefix=prefix, totals_prefix=totals_prefix)
    return out.drop(ALL_KEY) if drop_all else out


def _ranged_totals(df, keys, order_col, value_cols, descending, buckets, prefix, totals_prefix) -> DataFrame:
    """Running totals over Spark's own range partitions, stored once with their numbers."""
    columns = df.columns
    ordered = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = df.repartitionByRange(*([buckets] if buckets else []), *keys, ordered)
    df = stored(ranged.withColumn("_lw_bucket", F.spark_partition_id()), "running")

    part = [*keys, "_lw_bucket"]
    per_bucket = df.groupBy(*part).agg(*[F.sum(v).alias(f"_lw_bt_{v}") for v in value_cols])
    before = Window.partitionBy(*keys).orderBy("_lw_bucket").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *part,
        *[F.coalesce(F.sum(f"_lw_bt_{v}").over(before), F.lit(0)).alias(f"_lw_off_{v}") for v in value_cols],
        *([F.sum(f"_lw_bt_{v}").over(group).alias(f"_lw_gt_{v}") for v in value_cols] if totals_prefix else []),
    )
    inside = Window.partitionBy(*part).orderBy(ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = df.select("*", *[F.sum(v).over(inside).alias(f"_lw_in_{v}") for v in value_cols])
    return join_keys(inner, offsets, part).select(
        *columns,
        *[(F.col(f"_lw_in_{v}") + F.col(f"_lw_off_{v}")).alias(prefix + v) for v in value_cols],
        *([F.col(f"_lw_gt_{v}").alias(totals_prefix + v) for v in value_cols] if totals_prefix else []),
    )


def numpy_linspace(n_bins: int) -> list[float]:
    """Literal bin edges exactly as numpy produces them (0.30000000000000004 and all)."""
    return [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    probs: Sequence[float],
    *,
    out: str = "quantiles",
    buckets: int | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy/pandas default) per group: ``keys, n, <out>``.

    No value list is kept per group: the column is histogrammed, ranks come from running totals,
    and only the rows holding the needed ranks (two per probability) reach the final aggregate.
    """
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    hist = df.where(F.col(col).isNotNull()).groupBy(*gkeys, F.col(col).cast("double").alias("_lw_v")).agg(
        F.count(F.lit(1)).alias("_lw_n")
    )
    run = running_totals(hist, gkeys, "_lw_v", ["_lw_n"], buckets=buckets, totals_prefix="tot_")
    res = quantiles_from_running(run, gkeys, "_lw_v", "_lw_n", "cum__lw_n", "tot__lw_n", probs, out)
    return res if keys else res.drop(ALL_KEY)


def rank_hits(probs: Sequence[float], value: Column, count: Column, cum: Column, total: Column) -> Column:
    """A struct for histogram rows that hold a rank which one of the (sorted) probabilities needs, NULL for others: at most
    two rows per probability and group, so ``collect_list`` of it is small."""
    n1 = (total - 1).cast("double")
    start, end = cum - count, cum - 1
    # ranks grow with p, so the probabilities whose lo/hi rank falls in [start, end] form a range;
    # find its ends by binary search over the (sorted) rank arrays - compact generated code
    first = sorted_position(F.array(*[F.ceil(n1 * p) for p in probs]), start, len(probs))
    last = sorted_position(F.array(*[F.floor(n1 * p) for p in probs]), end + 1, len(probs)) - 1
    return F.when(first <= last, F.struct(value.alias("value"), start.alias("start"), end.alias("end")))


def rank_values(probs: Sequence[float], total: Column, hits: Column) -> Column:
    """Array of ``struct(low, high, value)`` per (sorted) probability: the hits that hold the order statistics around its
    rank, and the interpolated value, from the collected :func:`rank_hits`. Interpolation follows numpy's two-sided lerp,
    so it equals pandas' to the last bit."""
    n1 = (total - 1).cast("double")
    holding = lambda rank: F.get(F.filter(hits, lambda e: (e["start"] <= rank) & (rank <= e["end"])), F.lit(0))
    ranks = F.transform(F.array(*[F.lit(p) for p in probs]), lambda p: F.struct((n1 * p).alias("at"), F.floor(n1 * p).alias("lo"), F.ceil(n1 * p).alias("hi")))
    around = F.transform(ranks, lambda r: F.struct(holding(r["lo"]).alias("low"), holding(r["hi"]).alias("high"), (r["at"] - r["lo"]).alias("t")))

    def lerp(x: Column) -> Column:
        a, b, t = x["low"]["value"], x["high"]["value"], x["t"]
        return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t))

    return F.transform(around, lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"), lerp(x).alias("value")))


def quantiles_from_running(
    run: DataFrame,
    keys: Sequence[str],
    value: str,
    count: str,
    cum: str,
    total: str,
    probs: Sequence[float],
    out: str = "quantiles",
) -> DataFrame:
    """Quantiles from histogram rows that carry running and total counts: ``keys, n, <out>``.

    One aggregate gathers the few rows that hold a needed rank; see :func:`rank_values`.
    """
    keys = list(keys)
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    sp = [float(probs[i]) for i in order]
    hit = rank_hits(sp, F.col(value).cast("double"), F.col(count), F.col(cum), F.col(total))
    per = run.groupBy(*keys).agg(F.first(total).alias("n"), F.collect_list(hit).alias("_lw_e"))

    values = per.select(*keys, "n", rank_values(sp, F.col("n"), F.col("_lw_e")).alias("_lw_v"))
    # back to the caller's order of probabilities
    sorted_pos = {orig: j for j, orig in enumerate(order)}
    return values.select(*keys, "n", F.array(*[F.get("_lw_v", F.lit(sorted_pos[i]))["value"] for i in range(len(sp))]).alias(out))
