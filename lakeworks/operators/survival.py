"""Survival evaluation: censoring-aware MAE, concordance index, Kaplan-Meier curve and median.

All of it is read from one stored table of distinct ``(time, event, prediction)`` with counts.

Concordance never forms subject pairs, nor copies subjects per level of a tree: it counts dominance on two levels. A
group beyond ``STRIP_ROWS`` distinct subjects is cut into strips of time and strips of prediction (its quantiles, each
quantile value a strip of its own). A comparable pair, a death and a later subject, lies in

* different strips both ways: counted on the grid of strip counts by two-dimensional prefix sums;
* one strip of predictions: counted exactly inside that strip, which holds about ``STRIP_ROWS`` subjects;
* one strip of times but different strips of predictions: counted inside the time strip, where only the strip of a
  prediction matters, so that subjects of equal time, event and strip are one row.

A strip of a single value may be of any size, and needs less: equal predictions only tie, which running sums over time
count, and at one time only deaths meet the censored. Each distinct subject is thus shuffled once to its prediction
strip, at most once to its time strip, and as part of a grid cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.operators.common import (
    ALL_KEY,
    DEFAULT_BUCKETS,
    join_keys,
    ordered_products,
    quantiles_from_running,
    range_bounds,
    running,
    with_group_key,
)
from lakeworks.operators.classification import resolve_groups, round_doubles
from lakeworks.session import stored

_DEC = "decimal(38,0)"
#: distinct subjects of a strip, about, and strips that a group is cut into at most in either direction
STRIP_ROWS, MAX_STRIPS = 50_000, 1_000
#: the product limit reaches one half exactly at places where its log form ends a rounding error above
_HALF_SLACK = 1e-9


def _event(col: str) -> Column:
    return F.col(col).cast("int")


def survival_mae(df: DataFrame, time: str, event: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Events |t - p|; censored and predicted early t - p; otherwise 0; mean over all rows."""
    t, e, p = F.col(time).cast("double"), _event(event), F.col(pred).cast("double")
    err = F.when(e == 1, F.abs(t - p)).when((e == 0) & (p < t), t - p).otherwise(F.lit(0.0))
    return df.groupBy(*keys).agg(F.avg(err).alias("mae"))


def subjects(df: DataFrame, time: str, event: str, pred: str | None, gkeys: list[str]) -> DataFrame:
    """Distinct ``(keys, _t, _e, _p)`` with multiplicity ``_m``, NULLs too: the one pass over the rows."""
    p = F.col(pred).cast("double") if pred else F.lit(None).cast("double")
    base = df.select(*gkeys, F.col(time).alias("_t"), _event(event).alias("_e"), p.alias("_p"))
    return base.groupBy(*gkeys, "_t", "_e", "_p").agg(F.count(F.lit(1)).alias("_m"))


def _complete(comp: DataFrame) -> DataFrame:
    return comp.where("_t IS NOT NULL AND _e IS NOT NULL AND _p IS NOT NULL")


def _per_time(comp: DataFrame, gkeys: list[str]) -> DataFrame:
    """``time, removed, deaths`` per distinct time."""
    return comp.groupBy(*gkeys, F.col("_t").alias("time")).agg(
        F.sum("_m").alias("removed"),
        F.sum(F.when(F.col("_e") == 1, F.col("_m")).otherwise(F.lit(0))).cast("long").alias("deaths"),
    )


def dominance(slot: np.ndarray, value: np.ndarray, deaths: np.ndarray, weight: np.ndarray) -> tuple[int, int]:
    """Over pairs of a death and a subject of a later slot: the pairs of ``deaths x weight`` with a smaller, and with an
    equal value. Bit by bit of the slot: a pair meets where the slots first differ, the earlier one on the left."""
    less = equal = 0
    by_value = np.argsort(value, kind="stable")
    slot, value, deaths, weight = slot[by_value], value[by_value], deaths[by_value], weight[by_value]
    exact = int(deaths.sum()) * int(weight.sum()) >= 1 << 62
    for level in range(int(slot.max()).bit_length() if len(slot) else 0):
        block = slot >> (level + 1)
        order = np.argsort(block, kind="stable")  # by block, and by value in it
        b, v, right = block[order], value[order], (slot[order] >> level) & 1
        d, w = np.where(right == 0, deaths[order], 0), np.where(right == 1, weight[order], 0)
        before = np.cumsum(d) - d
        new_block = np.r_[True, b[1:] != b[:-1]]
        new_run = new_block | np.r_[True, v[1:] != v[:-1]]
        run = np.cumsum(new_run) - 1
        first = np.flatnonzero(new_run)
        block_first = np.flatnonzero(new_block)[np.cumsum(new_block) - 1]
        smaller = before[first][run] - before[block_first]
        tied = np.add.reduceat(d, first)[run]
        if exact:  # counts beyond a long
            smaller, tied, w = smaller.astype(object), tied.astype(object), w.astype(object)
        less += int((smaller * w).sum())
        equal += int((tied * w).sum())
    return less, equal


def _strip_counts(gkeys: list[str]):
    """Counts of one strip, for ``applyInArrow``: columns ``_t, _c`` (order), ``_v`` (value), ``_d, _m``."""

    def count(table: pa.Table) -> pa.Table:
        get = lambda c: table.column(c).to_numpy()
        _, slot = np.unique(np.stack([get("_t"), get("_c").astype(float)]), axis=1, return_inverse=True)
        _, value = np.unique(get("_v"), return_inverse=True)
        less, equal = dominance(slot.reshape(-1), value, get("_d"), get("_m"))
        return _count_rows(table, gkeys, less, equal)

    return count


def _count_rows(table: pa.Table, gkeys: list[str], less: int, equal: int) -> pa.Table:
    kind = pa.decimal128(38, 0)
    counts = [pa.array([Decimal(x)], kind) for x in (less, equal)]
    return pa.table([*(table.column(k).slice(0, 1) for k in gkeys), *counts], names=[*gkeys, "concordant", "tied"])


def _grid_counts(gkeys: list[str]):
    """Pairs of different strips both ways, from the cells ``_a, _b, _d, _m`` of one group."""

    def count(table: pa.Table) -> pa.Table:
        a, b, d, m = (table.column(c).to_numpy() for c in ("_a", "_b", "_d", "_m"))
        grid = np.zeros((int(a.max()) + 2, int(b.max()) + 2), np.int64)
        np.add.at(grid, (a + 1, b + 1), d)
        before = grid.cumsum(axis=0).cumsum(axis=1)[a, b]  # deaths of smaller strips both ways
        if int(before.max(initial=0)) * int(m.sum()) >= 1 << 62:
            before = before.astype(object)
        return _count_rows(table, gkeys, int((before * m).sum()), 0)

    return count


def strip_of(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Strips of values: odd for the values of ``bounds`` (sorted), even for what lies between them; NaN is the largest."""
    found = np.searchsorted(bounds, x)
    at = bounds[np.minimum(found, len(bounds) - 1)]
    return 2 * found + ((at == x) | (np.isnan(at) & np.isnan(x)))


def _placed(rows: DataFrame, edges: DataFrame, gkeys: list[str]) -> DataFrame:
    """``rows`` with the strips ``_a, _b`` of their time and prediction, and ``_cut``: false, and strips 0, for a group
    without ``edges``. The bounds are in the tasks' closure: two numbers per strip, of about ``STRIP_ROWS`` subjects."""
    cuts = {r["_g"]: (np.array(r["_qt"]), np.array(r["_qp"])) for r in edges.select("_g", "_qt", "_qp").collect()}
    known = join_keys(rows, edges.select(*gkeys, "_g"), gkeys, "left").select(*rows.columns, "_g")
    n = len(rows.columns)

    def place(batches):
        for batch in batches:
            group = batch.column(n).fill_null(-1).to_numpy(zero_copy_only=False)
            t, p = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_t", "_p"))
            a, b = np.zeros(len(t), np.int32), np.zeros(len(t), np.int32)
            for g in np.unique(group[group >= 0]):
                at = group == g
                a[at], b[at] = strip_of(t[at], cuts[g][0]), strip_of(p[at], cuts[g][1])
            more = [pa.array(a), pa.array(b), pa.array(group >= 0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *more], names=[*batch.schema.names[:n], "_a", "_b", "_cut"])

    more = [T.StructField("_a", T.IntegerType()), T.StructField("_b", T.IntegerType()), T.StructField("_cut", T.BooleanType())]
    return known.mapInArrow(place, T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema), *more]))


def _time_products(rows: DataFrame, gkeys: list[str], bounds: Sequence[float], out: str) -> DataFrame:
    """``keys, <out>``: pairs of a death and a subject of a later time, or a censored one of its own time; products of
    running sums over the times, so nothing but a row per distinct time is shuffled."""
    per_t = rows.groupBy(*gkeys, "_t").agg(F.sum("_d").alias("_d"), F.sum("_m").alias("_m"))
    later = ordered_products(per_t, gkeys, "_t", "_d", {"_later": "_m"}, bounds)
    here = F.col("_d").cast(_DEC) * (F.col("_m") - F.col("_d")).cast(_DEC)
    same = per_t.groupBy(*gkeys).agg(F.sum(here).cast(_DEC).alias("_same"))
    return join_keys(later, same, gkeys).select(*gkeys, (F.col("_later") + F.col("_same")).cast(_DEC).alias(out))


def concordance_counts(comp: DataFrame, gkeys: list[str], buckets: int | None = None, strip_rows: int | None = None) -> DataFrame:
    """``keys, pairs, concordant, tied, c_index`` from the stored subjects ``keys, _t, _e, _p, _m``."""
    rows = _complete(comp).select(
        *gkeys,
        F.col("_t").cast("double").alias("_t"),
        F.when(F.col("_e") == 1, 0).otherwise(1).alias("_c"),
        F.col("_p").alias("_p"),
        F.when(F.col("_e") == 1, F.col("_m")).otherwise(F.lit(0)).cast("long").alias("_d"),
        F.col("_m").cast("long").alias("_m"),
    )
    size = strip_rows or STRIP_ROWS
    # one row per group beyond a strip: as many as strips, so they are few, and their bounds a bounded share of the rows
    sizes = rows.groupBy(*gkeys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    large = not sizes.isEmpty()
    (bounds,) = range_bounds(rows, ["_t"], buckets)
    pairs = _time_products(rows, gkeys, bounds, "pairs")

    out_schema = T.StructType(
        [*(rows.schema[k] for k in gkeys), T.StructField("concordant", T.DecimalType(38, 0)), T.StructField("tied", T.DecimalType(38, 0))]
    )
    inside = _strip_counts(gkeys)
    parts = []
    if large:
        n = F.least(F.lit(MAX_STRIPS), F.ceil(F.col("_n") / size)).cast("int")
        known = join_keys(rows, sizes.select(*gkeys, n.alias("_strips")), gkeys, "left")
        cuts = []
        for c in ("_t", "_p"):
            # quantiles of MAX_STRIPS shares per large group, thinned out to the group's number of strips
            q = F.percentile_approx(c, F.array(*[F.lit(i / MAX_STRIPS) for i in range(1, MAX_STRIPS)]), F.lit(10 * MAX_STRIPS))
            cuts.append(q.alias(f"_q{c}"))
        wide = known.where("_strips IS NOT NULL").groupBy(*gkeys).agg(F.first("_strips").alias("_strips"), *cuts)
        thin = lambda q: F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("_strips") - 1), lambda i: F.get(q, F.floor(i * MAX_STRIPS / F.col("_strips")).cast("int") - 1)
            )
        )
        wide = wide.select(*gkeys, thin(F.col("_q_t")).alias("_qt"), thin(F.col("_q_p")).alias("_qp"))
        edges = stored(wide.withColumn("_g", F.monotonically_increasing_id()), "strips")
        # searched once per subject, and read by each of the counts
        placed = stored(_placed(rows, edges, gkeys), "placed")
        cells = placed.where("_cut").groupBy(*gkeys, "_a", "_b").agg(F.sum("_d").alias("_d"), F.sum("_m").alias("_m"))
        parts.append(cells.groupBy(*gkeys).applyInArrow(_grid_counts(gkeys), out_schema))
        # one strip of times, different strips of predictions
        coarse = placed.where("_cut").groupBy(*gkeys, "_a", "_t", "_c", "_b").agg(F.sum("_d").alias("_d"), F.sum("_m").alias("_m"))
        coarse = coarse.withColumn("_v", F.col("_b").cast("double"))
        parts.append(
            coarse.groupBy(*gkeys, "_a").applyInArrow(inside, out_schema).withColumn("tied", F.lit(0).cast(_DEC))
        )
        # strips of a single prediction: ties only
        ties = _time_products(placed.where("_b % 2 = 1"), [*gkeys, "_b"], bounds, "tied")
        parts.append(ties.select(*gkeys, F.lit(0).cast(_DEC).alias("concordant"), "tied"))
        exact = placed.where("_b % 2 = 0")
    else:
        exact = rows.withColumn("_b", F.lit(0))
    parts.append(exact.withColumn("_v", F.col("_p")).groupBy(*gkeys, "_b").applyInArrow(inside, out_schema))
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    counted = counted.groupBy(*gkeys).agg(*[F.sum(c).cast(_DEC).alias(c) for c in ("concordant", "tied")])
    counts = ("pairs", "concordant", "tied")
    out = join_keys(pairs, counted, gkeys, "left")
    out = out.select(*gkeys, *[F.coalesce(F.col(c), F.lit(0).cast(_DEC)).alias(c) for c in counts])
    index = (F.col("concordant").cast("double") + F.col("tied").cast("double") / 2) / F.col("pairs").cast("double")
    # the index comes from the exact decimal counts; a count beyond BIGINT is shown as NULL
    return out.select(
        *gkeys, *[F.col(c).try_cast("long").alias(c) for c in counts], F.when(F.col("pairs") > 0, index).alias("c_index")
    )


def concordance(
    df: DataFrame,
    time: str,
    event: str,
    pred: str,
    keys: Sequence[str] = (),
    buckets: int | None = DEFAULT_BUCKETS,
    strip_rows: int | None = None,
) -> DataFrame:
    """``keys, pairs, concordant, tied, c_index`` (c = (concordant + tied / 2) / pairs).

    A pair is comparable when the earlier time is an event, or the times tie and only one of the
    two is an event (that one counts as earlier); it is concordant when the earlier subject has
    the lower prediction. No comparable pair -> NULL c_index.
    """
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    comp = stored(subjects(df, time, event, pred, gkeys), "subjects")
    out = concordance_counts(comp, gkeys, buckets, strip_rows)
    return out if keys else out.drop(ALL_KEY)


def _km(per_t: DataFrame, gkeys: list[str], bounds: Sequence[float]) -> DataFrame:
    """The curve from ``time, removed, deaths``; both running sums use the same ranges of time."""
    run = running(per_t, gkeys, "time", ["removed"], bounds, totals_prefix="tot_")
    at_risk = F.col("tot_removed") - F.col("cum_removed") + F.col("removed")
    with_risk = run.select(*gkeys, "time", "removed", "deaths", at_risk.alias("at_risk"))
    term = F.when(F.col("at_risk") == F.col("deaths"), F.lit(float("-inf"))).otherwise(
        F.log(F.col("at_risk") - F.col("deaths")) - F.log(F.col("at_risk"))
    )
    with_term = with_risk.withColumn("_lt", F.when(F.col("deaths") > 0, term).otherwise(F.lit(0.0)))
    curve = running(with_term, gkeys, "time", ["_lt"], bounds)
    return curve.select(*gkeys, "time", "at_risk", "deaths", "removed", F.exp("cum__lt").alias("survival"))


def km_curve(
    df: DataFrame, time: str, event: str, keys: Sequence[str] = (), buckets: int | None = DEFAULT_BUCKETS
) -> DataFrame:
    """E18 curve: ``keys, time, at_risk, deaths, removed, survival`` per distinct time.

    ``survival = exp(sum(log(at_risk - deaths) - log(at_risk)))`` accumulated in time order - the
    product-limit estimate in the same log form the usual estimator uses.
    """
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    known = F.col(time).isNotNull() & _event(event).isNotNull()
    counts = df.where(known).groupBy(*gkeys, F.col(time).alias("time")).agg(
        F.count(F.lit(1)).alias("removed"), F.sum(_event(event)).cast("long").alias("deaths")
    )
    per_t = stored(counts, "times")
    (bounds,) = range_bounds(per_t, ["time"], buckets)
    out = _km(per_t, gkeys, bounds)
    return out if keys else out.drop(ALL_KEY)


def _median_of_curve(curve: DataFrame, gkeys: list[str]) -> DataFrame:
    return curve.groupBy(*gkeys).agg(
        F.coalesce(
            F.min(F.when(F.col("survival") <= 0.5 + _HALF_SLACK, F.col("time").cast("double"))), F.lit(float("inf"))
        ).alias("km_median")
    )


def km_median(
    df: DataFrame, time: str, event: str, keys: Sequence[str] = (), buckets: int | None = DEFAULT_BUCKETS
) -> DataFrame:
    """E18 median: smallest time with survival <= 0.5 (up to rounding), else +infinity."""
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    out = _median_of_curve(km_curve(df, time, event, gkeys, buckets=buckets), gkeys)
    return out if keys else out.drop(ALL_KEY)


def survival_report(
    data: DataFrame,
    time_col: str,
    event_col: str,
    pred_col: str,
    grouping_cols: Sequence[str] | None = None,
    test_size_minimum_per_group: int = 50,
    *,
    round_digits: int | None = 3,
    keep_null_groups: bool = False,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """Per group with more than the minimum rows: n, mean/median time, KM median, event rate,
    mean/median prediction, MAE and c-index; doubles rounded half-even."""
    df, keys = resolve_groups(data, grouping_cols)
    if not keep_null_groups:
        df = df.dropna(subset=keys)
    # one pass over the rows; statistics run on all groups (the join with ``base`` drops small ones)
    comp = stored(subjects(df, time_col, event_col, pred_col, keys), "subjects")
    t, e, p, m = F.col("_t").cast("double"), F.col("_e"), F.col("_p"), F.col("_m")
    err = F.when(e == 1, F.abs(t - p)).when((e == 0) & (p < t), t - p).otherwise(F.lit(0.0))
    mean = lambda x: F.try_divide(F.sum(x * m), F.sum(F.when(x.isNotNull(), m)))
    base = comp.groupBy(*keys).agg(
        F.sum(m).alias("n_observations"),
        mean(t).alias("avg_months"),
        mean(e).alias("event_rate"),
        mean(p).alias("avg_predicted_months"),
        mean(err).alias("mae"),
    ).where(F.col("n_observations") > test_size_minimum_per_group)
    known = _complete(comp)
    by_t, by_p = range_bounds(known, ["_t", "_p"], buckets)
    per_t = _per_time(known, keys)
    run = running(per_t, keys, "time", ["removed"], by_t, totals_prefix="tot_")
    med_t = quantiles_from_running(run, keys, "time", "removed", "cum_removed", "tot_removed", [0.5], out="_mt")
    km = _median_of_curve(_km(per_t, keys, by_t), keys)
    ci = concordance_counts(comp, keys, buckets)
    pred_hist = known.groupBy(*keys, "_p").agg(F.sum("_m").alias("_pn"))
    pred_run = running(pred_hist, keys, "_p", ["_pn"], by_p, totals_prefix="tot_")
    med_p = quantiles_from_running(pred_run, keys, "_p", "_pn", "cum__pn", "tot__pn", [0.5], out="_mp")
    full = join_keys(base, med_t.select(*keys, F.col("_mt")[0].alias("median_months")), keys, "left")
    full = join_keys(full, km.select(*keys, F.col("km_median").alias("km_median_surv_months")), keys, "left")
    full = join_keys(full, med_p.select(*keys, F.col("_mp")[0].alias("median_predicted_months")), keys, "left")
    full = join_keys(full, ci.select(*keys, "c_index"), keys, "left")
    out = full.select(
        *keys,
        "n_observations",
        "avg_months",
        "median_months",
        "km_median_surv_months",
        "event_rate",
        "avg_predicted_months",
        "median_predicted_months",
        "mae",
        "c_index",
    )
    return round_doubles(out, round_digits)
