"""Grouped binary-classification evaluation (confusion, curve areas, calibration, deciles, report).

Every metric is a grouped aggregation over the data or over the **score histogram**
``(keys, score) -> n, pos, neg``, never a per-group Python loop. Curve areas read one ascending
running total of (pos, neg) per group: for a score ``s`` the positives above it are
``P - cum_pos``, so ROC and PR points need no ``lag`` across ranges. The reports read the rows once, into a stored
histogram per (score, outcome, prediction), and everything else, quantile bins included, from that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.common import (
    ALL_KEY,
    DEFAULT_BUCKETS,
    exact_quantiles,
    join_keys,
    numpy_linspace,
    quantiles_from_running,
    range_bounds,
    rank_hits,
    rank_values,
    running,
    running_totals,
    safe_corr,
    sorted_position,
    with_group_key,
)
from lakeworks.session import stored

FAKE_GROUP = "fake_group"


def _y(target: str) -> Column:
    return F.col(target).cast("int")


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _zero_div(a: Column, b: Column) -> Column:
    """a / b, or 0.0 when b is 0 (scikit-learn's ``zero_division=0``)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(_div(a, b))


def score_histogram(df: DataFrame, keys: Sequence[str], target: str, score: str) -> DataFrame:
    """``keys, score, n, pos, neg``: one row per distinct score per group (map-side combined)."""
    y = _y(target)
    return (
        df.where(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(y).cast("long").alias("pos"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )


# ---------------------------------------------------------------- E1-E4, E7: one-pass aggregates


def confusion(df: DataFrame, target: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, n, tp, tn, fp, fn`` and the ``*_perc`` shares of n (x100)."""
    y, p = _y(target), F.col(pred).cast("int")
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    return agg.select(
        "*", *[(_div(F.col(c), F.col("n")) * 100).alias(f"{c}_perc") for c in ("tp", "tn", "fp", "fn")]
    )


def confusion_metrics(tp: Column, tn: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """E2-E4 from confusion counts. MCC in DOUBLE (the long product overflows), 0.0 when undefined."""
    tp, tn, fp, fn = (c.cast("double") for c in (tp, tn, fp, fn))
    recall1 = _zero_div(tp, tp + fn)
    recall0 = _zero_div(tn, tn + fp)
    denom = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "balanced_accuracy": (recall0 + recall1) / 2,
        "mcc": F.when(denom == 0, F.lit(0.0)).otherwise((tp * tn - fp * fn) / denom),
        "precision": _zero_div(tp, tp + fp),
        "recall": recall1,
        "f1": _zero_div(2 * tp, 2 * tp + fp + fn),
    }


def brier(df: DataFrame, target: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared difference between probability and outcome."""
    return df.groupBy(*keys).agg(F.avg(F.pow(F.col(prob) - _y(target), 2)).alias("brier_score"))


# ---------------------------------------------------------------- E5, E6: curve areas


def curve_areas(hist: DataFrame, keys: Sequence[str] = (), buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """E5 ROC AUC (ties 1/2) and E6 PR AUC (trapezoid over recall with the (0, 1) anchor).

    Input: ``score_histogram`` rows. Output: ``keys, n_pos, n_neg, roc_auc, pr_auc``.
    """
    hist, gkeys = with_group_key(hist, keys)
    run = running_totals(hist, gkeys, "score", ["n", "pos", "neg"], buckets=buckets, totals_prefix="tot_")
    out = run.groupBy(*gkeys).agg(*area_sums()).select(*gkeys, "n_pos", "n_neg", *areas())
    return out if keys else out.drop(ALL_KEY)


def area_sums() -> list[Column]:
    """Aggregates over running histogram rows that :func:`areas` needs."""
    P, N = F.col("tot_pos").cast("double"), F.col("tot_neg").cast("double")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below_neg = F.col("cum_neg").cast("double") - neg
    tp_prev = P - F.col("cum_pos").cast("double")
    fp_prev = N - F.col("cum_neg").cast("double")
    tp, fp = tp_prev + pos, fp_prev + neg
    prec = tp / (tp + fp)
    prec_prev = F.when(tp_prev + fp_prev == 0, F.lit(1.0)).otherwise(tp_prev / (tp_prev + fp_prev))
    return [
        F.first("tot_pos").alias("n_pos"),
        F.first("tot_neg").alias("n_neg"),
        F.sum(pos * below_neg + 0.5 * pos * neg).alias("_roc"),
        F.sum(F.when(pos > 0, pos * (prec + prec_prev) / 2).otherwise(F.lit(0.0))).alias("_pr"),
    ]


def areas() -> list[Column]:
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return [
        F.when(both, F.col("_roc") / (F.col("n_pos") * F.col("n_neg").cast("double"))).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("_pr") / F.col("n_pos")).alias("pr_auc"),
    ]


def outcome_histogram(df: DataFrame, keys: Sequence[str], target: str, pred: str, score: str) -> DataFrame:
    """``keys, score, y, p, n``: rows per distinct score, outcome and prediction (NULLs too). All metrics are read from
    it, so the rows themselves are read once."""
    cells = [F.col(score).cast("double").alias("score"), _y(target).alias("y"), F.col(pred).cast("int").alias("p")]
    return df.groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("n"))


def base_sums(centre: float) -> list[Column]:
    """Aggregates over an outcome histogram: counts, confusion counts, mean, deviation and Brier score of the rows."""
    y, p, s, n = F.col("y"), F.col("p"), F.col("score"), F.col("n")
    scored = F.sum(F.when(s.isNotNull(), n))
    off = s - F.lit(centre)  # near the mean, so that the squares lose nothing
    spread = F.try_divide(F.sum(n * off * off), scored) - F.pow(F.try_divide(F.sum(n * off), scored), 2)
    cell = lambda a, b: F.coalesce(F.sum(F.when((y == a) & (p == b), n)), F.lit(0)).alias
    return [
        F.sum(n).alias("n_observations"),
        F.try_divide(F.sum(n * y), F.sum(F.when(y.isNotNull(), n))).alias("target_rate"),
        F.try_divide(F.sum(n * s), scored).alias("score_average"),
        F.when(F.min(s) == F.max(s), F.lit(0.0)).otherwise(F.sqrt(F.greatest(F.lit(0.0), spread))).alias("score_std"),
        cell(1, 1)("tp"),
        cell(0, 0)("tn"),
        cell(0, 1)("fp"),
        cell(1, 0)("fn"),
        F.try_divide(F.sum(n * F.pow(s - y, 2)), F.sum(F.when((s - y).isNotNull(), n))).alias("_brier"),
        # two classes present <=> max != min (no distinct-aggregate expansion)
        (F.max(y) > F.min(y)).cast("int").alias("_two"),
    ]


def scored_cells(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of an outcome histogram that have a score and an outcome, as ``keys, score, n, pos, neg``."""
    rows = hist.where(F.col("score").isNotNull() & F.col("y").isNotNull())
    pos = F.col("n") * F.col("y")
    return rows.select(*keys, "score", "n", pos.alias("pos"), (F.col("n") - pos).alias("neg"))


def scored_run(cells: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """Running histogram over distinct scores: ``score, n, pos, neg``, ``cum_*`` and ``tot_*``."""
    whole = {c: F.sum(c).cast("long") for c in ("n", "pos", "neg")}
    return running(cells, keys, "score", ["n", "pos", "neg"], bounds, totals_prefix="tot_", combine=whole)


# ---------------------------------------------------------------- E8: calibration


def ece(hist: DataFrame, keys: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    """Expected calibration error with ``n_bins`` equal bins ``(lo, hi]`` over [0, 1].

    Literal numpy edges decide membership; a score of exactly 0 falls in no bin but still counts
    in the weights (the share of each bin is over all rows).
    """
    edges = numpy_linspace(n_bins)
    s = F.col("score")
    bin_ix = sorted_position(F.array(*[F.lit(e) for e in edges[:-1]]), s, n_bins) - 1
    in_any = (s > F.lit(edges[0])) & (s <= F.lit(edges[-1]))
    hist, gkeys = with_group_key(hist, keys)
    per_bin = (
        hist.withColumn("_bin", F.when(in_any, bin_ix))
        .groupBy(*gkeys, "_bin")
        .agg(
            F.sum("n").alias("_cnt"),
            F.sum("pos").alias("_pos"),
            F.sum(s * F.col("n")).alias("_conf"),
        )
    )
    # the weight of a bin is its share of *all* rows of the group, bin-less ones included, so the
    # group total is the sum over every per-bin row - one aggregate, no window and no join
    gap = F.abs(F.col("_conf") / F.col("_cnt") - F.col("_pos") / F.col("_cnt")) * F.col("_cnt")
    out = per_bin.groupBy(*gkeys).agg(
        (F.coalesce(F.sum(F.when(F.col("_bin").isNotNull(), gap)), F.lit(0.0)) / F.sum("_cnt")).alias("ece")
    )
    return out if keys else out.drop(ALL_KEY)


# ---------------------------------------------------------------- E9: metric set


def classification_metrics(
    df: DataFrame,
    target: str,
    pred: str,
    prob: str,
    keys: Sequence[str] = (),
    prefix: str | None = None,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """Balanced accuracy, MCC, precision, recall, F1, PR AUC, ROC AUC, Brier, ECE per group."""
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    hist = stored(outcome_histogram(df, gkeys, target, pred, prob), "histogram")
    (bounds,) = range_bounds(hist, ["score"], buckets)
    base = hist.groupBy(*gkeys).agg(*base_sums(0.0))
    m = confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    base = base.select(*gkeys, *[c.alias(k) for k, c in m.items()], F.col("_brier").alias("brier_score"))
    cells = scored_cells(hist, gkeys)
    areas_of = scored_run(cells, gkeys, bounds).groupBy(*gkeys).agg(*area_sums()).select(*gkeys, *areas())
    out = join_keys(join_keys(base, areas_of, gkeys), ece(cells, gkeys), gkeys)
    names = ["balanced_accuracy", "mcc", "precision", "recall", "f1", "pr_auc", "roc_auc", "brier_score", "ece"]
    pre = "" if prefix is None else prefix + "_"
    out = out.select(*gkeys, *[F.col(n).alias(pre + n) for n in names])
    return out if keys else out.drop(ALL_KEY)


# ---------------------------------------------------------------- E10-E12: quantile bins


def decile_edges(df: DataFrame, score: str, keys: Sequence[str] = (), q: int = 10) -> DataFrame:
    """E10 edges: ``keys, edges`` - distinct sorted linear quantiles at ``linspace(0, 1, q + 1)``."""
    qs = exact_quantiles(df, keys, score, numpy_linspace(q), out="_qs")
    return qs.select(*keys, F.array_sort(F.array_distinct("_qs")).alias("edges"))


def bin_of(score: Column, edges: Column, max_edges: int = 11) -> Column:
    """Right-closed bin with the lowest edge included; NULL with fewer than two distinct edges
    or outside the edges (pandas ``qcut(..., labels=False, duplicates="drop")``)."""
    # edges are sorted; positions past the array's end read NULL and never count as below
    ix = F.greatest(F.lit(0), sorted_position(edges, score, max_edges) - 1)
    inside = (score >= F.element_at(edges, 1)) & (score <= F.element_at(edges, -1))
    return F.when((F.size(edges) >= 2) & inside, ix)


def score_deciles(df: DataFrame, score: str, keys: Sequence[str] = (), q: int = 10, out: str = "bin") -> DataFrame:
    """Every row with its quantile bin (0-based)."""
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    edges = stored(decile_edges(df, score, gkeys, q), "edges")  # one row per group; its size is known to the join
    res = join_keys(df, edges, gkeys, "left").withColumn(out, bin_of(F.col(score).cast("double"), F.col("edges"), q + 1))
    res = res.drop("edges")
    return res if keys else res.drop(ALL_KEY)


def decile_rates(df: DataFrame, target: str, score: str, keys: Sequence[str] = (), q: int = 10) -> DataFrame:
    """E11 per-bin table: ``keys, bin, n, target_rate, score_mean`` (non-empty bins only).

    Works on the score histogram, so the row-level data is shuffled once.
    """
    keys = list(keys)
    df, gkeys = with_group_key(df, keys)
    hist = score_histogram(df, gkeys, target, score)
    hist = stored(hist, "histogram")
    run = running_totals(hist, gkeys, "score", ["n"], totals_prefix="tot_", held=True)
    qs = quantiles_from_running(run, gkeys, "score", "n", "cum_n", "tot_n", numpy_linspace(q), out="_qs")
    edges = stored(qs.select(*gkeys, F.array_sort(F.array_distinct("_qs")).alias("edges")), "edges")
    binned = join_keys(hist, edges, gkeys).withColumn("bin", bin_of(F.col("score"), F.col("edges"), q + 1))
    res = (
        binned.where(F.col("bin").isNotNull())
        .groupBy(*gkeys, "bin")
        .agg(
            F.sum("n").alias("n"),
            (F.sum("pos") / F.sum("n")).alias("target_rate"),
            (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score_mean"),
        )
    )
    return res if keys else res.drop(ALL_KEY)


def _array_corr(arr: Column, fx, fy) -> Column:
    """Pearson correlation over a small array of structs (two-pass, centred, so a constant side
    gives exactly zero variance -> NULL)."""
    n = F.size(arr).cast("double")
    mx = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + fx(e)) / n
    my = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + fy(e)) / n
    sxy = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + (fx(e) - mx) * (fy(e) - my))
    sxx = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + (fx(e) - mx) * (fx(e) - mx))
    syy = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + (fy(e) - my) * (fy(e) - my))
    return F.when((sxx > 0) & (syy > 0), sxy / F.sqrt(sxx * syy))


def decile_summary(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """E11/E12 per group: top-3 bin rates (highest bin first), bin count, Spearman and Pearson
    correlation of bin vs target rate (only with more than 4 bins, else NULL).

    A group has at most ``q`` bins, so its bins are gathered into one small array and ranked
    there (average ranks for tied rates) - one aggregate instead of window shuffles.
    """
    keys = list(keys)
    per = rates.groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("bin").cast("double").alias("b"), F.col("target_rate").alias("r"))),
            asc=False,
        ).alias("_bins")
    )
    return per.select(*keys, *bin_summary(F.col("_bins")))


def bin_summary(arr: Column) -> list[Column]:
    """The columns of :func:`decile_summary` from an array of ``(b, r)``: bin and its target rate, highest bin first."""
    ranked = F.transform(
        arr,
        lambda x: F.struct(
            (F.size(F.filter(arr, lambda y: y["b"] < x["b"])) + 1).cast("double").alias("rb"),
            (
                F.size(F.filter(arr, lambda y: y["r"] < x["r"]))
                + (F.size(F.filter(arr, lambda y: y["r"] == x["r"])) + 1) / 2.0
            ).alias("rr"),
        ),
    )
    many = F.size(arr) > 4
    return [
        F.size(arr).cast("long").alias("number_deciles"),
        F.when(many, _array_corr(ranked, lambda e: e["rb"], lambda e: e["rr"])).alias("rank_correlation"),
        F.when(many, _array_corr(arr, lambda e: e["b"], lambda e: e["r"])).alias("target_bin_correlation"),
        F.get(arr, 0)["r"].alias("first_decile_target_rate"),
        F.get(arr, 1)["r"].alias("second_decile_target_rate"),
        F.get(arr, 2)["r"].alias("third_decile_target_rate"),
    ]


def quantile_cuts(hits: Column, total: Column, probs: Sequence[float]) -> Column:
    """The distinct quantile edges of a group as a sorted array of ``(edge, n, pos)``, the counts up to the edge, from its
    collected rank hits with running counts ``n`` and ``pos``: those up to the order statistic at or below the edge."""

    def cut(x: Column) -> Column:
        below = F.when(x["value"] >= x["high"]["value"], x["high"]).otherwise(x["low"])
        return F.struct(x["value"].alias("edge"), below["n"].alias("n"), below["pos"].alias("pos"))

    return F.array_sort(F.array_distinct(F.transform(rank_values(probs, total, hits), cut)))


def cut_bins(cuts: Column) -> Column:
    """The non-empty quantile bins as an array of ``(b, r)``, bin and target rate, highest bin first: a bin's rows are
    those between its edges, so no row needs to be joined with the edges. The lowest edge belongs to the first bin."""

    def bin_at(i: Column) -> Column:
        top, bottom = F.get(cuts, i + 1), F.get(cuts, i)
        less = lambda c: top[c] - F.when(i == 0, F.lit(0)).otherwise(bottom[c])
        return F.struct(i.cast("double").alias("b"), less("n").alias("n"), less("pos").alias("pos"))

    bins = F.filter(F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), bin_at), lambda x: x["n"] > 0)
    rates = F.transform(bins, lambda x: F.struct(x["b"].alias("b"), (x["pos"] / x["n"]).alias("r")))
    return F.when(F.size(cuts) >= 2, F.sort_array(rates, asc=False)).otherwise(F.array().cast("array<struct<b:double,r:double>>"))


# ---------------------------------------------------------------- E13-E15: grouped report

REPORT_COLUMNS = [
    "n_observations",
    "target_rate",
    "score_average",
    "score_std",
    "rank_correlation",
    "target_bin_correlation",
    "number_deciles",
    "tp_perc",
    "tn_perc",
    "fp_perc",
    "fn_perc",
    "balanced_accuracy",
    "mcc",
    "precision",
    "recall",
    "f1",
    "pr_auc",
    "roc_auc",
    "brier_score",
    "ece",
    "first_decile_target_rate",
    "second_decile_target_rate",
    "third_decile_target_rate",
    "pr_auc_improvement",
    "first_decile_improvement",
    "second_decile_improvement",
]


def resolve_groups(df: DataFrame, grouping_cols: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Unknown grouping columns are dropped (none left -> error); no grouping -> ``fake_group``."""
    if grouping_cols is None:
        return df.withColumn(FAKE_GROUP, F.lit(1)), [FAKE_GROUP]
    cols = [c for c in grouping_cols if c in df.columns]
    if not cols:
        raise ValueError(f"none of the grouping columns {list(grouping_cols)} is in the data")
    return df, cols


def improvement(value: Column, baseline: Column) -> Column:
    """(value - baseline) / baseline; NULL when the baseline is NULL or 0 or the value NULL."""
    ok = baseline.isNotNull() & (baseline != 0) & value.isNotNull()
    return F.when(ok, (value - baseline) / baseline)


def performance_report(
    data: DataFrame,
    target_col: str,
    pred_col: str,
    prob_col: str,
    grouping_cols: Sequence[str] | None = None,
    test_size_minimum_per_group: int = 50,
    *,
    round_digits: int | None = 3,
    keep_null_groups: bool = False,
    buckets: int | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """One row per group with more than ``test_size_minimum_per_group`` rows.

    Metrics that are undefined for a single-class group are NULL; with no qualifying group the
    result is empty but keeps the full schema. Doubles are rounded half-even.
    """
    df, keys = resolve_groups(data, grouping_cols)
    if not keep_null_groups:
        df = df.dropna(subset=keys)
    # every statistic is computed for all groups at once and small groups are dropped at the end:
    # they are small by definition, and no extra pass over the rows is needed to find them
    hist = stored(outcome_histogram(df, keys, target_col, pred_col, prob_col), "histogram")
    (bounds,) = range_bounds(hist, ["score"], buckets)
    base = hist.groupBy(*keys).agg(*base_sums(bounds[len(bounds) // 2] if bounds else 0.0))
    base = base.where(F.col("n_observations") > test_size_minimum_per_group)
    cells = scored_cells(hist, keys)
    probs = numpy_linspace(10)
    hit = rank_hits(probs, F.col("score"), F.col("n"), F.col("cum_n"), F.col("tot_n"))
    counted = hit.withField("n", F.col("cum_n")).withField("pos", F.col("cum_pos"))
    curves = scored_run(cells, keys, bounds).groupBy(*keys).agg(
        *area_sums(), F.first("tot_n").alias("_n"), F.collect_list(counted).alias("_hits")
    )
    curves = curves.select(*keys, *areas(), quantile_cuts(F.col("_hits"), F.col("_n"), probs).alias("_cuts"))
    curves = curves.select(*keys, "roc_auc", "pr_auc", cut_bins(F.col("_cuts")).alias("_bins"))
    curves = curves.select(*keys, "roc_auc", "pr_auc", *bin_summary(F.col("_bins")))
    full = join_keys(join_keys(base, curves, keys, "left"), ece(cells, keys), keys, "left")
    n = F.col("n_observations")
    two = F.col("_two") == 1
    m = confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    cols = {
        "n_observations": n,
        "target_rate": F.col("target_rate"),
        "score_average": F.col("score_average"),
        "score_std": F.col("score_std"),
        "rank_correlation": F.col("rank_correlation"),
        "target_bin_correlation": F.col("target_bin_correlation"),
        "number_deciles": F.coalesce(F.col("number_deciles"), F.lit(0)).cast("long"),
        "tp_perc": _div(F.col("tp"), n) * 100,
        "tn_perc": _div(F.col("tn"), n) * 100,
        "fp_perc": _div(F.col("fp"), n) * 100,
        "fn_perc": _div(F.col("fn"), n) * 100,
        **{k: F.when(two, v) for k, v in m.items()},
        "pr_auc": F.when(two, F.col("pr_auc")),
        "roc_auc": F.when(two, F.col("roc_auc")),
        "brier_score": F.when(two, F.col("_brier")),
        "ece": F.when(two, F.col("ece")),
        "first_decile_target_rate": F.col("first_decile_target_rate"),
        "second_decile_target_rate": F.col("second_decile_target_rate"),
        "third_decile_target_rate": F.col("third_decile_target_rate"),
    }
    out = full.select(*keys, *[c.alias(k) for k, c in cols.items()])
    out = out.select(
        "*",
        improvement(F.col("pr_auc"), F.col("target_rate")).alias("pr_auc_improvement"),
        improvement(F.col("first_decile_target_rate"), F.col("target_rate")).alias("first_decile_improvement"),
        improvement(F.col("second_decile_target_rate"), F.col("target_rate")).alias("second_decile_improvement"),
    )
    return round_doubles(out, round_digits)


def round_doubles(df: DataFrame, digits: int | None, half_even: bool = True) -> DataFrame:
    """Round every DOUBLE column (half-even like numpy by default)."""
    if digits is None:
        return df
    fn = F.bround if half_even else F.round
    return df.select(
        *[
            fn(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in df.schema.fields
        ]
    )
