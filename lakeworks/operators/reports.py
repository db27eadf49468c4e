"""Report tables behind evaluation charts: the score-bin table and monthly trend series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.classification import bin_of, decile_edges, improvement
from lakeworks.operators.common import ALL_KEY, join_keys, with_group_key


def score_bin_table(df: DataFrame, prob: str, target: str, bins: int = 10) -> DataFrame:
    """G1: ``bin`` (1-based quantile bin), ``target_mean``, ``score_mean``, ``n`` per bin, with the
    overall target rate and the improvement of the top bin over it on every row."""
    keyed, keys = with_group_key(df, [])
    edges = decile_edges(keyed, prob, keys, bins)
    s = F.col(prob).cast("double")
    binned = join_keys(keyed, edges, keys, small=True).withColumn("_lw_bin", bin_of(s, F.col("edges"), bins + 1))
    per_bin = binned.where(F.col("_lw_bin").isNotNull()).groupBy("_lw_bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(target).cast("double")).alias("target_mean"),
        F.avg(s).alias("score_mean"),
    )
    overall = keyed.agg(F.avg(F.col(target).cast("double")).alias("overall_rate"), F.lit(1).alias(ALL_KEY))
    top = per_bin.agg(F.max_by("target_mean", "_lw_bin").alias("_lw_top"), F.lit(1).alias(ALL_KEY))
    summary = join_keys(overall, top, [ALL_KEY], small=True).select(
        ALL_KEY, "overall_rate", improvement(F.col("_lw_top"), F.col("overall_rate")).alias("top_bin_improvement")
    )
    out = join_keys(per_bin.withColumn(ALL_KEY, F.lit(1)), summary, [ALL_KEY], small=True)
    return out.select(
        (F.col("_lw_bin") + 1).alias("bin"), "n", "target_mean", "score_mean", "overall_rate", "top_bin_improvement"
    )


def trend_monthly(data: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """Mean of ``y`` per calendar month of ``x`` (and per ``hue``)."""
    month = F.date_trunc("month", F.col(x).cast("timestamp_ntz")).alias("month")
    keys = [month] + ([F.col(hue)] if hue else [])
    return data.groupBy(*keys).agg(F.avg(F.col(y).cast("double")).alias(f"mean_{y}"), F.count(F.lit(1)).alias("n"))
