"""Splits and samples: time split, stratified id sampling, (stratified) group k-fold.

Ids are ranked by a seeded hash inside their stratum with running totals over ranges of the hash, so a
stratum holding a third of all ids is still ranked across many tasks. Rows follow their id
through a semi join or a key join on the small per-id table; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.common import (
    ALL_KEY,
    exact_quantiles,
    join_keys,
    running_totals,
    with_group_key,
)
from lakeworks.session import stored


def time_split_labels(
    data: DataFrame, date_column: str, test_ratio: float = 0.3, max_date: str | None = None, out: str = "split"
) -> DataFrame:
    """rows labelled ``train`` (day < cutoff) or ``test`` (day >= cutoff); NULL for a NULL date.

    Optional ``max_date`` keeps only earlier rows first. Dates count as calendar days. The cutoff
    lies at position ``(n - 1) * (1 - test_ratio)`` of the sorted days; between two days it falls
    on a whole day: counted from the lower one for a fraction below one half, else from the upper.
    """
    if not 0 < test_ratio < 1:
        raise ValueError("test_ratio must be in (0, 1)")
    df = data
    if max_date is not None:
        df = df.where(F.col(date_column) < F.lit(max_date).cast(df.schema[date_column].dataType))
    ratio = 1 - test_ratio
    with_day = df.withColumn("_lw_day", F.datediff(F.col(date_column).cast("date"), F.lit("1970-01-01").cast("date")))
    cut = exact_quantiles(with_day, [], "_lw_day", [ratio], out="_lw_q")
    position = (F.col("n") - 1) * F.lit(ratio)
    day = F.col("_lw_q")[0]
    cut = cut.select(
        F.lit(1).alias(ALL_KEY),
        F.when(position - F.floor(position) < 0.5, F.floor(day)).otherwise(F.ceil(day)).alias("_lw_cut"),
    )
    keyed, _ = with_group_key(with_day, [])
    labelled = join_keys(keyed, cut, [ALL_KEY], "left", small=True)  # one row
    label = F.when(F.col("_lw_day") < F.col("_lw_cut"), "train").when(F.col("_lw_day") >= F.col("_lw_cut"), "test")
    return labelled.withColumn(out, label).drop("_lw_day", "_lw_cut", ALL_KEY)


def time_split(
    data: DataFrame, date_column: str, test_ratio: float = 0.3, max_date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """F1 as two frames (train, test); rows without a date are in neither; the input frame is left as it is."""
    labelled = time_split_labels(data, date_column, test_ratio, max_date, out="_lw_split")
    train = labelled.where(F.col("_lw_split") == "train").drop("_lw_split")
    test = labelled.where(F.col("_lw_split") == "test").drop("_lw_split")
    return train, test


def id_hash(id_cols: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of ``id|..|seed`` (a NULL as ``null``): an order of ids that any engine can compute again."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in id_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _hash_rank(ids: DataFrame, id_cols: Sequence[str], strata: Sequence[str], seed: int) -> DataFrame:
    """Rank ids inside each stratum by a seeded hash (1-based ``_lw_rank``), plus ``_lw_size``."""
    strata = list(strata)
    tagged = ids.withColumn("_lw_h", id_hash(id_cols, seed)).withColumn("_lw_one", F.lit(1).cast("long"))
    run = running_totals(tagged, strata, "_lw_h", ["_lw_one"], totals_prefix="tot_")
    return run.withColumnsRenamed({"cum__lw_one": "_lw_rank", "tot__lw_one": "_lw_size"}).drop("_lw_h", "_lw_one")


def stratified_id_sample(
    data: DataFrame,
    id_col: str,
    target_col: str,
    share: float,
    seed: int = 42,
    order_col: str | None = None,
    survival_event_col: str | None = None,
) -> DataFrame:
    """sample ``share`` of the ids per stratum and keep every row of the sampled ids.

    The stratum of an id is its first target value (first by ``order_col`` when given, else the
    smallest); with ``survival_event_col`` it is whether that column is not -1.
    """
    if not 0 < share < 1:
        raise ValueError("share must be between 0 and 1")
    if survival_event_col is not None:
        strat = (F.col(survival_event_col) != -1).cast("int")
    else:
        strat = F.col(target_col)
    if order_col is not None:
        first = data.groupBy(id_col).agg(F.min_by(strat, F.col(order_col)).alias("_lw_stratum"))
    else:
        first = data.groupBy(id_col).agg(F.min(strat).alias("_lw_stratum"))
    ranked = _hash_rank(first, [id_col], ["_lw_stratum"], seed)
    keep = ranked.where(F.col("_lw_rank") <= F.round(F.col("_lw_size") * F.lit(share))).select(id_col)
    return join_keys(data, keep, [id_col], "left_semi")  # rows with a NULL id are those of one id


def group_kfold(
    data: DataFrame, id_col: str, k: int = 3, seed: int = 42, strata_col: str | None = None, out: str = "fold"
) -> DataFrame:
    """every row with a fold in ``0..k-1``; all rows of an id share a fold, those of a NULL id too.

    Ids are put in the order of what they hold, their rows of each class with ``strata_col`` (else their number of rows),
    and by a seeded hash among equals; then they are dealt back and forth, ``0..k-1, k-1..0, ..``. Neighbours in the
    order are alike, so every fold gets about the same rows of each class, whatever mix of classes the ids have. The
    order is not one sort: ids are ranked among equals, behind the number of ids of smaller kinds.
    """
    kind = F.coalesce(F.col(strata_col).cast("string"), F.lit("null")) if strata_col is not None else F.lit("")
    per_class = data.groupBy(F.col(id_col), kind.alias("_lw_c")).agg(F.count(F.lit(1)).alias("_lw_n"))
    held = F.concat(F.col("_lw_c"), F.lit(":"), F.lpad(F.col("_lw_n").cast("string"), 12, "0"))
    ids = per_class.groupBy(id_col).agg(F.array_join(F.sort_array(F.collect_list(held)), "|").alias("_lw_held"))
    ids = stored(ids, "fold-ids")
    kinds = ids.groupBy("_lw_held").agg(F.count(F.lit(1)).alias("_lw_ids"))
    behind = running_totals(kinds, [], "_lw_held", ["_lw_ids"])
    behind = behind.select("_lw_held", (F.col("cum__lw_ids") - F.col("_lw_ids")).alias("_lw_before"))
    ranked = join_keys(_hash_rank(ids, [id_col], ["_lw_held"], seed), behind, ["_lw_held"])
    place = F.pmod(F.col("_lw_before") + F.col("_lw_rank") - 1, F.lit(2 * k))
    fold = F.when(place < k, place).otherwise(2 * k - 1 - place).cast("int")
    return join_keys(data, ranked.select(id_col, fold.alias(out)), [id_col])
