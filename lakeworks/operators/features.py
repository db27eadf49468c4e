"""Feature roles, missing-value profile, categorical filling, screening, feature matrix and
recursive feature elimination on Spark ML.

Screening statistics for all columns come from single aggregates (one pass, one small result row).
"""

from __future__ import annotations

import logging
import math
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeworks.functions.types import quote
from lakeworks.operators.splits import group_kfold, stratified_id_sample
from lakeworks.session import scratch_scope, stored

log = logging.getLogger(__name__)

_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def feature_roles(df: DataFrame, target_col: str | None = None) -> tuple[list[str], list[str]]:
    """(categorical, numeric) columns - text columns vs 32/64-bit ints and floats; the target
    is removed; other types are ignored."""
    cat, num = [], []
    for f in df.schema.fields:
        if f.name == target_col:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, _NUMERIC):
            num.append(f.name)
    return cat, num


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_missing`` for columns with any NULL (or NaN); one aggregate + unpivot."""
    cols = list(columns) if columns is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}

    def missing(c: str):
        col = F.col(quote(c))
        if isinstance(fields[c], (T.FloatType, T.DoubleType)):
            return F.count_if(col.isNull() | F.isnan(col))
        return F.count_if(col.isNull())

    counts = df.agg(*[missing(c).alias(f"m{i}") for i, c in enumerate(cols)])
    stacked = counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(cols)])).alias("s")
    ).select("s.column", "s.n_missing")
    return stacked.where(F.col("n_missing") > 0)


def fill_categoricals(df: DataFrame, categorical: Sequence[str] | None = None) -> DataFrame:
    """categorical NULLs -> text token (``'None'``; float columns give ``'nan'`` as pandas'
    string conversion does); numeric features untouched."""
    if categorical is None:
        categorical, _ = feature_roles(df)
    cats = set(categorical)
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if f.name in cats:
            token = "nan" if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else "None"
            c = F.coalesce(c.cast("string"), F.lit(token))
        out.append(c.alias(f.name))
    return df.select(*out)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n_distinct_approx, is_constant`` over non-null values in one pass: an estimate of the
    number of distinct values, and the exact answer to whether it is one."""
    cols = list(columns)
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(quote(c))
        aggs += [F.approx_count_distinct(col).alias(f"a{i}"), (F.min(col) == F.max(col)).alias(f"k{i}")]
    stats = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("n_distinct_approx"), F.coalesce(f"k{i}", F.lit(False)).alias("is_constant"))
        for i, c in enumerate(cols)
    ]
    return stats.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def constant_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """features with exactly one distinct non-null value."""
    return [r["feature"] for r in distinct_counts(df, columns).where("is_constant").collect()]


def binary_profile(df: DataFrame, columns: Sequence[str], min_count_binary: int = 30) -> DataFrame:
    """``feature, is_binary, n_ones, rare`` - a feature whose values are exactly 0 and 1 (both occur,
    NULLs aside) is binary, and rare with fewer than ``min_count_binary`` ones. One aggregate."""
    cols = list(columns)
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(quote(c)).cast("double")
        aggs += [
            F.count_if(col.isNotNull() & ~col.isin(0.0, 1.0)).alias(f"x{i}"),
            F.count_if(col == 0.0).alias(f"z{i}"),
            F.count_if(col == 1.0).alias(f"o{i}"),
        ]
    both = lambda i: (F.col(f"x{i}") == 0) & (F.col(f"z{i}") > 0) & (F.col(f"o{i}") > 0)
    rows = [
        F.struct(F.lit(c).alias("feature"), both(i).alias("is_binary"), F.col(f"o{i}").alias("n_ones")) for i, c in enumerate(cols)
    ]
    stacked = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return stacked.withColumn("rare", F.col("is_binary") & (F.col("n_ones") < min_count_binary))


def screened_features(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], forced: Sequence[str] = (), min_count_binary: int | None = 30
) -> DataFrame:
    """``feature, is_constant, rare, kept``: what elimination starts from. Constant features (F6) and rare 0/1 features (F7,
    among ``numeric``; not with ``min_count_binary=None``) are not kept, unless they are ``forced``."""
    found = distinct_counts(df, [*categorical, *numeric]).select("feature", "is_constant")
    if numeric and min_count_binary is not None:
        rare = binary_profile(df, list(numeric), min_count_binary).select("feature", "rare")
        found = found.join(rare, "feature", "left")
    else:
        found = found.withColumn("rare", F.lit(False))
    rare = F.coalesce("rare", F.lit(False))
    must = F.col("feature").isin(list(forced)) if forced else F.lit(False)
    return found.select("feature", "is_constant", rare.alias("rare"), (must | ~(F.col("is_constant") | rare)).alias("kept"))


#: columns whose pair sums one scan holds; wider frames take a scan per pair of blocks, of these columns only
CORRELATION_BLOCK = 512


def _pair_sums(df: DataFrame, cols: list[str], left: range, right: range) -> DataFrame:
    """``i, j, n, sx, sy, sxy, sxx, syy`` per pair ``i < j`` of columns ``left x right``, over the rows that have both; a
    task passes on one row per pair. Values count from the mean of some first rows, so that the sums lose nothing."""
    import numpy as np
    import pyarrow as pa

    at = sorted({*left, *right})
    values = df.select(*[F.col(quote(cols[i])).cast("double").alias(f"c{i}") for i in at])
    few = np.array([[np.nan if x is None or not np.isfinite(x) else x for x in r] for r in values.limit(100).collect()]).reshape(-1, len(at))
    known = ~np.isnan(few)
    shift = np.where(known, few, 0.0).sum(axis=0) / np.maximum(1, known.sum(axis=0))
    a, b = [at.index(i) for i in left], [at.index(j) for j in right]

    def run(batches):
        sums = None
        for batch in batches:
            v = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            has = ~np.isnan(v)
            x, m = np.where(has, v - shift, 0.0), has.astype(float)
            xa, xb, ma, mb = x[:, a], x[:, b], m[:, a], m[:, b]
            more = np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, xa.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb)])
            sums = more if sums is None else sums + more
        if sums is not None:
            i, j = np.meshgrid(np.array(left), np.array(right), indexing="ij")
            pairs = i < j
            arrays = [pa.array(i[pairs], pa.int32()), pa.array(j[pairs], pa.int32()), *(pa.array(s[pairs]) for s in sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "n", "sx", "sy", "sxy", "sxx", "syy"])

    return values.mapInArrow(run, "i int, j int, n double, sx double, sy double, sxy double, sxx double, syy double")


def correlation_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """F8: Pearson correlation of every numeric pair (pairwise-complete rows, NaN counts as missing; NULL without any, or
    for a constant side); ``correlated`` marks abs(corr) above ``threshold``.

    Cross products of whole Arrow batches: no row is multiplied, each task shuffles six sums per pair."""
    cols = list(columns)
    spark = df.sparkSession
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return spark.createDataFrame([], "feature_a string, feature_b string, corr double, correlated boolean")
    blocks = [range(k, min(k + CORRELATION_BLOCK, len(cols))) for k in range(0, len(cols), CORRELATION_BLOCK)]
    parts = [_pair_sums(df, cols, x, y) for k, x in enumerate(blocks) for y in blocks[k:]]
    sums = reduce(DataFrame.unionByName, parts)
    total = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy", "sxx", "syy")])
    n = F.col("n")
    spread = lambda s, ss: F.col(ss) - F.try_divide(F.col(s) * F.col(s), n)
    vx, vy = spread("sx", "sxx"), spread("sy", "syy")
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    varies = (vx > 1e-13 * F.col("sxx")) & (vy > 1e-13 * F.col("syy"))
    known = total.select("i", "j", F.when(varies, F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy))).alias("corr"))
    every = spark.createDataFrame([(i, j, cols[i], cols[j]) for i, j in pairs], "i int, j int, feature_a string, feature_b string")
    stacked = every.join(known, ["i", "j"], "left").select("feature_a", "feature_b", "corr")
    return stacked.withColumn("correlated", F.abs(F.col("corr")) > threshold)


# ------------------------------------------------------------------------------ F5, F12


def feature_matrix(df: DataFrame, label_col: str, categorical: Sequence[str], numeric: Sequence[str]):
    """``(frame with features vector and label, categorical positions)`` via Spark ML
    ``StringIndexer(handleInvalid="keep")`` + ``VectorAssembler``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    cats, nums = list(categorical), list(numeric)
    filled = fill_categoricals(df, cats)
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in cats]
    stages.append(VectorAssembler(inputCols=[f"{c}__idx" for c in cats] + nums, outputCol="features", handleInvalid="keep"))
    model = Pipeline(stages=stages).fit(filled)
    out = model.transform(filled).select("features", F.col(label_col).cast("double").alias("label"))
    return out, list(range(len(cats)))


#: thresholds of a numeric feature that trees choose from, one more
TREE_BINS = 64


def tree_splits(df: DataFrame, numeric: Sequence[str], bins: int = TREE_BINS) -> dict[str, list[float]]:
    """``Bucketizer`` splits of the features with far more values than ``bins``: quantiles over all rows (to a thousandth
    of them), each the last value of its bin. A value that takes several quantiles has a bin of its own. NULL and NaN do
    not count; the bins are ``bins`` at most."""
    cols = list(numeric)
    known = {r["feature"]: r["n_distinct_approx"] for r in distinct_counts(df, cols).collect()} if cols else {}
    many = [c for c in cols if known[c] > 2 * bins]
    if not many:
        return {}
    quantiles = df.select(*[F.col(quote(c)).cast("double").alias(f"q{i}") for i, c in enumerate(many)]).approxQuantile(
        [f"q{i}" for i in range(len(many))], [k / bins for k in range(1, bins)], 0.001
    )
    out = {}
    for c, cuts in zip(many, quantiles):
        times = Counter(cuts)
        ends = {math.nextafter(x, math.inf) for x in times} | {x for x, n in times.items() if n > 1}
        if inner := sorted(x for x in ends if math.isfinite(x)):
            out[c] = [-math.inf, *inner, math.inf]
    return out


def tree_cells(df: DataFrame, keys: Sequence[str], numeric: Sequence[str], splits: dict[str, list[float]]) -> DataFrame:
    """Rows that no tree can tell apart as one: ``keys, numeric, _lw_n`` with their number, the features of ``splits`` as
    numbers of bins (NULL and NaN in the last). Trees of these features with weights are those of the rows."""
    from pyspark.ml.feature import Bucketizer

    binned = df
    if splits:
        names = list(splits)
        bucketizer = Bucketizer(
            inputCols=names, outputCols=[f"_lw_bin{i}" for i in range(len(names))], splitsArray=[splits[c] for c in names], handleInvalid="keep"
        )
        # the cast takes off the mark of a categorical feature
        binned = bucketizer.transform(df).withColumns({c: F.col(f"_lw_bin{i}").cast("int") for i, c in enumerate(names)})
    by = [F.col(quote(c)) for c in [*keys, *numeric]]
    return _for_all_cores(binned.groupBy(*by).agg(F.count(F.lit(1)).alias("_lw_n")), by)


def _for_all_cores(cells: DataFrame, by: list) -> DataFrame:
    """Few rows, that are gone over dozens of times, in parts for all cores."""
    spark = cells.sparkSession
    parts = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cells.repartition(parts, *by)


def weighted_cells(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`tree_cells` of fewer ``columns``, stored, with a ``_lw_weight``: a cell of many rows as several rows, each of
    the mean number at most. So the sample of rows in which Spark looks for thresholds meets a value of many rows often."""
    by = [F.col(quote(c)) for c in columns]
    fewer = stored(_for_all_cores(cells.groupBy(*by).agg(F.sum("_lw_n").alias("_lw_n")), by), "elimination-round")
    total = fewer.agg(F.count(F.lit(1)).alias("cells"), F.sum("_lw_n").alias("rows")).first()
    most = math.ceil((total["rows"] or 1) / max(1, total["cells"]))
    times = F.ceil(F.col("_lw_n") / most).cast("int")
    out = fewer.withColumn("_lw_weight", F.col("_lw_n") / times)
    return out.withColumn("_lw_n", F.explode(F.sequence(F.lit(1), times))).drop("_lw_n")


def feature_elimination(
    df: DataFrame,
    label_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    *,
    task: str = "classification",
    steps: int = 15,
    n_features: int | None = None,
    forced: Sequence[str] = (),
    max_iter: int = 100,
    seed: int = 42,
    event_col: str | None = None,
    id_col: str | None = None,
    sample_share: float | None = None,
    min_count_binary: int | None = 30,
) -> tuple[list[str], DataFrame]:
    """recursive elimination on Spark ML - gradient-boosted trees for ``classification``
    (loss 1 - ROC AUC) and ``regression`` (RMSE); accelerated-failure-time regression for
    ``survival`` (``label_col`` = time > 0, ``event_col`` = 1 when observed; importance =
    |coefficient| x feature std; loss 1 - concordance index on the validation fold).

    Constant features go first (F6), then 0/1 features with fewer than ``min_count_binary`` ones (F7;
    None keeps them); forced features stay. ``sample_share`` fits on a share of the ids (F9). Train on
    folds 0-1, validate on fold 2: with ``id_col`` the folds of F10/F11, so no id is on both sides,
    else by a hash of the features. Each round fits, records the validation loss for the current
    feature count, and drops the least important non-forced feature: ``steps`` features at most, or
    until ``n_features`` are left. Returns the chosen features (minimum loss, or the last
    ``n_features``) and the curve ``n_features, removed, loss`` (G3).

    Trees see the features in ``TREE_BINS`` bins, as always, but rows of the same bins and label are counted first
    (:func:`tree_cells`): every row counts, while a round goes over combinations of bins, however many rows there are.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor

    forced_set = set(forced)
    if task == "survival" and not df.where(F.col(label_col) <= 0).isEmpty():
        raise ValueError("survival times must be positive")
    if sample_share is not None:
        if id_col is None:
            raise ValueError("sample_share needs id_col")
        df = stratified_id_sample(df, id_col, event_col or label_col, sample_share, seed)
    full = list(categorical) + list(numeric)
    kept = {r["feature"] for r in screened_features(df, categorical, numeric, forced, min_count_binary).where("kept").collect()}
    full = [c for c in full if c in kept]
    categorical, numeric = [c for c in full if c in set(categorical)], [c for c in full if c in set(numeric)]
    if not full:
        raise ValueError("no feature is left after screening")
    if id_col is not None:
        strata = label_col if task == "classification" else event_col
        split = group_kfold(df, id_col, 3, seed, strata, out="_lw_fold")
    else:
        split = df.withColumn("_lw_fold", F.pmod(F.xxhash64(*[F.col(quote(c)) for c in full], F.lit(seed)), F.lit(3)))
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    # what a round assembles its columns from is stored: indexed rows, or for trees their cells
    others = [c for c in {label_col: 1, event_col: 1} if c is not None and c not in full]
    filled = stored(fill_categoricals(split, categorical).select(*[F.col(quote(c)) for c in [*others, *full, "_lw_fold"]]), "elimination")
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    indexed = Pipeline(stages=indexers).fit(filled).transform(filled).withColumn("label", F.col(label_col).cast("double"))
    if task == "survival":
        indexed = stored(indexed, "elimination-indexed")
    else:
        rows = indexed.withColumn("_lw_fold", F.when(F.col("_lw_fold") < 2, 0).otherwise(2))
        keys = ["_lw_fold", "label", *[f"{c}__idx" for c in categorical]]
        splits = tree_splits(filled.where(F.col("_lw_fold") < 2), numeric)
        indexed = stored(tree_cells(rows, keys, numeric, splits), "elimination-cells")
    current = list(full)
    if n_features is not None:
        steps = max(1, len(full) - n_features + 1)
    curve = []
    removed: list[str | None] = [None]
    for _ in range(max(1, steps)):
        cats = [c for c in current if c in categorical]
        nums = [c for c in current if c in numeric]
        with scratch_scope(df.sparkSession):
            columns = [f"{c}__idx" for c in cats] + nums
            assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
            source = indexed if task == "survival" else weighted_cells(indexed, ["_lw_fold", "label", *columns])
            prep = assembler.transform(source)
            train, valid = prep.where(F.col("_lw_fold") < 2), prep.where(F.col("_lw_fold") == 2)
            order = [c for c in cats] + nums
            if task == "survival":
                imp, loss = _aft_round(train, valid, order, cats, event_col, max_iter)
            else:
                if task == "classification":
                    est = GBTClassifier(maxIter=max_iter, maxDepth=4, seed=seed, maxBins=TREE_BINS, weightCol="_lw_weight")
                    ev = BinaryClassificationEvaluator(metricName="areaUnderROC", weightCol="_lw_weight")
                else:
                    est = GBTRegressor(maxIter=max_iter, maxDepth=4, seed=seed, maxBins=TREE_BINS, weightCol="_lw_weight")
                    ev = RegressionEvaluator(metricName="rmse", weightCol="_lw_weight")
                model = est.fit(train)
                metric = ev.evaluate(model.transform(valid))
                loss = 1.0 - metric if task == "classification" else metric
                imp = model.featureImportances.toArray().tolist()
        curve.append((len(current), removed[-1], float(loss)))
        candidates = [(imp[i], name) for i, name in enumerate(order) if name not in forced_set]
        if len(current) <= 1 or not candidates:
            break
        worst = min(candidates)[1]
        current.remove(worst)
        removed.append(worst)
    curve_df = df.sparkSession.createDataFrame(curve, "n_features int, removed string, loss double")
    keep_n = n_features if n_features is not None else min(curve, key=lambda r: r[2])[0]
    dropped = set(removed[1:][: max(0, len(full) - keep_n)])
    return [c for c in full if c not in dropped], curve_df


def _aft_round(train: DataFrame, valid: DataFrame, order, cats, event_col: str | None, max_iter: int):
    """One survival round: AFT fit, importances from |coef| x std, loss = 1 - c-index."""
    from pyspark.ml.regression import AFTSurvivalRegression

    from lakeworks.operators.survival import concordance

    if event_col is None:
        raise ValueError("task='survival' needs event_col")
    tr = train.withColumn("_lw_censor", F.col(event_col).cast("double"))
    model = AFTSurvivalRegression(censorCol="_lw_censor", maxIter=max(10, max_iter)).fit(tr)
    cols = [f"{c}__idx" if c in cats else c for c in order]
    stds = train.agg(*[F.stddev_pop(F.col(quote(c)).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    coef = model.coefficients.toArray().tolist()
    imp = [abs(coef[i]) * float(stds[f"s{i}"] or 0.0) for i in range(len(cols))]
    scored = model.transform(valid)
    c = concordance(scored, "label", event_col, "prediction").first()["c_index"]
    return imp, 1.0 - (c if c is not None else 0.5)
