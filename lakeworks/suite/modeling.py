"""Splits, feature screening, reports, batch scoring (F, G, H items) and SQL pipelines (D items)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeworks.operators import features as FE
from lakeworks.operators import reports as RP
from lakeworks.operators import splits as SP
from lakeworks.plans import scoring as SC
from lakeworks.plans.sql import FrameSession, pipeline_to_tables, run_scripts, run_sql
from lakeworks.session import scratch_database, scratch_path
from lakeworks.suite import register, round6, table
from lakeworks.suite.evaluation import CLF_SQL, clf_frame

SCRIPTS = Path(__file__).parent / "scripts" / "orders_daily"

# ----------------------------------------------------------------------------- F1


@register(
    "time_split",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL),
p AS (SELECT (count(*) - 1) * 0.7::DOUBLE AS pos FROM d),
s AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS k FROM d),
c AS (SELECT pos - floor(pos) AS f, max(day) FILTER (WHERE k = floor(pos)) AS lo, max(day) FILTER (WHERE k = ceil(pos)) AS hi
      FROM s CROSS JOIN p GROUP BY pos),
cut AS (SELECT CASE WHEN f < 0.5 THEN lo + CAST(floor((hi - lo) * f) AS INTEGER)
                    ELSE hi - CAST(floor((hi - lo) * (1 - f)) AS INTEGER) END AS day FROM c)
SELECT CASE WHEN CAST(o_orderdate AS DATE) < cut.day THEN 'train' WHEN CAST(o_orderdate AS DATE) >= cut.day THEN 'test' END AS split,
       count(*) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
FROM orders CROSS JOIN cut GROUP BY 1""",
)
def q_time_split(spark: SparkSession, d: str) -> DataFrame:
    labelled = SP.time_split_labels(table(spark, d, "orders"), "o_orderdate", 0.3)
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date")
    )


# ----------------------------------------------------------------------------- F3-F8


def _doc_features(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left")


_DOC_SQL = "SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


@register(
    "missing_profile",
    f"""WITH f AS ({_DOC_SQL}), m AS (
  SELECT 'doc_id' AS column, count(*) FILTER (WHERE doc_id IS NULL) AS n_missing FROM f
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM f
  UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL) FROM f
  UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE n_chars IS NULL) FROM f
  UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM f
  UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM f)
SELECT * FROM m WHERE n_missing > 0""",
)
def q_missing_profile(spark: SparkSession, d: str) -> DataFrame:
    return FE.missing_profile(_doc_features(spark, d))


@register(
    "fill_categoricals",
    f"""WITH f AS ({_DOC_SQL})
SELECT doc_id, lang, coalesce(CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END, 'None') AS quality_label,
       n_chars, CAST(toxic AS DOUBLE) AS toxic FROM f""",
)
def q_fill_categoricals(spark: SparkSession, d: str) -> DataFrame:
    f = _doc_features(spark, d).select(
        "doc_id",
        "lang",
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").alias("quality_label"),
        "n_chars",
        "toxic",
    )
    out = FE.fill_categoricals(f, ["lang", "quality_label"])
    return out.withColumn("toxic", F.col("toxic").cast("double"))


@register(
    "feature_matrix",
    f"""WITH f AS (SELECT * FROM ({_DOC_SQL}) WHERE quality IS NOT NULL),
l AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS k FROM f GROUP BY lang),
s AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS k FROM f GROUP BY source)
SELECT doc_id, quality::DOUBLE AS label, l.k::DOUBLE AS lang_index, s.k::DOUBLE AS source_index, n_chars::DOUBLE AS n_chars
FROM f JOIN l USING (lang) JOIN s USING (source)""",
)
def q_feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents (a feature matrix needs its label): indexed categories, then numbers."""
    f = _doc_features(spark, d).where(F.col("quality").isNotNull())
    out, _ = FE.feature_matrix(f.withColumn("id", F.col("doc_id").cast("double")), "quality", ["lang", "source"], ["n_chars", "id"])
    v = out.select("label", _vec("features"))
    return v.select(
        F.get("features", 3).cast("long").alias("doc_id"),
        "label",
        F.get("features", 0).alias("lang_index"),
        F.get("features", 1).alias("source_index"),
        F.get("features", 2).alias("n_chars"),
    )


def _vec(col: str):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(col)).alias(col)


_CONST = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "currency"]


@register(
    "constant_features",
    "WITH o AS (SELECT *, 'EUR' AS currency FROM orders) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) = 1 AS is_constant FROM o" for c in _CONST),
)
def q_constant_features(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("currency", F.lit("EUR"))
    return FE.distinct_counts(o, _CONST).select("feature", "is_constant")


@register(
    "rare_binary_features",
    "WITH f AS (SELECT *, CAST(NULL AS INTEGER) AS nothing, 0 AS zero FROM (" + _DOC_SQL + ")), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(count(DISTINCT {c}) = 2 AND min({c}) = 0 AND max({c}) = 1, FALSE) AS is_binary,"
        f" count(*) FILTER (WHERE {c} = 1) AS n_ones FROM f"
        for c in ("quality", "toxic", "n_chars", "nothing", "zero")
    )
    + ") SELECT feature, is_binary, n_ones, is_binary AND n_ones < 30 AS rare FROM p",
)
def q_rare_binary_features(spark: SparkSession, d: str) -> DataFrame:
    f = _doc_features(spark, d).withColumns({"nothing": F.lit(None).cast("int"), "zero": F.lit(0)})
    return FE.binary_profile(f, ["quality", "toxic", "n_chars", "nothing", "zero"], 30)


_SCREEN_CAT, _SCREEN_NUM = ["lang", "source"], ["quality", "toxic", "n_chars", "nothing", "zero"]


@register(
    "feature_screening",
    "WITH f AS (SELECT *, CAST(NULL AS INTEGER) AS nothing, 0 AS zero FROM (" + _DOC_SQL + ")), c AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) = 1 AS is_constant FROM f" for c in [*_SCREEN_CAT, *_SCREEN_NUM])
    + "), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(count(DISTINCT {c}) = 2 AND min({c}) = 0 AND max({c}) = 1, FALSE)"
        f" AND count(*) FILTER (WHERE {c} = 1) < 60 AS rare FROM f"
        for c in _SCREEN_NUM
    )
    + """) SELECT feature, is_constant, coalesce(rare, FALSE) AS rare,
  feature = 'zero' OR NOT (is_constant OR coalesce(rare, FALSE)) AS kept FROM c LEFT JOIN p USING (feature)""",
)
def q_feature_screening(spark: SparkSession, d: str) -> DataFrame:
    """The features that elimination starts from, one of the constant ones forced."""
    f = _doc_features(spark, d).withColumns({"nothing": F.lit(None).cast("int"), "zero": F.lit(0)})
    return FE.screened_features(f, _SCREEN_CAT, _SCREEN_NUM, ["zero"], 60)


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "correlated_pairs",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr, abs(corr({a}, {b})) > 0.8 AS correlated FROM lineitem"
        for i, a in enumerate(_NUM)
        for b in _NUM[i + 1 :]
    )
    + ")",
)
def q_correlated_pairs(spark: SparkSession, d: str) -> DataFrame:
    return round6(FE.correlation_pairs(table(spark, d, "lineitem"), _NUM, 0.8))


_ID_HASH = "('0x' || substr(md5({id} || '|{seed}'), 1, 15))::BIGINT"


@register(
    "stratified_id_sample",
    f"""WITH i AS (SELECT l_orderkey, arg_min(CAST(l_returnflag = 'R' AS INTEGER),
  l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey) AS stratum FROM lineitem GROUP BY 1),
r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY stratum ORDER BY {_ID_HASH.format(id="l_orderkey", seed=7)}) AS k,
  count(*) OVER (PARTITION BY stratum) AS n FROM i)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem JOIN r USING (l_orderkey) WHERE k <= round(n * 0.2)""",
)
def q_stratified_id_sample(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a fifth of the orders of each stratum."""
    li = table(spark, d, "lineitem").withColumn("target", (F.col("l_returnflag") == "R").cast("int"))
    # a line number may repeat within an order: break ties, so that the first row is the same everywhere
    li = li.withColumn("seq", F.col("l_linenumber").cast("long") * 10_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey"))
    sample = SP.stratified_id_sample(li, "l_orderkey", "target", 0.2, seed=7, order_col="seq")
    return sample.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


def _folds_sql(kind: str) -> str:
    """Every order with the fold of its customer: customers by their orders of each ``kind``, dealt back and forth."""
    return f"""WITH c AS (SELECT o_custkey, {kind} AS kind, count(*) AS n FROM orders GROUP BY ALL),
i AS (SELECT o_custkey, string_agg(kind || ':' || lpad(n::VARCHAR, 12, '0'), '|' ORDER BY kind) AS held FROM c GROUP BY 1),
r AS (SELECT o_custkey, (row_number() OVER (ORDER BY held, {_ID_HASH.format(id="o_custkey", seed=42)}) - 1) % 6 AS place FROM i)
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CASE WHEN place < 3 THEN place ELSE 5 - place END AS INTEGER) AS fold
FROM orders JOIN r USING (o_custkey)"""


@register("group_kfold", _folds_sql("''"))
def q_group_kfold(spark: SparkSession, d: str) -> DataFrame:
    folds = SP.group_kfold(table(spark, d, "orders"), "o_custkey", k=3)
    return folds.select("o_orderkey", "o_custkey", "o_orderstatus", "fold")


@register("stratified_group_kfold", _folds_sql("o_orderstatus"))
def q_stratified_group_kfold(spark: SparkSession, d: str) -> DataFrame:
    folds = SP.group_kfold(table(spark, d, "orders"), "o_custkey", k=3, strata_col="o_orderstatus")
    return folds.select("o_orderkey", "o_custkey", "o_orderstatus", "fold")


@register(
    "stratified_fold_shares",
    f"""WITH f AS ({_folds_sql("o_orderstatus")}),
n AS (SELECT fold, o_orderstatus, count(*) AS n_rows, sum(count(*)) OVER (PARTITION BY fold) AS fold_rows FROM f GROUP BY 1, 2),
w AS (SELECT o_orderstatus, count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1)
SELECT fold, o_orderstatus, n_rows, round(n_rows / fold_rows, 6) AS class_share, TRUE AS within_two_percent
FROM n JOIN w USING (o_orderstatus)""",
)
def q_stratified_fold_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows per class and fold of the stratified folds, and whether a class has the share it has in the whole table, to
    two hundredths."""
    orders = table(spark, d, "orders")
    n = SP.group_kfold(orders, "o_custkey", k=3, strata_col="o_orderstatus").groupBy("fold", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("fold"))
    whole = F.sum("n_rows").over(Window.partitionBy("o_orderstatus")) / F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    out = n.select("fold", "o_orderstatus", "n_rows", share.alias("class_share"), (F.abs(share - whole) <= 0.02).alias("within_two_percent"))
    return round6(out)


@register("feature_elimination")
def q_feature_elimination(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("target", (F.col("l_returnflag") == "R").cast("int"))
    _, curve = FE.feature_elimination(
        li.select("l_orderkey", "target", "l_linestatus", *_NUM),
        "target",
        ["l_linestatus"],
        _NUM,
        n_features=2,
        max_iter=10,
        id_col="l_orderkey",
    )
    return curve


# ----------------------------------------------------------------------------- G1, G2, H1


@register(
    "score_bin_table",
    f"""WITH b AS ({CLF_SQL}),
q AS (SELECT list_sort(list_distinct(quantile_cont(pscore, [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5,
          0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]))) AS edges FROM b),
x AS (SELECT b.*, greatest(0, len(list_filter(edges, lambda e: e < pscore)) - 1) + 1 AS bin FROM b CROSS JOIN q),
per AS (SELECT bin, count(*) AS n, avg(target) AS target_mean, avg(pscore) AS score_mean FROM x GROUP BY bin),
o AS (SELECT avg(target) AS overall_rate FROM b),
t AS (SELECT arg_max(target_mean, bin) AS top FROM per)
SELECT CAST(bin AS INTEGER) AS bin, n, round(target_mean, 6) AS target_mean, round(score_mean, 6) AS score_mean,
       round(overall_rate, 6) AS overall_rate, round((top - overall_rate) / overall_rate, 6) AS top_bin_improvement
FROM per CROSS JOIN o CROSS JOIN t""",
)
def q_score_bin_table(spark: SparkSession, d: str) -> DataFrame:
    out = RP.score_bin_table(clf_frame(spark, d), "pscore", "target", 10)
    return round6(out.withColumn("bin", F.col("bin").cast("int")))


@register(
    "trend_monthly",
    """SELECT date_trunc('month', o_orderdate) AS month, o_orderstatus, round(avg(o_totalprice), 6) AS mean_o_totalprice,
              count(*) AS n FROM orders GROUP BY ALL""",
)
def q_trend_monthly(spark: SparkSession, d: str) -> DataFrame:
    return round6(RP.trend_monthly(table(spark, d, "orders"), "o_orderdate", "o_totalprice", "o_orderstatus"))


@register("batch_score")
def q_batch_score(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    li = table(spark, d, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("double"))
    train = li.where(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) < 2)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=_NUM, outputCol="features"), LogisticRegression(maxIter=10)])
    path = SC.save_model(pipe.fit(train), scratch_path(spark, "model"))
    return SC.batch_score(path, li, keep=["l_orderkey", "l_linenumber"], outputs=["prediction"])


# ----------------------------------------------------------------------------- D1, D4, D7, D9, D11

_INLINE = """CREATE OR REPLACE TEMP VIEW lw_big AS SELECT * FROM orders WHERE o_totalprice > 200000;
SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 6) AS avg_price FROM lw_big GROUP BY o_orderstatus"""


@register(
    "sql_inline",
    """SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 6) AS avg_price FROM orders
       WHERE o_totalprice > 200000 GROUP BY o_orderstatus""",
)
def q_sql_inline(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    return run_sql(spark, _INLINE)


@register(
    "sql_templated",
    """SELECT o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY o_orderpriority""",
)
def q_sql_templated(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    text = """SELECT o_orderpriority, count(*) AS n FROM orders  -- {not_a_parameter} stays
WHERE o_orderstatus = '{status}' AND o_totalprice > {min_price} GROUP BY o_orderpriority"""
    return run_sql(spark, text, status="F", min_price=100000)


_FEATURES_SQL = """SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent, max(c_mktsegment) AS segment
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus IN ('F', 'P') AND o_totalprice > 50000 GROUP BY o_custkey"""


@register("run_scripts", _FEATURES_SQL)
def q_run_scripts(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    table(spark, d, "customer").createOrReplaceTempView("customer")
    return run_scripts(spark, SCRIPTS, pipeline="daily", status_a="F", status_b="P", min_price=50000)


@register("pipeline_to_tables", _FEATURES_SQL)
def q_pipeline_to_tables(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "orders").createOrReplaceTempView("orders")
    table(spark, d, "customer").createOrReplaceTempView("customer")
    import uuid

    return pipeline_to_tables(
        spark,
        SCRIPTS,
        pipeline="daily",
        schema=scratch_database(spark),
        table_prefix="stg_",
        table_suffix="_" + uuid.uuid4().hex[:8],
        status_a="F",
        status_b="P",
        min_price=50000,
    )


@register(
    "query_with_frames",
    """SELECT c_mktsegment, count(*) AS n_big, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000 GROUP BY c_mktsegment""",
)
def q_query_with_frames(spark: SparkSession, d: str) -> DataFrame:
    fs = FrameSession(spark)
    fs.register("customer", table(spark, d, "customer"))
    big = table(spark, d, "orders").where(F.col("o_totalprice") > 300000)
    return fs.query(
        """SELECT c_mktsegment, count(*) AS n_big, round(sum(o_totalprice), 2) AS total
           FROM big_orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        frames={"big_orders": big},
        use_persistent=False,
    )


@register("feature_elimination_survival")
def q_feature_elimination_survival(spark: SparkSession, d: str) -> DataFrame:
    """Survival task of F12 on orders: time in days, counted from 1; event = not open."""
    from lakeworks.suite.evaluation import surv_frame

    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority")
    s = surv_frame(spark, d).select("o_orderkey", "t", "e").join(o, "o_orderkey").withColumn("t", F.col("t") + 1)
    s = s.withColumn("o_custkey", F.col("o_custkey").cast("double"))
    _, curve = FE.feature_elimination(
        s, "t", ["o_orderpriority"], ["o_totalprice", "o_custkey"], task="survival", event_col="e", n_features=1
    )
    return curve
