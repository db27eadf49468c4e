"""Classification and survival evaluation queries.

Classification: ``lineitem`` with target ``l_returnflag = 'R'``, a tied score ``l_quantity / 50``
(50 values), a near-continuous score ``l_extendedprice / 105000``, predicted class
``score >= 0.5``, groups ``l_linestatus``. Survival: ``orders`` with time in days since
1995-01-01, event ``o_orderstatus <> 'O'``, prediction ``floor(o_totalprice / 1000)``, groups
``o_orderpriority``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators import classification as C
from lakeworks.operators import survival as S
from lakeworks.suite import register, round6, table

G = ["l_linestatus"]
SG = ["o_orderpriority"]

CLF_SQL = """SELECT l_orderkey, l_linenumber, l_linestatus,
       CAST(l_returnflag = 'R' AS INTEGER) AS target,
       l_quantity / 50.0 AS score,
       l_extendedprice / 105000.0 AS pscore,
       CAST(l_quantity / 50.0 >= 0.5 AS INTEGER) AS pred
FROM lineitem"""

SURV_SQL = """SELECT o_orderkey, o_orderpriority,
       CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS INTEGER) AS t,
       CAST(o_orderstatus <> 'O' AS INTEGER) AS e,
       floor(o_totalprice / 1000.0) AS p
FROM orders"""


def clf_frame(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    score = F.col("l_quantity") / 50.0
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
        score.alias("score"),
        (F.col("l_extendedprice") / 105000.0).alias("pscore"),
        (score >= 0.5).cast("int").alias("pred"),
    )


def surv_frame(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        "o_orderpriority",
        F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("t"),
        (F.col("o_orderstatus") != "O").cast("int").alias("e"),
        F.floor(F.col("o_totalprice") / 1000.0).cast("double").alias("p"),
    )


# --------------------------------------------------------------------------- E1-E9

_CONF_SQL = f"""
WITH b AS ({CLF_SQL}), c AS (
  SELECT l_linestatus, count(*) AS n,
         count(*) FILTER (WHERE target = 1 AND pred = 1) AS tp,
         count(*) FILTER (WHERE target = 0 AND pred = 0) AS tn,
         count(*) FILTER (WHERE target = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE target = 1 AND pred = 0) AS fn
  FROM b GROUP BY l_linestatus)
"""


@register(
    "confusion",
    _CONF_SQL
    + """SELECT l_linestatus, n, tp, tn, fp, fn,
       round(100.0 * tp / n, 6) AS tp_perc, round(100.0 * tn / n, 6) AS tn_perc,
       round(100.0 * fp / n, 6) AS fp_perc, round(100.0 * fn / n, 6) AS fn_perc FROM c""",
)
def q_confusion(spark, d):
    return round6(C.confusion(clf_frame(spark, d), "target", "pred", G))


@register(
    "balanced_accuracy",
    _CONF_SQL
    + """SELECT l_linestatus,
       round((CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END
            + CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END) / 2, 6) AS balanced_accuracy FROM c""",
)
def q_balanced_accuracy(spark, d):
    c = C.confusion(clf_frame(spark, d), "target", "pred", G)
    m = C.confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    return round6(c.select(*G, m["balanced_accuracy"].alias("balanced_accuracy")))


@register(
    "mcc",
    _CONF_SQL
    + """SELECT l_linestatus,
       round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
             ELSE (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
                  / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc FROM c""",
)
def q_mcc(spark, d):
    c = C.confusion(clf_frame(spark, d), "target", "pred", G)
    m = C.confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    return round6(c.select(*G, m["mcc"].alias("mcc")))


@register(
    "prf1",
    _CONF_SQL
    + """SELECT l_linestatus,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM c""",
)
def q_prf1(spark, d):
    c = C.confusion(clf_frame(spark, d), "target", "pred", G)
    m = C.confusion_metrics(F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn"))
    return round6(c.select(*G, m["precision"].alias("precision"), m["recall"].alias("recall"), m["f1"].alias("f1")))


_HIST_SQL = f"""
WITH b AS ({CLF_SQL}), h AS (
  SELECT l_linestatus, pscore AS s, count(*) AS n, CAST(sum(target) AS BIGINT) AS pos,
         count(*) - CAST(sum(target) AS BIGINT) AS neg
  FROM b GROUP BY l_linestatus, pscore)
"""


@register(
    "roc_auc",
    _HIST_SQL
    + """, r AS (
  SELECT *, sum(neg) OVER (PARTITION BY l_linestatus ORDER BY s ROWS UNBOUNDED PRECEDING) - neg AS below FROM h)
SELECT l_linestatus, round(sum(pos * below + 0.5 * pos * neg) / (sum(pos) * CAST(sum(neg) AS DOUBLE)), 6) AS roc_auc
FROM r GROUP BY l_linestatus""",
)
def q_roc_auc(spark, d):
    b = clf_frame(spark, d)
    h = C.score_histogram(b, G, "target", "pscore")
    return round6(C.curve_areas(h, G).select(*G, "roc_auc"))


@register(
    "pr_auc",
    _HIST_SQL
    + """, c AS (
  SELECT l_linestatus, s,
         sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY l_linestatus) AS p_all
  FROM h WINDOW w AS (PARTITION BY l_linestatus ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
pts AS (
  SELECT l_linestatus, s, tp / p_all AS rec, tp / (tp + fp) AS prec FROM c),
seg AS (
  SELECT l_linestatus,
         rec - lag(rec, 1, 0.0) OVER (PARTITION BY l_linestatus ORDER BY s DESC) AS dr,
         (prec + lag(prec, 1, 1.0) OVER (PARTITION BY l_linestatus ORDER BY s DESC)) / 2 AS hp
  FROM pts)
SELECT l_linestatus, round(sum(dr * hp), 6) AS pr_auc FROM seg GROUP BY l_linestatus""",
)
def q_pr_auc(spark, d):
    b = clf_frame(spark, d)
    h = C.score_histogram(b, G, "target", "pscore")
    return round6(C.curve_areas(h, G).select(*G, "pr_auc"))


@register(
    "brier",
    f"""WITH b AS ({CLF_SQL})
SELECT l_linestatus, round(avg((pscore - target) * (pscore - target)), 6) AS brier_score FROM b GROUP BY l_linestatus""",
)
def q_brier(spark, d):
    return round6(C.brier(clf_frame(spark, d), "target", "pscore", G))


_ECE_EDGES = "[0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]"

_ECE_SQL = f"""WITH b AS ({CLF_SQL}),
x AS (SELECT l_linestatus, target, pscore,
             CASE WHEN pscore > 0 AND pscore <= 1.0
                  THEN len(list_filter({_ECE_EDGES}[1:10], lambda e: e < pscore)) - 1 END AS bin,
             count(*) OVER (PARTITION BY l_linestatus) AS n_all
      FROM b),
per AS (SELECT l_linestatus, bin, count(*) AS cnt, avg(pscore) AS conf, avg(target) AS acc, any_value(n_all) AS n_all
        FROM x WHERE bin IS NOT NULL GROUP BY l_linestatus, bin)
SELECT l_linestatus, round(sum(abs(conf - acc) * cnt / n_all), 6) AS ece FROM per GROUP BY l_linestatus"""


@register("ece", _ECE_SQL)
def q_ece(spark, d):
    b = clf_frame(spark, d)
    return round6(C.ece(C.score_histogram(b, G, "target", "pscore"), G))


def _metrics_all_sql() -> str:
    return f"""WITH b AS ({CLF_SQL}),
c AS (
  SELECT l_linestatus,
         CAST(count(*) FILTER (WHERE target = 1 AND pred = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE target = 0 AND pred = 0) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (WHERE target = 0 AND pred = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE target = 1 AND pred = 0) AS DOUBLE) AS fn,
         avg((score - target) * (score - target)) AS brier_score
  FROM b GROUP BY l_linestatus),
h AS (SELECT l_linestatus, score AS s, count(*) AS n, CAST(sum(target) AS BIGINT) AS pos,
             count(*) - CAST(sum(target) AS BIGINT) AS neg FROM b GROUP BY l_linestatus, score),
r AS (SELECT *, sum(neg) OVER (PARTITION BY l_linestatus ORDER BY s ROWS UNBOUNDED PRECEDING) - neg AS below,
             sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp, sum(pos) OVER (PARTITION BY l_linestatus) AS p_all
      FROM h WINDOW w AS (PARTITION BY l_linestatus ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT *, ctp / p_all AS rec, ctp / (ctp + cfp) AS prec FROM r),
seg AS (SELECT *, rec - lag(rec, 1, 0.0) OVER (PARTITION BY l_linestatus ORDER BY s DESC) AS dr,
               (prec + lag(prec, 1, 1.0) OVER (PARTITION BY l_linestatus ORDER BY s DESC)) / 2 AS hp FROM pts),
a AS (SELECT l_linestatus, sum(pos * below + 0.5 * pos * neg) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS roc_auc,
             sum(dr * hp) AS pr_auc FROM seg GROUP BY l_linestatus),
x AS (SELECT l_linestatus, target, score,
             CASE WHEN score > 0 AND score <= 1.0
                  THEN len(list_filter({_ECE_EDGES}[1:10], lambda e: e < score)) - 1 END AS bin,
             count(*) OVER (PARTITION BY l_linestatus) AS n_all FROM b),
per AS (SELECT l_linestatus, bin, count(*) AS cnt, avg(score) AS conf, avg(target) AS acc, any_value(n_all) AS n_all
        FROM x WHERE bin IS NOT NULL GROUP BY l_linestatus, bin),
e AS (SELECT l_linestatus, sum(abs(conf - acc) * cnt / n_all) AS ece FROM per GROUP BY l_linestatus)
SELECT c.l_linestatus,
  round((CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END + CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END) / 2, 6)
    AS m_balanced_accuracy,
  round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0
        ELSE (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS m_mcc,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS m_precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS m_recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS m_f1,
  round(pr_auc, 6) AS m_pr_auc, round(roc_auc, 6) AS m_roc_auc, round(brier_score, 6) AS m_brier_score,
  round(ece, 6) AS m_ece
FROM c JOIN a USING (l_linestatus) JOIN e USING (l_linestatus)"""


@register("metrics_all", _metrics_all_sql())
def q_metrics_all(spark, d):
    return round6(C.classification_metrics(clf_frame(spark, d), "target", "pred", "score", G, prefix="m"))


# --------------------------------------------------------------------------- E10-E13

_DECILE_SQL = f"""WITH b AS ({CLF_SQL}),
q AS (SELECT l_linestatus,
             list_sort(list_distinct(quantile_cont(pscore, [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5,
                 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]))) AS edges
      FROM b GROUP BY l_linestatus),
binned AS (
  SELECT b.*, CASE WHEN len(edges) >= 2 THEN greatest(0, len(list_filter(edges, lambda e: e < pscore)) - 1) END AS bin
  FROM b JOIN q USING (l_linestatus))
"""


@register(
    "score_deciles",
    _DECILE_SQL + "SELECT l_orderkey, l_linenumber, l_linestatus, CAST(bin AS INTEGER) AS bin FROM binned",
)
def q_score_deciles(spark, d):
    b = clf_frame(spark, d)
    out = C.score_deciles(b, "pscore", G)
    return out.select("l_orderkey", "l_linenumber", "l_linestatus", F.col("bin").cast("int").alias("bin"))


@register(
    "decile_rates",
    _DECILE_SQL
    + """SELECT l_linestatus, CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(target), 6) AS target_rate,
       round(avg(pscore), 6) AS score_mean FROM binned GROUP BY l_linestatus, bin""",
)
def q_decile_rates(spark, d):
    r = C.decile_rates(clf_frame(spark, d), "target", "pscore", G)
    return round6(r.select(*G, F.col("bin").cast("int").alias("bin"), "n", "target_rate", "score_mean"))


_DECSUM_SQL = (
    _DECILE_SQL
    + """, rates AS (SELECT l_linestatus, bin, avg(target) AS target_rate FROM binned GROUP BY l_linestatus, bin),
rk AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY bin DESC) AS pos,
              rank() OVER (PARTITION BY l_linestatus ORDER BY target_rate)
                + (count(*) OVER (PARTITION BY l_linestatus, target_rate) - 1) / 2.0 AS rr FROM rates),
s AS (SELECT l_linestatus, count(*) AS number_deciles, corr(bin, rr) AS sp, corr(bin, target_rate) AS pe,
             max(target_rate) FILTER (WHERE pos = 1) AS first_decile_target_rate,
             max(target_rate) FILTER (WHERE pos = 2) AS second_decile_target_rate,
             max(target_rate) FILTER (WHERE pos = 3) AS third_decile_target_rate
      FROM rk GROUP BY l_linestatus)
"""
)


@register(
    "bin_correlation",
    _DECSUM_SQL
    + """SELECT l_linestatus, number_deciles,
       round(CASE WHEN number_deciles > 4 THEN sp END, 6) AS rank_correlation,
       round(CASE WHEN number_deciles > 4 THEN pe END, 6) AS target_bin_correlation,
       round(first_decile_target_rate, 6) AS first_decile_target_rate,
       round(second_decile_target_rate, 6) AS second_decile_target_rate,
       round(third_decile_target_rate, 6) AS third_decile_target_rate FROM s""",
)
def q_bin_correlation(spark, d):
    r = C.decile_rates(clf_frame(spark, d), "target", "pscore", G)
    return round6(C.decile_summary(r, G))


def _report_sql() -> str:
    r3 = lambda e, a: f"round_even({e}, 3) AS {a}"
    return (
        _DECSUM_SQL
        + """, base AS (
  SELECT l_linestatus, count(*) AS n_observations, avg(target) AS target_rate, avg(pscore) AS score_average,
         stddev_pop(pscore) AS score_std,
         CAST(count(*) FILTER (WHERE target = 1 AND pred = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE target = 0 AND pred = 0) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (WHERE target = 0 AND pred = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE target = 1 AND pred = 0) AS DOUBLE) AS fn,
         avg((pscore - target) * (pscore - target)) AS brier_score, count(DISTINCT target) AS classes
  FROM b GROUP BY l_linestatus HAVING count(*) > 50),
h AS (SELECT l_linestatus, pscore AS sc, count(*) AS n, CAST(sum(target) AS BIGINT) AS pos,
             count(*) - CAST(sum(target) AS BIGINT) AS neg FROM b GROUP BY l_linestatus, pscore),
r AS (SELECT *, sum(neg) OVER (PARTITION BY l_linestatus ORDER BY sc ROWS UNBOUNDED PRECEDING) - neg AS below,
             sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp, sum(pos) OVER (PARTITION BY l_linestatus) AS p_all
      FROM h WINDOW w AS (PARTITION BY l_linestatus ORDER BY sc DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT *, ctp / p_all AS rec, ctp / (ctp + cfp) AS prec FROM r),
seg AS (SELECT *, rec - lag(rec, 1, 0.0) OVER (PARTITION BY l_linestatus ORDER BY sc DESC) AS dr,
               (prec + lag(prec, 1, 1.0) OVER (PARTITION BY l_linestatus ORDER BY sc DESC)) / 2 AS hp FROM pts),
a AS (SELECT l_linestatus, sum(pos * below + 0.5 * pos * neg) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS roc_auc,
             sum(dr * hp) AS pr_auc FROM seg GROUP BY l_linestatus),
x AS (SELECT l_linestatus, target, pscore,
             CASE WHEN pscore > 0 AND pscore <= 1.0
                  THEN len(list_filter("""
        + _ECE_EDGES
        + """[1:10], lambda e: e < pscore)) - 1 END AS ebin,
             count(*) OVER (PARTITION BY l_linestatus) AS n_all FROM b),
per AS (SELECT l_linestatus, ebin, count(*) AS cnt, avg(pscore) AS conf, avg(target) AS acc, any_value(n_all) AS n_all
        FROM x WHERE ebin IS NOT NULL GROUP BY l_linestatus, ebin),
e AS (SELECT l_linestatus, sum(abs(conf - acc) * cnt / n_all) AS ece FROM per GROUP BY l_linestatus),
m AS (
  SELECT base.*, a.roc_auc, a.pr_auc, e.ece, s.number_deciles, s.sp, s.pe,
         s.first_decile_target_rate, s.second_decile_target_rate, s.third_decile_target_rate
  FROM base JOIN a USING (l_linestatus) JOIN e USING (l_linestatus) JOIN s USING (l_linestatus))
SELECT l_linestatus, n_observations, """
        + ", ".join(
            [
                r3("target_rate", "target_rate"),
                r3("score_average", "score_average"),
                r3("score_std", "score_std"),
                r3("CASE WHEN number_deciles > 4 THEN sp END", "rank_correlation"),
                r3("CASE WHEN number_deciles > 4 THEN pe END", "target_bin_correlation"),
                "CAST(number_deciles AS BIGINT) AS number_deciles",
                r3("100.0 * tp / n_observations", "tp_perc"),
                r3("100.0 * tn / n_observations", "tn_perc"),
                r3("100.0 * fp / n_observations", "fp_perc"),
                r3("100.0 * fn / n_observations", "fn_perc"),
                r3(
                    "CASE WHEN classes > 1 THEN (CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END"
                    " + CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END) / 2 END",
                    "balanced_accuracy",
                ),
                r3(
                    "CASE WHEN classes > 1 THEN CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0.0"
                    " ELSE (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) END END",
                    "mcc",
                ),
                r3("CASE WHEN classes > 1 THEN CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END END", "precision"),
                r3("CASE WHEN classes > 1 THEN CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END END", "recall"),
                r3(
                    "CASE WHEN classes > 1 THEN CASE WHEN 2 * tp + fp + fn = 0 THEN 0"
                    " ELSE 2 * tp / (2 * tp + fp + fn) END END",
                    "f1",
                ),
                r3("CASE WHEN classes > 1 THEN pr_auc END", "pr_auc"),
                r3("CASE WHEN classes > 1 THEN roc_auc END", "roc_auc"),
                r3("CASE WHEN classes > 1 THEN brier_score END", "brier_score"),
                r3("CASE WHEN classes > 1 THEN ece END", "ece"),
                r3("first_decile_target_rate", "first_decile_target_rate"),
                r3("second_decile_target_rate", "second_decile_target_rate"),
                r3("third_decile_target_rate", "third_decile_target_rate"),
                r3(
                    "CASE WHEN classes > 1 AND target_rate <> 0 THEN (pr_auc - target_rate) / target_rate END",
                    "pr_auc_improvement",
                ),
                r3(
                    "CASE WHEN target_rate <> 0 THEN (first_decile_target_rate - target_rate) / target_rate END",
                    "first_decile_improvement",
                ),
                r3(
                    "CASE WHEN target_rate <> 0 THEN (second_decile_target_rate - target_rate) / target_rate END",
                    "second_decile_improvement",
                ),
            ]
        )
        + " FROM m"
    )


@register("performance_report", _report_sql())
def q_performance_report(spark, d):
    return C.performance_report(clf_frame(spark, d), "target", "pred", "pscore", G, 50)


# --------------------------------------------------------------------------- E16-E19


@register(
    "survival_mae",
    f"""WITH b AS ({SURV_SQL})
SELECT o_orderpriority, round(avg(CASE WHEN e = 1 THEN abs(t - p) WHEN e = 0 AND p < t THEN t - p ELSE 0 END), 6) AS mae
FROM b GROUP BY o_orderpriority""",
)
def q_survival_mae(spark, d):
    return round6(S.survival_mae(surv_frame(spark, d), "t", "e", "p", SG))


_CONC_SQL = f"""WITH b AS ({SURV_SQL}),
c AS (SELECT o_orderpriority, t, e, p, count(*) AS m FROM b GROUP BY ALL),
pr AS (
  SELECT i.o_orderpriority,
         sum(i.m * j.m) AS pairs,
         sum(i.m * j.m) FILTER (WHERE i.p < j.p) AS concordant,
         sum(i.m * j.m) FILTER (WHERE i.p = j.p) AS tied
  FROM c i JOIN c j ON i.o_orderpriority = j.o_orderpriority AND i.e = 1
                    AND (i.t < j.t OR (i.t = j.t AND j.e = 0))
  GROUP BY i.o_orderpriority)
"""


@register(
    "concordance",
    _CONC_SQL
    + """SELECT o_orderpriority, CAST(pairs AS BIGINT) AS pairs, CAST(coalesce(concordant, 0) AS BIGINT) AS concordant,
       CAST(coalesce(tied, 0) AS BIGINT) AS tied,
       round((coalesce(concordant, 0) + coalesce(tied, 0) / 2.0) / pairs, 6) AS c_index FROM pr""",
)
def q_concordance(spark, d):
    return round6(S.concordance(surv_frame(spark, d), "t", "e", "p", SG))


_KM_SQL = f"""WITH b AS ({SURV_SQL}),
pt AS (SELECT o_orderpriority, t AS time, count(*) AS removed, CAST(sum(e) AS BIGINT) AS deaths FROM b GROUP BY ALL),
rk AS (SELECT *, sum(removed) OVER (PARTITION BY o_orderpriority ORDER BY time DESC ROWS UNBOUNDED PRECEDING) AS at_risk
       FROM pt),
lt AS (SELECT *, CASE WHEN deaths = 0 THEN 0.0 WHEN at_risk = deaths THEN '-inf'::DOUBLE
                      ELSE ln(at_risk - deaths) - ln(at_risk) END AS l FROM rk),
km AS (SELECT *, exp(sum(l) OVER (PARTITION BY o_orderpriority ORDER BY time ROWS UNBOUNDED PRECEDING)) AS survival
       FROM lt)
"""


@register(
    "km_curve",
    _KM_SQL
    + "SELECT o_orderpriority, time, CAST(at_risk AS BIGINT) AS at_risk, deaths, removed, round(survival, 6) AS survival FROM km",
)
def q_km_curve(spark, d):
    return round6(S.km_curve(surv_frame(spark, d), "t", "e", SG))


@register(
    "km_median",
    _KM_SQL
    + "SELECT o_orderpriority, coalesce(min(time) FILTER (WHERE survival <= 0.5 + 1e-9), 'inf'::DOUBLE)::DOUBLE AS km_median "
    "FROM km GROUP BY o_orderpriority",
)
def q_km_median(spark, d):
    return S.km_median(surv_frame(spark, d), "t", "e", SG)


@register(
    "survival_report",
    _KM_SQL
    + """, kmm AS (SELECT o_orderpriority, coalesce(min(time) FILTER (WHERE survival <= 0.5 + 1e-9), 'inf'::DOUBLE)::DOUBLE AS km_med
        FROM km GROUP BY o_orderpriority),
c AS (SELECT o_orderpriority, t, e, p, count(*) AS m FROM b GROUP BY ALL),
pr AS (
  SELECT i.o_orderpriority, sum(i.m * j.m) AS pairs,
         coalesce(sum(i.m * j.m) FILTER (WHERE i.p < j.p), 0) AS concordant,
         coalesce(sum(i.m * j.m) FILTER (WHERE i.p = j.p), 0) AS tied
  FROM c i JOIN c j ON i.o_orderpriority = j.o_orderpriority AND i.e = 1
                    AND (i.t < j.t OR (i.t = j.t AND j.e = 0))
  GROUP BY i.o_orderpriority),
base AS (
  SELECT o_orderpriority, count(*) AS n_observations, avg(t) AS avg_months, quantile_cont(t, 0.5) AS median_months,
         avg(e) AS event_rate, avg(p) AS avg_predicted_months, quantile_cont(p, 0.5) AS median_predicted_months,
         avg(CASE WHEN e = 1 THEN abs(t - p) WHEN e = 0 AND p < t THEN t - p ELSE 0 END) AS mae
  FROM b GROUP BY o_orderpriority HAVING count(*) > 50)
SELECT o_orderpriority, n_observations, round_even(avg_months, 3) AS avg_months,
       round_even(median_months, 3) AS median_months, round_even(km_med, 3) AS km_median_surv_months,
       round_even(event_rate, 3) AS event_rate, round_even(avg_predicted_months, 3) AS avg_predicted_months,
       round_even(median_predicted_months, 3) AS median_predicted_months, round_even(mae, 3) AS mae,
       round_even((concordant + tied / 2.0) / pairs, 3) AS c_index
FROM base JOIN kmm USING (o_orderpriority) JOIN pr USING (o_orderpriority)""",
)
def q_survival_report(spark, d):
    return S.survival_report(surv_frame(spark, d), "t", "e", "p", SG, 50)
