import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.operators import classification as C


def _row(df):
    return df.collect()[0].asDict()


def test_fixture_metrics(clf_df):
    m = _row(C.classification_metrics(clf_df, "target", "prediction", "probability"))
    assert m["balanced_accuracy"] == pytest.approx(0.6)
    assert m["mcc"] == pytest.approx(0.2)
    assert m["precision"] == pytest.approx(0.6)
    assert m["recall"] == pytest.approx(0.6)
    assert m["f1"] == pytest.approx(0.6)
    assert m["roc_auc"] == pytest.approx(0.84)
    assert m["pr_auc"] == pytest.approx(0.8647619047619047)
    assert m["brier_score"] == pytest.approx(0.1845)
    assert m["ece"] == pytest.approx(0.36)


def test_confusion_counts(clf_df):
    c = _row(C.confusion(clf_df, "target", "prediction"))
    assert (c["tp"], c["tn"], c["fp"], c["fn"]) == (3, 3, 2, 2)
    assert c["tp_perc"] == pytest.approx(30.0)


@pytest.mark.parametrize(
    "y,p,expected",
    [([0, 0, 0, 0], [1, 1, 1, 1], 0.0), ([0, 1, 0, 1], [0, 1, 0, 1], 1.0), ([0, 1, 0, 1], [1, 0, 1, 0], -1.0)],
)
def test_mcc_edges(spark, y, p, expected):
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    c = _row(C.confusion(df, "y", "p"))
    m = C.confusion_metrics(F.lit(c["tp"]), F.lit(c["tn"]), F.lit(c["fp"]), F.lit(c["fn"]))
    assert spark.range(1).select(m["mcc"].alias("m")).first()["m"] == pytest.approx(expected)


def test_prefix(clf_df):
    cols = C.classification_metrics(clf_df, "target", "prediction", "probability", prefix="val").columns
    assert all(c.startswith("val_") for c in cols)


def _brute_auc(y, s):
    pos = s[y == 1]
    neg = s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def _brute_pr_auc(y, s):
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    thresholds = np.unique(ss)[::-1]
    P = y.sum()
    pts = [(0.0, 1.0)]
    for t in thresholds:
        sel = ss >= t
        tp = ys[sel].sum()
        pts.append((tp / P, tp / sel.sum()))
    area = 0.0
    for (r0, p0), (r1, p1) in zip(pts, pts[1:]):
        area += (r1 - r0) * (p0 + p1) / 2
    return area


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_curves_against_brute_force(spark, buckets):
    rng = np.random.default_rng(3)
    n = 400
    g = rng.integers(0, 3, n)
    s = np.round(rng.random(n), 2)  # many ties
    y = (rng.random(n) < s * 0.8).astype(int)
    pdf = pd.DataFrame({"g": g, "s": s, "y": y})
    df = spark.createDataFrame(pdf)
    hist = C.score_histogram(df, ["g"], "y", "s")
    got = {r["g"]: r for r in C.curve_areas(hist, ["g"], buckets=buckets).collect()}
    for k in range(3):
        sub = pdf[pdf.g == k]
        assert got[k]["roc_auc"] == pytest.approx(_brute_auc(sub.y.values, sub.s.values))
        assert got[k]["pr_auc"] == pytest.approx(_brute_pr_auc(sub.y.values, sub.s.values))


def test_auc_symmetry(spark):
    rng = np.random.default_rng(5)
    s = rng.random(300)
    y = (rng.random(300) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y})).withColumn("r", 1 - F.col("s"))
    a = _row(C.curve_areas(C.score_histogram(df, [], "y", "s")))["roc_auc"]
    b = _row(C.curve_areas(C.score_histogram(df, [], "y", "r")))["roc_auc"]
    assert a == pytest.approx(1 - b)


def _np_ece(y, p, n_bins=10):
    edges = np.linspace(0, 1, n_bins + 1)
    total = 0.0
    for lo, hi in zip(edges[:-1], edges[1:]):
        m = (p > lo) & (p <= hi)
        if m.mean() > 0:
            total += abs(p[m].mean() - y[m].mean()) * m.mean()
    return total


def test_ece_edges_match_numpy(spark):
    p = np.array([0.0, 0.1, 0.2, 0.3, 0.30000000000000004, 0.7, 0.7000000000000001, 1.0, 0.55, 0.05])
    y = np.array([0, 1, 0, 1, 1, 0, 1, 1, 0, 0])
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y}))
    got = _row(C.ece(C.score_histogram(df, [], "y", "p")))["ece"]
    assert got == pytest.approx(_np_ece(y, p))


def test_deciles_match_pandas_qcut(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": range(500), "g": rng.integers(0, 2, 500), "s": np.round(rng.random(500) ** 2, 3)})
    df = spark.createDataFrame(pdf)
    got = C.score_deciles(df, "s", ["g"]).toPandas().set_index("id")["bin"]
    for k in (0, 1):
        sub = pdf[pdf.g == k]
        exp = pd.qcut(sub.s, q=10, labels=False, duplicates="drop")
        assert (got.loc[sub.id].values == exp.values).all()


def test_constant_score_has_no_bins(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(20)], "id int, s double")
    assert C.score_deciles(df, "s").where(F.col("bin").isNotNull()).count() == 0


def test_report_groups_and_minimum(clf_df):
    rep = C.performance_report(clf_df, "target", "prediction", "probability", ["group"], 3)
    assert sorted(r["group"] for r in rep.collect()) == ["A", "B"]
    assert rep.columns[: len(C.REPORT_COLUMNS) + 1] == ["group", *C.REPORT_COLUMNS]
    one = C.performance_report(clf_df, "target", "prediction", "probability", None, 3).collect()
    assert len(one) == 1 and one[0]["fake_group"] == 1 and one[0]["n_observations"] == 10
    assert one[0]["mcc"] == pytest.approx(0.2) and one[0]["roc_auc"] == pytest.approx(0.84)
    empty = C.performance_report(clf_df, "target", "prediction", "probability", ["group"], 5)
    assert empty.count() == 0 and "roc_auc" in empty.columns


def test_report_unknown_grouping(clf_df):
    rep = C.performance_report(clf_df, "target", "prediction", "probability", ["group", "nope"], 3)
    assert "nope" not in rep.columns
    with pytest.raises(ValueError):
        C.performance_report(clf_df, "target", "prediction", "probability", ["nope"], 3)


def test_single_class_group_metrics_are_null(spark):
    df = spark.createDataFrame([(0, 0, i / 10, "a") for i in range(10)], "t int, p int, s double, g string")
    r = _row(C.performance_report(df, "t", "p", "s", ["g"], 3))
    assert r["roc_auc"] is None and r["mcc"] is None and r["n_observations"] == 10


def test_partition_count_does_not_change_results(spark, clf_df):
    out = []
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(sorted(map(tuple, C.performance_report(clf_df, "target", "prediction", "probability", ["group"], 3).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


def test_decile_summary_matches_pandas_with_ties(spark):
    rates = pd.DataFrame({"g": ["a"] * 7, "bin": range(7), "target_rate": [0.1, 0.3, 0.3, 0.2, 0.5, 0.5, 0.9]})
    got = C.decile_summary(spark.createDataFrame(rates), ["g"]).first()
    assert got["number_deciles"] == 7
    assert got["rank_correlation"] == pytest.approx(rates[["bin", "target_rate"]].corr(method="spearman").iloc[0, 1])
    assert got["target_bin_correlation"] == pytest.approx(rates[["bin", "target_rate"]].corr().iloc[0, 1])
    top = [got["first_decile_target_rate"], got["second_decile_target_rate"], got["third_decile_target_rate"]]
    assert top == [0.9, 0.5, 0.5]
    few = C.decile_summary(spark.createDataFrame(rates.head(4)), ["g"]).first()
    assert few["rank_correlation"] is None and few["number_deciles"] == 4
