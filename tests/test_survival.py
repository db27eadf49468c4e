import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.operators import survival as S


def _by_group(df, key="group"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_mae_fixture(surv_df):
    assert S.survival_mae(surv_df, "time", "event", "prediction").first()["mae"] == pytest.approx(2.8)
    g = _by_group(S.survival_mae(surv_df, "time", "event", "prediction", ["group"]))
    assert g["A"]["mae"] == pytest.approx(3.8) and g["B"]["mae"] == pytest.approx(1.8)


@pytest.mark.parametrize(
    "t,e,p,expected",
    [([10, 20], [1, 1], [10, 20], 0.0), ([10, 20], [0, 0], [5, 15], 5.0), ([10, 20], [0, 0], [15, 25], 0.0)],
)
def test_mae_edges(spark, t, e, p, expected):
    df = spark.createDataFrame(list(zip(t, e, p)), "t int, e int, p int")
    assert S.survival_mae(df, "t", "e", "p").first()["mae"] == pytest.approx(expected)


def test_mae_boolean_event(spark, surv_df):
    df = surv_df.withColumn("event", F.col("event") == 1)
    assert S.survival_mae(df, "time", "event", "prediction").first()["mae"] == pytest.approx(2.8)


def test_concordance_fixture(surv_df):
    assert S.concordance(surv_df, "time", "event", "prediction").first()["c_index"] == pytest.approx(21.5 / 27)
    g = _by_group(S.concordance(surv_df, "time", "event", "prediction", ["group"]))
    assert g["A"]["c_index"] == pytest.approx(4 / 6) and g["B"]["c_index"] == pytest.approx(1.0)


def _brute_concordance(t, e, p):
    pairs = conc = tied = 0.0
    n = len(t)
    for i in range(n):
        if e[i] != 1:
            continue
        for j in range(n):
            if i == j:
                continue
            if t[i] < t[j] or (t[i] == t[j] and e[j] == 0):
                pairs += 1
                if p[i] < p[j]:
                    conc += 1
                elif p[i] == p[j]:
                    tied += 1
    return (conc + tied / 2) / pairs


@pytest.mark.parametrize("buckets", [1, 4])
def test_concordance_brute_force_with_ties(spark, buckets):
    rng = np.random.default_rng(7)
    n = 150
    pdf = pd.DataFrame(
        {"g": rng.integers(0, 2, n), "t": rng.integers(0, 30, n), "e": rng.integers(0, 2, n), "p": rng.integers(0, 15, n)}
    )
    got = _by_group(S.concordance(spark.createDataFrame(pdf), "t", "e", "p", ["g"], buckets=buckets), "g")
    for k in (0, 1):
        sub = pdf[pdf.g == k]
        assert got[k]["c_index"] == pytest.approx(_brute_concordance(sub.t.values, sub.e.values, sub.p.values))


def test_dominance_counts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 40, 333):
        slot, value = rng.integers(0, max(1, n // 2), n), rng.integers(0, 9, n)
        deaths, weight = rng.integers(0, 3, n), rng.integers(1, 4, n)
        pairs = [(i, j) for i in range(n) for j in range(n) if slot[i] < slot[j]]
        less = sum(int(deaths[i] * weight[j]) for i, j in pairs if value[i] < value[j])
        equal = sum(int(deaths[i] * weight[j]) for i, j in pairs if value[i] == value[j])
        assert S.dominance(slot, value, deaths, weight) == (less, equal)
    big = np.array([1 << 40, 1 << 40])
    assert S.dominance(np.array([0, 1]), np.array([0, 1]), big, big) == (1 << 80, 0)


@pytest.mark.parametrize("strip_rows", [3, 20, 1000])
def test_concordance_strips(spark, strip_rows):
    """Groups cut into many strips, few, and none; a third of the subjects at one time, another third with one prediction."""
    rng = np.random.default_rng(8)
    n = 260
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "t": rng.integers(0, 50, n), "e": rng.integers(0, 2, n), "p": rng.random(n).round(2)})
    pdf.loc[pdf.index % 3 == 0, "t"] = 17
    pdf.loc[pdf.index % 3 == 1, "p"] = 0.5
    pdf["g"] = pdf["g"].astype("Int64").mask(pdf["g"] == 2)  # a NULL group counts as a group
    df = spark.createDataFrame([(None if pd.isna(r.g) else int(r.g), int(r.t), int(r.e), float(r.p)) for r in pdf.itertuples()], "g int, t int, e int, p double")
    got = {r["g"]: r for r in S.concordance(df, "t", "e", "p", ["g"], strip_rows=strip_rows).collect()}
    assert set(got) == {0, 1, None}
    for k, r in got.items():
        sub = pdf[pdf.g.isna()] if k is None else pdf[pdf.g == k]
        assert r["c_index"] == pytest.approx(_brute_concordance(sub.t.values, sub.e.values, sub.p.values), rel=1e-12)


def _brute_km_median(t, e):
    times = np.unique(t)
    s = 1.0
    for u in times:
        at_risk = (t >= u).sum()
        d = ((t == u) & (e == 1)).sum()
        if d:
            s *= 1 - d / at_risk
        if s <= 0.5:
            return float(u)
    return float("inf")


def test_km_median_fixture_and_brute(spark, surv_df):
    g = _by_group(S.km_median(surv_df, "time", "event", ["group"]))
    assert g["A"]["km_median"] == 30 and g["B"]["km_median"] == 32
    assert S.km_median(surv_df, "time", "event").first()["km_median"] == 30
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"t": rng.integers(1, 40, 300), "e": (rng.random(300) < 0.4).astype(int)})
    got = S.km_median(spark.createDataFrame(pdf), "t", "e").first()["km_median"]
    assert got == _brute_km_median(pdf.t.values, pdf.e.values)


def test_km_median_infinite_when_never_below_half(spark):
    df = spark.createDataFrame([(i, 1 if i == 1 else 0) for i in range(1, 11)], "t int, e int")
    assert S.km_median(df, "t", "e").first()["km_median"] == float("inf")


def test_survival_report(surv_df):
    g = _by_group(S.survival_report(surv_df, "time", "event", "prediction", ["group"], 3))
    assert g["A"]["n_observations"] == 5 and g["A"]["c_index"] == pytest.approx(0.667)
    assert g["B"]["km_median_surv_months"] == 32 and g["B"]["median_months"] == 22
    assert g["A"]["mae"] == pytest.approx(3.8)
    assert S.survival_report(surv_df, "time", "event", "prediction", ["group"], 5).count() == 0
