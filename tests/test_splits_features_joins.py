import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.operators import features as FE
from lakeworks.operators import joins as J
from lakeworks.operators import reports as RP
from lakeworks.operators import splits as SP


def test_time_split_matches_the_day_rule(spark):
    rng = np.random.default_rng(1)
    days = pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 400, 500), unit="D")
    pdf = pd.DataFrame({"id": range(500), "d": days})
    ordered = pdf["d"].sort_values(ignore_index=True)
    pos = (len(ordered) - 1) * 0.7
    lo, hi, f = ordered[int(pos)], ordered[int(pos) + 1], pos - int(pos)
    gap = (hi - lo).days  # whole days only: the cutoff is a date
    cut = lo + pd.Timedelta(days=int(gap * f)) if f < 0.5 else hi - pd.Timedelta(days=int(gap * (1 - f)))
    df = spark.createDataFrame(pdf).withColumn("d", F.col("d").cast("timestamp_ntz"))
    train, test = SP.time_split(df, "d", 0.3)
    exp_train = set(pdf.loc[pdf.d < cut, "id"])
    got_train = {r["id"] for r in train.collect()}
    got_test = {r["id"] for r in test.collect()}
    assert got_train == exp_train and got_train.isdisjoint(got_test) and len(got_train | got_test) == 500
    with pytest.raises(ValueError):
        SP.time_split(df, "d", 1.0)
    capped, _ = SP.time_split(df, "d", 0.3, max_date="2020-06-01")
    assert capped.agg(F.max("d")).first()[0] < dt.datetime(2020, 6, 1)


def test_group_kfold_never_splits_ids(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"uid": rng.integers(0, 300, 3000), "y": rng.integers(0, 2, 3000)})
    df = spark.createDataFrame(pdf)
    for strata in (None, "y"):
        folds = SP.group_kfold(df, "uid", k=3, strata_col=strata).toPandas()
        assert folds.groupby("uid")["fold"].nunique().max() == 1
        sizes = folds["fold"].value_counts()
        assert set(sizes.index) == {0, 1, 2} and sizes.max() / sizes.min() < 1.3


def test_stratified_sample_keeps_whole_ids(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"uid": np.repeat(np.arange(400), 3), "t": np.tile([0, 1, 2], 400)})
    pdf["y"] = (pdf.uid % 4 == 0).astype(int)
    out = SP.stratified_id_sample(spark.createDataFrame(pdf), "uid", "y", 0.25, order_col="t").toPandas()
    per = out.groupby("uid").size()
    assert (per == 3).all()
    ids = set(per.index)
    assert len(ids) == 100 and sum(1 for i in ids if i % 4 == 0) == 25
    with pytest.raises(ValueError):
        SP.stratified_id_sample(spark.createDataFrame(pdf), "uid", "y", 1.0)


def test_feature_roles(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, 1.0, 0)], "cat_col1 string, cat_col2 string, num_col1 long, num_col2 double, target long"
    )
    assert FE.feature_roles(df, "target") == (["cat_col1", "cat_col2"], ["num_col1", "num_col2"])


def test_screening(spark):
    df = spark.createDataFrame(
        [(1, "a", float("nan"), 1, i % 2, i * 1.0, i * 2.0 + 1) for i in range(50)] + [(1, None, 1.0, 0, 1, 50.0, 101.0)],
        "k int, c string, f double, b int, b2 int, x double, y double",
    )
    miss = {r["column"]: r["n_missing"] for r in FE.missing_profile(df).collect()}
    assert miss == {"c": 1, "f": 50}
    filled = FE.fill_categoricals(df, ["c", "f"]).where(F.col("c") == "None").first()
    assert filled is not None
    assert FE.constant_features(df, ["k", "c", "b2"]) == ["k", "c"]  # NULLs do not count as a value
    prof = {r["feature"]: r for r in FE.binary_profile(df, ["b", "b2", "x"], 30).collect()}
    assert prof["b"]["n_ones"] == 50 and not prof["b"]["rare"]
    assert prof["b2"]["n_ones"] == 26 and prof["b2"]["rare"] and not prof["x"]["is_binary"]
    pairs = {(r["feature_a"], r["feature_b"]): r for r in FE.correlation_pairs(df, ["x", "y", "k"]).collect()}
    assert pairs[("x", "y")]["correlated"] and pairs[("x", "k")]["corr"] is None


def test_score_bin_table_and_trend(spark):
    rng = np.random.default_rng(9)
    s = rng.random(1000)
    pdf = pd.DataFrame({"s": s, "y": (rng.random(1000) < s).astype(int)})
    tab = RP.score_bin_table(spark.createDataFrame(pdf), "s", "y").orderBy("bin").toPandas()
    exp = pdf.groupby(pd.qcut(pdf.s, 10, labels=False, duplicates="drop"))["y"].mean().values
    assert np.allclose(tab["target_mean"].values, exp) and list(tab["bin"]) == list(range(1, 11))
    assert tab["top_bin_improvement"].iloc[0] == pytest.approx((exp[-1] - pdf.y.mean()) / pdf.y.mean())
    ev = spark.createDataFrame(
        [(dt.datetime(2024, 1, 5), 1.0, "a"), (dt.datetime(2024, 1, 20), 3.0, "a"), (dt.datetime(2024, 2, 1), 5.0, "b")],
        "ts timestamp_ntz, v double, h string",
    )
    trend = {(r["month"].month, r["h"]): r["mean_v"] for r in RP.trend_monthly(ev, "ts", "v", "h").collect()}
    assert trend == {(1, "a"): 2.0, (2, "b"): 5.0}


def _events(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    base = pd.Timestamp("2024-01-01")
    pdf = pd.DataFrame(
        {
            "eid": range(n),
            "user": rng.integers(0, 5, n),
            "ts": base + pd.to_timedelta(rng.integers(0, 5 * 86400, n), unit="s"),
            "kind": rng.choice(["buy", "view"], n),
            "v": rng.random(n),
        }
    )
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return pdf, df


@pytest.mark.parametrize("buckets", [1, 5, None])
def test_asof_join_against_merge_asof(spark, buckets):
    pdf, df = _events(spark)
    buys = df.where(F.col("kind") == "buy").select("user", F.col("ts").alias("bts"), F.col("eid").alias("buy_id"))
    got = J.asof_join(df.select("eid", "user", "ts"), buys, ["user"], "ts", "bts", ["buy_id"], buckets=buckets)
    got = {r["eid"]: r["buy_id"] for r in got.collect()}
    left = pdf.sort_values("ts")
    right = pdf[pdf.kind == "buy"][["user", "ts", "eid"]].rename(columns={"eid": "buy_id"}).sort_values("ts")
    exp = pd.merge_asof(left, right, on="ts", by="user", direction="backward", allow_exact_matches=True)
    for eid, bid in zip(exp.eid, exp.buy_id):
        assert got[eid] == (None if pd.isna(bid) else int(bid))


def test_range_join_against_brute_force(spark):
    pdf, df = _events(spark, 300, 6)
    probe = df.select(F.col("eid").alias("p"), "user", F.col("ts").alias("pts"))
    build = df.select(F.col("eid").alias("b"), "user", F.col("ts").alias("bts"))
    got = J.range_join(probe, build, ["user"], "pts", "bts", 7200, 600, bucket_seconds=1800)
    got = sorted((r["p"], r["b"]) for r in got.collect())
    exp = []
    for a in pdf.itertuples():
        for b in pdf.itertuples():
            if a.user == b.user and a.ts - pd.Timedelta(seconds=7200) <= b.ts < a.ts + pd.Timedelta(seconds=600):
                exp.append((a.eid, b.eid))
    assert got == sorted(exp)


def test_feature_elimination_tasks(spark):
    rng = np.random.default_rng(12)
    n = 600
    x1, x2, noise = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    cat = rng.choice(["a", "b"], n)
    y = (x1 + 0.5 * x2 + rng.normal(scale=0.3, size=n) > 0).astype(int)
    t = np.exp(1 + 0.8 * x1 + rng.normal(scale=0.2, size=n))
    e = (rng.random(n) < 0.7).astype(int)
    pdf = pd.DataFrame({"x1": x1, "x2": x2, "noise": noise, "cat": cat, "y": y, "t": t, "e": e})
    df = spark.createDataFrame(pdf)
    chosen, curve = FE.feature_elimination(df, "y", ["cat"], ["x1", "x2", "noise"], steps=2, max_iter=5, forced=["x1"])
    assert "x1" in chosen and curve.count() == 2
    chosen_s, curve_s = FE.feature_elimination(
        df, "t", [], ["x1", "x2", "noise"], task="survival", event_col="e", steps=2, n_features=2
    )
    assert len(chosen_s) == 2 and "x1" in chosen_s
    assert all(0 <= r["loss"] <= 1 for r in curve_s.collect())


def test_remote_options_and_read(spark, tmp_dir):
    from lakeworks.sources import remote as R

    opts = R.source_options("myorg-acct", "me", database="db", token="tok", password="pw", extra={"sfRole": "r2", "x": None})
    assert opts == {"sfUrl": "myorg-acct.snowflakecomputing.com", "sfUser": "me", "sfDatabase": "db",
                    "sfAuthenticator": "oauth", "sfToken": "tok", "sfRole": "r2"}
    assert R.source_options("https://h.example.com/", "me", password="pw")["sfPassword"] == "pw"
    with pytest.raises(ValueError):
        R.source_options("acct", "me", authenticator="externalbrowser")
    with pytest.raises(ValueError):
        R.source_options(None, "me")
    # the read path (wrap, lower-case, decimals) checked with a file source that ignores "query"
    import os

    path = os.path.join(tmp_dir, "remote")
    spark.sql("SELECT CAST(7 AS DECIMAL(38,0)) AS USER_ID, CAST(1.25 AS DECIMAL(10,2)) AS Score").write.parquet(path)
    df = R.read_query(spark, "-- c\nSELECT 1;", "parquet", {"path": path})
    assert df.columns == ["user_id", "score"] and df.first()["user_id"] == 7
    assert dict(df.dtypes) == {"user_id": "bigint", "score": "double"}


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(1, None, 10.0), (2, 7, 10.0), (3, 7, None), (4, 8, 10.0)], "i int, k int, t double")
    right = spark.createDataFrame([(None, 1.0, "x"), (7, 2.0, "y"), (7, None, "z")], "k int, u double, v string")
    at = lambda df, c: df.withColumn(c, F.timestamp_seconds(c).cast("timestamp_ntz"))
    left, right = at(left, "t"), at(right, "u")
    got = {r["i"]: r["v"] for r in J.asof_join(left, right, ["k"], "t", "u", ["v"]).collect()}
    assert got == {1: None, 2: "y", 3: None, 4: None}
    count = {"n": lambda c, w: F.count(c("one")).over(w)}
    got = J.range_aggregate(left.where("t IS NOT NULL"), right, ["k"], "t", "u", 3600, count, {"one": F.lit(1)})
    assert {r["i"]: r["n"] for r in got.collect()} == {1: 0, 2: 1, 4: 0}


def test_asof_spreads_a_key_with_one_day(spark):
    """All events of one key within a second: the ranges of time follow the rows, so no task holds them all."""
    ev = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_micros(F.col("id") * 40).cast("timestamp_ntz").alias("t"), "id")
    buys = ev.where("id % 10 = 0").select("k", F.col("t").alias("u"), F.col("id").alias("buy"))
    out = J.asof_join(ev, buys, ["k"], "t", "u", ["buy"])
    assert out.where("buy <> id - id % 10").count() == 0 and out.count() == 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would put so few rows together again
    try:
        sizes = [r["count"] for r in J.asof_join(ev, buys, ["k"], "t", "u", ["buy"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 8_000 and sum(sizes) == 20_000


def test_sample_keeps_rows_without_an_id(spark):
    rows = [(i, 1) for i in (None, 1, 2, 3, 4) for _ in range(3)]
    df = spark.createDataFrame(rows, "id int, y int")
    assert SP.stratified_id_sample(df, "id", "y", 0.99).count() == 15


def test_stratified_folds_balance_classes(spark):
    """Ids that mix classes: every fold gets each class's share of the rows, to two hundredths."""
    rng = np.random.default_rng(4)
    rows = [(i, "abc"[rng.choice(3, p=[0.6, 0.3, 0.1])]) for i in range(600) for _ in range(rng.integers(1, 9))]
    rows += [(None, "a")] * 3
    got = SP.group_kfold(spark.createDataFrame(rows, "id int, c string"), "id", k=4, strata_col="c").toPandas()
    assert len(got) == len(rows) and got.groupby("id", dropna=False).fold.nunique().max() == 1
    whole = got.c.value_counts(normalize=True)
    for _, part in got.groupby("fold"):
        share = part.c.value_counts(normalize=True)
        assert (share - whole).abs().max() < 0.02 and abs(len(part) / len(got) - 0.25) < 0.02


@pytest.mark.parametrize("block", [3, 512])
def test_correlations_of_wide_frames(spark, block, monkeypatch):
    from lakeworks.operators import features as FE

    monkeypatch.setattr(FE, "CORRELATION_BLOCK", block)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(400, 8)) + 1e6, columns=[f"c{i}" for i in range(8)])
    pdf["c1"] = pdf.c0 * 2 + rng.normal(size=400) * 0.1
    pdf.iloc[::7, 2] = np.nan
    pdf.iloc[1::5, 3] = np.nan
    pdf["c4"] = 5.0
    pdf.iloc[0, 5] = np.nan
    got = FE.correlation_pairs(spark.createDataFrame(pdf), list(pdf.columns)).collect()
    want = pdf.corr()
    assert len(got) == 28
    for r in got:
        w = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["corr"] is None) == np.isnan(w) and (np.isnan(w) or abs(r["corr"] - w) < 1e-6)
        assert bool(r["correlated"]) == ({r["feature_a"], r["feature_b"]} == {"c0", "c1"})
