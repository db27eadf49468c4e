"""Inputs that once lost rows or gave wrong answers, written to files and read back where that matters."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeworks.functions import cells, sqltext
from lakeworks.operators import common, features, joins, splits, survival
from lakeworks.plans import sql, tables
from lakeworks.session import scratch_table, stored, work_dir
from lakeworks.sources import files, remote


# ------------------------------------------------------------------ running totals: one algorithm


@pytest.mark.parametrize("buckets", [None, 1, 4, 64])
@pytest.mark.parametrize("parts", [1, 4, 64])
def test_running_totals_do_not_depend_on_the_layout(spark, buckets, parts):
    rows = [("a" if k % 3 else None, float(k * 7 % 101) / 4, k % 5 + 1) for k in range(101)] + [("b", None, 3)]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(parts)
    got = common.running_totals(df, ["g"], "x", ["n"], buckets=buckets, totals_prefix="tot_").collect()
    for r in got:
        group = [(x, n) for g, x, n in rows if g == r["g"]]
        low = [n for x, n in group if x is None or (r["x"] is not None and x <= r["x"])]
        assert r["cum_n"] == sum(low) and r["tot_n"] == sum(n for _, n in group)
    down = common.running_totals(df.where("x is not null"), [], "x", ["n"], buckets=buckets, descending=True).collect()
    assert all(r["cum_n"] == sum(n for _, x, n in rows if x is not None and x >= r["x"]) for r in down)


def test_survival_report_reads_its_input_few_times(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    rows = [(k % 2, float(k % 50 + 1), int(k % 3 > 0), float(k * 13 % 60)) for k in range(400)]
    spark.createDataFrame(rows, "g int, t double, e int, p double").write.parquet(path)
    out = survival.survival_report(spark.read.parquet(path), "t", "e", "p", ["g"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count(path) <= 3
    assert out.count() == 2


# ------------------------------------------------------------------ identity, splits


def test_identity_without_an_order_keeps_every_row(spark, tmp_dir):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        df = spark.range(100_000).groupBy((F.col("id") * 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        path = os.path.join(tmp_dir, "ids")
        tables.with_identity(df, "rid").write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    r = spark.read.parquet(path).agg(F.count("rid"), F.count_distinct("rid"), F.min("rid"), F.max("rid"), F.count_distinct("k")).first()
    assert tuple(r) == (100_000, 100_000, 1, 100_000, 100_000)


def test_folds_keep_rows_without_an_id(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (None, "x")], "id long, c string")
    for strata in (None, "c"):
        got = splits.group_kfold(df, "id", 3, strata_col=strata).collect()
        assert len(got) == 3
        assert len({r["fold"] for r in got if r["id"] is None}) == 1


def test_time_split_by_days(spark):
    def label(days, ratio=0.3):
        df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
        return [r["split"] for r in splits.time_split_labels(df, "d", ratio).orderBy("d").collect()]

    one, two = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 8)
    assert label([one, two], 0.7) == ["test", "test"]  # the cutoff falls on the first day
    assert label([one, two], 0.3) == ["train", "test"]
    assert label([one.replace(hour=h) for h in range(10)]) == ["test"] * 10
    assert label([None, one, dt.datetime(2024, 3, 1)]) == [None, "train", "test"]
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k * k % 17) for k in range(23)]
    got = label(days, 0.25)
    cut = pd.Series(sorted(d.date() for d in days))
    pos = (len(cut) - 1) * 0.75
    lo, hi, f = cut[int(pos)], cut[min(int(pos) + 1, len(cut) - 1)], pos - int(pos)
    gap = (hi - lo).days
    day = lo + dt.timedelta(days=int(gap * f)) if f < 0.5 else hi - dt.timedelta(days=int(gap * (1 - f)))
    assert got == ["train" if d.date() < day else "test" for d in sorted(days)]


def test_screening_of_null_and_constant_columns(spark):
    df = spark.createDataFrame([(0, None, 0, 1), (1, None, 0, 2), (0, None, 0, None)], "a int, b int, c int, d int")
    got = {r["feature"]: (r["is_binary"], r["rare"]) for r in features.binary_profile(df, df.columns, 30).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (False, False), "d": (False, False)}
    assert features.constant_features(df, df.columns) == ["c"]


def test_correlations_of_many_columns(spark):
    pdf = pd.DataFrame({f"c{k}": [((i * (k + 3)) % 17) / 3 if (i + k) % 11 else None for i in range(200)] for k in range(12)})
    pdf["same"] = 1.0
    got = features.correlation_pairs(spark.createDataFrame(pdf), list(pdf.columns)).collect()
    assert len(got) == 13 * 12 // 2
    want = pdf.corr()
    for r in got:
        expected = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["corr"] is None) if pd.isna(expected) else abs(r["corr"] - expected) < 1e-9


def test_elimination_by_ids_until_the_wanted_count(spark):
    rows = [(k // 3, int(k % 7 > 2), float(k % 7), float(k * 31 % 13), 1.0, int(k == 5)) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, good double, noise double, flat double, rare int")
    chosen, curve = features.feature_elimination(df, "y", [], ["good", "noise", "flat", "rare"], n_features=1, max_iter=3, id_col="id")
    assert chosen == ["good"]
    assert [r["n_features"] for r in curve.orderBy(F.desc("n_features")).collect()] == [2, 1]
    with pytest.raises(ValueError):
        features.feature_elimination(df.withColumn("t", F.lit(0)), "t", [], ["good"], task="survival", event_col="y")


def test_km_median_at_exactly_one_half(spark):
    for n, want in ((14, 7.0), (20, 10.0), (10, 5.0), (7, 4.0)):
        df = spark.createDataFrame([(float(k + 1), 1) for k in range(n)], "t double, e int")
        assert survival.km_median(df, "t", "e").first()["km_median"] == want


def test_range_aggregate_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(k % 3, base + dt.timedelta(minutes=k * k * 37 % 4000), float(k)) for k in range(120)]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz, v double")
    got = joins.range_aggregate(
        df, df.select("u", F.col("ts").alias("o"), "v"), ["u"], "ts", "o", 3600,
        {"n": lambda c, w: F.count(c("v")).over(w), "s": lambda c, w: F.sum(c("v")).over(w)}, {"v": F.col("v")},
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        inside = [v for u, t, v in rows if u == r["u"] and r["ts"] - dt.timedelta(hours=1) <= t < r["ts"]]
        assert r["n"] == len(inside) and (r["s"] or 0.0) == sum(inside)


# ------------------------------------------------------------------ files


def test_csv_rows_do_not_depend_on_the_columns_selected(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n1,10,  hi \n2,x,\n3,30,   \n4,40\n")
    types = {"a": "INT", "b": "INT", "c": "VARCHAR(9)"}
    with pytest.raises(ValueError, match="2 rows"):
        files.load_csv(spark, path, types)
    df = files.load_csv(spark, path, types, max_error=2)
    assert df.count() == 2 and [r["a"] for r in df.select("a").orderBy("a").collect()] == [1, 3]
    assert [r["c"] for r in df.orderBy("a").collect()] == ["  hi ", "   "]
    df = files.load_csv(spark, path, types, max_error=2, blanks_as_null=True)
    assert [r["c"] for r in df.orderBy("a").collect()] == ["  hi ", None]
    text = os.path.join(tmp_dir, "t.csv")
    with open(text, "w") as f:
        f.write("a,c\n1,\n2,NA\n")
    for empty, want in ((True, [None, None]), (False, ["", None])):
        df = files.load_csv(spark, text, {"a": "INT", "c": "VARCHAR(9)"}, empty_as_null=empty, null_as="NA")
        assert [r["c"] for r in df.orderBy("a").collect()] == want


@pytest.mark.parametrize("freq", ["M", "Q-DEC", "Q-JAN", "Y-DEC", "Y-JUN", "W-SUN", "W-WED", "D", "h", "min", "s", "ms"])
def test_period_starts(spark, freq):
    ordinals = [-100, -3, 0, 1, 5, 100, 200]
    df = spark.createDataFrame([(k,) for k in ordinals], "k long").select("k", files.period_start("k", freq).alias("t"))
    for r in df.collect():
        assert r["t"] == pd.Period(ordinal=r["k"], freq=freq).start_time.to_pydatetime(), (freq, r["k"])
    if freq == "M":
        with pytest.raises(ValueError):
            files.period_start("k", "B")


def test_listings_and_partition_folders(spark, tmp_dir):
    root = os.path.join(tmp_dir, "parts")
    df = spark.createDataFrame([(1, "a b:c"), (2, "x=y"), (3, "p+q")], "v int, k string")
    df.write.partitionBy("k").parquet(root)
    spark.range(1).write.parquet(os.path.join(root, "plain", "k=z"))
    assert files.list_files(spark, root, recursive=False, glob="*.parquet").count() == 0
    found = {r["partition_values"][0]["value"]: r["partition_path"] for r in files.list_partition_paths(spark, root).collect()}
    assert set(found) == {"a b:c", "x=y", "p+q"}
    assert all(os.path.isdir(p.removeprefix("file:")) for p in found.values())


# ------------------------------------------------------------------ tables


def test_replacing_writes_keep_the_layout(spark):
    name = scratch_table(spark, "layout")
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "id long, p string, v double")
    tables.save_table(df, name, comment="it's kept", optimize=True, partition_by=["p"])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'x')")

    def check(table):
        layout = tables.table_layout(spark, table)
        assert (layout["comment"], layout["partition_by"], layout["properties"].get("owner.team")) == ("it's kept", ["p"], "x")
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
        assert spark.table(table).count() == 2

    check(name)
    for _ in range(2):
        tables.save_table(df, name)
        check(name)
    tables.optimize_table(spark, name, "id,v,p")
    check(name)
    tables.upsert_table(spark, name, spark.createDataFrame([(2, "c", 9.0)], "id long, p string, v double"), ["id"])
    check(name)
    assert {tuple(r) for r in spark.table(name).select("id", "p", "v").collect()} == {(1, "a", 1.5), (2, "c", 9.0)}
    copy = scratch_table(spark, "copy")
    tables.copy_table(spark, name, copy)
    assert tables.table_layout(spark, copy)["partition_by"] == ["p"]
    with pytest.raises(ValueError, match="more than once"):
        tables.upsert_table(spark, name, df.unionByName(df), ["id"])


def test_appends_and_loads_never_lose_values_or_tables(spark, tmp_dir):
    name = scratch_table(spark, "strict")
    tables.save_table(spark.createDataFrame([(1,)], "v int"), name)
    with pytest.raises(Exception, match="(?i)overflow"):
        tables.save_table(spark.createDataFrame([(9_999_999_999,)], "v long"), name, mode="append")
    assert spark.table(name).count() == 1
    for option in ("drop_existing_table", "truncate_before_load"):
        with pytest.raises(Exception):
            tables.load_files_to_table(spark, name, os.path.join(tmp_dir, "missing"), **{option: True})
        assert spark.table(name).count() == 1
    path = os.path.join(tmp_dir, "new")
    spark.createDataFrame([(7,), (8,)], "v int").write.parquet(path)
    for option in ("drop_existing_table", "truncate_before_load"):
        tables.load_files_to_table(spark, name, path, **{option: True})
        assert sorted(r["v"] for r in spark.table(name).collect()) == [7, 8]
    with pytest.raises(ValueError, match="reserved"):
        tables.load_files_to_table(spark, name, path, reserved=["V"])


def test_external_table_over_decimals_and_escaped_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "ext's")
    df = spark.createDataFrame([(1, "a b:c"), (2, "it's")], "v int, k string").withColumn("d", F.lit("1.25").cast("decimal(10,2)"))
    df.write.partitionBy("k").parquet(root)
    name = scratch_table(spark, "ext")
    got = tables.external_table(spark, name, root, [("k", "VARCHAR(9)")])
    assert {(r["v"], r["k"], str(r["d"])) for r in got.collect()} == {(1, "a b:c", "1.25"), (2, "it's", "1.25")}


def test_work_dir_keeps_uris(spark):
    assert work_dir(spark)
    df = stored(spark.range(3), "probe")
    assert df.count() == 3


# ------------------------------------------------------------------ SQL text, cells, options


def test_lexer_knows_escapes_and_backticks(spark):
    assert sqltext.split_statements(r"SELECT 'it\'s; x' AS a; SELECT `a;b` FROM t") == [r"SELECT 'it\'s; x' AS a", "SELECT `a;b` FROM t"]
    assert sql.run_sql(spark, r"SELECT 'it\'s; x' AS a").first()["a"] == "it's; x"
    assert "--" in sqltext.strip_comments(r"SELECT '\' -- no comment', 1")


def test_any_statement_with_columns_returns_its_frame(spark):
    assert sql.run_sql(spark, "SHOW DATABASES").count() >= 1
    assert sql.run_sql(spark, "VALUES (1), (2)").count() == 2
    assert sql.run_sql(spark, "DESCRIBE FUNCTION abs").count() >= 1
    assert sql.run_sql(spark, "CREATE OR REPLACE TEMP VIEW v_none AS SELECT 1 AS a") is None


def test_isolated_queries_restore_registered_frames(spark):
    session = sql.FrameSession(spark)
    session.register("shared_frame", spark.range(5))
    got = session.query("SELECT count(*) AS n FROM shared_frame", {"shared_frame": spark.range(2)}, use_persistent=False)
    assert got.first()["n"] == 2
    assert session.query("SELECT count(*) AS n FROM shared_frame").first()["n"] == 5


def test_wrapping_keeps_comments():
    assert sqltext.wrap_subquery("SELECT 1; -- last", "q") == "SELECT * FROM (\nSELECT 1 -- last\n) AS q"
    assert sqltext.wrap_subquery("SELECT ';' ;;", "q") == "SELECT * FROM (\nSELECT ';'\n) AS q"
    assert sqltext.wrap_subquery("  ") == "  "


def test_cells_in_plain_digits_with_a_header(spark):
    df = spark.createDataFrame([(12345678.9,), (0.0001,), (1e7,), (-0.00025,), (1.5,)], "x double")
    assert [r["x"] for r in cells.to_cells(df).collect()] == ["12345678.9", "0.0001", "10000000.0", "-0.00025", "1.5"]
    assert cells.to_cells(df, include_headers=True).first()["x"] == "x"


def test_sign_in_precedence():
    o = remote.OPTION_NAMES
    opts = remote.source_options("acct", "me", token="t", password="p")
    assert opts[o["token"]] == "t" and opts[o["authenticator"]] == "oauth" and o["password"] not in opts
    opts = remote.source_options("acct", "me", password="p", private_key_pem="k")
    assert opts[o["private_key"]] == "k" and o["password"] not in opts
    with pytest.raises(ValueError):
        remote.source_options("acct", "me", authenticator="externalbrowser")


def test_capped_exports_measure_all_rows(spark, tmp_dir):
    name = scratch_table(spark, "exp")
    tables.save_table(spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("t")), name)
    for fmt, cap in (("parquet", 0.2), ("csv", 0.2), ("json", 0.2)):
        path = tables.export_query(spark, f"SELECT * FROM {name}", os.path.join(tmp_dir, fmt), fmt=fmt, max_file_size_mb=cap)
        sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
        assert len(sizes) > 2 and max(sizes) <= 1.2 * cap * 1024 * 1024


def _located(spark, table):
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return rows["Type"], rows["Location"]


def test_values_that_do_not_fit_raise(spark, tmp_dir):
    name = scratch_table(spark, "fit")
    spark.sql(f"CREATE TABLE {name} (a INT) USING parquet")
    wide = spark.createDataFrame([(9_999_999_999,)], "a long")
    with pytest.raises(Exception, match="(?i)overflow|cast"):
        tables.create_table_from_frame(wide, name, mode="append")
    wide.write.parquet(f"{tmp_dir}/wide")
    with pytest.raises(Exception, match="(?i)overflow|cast"):
        tables.load_files_to_table(spark, name, f"{tmp_dir}/wide")
    assert spark.table(name).count() == 0


def test_a_failed_first_load_leaves_no_table(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/rows")
    name = scratch_table(spark, "first")
    with pytest.raises(Exception):
        tables.load_files_to_table(spark, name, f"{tmp_dir}/rows", identity="rid", identity_order_by="nowhere")
    assert not spark.catalog.tableExists(name)
    tables.load_files_to_table(spark, name, f"{tmp_dir}/rows", identity="rid", identity_order_by="id")
    assert sorted(r["rid"] for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]


def test_external_tables_stay_external(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ext")
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(path)
    name = scratch_table(spark, "ext")
    tables.external_table(spark, name, path)
    before = _located(spark, name)
    tables.save_table(spark.table(name).where("id < 4"), name)
    tables.optimize_table(spark, name)
    tables.upsert_table(spark, name, spark.createDataFrame([(3, -1)], "id long, x long"), ["id"])
    assert _located(spark, name) == before and before[0] == "EXTERNAL"
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(0, 0), (1, 2), (2, 4), (3, -1)]
    with pytest.raises(ValueError, match="external"):
        tables.save_table(spark.range(3), name)


def test_overwrites_keep_column_comments_and_buckets(spark):
    name = scratch_table(spark, "kept")
    spark.sql(f"CREATE TABLE {name} (a LONG COMMENT 'the key', b LONG) USING parquet CLUSTERED BY (a) SORTED BY (b) INTO 4 BUCKETS COMMENT 'all'")
    tables.save_table(spark.range(20).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b")), name)
    layout = tables.table_layout(spark, name)
    assert layout["buckets"] == (4, ["a"], ["b"]) and layout["column_comments"] == {"a": "the key"} and layout["comment"] == "all"
    assert spark.table(name).count() == 20


def test_upsert_leaves_untouched_partitions_alone(spark):
    name = scratch_table(spark, "ups")
    rows = spark.range(60).select("id", F.col("id").alias("v"), F.when(F.col("id") % 4 < 3, (F.col("id") % 4).cast("string")).alias("p"))
    tables.save_table(rows, name, partition_by=["p"])
    files = lambda: {f: os.path.getmtime(f.removeprefix("file:")) for f in spark.table(name).inputFiles()}
    before = files()
    # new row in p=1; a key that moves from p=0 to p=1; a row of the NULL partition; all else stays
    source = spark.createDataFrame([(100, 5, "1"), (0, -1, "1"), (3, -3, None)], "id long, v long, p string")
    tables.upsert_table(spark, name, source, ["id"])
    got = {r["id"]: (r["v"], r["p"]) for r in spark.table(name).collect()}
    want = {r["id"]: (r["v"], r["p"]) for r in rows.collect()} | {100: (5, "1"), 0: (-1, "1"), 3: (-3, None)}
    assert got == want
    after = files()
    same = [f for f in before if "p=2" in f]
    assert same and all(after.get(f) == before[f] for f in same)
    assert not any(f in after for f in before if "p=1" in f or "p=0" in f)
    # a partition that loses all of its rows goes
    move = spark.table(name).where("p = '2'").withColumn("p", F.lit("9"))
    tables.upsert_table(spark, name, move, ["id"])
    assert {r["p"] for r in spark.table(name).select("p").distinct().collect()} == {"0", "1", "9", None}
    assert spark.table(name).count() == 61


def test_scratch_scopes_remove_what_was_stored(spark, clf_df):
    from lakeworks.operators import classification
    from lakeworks.session import run_folder, scratch_path, scratch_scope

    at = run_folder(spark).removeprefix("file:")
    held = lambda: set(os.listdir(at)) if os.path.isdir(at) else set()
    outside = stored(spark.range(2), "outside")
    before = held()
    with scratch_scope(spark) as paths:
        rows = classification.performance_report(clf_df, "target", "prediction", "probability", ["group"], 3).collect()
        inner = scratch_path(spark, "never-written")
        with scratch_scope(spark):
            stored(spark.range(2), "inner")
        assert len(rows) == 2 and held() > before and inner in paths
    assert held() == before and outside.count() == 2
    with pytest.raises(ValueError), scratch_scope(spark):
        stored(spark.range(2), "lost")
        raise ValueError
    assert held() == before


@pytest.mark.parametrize("header,escape", [(1, '"'), (3, "\\")])
def test_csv_records_with_line_breaks(spark, tmp_dir, header, escape):
    """Quoted breaks, blank lines and header lines, in files of one and of many blocks; quotes inside plain fields."""
    path = os.path.join(tmp_dir, f"csv{header}")
    os.makedirs(path)
    want = []
    for f in range(3):
        rows = [
            (f * 1000 + k, ["plain", "a\nb", 'say "x\n\n", y" now', "x, y", 'five " inches', "", "\n", 'end"\n'][k % 8 if f else k % 2 * 4], k / 2)
            for k in range(300)
        ]
        with open(os.path.join(path, f"{f}.csv"), "w", newline="") as out:
            out.write("id,note,x\n" + "more\n" * (header - 1))
            for i, note, x in rows:
                bare = not any(c in note for c in ",\n") and note[:1] != '"'
                field = note if bare else '"' + note.replace('"', escape + '"') + '"'
                out.write(f"{i},{field},{x}\n" + ("\n" if i % 7 == 0 else ""))
        want += [(i, note or None, x) for i, note, x in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("300b", old):  # blocks of about ten lines, and one block a file
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = files.load_csv(spark, path, {"id": "INT", "note": "VARCHAR(99)", "x": "DOUBLE"}, ignore_header=header, escape=escape)
            assert sorted((r["id"], r["note"], r["x"]) for r in got.collect()) == sorted(want)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_quotes_that_never_close(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(files, "MAX_RECORD_LINES", 20)
    with open(os.path.join(tmp_dir, "open.csv"), "w") as out:
        out.write("a,b\n1,\"x\n" + "2,y\n" * 50)
    with pytest.raises(ValueError, match="not closed"):
        files.load_csv(spark, os.path.join(tmp_dir, "open.csv"), {"a": "INT", "b": "VARCHAR(9)"})


def test_compaction_leaves_good_partitions_alone(spark):
    name = scratch_table(spark, "small")
    rows = spark.range(4000).select("id", F.md5(F.col("id").cast("string")).alias("t"), (F.col("id") % 3).cast("int").alias("p"))
    tables.save_table(rows.where("p = 0").coalesce(1), name, partition_by=["p"])
    for _ in range(2):
        tables.save_table(rows.where("p = 1").repartition(20), name, mode="append")
    tables.save_table(rows.where("p = 2").repartition(2), name, mode="append")
    files = lambda: {f: os.path.getmtime(f.removeprefix("file:")) for f in spark.table(name).inputFiles()}
    before = files()
    size = next(os.path.getsize(f.removeprefix("file:")) for f in before if "p=0" in f)
    want = sorted(map(tuple, spark.table(name).collect()))
    target = size / 1024 / 1024 * 0.6  # the files of p=0 (one, as two would be smaller) and p=2 stay
    assert {r["p"]: r["files"] > r["bins"] for r in tables.partition_files(spark, name, int(target * 1024 * 1024)).collect()}[1]
    tables.optimize_table(spark, name, target_mb=target)
    after = files()
    assert sorted(map(tuple, spark.table(name).collect())) == want
    assert len([f for f in after if "p=1" in f]) < 8 < len([f for f in before if "p=1" in f])
    assert all(after.get(f) == before[f] for f in before if "p=1" not in f)
    tables.optimize_table(spark, name, target_mb=1024.0)
    assert all(r["files"] == 1 for r in tables.partition_files(spark, name, 1 << 30).collect())
    again = files()
    tables.optimize_table(spark, name, target_mb=1024.0)
    assert files() == again  # nothing left to do


def test_forced_external_table_is_built_before_the_old_one_goes(spark, tmp_dir, monkeypatch):
    for v in (1, 2):
        spark.range(6).select("id", (F.col("id") % 2).alias("p")).where(f"id < {v * 3}").write.partitionBy("p").parquet(f"{tmp_dir}/{v}")
    name = scratch_table(spark, "forced")
    tables.external_table(spark, name, f"{tmp_dir}/1", [("p", "INT")])
    assert spark.table(name).count() == 3
    real = tables.sync_partitions_from_files
    monkeypatch.setattr(tables, "sync_partitions_from_files", lambda *a: {"failed": ["p=0"]})
    with pytest.raises(RuntimeError):
        tables.external_table(spark, name, f"{tmp_dir}/2", [("p", "INT")], force=True)
    assert spark.table(name).count() == 3
    monkeypatch.setattr(tables, "sync_partitions_from_files", real)
    assert tables.external_table(spark, name, f"{tmp_dir}/2", [("p", "INT")], force=True).count() == 6
    assert spark.table(name).where("p = 1").count() == 3


def test_elimination_counts_rows_that_trees_cannot_tell_apart(spark, monkeypatch):
    """A round fits combinations of values with their number, and gets what the rows themselves give."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    rows = [("xyz"[k * 7 % 3], k % 11, float(k * k % 5), int(k % 11 + k * k % 5 + 3 * (k * 7 % 3 == 1) + k * 31 % 7 > 9)) for k in range(6000)]
    df = spark.createDataFrame(rows, "c string, a int, b double, y int")
    fitted, fit = [], GBTClassifier._fit

    def spy(self, train):
        fitted.append(train.count())
        return fit(self, train)

    monkeypatch.setattr(GBTClassifier, "_fit", spy)
    _, curve = features.feature_elimination(df, "y", ["c"], ["a", "b"], steps=1, max_iter=4, seed=7)
    monkeypatch.undo()
    indexed = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    whole = VectorAssembler(inputCols=["i", "a", "b"], outputCol="features").transform(indexed).withColumn("label", F.col("y").cast("double"))
    fold = F.pmod(F.xxhash64("c", "a", "b", F.lit(7)), F.lit(3))
    train, valid = whole.where(fold < 2), whole.where(fold == 2)
    model = GBTClassifier(maxIter=4, maxDepth=4, seed=7, maxBins=64).fit(train)
    want = 1 - BinaryClassificationEvaluator().evaluate(model.transform(valid))
    assert abs(curve.first()["loss"] - want) < 1e-9
    assert fitted[0] <= 2 * 3 * 11 * 5 * 2 < train.count()


def test_tree_cells_hold_every_row(spark):
    rows = [(0.0 if k % 2 else k / 7, float(k % 3) if k % 50 else None, float("nan") if k % 40 == 1 else float(k), k % 2) for k in range(4000)]
    df = spark.createDataFrame(rows, "zeros double, few double, gaps double, y int")
    numeric = ["zeros", "few", "gaps"]
    splits = features.tree_splits(df, numeric)
    assert set(splits) == {"zeros", "gaps"} and all(len(s) <= 65 for s in splits.values())
    cells = features.tree_cells(df, ["y"], numeric, splits)
    assert cells.agg(F.sum("_lw_n")).first()[0] == 4000
    assert {r["few"] for r in cells.select("few").distinct().collect()} == {None, 0.0, 1.0, 2.0}
    # half of the values are zero: alone in their bin; k = 0 is zero as well
    zero = [r["n"] for r in cells.groupBy("zeros").agg(F.sum("_lw_n").alias("n")).collect() if r["n"] > 1000]
    assert zero == [2001]
    last = cells.groupBy("gaps").agg(F.sum("_lw_n").alias("n")).orderBy(F.desc("gaps")).first()
    assert last["gaps"] == len(splits["gaps"]) - 1 and last["n"] == 100
    weighted = features.weighted_cells(cells, ["y", "zeros"])
    total = weighted.agg(F.sum("_lw_weight"), F.max("_lw_weight"), F.count("*")).first()
    distinct = weighted.select("y", "zeros").distinct().count()
    assert abs(total[0] - 4000) < 1e-6 and total[2] <= 2 * distinct and total[1] <= 4000 / distinct + 1


def test_concordance_places_subjects_in_strips_once(spark, monkeypatch):
    """Strips are searched in one stored step, not anew in the plan of each count; groups, ties and NaN as by brute force."""
    nan = float("nan")
    rows = [(g, float(k * 37 % 23), int(k % 3 > 0), nan if k % 29 == 0 else float(k * k % 17) / 2) for g in ("a", "b", None) for k in range(160 if g != "b" else 12)]
    df = spark.createDataFrame(rows, "g string, t double, e int, p double")
    steps, keep = [], survival.stored

    def spy(frame, label):
        steps.append(label)
        return keep(frame, label)

    monkeypatch.setattr(survival, "stored", spy)
    out = survival.concordance(df, "t", "e", "p", ["g"], strip_rows=20)
    assert steps.count("placed") == 1
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    rank = lambda p: (p != p, 0.0 if p != p else p)
    for r in out.collect():
        group = [x[1:] for x in rows if x[0] == r["g"]]
        pairs = [(rank(p), rank(q)) for t, e, p in group for u, f, q in group if e == 1 and (t < u or (t == u and f == 0))]
        assert r["pairs"] == len(pairs) and r["concordant"] == sum(p < q for p, q in pairs) and r["tied"] == sum(p == q for p, q in pairs)


def test_approximate_distinct_keeps_no_sketch_per_value(spark, tmp_dir):
    """The sketch is kept per flag, not per flag and part beside the exact count; a NULL flag is a group."""
    import __spark_entry__ as entry

    folder = os.path.join(tmp_dir, "approx")
    rows = [("ARN"[k % 3] if k % 10 else None, k * 7 % 90 if k % 4 else None) for k in range(900)] + [("Z", None)]
    spark.createDataFrame(rows, "l_returnflag string, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    out = entry.queries()["sql_approx_distinct"](spark, folder)
    want = {f: len({p for g, p in rows if g == f and p is not None}) for f in ("A", "R", "N", None, "Z")}
    assert {r["l_returnflag"]: (r["n_parts"], r["approx_close"]) for r in out.collect()} == {f: (n, True) for f, n in want.items()}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    steps = [line for line in plan.splitlines() if "approx_count_distinct(" in line]
    assert steps and not [line for line in steps if "l_partkey" in line.split("functions=")[0]]
