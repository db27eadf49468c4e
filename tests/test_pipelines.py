import os

import pytest

from lakeworks.plans import sql as P


def _folder(tmp_dir, yaml_files=None):
    for n in ("alpha", "beta", "gamma"):
        with open(os.path.join(tmp_dir, f"{n}.sql"), "w") as fh:
            fh.write(f"SELECT '{n}' AS step")
    for name, text in (yaml_files or {}).items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    return tmp_dir


def test_alphabetical_without_yaml(tmp_dir):
    assert list(P.sql_files(_folder(tmp_dir))) == ["alpha", "beta", "gamma"]


def test_yaml_steps_order_and_missing(tmp_dir):
    d = _folder(tmp_dir, {"pipeline.yaml": "steps:\n  - gamma\n  - alpha\n  - nope\n"})
    assert list(P.sql_files(d)) == ["gamma", "alpha"]


@pytest.mark.parametrize("text", ["steps: []\n", "just text\n", "other: 1\n", "steps: [\n"])
def test_bad_yaml_falls_back(tmp_dir, text):
    d = _folder(tmp_dir, {"pipeline.yaml": text})
    assert list(P.sql_files(d)) == ["alpha", "beta", "gamma"]


def test_named_pipeline_layouts(tmp_dir):
    d = _folder(
        tmp_dir,
        {
            "daily.yaml": "steps: [beta, alpha]\n",
            "pipelines.yaml": "pipelines:\n  daily:\n    steps: [gamma]\n  weekly:\n    steps: [gamma, beta]\n"
            "  listed_dummy: {}\n",
        },
    )
    assert list(P.sql_files(d, "daily")) == ["beta", "alpha"]
    assert list(P.sql_files(d, "weekly")) == ["gamma", "beta"]
    assert list(P.sql_files(d, "unknown")) == ["alpha", "beta", "gamma"]
    assert list(P.sql_files(d)) == ["alpha", "beta", "gamma"]  # several YAMLs, no name


def test_list_form_pipeline(tmp_dir):
    d = _folder(tmp_dir, {"p.yaml": "pipelines:\n  - name: nightly\n    steps: [gamma, alpha]\n"})
    assert list(P.sql_files(d, "nightly")) == ["gamma", "alpha"]


def test_resolve_inputs(tmp_dir):
    d = _folder(tmp_dir)
    one = os.path.join(d, "beta.sql")
    assert list(P.resolve_query_paths(one)) == ["beta"]
    assert list(P.resolve_query_paths([one, os.path.join(d, "alpha.sql")])) == ["beta", "alpha"]
    assert list(P.resolve_query_paths({"x": one})) == ["x"]


def test_run_sql_and_scripts(spark, tmp_dir):
    df = P.run_sql(spark, "CREATE TEMP TABLE tmp_a AS SELECT 1 AS a; SELECT a + {k} AS b FROM tmp_a", k=2)
    assert df.first()["b"] == 3
    assert P.run_sql(spark, "CREATE OR REPLACE TEMP VIEW v1 AS SELECT 1 AS a") is None
    d = _folder(tmp_dir)
    out = P.run_scripts(spark, d)
    assert out.first()["step"] == "gamma"
    with open(os.path.join(d, "delta.sql"), "w") as fh:
        fh.write("SELECT 1; SELECT nope FROM nowhere")
    with pytest.raises(RuntimeError, match="delta.*statement 2"):
        P.run_scripts(spark, d)


def test_pipeline_to_tables_names(spark, tmp_dir):
    from lakeworks.session import scratch_database

    import uuid

    d = _folder(tmp_dir)
    db = scratch_database(spark)
    tag = uuid.uuid4().hex[:8]  # the scratch folder outlives sessions: never reuse a table location
    frames = P.pipeline_to_tables(
        spark, d, schema=db, table_prefix=f"stg_{tag}_", table_names={"gamma": f"churn_daily_{tag}"}, return_all=True
    )
    assert set(frames) == {"alpha", "beta", "gamma"}
    assert spark.catalog.tableExists(f"{db}.stg_{tag}_alpha") and spark.catalog.tableExists(f"{db}.churn_daily_{tag}")
    assert spark.table(f"{db}.churn_daily_{tag}").first()["step"] == "gamma"


def test_frame_session_isolation(spark):
    fs = P.FrameSession(spark)
    frames = {"lw_iso_frame": spark.range(5)}
    assert fs.query("SELECT count(*) AS n FROM lw_iso_frame", frames, use_persistent=False).first()["n"] == 5
    assert not spark.catalog.tableExists("lw_iso_frame")
    fs.query("SELECT 1", {"lw_kept_frame": spark.range(2)})
    assert spark.catalog.tableExists("lw_kept_frame")
    assert fs.unregister("lw_kept_frame")
