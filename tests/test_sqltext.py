import pytest

from lakeworks.functions import sqltext as Q


def test_template_skips_comments():
    assert Q.render_template("SELECT {n}  -- keep {not_a_var}\nFROM t", n=1) == "SELECT 1  -- keep {not_a_var}\nFROM t"
    assert Q.render_template("SELECT 1 /* {x} */ , {n}", n=2) == "SELECT 1 /* {x} */ , 2"


def test_template_substitutes_string_literals():
    out = Q.render_template("WHERE d BETWEEN '{start}' AND '{end}'", start="2024-01-01", end="2024-02-01")
    assert out == "WHERE d BETWEEN '2024-01-01' AND '2024-02-01'"
    assert Q.render_template("SELECT 'a -- b' AS v, {n} AS n", n=1) == "SELECT 'a -- b' AS v, 1 AS n"


def test_template_escapes_and_errors():
    assert Q.render_template("SELECT {n} AS {{lit}}", n=1) == "SELECT 1 AS {lit}"
    with pytest.raises(KeyError):
        Q.render_template("SELECT {missing}", n=1)
    assert Q.render_template("SELECT '{\"a\": 1}'") == "SELECT '{\"a\": 1}'"
    with pytest.raises(ValueError):
        Q.resolve_query("SELECT {missing}", n=1)


def test_strip_and_detect_comments():
    text = "SELECT 1 -- c\n, '--x' /* b\nlock */ FROM t  "
    assert Q.has_comments(text)
    assert not Q.has_comments("SELECT '--not' AS a")
    assert Q.strip_comments(text) == "SELECT 1\n, '--x'\n FROM t"


def test_split_statements():
    parts = Q.split_statements("CREATE TEMP TABLE tmp AS SELECT 1; SELECT * FROM tmp")
    assert parts == ["CREATE TEMP TABLE tmp AS SELECT 1", "SELECT * FROM tmp"]
    assert Q.split_statements("SELECT ';' AS a; -- x; y\nSELECT 2;") == ["SELECT ';' AS a", "-- x; y\nSELECT 2"]
    assert Q.split_statements(" ; ; ") == []


@pytest.mark.parametrize(
    "stmt,rows",
    [
        ("SELECT 1", True),
        ("with a as (select 1) select * from a", True),
        ("(SELECT 1)", True),
        ("SELECT * INTO b FROM a", False),
        ("INSERT INTO t SELECT 1", False),
        ("CREATE TABLE t AS SELECT 1", False),
        ("SELECT into_field FROM into_table", True),
        ("-- lead\nSELECT 1", True),
        ("SELECT a /* INTO x */ FROM t", True),
        ("WITH c AS (SELECT 1 AS a) SELECT a INTO t2 FROM c", False),
        ("DROP TABLE t", False),
    ],
)
def test_returns_rows(stmt, rows):
    assert Q.returns_rows(stmt) is rows


def test_wrap_and_dialect():
    assert Q.wrap_subquery("-- c\nSELECT 1;") == "SELECT * FROM (\n-- c\nSELECT 1\n) AS lakeworks_query"
    assert Q.wrap_subquery("  ") == "  "
    assert Q.spark_dialect("CREATE TEMP TABLE x AS SELECT 1").startswith("CREATE OR REPLACE TEMP VIEW x AS")
    assert Q.spark_dialect("SELECT 1") == "SELECT 1"


def test_resolve_query_reads_files(tmp_dir):
    import os

    path = os.path.join(tmp_dir, "q.sql")
    with open(path, "w") as fh:
        fh.write("SELECT {n} -- {c}")
    assert Q.resolve_query(path, n=3) == "SELECT 3 -- {c}"
    with pytest.raises(FileNotFoundError):
        Q.resolve_query(os.path.join(tmp_dir, "missing.sql"))
