"""The SQL surface the toolkit delegates to its engine (S1-S25), run through ``run_sql`` /
``FrameSession`` on the driver tables registered as views. Spark text and DuckDB twin differ
only where the dialects do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators.joins import asof_join, range_aggregate
from lakeworks.plans.sql import FrameSession, run_sql
from lakeworks.session import scratch_table
from lakeworks.suite import register, round6, table

def with_views(spark: SparkSession, d: str, *names: str) -> FrameSession:
    fs = FrameSession(spark)
    for n in names:
        fs.register(n, table(spark, d, n))
    return fs


def sql_query(name: str, spark_sql: str, duck_sql: str | None, tables: tuple[str, ...], rounded: bool = True):
    """Register a query whose Spark side is plain SQL over the named views."""

    def q(spark: SparkSession, d: str) -> DataFrame:
        with_views(spark, d, *tables)
        df = run_sql(spark, spark_sql)
        return round6(df) if rounded else df

    q.__name__ = f"q_{name}"
    register(name, duck_sql)(q)


# ----------------------------------------------------------------------------- S1, S2

sql_query(
    "sql_project",
    """SELECT * EXCEPT (l_shipdate, l_tax),
              round(l_extendedprice * (1 - l_discount), 6) AS disc_price,
              CASE WHEN l_quantity > 25 THEN 'big' WHEN l_quantity > 10 THEN 'mid' ELSE 'small' END AS size_class
       FROM lineitem""",
    """SELECT * EXCLUDE (l_shipdate, l_tax),
              round(l_extendedprice * (1 - l_discount), 6) AS disc_price,
              CASE WHEN l_quantity > 25 THEN 'big' WHEN l_quantity > 10 THEN 'mid' ELSE 'small' END AS size_class
       FROM lineitem""",
    ("lineitem",),
)

sql_query(
    "sql_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag
       FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP_NTZ '1996-01-01 00:00:00' AND TIMESTAMP_NTZ '1997-12-31 00:00:00'
         AND l_returnflag IN ('R', 'A') AND l_linestatus LIKE 'F%'
         AND l_discount IS NOT NULL AND NOT (l_quantity < 5 OR l_quantity > 45)""",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag
       FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00'
         AND l_returnflag IN ('R', 'A') AND l_linestatus LIKE 'F%'
         AND l_discount IS NOT NULL AND NOT (l_quantity < 5 OR l_quantity > 45)""",
    ("lineitem",),
)

# ----------------------------------------------------------------------------- S3-S6 joins

_JOIN_INNER = """SELECT n_name, r_name, count(*) AS n_lines,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
GROUP BY n_name, r_name"""
sql_query("sql_join_inner", _JOIN_INNER, _JOIN_INNER, ("lineitem", "orders", "customer", "nation", "region"))

_JOIN_OUTER = """SELECT c.c_custkey, count(o.o_orderkey) AS n_orders, round(coalesce(sum(o.o_totalprice), 0), 6) AS spent
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey"""
sql_query("sql_join_outer", _JOIN_OUTER, _JOIN_OUTER, ("customer", "orders"))

_JOIN_FULL = """SELECT coalesce(a.k, b.k) AS nationkey, CAST(a.n_customers AS DOUBLE) AS n_customers,
       CAST(b.n_suppliers AS DOUBLE) AS n_suppliers
FROM (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_acctbal > 5000 GROUP BY c_nationkey) a
FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY s_nationkey) b
ON a.k = b.k"""
sql_query("sql_join_full", _JOIN_FULL, _JOIN_FULL, ("customer", "supplier"))

sql_query(
    "sql_join_semi",
    """SELECT c_custkey, c_name FROM customer LEFT SEMI JOIN orders
       ON c_custkey = o_custkey AND o_totalprice > 300000""",
    """SELECT c_custkey, c_name FROM customer c
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)""",
    ("customer", "orders"),
)

sql_query(
    "sql_join_anti",
    """SELECT c_custkey, c_mktsegment FROM customer LEFT ANTI JOIN orders ON c_custkey = o_custkey""",
    """SELECT c_custkey, c_mktsegment FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""",
    ("customer", "orders"),
)

_THETA = """SELECT l_partkey, count(*) AS n_above_list, round(sum(l_extendedprice - p_retailprice * l_quantity), 2) AS excess
FROM lineitem JOIN part ON l_partkey = p_partkey AND l_extendedprice > p_retailprice * l_quantity * 0.5
GROUP BY l_partkey"""
sql_query("sql_join_theta", _THETA, _THETA, ("lineitem", "part"))


# ----------------------------------------------------------------------------- S7, S8 range / as-of

_RANGE_DUCK = """WITH ev AS (SELECT event_id, event_type, ts, value, nullif(user_id, 3) AS user_id FROM events)
SELECT p.event_id, count(e.event_id) AS n_prior, round(coalesce(sum(e.value), 0), 6) AS prior_value
FROM ev p LEFT JOIN ev e
  ON e.user_id = p.user_id AND e.ts >= p.ts - INTERVAL 6 HOUR AND e.ts < p.ts
WHERE p.event_type = 'purchase'
GROUP BY p.event_id"""


@register("sql_join_range", _RANGE_DUCK)
def q_sql_join_range(spark: SparkSession, d: str) -> DataFrame:
    """Events of the same user in the 6 hours before each purchase (no pairs: a bucketed range window); one user's events
    have no key, so they count for nobody."""
    ev = table(spark, d, "events").withColumn("user_id", F.nullif("user_id", F.lit(3)))
    purchases = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    others = ev.select("user_id", F.col("ts").alias("o_ts"), "value")
    out = range_aggregate(
        purchases,
        others,
        ["user_id"],
        "ts",
        "o_ts",
        6 * 3600,
        {"n_prior": lambda c, w: F.count(c("value_present")).over(w), "prior_value": lambda c, w: F.sum(c("value")).over(w)},
        {"value": F.col("value"), "value_present": F.lit(1)},
    )
    return round6(out.select("event_id", "n_prior", F.coalesce("prior_value", F.lit(0.0)).alias("prior_value")))


_ASOF_DUCK = """SELECT e.event_id, e.event_type, CAST(p.event_id AS DOUBLE) AS last_purchase_id, round(p.value, 6) AS last_purchase_value
FROM (SELECT event_id, event_type, nullif(user_id, 3) AS user_id, ts FROM events) e
  ASOF LEFT JOIN (SELECT nullif(user_id, 3) AS user_id, ts, event_id, value FROM events WHERE event_type = 'purchase') p
  ON e.user_id = p.user_id AND e.ts >= p.ts"""


@register("sql_join_asof", _ASOF_DUCK)
def q_sql_join_asof(spark: SparkSession, d: str) -> DataFrame:
    """Each event with the latest purchase of the same user at or before it; one user's events have no key, so they match
    nothing."""
    ev = table(spark, d, "events").withColumn("user_id", F.nullif("user_id", F.lit(3)))
    purchases = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("last_purchase_id"),
        F.col("value").alias("last_purchase_value"),
    )
    out = asof_join(
        ev.select("event_id", "event_type", "user_id", "ts"),
        purchases,
        ["user_id"],
        "ts",
        "p_ts",
        ["last_purchase_id", "last_purchase_value"],
    )
    return round6(
        out.select(
            "event_id", "event_type", F.col("last_purchase_id").cast("double").alias("last_purchase_id"), "last_purchase_value"
        )
    )


# ----------------------------------------------------------------------------- S9-S11 aggregation

_AGG = """SELECT l_returnflag, l_linestatus,
       round(sum(l_quantity), 6) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order,
       count(*) FILTER (WHERE l_quantity > 30) AS n_large,
       round(sum(l_extendedprice) FILTER (WHERE l_discount >= 0.05), 2) AS price_discounted
FROM lineitem
WHERE l_shipdate <= {cutoff}
GROUP BY ALL
HAVING count(*) > 100"""
sql_query(
    "sql_agg",
    _AGG.format(cutoff="TIMESTAMP_NTZ '2000-09-02 00:00:00'"),
    _AGG.format(cutoff="TIMESTAMP '2000-09-02 00:00:00'"),
    ("lineitem",),
)

_DISTINCT = """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_supps,
       count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_returnflag"""
sql_query("sql_distinct", _DISTINCT, _DISTINCT, ("lineitem",))

sql_query(
    "sql_approx_distinct",
    # two aggregates: beside a DISTINCT one, Spark keeps and shuffles a sketch of kilobytes for each flag and part
    """WITH exact AS (SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_returnflag),
approx AS (SELECT l_returnflag, approx_count_distinct(l_partkey, 0.02) AS n_approx FROM lineitem GROUP BY l_returnflag)
SELECT exact.l_returnflag, n_parts, abs(n_approx - n_parts) <= 0.1 * n_parts AS approx_close
FROM exact JOIN approx ON exact.l_returnflag <=> approx.l_returnflag""",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, TRUE AS approx_close FROM lineitem GROUP BY l_returnflag",
    ("lineitem",),
)

_GSETS = """SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INT) AS g_status,
       CAST(grouping(o_orderpriority) AS INT) AS g_priority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY {how}"""
sql_query(
    "sql_grouping_sets",
    _GSETS.format(how="GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())"),
    _GSETS.format(how="GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())"),
    ("orders",),
)
sql_query(
    "sql_cube",
    _GSETS.format(how="CUBE (o_orderstatus, o_orderpriority)"),
    _GSETS.format(how="CUBE (o_orderstatus, o_orderpriority)"),
    ("orders",),
)
sql_query(
    "sql_rollup",
    _GSETS.format(how="ROLLUP (o_orderstatus, o_orderpriority)"),
    _GSETS.format(how="ROLLUP (o_orderstatus, o_orderpriority)"),
    ("orders",),
)

# ----------------------------------------------------------------------------- S12-S15 windows

_RANK = """SELECT o_orderkey, o_custkey,
       row_number() OVER w AS rn, rank() OVER w AS rnk, dense_rank() OVER w AS drnk,
       ntile(4) OVER w AS quartile, round(percent_rank() OVER w, 6) AS prank
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)"""
sql_query("sql_window_rank", _RANK, _RANK, ("orders",))

_ANALYTIC = """SELECT o_orderkey, o_custkey,
       CAST(lag(o_orderkey, 1) OVER w AS DOUBLE) AS prev_order, CAST(lead(o_orderkey, 1) OVER w AS DOUBLE) AS next_order,
       first_value(o_totalprice) OVER wf AS first_price, nth_value(o_totalprice, 2) OVER wf AS second_price,
       last_value(o_orderkey) OVER wf AS last_order
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
       wf AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
sql_query("sql_window_analytic", _ANALYTIC, _ANALYTIC, ("orders",))

_FRAMES = """SELECT event_id, user_id,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS sum_last3,
       count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {h} PRECEDING AND CURRENT ROW) AS n_last_hour,
       round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS centred_avg
FROM events"""
sql_query("sql_window_frames", _FRAMES.format(h="1 HOUR"), _FRAMES.format(h="1 HOUR"), ("events",))

_TOPK = """SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) t
WHERE rn <= 3"""
sql_query("sql_topk", _TOPK, _TOPK, ("orders",))

_LIMIT = """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5"""
sql_query("sql_order_limit", _LIMIT, _LIMIT, ("orders",))

# ----------------------------------------------------------------------------- S16-S18

_SETOPS = """SELECT 'union' AS op, k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
                                     UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'union_all', k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
                                      INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersect_all', k FROM (SELECT c_nationkey AS k FROM customer
                                          INTERSECT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except_all', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)"""
sql_query("sql_set_ops", _SETOPS, _SETOPS, ("orders", "customer", "supplier"))

_CTE = """WITH RECURSIVE months(m) AS (
  SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) FROM orders
  UNION ALL
  SELECT CAST(m + INTERVAL 1 MONTH AS DATE) FROM months
  WHERE m < (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders)
),
per_month AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1
),
rich AS (
  SELECT c_custkey FROM customer c
  WHERE c.c_acctbal > (SELECT avg(c2.c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey)
),
rich_month AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(DISTINCT o_custkey) AS n_rich
  FROM orders o WHERE EXISTS (SELECT 1 FROM rich r WHERE r.c_custkey = o.o_custkey)
  GROUP BY 1
)
SELECT CAST(months.m AS STRING) AS month, coalesce(per_month.n, 0) AS n_orders,
       coalesce(rich_month.n_rich, 0) AS n_rich_buyers
FROM months LEFT JOIN per_month ON months.m = per_month.m LEFT JOIN rich_month ON months.m = rich_month.m"""
sql_query("sql_cte_subquery", _CTE, _CTE, ("orders", "customer"))

sql_query(
    "sql_pivot",
    """SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_totalprice FROM orders)
       PIVOT (count(*) AS n, round(sum(o_totalprice), 2) AS total FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))""",
    """SELECT o_orderpriority,
              count(*) FILTER (WHERE o_orderstatus = 'F') AS f_n, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS f_total,
              count(*) FILTER (WHERE o_orderstatus = 'O') AS o_n, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS o_total,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS p_n, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS p_total
       FROM orders GROUP BY o_orderpriority""",
    ("orders",),
)

sql_query(
    "sql_unpivot",
    """SELECT c_custkey, metric, CAST(val AS DOUBLE) AS val FROM
       (SELECT c_custkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS nation FROM customer)
       UNPIVOT (val FOR metric IN (c_acctbal AS acctbal, nation AS nation))""",
    """SELECT c_custkey, 'acctbal' AS metric, round(c_acctbal, 6) AS val FROM customer
       UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer""",
    ("customer",),
)

# ----------------------------------------------------------------------------- S19-S23 functions

sql_query(
    "sql_strings",
    """SELECT p_partkey, upper(p_name) AS up, substring(p_type, 1, 5) AS type5,
              regexp_extract(p_brand, '([0-9]+)', 1) AS brand_no,
              split(p_type, ' ')[0] AS first_word, concat_ws('|', p_brand, p_type) AS joined,
              levenshtein(p_brand, p_type) AS lev, length(p_name) AS name_len,
              lower(trim(p_type)) AS low, replace(p_name, ' ', '_') AS underscored
       FROM part""",
    """SELECT p_partkey, upper(p_name) AS up, substring(p_type, 1, 5) AS type5,
              regexp_extract(p_brand, '([0-9]+)', 1) AS brand_no,
              string_split(p_type, ' ')[1] AS first_word, concat_ws('|', p_brand, p_type) AS joined,
              levenshtein(p_brand, p_type) AS lev, length(p_name) AS name_len,
              lower(trim(p_type)) AS low, replace(p_name, ' ', '_') AS underscored
       FROM part""",
    ("part",),
)

sql_query(
    "sql_dates",
    """SELECT o_orderkey, date_trunc('MONTH', o_orderdate) AS month_start,
              datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01') AS days_since,
              CAST(add_months(CAST(o_orderdate AS DATE), 3) AS STRING) AS plus_quarter,
              CAST(extract(YEAR FROM o_orderdate) AS INT) AS yr, CAST(extract(DOW FROM o_orderdate) AS INT) AS dow,
              CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS month_end
       FROM orders""",
    """SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start,
              CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since,
              CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS plus_quarter,
              CAST(extract(YEAR FROM o_orderdate) AS INTEGER) AS yr, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
              CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS month_end
       FROM orders""",
    ("orders",),
)

sql_query(
    "sql_math",
    """SELECT l_returnflag, round(avg(ln(l_extendedprice)), 6) AS avg_ln, round(sum(power(l_discount, 2)), 6) AS sum_sq,
              round(corr(l_quantity, l_extendedprice), 6) AS corr_qp, round(stddev_pop(l_extendedprice), 6) AS sd,
              round(percentile(l_quantity, 0.5), 6) AS median_qty, round(avg(sqrt(l_quantity)), 6) AS avg_sqrt,
              round(max(abs(l_extendedprice - 50000)), 6) AS max_dev, round(sum(l_tax * 100 % 3), 6) AS modsum
       FROM lineitem GROUP BY l_returnflag""",
    """SELECT l_returnflag, round(avg(ln(l_extendedprice)), 6) AS avg_ln, round(sum(power(l_discount, 2)), 6) AS sum_sq,
              round(corr(l_quantity, l_extendedprice), 6) AS corr_qp, round(stddev_pop(l_extendedprice), 6) AS sd,
              round(quantile_cont(l_quantity, 0.5), 6) AS median_qty, round(avg(sqrt(l_quantity)), 6) AS avg_sqrt,
              round(max(abs(l_extendedprice - 50000)), 6) AS max_dev, round(sum(fmod(l_tax * 100, 3)), 6) AS modsum
       FROM lineitem GROUP BY l_returnflag""",
    ("lineitem",),
)

sql_query(
    "sql_arrays",
    """WITH v AS (SELECT vec_id, label, transform(embedding, x -> CAST(x AS DOUBLE)) AS e FROM embeddings)
       SELECT vec_id, label,
              round(sqrt(aggregate(e, CAST(0.0 AS DOUBLE), (acc, x) -> acc + x * x)), 6) AS norm,
              size(filter(e, x -> x > 0)) AS n_positive,
              round(element_at(e, 1), 6) AS first_dim,
              round(array_max(e), 6) AS max_dim,
              size(map_keys(map_from_arrays(array(1, 2), slice(e, 1, 2)))) AS n_map
       FROM v""",
    """WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
       SELECT vec_id, label,
              round(sqrt(list_sum(list_transform(e, lambda x: x * x))), 6) AS norm,
              CAST(len(list_filter(e, lambda x: x > 0)) AS INTEGER) AS n_positive,
              round(e[1], 6) AS first_dim,
              round(list_max(e), 6) AS max_dim,
              CAST(2 AS INTEGER) AS n_map
       FROM v""",
    ("embeddings",),
)

sql_query(
    "sql_explode",
    """SELECT label, pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean_value
       FROM embeddings LATERAL VIEW posexplode(embedding) t AS pos, x
       GROUP BY label, pos""",
    """SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean_value
       FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
       GROUP BY label, pos""",
    ("embeddings",),
)

sql_query(
    "sql_json",
    """SELECT event_type, sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS sum_k,
              max(from_json(props, 'k BIGINT').k) AS max_k,
              count(*) FILTER (WHERE CAST(get_json_object(props, '$.k') AS INT) > 50) AS n_big
       FROM events GROUP BY event_type""",
    """SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
              max(CAST(json_extract(props, '$.k') AS BIGINT)) AS max_k,
              count(*) FILTER (WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 50) AS n_big
       FROM events GROUP BY event_type""",
    ("events",),
)


# ----------------------------------------------------------------------------- S24, S25


@register(
    "sql_ctas",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
       WHERE o_orderstatus = 'F' OR o_orderstatus = 'P' GROUP BY o_orderpriority""",
)
def q_sql_ctas(spark: SparkSession, d: str) -> DataFrame:
    """CTAS, INSERT, TRUNCATE and a view over a table in the scratch database."""
    with_views(spark, d, "orders")
    t = scratch_table(spark, "ctas")
    run_sql(spark, f"CREATE TABLE {t} USING parquet AS SELECT * FROM orders WHERE o_orderstatus = 'O'")
    run_sql(spark, f"TRUNCATE TABLE {t}")
    run_sql(spark, f"INSERT INTO {t} SELECT * FROM orders WHERE o_orderstatus = 'F'")
    run_sql(spark, f"INSERT INTO {t} SELECT * FROM orders WHERE o_orderstatus = 'P'")
    run_sql(spark, f"CREATE OR REPLACE TEMP VIEW ctas_view AS SELECT * FROM {t}")
    return round6(
        run_sql(
            spark,
            "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ctas_view "
            "GROUP BY o_orderpriority",
        )
    )


sql_query(
    "sql_sample",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE CAST(conv(substring(md5(CAST(o_orderkey AS STRING)), 1, 4), 16, 10) AS INT) % 100 < 10""",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE CAST('0x' || substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) AS INT) % 100 < 10""",
    ("orders",),
)
