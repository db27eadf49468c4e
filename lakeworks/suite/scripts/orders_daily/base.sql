-- orders of the chosen statuses, one row per order {not_a_parameter}
CREATE OR REPLACE TEMP VIEW lw_base AS
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders
WHERE o_orderstatus IN ('{status_a}', '{status_b}');

SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM lw_base
