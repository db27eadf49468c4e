/* per-customer features from the base step; ';' inside a comment does not split */
SELECT b.o_custkey, count(*) AS n_orders, round(sum(b.o_totalprice), 2) AS spent,
       max(c.c_mktsegment) AS segment
FROM lw_base b JOIN customer c ON b.o_custkey = c.c_custkey
WHERE b.o_totalprice > {min_price}
GROUP BY b.o_custkey
