"""DuckDB SQL for the queries, written against the driver's tables alone."""

from __future__ import annotations

#: The label table: every label's first appearance by symbol, insertion order and dimension.
_LABELS = """
    lab AS (
        SELECT r_name AS label, 1 AS s, r_regionkey::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS c, 0::BIGINT AS d, 0::BIGINT AS e, 0 AS k FROM region
        UNION ALL SELECT n_name, 2, n_nationkey, 0, 0, 0, 0, 0 FROM nation
        UNION ALL SELECT r_name, 2, n_nationkey, 0, 0, 0, 0, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT c_mktsegment, 3, c_custkey, 0, 0, 0, 0, 0 FROM customer
        UNION ALL SELECT c_name, 3, c_custkey, 0, 0, 0, 0, 1 FROM customer
        UNION ALL SELECT p_brand, 4, p_partkey, 0, 0, 0, 0, 0 FROM part
        UNION ALL SELECT 'p' || p_partkey, 4, p_partkey, 0, 0, 0, 0, 1 FROM part
        UNION ALL SELECT o_orderpriority, 5, o_orderkey, 0, 0, 0, 0, 0 FROM orders
        UNION ALL SELECT 'o' || o_orderkey, 5, o_orderkey, 0, 0, 0, 0, 1 FROM orders
        UNION ALL SELECT unnest(['o' || l_orderkey, 'p' || l_partkey, 's' || l_suppkey, 'l' || l_linenumber, strftime(l_shipdate, '%Y-%m-%d')]),
                         6, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate::DATE - DATE '1970-01-01', unnest([0, 1, 2, 3, 4]) FROM lineitem
        UNION ALL SELECT unnest([event_type, 'u' || user_id, 'e' || event_id]), 7, event_id, 0, 0, 0, 0, unnest([0, 1, 2]) FROM events),
    firsts AS (SELECT label, min(ROW(s, a, b, c, d, e, k)) AS f FROM lab GROUP BY label),
    u AS (SELECT CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS uel, label FROM firsts)"""

_BAL = 'SELECT c_mktsegment AS segment, c_name AS customer, c_acctbal AS "value" FROM customer'
_BAL_U = f"""WITH {_LABELS}, bal AS (
    SELECT c_mktsegment AS segment, c_name AS customer, c_acctbal AS "value", x.uel AS u0, y.uel AS u1
    FROM customer JOIN u x ON x.label = c_mktsegment JOIN u y ON y.label = c_name)"""
_SHIP = """SELECT 'o' || l_orderkey AS "order", 'p' || l_partkey AS part, 's' || l_suppkey AS supp, 'l' || l_linenumber AS line,
    strftime(l_shipdate, '%Y-%m-%d') AS day, l_quantity AS level FROM lineitem"""
_TOTAL = """SELECT o_orderpriority AS priority, 'o' || o_orderkey AS "order", o_totalprice AS level FROM orders"""
_EV = """SELECT event_type AS dim_0, 'u' || user_id AS "user", 'e' || event_id AS dim_2, "value" FROM events"""

ORACLES: dict[str, str] = {
    "q01_scan": _BAL,
    "q02_catalog": """
        SELECT 'region' AS name, 'Set' AS type, 1 AS dim, (SELECT count(*) FROM region) AS records, '*' AS domains, 'regions' AS text
        UNION ALL SELECT 'nation', 'Set', 2, (SELECT count(*) FROM nation), 'nation,region', 'nations'
        UNION ALL SELECT 'bal', 'Parameter', 2, (SELECT count(*) FROM customer), 'segment,customer', 'balance'
        UNION ALL SELECT 'price', 'Parameter', 2, (SELECT count(*) FROM part), 'value,value', 'price'
        UNION ALL SELECT 'total', 'Equation', 2, (SELECT count(*) FROM orders), 'priority,order', 'order total'
        UNION ALL SELECT 'ship', 'Variable', 5, (SELECT count(*) FROM lineitem), 'order,part,supp,line,day', 'shipments'
        UNION ALL SELECT 'ev', 'Parameter', 3, (SELECT count(*) FROM events), '*,user,*', 'events'
        UNION ALL SELECT 'nlines', 'Parameter', 0, 1, '', 'number of line items'""",
    "q03_domains": f"""WITH {_LABELS},
        a AS (SELECT label AS segment, row_number() OVER (ORDER BY uel) AS n FROM u WHERE label IN (SELECT c_mktsegment FROM customer)),
        b AS (SELECT label AS customer, row_number() OVER (ORDER BY uel) AS n FROM u WHERE label IN (SELECT c_name FROM customer))
        SELECT CAST(coalesce(a.n, b.n) AS INTEGER) AS place, segment, customer FROM a FULL JOIN b ON a.n = b.n""",
    "q04_domain_elements": f"WITH {_LABELS} SELECT uel, label FROM u WHERE label IN (SELECT 's' || l_suppkey FROM lineitem)",
    "q05_label_table": f"WITH {_LABELS} SELECT uel, label FROM u",
    "q05_label_counts": f"WITH {_LABELS} SELECT count(*) AS n, max(uel) AS high FROM u",
    "q06_custom_key_names": f'SELECT "order" AS o, part AS p, supp AS s, line AS l, day AS d, level FROM ({_SHIP})',
    "q07_all_fields": """SELECT 'o' || l_orderkey AS "order", 'p' || l_partkey AS part, 's' || l_suppkey AS supp, 'l' || l_linenumber AS line,
        strftime(l_shipdate, '%Y-%m-%d') AS day, l_quantity AS level, l_extendedprice AS marginal, l_discount AS lower, l_tax AS upper,
        1.0::DOUBLE AS scale FROM lineitem""",
    "q08_label_predicate": f"SELECT * FROM ({_BAL}) WHERE customer LIKE '%7'",
    "q09_ordinal_predicate": f'{_BAL_U} SELECT segment, customer, "value" FROM bal WHERE u1 % 2 = 0',
    "q10_head": f'{_BAL_U} SELECT segment, customer, "value", u0, u1, CAST(row_number() OVER (ORDER BY u0, u1) AS INTEGER) AS place FROM bal QUALIFY place <= 10',
    "q11_ordinal_range": f'{_BAL_U}, r AS (SELECT *, dense_rank() OVER (ORDER BY u0) AS n FROM bal) SELECT segment, customer, "value", u0, u1 FROM r WHERE n IN (2, 3)',
    "q12_write_read": "SELECT count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) AS total, 1 AS refused FROM customer",
    "q13_projection": "SELECT c_name AS customer FROM customer",
    "q14_value_field": f"""SELECT 'o' || l_orderkey AS "order", 'p' || l_partkey AS part, 's' || l_suppkey AS supp, 'l' || l_linenumber AS line,
        strftime(l_shipdate, '%Y-%m-%d') AS day, l_extendedprice AS marginal FROM lineitem""",
    "q15_name_collisions": """SELECT p_brand AS value_0, 'p' || p_partkey AS value_1, p_retailprice AS "value" FROM part""",
    "q16_ignored_value_field": _BAL,
    "q17_special_values": """SELECT CAST(count(*) FILTER (l_discount = 0) AS BIGINT) AS n_eps, CAST(count(*) FILTER (l_discount = 0.05) AS BIGINT) AS n_plus,
        CAST(count(*) FILTER (l_discount = 0.06) AS BIGINT) AS n_minus, CAST(count(*) FILTER (l_tax = 0 OR l_tax = 0.01) AS BIGINT) AS n_nan,
        count(l_tax) AS n FROM lineitem""",
    "q18_upper": "SELECT DISTINCT upper(c_mktsegment) AS segment FROM customer",
    "q19_key_filter": f"SELECT * FROM ({_BAL}) WHERE segment IN ('BUILDING', 'nowhere')",
    "q20_empty_filters": f"""
        SELECT 'wrong case' AS test, count(*) AS n FROM ({_BAL}) WHERE segment = 'building'
        UNION ALL SELECT 'unknown', count(*) FROM ({_BAL}) WHERE customer = 'nobody'
        UNION ALL SELECT 'empty list', 0
        UNION ALL SELECT 'trailing blank', count(*) FROM ({_BAL}) WHERE segment = 'BUILDING '""",
    "q21_equality": f"SELECT * FROM ({_BAL}) WHERE segment = 'BUILDING'",
    "q22_is_in": f"SELECT * FROM ({_BAL}) WHERE segment IN ('BUILDING', 'MACHINERY', 'nowhere')",
    "q23_conjunction": f"""SELECT * FROM ({_EV}) WHERE dim_0 = 'click' AND "user" IN ('u1', 'u2', 'u3')""",
    "q24_intersection": f"SELECT * FROM ({_BAL}) WHERE segment = 'MACHINERY'",
    "q25_unused_label": f"SELECT count(*) AS n FROM ({_BAL}) WHERE segment IN (SELECT c_name FROM customer)",
    "q26_value_predicate": f'SELECT * FROM ({_BAL}) WHERE "value" > 5000',
    "q27_disjunction": f"""SELECT * FROM ({_BAL}) WHERE segment = 'BUILDING' OR "value" < 0""",
    "q28_inner_dimension": f"""SELECT * FROM ({_EV}) WHERE "user" IN ('u1', 'u5', 'u7')""",
    "q29_filter_then_head": f"""{_BAL_U} SELECT segment, customer, "value", u0, u1, CAST(row_number() OVER (ORDER BY u0, u1) AS INTEGER) AS place
        FROM bal WHERE "value" > 0 QUALIFY place <= 5""",
    "q30_label_order": f"""WITH {_LABELS} SELECT label AS priority, CAST(row_number() OVER (ORDER BY uel) AS INTEGER) AS place
        FROM u WHERE label IN (SELECT o_orderpriority FROM orders)""",
    "q31_join": """SELECT o_orderpriority AS priority, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "q32_semi_join": f"""SELECT * FROM ({_TOTAL}) WHERE "order" IN (SELECT 'o' || l_orderkey FROM lineitem WHERE l_suppkey = 1)""",
    "q32_anti_join": f"""SELECT * FROM ({_TOTAL}) WHERE "order" NOT IN (SELECT 'o' || l_orderkey FROM lineitem WHERE l_suppkey = 1)""",
    "q33_group_count": "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1",
    "q34_distinct": """SELECT DISTINCT 'o' || l_orderkey AS "order", 'p' || l_partkey AS part FROM lineitem""",
    "q35_count_distinct": "SELECT 's' || l_suppkey AS supp, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1",
    "q36_scalar": 'SELECT CAST(count(*) AS DOUBLE) AS "value" FROM lineitem',
    "q38_low_level": """SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT CAST(sum(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) FROM lineitem) AS upper,
        (SELECT count(*) FROM part) AS n_price, 0.0::DOUBLE AS marginal""",
    "q39_restart_points": f"{_BAL_U}, r AS (SELECT u0, row_number() OVER (ORDER BY u0, u1) - 1 AS record FROM bal) SELECT u0, min(record) AS record FROM r GROUP BY u0",
    "q40_long_list": f"""SELECT * FROM ({_EV}) WHERE CAST(substr("user", 2) AS BIGINT) % 2 = 0 AND CAST(substr("user", 2) AS BIGINT) < 200000""",
    "q41_key_conjunction": f"""SELECT * FROM ({_SHIP}) WHERE supp = 's7' AND line IN ('l1', 'l2') AND level > 10""",
    "q42_typed_order": "SELECT CAST(row_number() OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS uel, c_name AS label FROM customer",
    "q43_five_domains": f"""WITH {_LABELS},
        d AS (SELECT DISTINCT unnest(['o' || l_orderkey, 'p' || l_partkey, 's' || l_suppkey, 'l' || l_linenumber, strftime(l_shipdate, '%Y-%m-%d')]) AS label, unnest([0, 1, 2, 3, 4]) AS d FROM lineitem),
        n AS (SELECT d, d.label, row_number() OVER (PARTITION BY d ORDER BY uel) AS n FROM d JOIN u ON u.label = d.label)
        SELECT CAST(n AS INTEGER) AS place, max(label) FILTER (d = 0) AS "order", max(label) FILTER (d = 1) AS part, max(label) FILTER (d = 2) AS supp,
               max(label) FILTER (d = 3) AS line, max(label) FILTER (d = 4) AS day FROM n GROUP BY n""",
    "q37_set": 'SELECT n_name AS nation, r_name AS region, 0.0::DOUBLE AS "value" FROM nation JOIN region ON n_regionkey = r_regionkey',
}
