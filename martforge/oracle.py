"""DuckDB SQL equivalents of the registered queries (correctness oracle).

Each string runs on the raw Parquet views (region nation customer supplier
part orders lineitem pages ...).  The logical tables are rebuilt as CTEs with
the same mapping as ``martforge.views``.  Casts pin DuckDB's types to the
Spark result types: sums are BIGINT, year / quarter INTEGER, and double to
int conversions truncate (``trunc``) as Spark's cast does.
"""

from __future__ import annotations

from martforge.functions import clean as C

CTE = {
    "products": "products AS (SELECT p_partkey AS pid, p_name AS pname FROM part)",
    "reps": (
        "reps AS (SELECT s.s_suppkey AS rid, split_part(s.s_name, '#', 1) AS fname, "
        "split_part(s.s_name, '#', 2) AS lname, r.r_name AS region FROM supplier s "
        "LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"),
    "customers": (
        "customers AS (SELECT c.c_custkey AS cid, c.c_name AS customer, n.n_name AS country "
        "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"),
    "salestxn": (
        "salestxn AS (SELECT CAST(l_shipdate AS DATE) AS date, "
        "CAST(trunc(l_quantity) AS INTEGER) AS quantity, "
        "CAST(trunc(l_extendedprice) AS INTEGER) AS amount, "
        "l_suppkey AS ridFK, l_partkey AS pidFK FROM lineitem)"),
    "salestxn_c": (
        "salestxn_c AS (SELECT CAST(l_shipdate AS DATE) AS date, "
        "CAST(trunc(l_quantity) AS INTEGER) AS quantity, "
        "CAST(trunc(l_extendedprice) AS INTEGER) AS amount, "
        "l_suppkey AS ridFK, l_partkey AS pidFK, o_custkey AS cidFK "
        "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"),
    "airports": "airports AS (SELECT n_nationkey AS aid, n_name AS airportState FROM nation)",
    "flights": (
        "flights AS (SELECT o.o_orderkey AS fid, CAST(o.o_orderdate AS DATE) AS date, "
        "c.c_nationkey AS origin, c.c_name AS airline, o.o_orderstatus AS aircraft, "
        "CAST(trunc(o.o_totalprice) AS INTEGER) AS altitude, "
        "CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS heavy "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"),
    "strikes": (
        "strikes AS (SELECT l_orderkey AS fid, CAST(trunc(l_quantity) AS INTEGER) AS numbirds, "
        "l_linestatus AS impact, CAST(l_returnflag = 'R' AS INTEGER) AS damage, "
        "CAST(trunc(l_extendedprice) AS INTEGER) AS altitude, "
        "CASE WHEN l_returnflag = 'A' THEN 'No Cloud' WHEN l_returnflag = 'N' "
        "THEN 'Some Cloud' ELSE NULL END AS sky_condition FROM lineitem)"),
}

# CTE dependencies (a CTE listed later may use an earlier one).
DEPS: dict[str, tuple[str, ...]] = {}


def with_(*names: str) -> str:
    seen: list[str] = []
    for n in names:
        for dep in DEPS.get(n, ()):
            if dep not in seen:
                seen.append(dep)
        if n not in seen:
            seen.append(n)
    return "WITH " + ",\n".join(CTE[n] for n in seen) + "\n"


def _grains(suffix: str, fact: str, products: str, reps: str) -> None:
    """One aggregate of the fact per grain; region and product-name totals are
    rolled up from the (pid, rid) grain.  Null keys are left out, as no
    dimension row has one."""
    period = "CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter"
    total = "CAST(SUM(quantity) AS BIGINT)"
    rolled = "CAST(SUM(units) AS BIGINT)"
    grain = {
        "by_pid": f"SELECT pidFK AS pid, {total} AS total_sold FROM {fact} GROUP BY ALL",
        "by_pid_quarter": f"SELECT pidFK AS pid, {period}, {total} AS total_sold_per_quarter_and_year "
                          f"FROM {fact} GROUP BY ALL",
        "by_rid": f"SELECT ridFK AS rid, {total} AS total_sold FROM {fact} GROUP BY ALL",
        "by_rid_quarter": f"SELECT ridFK AS rid, {period}, {total} AS total_sold_per_quarter_and_year "
                          f"FROM {fact} GROUP BY ALL",
        "by_both": f"SELECT pidFK AS pid, ridFK AS rid, {total} AS units FROM {fact} GROUP BY ALL",
        "by_pid_region": f"SELECT pid, region, {rolled} AS total_sold_per_region "
                         f"FROM by_both{suffix} JOIN {reps} USING (rid) GROUP BY ALL",
        "by_rid_name": f"SELECT rid, pname, {rolled} AS total_sold_per_product "
                       f"FROM by_both{suffix} JOIN {products} USING (pid) GROUP BY ALL",
        "by_pid_month": f"SELECT pidFK AS pid, strftime(date, '%Y-%m') AS month, {total} AS units "
                        f"FROM {fact} GROUP BY ALL",
        "by_name_month": f"SELECT MIN(pid) AS pid, pname, month, {rolled} AS total_sold_per_month "
                         f"FROM by_pid_month{suffix} JOIN {products} USING (pid) GROUP BY pname, month",
        "pfacts": "SELECT pid, pname, total_sold, year, quarter, region, total_sold_per_region "
                  f"FROM by_pid{suffix} JOIN {products} USING (pid) LEFT JOIN by_pid_quarter{suffix} USING (pid) "
                  f"LEFT JOIN by_pid_region{suffix} USING (pid)",
        "rfacts": "SELECT rid, fname, lname, total_sold, year, quarter, pname, total_sold_per_product "
                  f"FROM by_rid{suffix} JOIN {reps} USING (rid) LEFT JOIN by_rid_quarter{suffix} USING (rid) "
                  f"LEFT JOIN by_rid_name{suffix} USING (rid)",
    }
    below = {"by_pid_region": ["by_both"], "by_rid_name": ["by_both"], "by_name_month": ["by_pid_month"],
             "pfacts": ["by_pid", "by_pid_quarter", "by_both", "by_pid_region"],
             "rfacts": ["by_rid", "by_rid_quarter", "by_both", "by_rid_name"]}
    for name, sql in grain.items():
        CTE[name + suffix] = f"{name}{suffix} AS ({sql})"
        dims = [d for d in (products, reps) if d in sql or name in ("pfacts", "rfacts")]
        DEPS[name + suffix] = (*DEPS.get(fact, ()), fact, *[x for d in dims for x in (*DEPS.get(d, ()), d)],
                               *[n + suffix for n in below.get(name, [])])


_grains("", "salestxn", "products", "reps")
CTE["by_airline"] = ("by_airline AS (SELECT CAST(SUM(n) AS BIGINT) AS strikCount, airline FROM (SELECT fid, "
                     "COUNT(*) AS n FROM strikes GROUP BY fid) JOIN flights USING (fid) GROUP BY airline)")
DEPS["by_airline"] = ("strikes", "flights")

SQL: dict[str, str] = {
    # ---------------------------------------------------------------- marts
    "prod_total": with_("products", "by_pid") + (
        "SELECT pid, pname, total_sold FROM by_pid JOIN products USING (pid)"),
    "prod_quarter": with_("products", "by_pid_quarter") + (
        "SELECT * FROM by_pid_quarter SEMI JOIN products USING (pid)"),
    "prod_region": with_("products", "by_pid_region") + (
        "SELECT * FROM by_pid_region SEMI JOIN products USING (pid)"),
    "rep_total": with_("reps", "by_rid") + (
        "SELECT rid, fname, lname, total_sold FROM by_rid JOIN reps USING (rid)"),
    "rep_quarter": with_("reps", "by_rid_quarter") + (
        "SELECT * FROM by_rid_quarter SEMI JOIN reps USING (rid)"),
    "rep_product_total": with_("reps", "by_rid_name") + (
        "SELECT * FROM by_rid_name SEMI JOIN reps USING (rid)"),
    "prod_facts": with_("pfacts") + "SELECT * FROM pfacts",
    "prod_facts_shared": with_("pfacts") + "SELECT * FROM pfacts",
    "prod_facts_unnested": with_("pfacts") + "SELECT * FROM pfacts",
    "rep_facts_shared": with_("rfacts") + "SELECT * FROM rfacts",
    "prod_facts_three_scans": with_("pfacts") + "SELECT * FROM pfacts",
    "rep_facts": with_("rfacts") + "SELECT * FROM rfacts",
    "rep_facts_three_scans": with_("rfacts") + "SELECT * FROM rfacts",
    "prod_month": with_("by_name_month") + "SELECT * FROM by_name_month",
    "monthly_sales": with_("by_name_month") + (
        "SELECT pname, month, total_sold_per_month FROM by_name_month"),
    "prod_total_by_name": with_("products", "by_pid") + (
        "SELECT MIN(pid) AS pid, pname, CAST(SUM(total_sold) AS BIGINT) AS total_sold "
        "FROM by_pid JOIN products USING (pid) GROUP BY pname"),
    "prod_quarter_named": with_("products", "by_pid_quarter") + (
        "SELECT pid, pname, year, quarter, total_sold_per_quarter_and_year "
        "FROM by_pid_quarter JOIN products USING (pid)"),
    "prod_region_named": with_("products", "by_pid_region") + (
        "SELECT pid, pname, region, total_sold_per_region FROM by_pid_region JOIN products USING (pid)"),
    "rep_quarter_named": with_("reps", "by_rid_quarter") + (
        "SELECT rid, fname, lname, year, quarter, total_sold_per_quarter_and_year "
        "FROM by_rid_quarter JOIN reps USING (rid)"),
    "rep_product_named": with_("reps", "by_rid_name") + (
        "SELECT rid, fname, lname, pname, total_sold_per_product FROM by_rid_name JOIN reps USING (rid)"),
    "prod_reps": with_("reps") + "SELECT rid, fname, lname FROM reps",
    "prod_customers": with_("customers") + "SELECT cid, customer, country FROM customers",
    "rep_product": with_("products", "salestxn") + (
        "SELECT pid, quantity, amount FROM salestxn "
        "JOIN products ON salestxn.pidFK = products.pid"),
    # -------------------------------------------------------------- reports
    "top_reps": with_("reps", "by_rid") + (
        "SELECT fname, lname, total_sold AS units FROM by_rid JOIN reps USING (rid) "
        "WHERE total_sold IS NOT NULL ORDER BY total_sold DESC, rid ASC LIMIT 5"),
    "month_levels": with_("by_name_month") + (
        "SELECT month, CAST(row_number() OVER (ORDER BY first_pname NULLS FIRST, month) "
        "AS INTEGER) AS level FROM (SELECT month, MIN(pname) AS first_pname "
        "FROM by_name_month WHERE month IS NOT NULL GROUP BY month)"),
    "month_total": with_("by_name_month") + (
        "SELECT month, CAST(SUM(total_sold_per_month) AS BIGINT) AS total_sold "
        "FROM by_name_month GROUP BY month"),
    "strikes_by_state": with_("strikes", "flights", "airports") + (
        "SELECT CAST(COUNT(*) AS BIGINT) AS strikCount, a.airportState FROM strikes s "
        "JOIN flights f ON s.fid = f.fid JOIN airports a ON f.origin = a.aid "
        "GROUP BY a.airportState ORDER BY strikCount DESC, airportState ASC NULLS LAST "
        "LIMIT 10"),
    "above_avg_airlines": with_("by_airline") + (
        "SELECT strikCount, airline FROM by_airline "
        "WHERE strikCount > (SELECT AVG(strikCount) FROM by_airline)"),
    "avg_strikes_per_airline": with_("by_airline") + (
        "SELECT AVG(strikCount) AS avStrikeCount FROM by_airline"),
    "strikes_by_month": with_("strikes", "flights") + (
        "SELECT CAST(SUM(s.numbirds) AS BIGINT) AS birds, strftime(f.date, '%m') AS month "
        "FROM strikes s JOIN flights f ON s.fid = f.fid GROUP BY month"),
}


# ------------------------------------------------------- raw record CTEs
_LI_ORDER = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
             "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
_ORD = ("row_number() OVER (ORDER BY " +
        ", ".join(c.strip() + " ASC NULLS FIRST" for c in _LI_ORDER.split(",")) + ")")

CTE.update({
    "raw_txn": (
        "raw_txn AS (SELECT l.*, CAST(l_shipdate AS DATE) AS date, c_name AS cust, "
        "p_name AS prod, CAST(trunc(l_quantity) AS INTEGER) AS quantity, "
        "CAST(trunc(l_extendedprice) AS INTEGER) AS amount, n_name AS country, "
        "l_suppkey AS repID, " + _ORD + " AS ord "
        "FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "LEFT JOIN part p ON l.l_partkey = p.p_partkey)"),
    "dim_products": (
        "dim_products AS (SELECT CAST(row_number() OVER (ORDER BY MIN(ord)) AS BIGINT) AS pid, "
        "prod AS pname FROM raw_txn GROUP BY prod)"),
    "dim_customers": (
        "dim_customers AS (SELECT CAST(100 + row_number() OVER (ORDER BY MIN(ord)) AS BIGINT) "
        "AS cid, cust AS customer, arg_min(country, ord) AS country FROM raw_txn GROUP BY cust)"),
    "gaps": (
        "gaps AS (SELECT CASE WHEN quantity % 11 <> 0 THEN date END AS date, quantity, amount, "
        "CASE WHEN quantity % 10 = 1 THEN ridFK + 1000000000000 WHEN quantity % 10 <> 0 THEN ridFK END AS ridFK, "
        "CASE WHEN quantity % 7 = 0 THEN pidFK + 1000000000000 ELSE pidFK END AS pidFK, "
        "CASE WHEN quantity % 5 = 1 THEN cidFK + 1000000000000 WHEN quantity % 5 <> 0 THEN cidFK END AS cidFK "
        "FROM salestxn_c)"),
    "gap_txn": (
        "gap_txn AS (SELECT ord, date, quantity, amount, prod, country, CASE WHEN l_linenumber <> 3 THEN cust END "
        "AS cust, CASE WHEN l_linenumber > 2 THEN repID END AS repID FROM raw_txn)"),
    "gap_customers": (
        "gap_customers AS (SELECT CAST(100 + row_number() OVER (ORDER BY MIN(ord)) AS BIGINT) AS cid, "
        "cust AS customer FROM gap_txn GROUP BY cust)"),
    "gaps_loaded": (
        "gaps_loaded AS (SELECT CAST(t.ord AS BIGINT) AS tid, t.date, t.quantity, t.amount, r.rid AS ridFK, "
        "p.pid AS pidFK, c.cid AS cidFK FROM gap_txn t LEFT JOIN dim_products p ON t.prod = p.pname "
        "LEFT JOIN gap_customers c ON t.cust = c.customer LEFT JOIN reps r ON t.repID = r.rid)"),
    "raw_strikes": (
        "raw_strikes AS (SELECT l.*, l_orderkey AS fid, CAST(o_orderdate AS DATE) AS fdate, "
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE n_name END AS origin, "
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' WHEN c_mktsegment = 'MACHINERY' "
        "THEN NULL ELSE c_name END AS airline, o_orderstatus AS aircraft, "
        "CAST(trunc(o_totalprice) AS INTEGER) AS altitude, "
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' WHEN o_orderpriority = '5-LOW' "
        "THEN NULL ELSE 'No' END AS heavy_flag, "
        "CASE WHEN l_returnflag = 'A' THEN 'No Cloud' WHEN l_returnflag = 'N' "
        "THEN 'Some Cloud' ELSE NULL END AS sky_conditions, "
        "CAST(trunc(l_quantity) AS INTEGER) AS numbirds, l_linestatus AS impact, "
        "CASE WHEN l_returnflag = 'R' THEN 'Caused damage' ELSE 'No damage' END AS damage, "
        + _ORD + " AS ord "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"),
    "dim_airports": (
        "dim_airports AS (SELECT CAST(row_number() OVER (ORDER BY MIN(ord)) AS BIGINT) AS aid, "
        "COALESCE(origin, 'unknown') AS airportState, CAST(NULL AS VARCHAR) AS airportCode, "
        "origin AS origin_raw FROM raw_strikes GROUP BY origin)"),
    "dim_conditions": (
        "dim_conditions AS (SELECT CAST(row_number() OVER (ORDER BY MIN(ord)) AS BIGINT) AS cid, "
        "sky_conditions AS sky_condition, CAST(NULL AS VARCHAR) AS explanation "
        "FROM raw_strikes GROUP BY sky_conditions)"),
    "fact_strikes": (
        "fact_strikes AS (SELECT CAST(r.ord AS BIGINT) AS sid, r.fid, r.numbirds, r.impact, "
        "CAST(r.damage = 'Caused damage' AS INTEGER) AS damage, r.altitude, "
        "c.cid AS conditions FROM raw_strikes r LEFT JOIN dim_conditions c "
        "ON r.sky_conditions IS NOT DISTINCT FROM c.sky_condition)"),
    "fact_flights": (
        "fact_flights AS (SELECT f.fid, f.fdate AS date, a.aid AS origin, "
        "COALESCE(f.airline, 'Unknown') AS airline, COALESCE(f.aircraft, 'Unknown') AS aircraft, "
        "f.altitude, CAST(f.heavy_flag = 'Yes' AS INTEGER) AS heavy "
        "FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY ord) AS rn "
        "FROM raw_strikes) f LEFT JOIN dim_airports a ON f.origin = a.origin_raw "
        "WHERE f.rn = 1)"),
    "fact_sales": (
        "fact_sales AS (SELECT CAST(t.ord AS BIGINT) AS tid, t.date, t.quantity, t.amount, "
        "t.repID AS ridFK, p.pid AS pidFK, c.cid AS cidFK FROM raw_txn t "
        "JOIN dim_products p ON t.prod = p.pname JOIN dim_customers c ON t.cust = c.customer)"),
})
DEPS.update({
    "gaps": ("salestxn_c",), "gap_txn": ("raw_txn",), "gap_customers": ("raw_txn", "gap_txn"),
    "gaps_loaded": ("reps", "raw_txn", "dim_products", "gap_txn", "gap_customers"),
    "dim_products": ("raw_txn",), "dim_customers": ("raw_txn",),
    "dim_airports": ("raw_strikes",), "dim_conditions": ("raw_strikes",),
    "fact_strikes": ("raw_strikes", "dim_conditions"),
    "fact_flights": ("raw_strikes", "dim_airports"),
    "fact_sales": ("raw_txn", "dim_products", "dim_customers"),
})

_TXN_TYPED = "SELECT date, cust, prod, quantity, amount, country, repID FROM raw_txn"

SQL.update({
    "rep_id_parse": "SELECT 'r' || CAST(s_suppkey AS VARCHAR) AS raw, "
                    "s_suppkey AS rid FROM supplier",
    "parse_us_date": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 >= 4 THEN CAST(o_orderdate AS DATE) END "
                     "AS date FROM orders",
    "lenient_int": "SELECT l_orderkey, l_linenumber, "
                   "CAST(CASE WHEN l_linenumber < 5 THEN NULL WHEN l_linenumber = 5 THEN -trunc(l_extendedprice) "
                   "ELSE trunc(l_extendedprice) END AS INTEGER) AS amount FROM lineitem",
    "altitude_parse": "SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS altitude "
                      "FROM orders",
    "null_default": "SELECT c_custkey AS cid, COALESCE(NULLIF(c_mktsegment, 'MACHINERY'), "
                    "'Unknown') AS segment FROM customer",
    "text_flag": with_("raw_strikes") + (
        "SELECT l_orderkey, l_linenumber, CAST(heavy_flag = 'Yes' AS INTEGER) AS heavy, "
        "CAST(damage = 'Caused damage' AS INTEGER) AS damage FROM raw_strikes"),
    "xml_txn_scan": with_("raw_txn") + _TXN_TYPED,
    "xml_rep_scan": with_("reps") + (
        "SELECT rid, fname, lname, region FROM reps"),
    "xml_product_scan": with_("raw_txn") + "SELECT prod AS text FROM raw_txn",
    "xml_multi_file": with_("raw_txn") + _TXN_TYPED,
    "xml_rowtag_multi_file": with_("raw_txn") + _TXN_TYPED,
    "csv_scan": with_("raw_strikes") + (
        "SELECT fid AS rid, fdate AS flight_date, origin, airline, CASE l_linenumber % 3 "
        "WHEN 0 THEN 'A \"' || aircraft || '\", old' WHEN 1 THEN aircraft || chr(10) || 'second line' "
        "ELSE aircraft END AS aircraft, altitude, heavy_flag, sky_conditions, numbirds AS wildlife_struck, impact, damage "
        "FROM raw_strikes"),
    "sink_overwrite": with_("reps") + "SELECT rid, fname, lname FROM reps",
    "sink_append": with_("customers") + (
        "SELECT cid, customer, country FROM customers UNION ALL "
        "SELECT cid, customer, country FROM customers"),
    "materialize_mart": with_("by_name_month") + "SELECT * FROM by_name_month",
    "monthly_sales_table": with_("by_name_month") + (
        "SELECT pname, month, total_sold_per_month FROM by_name_month"),
    "txn_row_count": "SELECT COUNT(*) AS count FROM lineitem",
    "dim_products": with_("dim_products") + "SELECT pid, pname FROM dim_products",
    "dim_customers": with_("dim_customers") + "SELECT cid, customer, country FROM dim_customers",
    "dim_reps": with_("reps") + "SELECT rid, fname, lname, region FROM reps",
    "cust_reps": with_("fact_sales") + "SELECT DISTINCT cidFK AS cid, ridFK AS rid FROM fact_sales",
    "fact_sales": with_("fact_sales") + "SELECT * FROM fact_sales",
    "fact_sales_orphans_null": with_("gaps_loaded") + "SELECT * FROM gaps_loaded",
    "fact_sales_orphans_drop": with_("gaps_loaded") + (
        "SELECT * FROM gaps_loaded WHERE ridFK IS NOT NULL AND cidFK IS NOT NULL"),
    "key_policy_append": with_("customers") + (
        "SELECT cid, customer, CASE WHEN cid % 2 <> 0 THEN country END AS country FROM customers"),
    "schema_listing": with_("fact_flights") + (
        "SELECT CAST(i AS INTEGER) AS cid, name, type, n_values FROM (VALUES "
        "(0, 'fid', 'bigint'), (1, 'date', 'date'), (2, 'origin', 'bigint'), (3, 'airline', 'string'), "
        "(4, 'aircraft', 'string'), (5, 'altitude', 'int'), (6, 'heavy', 'int')) v(i, name, type) JOIN "
        "(UNPIVOT (SELECT COUNT(fid) AS fid, COUNT(date) AS date, COUNT(origin) AS origin, COUNT(airline) AS airline, "
        "COUNT(aircraft) AS aircraft, COUNT(altitude) AS altitude, COUNT(heavy) AS heavy FROM fact_flights) "
        "ON COLUMNS(*) INTO NAME name VALUE n_values) USING (name)"),
    "check_violations_strikes": with_("strikes") + (
        "SELECT fid, numbirds, CAST(altitude - 20000 AS INTEGER) AS altitude FROM strikes WHERE NOT (altitude - 20000 >= 0)"),
    "dim_airports": with_("dim_airports") + (
        "SELECT aid, airportState, airportCode FROM dim_airports"),
    "fact_flights": with_("fact_flights") + "SELECT * FROM fact_flights",
    "dim_conditions": with_("dim_conditions") + "SELECT * FROM dim_conditions",
    "fact_strikes": with_("fact_strikes") + "SELECT * FROM fact_strikes",
    "flight_origin_lookup": with_("fact_flights") + "SELECT fid, origin FROM fact_flights",
    "strike_condition_lookup": with_("fact_strikes") + "SELECT sid, conditions FROM fact_strikes",
    "first_strike_per_flight": with_("fact_strikes") + (
        "SELECT sid, fid, numbirds, impact, damage, altitude, conditions FROM ("
        "SELECT *, row_number() OVER (PARTITION BY fid ORDER BY sid) AS rn FROM fact_strikes) "
        "WHERE rn = 1"),
    "fk_orphans": with_("gaps", "reps", "products", "customers") + (
        "SELECT 'ridFK' AS fk, COUNT(*) AS orphans FROM gaps s WHERE ridFK IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM reps r WHERE r.rid = s.ridFK) UNION ALL "
        "SELECT 'pidFK', COUNT(*) FROM gaps s WHERE pidFK IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM products p WHERE p.pid = s.pidFK) UNION ALL "
        "SELECT 'cidFK', COUNT(*) FROM gaps s WHERE cidFK IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM customers c WHERE c.cid = s.cidFK)"),
    "pk_duplicates": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
                     "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    "not_null_violations": with_("gaps") + (
        "SELECT * FROM (SELECT 'date' AS \"column\", COUNT(*) FILTER (WHERE date IS NULL) AS nulls "
        "FROM gaps UNION ALL SELECT 'quantity', COUNT(*) FILTER (WHERE quantity IS NULL) "
        "FROM gaps UNION ALL SELECT 'ridFK', COUNT(*) FILTER (WHERE ridFK IS NULL) "
        "FROM gaps UNION ALL SELECT 'pidFK', COUNT(*) FILTER (WHERE pidFK IS NULL) "
        "FROM gaps UNION ALL SELECT 'cidFK', COUNT(*) FILTER (WHERE cidFK IS NULL) "
        "FROM gaps)"),
    "check_violations": with_("flights") + (
        "SELECT fid, CAST(altitude - 100000 AS INTEGER) AS altitude FROM flights WHERE NOT (altitude - 100000 > 0)"),
    "key_policy_first": with_("pfacts") + (
        "SELECT pid, pname, total_sold, year, quarter, region, total_sold_per_region FROM ("
        "SELECT *, row_number() OVER (PARTITION BY pid ORDER BY year ASC NULLS FIRST, "
        "quarter ASC NULLS FIRST, region ASC NULLS FIRST) AS rn FROM pfacts) "
        "WHERE rn = 1"),
    "union_all": "SELECT l_orderkey, l_linenumber, l_linestatus FROM lineitem",
})


# ------------------------------------------------------------------ upsert
CTE.update({
    "batch": (
        "batch AS (SELECT s.s_suppkey AS bord, DATE '2023-06-24' + s.s_nationkey AS date, "
        "CASE WHEN s.s_acctbal >= 0 THEN n.n_name ELSE r.r_name END AS origin, "
        "'Airplane' AS aircraft, CAST(trunc(abs(s.s_acctbal)) AS INTEGER) AS altitude, "
        "s.s_nationkey + 1 AS numbirds, CASE WHEN s.s_acctbal >= 5000 THEN 'No Cloud' "
        "WHEN s.s_acctbal >= 0 THEN 'Some Cloud' ELSE NULL END AS conditions "
        "FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"),
    "airports2": (
        "airports2 AS (SELECT aid, airportState, airportCode FROM dim_airports UNION ALL "
        "SELECT CAST((SELECT MAX(aid) FROM dim_airports) + row_number() OVER "
        "(ORDER BY MIN(bord)) AS BIGINT) AS aid, COALESCE(origin, 'unknown') AS airportState, "
        "CAST(NULL AS VARCHAR) AS airportCode FROM batch "
        "WHERE COALESCE(origin, 'unknown') NOT IN (SELECT airportState FROM dim_airports) "
        "GROUP BY COALESCE(origin, 'unknown'))"),
    "bf": (
        "bf AS (SELECT b.*, a.aid AS origin_id FROM batch b LEFT JOIN (SELECT airportState, "
        "MIN(aid) AS aid FROM airports2 GROUP BY airportState) a "
        "ON COALESCE(b.origin, 'unknown') = a.airportState)"),
    "flights2": (
        "flights2 AS (SELECT fid, date, origin, airline, aircraft, altitude, heavy "
        "FROM fact_flights UNION ALL SELECT CAST((SELECT MAX(fid) FROM fact_flights) + "
        "row_number() OVER (ORDER BY first_ord) AS BIGINT) AS fid, date, origin_id AS origin, "
        "'Unknown' AS airline, aircraft, altitude, 0 AS heavy FROM (SELECT date, origin_id, "
        "aircraft, MIN(bord) AS first_ord, arg_min(altitude, bord) AS altitude FROM bf "
        "GROUP BY date, origin_id, aircraft) k WHERE NOT EXISTS (SELECT 1 FROM fact_flights f "
        "WHERE f.date IS NOT DISTINCT FROM k.date AND f.origin IS NOT DISTINCT FROM k.origin_id "
        "AND f.aircraft IS NOT DISTINCT FROM k.aircraft))"),
    "strikes2": (
        "strikes2 AS (SELECT sid, fid, numbirds, impact, damage, altitude, conditions "
        "FROM fact_strikes UNION ALL SELECT CAST((SELECT MAX(sid) FROM fact_strikes) + "
        "row_number() OVER (ORDER BY b.bord) AS BIGINT) AS sid, k.fid, "
        "CAST(b.numbirds AS INTEGER) AS numbirds, 'N/A' AS impact, 0 AS damage, b.altitude, "
        "c.cid AS conditions FROM bf b LEFT JOIN (SELECT date, origin, aircraft, MIN(fid) AS fid "
        "FROM flights2 GROUP BY date, origin, aircraft) k ON k.date IS NOT DISTINCT FROM b.date "
        "AND k.origin IS NOT DISTINCT FROM b.origin_id AND k.aircraft IS NOT DISTINCT FROM "
        "b.aircraft LEFT JOIN (SELECT sky_condition, MIN(cid) AS cid FROM dim_conditions "
        "GROUP BY sky_condition) c ON b.conditions IS NOT DISTINCT FROM c.sky_condition)"),
})
DEPS.update({
    "airports2": ("raw_strikes", "dim_airports", "batch"),
    "bf": ("raw_strikes", "dim_airports", "batch", "airports2"),
    "flights2": ("raw_strikes", "dim_airports", "batch", "airports2", "bf", "fact_flights"),
    "strikes2": ("raw_strikes", "dim_airports", "dim_conditions", "batch", "airports2", "bf",
                 "fact_flights", "flights2", "fact_strikes"),
})
SQL.update({
    "upsert_airports_indexed": with_("airports2") + "SELECT * FROM airports2",
    "upsert_flights_indexed": with_("flights2") + "SELECT * FROM flights2",
    "upsert_strikes_indexed": with_("strikes2") + "SELECT * FROM strikes2",
    "upsert_airports": with_("airports2") + "SELECT * FROM airports2",
    "upsert_flights": with_("flights2") + "SELECT * FROM flights2",
    "upsert_strikes": with_("strikes2") + "SELECT * FROM strikes2",
})


# ------------------------------------------------------------------ people
def _code(k: str) -> str:
    n = f"CAST({k} AS VARCHAR)"
    t = f"translate(lpad({n}, CAST(greatest(6, length({n})) AS INTEGER), '0'), '0123456789', 'aeioubcdfg')"
    return f"(upper(substr({t}, 1, 1)) || substr({t}, 2))"


_SEGNAME = "(upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2))"
_PNAME = (f"CASE WHEN c_mktsegment = 'BUILDING' THEN {_code('c_custkey')} || ' ' || "
          f"{_code('c_custkey')} || ' the ' || {_SEGNAME} ELSE {_code('c_custkey')} || "
          f"' the ' || {_SEGNAME} END")
_LD = "strftime({}, '%-d %B %Y')"
_NOTE = "'[' || CAST(c_nationkey AS VARCHAR) || ']'"
_BIRTH = "(year(d1) - 18 - c_nationkey)"
_BIRTH_T = (f"CASE WHEN c_acctbal < 0 THEN 'c. ' || CAST({_BIRTH} AS VARCHAR) || '[a]' "
            f"ELSE CAST({_BIRTH} AS VARCHAR) END")
_DEATH_T = ("strftime(d2, '%-d %B ') || CAST(year(d2) + CASE WHEN c_acctbal > 5000 THEN 5 "
            "ELSE 0 END AS VARCHAR)")
_CLAIM = (f"CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Son of ' || {_code('c_custkey - 1')} "
          f"WHEN c_mktsegment = 'BUILDING' THEN 'Daughter of ' || {_code('c_custkey - 1')} || "
          f"' the ' || lower(c_mktsegment) WHEN c_mktsegment = 'FURNITURE' THEN "
          f"'Great-grandson of ' || {_code('c_custkey - 1')} || {_SEGNAME} "
          f"WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Grandson/son of ' || {_code('c_custkey - 1')} "
          f"END")
_START1 = ("CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(year(d1) AS VARCHAR) ELSE "
           + _LD.format("d1") + " END")
_END1 = _LD.format("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN d1 + INTERVAL 12 MONTH ELSE d2 END")
_NAME1 = (f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '(1st reign) ' ELSE '' END || {_PNAME} || "
          f"{_NOTE} || CASE WHEN d1 IS NULL THEN '' ELSE ' ' || {_START1} || ' – ' || {_END1} END")
_NAME2 = (f"'(2nd reign) ' || {_PNAME} || {_NOTE} || ' ' || "
          + _LD.format("d2 - INTERVAL 12 MONTH") + " || ' – ' || " + _LD.format("d2"))
_SPLIT = r"(?:\s\d|\[\d+\])"

CTE.update({
    "pbase": (
        "pbase AS (SELECT c.*, o.d1, o.d2 FROM customer c LEFT JOIN (SELECT o_custkey, "
        "MIN(CAST(o_orderdate AS DATE)) AS d1, MAX(CAST(o_orderdate AS DATE)) AS d2 "
        "FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey)"),
    "raw_people": (
        "raw_people AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey, part) - 1 AS BIGINT) "
        "AS row_index, Name, Birth, Death, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL "
        "ELSE Claim END AS Claim FROM ("
        f"SELECT c_custkey, 0 AS part, c_mktsegment, {_NAME1} AS Name, {_BIRTH_T} AS Birth, "
        f"{_DEATH_T} AS Death, {_CLAIM} AS Claim FROM pbase UNION ALL "
        f"SELECT c_custkey, 1 AS part, c_mktsegment, {_NAME2} AS Name, {_BIRTH_T} AS Birth, "
        f"{_DEATH_T} AS Death, {_CLAIM} AS Claim FROM pbase "
        "WHERE c_mktsegment = 'HOUSEHOLD' AND d1 IS NOT NULL))"),
    "psplit": (
        "psplit AS (SELECT row_index, CASE WHEN regexp_matches(n0, '" + _SPLIT + "') THEN "
        "regexp_extract(n0, '^(.*?)" + _SPLIT + "', 1) ELSE n0 END AS name, "
        "CASE WHEN regexp_matches(n0, '" + _SPLIT + "') THEN "
        "regexp_replace(n0, '^.*?" + _SPLIT + "', '') ELSE NULL END AS \"desc\", "
        "Birth, Death, Claim FROM (SELECT *, regexp_replace(Name, '" + C.FOOTNOTE_PATTERN + "', '', 'g') AS n0 "
        "FROM raw_people))"),
    "pclean": (
        "pclean AS (SELECT row_index, array_to_string(list_filter(l, lambda x, i: "
        "list_position(l, x) = i), ' ') AS Name, \"desc\", d2 AS dates, "
        "TRY_CAST(trim(string_split(trim(d2), '–')[1]) AS INTEGER) AS start, "
        "TRY_CAST(trim(string_split(trim(d2), '–')[2]) AS INTEGER) AS \"end\", "
        "TRY_CAST(NULLIF(regexp_extract(Birth, '" + C.YEAR_PATTERN + "', 1), '') AS INTEGER) AS Birth, "
        "TRY_CAST(NULLIF(regexp_extract(Death, '" + C.YEAR_PATTERN + "', 1), '') AS INTEGER) AS Death, "
        "regexp_replace(NULLIF(regexp_extract(cl, '(?i)" + C.CLAIM_PARENT_PATTERN + "', 1), ''), '^(.*?[^ IV])[A-Z].*$', '\\1') AS Claim, "
        "NULLIF(regexp_extract(cl, '(?i)" + C.CLAIM_RELATION_PATTERN + "', 1), '') "
        "AS ClaimRelation FROM (SELECT *, regexp_replace(dates, '" + C.DAY_MONTH_PATTERN + "', ' ', "
        "'g') AS d2 FROM (SELECT *, list_filter(string_split_regex(name, '\\s+'), lambda x: "
        "x <> '') AS l, NULLIF(regexp_extract(\"desc\", '" + C.DATE_RANGE_PATTERN + "', 1), '') AS dates, regexp_replace(Claim, '" + C.CLAIM_OF_PATTERN + "', 'of', 'g') "
        "AS cl FROM psplit)))"),
    "people": (
        "people AS (SELECT CAST(row_number() OVER (ORDER BY start ASC NULLS LAST, row_index) - 1 "
        "AS BIGINT) AS idx, * FROM pclean)"),
    "second": (
        "second AS (SELECT f.idx, MIN(s.idx) AS partner_idx FROM people f JOIN people s "
        "ON s.Name = '(2nd reign) ' || trim(f.Name, '(1st reign)') "
        "WHERE contains(f.Name, '(1st reign)') AND COALESCE(f.Death - f.\"end\" <> 0, TRUE) "
        "GROUP BY f.idx)"),
    "lineage": (
        "lineage AS (SELECT c.idx AS child_idx, MIN(p.idx) AS parent_idx FROM people c "
        "JOIN people p ON contains(lower(p.Name), lower(c.Claim)) "
        "WHERE c.Claim IS NOT NULL AND length(c.Claim) > 0 GROUP BY c.idx)"),
    "b0": "b0 AS (SELECT MAX(Birth) AS b0 FROM people WHERE idx = 0)",
    "layout": (
        "layout AS (SELECT idx, CAST(Birth - (SELECT b0 FROM b0) + 10 AS BIGINT) AS x, "
        "CAST(600 - 10 * idx AS BIGINT) AS lane FROM people "
        "WHERE idx NOT IN (SELECT partner_idx FROM second))"),
})
_P = ("raw_people", "psplit", "pclean", "people")
DEPS.update({
    "raw_people": ("pbase",), "psplit": ("pbase", "raw_people"),
    "pclean": ("pbase", "raw_people", "psplit"),
    "people": ("pbase",) + _P[:-1],
    "second": ("pbase",) + _P, "lineage": ("pbase",) + _P, "b0": ("pbase",) + _P,
    "layout": ("pbase",) + _P + ("b0", "second"),
})

_SEGMENTS = (
    "SELECT idx, seg_no, kind, CAST(length AS INTEGER) AS length FROM ("
    "SELECT p.idx, 0 AS seg_no, 'before' AS kind, p.start - p.Birth AS length, TRUE AS keep "
    "FROM rows_ p UNION ALL SELECT idx, 1, 'reign', \"end\" - start, TRUE FROM rows_ "
    "UNION ALL SELECT idx, 2, 'between', start2 - \"end\", partner_idx IS NOT NULL FROM rows_ "
    "UNION ALL SELECT idx, 3, 'reign', end2 - start2, partner_idx IS NOT NULL FROM rows_ "
    "UNION ALL SELECT idx, 4, 'after', Death - ae, COALESCE(Death - ae <> 0, TRUE) FROM rows_) "
    "WHERE keep")
_ROWS = (
    "rows_ AS (SELECT p.idx, p.Birth, p.Death, p.start, p.\"end\", s.partner_idx, "
    "q.start AS start2, q.\"end\" AS end2, CASE WHEN s.partner_idx IS NOT NULL THEN q.\"end\" "
    "ELSE p.\"end\" END AS ae FROM people p LEFT JOIN second s ON p.idx = s.idx "
    "LEFT JOIN people q ON q.idx = s.partner_idx "
    "WHERE p.idx NOT IN (SELECT partner_idx FROM second))")

SQL.update({
    "union_missing_cols": with_("raw_people") + "SELECT * FROM raw_people",
    "strip_footnotes": with_("raw_people") + (
        "SELECT row_index, regexp_replace(Name, '" + C.FOOTNOTE_PATTERN + "', '', 'g') AS Name FROM raw_people"),
    "name_desc_split": with_("psplit") + "SELECT row_index, name, \"desc\" FROM psplit",
    "dedupe_words": with_("pclean") + "SELECT row_index, Name FROM pclean",
    "date_range_extract": with_("psplit") + (
        "SELECT row_index, NULLIF(regexp_extract(\"desc\", '" + C.DATE_RANGE_PATTERN + "', 1), '') AS dates FROM psplit"),
    "reign_parse": with_("pclean") + "SELECT row_index, start, \"end\" FROM pclean",
    "year_extract": with_("pclean") + "SELECT row_index, Birth, Death FROM pclean",
    "claim_parse": with_("raw_people") + (
        "SELECT row_index, NULLIF(regexp_extract(regexp_replace(Claim, '" + C.CLAIM_OF_PATTERN + "', 'of', 'g'), "
        "'(?i)" + C.CLAIM_PARENT_PATTERN + "', 1), '') "
        "AS Claim FROM raw_people"),
    "claim_relation": with_("pclean") + "SELECT row_index, ClaimRelation FROM pclean",
    "glued_name_cut": with_("pclean") + "SELECT row_index, Claim FROM pclean",
    "char_set_trim": with_("pclean") + (
        "SELECT row_index, trim(Name, '(1st reign)') AS Name FROM pclean"),
    "reject_rows": with_("raw_people") + (
        "SELECT CAST(row_number() OVER (ORDER BY row_index) - 1 AS BIGINT) AS row_index, Name, "
        "Birth, Death, Claim FROM raw_people WHERE row_index NOT IN (18, 25, 48)"),
    "point_overrides": with_("pclean") + (
        "SELECT row_index, CASE WHEN row_index = 0 THEN 'Alfred the Great' ELSE Name END AS Name, "
        "CASE WHEN row_index = 29 THEN '1307 – 1327' WHEN row_index = 3 THEN '927 – 939' "
        "ELSE dates END AS dates, CASE WHEN row_index = 10 THEN NULL WHEN row_index = 45 "
        "THEN 'spouse' ELSE Claim END AS Claim FROM pclean"),
    "monarch_clean": with_("people") + "SELECT * FROM people",
    "monarch_order": with_("people") + "SELECT idx, row_index, start FROM people",
    "lineage": with_("lineage") + "SELECT * FROM lineage",
    "second_reign": with_("second") + "SELECT * FROM second",
    "reign_segments": with_("second") + ", " + _ROWS + "\n" + _SEGMENTS,
    "year_span": with_("people") + (
        "SELECT MIN(Birth) AS min_birth, MAX(Death) AS max_death, "
        "MAX(Death) - MIN(Birth) + 20 AS date_range FROM people"),
    "year_grid": with_("b0") + (
        "SELECT CAST(c * 100 + 25 * j AS INTEGER) AS year, k AS kind, "
        "CAST(c * 100 + 25 * j - (SELECT b0 FROM b0) AS INTEGER) AS x FROM "
        "(SELECT unnest(range(lo, CAST(lo + round_even(span / 100.0, 0) AS INTEGER) + 1)) AS c FROM "
        "(SELECT CAST(floor(MIN(Birth) / 100.0) AS INTEGER) AS lo, MAX(Death) - MIN(Birth) + 20 AS span FROM people)) "
        "CROSS JOIN (VALUES (0, 'century'), (1, 'quarter'), (2, 'half'), (3, 'quarter')) m(j, k)"),
    "timeline_layout": with_("layout") + "SELECT * FROM layout",
    "lineage_edges": with_("lineage", "layout") + (
        "SELECT l.child_idx, l.parent_idx, c.lane AS child_lane, p.lane AS parent_lane, "
        "p.x AS parent_x FROM lineage l JOIN layout c ON c.idx = l.child_idx "
        "JOIN layout p ON p.idx = l.parent_idx"),
})


# -------------------------------------------------------------------- html
SQL.update({
    "html_table_extract": (
        "SELECT l_orderkey, l_linenumber, 0 AS table_no, 0 AS row_no, "
        "'Part ' || CAST(l_partkey AS VARCHAR) AS Name, "
        "CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS Birth, "
        "CAST(year(l_shipdate) AS VARCHAR) AS Death, "
        "CASE WHEN l_linestatus = 'F' THEN 'Son of ' || l_returnflag END AS Claim "
        "FROM lineitem UNION ALL "
        "SELECT l_orderkey, l_linenumber, 0, 1, 'Part ' || CAST(l_partkey AS VARCHAR), "
        "CAST(l_linenumber AS VARCHAR), CASE WHEN l_linestatus = 'F' THEN 'Son of ' || l_returnflag "
        "ELSE CAST(month(l_shipdate) AS VARCHAR) END, NULL FROM lineitem"),
    "html_list_items": (
        "SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS item_no, "
        "unnest(h) AS href, unnest(t) AS text FROM (SELECT page_id, "
        "regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 1) AS h, "
        "regexp_extract_all(html, '<li><a href=\"([^\"]*)\">([^<]*)</a></li>', 2) AS t "
        "FROM pages)"),
})


SQL.update({
    "preview": with_("fact_flights") + (
        "SELECT * FROM fact_flights ORDER BY fid ASC NULLS LAST LIMIT 5"),
    "strike_ids": with_("fact_strikes") + "SELECT sid, fid FROM fact_strikes",
    "rep_customer": with_("customers") + "SELECT cid, customer, country FROM customers",
})


# ------------------------------------------ person pipeline from HTML
CTE.update({
    "mr_raw": (
        "mr_raw AS (SELECT CAST(row_number() OVER (ORDER BY row_index) - 1 AS BIGINT) "
        "AS row_index, Name, Birth, Death, Claim FROM raw_people "
        "WHERE row_index NOT IN (18, 25, 48))"),
    "mr_split": CTE["psplit"].replace("psplit AS", "mr_split AS").replace(
        "FROM raw_people", "FROM mr_raw"),
    "mr_pre": (
        "mr_pre AS (SELECT row_index, CASE WHEN row_index = 0 THEN 'Alfred the Great' ELSE "
        "array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') END AS Name, "
        "\"desc\", Birth, Death, Claim, CASE WHEN row_index = 29 THEN '1307 – 1327' "
        "WHEN row_index = 3 THEN '927 – 939' ELSE NULLIF(regexp_extract(\"desc\", '" + C.DATE_RANGE_PATTERN
        + "', 1), '') END AS dates FROM (SELECT *, list_filter(string_split_regex(name, '\\s+'), "
        "lambda x: x <> '') AS l FROM mr_split))"),
    "mr_fin": (
        "mr_fin AS (SELECT row_index, Name, \"desc\", d2 AS dates, "
        "TRY_CAST(trim(string_split(trim(d2), '–')[1]) AS INTEGER) AS start, "
        "TRY_CAST(trim(string_split(trim(d2), '–')[2]) AS INTEGER) AS \"end\", "
        "TRY_CAST(NULLIF(regexp_extract(Birth, '" + C.YEAR_PATTERN + "', 1), '') AS INTEGER) AS Birth, "
        "TRY_CAST(NULLIF(regexp_extract(Death, '" + C.YEAR_PATTERN + "', 1), '') AS INTEGER) AS Death, "
        "CASE WHEN row_index = 10 THEN NULL WHEN row_index = 45 THEN 'spouse' ELSE "
        "regexp_replace(NULLIF(regexp_extract(cl, '" + "(?i)" + C.CLAIM_PARENT_PATTERN + "', 1), ''), "
        "'^(.*?[^ IV])[A-Z].*$', '\\1') END AS Claim, "
        "NULLIF(regexp_extract(cl, '" + "(?i)" + C.CLAIM_RELATION_PATTERN + "', 1), '') AS ClaimRelation "
        "FROM (SELECT *, regexp_replace(dates, '" + C.DAY_MONTH_PATTERN + "', ' ', 'g') AS d2, "
        "regexp_replace(Claim, '" + C.CLAIM_OF_PATTERN + "', 'of', 'g') AS cl FROM mr_pre))"),
})
DEPS.update({
    "mr_raw": ("pbase", "raw_people"),
    "mr_split": ("pbase", "raw_people", "mr_raw"),
    "mr_pre": ("pbase", "raw_people", "mr_raw", "mr_split"),
    "mr_fin": ("pbase", "raw_people", "mr_raw", "mr_split", "mr_pre"),
})
SQL.update({
    "monarch_from_html": with_("mr_fin") + (
        "SELECT CAST(row_number() OVER (ORDER BY start ASC NULLS LAST, row_index) - 1 AS BIGINT) "
        "AS idx, * FROM mr_fin"),
})


# ------------------------------------- incident reports on the loaded tables
_LOADED_BY_AIRLINE = (
    "SELECT CAST(COUNT(s.sid) AS BIGINT) AS strikCount, f.airline FROM fact_strikes s "
    "JOIN fact_flights f ON s.fid = f.fid GROUP BY f.airline")
SQL.update({
    "strikes_by_state_loaded": with_("fact_strikes", "fact_flights") + (
        "SELECT CAST(COUNT(s.sid) AS BIGINT) AS strikCount, a.airportState FROM fact_strikes s "
        "JOIN fact_flights f ON s.fid = f.fid JOIN dim_airports a ON f.origin = a.aid "
        "GROUP BY a.airportState ORDER BY strikCount DESC, airportState ASC NULLS LAST LIMIT 10"),
    "above_avg_airlines_loaded": with_("fact_strikes", "fact_flights") + (
        "SELECT strikCount, airline FROM (" + _LOADED_BY_AIRLINE + ") c WHERE strikCount > "
        "(SELECT AVG(strikCount) FROM (" + _LOADED_BY_AIRLINE + "))"),
    "strikes_by_month_loaded": with_("fact_strikes", "fact_flights") + (
        "SELECT CAST(SUM(s.numbirds) AS BIGINT) AS birds, strftime(f.date, '%m') AS month "
        "FROM fact_strikes s JOIN fact_flights f ON s.fid = f.fid GROUP BY month"),
})


# ------------------------------------------ sales marts on the loaded tables
CTE["dim_reps"] = "dim_reps AS (SELECT rid, fname, lname, region FROM reps)"
DEPS["dim_reps"] = ("reps",)
_grains("_loaded", "fact_sales", "dim_products", "dim_reps")
SQL.update({
    "prod_facts_loaded": with_("pfacts_loaded") + "SELECT * FROM pfacts_loaded",
    "rep_facts_loaded": with_("rfacts_loaded") + "SELECT * FROM rfacts_loaded",
})

# ------------------------------------- other forms of the same results
# The same rows by another plan share their SQL.
SQL.update({
    "rep_facts_unnested": SQL["rep_facts_shared"],
    "top_reps_nested": SQL["top_reps"],
    "xml_split_files": SQL["xml_multi_file"],
    "csv_split_scan": SQL["csv_scan"],
    "fk_orphans_one_pass": SQL["fk_orphans"],
    "csv_fill": (
        "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, "
        "CASE WHEN l_linenumber IN (4, 6) THEN '' ELSE l_linestatus END AS l_linestatus, "
        "CASE WHEN l_linenumber % 2 = 1 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE '' END AS shipped FROM lineitem"),
    "observed_checks": with_("gaps") + (
        "SELECT 'rows' AS \"check\", COUNT(*) AS violations FROM gaps "
        + "".join(f"UNION ALL SELECT 'null {c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM gaps "
                  for c in ("date", "quantity", "ridFK", "pidFK", "cidFK"))
        + "UNION ALL SELECT 'check quantity above 2', COUNT(*) FILTER (WHERE NOT (quantity > 2)) FROM gaps"),
})
