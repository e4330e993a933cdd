"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the shared Parquet tables (through ``martforge.views``) or
data Spark derives from them, over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import views as V
from martforge.functions import clean as C
from martforge.operators import keys as K
from martforge.operators import marts as M
from martforge.operators import people as P
from martforge.operators import quality as Q
from martforge.operators import reports as R
from martforge.operators import upsert as U
from martforge.plans import sales_load as SL
from martforge.plans import strikes_load as STL
from martforge.session import scratch_dir
from martforge.sources import csv as CSV
from martforge.sources import html as H
from martforge.sources import sinks as SK
from martforge.sources import xml as X
from martforge.streaming import upsert_stream as US

Query = Callable[[SparkSession, str], DataFrame]


def _rep_facts(spark, d):
    return M.rep_facts(V.sales(spark, d), V.products(spark, d), V.reps(spark, d))


def _prod_month(spark, d):
    return M.prod_month(V.sales(spark, d), V.products(spark, d))


QUERIES: dict[str, Query] = {
    # ---------------------------------------------------------------- marts
    "prod_total": lambda s, d: M.prod_total(V.sales(s, d), V.products(s, d)),
    "prod_quarter": lambda s, d: M.prod_quarter(V.sales(s, d), V.products(s, d)),
    "prod_region": lambda s, d: M.prod_region(V.sales(s, d), V.products(s, d), V.reps(s, d)),
    "rep_total": lambda s, d: M.rep_total(V.sales(s, d), V.reps(s, d)),
    "rep_quarter": lambda s, d: M.rep_quarter(V.sales(s, d), V.reps(s, d)),
    "rep_product_total": lambda s, d: M.rep_product_total(
        V.sales(s, d), V.products(s, d), V.reps(s, d)),
    "prod_facts": lambda s, d: M.prod_facts(V.sales(s, d), V.products(s, d), V.reps(s, d)),
    "prod_facts_shared": lambda s, d: M.prod_facts(
        V.sales(s, d), V.products(s, d), V.reps(s, d), shared_base=True),
    "prod_facts_three_scans": lambda s, d: M.prod_facts(
        V.sales(s, d), V.products(s, d), V.reps(s, d), shared_base=False),
    "rep_facts": _rep_facts,
    "rep_facts_shared": lambda s, d: M.rep_facts(
        V.sales(s, d), V.products(s, d), V.reps(s, d), shared_base=True),
    "rep_facts_three_scans": lambda s, d: M.rep_facts(
        V.sales(s, d), V.products(s, d), V.reps(s, d), shared_base=False),
    # The nested marts (one scan of the fact), unnested as a reader does.
    "prod_facts_unnested": lambda s, d: M.unnest_mart(M.prod_mart(V.sales(s, d), V.products(s, d), V.reps(s, d))),
    "rep_facts_unnested": lambda s, d: M.unnest_mart(M.rep_mart(V.sales(s, d), V.products(s, d), V.reps(s, d))),
    "prod_month": _prod_month,
    "monthly_sales": lambda s, d: M.monthly_sales(V.sales(s, d), V.products(s, d)),
    "prod_total_by_name": lambda s, d: M.prod_total_by_name(V.sales(s, d), V.products(s, d)),
    "prod_quarter_named": lambda s, d: M.prod_quarter_named(V.sales(s, d), V.products(s, d)),
    "prod_region_named": lambda s, d: M.prod_region_named(
        V.sales(s, d), V.products(s, d), V.reps(s, d)),
    "rep_quarter_named": lambda s, d: M.rep_quarter_named(V.sales(s, d), V.reps(s, d)),
    "rep_product_named": lambda s, d: M.rep_product_named(
        V.sales(s, d), V.products(s, d), V.reps(s, d)),
    "prod_reps": lambda s, d: M.prod_reps(V.reps(s, d)),
    "prod_customers": lambda s, d: M.prod_customers(V.customers(s, d)),
    "rep_product": lambda s, d: M.rep_product(V.sales(s, d), V.products(s, d)),
    # -------------------------------------------------------------- reports
    "top_reps": lambda s, d: R.top_reps(_rep_facts(s, d)),
    "top_reps_nested": lambda s, d: M.top_of_mart(M.rep_mart(V.sales(s, d), V.products(s, d), V.reps(s, d))),
    "month_levels": lambda s, d: R.month_levels(_prod_month(s, d)),
    "month_total": lambda s, d: R.month_total(_prod_month(s, d)),
    "strikes_by_state": lambda s, d: R.strikes_by_state(
        V.strikes(s, d), V.flights(s, d), V.airports(s, d)),
    "above_avg_airlines": lambda s, d: R.above_avg_airlines(V.strikes(s, d), V.flights(s, d)),
    "avg_strikes_per_airline": lambda s, d: R.avg_strikes_per_airline(
        V.strikes(s, d), V.flights(s, d)),
    "strikes_by_month": lambda s, d: R.strikes_by_month(
        V.strikes(s, d), V.flights(s, d, with_customer=False)),
}


# ===================================================================== loads


def _sales(s, d, policy="error"):
    return SL.SalesLoad(V.raw_txn(s, d), V.raw_rep_records(s, d), V.LINEITEM_ORDER, policy, V.table(s, d, "lineitem"))


def _sales_with_gaps(s, d, policy):
    return SL.SalesLoad(V.raw_txn_with_gaps(s, d), V.raw_rep_records(s, d), V.LINEITEM_ORDER, policy, V.table(s, d, "lineitem"))


def _strikes(s, d):
    return STL.StrikesLoad(V.raw_strikes(s, d), V.LINEITEM_ORDER, order_source=V.table(s, d, "lineitem"))


def _typed_txn(df):
    return df.select(C.parse_us_date("date").alias("date"), "cust", "prod",
                     C.lenient_int("qty").alias("quantity"),
                     C.lenient_int("amount").alias("amount"), "country",
                     C.lenient_int("repID", "bigint").alias("repID"))


def _xml_txn(s, d):
    xml = X.records_to_xml(V.raw_txn(s, d), "txn", SL.TXN_FIELDS)
    return X.parse_xml_column(xml, "xml", SL.TXN_FIELDS)


def _xml_reps(s, d):
    xml = X.records_to_xml(V.raw_rep_records(s, d), "rep", SL.REP_FIELDS, attributes=["rID"])
    return SL.load_reps(X.parse_xml_column(xml, "xml", SL.REP_FIELDS, attributes=["rID"]))


def _write_txn_files(s, d):
    """Sales records as XML files named ``pharmaSale<year>-<n>.xml``, each
    record inside an ``entry`` element below the root, plus records that the
    name pattern must skip, in a folder whose own name matches it."""
    root = scratch_dir(s, "txn-xml")
    txn = V.raw_txn(s, d).select(
        F.struct(*SL.TXN_FIELDS).alias("txn"),
        F.concat(F.lit("pharmaSale"), F.year("l_shipdate").cast("string")).alias("file"))
    X.write_xml_files(txn, root, "entry", "sales", "file")
    decoy = V.raw_rep_records(s, d).select(
        F.lit("1/1/2000").alias("date"), F.col("firstName").alias("cust"),
        F.col("lastName").alias("prod"), F.lit("1").alias("qty"), F.lit("1").alias("amount"),
        F.col("territory").alias("country"), F.lit("0").alias("repID"),
        F.lit("pharmaReps").alias("file"))
    X.write_xml_files(decoy, f"{root}/pharmaSale.xml", "txn", "sales", "file")
    return root


def _xml_multi_file(s, d):
    """S1 + S4, exact order: whole documents, (file, position)."""
    root = _write_txn_files(s, d)
    rows = X.read_xml_documents(s, root, "txn", SL.TXN_FIELDS, file_regex=r"pharmaSale.*\.xml")
    return _typed_txn(rows)


def _xml_rowtag_multi_file(s, d):
    """S1 + S4, scalable: Spark's row-tag reader splits the files."""
    root = _write_txn_files(s, d)
    rows = X.read_xml_records(s, root, "txn", SL.TXN_FIELDS, file_regex=r"pharmaSale.*\.xml")
    return _typed_txn(rows)


def _xml_split_files(s, d):
    """S1 + S4, exact order, each file read by as many tasks as it has splits."""
    root = _write_txn_files(s, d)
    return _typed_txn(X.read_xml_split(s, root, "txn", SL.TXN_FIELDS, file_regex=r"pharmaSale.*\.xml"))


def _csv_scan(s, d, read=CSV.read_csv_text):
    root = scratch_dir(s, "strikes-csv")
    # Aircraft names with quotes, commas and line ends, as real files have them.
    n = F.col("l_linenumber") % 3
    odd = (F.when(n == 0, F.concat(F.lit('A "'), F.col("aircraft"), F.lit('", old')))
           .when(n == 1, F.concat(F.col("aircraft"), F.lit("\nsecond line"))).otherwise(F.col("aircraft")))
    CSV.write_csv_text(V.raw_strikes(s, d).withColumn("aircraft", odd).select(*STL.CSV_FIELDS), root)
    raw = read(s, root, STL.CSV_FIELDS)
    return raw.select(C.lenient_int("rid", "bigint").alias("rid"),
                      C.parse_us_date("flight_date").alias("flight_date"),
                      "origin", "airline", "aircraft",
                      C.altitude_parse("altitude_ft").alias("altitude"),
                      "heavy_flag", "sky_conditions",
                      C.lenient_int("wildlife_struck").alias("wildlife_struck"),
                      "impact", "damage")


def _csv_fill(s, d):
    """S5 with ``fill``: records as text, those of even line numbers without
    their last field, those of line numbers 4 and 6 without the last two."""
    root = scratch_dir(s, "short-csv")
    n = F.col("l_linenumber")
    short = F.concat_ws(",", F.col("l_orderkey").cast("string"), n.cast("string"), F.col("l_returnflag"),
                        F.when(~n.isin(4, 6), F.col("l_linestatus")), F.when(n % 2 == 1, F.date_format("l_shipdate", "yyyy-MM-dd")))
    # Written with another separator, so that the commas stay as they are.
    header = "l_orderkey,l_linenumber,l_returnflag,l_linestatus,shipped"
    V.table(s, d, "lineitem").select(short.alias(header)).write.option("header", "true").option("sep", "\t").csv(root)
    return CSV.read_csv_text(s, root, fill=True)


def _odd_date():
    """Order dates as text, some of them no dates (by o_orderkey mod 6)."""
    n = F.col("o_orderkey") % 6
    return (F.when(n == 0, F.concat(F.lit("2/30/"), F.year("o_orderdate").cast("string")))
            .when(n == 1, "13/1/2020").when(n == 2, "soon").when(n == 3, "")
            .otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm")))


def _odd_amount():
    """Prices as text, some of them no numbers (by l_linenumber)."""
    n, price = F.col("l_linenumber"), F.col("l_extendedprice").cast("string")
    return (F.when(n == 1, "abc").when(n == 2, "NaN").when(n == 3, "").when(n == 4, "99999999999")
            .when(n == 5, F.concat(F.lit(" -"), price, F.lit(" "))).otherwise(price))


PROD_MONTH_SCHEMA = T.StructType([
    T.StructField("pid", T.LongType()), T.StructField("pname", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("total_sold_per_month", T.LongType())])


def _sink_overwrite(s, d):
    name = scratch_dir(s, "prod_reps")
    SK.materialize(M.prod_reps(V.reps(s, d)), "prod_reps", path=name)
    return SK.materialize(M.prod_reps(V.reps(s, d)), "prod_reps", path=name)


def _sink_append(s, d):
    name = scratch_dir(s, "prod_customers")
    SK.materialize(M.prod_customers(V.customers(s, d)), "prod_customers", path=name)
    return SK.materialize(M.prod_customers(V.customers(s, d)), "prod_customers",
                          mode="append", path=name)


def _materialize_mart(s, d):
    return SK.materialize(_prod_month(s, d), "prod_month", schema=PROD_MONTH_SCHEMA,
                          path=scratch_dir(s, "prod_month"))


def _monthly_sales_table(s, d):
    """M7: monthly_sales saved, then read back."""
    return SK.materialize(M.monthly_sales(V.sales(s, d), V.products(s, d)), "monthly_sales",
                          path=scratch_dir(s, "monthly_sales"))


def _fk_orphans(s, d):
    sales = V.sales_with_gaps(s, d)
    out = Q.fk_orphan_counts(sales, V.reps(s, d), [("ridFK", "rid")])
    out = out.unionByName(Q.fk_orphan_counts(sales, V.products(s, d), [("pidFK", "pid")]))
    with_customer = V.sales_with_gaps(s, d, with_customer=True)  # the only check that needs orders
    return out.unionByName(Q.fk_orphan_counts(with_customer, V.customers(s, d), [("cidFK", "cid")]))


def _fk_orphans_one_pass(s, d):
    """V1 for all three keys of the sales in one pass over them."""
    return Q.fk_orphans_of(V.sales_with_gaps(s, d, with_customer=True), {
        "ridFK": (V.reps(s, d), "rid"), "pidFK": (V.products(s, d), "pid"), "cidFK": (V.customers(s, d), "cid")})


def _observed_checks(s, d):
    """V3 and V4 counted by the job that writes the sales: (check, violations)."""
    found = Q.checked_write(V.sales_with_gaps(s, d, with_customer=True), scratch_dir(s, "checked-sales"),
                            ["date", "quantity", "ridFK", "pidFK", "cidFK"], {"quantity above 2": F.col("quantity") > 2})
    return s.createDataFrame(sorted(found.items()), "check string, violations long")


def _key_policy_append(s, d):
    """D8 over two appends: customers with even keys, then all of them; a key
    that the table holds stays as it is (its country was set to null)."""
    name, c = scratch_dir(s, "customers-appended"), V.customers(s, d)
    first = c.where(F.col("cid") % 2 == 0).withColumn("country", F.lit(None).cast("string"))
    for part in (first, c):
        table = SK.materialize(part, "customers", mode="append", key="cid", key_policy="keep_first",
                               order_cols=["customer"], path=name)
    return table


def _schema_listing(s, d):
    """The columns of the loaded flights, with the number of values in each."""
    flights = _strikes(s, d).flights
    counts = flights.agg(*[F.count(c).alias(c) for c in flights.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in flights.columns)
    return (SK.describe(flights).select("cid", "name", "type")
            .join(counts.selectExpr(f"stack({len(flights.columns)}, {stack}) AS (name, n_values)"), "name")
            .select("cid", "name", "type", "n_values"))


def _union_all(s, d):
    li = V.table(s, d, "lineitem")
    open_ = li.where(F.col("l_linestatus") == "O")
    rest = li.where(~(F.col("l_linestatus") == "O") | F.col("l_linestatus").isNull())
    parts = [p.select("l_orderkey", "l_linenumber", "l_linestatus") for p in (open_, rest)]
    return parts[0].unionByName(parts[1])


QUERIES.update({
    # --------------------------------------------------------- scalar parsing
    "rep_id_parse": lambda s, d: V.raw_rep_records(s, d).select(
        F.col("rID").alias("raw"), C.rep_id_parse("rID").alias("rid")),
    "parse_us_date": lambda s, d: V.table(s, d, "orders").select(
        "o_orderkey",
        C.parse_us_date(_odd_date()).alias("date")),
    "lenient_int": lambda s, d: V.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        C.lenient_int(_odd_amount()).alias("amount")),
    "altitude_parse": lambda s, d: V.table(s, d, "orders").select(
        "o_orderkey",
        C.altitude_parse(F.format_number(F.col("o_totalprice").cast("long"), 0)).alias("altitude")),
    "null_default": lambda s, d: V.table(s, d, "customer").select(
        F.col("c_custkey").alias("cid"),
        C.null_default(F.nullif("c_mktsegment", F.lit("MACHINERY")), "Unknown").alias("segment")),
    "text_flag": lambda s, d: V.raw_strikes(s, d).select(
        "l_orderkey", "l_linenumber", C.text_flag("heavy_flag", "Yes").alias("heavy"),
        C.text_flag("damage", "Caused damage").alias("damage")),
    # ------------------------------------------------------------ XML / CSV
    "xml_txn_scan": lambda s, d: _typed_txn(_xml_txn(s, d)),
    "xml_rep_scan": _xml_reps,
    "xml_product_scan": lambda s, d: X.leaf_text(_xml_txn(s, d), "prod"),
    "xml_multi_file": _xml_multi_file,
    "xml_rowtag_multi_file": _xml_rowtag_multi_file,
    "xml_split_files": _xml_split_files,
    "csv_scan": _csv_scan,
    "csv_split_scan": lambda s, d: _csv_scan(s, d, CSV.read_csv_split),
    "csv_fill": _csv_fill,
    # ---------------------------------------------------------------- sinks
    "sink_overwrite": _sink_overwrite,
    "sink_append": _sink_append,
    "materialize_mart": _materialize_mart,
    "monthly_sales_table": _monthly_sales_table,
    # Every record becomes one row of the table (an unmatched one aborts the load).
    "txn_row_count": lambda s, d: SK.row_count(_sales(s, d).records),
    "key_policy_append": _key_policy_append,
    "schema_listing": _schema_listing,
    # ------------------------------------------------------- sales load
    "dim_products": lambda s, d: _sales(s, d).products,
    "dim_customers": lambda s, d: _sales(s, d).customers,
    "dim_reps": lambda s, d: _sales(s, d).reps,
    "cust_reps": lambda s, d: _sales(s, d).cust_reps,
    "fact_sales": lambda s, d: _sales(s, d).salestxn,
    "fact_sales_orphans_null": lambda s, d: _sales_with_gaps(s, d, "null").salestxn,
    "fact_sales_orphans_drop": lambda s, d: _sales_with_gaps(s, d, "drop").salestxn,
    # ---------------------------------------------------- incident load
    "dim_airports": lambda s, d: _strikes(s, d).airports,
    "fact_flights": lambda s, d: _strikes(s, d).flights,
    "dim_conditions": lambda s, d: _strikes(s, d).conditions,
    "fact_strikes": lambda s, d: _strikes(s, d).strikes,
    "flight_origin_lookup": lambda s, d: _strikes(s, d).flights.select("fid", "origin"),
    "strike_condition_lookup": lambda s, d: _strikes(s, d).strikes.select(
        "sid", "conditions"),
    "first_strike_per_flight": lambda s, d: STL.first_strike_per_flight(
        _strikes(s, d).strikes),
    # -------------------------------------------------------------- quality
    "fk_orphans": _fk_orphans,
    "fk_orphans_one_pass": _fk_orphans_one_pass,
    "observed_checks": _observed_checks,
    "pk_duplicates": lambda s, d: Q.pk_duplicates(
        V.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "not_null_violations": lambda s, d: Q.not_null_violations(
        V.sales_with_gaps(s, d, with_customer=True), ["date", "quantity", "ridFK", "pidFK", "cidFK"]),
    # Altitudes above a plateau, so that the rules have something to find.
    "check_violations": lambda s, d: Q.check_violations(
        V.flights(s, d).withColumn("altitude", F.col("altitude") - 100_000),
        F.col("altitude") > 0).select("fid", "altitude"),
    "check_violations_strikes": lambda s, d: Q.check_violations(
        V.strikes(s, d).withColumn("altitude", F.col("altitude") - 20_000),
        F.col("altitude") >= 0).select("fid", "numbirds", "altitude"),
    "key_policy_first": lambda s, d: K.apply_key_policy(
        QUERIES["prod_facts"](s, d), "pid", "keep_first", ["year", "quarter", "region"]),
    "union_all": _union_all,
})


# ==================================================================== upsert


def _upsert(s, d):
    t = _strikes(s, d).stored()
    return U.record_strikes(V.strike_batch(s, d), t["airports"], t["flights"], t["strikes"],
                            t["conditions"], ["bord"])


def _upsert_indexed(s, d, name):
    """The same upsert on stored tables, through their key index and marks,
    then compacted and read back."""
    t, root = _strikes(s, d), scratch_dir(s, "strike-tables")
    t.staged  # all tables are written, each from the numbered records
    US.init_tables({"airports": t.airports, "flights": t.flights, "strikes": t.strikes, "conditions": t.conditions}, root)
    US.upsert_batch(V.strike_batch(s, d), 0, root, ["bord"])
    US.compact(s, root, 0)
    return US.read_tables(s, root)[name]


QUERIES.update({
    "upsert_airports_indexed": lambda s, d: _upsert_indexed(s, d, "airports"),
    "upsert_flights_indexed": lambda s, d: _upsert_indexed(s, d, "flights"),
    "upsert_strikes_indexed": lambda s, d: _upsert_indexed(s, d, "strikes"),
    "upsert_airports": lambda s, d: _upsert(s, d)["airports"],
    "upsert_flights": lambda s, d: _upsert(s, d)["flights"],
    "upsert_strikes": lambda s, d: _upsert(s, d)["strikes"],
})


# ==================================================================== people


def _raw_people(s, d):
    return V.person_records(s, d)


def _split(s, d):
    r = _raw_people(s, d)
    name, desc = C.name_desc_split(C.strip_footnotes("Name"))
    return r.select("row_index", name.alias("name"), desc.alias("desc"))


def _people(s, d):
    return P.monarch_clean(_raw_people(s, d))


def _unsorted_people(s, d):
    return P.finish_people(P.clean_people(_raw_people(s, d)))


QUERIES.update({
    "union_missing_cols": _raw_people,
    "strip_footnotes": lambda s, d: _raw_people(s, d).select(
        "row_index", C.strip_footnotes("Name").alias("Name")),
    "name_desc_split": _split,
    "dedupe_words": lambda s, d: _split(s, d).select(
        "row_index", C.dedupe_words("name").alias("Name")),
    "date_range_extract": lambda s, d: _split(s, d).select(
        "row_index", C.date_range_extract("desc").alias("dates")),
    "reign_parse": lambda s, d: _unsorted_people(s, d).select("row_index", "start", "end"),
    "year_extract": lambda s, d: _unsorted_people(s, d).select("row_index", "Birth", "Death"),
    "claim_parse": lambda s, d: _raw_people(s, d).select(
        "row_index", C.claim_parent(C.claim_of("Claim")).alias("Claim")),
    "claim_relation": lambda s, d: _unsorted_people(s, d).select("row_index", "ClaimRelation"),
    "glued_name_cut": lambda s, d: _unsorted_people(s, d).select("row_index", "Claim"),
    "char_set_trim": lambda s, d: _unsorted_people(s, d).select(
        "row_index", C.char_set_trim("Name", P.FIRST_REIGN).alias("Name")),
    "reject_rows": lambda s, d: P.reject_rows(_raw_people(s, d), P.SOURCE_REJECT_POSITIONS),
    "point_overrides": lambda s, d: P.point_overrides(
        _unsorted_people(s, d).select("row_index", "Name", "dates", "Claim"),
        P.overrides_frame(s, P.SOURCE_OVERRIDES)),
    "monarch_clean": _people,
    "monarch_order": lambda s, d: _people(s, d).select("idx", "row_index", "start"),
    "lineage": lambda s, d: P.lineage(_people(s, d)),
    "second_reign": lambda s, d: P.second_reign(_people(s, d)),
    "reign_segments": lambda s, d: P.reign_segments(_people(s, d)),
    "year_span": lambda s, d: P.year_span(_people(s, d)),
    "year_grid": lambda s, d: P.year_grid(_people(s, d)),
    "timeline_layout": lambda s, d: P.timeline_layout(_people(s, d)),
    "lineage_edges": lambda s, d: P.lineage_edges(_people(s, d)),
})


# ====================================================================== html


def _line_documents(s, d):
    """One small HTML page per line item (no grouping): a table of another
    class, then a ``wikitable`` with two header rows and two body rows.  The
    Name cell spans both rows and holds hidden text.  Closed lines (status F)
    have a Claim column whose cell spans into a second row that is too short
    to reach it.  Even line numbers leave the table unclosed."""
    li = V.table(s, d, "lineitem")
    cell = lambda c: F.concat(F.lit("<td>"), c.cast("string"), F.lit("</td>"))
    closed = F.col("l_linestatus") == "F"
    claim1 = F.when(closed, F.concat(F.lit("<td rowspan=\"2\">Son of "), F.col("l_returnflag"), F.lit("</td>"))) \
        .otherwise(F.lit(""))
    last = F.when(closed, F.lit("")).otherwise(cell(F.month("l_shipdate")))
    header = F.concat(F.lit("<tr><th rowspan=\"2\">Name</th><th>Birth</th><th rowspan=\"2\">Death</th>"),
                      F.when(closed, F.lit("<th>Claim</th>")).otherwise(F.lit("")), F.lit("</tr><tr><th>year</th>"),
                      F.when(closed, F.lit("<th>Claim</th>")).otherwise(F.lit("")), F.lit("</tr>"))
    row1 = F.concat(F.lit("<tr><td rowspan=\"2\">Part <span style=\"display: none\">no. <b>x</b></span>"),
                    F.col("l_partkey").cast("string"), F.lit("</td>"), cell(F.col("l_quantity").cast("int")),
                    cell(F.year("l_shipdate")), claim1, F.lit("</tr>"))
    row2 = F.concat(F.lit("<tr>"), cell(F.col("l_linenumber")), last, F.lit("</tr>"))
    end = F.when(F.col("l_linenumber") % 2 == 0, F.lit("")).otherwise(F.lit("</table></body></html>"))
    html = F.concat(F.lit("<html><body><table class=\"infobox\"><tr><th>Name</th></tr><tr><td>decoy</td></tr></table>"
                          "<table class=\"wikitable sortable\">"), header, row1, row2, end)
    return li.select("l_orderkey", "l_linenumber", html.alias("html"))


def _html_table_extract(s, d):
    t = H.html_tables(_line_documents(s, d), "html", "wikitable",
                      keep=["l_orderkey", "l_linenumber"])
    return t.select("l_orderkey", "l_linenumber", "table_no", "row_no", H.table_column("Name"),
                    H.table_column("Birth year").alias("Birth"), H.table_column("Death"), H.table_column("Claim"))


QUERIES.update({
    "html_table_extract": _html_table_extract,
    "html_list_items": lambda s, d: H.html_links(V.table(s, d, "pages"), "html",
                                                 keep=["page_id"]),
})


# ================================================================== previews
QUERIES.update({
    # O3: the source previews tables with an unordered LIMIT; ordered by key here.
    "preview": lambda s, d: R.preview(_strikes(s, d).flights, "fid", 5),
    "strike_ids": lambda s, d: _strikes(s, d).strikes.select("sid", "fid"),
    "rep_customer": lambda s, d: M.prod_customers(V.customers(s, d)),
})


# ================================================= person pipeline from HTML
def _person_documents(s, d):
    """One HTML page per person record: a one-row ``wikitable``, with a Claim
    column only where the record has one (the claim-less table kind)."""
    raw = _raw_people(s, d)
    esc = lambda c: F.coalesce(F.regexp_replace(F.regexp_replace(
        c, "&", "&amp;"), "<", "&lt;"), F.lit(""))
    cell = lambda c: F.concat(F.lit("<td>"), esc(c), F.lit("</td>"))
    has_claim = F.col("Claim").isNotNull()
    html = F.concat(
        F.lit("<html><body><table class=\"wikitable\"><tr><th>Name</th><th>Birth</th>"
              "<th>Death</th>"),
        F.when(has_claim, F.lit("<th>Claim</th>")).otherwise(F.lit("")), F.lit("</tr><tr>"),
        cell(F.col("Name")), cell(F.col("Birth")), cell(F.col("Death")),
        F.when(has_claim, cell(F.col("Claim"))).otherwise(F.lit("")),
        F.lit("</tr></table></body></html>"))
    return raw.select(F.col("row_index").alias("doc_no"), html.alias("html"))


def _monarch_from_html(s, d):
    t = H.html_tables(_person_documents(s, d), "html", "wikitable", keep=["doc_no"])
    empty_null = lambda n: F.nullif(H.table_column(n), F.lit("")).alias(n)
    raw = K.dense_ids(
        t.select("doc_no", "table_no", "row_no", empty_null("Name"), empty_null("Birth"),
                 empty_null("Death"), empty_null("Claim")),
        ["doc_no", "table_no", "row_no"], "row_index", offset=-1, tie_breaker="row_no")
    early = [o for o in P.SOURCE_OVERRIDES if o[1] in ("Name", "dates")]
    late = [o for o in P.SOURCE_OVERRIDES if o[1] == "Claim"]
    return P.monarch_clean(raw.select("row_index", "Name", "Birth", "Death", "Claim"),
                           rejects=P.SOURCE_REJECT_POSITIONS,
                           early_overrides=P.overrides_frame(s, early),
                           late_overrides=P.overrides_frame(s, late))


QUERIES.update({"monarch_from_html": _monarch_from_html})


# ======================================= incident reports on the loaded tables
def _loaded_reports(s, d):
    t = _strikes(s, d)
    return t.strikes, t.flights, t.airports


QUERIES.update({
    # M12 over M13: the reports as the source runs them, on the normalised
    # tables (a flight whose origin was missing has no airport: Q3).
    "strikes_by_state_loaded": lambda s, d: R.strikes_by_state(
        *_loaded_reports(s, d), count_col="sid"),
    "above_avg_airlines_loaded": lambda s, d: R.above_avg_airlines(
        *_loaded_reports(s, d)[:2], count_col="sid"),
    "strikes_by_month_loaded": lambda s, d: R.strikes_by_month(*_loaded_reports(s, d)[:2]),
})


# =========================================== sales marts on the loaded tables
def _loaded_sales(s, d):
    t = _sales(s, d)
    return t.salestxn, t.products, t.reps


QUERIES.update({
    # The warehouse step run on the tables the loader produced (M3 / M6 over M15).
    "prod_facts_loaded": lambda s, d: M.prod_facts(*_loaded_sales(s, d)),
    "rep_facts_loaded": lambda s, d: M.rep_facts(*_loaded_sales(s, d)),
})
