"""Logical tables over the shared Parquet test tables.

The reference works on its own databases (products, reps, customers,
salestxn; flights, airports, conditions, strikes; monarch rows).  Here they
are views over the TPC-H-like Parquet tables so every operator runs on data
that grows with the scale factor:

=================  =========================================================
products           part: pid = p_partkey, pname = p_name
reps               supplier + nation + region: rid = s_suppkey, fname / lname
                   = parts of s_name before / after ``#``, region = r_name
customers          customer + nation: cid, customer = c_name, country = n_name
sales (salestxn)   lineitem: date, quantity, amount (truncated), ridFK, pidFK;
                   cidFK only when asked for (needs the orders join)
airports           nation: aid = n_nationkey, airportState = n_name
flights            orders + customer: fid, date, origin, airline, aircraft,
                   altitude, heavy
strikes            lineitem: fid, numbirds, impact, damage, conditions
=================  =========================================================

Only ``nation`` and ``region`` carry an explicit broadcast hint: their size is
fixed (25 and 5 rows) whatever the scale factor.  Every other join is left to
AQE, which broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MATERIALIZED: dict[tuple, str] = {}


def _state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, number of files and time of the last change of what is stored at
    ``path``: two calls, however many files there are."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(p)
    return size.getLength(), size.getFileCount(), fs.getFileStatus(p).getModificationTime()


def materialized(spark: SparkSession, sf_dir: str, name: str, inputs: tuple[str, ...], build) -> DataFrame:
    """A dimension view built from several tables, written once per session.

    Joined views carry a useless size estimate (Spark multiplies the input
    sizes of a join), which can make the planner broadcast the FACT side of a
    later join.  Written once under the checkpoint folder, the dimension has
    its true size, and later queries read it instead of re-joining.  A change
    of an input (its bytes, number of files or time of change) makes it anew.
    """
    from martforge.session import scratch_dir
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name,
           *[_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in inputs])
    path = _MATERIALIZED.get(key)
    if path is None:
        path = scratch_dir(spark, f"view-{name}")
        build().write.mode("overwrite").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def fixed_dim(df: DataFrame) -> DataFrame:
    """Broadcast a dimension whose row count does not grow with the data."""
    return F.broadcast(df)


# ---------------------------------------------------------------- sales (A)

def products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("pid"), F.col("p_name").alias("pname"))


def regions_of_nations(spark: SparkSession, d: str) -> DataFrame:
    """nation -> region name; 25 rows, fixed size."""
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    return fixed_dim(
        nation.join(F.broadcast(region),
                    nation.n_regionkey == region.r_regionkey, "left")
        .select("n_nationkey", "n_name", "r_name"))


def _reps(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    nr = regions_of_nations(spark, d)
    return (s.join(nr, s.s_nationkey == nr.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("rid"),
                    F.split_part("s_name", F.lit("#"), F.lit(1)).alias("fname"),
                    F.split_part("s_name", F.lit("#"), F.lit(2)).alias("lname"),
                    F.col("r_name").alias("region")))


def reps(spark: SparkSession, d: str) -> DataFrame:
    return materialized(spark, d, "reps", ("supplier", "nation", "region"), lambda: _reps(spark, d))


def _customers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    n = fixed_dim(table(spark, d, "nation").select("n_nationkey", "n_name"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("cid"),
                    F.col("c_name").alias("customer"),
                    F.col("n_name").alias("country")))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return materialized(spark, d, "customers", ("customer", "nation"), lambda: _customers(spark, d))


def _ship_date() -> Column:
    return F.to_date("l_shipdate")


def sales(spark: SparkSession, d: str, with_customer: bool = False) -> DataFrame:
    """salestxn without tid.  ``with_customer`` adds cidFK via orders (a sale
    whose order is missing stays, with a null cidFK)."""
    li = table(spark, d, "lineitem")
    cols = [
        _ship_date().alias("date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("int").alias("amount"),
        F.col("l_suppkey").alias("ridFK"),
        F.col("l_partkey").alias("pidFK"),
    ]
    if not with_customer:
        return li.select(*cols)
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "left")
            .select(*cols, F.col("o_custkey").alias("cidFK")))


def sales_with_gaps(spark: SparkSession, d: str, with_customer: bool = False) -> DataFrame:
    """Sales with broken references and missing values, for the checks.

    Mapping (fixed values), by the quantity q: no date if q mod 11 is 0; no
    rep if q mod 10 is 0, an unknown one if it is 1; an unknown product if
    q mod 7 is 0; no customer if q mod 5 is 0, an unknown one if it is 1.
    """
    q, far = F.col("quantity"), F.lit(10 ** 12)
    df = (sales(spark, d, with_customer)
          .withColumn("date", F.when(q % 11 != 0, F.col("date")))
          .withColumn("ridFK", F.when(q % 10 == 1, F.col("ridFK") + far).when(q % 10 != 0, F.col("ridFK")))
          .withColumn("pidFK", F.when(q % 7 == 0, F.col("pidFK") + far).otherwise(F.col("pidFK"))))
    if with_customer:
        df = df.withColumn("cidFK", F.when(q % 5 == 1, F.col("cidFK") + far).when(q % 5 != 0, F.col("cidFK")))
    return df


def raw_txn_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Sales records of which some name no known rep or no customer.

    Mapping (fixed values), by l_linenumber: rep ``abc`` for 1, a rep number
    above 2^31 that nobody has for 2, no customer name for 3.
    """
    n = F.col("l_linenumber")
    return (raw_txn(spark, d)
            .withColumn("repID", F.when(n == 1, "abc").when(n == 2, "99999999999").otherwise(F.col("repID")))
            .withColumn("cust", F.when(n != 3, F.col("cust"))))


# ---------------------------------------------------------- bird strikes (B)

def airports(spark: SparkSession, d: str) -> DataFrame:
    return fixed_dim(table(spark, d, "nation").select(
        F.col("n_nationkey").alias("aid"), F.col("n_name").alias("airportState")))


def flights(spark: SparkSession, d: str, with_customer: bool = True) -> DataFrame:
    """Flights; ``with_customer=False`` skips the customer join (no origin /
    airline columns) for reports that only need the flight's own columns."""
    o = table(spark, d, "orders")
    own = [F.col("o_orderkey").alias("fid"), F.to_date("o_orderdate").alias("date"),
           F.col("o_orderstatus").alias("aircraft"),
           F.col("o_totalprice").cast("int").alias("altitude"),
           (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("heavy")]
    if not with_customer:
        return o.select(*own)
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .select(own[0], own[1], F.col("c_nationkey").alias("origin"),
                    F.col("c_name").alias("airline"), *own[2:]))


def strikes(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("fid"),
        F.col("l_quantity").cast("int").alias("numbirds"),
        F.col("l_linestatus").alias("impact"),
        (F.col("l_returnflag") == "R").cast("int").alias("damage"),
        F.col("l_extendedprice").cast("int").alias("altitude"),
        sky_condition_of(F.col("l_returnflag")).alias("sky_condition"))


def sky_condition_of(flag: Column) -> Column:
    """Return-flag -> sky condition text; 'R' maps to null (exercises J4)."""
    # Fixed values of this mapping.
    return (F.when(flag == "A", F.lit("No Cloud"))
            .when(flag == "N", F.lit("Some Cloud"))
            .otherwise(F.lit(None).cast("string")))


# ------------------------------------------------- raw input records (text)
# The source pipelines start from text records (XML sales files, a CSV of
# incidents).  These views rebuild such records from the Parquet tables, all
# values as text, with the columns that fix the original record order.

LINEITEM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                  "l_linestatus", "l_shipdate"]


def raw_txn(spark: SparkSession, d: str) -> DataFrame:
    """Sales records as in the XML files: date (M/d/yyyy), cust, prod, qty,
    amount, country, repID, all text; plus the lineitem order columns.  A sale
    whose order, customer or part is missing stays, with a null name."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    j = (li.join(p, li.l_partkey == p.p_partkey, "left")
         .join(with_customers(spark, d, o), li.l_orderkey == o.o_orderkey, "left"))
    return j.select(
        *LINEITEM_ORDER,
        F.date_format("l_shipdate", "M/d/yyyy").alias("date"),
        F.col("c_name").alias("cust"),
        F.col("p_name").alias("prod"),
        F.col("l_quantity").cast("int").cast("string").alias("qty"),
        F.col("l_extendedprice").cast("string").alias("amount"),
        F.col("n_name").alias("country"),
        F.col("l_suppkey").cast("string").alias("repID"))


def with_customers(spark: SparkSession, d: str, orders: DataFrame) -> DataFrame:
    """Orders with their customer and nation, if they have one.  Joined before
    the line items meet the orders, which are fewer, so the line items move
    once for all three."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = fixed_dim(table(spark, d, "nation").select("n_nationkey", "n_name"))
    return (orders.join(c, orders.o_custkey == c.c_custkey, "left")
            .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))


def raw_rep_records(spark: SparkSession, d: str) -> DataFrame:
    """Rep records as in the reps XML: rID attribute (``r`` + id), firstName,
    lastName, territory."""
    r = reps(spark, d)
    return r.select(F.concat(F.lit("r"), F.col("rid").cast("string")).alias("rID"),
                    F.col("fname").alias("firstName"), F.col("lname").alias("lastName"),
                    F.col("region").alias("territory"))


def raw_strikes(spark: SparkSession, d: str) -> DataFrame:
    """Incident records as in the CSV: one per lineitem (a strike), its order
    is the flight.  Text columns; missing values are null (written as NA).

    Mapping (fixed values): origin is the customer's nation, missing for
    pending orders (status 'P'); airline is the customer name, blank for the
    HOUSEHOLD segment and missing for MACHINERY; heavy_flag is Yes for
    1-URGENT, missing for 5-LOW, else No; damage is 'Caused damage' for
    return flag R, else 'No damage'.
    """
    li = table(spark, d, "lineitem")
    null = F.lit(None).cast("string")
    # An order's texts are made once, not for each of its line items.
    o = with_customers(spark, d, table(spark, d, "orders")).select(
        "o_orderkey",
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("flight_date"),
        F.when(F.col("o_orderstatus") == "P", null).otherwise(F.col("n_name")).alias("origin"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(""))
        .when(F.col("c_mktsegment") == "MACHINERY", null)
        .otherwise(F.col("c_name")).alias("airline"),
        F.col("o_orderstatus").alias("aircraft"),
        F.format_number(F.col("o_totalprice").cast("long"), 0).alias("altitude_ft"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Yes"))
        .when(F.col("o_orderpriority") == "5-LOW", null)
        .otherwise(F.lit("No")).alias("heavy_flag"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        *LINEITEM_ORDER,
        F.col("l_orderkey").cast("string").alias("rid"),
        "flight_date", "origin", "airline", "aircraft", "altitude_ft", "heavy_flag",
        sky_condition_of(F.col("l_returnflag")).alias("sky_conditions"),
        F.col("l_quantity").cast("int").cast("string").alias("wildlife_struck"),
        F.col("l_linestatus").alias("impact"),
        F.when(F.col("l_returnflag") == "R", F.lit("Caused damage"))
        .otherwise(F.lit("No damage")).alias("damage"))


def strike_batch(spark: SparkSession, d: str) -> DataFrame:
    """A batch of new incidents, one per supplier (upsert input).

    Mapping (fixed values): date = 2023-06-24 plus the nation key in days;
    origin = the supplier's nation, or its region name (a new airport) when
    the account balance is negative; aircraft 'Airplane'; altitude = the
    truncated absolute balance; numbirds = nation key + 1; sky condition
    'No Cloud' from a balance of 5000, 'Some Cloud' from 0, else missing.
    """
    s = table(spark, d, "supplier")
    nr = regions_of_nations(spark, d)
    j = s.join(nr, s.s_nationkey == nr.n_nationkey, "left")
    bal = F.col("s_acctbal")
    return j.select(
        F.col("s_suppkey").alias("bord"),
        F.date_add(F.lit("2023-06-24").cast("date"), F.col("s_nationkey")).alias("date"),
        F.when(bal >= 0, F.col("n_name")).otherwise(F.col("r_name")).alias("origin"),
        F.lit("Airplane").alias("aircraft"),
        F.abs(bal).cast("int").alias("altitude"),
        (F.col("s_nationkey") + 1).alias("numbirds"),
        F.when(bal >= 5000, F.lit("No Cloud")).when(bal >= 0, F.lit("Some Cloud"))
        .otherwise(F.lit(None).cast("string")).alias("conditions"))


# ----------------------------------------------------- person records (C)

def _cap(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def _code(key: Column) -> Column:
    """A letters-only name for a customer key (digits mapped to letters)."""
    digits = key.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), F.lit("0"))
    return _cap(F.translate(padded, "0123456789", "aeioubcdfg"))


def _long_date(c: Column) -> Column:
    return F.date_format(c, "d MMMM yyyy")


def person_records(spark: SparkSession, d: str) -> DataFrame:
    """Scraped-style person rows (row_index, Name, Birth, Death, Claim).

    One row per customer, reign = its first and last order dates; a second
    row for the HOUSEHOLD segment (a second reign).  Built as two frames, one
    without a Claim column (MACHINERY), unioned by name with the missing
    column added as null (P13).  Mapping (fixed values): the name is a
    letters-only code of the key plus ``the <Segment>``, doubled first word
    for BUILDING; AUTOMOBILE reigns start with a bare year; birth = first
    year - 18 - nation key, ``c. <year>[a]`` for a negative balance; death =
    last year (+5 for a balance over 5000); claims by segment: AUTOMOBILE
    ``Son of <code of key-1>``, BUILDING ``Daughter of <code> the <segment>``,
    FURNITURE ``Great-grandson of <code><Segment>`` (glued), HOUSEHOLD
    ``Grandson/son of <code>``.
    """
    c = table(spark, d, "customer")
    o = (table(spark, d, "orders")
         .groupBy("o_custkey")
         .agg(F.min(F.to_date("o_orderdate")).alias("d1"),
              F.max(F.to_date("o_orderdate")).alias("d2")))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    seg = F.col("c_mktsegment")
    segname = _cap(F.lower(seg))
    code = _code(F.col("c_custkey"))
    pcode = _code(F.col("c_custkey") - 1)
    pname = F.when(seg == "BUILDING", F.concat(code, F.lit(" "), code, F.lit(" the "), segname)) \
        .otherwise(F.concat(code, F.lit(" the "), segname))
    household = seg == "HOUSEHOLD"
    note = F.concat(F.lit("["), F.col("c_nationkey").cast("string"), F.lit("]"))
    start1 = F.when(seg == "AUTOMOBILE", F.year("d1").cast("string")).otherwise(_long_date(F.col("d1")))
    end1 = _long_date(F.when(household, F.add_months("d1", 12)).otherwise(F.col("d2")))
    span1 = F.when(F.col("d1").isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" "), start1, F.lit(" – "), end1))
    name1 = F.concat(F.when(household, F.lit("(1st reign) ")).otherwise(F.lit("")),
                     pname, note, span1)
    name2 = F.concat(F.lit("(2nd reign) "), pname, note, F.lit(" "),
                     _long_date(F.add_months("d2", -12)), F.lit(" – "), _long_date(F.col("d2")))
    birth = F.year("d1") - 18 - F.col("c_nationkey")
    birth_t = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("c. "), birth.cast("string"), F.lit("[a]"))) \
        .otherwise(birth.cast("string"))
    death = F.year("d2") + F.when(F.col("c_acctbal") > 5000, F.lit(5)).otherwise(F.lit(0))
    death_t = F.concat(F.date_format("d2", "d MMMM "), death.cast("string"))
    claim = (F.when(seg == "AUTOMOBILE", F.concat(F.lit("Son of "), pcode))
             .when(seg == "BUILDING", F.concat(F.lit("Daughter of "), pcode, F.lit(" the "),
                                                F.lower(seg)))
             .when(seg == "FURNITURE", F.concat(F.lit("Great-grandson of "), pcode, segname))
             .when(household, F.concat(F.lit("Grandson/son of "), pcode)))
    first = j.select("c_custkey", F.lit(0).alias("part"), seg.alias("_seg"),
                     name1.alias("Name"), birth_t.alias("Birth"), death_t.alias("Death"),
                     claim.alias("Claim"))
    second = j.where(household & F.col("d1").isNotNull()).select(
        "c_custkey", F.lit(1).alias("part"), seg.alias("_seg"), name2.alias("Name"),
        birth_t.alias("Birth"), death_t.alias("Death"), claim.alias("Claim"))
    both = first.unionByName(second)
    with_claim = both.where(~(F.col("_seg") == "MACHINERY") | F.col("_seg").isNull())
    without_claim = both.where(F.col("_seg") == "MACHINERY").drop("Claim")
    rows = with_claim.unionByName(without_claim, allowMissingColumns=True)
    from martforge.operators.keys import dense_ids_by_int_key
    from martforge.session import scratch_dir
    # (customer key, part) is unique: number rows by the integer key*2+part
    # (no range sample), then write the records once so later steps read
    # them instead of rebuilding them.
    keyed = rows.withColumn("_rk", F.col("c_custkey") * 2 + F.col("part"))
    ids = dense_ids_by_int_key(keyed, "_rk", "row_index", offset=-1)
    path = scratch_dir(spark, "person-records")
    ids.select("row_index", "Name", "Birth", "Death", "Claim").write.parquet(path)
    return spark.read.parquet(path)
