"""Sales marts: product and rep totals by quarter, region, product and month.

All aggregates are integer ``SUM(quantity)``, computed per block with map-side
partial aggregation.  ``prod_facts`` and ``rep_facts`` take each of their
three blocks from a scan of the fact table by default.  ``shared_base=True``
takes two of them from one (pid, rid) pre-aggregate instead; it was meant to
move less data where no dimension can be broadcast, but measured with
broadcasts off (sf0.1) it shuffles more, as (pid, rid) hardly reduces the
fact: 31 MB against 22 MB for ``prod_facts``, 23 MB against 14 MB for
``rep_facts``.  It pays only where reps sell few products very often.

Every pre-aggregate runs with map-side partial aggregation, so a product or
rep holding a large share of the rows collapses before any shuffle; all
later steps work on aggregated rows whose count per key is bounded (quarters
x regions per product).  Dimension joins are plain joins: AQE broadcasts the
dimension only when its size is under the broadcast threshold and shuffles
otherwise.

Dimension keys (products.pid, reps.rid) are assumed unique, as their declared
primary keys say; ``quality.pk_duplicates`` checks it.

``prod_mart`` and ``rep_mart`` hold the same numbers nested: one row per id
with its total and the arrays of its quarters and of its regions (products).
They read the fact once: ``GROUPING SETS`` adds up all three grains in one
partial aggregation, and their rows meet again per id.  ``unnest_mart`` makes
the flat, fanned-out form of them where a reader wants it; reports that need
the totals only read the nested form.

Fan-out (reproduced on purpose): ``prod_facts`` joins the per-quarter and the
per-region rows of a product only on the product id, so a product has
(#quarters x #regions) rows and ``total_sold`` repeats on each of them.
Summing ``total_sold`` or ``total_sold_per_region`` over that table
over-counts.  ``rep_facts`` has the same shape with products instead of
regions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_period(sales: DataFrame) -> DataFrame:
    """Add year and quarter ints (``(month-1)/3+1`` == ``quarter``)."""
    return sales.withColumn("year", F.year("date")).withColumn("quarter", F.quarter("date"))


def month_label(date_col: str = "date"):
    """``YYYY-MM`` text of a date (null date -> null label)."""
    return F.date_format(date_col, "yyyy-MM")


def _pre(sales: DataFrame, *keys: str) -> DataFrame:
    """Pre-aggregate the fact: keys -> qty = SUM(quantity)."""
    named = {"pid": F.col("pidFK").alias("pid"), "rid": F.col("ridFK").alias("rid"),
             "year": F.year("date").alias("year"), "quarter": F.quarter("date").alias("quarter")}
    return (sales.select(*[named[k] for k in keys], "quantity")
            .groupBy(*keys).agg(F.sum("quantity").alias("qty")))


def sales_base(sales: DataFrame) -> DataFrame:
    """Pre-aggregate: (pid, rid, year, quarter) -> qty = SUM(quantity)."""
    return _pre(sales, "pid", "rid", "year", "quarter")


def _dim_join(agg: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join of a pre-aggregate with a dimension on ``key``.

    Written as a null-safe match against the dimension's non-null keys: the
    same rows as a plain inner equi-join, but Catalyst infers no
    ``key IS NOT NULL`` filter into the aggregate's input, so an aggregate
    used by several blocks stays one plan and its exchange is reused.
    """
    d = dim.where(F.col(key).isNotNull()).withColumnRenamed(key, "_dk")
    return agg.join(d, agg[key].eqNullSafe(d["_dk"])).drop("_dk")


def _fact_keys(sales: DataFrame) -> DataFrame:
    return (with_period(sales)
            .select(F.col("pidFK").alias("pid"), F.col("ridFK").alias("rid"),
                    "year", "quarter", F.col("quantity").alias("qty")))


# ------------------------------------------------------------- product side

def prod_total(sales: DataFrame, products: DataFrame) -> DataFrame:
    """A1: (pid, pname) -> total_sold."""
    return (_pre(sales, "pid").withColumnRenamed("qty", "total_sold")
            .join(products, "pid")
            .select("pid", "pname", "total_sold"))


def prod_quarter(sales: DataFrame, products: DataFrame) -> DataFrame:
    """A2: (pid, year, quarter) -> total_sold_per_quarter_and_year."""
    return (_pre(sales, "pid", "year", "quarter")
            .join(products.select("pid"), "pid", "left_semi")
            .withColumnRenamed("qty", "total_sold_per_quarter_and_year"))


def prod_region(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """A3: (pid, region) -> total_sold_per_region (orphan reps dropped)."""
    return (_pre(sales, "pid", "rid")
            .join(reps.select("rid", "region"), "rid")
            .join(products.select("pid"), "pid", "left_semi")
            .groupBy("pid", "region")
            .agg(F.sum("qty").alias("total_sold_per_region")))


def prod_facts(sales: DataFrame, products: DataFrame, reps: DataFrame,
               shared_base: bool = False) -> DataFrame:
    """M3: A1 LEFT JOIN A2 LEFT JOIN A3 on pid (fan-out; see module doc).

    ``shared_base=True`` computes the total and the regions from one
    (pid, rid) pre-aggregate.
    """
    if shared_base:
        by_rep = _pre(sales, "pid", "rid")
        total = by_rep.groupBy("pid").agg(F.sum("qty").alias("total_sold"))
        quarters = sales.select(F.col("pidFK").alias("pid"), F.year("date").alias("year"),
                                F.quarter("date").alias("quarter")).distinct()
    else:
        base = _fact_keys(sales)
        total = base.groupBy("pid").agg(F.sum("qty").alias("total_sold"))
        # A2's sum is never selected: only its (pid, year, quarter) keys matter.
        quarters = base.select("pid", "year", "quarter").distinct()
        by_rep = base
    regions = (_dim_join(by_rep, reps.select("rid", "region"), "rid")
               .groupBy("pid", "region")
               .agg(F.sum("qty").alias("total_sold_per_region")))
    return (total.join(products, "pid")
            .join(quarters, "pid", "left")
            .join(regions, "pid", "left")
            .select("pid", "pname", "total_sold", "year", "quarter",
                    "region", "total_sold_per_region"))


def prod_month(sales: DataFrame, products: DataFrame) -> DataFrame:
    """(pname, month) -> total_sold_per_month, pid = min(pid).

    The source groups by pname and month but selects a bare pid; several
    products can share a name, so pid is made explicit as ``min(pid)``.
    """
    per_pid = (sales.select(F.col("pidFK").alias("pid"), month_label().alias("month"),
                            "quantity")
               .groupBy("pid", "month").agg(F.sum("quantity").alias("q")))
    return (per_pid.join(products, "pid")
            .groupBy("pname", "month")
            .agg(F.min("pid").alias("pid"), F.sum("q").alias("total_sold_per_month"))
            .select("pid", "pname", "month", "total_sold_per_month"))


def monthly_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """M7: (pname, month) -> total_sold_per_month, month kept as text."""
    return prod_month(sales, products).select("pname", "month", "total_sold_per_month")


def prod_total_by_name(sales: DataFrame, products: DataFrame) -> DataFrame:
    """GROUP BY pname with a bare pid -> pid = min(pid)."""
    per_pid = sales.groupBy(F.col("pidFK").alias("pid")).agg(F.sum("quantity").alias("q"))
    return (per_pid.join(products, "pid")
            .groupBy("pname")
            .agg(F.min("pid").alias("pid"), F.sum("q").alias("total_sold"))
            .select("pid", "pname", "total_sold"))


def prod_quarter_named(sales: DataFrame, products: DataFrame) -> DataFrame:
    """M8: (pid, pname, year, quarter) -> total_sold_per_quarter_and_year."""
    return (prod_quarter(sales, products).join(products, "pid")
            .select("pid", "pname", "year", "quarter", "total_sold_per_quarter_and_year"))


def prod_region_named(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """M8: (pid, pname, region) -> total_sold_per_region."""
    return (prod_region(sales, products, reps).join(products, "pid")
            .select("pid", "pname", "region", "total_sold_per_region"))


def prod_reps(reps: DataFrame) -> DataFrame:
    """M1: reps projected to (rid, fname, lname)."""
    return reps.select("rid", "fname", "lname")


def prod_customers(customers: DataFrame) -> DataFrame:
    """M2: copy of customers (also rep_customer)."""
    return customers.select("cid", "customer", "country")


def rep_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """M5: per-transaction (pid, quantity, amount) of known products; no aggregation."""
    return (sales.join(products.select(F.col("pid").alias("pidFK")), "pidFK", "left_semi")
            .select(F.col("pidFK").alias("pid"), "quantity", "amount"))


# ----------------------------------------------------------------- rep side

def rep_total(sales: DataFrame, reps: DataFrame) -> DataFrame:
    """A4: (rid, fname, lname) -> total_sold."""
    return (_pre(sales, "rid").withColumnRenamed("qty", "total_sold")
            .join(reps.select("rid", "fname", "lname"), "rid")
            .select("rid", "fname", "lname", "total_sold"))


def rep_quarter(sales: DataFrame, reps: DataFrame) -> DataFrame:
    """A5: (rid, year, quarter) -> total_sold_per_quarter_and_year."""
    return (_pre(sales, "rid", "year", "quarter")
            .join(reps.select("rid"), "rid", "left_semi")
            .withColumnRenamed("qty", "total_sold_per_quarter_and_year"))


def rep_product_total(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """(rid, pname) -> total_sold_per_product."""
    return (_pre(sales, "rid", "pid")
            .join(products, "pid")
            .join(reps.select("rid"), "rid", "left_semi")
            .groupBy("rid", "pname")
            .agg(F.sum("qty").alias("total_sold_per_product")))


def rep_quarter_named(sales: DataFrame, reps: DataFrame) -> DataFrame:
    """M8: (rid, fname, lname, year, quarter) -> total_sold_per_quarter_and_year."""
    return (rep_quarter(sales, reps).join(reps.select("rid", "fname", "lname"), "rid")
            .select("rid", "fname", "lname", "year", "quarter",
                    "total_sold_per_quarter_and_year"))


def rep_product_named(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """M8: (rid, fname, lname, pname) -> total_sold_per_product."""
    return (rep_product_total(sales, products, reps)
            .join(reps.select("rid", "fname", "lname"), "rid")
            .select("rid", "fname", "lname", "pname", "total_sold_per_product"))


def rep_facts(sales: DataFrame, products: DataFrame, reps: DataFrame,
              shared_base: bool = False) -> DataFrame:
    """M6: A4 LEFT JOIN A5 LEFT JOIN A6 on rid (fan-out; see module doc).

    Shared form: (rid, pid) feeds A6 before the products join and, rolled
    up, A4; A5 is the distinct (rid, year, quarter) keys.
    """
    if shared_base:
        by_product = _pre(sales, "rid", "pid")
        total = by_product.groupBy("rid").agg(F.sum("qty").alias("total_sold"))
        quarters = sales.select(F.col("ridFK").alias("rid"), F.year("date").alias("year"),
                                F.quarter("date").alias("quarter")).distinct()
    else:
        base = _fact_keys(sales)
        total = base.groupBy("rid").agg(F.sum("qty").alias("total_sold"))
        quarters = base.select("rid", "year", "quarter").distinct()
        by_product = base
    per_product = (_dim_join(by_product, products, "pid")
                   .groupBy("rid", "pname")
                   .agg(F.sum("qty").alias("total_sold_per_product")))
    return (total.join(reps.select("rid", "fname", "lname"), "rid")
            .join(quarters, "rid", "left")
            .join(per_product, "rid", "left")
            .select("rid", "fname", "lname", "total_sold", "year", "quarter",
                    "pname", "total_sold_per_product"))


# ------------------------------------------------------------ nested marts

def _grains(sales: DataFrame, key: str, detail: Sequence[str]) -> DataFrame:
    """(key, grain, year, quarter, *detail, qty): the sums of ``qty`` by the
    key alone (grain "total"), by year and quarter ("quarter") and by
    ``detail`` ("detail"), from one pass over ``sales``."""
    period = ["year", "quarter"]
    sums = sales.groupingSets([[key], [key, *period], [key, *detail]], key, *period, *detail).agg(
        F.sum("qty").alias("qty"), F.grouping("year").alias("_no_period"), F.grouping(detail[0]).alias("_no_detail"))
    grain = F.when(F.col("_no_period") == 0, "quarter").when(F.col("_no_detail") == 0, "detail").otherwise("total")
    return sums.select(key, grain.alias("grain"), *period, *detail, "qty")


def _nest(sums: DataFrame, key: str, detail: dict[str, str], kept) -> DataFrame:
    """One row per key: total_sold, quarters and details as sorted arrays (a
    key has no more rows than quarters and details)."""
    of = lambda g: F.col("grain") == g
    quarter = F.struct("year", "quarter", F.col("qty").alias("total_sold_per_quarter_and_year"))
    row = F.struct(*[F.col(c).alias(n) for c, n in detail.items()])
    return sums.groupBy(key).agg(F.max(F.when(of("total"), F.col("qty"))).alias("total_sold"),
                                 F.sort_array(F.collect_list(F.when(of("quarter"), quarter))).alias("quarters"),
                                 F.sort_array(F.collect_list(F.when(of("detail") & kept, row))).alias("details"))


def prod_mart(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """M3 nested: pid, pname, total_sold, quarters array<(year, quarter,
    total_sold_per_quarter_and_year)>, regions array<(region,
    total_sold_per_region)>; sales of unknown reps count for the total and the
    quarters but for no region."""
    where = reps.where(F.col("rid").isNotNull()).select("rid", "region", F.lit(True).alias("known"))
    rows = _fact_keys(sales).join(where, "rid", "left").select("pid", "year", "quarter", "region", F.coalesce("known", F.lit(False)).alias("known"), "qty")
    nested = _nest(_grains(rows, "pid", ["known", "region"]), "pid", {"region": "region", "qty": "total_sold_per_region"}, F.col("known"))
    return nested.join(products, "pid").select("pid", "pname", "total_sold", "quarters", F.col("details").alias("regions"))


def rep_mart(sales: DataFrame, products: DataFrame, reps: DataFrame) -> DataFrame:
    """M6 nested: rid, fname, lname, total_sold, quarters, products
    array<(pname, total_sold_per_product)>; sales of unknown products count
    for the total and the quarters only."""
    named = products.where(F.col("pid").isNotNull()).select("pid", "pname", F.lit(True).alias("known"))
    rows = _fact_keys(sales).join(named, "pid", "left").select("rid", "year", "quarter", "pname", F.coalesce("known", F.lit(False)).alias("known"), "qty")
    nested = _nest(_grains(rows, "rid", ["known", "pname"]), "rid", {"pname": "pname", "qty": "total_sold_per_product"}, F.col("known"))
    return (nested.join(reps.select("rid", "fname", "lname"), "rid")
            .select("rid", "fname", "lname", "total_sold", "quarters", F.col("details").alias("products")))


def unnest_mart(mart: DataFrame) -> DataFrame:
    """The rows of ``prod_facts`` / ``rep_facts`` from a nested mart: each
    quarter with each region (product) of an id (the fan-out of the module
    doc); an id without any keeps one row with nulls."""
    last = mart.columns[-1]
    own = [c for c in mart.columns if c not in ("quarters", last)]
    flat = mart.select(*own, last, F.inline_outer("quarters")).drop("total_sold_per_quarter_and_year")
    return flat.select(*own, "year", "quarter", F.inline_outer(last))


def top_of_mart(mart: DataFrame, k: int = 5) -> DataFrame:
    """M9 from the nested form of M6: the reps with the highest totals, from
    one row per rep instead of one per quarter and product."""
    return (mart.select("rid", "fname", "lname", F.col("total_sold").alias("units")).where(F.col("units").isNotNull())
            .orderBy(F.desc("units"), F.asc("rid")).limit(k).select("fname", "lname", "units"))
