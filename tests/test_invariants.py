"""SURVEY §5 invariants on the sf0.001 tables."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from martforge import views as V
from martforge.operators import marts as M

SF = "/root/testdata/sf0.001"


def _by(df, key, col):
    return {r[0]: r[1] for r in df.groupBy(key).agg(F.sum(col)).collect()}


def test_block_sums_equal_totals(spark):
    sales, products, reps = V.sales(spark, SF), V.products(spark, SF), V.reps(spark, SF)
    a1 = {r.pid: r.total_sold for r in M.prod_total(sales, products).collect()}
    assert _by(M.prod_quarter(sales, products), "pid", "total_sold_per_quarter_and_year") == a1
    # No orphan reps in these tables (fk_orphans is 0), so the region block sums up too.
    assert _by(M.prod_region(sales, products, reps), "pid", "total_sold_per_region") == a1
    month_total = M.prod_month(sales, products).agg(F.sum("total_sold_per_month")).first()[0]
    assert month_total == sum(a1.values())
    a4 = {r.rid: r.total_sold for r in M.rep_total(sales, reps).collect()}
    assert _by(M.rep_product_total(sales, products, reps), "rid", "total_sold_per_product") == a4


def test_fan_out_row_count(spark):
    sales, products, reps = V.sales(spark, SF), V.products(spark, SF), V.reps(spark, SF)
    q = {r[0]: r[1] for r in M.prod_quarter(sales, products).groupBy("pid").count().collect()}
    g = {r[0]: r[1] for r in M.prod_region(sales, products, reps).groupBy("pid").count().collect()}
    expect = sum(q[p] * g.get(p, 1) for p in q)
    assert M.prod_facts(sales, products, reps).count() == expect


def test_fact_ids_are_one_to_n(spark):
    ids = [r.tid for r in E.queries()["fact_sales"](spark, SF).select("tid").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_fact_sales_plan_has_no_single_partition_over_facts(spark):
    df = E.queries()["fact_sales"](spark, SF)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles
    # Every single-partition exchange sits on a count per range partition or
    # per key bucket (one row each), never on fact rows.
    for i in singles:
        child = lines[i + 1]
        assert "HashAggregate" in child and ("_dense_part" in child or "_ib" in child), child
    assert not any("rangepartitioning" in line for line in lines)
