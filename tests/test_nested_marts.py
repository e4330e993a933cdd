"""Nested marts, one-pass checks and appends that move no stored key."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from martforge import views as V
from martforge.operators import marts as M
from martforge.operators import quality as Q
from martforge.operators import reports as R
from martforge.sources import sinks as SK

from conftest import SF001
from tests_support import rows

SALES = "date date, quantity int, amount int, ridFK long, pidFK long"


@pytest.fixture(scope="module")
def small(request):
    spark = request.getfixturevalue("spark")
    d = [dt.date(2020, 1, 5), dt.date(2020, 5, 5), None]
    sales = [(d[i % 3], i, 1, [1, 2, 99, None][i % 4], [10, 20, 30, None][i % 5 % 4]) for i in range(60)] + [(d[0], None, 1, 1, 10)]
    return (spark.createDataFrame(sales, SALES),
            spark.createDataFrame([(10, "a"), (20, "b"), (40, "unsold")], "pid long, pname string"),
            spark.createDataFrame([(1, "x", "y", "N"), (2, "z", "w", None)], "rid long, fname string, lname string, region string"))


def test_unnested_marts_equal_the_flat_ones(spark, small):
    sales, products, reps = small
    for nested, flat in ((M.prod_mart, M.prod_facts), (M.rep_mart, M.rep_facts)):
        got, want = M.unnest_mart(nested(sales, products, reps)), flat(sales, products, reps)
        assert got.columns == want.columns and rows(got) == rows(want) and want.count() > 0
    mart = {r.pid: r for r in M.prod_mart(sales, products, reps).collect()}
    assert sorted(mart) == [10, 20] and [q.year for q in mart[10].quarters] == [None, 2020, 2020]
    assert [r.region for r in mart[20].regions] == [None, "N"]  # a known rep without a region; orphans have none


def test_a_product_of_unknown_reps_only_keeps_a_row(spark, small):
    _, products, reps = small
    sales = spark.createDataFrame([(dt.date(2020, 1, 1), 3, 1, 99, 10)], SALES)
    got = M.unnest_mart(M.prod_mart(sales, products, reps))
    assert rows(got) == rows(M.prod_facts(sales, products, reps)) == [(10, "a", 3, 2020, 1, None, None)]
    assert M.unnest_mart(M.prod_mart(sales.limit(0), products, reps)).collect() == []


def test_nested_mart_scans_the_fact_once(spark):
    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")

    args = V.sales(spark, SF001), V.products(spark, SF001), V.reps(spark, SF001)
    assert scans(M.prod_mart(*args)) == scans(M.rep_mart(*args)) == scans(M.unnest_mart(M.prod_mart(*args))) == 1
    assert scans(M.prod_facts(*args)) == 3
    top = M.top_of_mart(M.rep_mart(*args))
    assert top.collect() == R.top_reps(M.rep_facts(*args)).collect()


def test_fk_orphans_in_one_pass(spark, small):
    sales, products, reps = small
    parents = {"ridFK": (reps, "rid"), "pidFK": (products, "pid")}
    got = {r.fk: r.orphans for r in Q.fk_orphans_of(sales, parents).collect()}
    want = {c: Q.fk_orphans(sales, c, p, k).count() for c, (p, k) in parents.items()}
    assert got == want and min(want.values()) > 0
    assert {r.fk: r.orphans for r in Q.fk_orphans_of(sales.limit(0), parents).collect()} == {"ridFK": 0, "pidFK": 0}
    args = V.sales_with_gaps(spark, SF001), {"ridFK": (V.reps(spark, SF001), "rid"), "pidFK": (V.products(spark, SF001), "pid")}
    plan = Q.fk_orphans_of(*args)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_checks_counted_by_the_load_itself(spark, small, tmp_path):
    sales = small[0]
    passes = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    counted = sales.mapInArrow(count, sales.schema)
    got = Q.checked_write(counted, str(tmp_path / "t"), ["date", "quantity"], {"low": F.col("quantity") < 50})
    assert got == {"rows": 61, "null date": sales.where("date is null").count(), "null quantity": 1, "check low": 10}
    assert passes.value == 61 and spark.read.parquet(str(tmp_path / "t")).count() == 61
    assert Q.checked_write(sales.limit(0), str(tmp_path / "e"), ["date"], {}) == {"rows": 0, "null date": 0}


def test_append_moves_no_stored_key(spark, tmp_path):
    stored = str(tmp_path / "t")
    spark.range(20_000).select(F.col("id").alias("k"), F.lit("old").alias("v")).write.parquet(stored)
    new = spark.createDataFrame([(5, "new"), (5, "again"), (30_000, "new"), (None, "x")], "k long, v string")
    met = SK.stored_keys_met(spark.read.parquet(stored), new, ["k"])
    assert rows(met) == [(5,)]
    plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The table's scan meets the new keys by a broadcast of those.
    assert "BroadcastHashJoin" in plan and "LeftSemi, BuildRight" in plan
    for _ in range(2):
        table = SK.materialize(new, "t", mode="append", key="k", key_policy="keep_first", order_cols=["v"], path=stored)
    assert table.count() == 20_002 and rows(table.where("k = 5"), "v") == [("old",)]
    assert rows(table.where("k is null"), "v") == [("x",)]
    with pytest.raises(ValueError):
        SK.materialize(new.where("k = 30000"), "t", mode="append", key="k", key_policy="error", path=stored)
