"""A key holding a third of all rows: results stay whole and exact, and the
fact is pre-aggregated (partial aggregation) before any shuffle."""
import datetime as dt
import random
from collections import defaultdict

from martforge.operators import keys as K
from martforge.operators import marts as M


def _sales(spark, n=3000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        pid = 1 if hot else rnd.randint(2, 40)
        rid = 1 if hot else rnd.randint(2, 9)
        d = dt.date(2000 + rnd.randint(0, 2), rnd.randint(1, 12), rnd.randint(1, 28))
        rows.append((d, rnd.randint(1, 9), 10, rid, pid))
    return rows, spark.createDataFrame(rows, "date date, quantity int, amount int, ridFK long, pidFK long")


def test_hot_product_and_rep(spark):
    rows, sales = _sales(spark)
    products = spark.createDataFrame([(p, f"p{p % 7}") for p in range(1, 41)], "pid long, pname string")
    reps = spark.createDataFrame([(r, f"f{r}", f"l{r}", f"reg{r % 3}") for r in range(1, 10)],
                                 "rid long, fname string, lname string, region string")
    region = {r: f"reg{r % 3}" for r in range(1, 10)}
    # Brute force.
    total, quarters, per_region = defaultdict(int), defaultdict(set), defaultdict(int)
    for d, q, _, rid, pid in rows:
        total[pid] += q
        quarters[pid].add((d.year, (d.month - 1) // 3 + 1))
        per_region[(pid, region[rid])] += q
    regions_of = defaultdict(set)
    for (pid, reg) in per_region:
        regions_of[pid].add(reg)
    # Fan-out: one row per (quarter, region) of each product.
    expect = sorted(
        (pid, f"p{pid % 7}", total[pid], y, qq, reg, per_region[(pid, reg)])
        for pid in total for (y, qq) in quarters[pid] for reg in regions_of[pid])
    got = sorted(tuple(r) for r in M.prod_facts(sales, products, reps).collect())
    assert got == expect
    three = sorted(tuple(r) for r in M.prod_facts(sales, products, reps, shared_base=True).collect())
    assert three == expect


def test_pre_aggregation_before_exchange(spark):
    _, sales = _sales(spark, 300)
    products = spark.createDataFrame([(p, "x") for p in range(1, 41)], "pid long, pname string")
    reps = spark.createDataFrame([(r, "f", "l", "reg") for r in range(1, 10)],
                                 "rid long, fname string, lname string, region string")
    plan = M.prod_facts(sales, products, reps, shared_base=True)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    found = [i for i, line in enumerate(lines)
             if "Exchange hashpartitioning(pid" in line and "rid" in line]
    assert found
    for i in found:
        assert "partial_sum" in lines[i + 1]


def test_hot_natural_key_lookup(spark):
    fact = spark.createDataFrame([("Acme" if i % 3 == 0 else f"c{i % 50}", i) for i in range(3000)],
                                 "cust string, v int")
    dim = spark.createDataFrame([("Acme", 101)] + [(f"c{i}", 200 + i) for i in range(50)],
                                "customer string, cid int")
    out = K.lookup_key(fact, dim, "cust", "customer", "cid", policy="error")
    got = dict(((r.cust, r.cid) for r in out.select("cust", "cid").distinct().collect()))
    assert got["Acme"] == 101 and out.count() == 3000
