import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martforge.operators import keys as K
from martforge.operators import quality as Q


def test_dense_ids_exact_and_ordered_with_hot_key(spark):
    # A third of the rows share one order value: ids must still be 1..n.
    data = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, v int")
    out = K.dense_ids(df, ["k"], "id", num_partitions=7)
    got = sorted(out.select("id", "k").collect())
    assert [r.id for r in got] == list(range(1, 3001))
    ks = [r.k for r in got]
    assert ks == sorted(ks)


def test_dense_ids_offset_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(0, "b")], "k int, s string")
    out = K.dense_ids(df, ["k"], "id", offset=100)
    got = sorted((r.id, r.k) for r in out.collect())
    assert got == [(101, 0)] + [(i, 1) for i in range(102, 107)]


def test_dense_ids_plan_has_no_single_partition_fact_exchange(spark):
    df = spark.range(0, 10000).withColumn("k", F.col("id") % 97)
    out = K.dense_ids(df, ["k"], "rid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The range shuffle ran once, before the write; what remains reads the
    # written rows.  The only single-partition exchange is the one over the
    # per-partition counts (one row per partition).
    assert "rangepartitioning" not in plan
    assert plan.count("SinglePartition") == 1
    assert sorted(r.rid for r in out.collect()) == list(range(1, 10001))


def test_first_per_key_takes_first_row_values(spark):
    df = spark.createDataFrame(
        [(1, "Acme", "US"), (2, "Bolt", "DE"), (4, "Acme", "FR")], "o int, cust string, country string")
    out = K.first_per_key(df, "cust", "o", ["country"])
    assert sorted(tuple(r) for r in out.collect()) == [("Acme", 1, "US"), ("Bolt", 2, "DE")]


def test_dense_key_first_appearance(spark):
    df = spark.createDataFrame([(3, "Beta"), (1, "Alpha"), (2, "Beta"), (5, "Gamma")],
                               "o int, prod string")
    out = K.dense_key(df, "prod", "o", "pid")
    assert sorted((r.pid, r.prod) for r in out.collect()) == [(1, "Alpha"), (2, "Beta"), (3, "Gamma")]


def test_lookup_policies(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    dim = spark.createDataFrame([("a", 1), (None, 9)], "name string, id int")
    null = K.lookup_key(fact, dim, "name", "name", "id", policy="null")
    assert sorted(null.collect(), key=repr) == sorted(
        [("a", 1), ("b", None), (None, None)], key=repr)
    safe = K.lookup_key(fact, dim, "name", "name", "id", policy="null", null_safe=True)
    assert (None, 9) in [tuple(r) for r in safe.collect()]
    drop = K.lookup_key(fact, dim, "name", "name", "id", policy="drop")
    assert [tuple(r) for r in drop.collect()] == [("a", 1)]
    err = K.lookup_key(fact, dim, "name", "name", "id", policy="error")
    with pytest.raises(PySparkException) as e:
        err.collect()
    assert "OrphanKeyError" in str(e.value)


def test_key_policies(spark):
    df = spark.createDataFrame([(1, 10, "x"), (1, 5, "y"), (2, 1, "z")], "k int, o int, v string")
    first = K.apply_key_policy(df, "k", "keep_first", ["o"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, 5, "y"), (2, 1, "z")]
    assert K.apply_key_policy(df, "k", "keep_all").count() == 3
    with pytest.raises(ValueError):
        K.apply_key_policy(df, "k", "error")


def test_quality_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r.fk for r in Q.fk_orphans(child, "fk", parent, "pk").collect()] == [2]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in Q.pk_duplicates(dup, "k").collect()] == [(1, 2)]
    nn = Q.not_null_violations(child, ["fk"]).collect()
    assert [tuple(r) for r in nn] == [("fk", 1)]
    alt = spark.createDataFrame([(0,), (5,), (None,)], "altitude int")
    bad = Q.check_violations(alt, F.col("altitude") > 0).collect()
    assert [r.altitude for r in bad] == [0]           # null passes a CHECK


def test_dense_ids_by_int_key_small_buckets(spark):
    keys = [7, 3, 1000003, 50, 9, 2000001]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    out = K.dense_ids_by_int_key(df, "k", "id", offset=100, bucket_size=4)
    got = sorted((r.k, r.id) for r in out.collect())
    assert got == [(k, 101 + i) for i, k in enumerate(sorted(keys))]


def test_ids_from_positions(spark):
    rows = [("b.xml", 0), ("a.xml", 1), ("a.xml", 0), ("b.xml", 1), ("b.xml", 2)]
    df = spark.createDataFrame(rows, "_file string, _pos int")
    out = K.ids_from_positions(df, "_file", "_pos", "tid")
    got = sorted((r._file, r._pos, r.tid) for r in out.collect())
    assert got == [("a.xml", 0, 1), ("a.xml", 1, 2), ("b.xml", 0, 3), ("b.xml", 1, 4),
                   ("b.xml", 2, 5)]
