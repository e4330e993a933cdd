"""Range bounds, numbering with one write, and the lineage sweep."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martforge.operators import keys as K
from martforge.operators import people as P
from martforge.operators import ranges as RG

PEOPLE = "idx long, Name string, Claim string"


def numbered(spark, df, cols, bounds):
    return df.withColumn("part", RG.range_number(df, cols, bounds))


def test_range_number_counts_the_bounds_below(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (6,), (100,)], "k int")
    got = {r.k: r.part for r in numbered(spark, df, ["k"], [(1,), (5,), (50,)]).collect()}
    assert got == {None: 0, 1: 1, 5: 2, 6: 2, 100: 3}
    assert {r.part for r in numbered(spark, df, ["k"], []).collect()} == {0}


def test_hot_values_and_nulls_are_split_by_the_next_column(spark):
    df = (spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("a"),
        (F.col("id") * 37 % 10_007).cast("double").alias("b")))
    bounds = RG.range_bounds(df, ["a", "b"], 12)
    counts = {r.part: r["count"] for r in numbered(spark, df, ["a", "b"], bounds).groupBy("part").count().collect()}
    assert max(counts.values()) < 2 * 30_000 / 12 and len(counts) >= 10
    # The ranges follow the order of the keys.
    spans = (numbered(spark, df, ["a", "b"], bounds).groupBy("part").agg(F.min(F.struct("a", "b")).alias("lo"), F.max(F.struct("a", "b")).alias("hi"))
             .orderBy("part").collect())
    key = lambda r: [(v is not None, v) for v in r]
    assert all(key(x.hi) <= key(y.lo) for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_dense_ids_by_range_equals_a_sort(spark, parts):
    rng = random.Random(parts)
    data = [(rng.choice([None, 1, 1, 1, rng.randrange(50)]), rng.choice([None, dt.date(2020, 1, 1 + rng.randrange(9))]), rng.choice("xyz"), i) for i in range(400)]
    df = spark.createDataFrame(data, "a int, d date, t string, own int").repartition(5)
    got = K.dense_ids_by_range(df, ["a", "d", "t", "own"], "id", offset=10, num_partitions=parts)
    order = lambda r: [(v is not None, v) for v in r]
    want = {tuple(r): i + 11 for i, r in enumerate(sorted(data, key=order))}
    assert {(r.a, r.d, r.t, r.own): r.id for r in got.collect()} == want
    assert K.dense_ids_by_range(df.limit(0), ["a"], "id").collect() == []


def test_dense_ids_by_range_falls_back_for_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    assert sorted((r.id, r.t) for r in K.dense_ids_by_range(df, ["t"], "id").collect()) == [(1, None), (2, "a"), (3, "b")]


def test_records_are_written_once_and_sampled_never(spark):
    """The plan of the written table's reader has one scan and no range exchange;
    the records' own plan runs once, for the write."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(r.num_rows)
            yield r

    src = spark.range(5_000).select((F.col("id") % 97).alias("k"), "id").mapInArrow(count, "k long, id long")
    out = K.dense_ids_by_range(src, ["k", "id"], "n", bounds_from=spark.range(5_000).select((F.col("id") % 97).alias("k"), "id"))
    assert out.count() == 5_000 and out.select("n").distinct().count() == 5_000
    assert seen.value == 5_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def scan(people, earlier):
    out = []
    for i, _, c in people:
        hit = [j for j, n, _ in people if n and c and c.lower() in n.lower() and (not earlier or j < i)]
        if hit:
            out.append((i, min(hit)))
    return sorted(out)


@pytest.mark.parametrize("earlier", [False, True])
def test_lineage_nested_claims_against_a_scan(spark, earlier):
    rng = random.Random(5 + earlier)
    letters = "aab é"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    people = [(i, rng.choice([None, word(rng.randrange(0, 15)), word(12)]), rng.choice([None, "", word(rng.randrange(1, 6)), word(9)])) for i in range(150)]
    got = P.lineage(spark.createDataFrame(people, PEOPLE), earlier_only=earlier)
    assert sorted(tuple(r) for r in got.collect()) == scan(people, earlier)


def test_lineage_moves_no_pairs(spark):
    """Claims that all share their rarest piece with all names: the rows that
    any step makes stay in proportion to the names and claims."""
    n = 1_500
    people = [(i, f"Shared Rare Xq{i % 700:04d}", f"Xq{i % 900:04d}" if i % 2 else f"Rare Xq{i % 900:04d}") for i in range(n)]
    got = P.lineage(spark.createDataFrame(people, PEOPLE))
    got.collect()
    want = {i: int(c[-4:]) for i, _, c in people if int(c[-4:]) < 700}
    assert {r.child_idx: r.parent_idx for r in got.collect()} == want
    rows = []

    def walk(node):
        m = node.metrics()
        if m.contains("numOutputRows"):
            rows.append(m.apply("numOutputRows").value())
        if m.contains("shuffleRecordsWritten"):
            rows.append(m.apply("shuffleRecordsWritten").value())
        kids = [node.plan()] if node.getClass().getSimpleName().endswith("QueryStageExec") else []
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            kids = [node.executedPlan()]
        seq = node.children()
        kids += [seq.apply(k) for k in range(seq.size())]
        for k in kids:
            walk(k)

    walk(got._jdf.queryExecution().executedPlan())
    # 700 names of 18 characters have at most 12,600 distinct suffixes.
    assert rows and max(rows) < 3 * (700 * 18 + n)
