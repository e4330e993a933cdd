import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import vptree as V


def brute(rows, queries, k):
    """rows: {id: vector}."""
    out = {}
    for q in queries:
        s = [(-float((np.array(v, np.float64) * np.array(rows[q], np.float64)).sum()), i) for i, v in rows.items()
             if i != q and len(v) == len(rows[q])]
        out[q] = [(i, -x) for x, i in sorted(s)[:k]]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        assert r.rank == len(own) + 1
        own.append((r.vec_id, r.score))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")


@pytest.mark.parametrize("shard, block", [(1 << 16, 1 << 14), (60, 7)])
def test_factor_one_is_exact(spark, shard, block):
    rng = np.random.default_rng(1)
    base = np.float32(rng.normal(size=(400, 6)))
    base[100:220] = base[5]                       # one vector with very many copies
    base[220:300] = np.float32(rng.integers(-1, 2, (80, 6)))
    base[base.any(axis=1) == False] = 1           # noqa: E712
    rows = {i: v.tolist() for i, v in enumerate(base)}
    rows |= {1000: [1.0, 2.0], 1020: [0.5, 3.0], 1040: [2.0, 2.0, 2.0]}
    bad = [(2000, None), (2020, [0.0] * 6), (2040, [float("nan")] * 6), (2060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2080, [float("inf")] * 6), (2100, []),
           (None, [1.0] * 6)]
    df = table(spark, [*rows.items(), *bad, (40, rows[40]), (41, rows[41])])
    got = collected(V.nearest(df, F.col("vec_id") % 20 == 0, k=20, relax=1.0, shard=shard, block=block))
    want = brute(rows, [i for i in rows if i % 20 == 0], 20)
    assert {q: v for q, v in got.items()} == {q: v for q, v in want.items() if v}


def test_pruning_leaves_out_and_factor_one_keeps(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 8))
    x = centres[rng.integers(0, 30, 6000)] + 0.05 * rng.normal(size=(6000, 8))
    tree = V.Tree(np.arange(6000), x, leaf=32)
    seen = []
    scan = tree._scan
    tree._scan = lambda node, active: (seen.append(len(active) * (node.stop - node.start)), scan(node, active))
    work = {}
    for relax in (1.0, 3.0):
        seen.clear()
        found = tree.search(np.arange(0, 6000, 60), x[::60], 10, relax)
        work[relax] = sum(seen)
        hit = 0
        for i, (ids, _) in zip(range(0, 6000, 60), found):
            s = x @ x[i]
            s[i] = -np.inf
            hit += len(set(ids.tolist()) & set(np.argsort(-s, kind="stable")[:10].tolist()))
        if relax == 1.0:
            assert hit == 1000
    assert work[3.0] < work[1.0] < 100 * 6000


def test_recall_of_the_query(spark):
    from martforge.llm.queries import QUERIES
    for sf in ("sf0.01", "sf0.1"):
        d = f"/root/testdata/{sf}"
        rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
        got = collected(QUERIES["op1_vantage_point_trees"](spark, d))
        x, ids = np.array(list(rows.values()), np.float64), np.array(list(rows))
        hit = total = 0
        for q in [i for i in rows if i % 20 == 0]:
            s = (x * np.array(rows[q], np.float64)).sum(axis=1)
            s[ids == q] = -np.inf
            best = ids[np.lexsort((ids, -s))[:20]]
            hit += len(set(best.tolist()) & {i for i, _ in got[q]})
            total += 20
        print(sf, "recall", hit / total)
        assert hit / total >= 0.95


def test_empty(spark):
    df = table(spark, [(20, [1.0, 2.0])])
    assert V.nearest(df, F.col("vec_id") % 20 == 0).collect() == []
    assert V.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def recall(spark, x, **more):
    rows = {i: v for i, v in enumerate(np.float32(x).tolist())}
    got = collected(V.nearest(table(spark, rows.items()), F.col("vec_id") % 20 == 0, k=20, **more))
    want = brute(rows, [i for i in rows if i % 20 == 0], 20)
    return sum(sum(s >= own[-1][1] for _, s in got[q]) for q, own in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("n, d, k, spread, unequal", [(1000, 8, 10, 0.1, True), (3000, 8, 30, 0.05, False), (2000, 2, 20, 0.05, True)])
@pytest.mark.parametrize("shard", [1 << 16, 400])
def test_recall_on_clusters_at_the_factor_in_use(spark, n, d, k, spread, unequal, shard):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(k, d))[rng.integers(0, k, n)] + spread * rng.normal(size=(n, d))
    if unequal:
        x *= rng.uniform(0.2, 3, size=(n, 1))
    assert recall(spark, x, shard=shard) >= 0.95


def test_the_factor_follows_the_shard():
    rng = np.random.default_rng(5)
    loose = rng.normal(size=(3000, 32))
    tight = rng.normal(size=(30, 8))[rng.integers(0, 30, 20_000)] + 0.05 * rng.normal(size=(20_000, 8))
    ids = np.arange(0, 3000, 20)
    assert V.calibrated(V.Tree(np.arange(3000), loose), ids, loose[ids], 20, 1.5) == 1.5
    ids = np.arange(0, 20_000, 20)
    tree = V.Tree(np.arange(20_000), tight)
    factor = V.calibrated(tree, ids, tight[ids], 20, 1.5)
    assert 1 <= factor < 1.2
    seen = []
    scan = tree._scan
    tree._scan = lambda node, active: (seen.append(len(active) * (node.stop - node.start)), scan(node, active))
    tree.search(ids, tight[ids], 20, factor)
    assert sum(seen) < 0.5 * len(ids) * 20_000  # it prunes
