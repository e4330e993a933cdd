"""Nearest neighbours by inner product: a vantage-point tree per shard.

Inside a shard every vector x gets one more component, sqrt(M^2 - |x|^2) with
M the shard's largest norm, and a query gets 0: squared distances become
|q|^2 + M^2 - 2 q.x, so the nearest vectors are those of the largest inner
product and the triangle inequality holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import stage

#: Vectors in a shard and queries in a block, at most about; vectors in a leaf.
SHARD, BLOCK, LEAF = 1 << 16, 1 << 14, 128
#: Fewer vectors are dealt to this many shards, of at least so many vectors.
SPREAD, LEAST = 24, 1024
#: How much more than the triangle inequality allows is pruned at most; 1 is exact.
#: A shard takes the largest of RELAX, half its excess over 1, a quarter, ... and 1
#: with which SAMPLE of its queries find so large a share of what brute force finds.
RELAX, SAMPLE, RECALL = 1.5, 64, 0.98


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def dots(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products whose last bits don't hang on a row's place."""
    return (rows * query).sum(axis=1)


@dataclass
class Node:
    """Rows ``start`` to ``stop`` of the tree's order; a leaf has no vantage point."""
    start: int
    stop: int
    point: np.ndarray | None = None
    radius: float = 0.0
    inner: Node | None = None
    outer: Node | None = None


class Tree:
    """Vantage-point tree over the rows of ``x`` (ids ascending)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        norm = (x * x).sum(axis=1)
        self.top = float(norm.max())
        lifted = np.hstack((x, np.sqrt(np.maximum(self.top - norm, 0))[:, None]))
        self.order = np.arange(len(x))
        self.leaf = leaf
        self.root = self._grow(lifted, 0, len(x), np.random.default_rng(1))
        self.ids, self.x, self.lifted = ids[self.order], x[self.order], lifted[self.order]

    def _grow(self, lifted: np.ndarray, start: int, stop: int, rng: np.random.Generator) -> Node:
        """Halves by rank of distance, so many equal vectors still split evenly."""
        if stop - start <= self.leaf:
            return Node(start, stop)
        own = self.order[start:stop]
        point = lifted[own[rng.integers(len(own))]]
        d = np.sqrt(((lifted[own] - point) ** 2).sum(axis=1))
        half = len(own) // 2
        by = np.argpartition(d, half)
        self.order[start:stop] = own[by]
        node = Node(start, stop, point, float(d[by[half]]))
        node.inner = self._grow(lifted, start, start + half, rng)
        node.outer = self._grow(lifted, start + half, stop, rng)
        return node

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, relax: float = 1.0) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, inner products) of each query's ``k`` best rows other than itself."""
        n = len(q)
        self.limit = np.full(n, -np.inf)                 # the k-th best inner product so far
        self.found: list[list[np.ndarray]] = [[] for _ in range(n)]
        self.best = np.full((n, k), -np.inf)
        self.q, self.query_ids, self.k, self.relax = q, query_ids, k, relax
        self.shift = (q * q).sum(axis=1) + self.top
        self.slack = 1e-9 * (1 + self.shift)
        self._visit(self.root, np.arange(n))
        out = []
        for i in range(n):
            at = np.concatenate(self.found[i]) if self.found[i] else np.zeros(0, np.int64)
            s = dots(q[i], self.x[at])
            first = np.lexsort((self.ids[at], -s))[:k]
            out.append((self.ids[at[first]], s[first]))
        return out

    def _visit(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        if node.point is None:
            self._scan(node, active)
            return
        lifted = np.hstack((self.q[active], np.zeros((len(active), 1))))
        d = np.sqrt(((lifted - node.point) ** 2).sum(axis=1))
        inside = d < node.radius
        self._visit(node.inner, active[inside])
        self._visit(node.outer, active[~inside])
        # The far half holds nothing nearer than |d - radius|.
        reach = np.sqrt(np.maximum(self.shift[active] - 2 * self.limit[active], 0) + self.slack[active])
        far = ~(np.abs(d - node.radius) * self.relax > reach)
        self._visit(node.outer, active[inside & far])
        self._visit(node.inner, active[~inside & far])

    def _scan(self, node: Node, active: np.ndarray) -> None:
        s = self.q[active] @ self.x[node.start:node.stop].T
        s[self.query_ids[active][:, None] == self.ids[None, node.start:node.stop]] = -np.inf
        both = np.concatenate((self.best[active], s), axis=1)
        self.best[active] = -np.partition(-both, self.k - 1, axis=1)[:, :self.k]
        self.limit[active] = self.best[active].min(axis=1)
        # A little below the limit stays, ties are settled on exact products.
        keep = (s >= (self.limit[active] - self.slack[active])[:, None]) & (s > -np.inf)
        for i, row in zip(active.tolist(), keep):
            if row.any():
                self.found[i].append(node.start + np.flatnonzero(row))


def calibrated(tree: Tree, query_ids: np.ndarray, q: np.ndarray, k: int, relax: float) -> float:
    """The largest factor up to ``relax`` that keeps a recall of ``RECALL``
    on an even sample of the queries; 1 if none does."""
    at = np.unique(np.linspace(0, len(q) - 1, min(SAMPLE, len(q))).astype(np.int64))
    s = q[at] @ tree.x.T
    s[query_ids[at][:, None] == tree.ids[None, :]] = -np.inf
    best = -np.sort(np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k], axis=1)
    wanted = np.isfinite(best).sum(axis=1)
    for step in range(6):
        factor = 1 + (relax - 1) / 2 ** step
        found = tree.search(query_ids[at], q[at], k, factor)
        hits = sum(int((near[:n] >= row[n - 1] - 1e-9 * (1 + abs(row[n - 1]))).sum()) for (_, near), row, n in zip(found, best, wanted) if n)
        if hits >= RECALL * wanted.sum():
            return factor
    return 1.0


def _sizes(total: int, most: int, least: int) -> int:
    """Parts of at most about ``most`` rows; more, but no smaller than
    ``least`` rows, as long as there are fewer than ``SPREAD`` of them."""
    return max(1, -(-total // most), min(SPREAD, -(-total // least)))


def nearest(vectors: DataFrame, queries: Column, k: int = 20, relax: float = RELAX, shard: int = SHARD, block: int = BLOCK,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner
    products (double precision) among all rows but its own, ties to the
    smaller id; fewer if there are fewer candidates.

    ``relax`` is the largest pruning factor that a shard may use
    (``calibrated``); 1 is exact search.
    ``queries`` is a condition on ``id_col`` (long).  Vectors that are null,
    zero or hold null or non-finite components take no part, nor do null ids;
    rows repeated under one id count once (of different vectors the
    smallest); a query is compared with vectors of its own length.  Every
    shard meets every block of queries and no task holds more than one of
    each; of equal vectors a shard keeps the ``k`` + 1 smallest ids, as no
    other can be among anyone's ``k`` nearest.  An empty table gives no rows.
    """
    own = (vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
           .groupBy(F.col(id_col).cast("long").alias(id_col)).agg(F.min(vector_col).alias("v"))
           .withColumn("v", F.col("v").cast("array<double>")).withColumn("dim", F.size("v")))
    own = stage(own, "vectors")
    asked = own.filter(queries)
    shards, blocks = _sizes(own.count(), shard, LEAST), max(1, -(-asked.count() // block))
    # Other seeds for shards and blocks, so that a block's queries come from all shards.
    rows = (own.withColumn("shard", F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        found, qids = [], np.zeros(0, np.int64)
        if len(left) and len(right):
            qids, q = _matrix(right)
            tree = Tree(*_few_equal(*_matrix(left), k + 1))
            found = tree.search(qids, q, k, calibrated(tree, qids, q, k, relax) if relax > 1 else relax)
        none = [(np.zeros(0, np.int64), np.zeros(0))]
        return pa.table({"query_id": np.repeat(qids, [len(i) for i, _ in found]), "vec_id": np.concatenate([i for i, _ in found or none]),
                         "score": np.concatenate([s for _, s in found or none])})

    keys = ["dim", "shard", "block"]
    near = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(find, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) by ascending id."""
    ids = table.column(0).to_numpy()
    x = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], x[order]


def _few_equal(ids: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    seen: dict[bytes, int] = {}
    keep = np.ones(len(ids), bool)
    for i, row in enumerate(x):
        b = row.tobytes()
        seen[b] = seen.get(b, 0) + 1
        keep[i] = seen[b] <= most
    return ids[keep], x[keep]
