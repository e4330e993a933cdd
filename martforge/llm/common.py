"""Shared helpers of the subpackage: staging, bounded text chunks, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.session import ensure_checkpoint_dir

#: Bytes of text that a Python task works on at once (numpy temporaries are a
#: small multiple of it); one text may be longer and is then a chunk by itself.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` (shared by all
    executors) and read it back: cuts the lineage, gives the planner true
    sizes, and survives a lost executor."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(values: list, size=len, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) ranges of ``values`` whose sizes sum to ``limit`` at most
    (a single longer value is a range of its own)."""
    start = total = 0
    for i, v in enumerate(values):
        n = size(v)
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(values):
        yield start, len(values)


def any_of(conditions: list):
    return reduce(lambda a, b: a | b, conditions)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Distributed union-find over undirected ``edges`` (src, dst longs).

    Alternating large-star and small-star steps hook every node to the
    smallest node of its neighbourhood until each component is a star; both
    steps are a partial minimum per node and a join, so no neighbourhood is
    gathered in one task and no edge list reaches the driver (only a row
    count and a checksum per round).  Returns (node, root), one row for each
    node that has an edge to another node; root is the component's smallest
    node.  Self loops, repeated and reversed edges are harmless; null ends
    are ignored; no edges give no rows.
    """
    spark = edges.sparkSession

    def down(df: DataFrame) -> DataFrame:
        """Distinct edges from the larger to the smaller end."""
        return (df.filter("src <> dst")
                .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                .distinct())

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()
        return r[0], r[1]

    e = stage(down(edges), name)
    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = down(both.filter("dst > src").join(low, "src")
                     .select(F.col("dst").alias("src"), F.col("m").alias("dst")))
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(least, "src")
                 .select(F.explode(F.array(F.struct(F.col("src"), F.col("m").alias("dst")),
                                           F.struct(F.col("dst").alias("src"), F.col("m").alias("dst"))))
                         .alias("e")).select("e.src", "e.dst"))
        e = stage(down(small), name)
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("dst").alias("node")).distinct()
    return (e.select(F.col("src").alias("node"), F.col("dst").alias("root"))
            .unionByName(roots.withColumn("root", F.col("node"))))
