"""SimHash near-duplicates found through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks, connected_components, stage

#: Reference fingerprints of the distance table, made by a rule.
PIVOTS = 16
#: Distinct fingerprints that a bucket may hold for its pairs to be formed;
#: a larger bucket is linked through shared one-bit neighbours instead.
BUCKET = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def pivots(n: int = PIVOTS) -> list[int]:
    return [int(np.uint64(xxhash.xxh64_intdigest(f"pivot {i}".encode(), 42)).astype(np.int64)) for i in range(n)]


def fingerprint_texts(texts: list[bytes], words: int, seed: int = 42) -> np.ndarray:
    """Fingerprints (int64) of UTF-8 texts."""
    split = [t.lower().split() for t in texts]  # of bytes: A-Z, and the six ASCII white spaces
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for own in split for w in own]
    joined = b" ".join(flat)
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    start = np.cumsum(sizes + 1) - sizes - 1
    stop = start + sizes
    span = np.minimum(counts, words)                     # words in a shingle of this text
    shingles = np.where(counts > 0, counts - span + 1, 0)
    first_word = np.cumsum(counts) - counts
    first = np.cumsum(shingles) - shingles
    own = np.repeat(np.arange(len(split)), shingles)
    at = np.arange(len(own)) - first[own] + first_word[own]
    cut = map(joined.__getitem__, map(slice, start[at].tolist(), stop[at + span[own] - 1].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), "<u8", len(own))
    ones = np.zeros((len(split), 64), np.int64)
    for s in range(0, len(own), BLOCK):
        part = own[s:s + BLOCK]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        bits = np.unpackbits(h[s:s + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[part[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<i8")[:, 0]


def text_digest(text: Column) -> Column:
    """64-bit hash of a text (null: empty), to tell apart rows of one id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, digest long, fp long): a hash and the SimHash of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for s, e in chunks(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, e - s), batch.column(1).slice(s, e - s),
                     pa.array(fingerprint_texts(texts[s:e], words), pa.int64())], [id_col, "digest", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), text_digest(F.col(text_col)).alias("digest"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
            .mapInArrow(run, f"`{id_col}` {kind}, digest long, fp long"))


def _bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def distance_keys(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Nodes with their pivot distances, once for each pair of segments.

    The 64 bits are cut into ``max_bits`` + 2 segments.  Fingerprints that
    differ in at most ``max_bits`` bits agree in at least two whole segments,
    hence in all Hamming distances to the pivots inside those two segments:
    that part of the distance table is the join key, so no pair is missed.
    ``pd`` holds the distances to the whole pivots.
    """
    fp, parts, refs = F.col("fp"), max_bits + 2, pivots()
    cuts = [64 * i // parts for i in range(parts + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    inside = [F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(m))) for p in refs]) for m in signed]
    table = nodes.select("*", F.array(*[_bits_apart(fp, F.lit(p)).cast("tinyint") for p in refs]).alias("pd"),
                         *[d.alias(f"s{i}") for i, d in enumerate(inside)])
    keys = F.array(*[F.xxhash64(F.lit(i), F.col(f"s{a}"), F.col(f"s{b}"))
                     for i, (a, b) in enumerate(combinations(range(parts), 2))])
    return table.select("fp", "node", "pd", F.explode(keys).alias("key"))


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (src, dst) between the ``node`` ids of distinct fingerprints; the
    edges' components are those of all pairs within ``max_bits`` bits."""
    keyed = distance_keys(nodes, max_bits)
    crowd = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stage(keyed.join(crowd, "key"), "simhash-buckets")
    small = shared.filter(F.col("n") <= BUCKET)
    a, b = small.alias("a"), small.select("key", "fp", "node", "pd").alias("b")
    apart = F.greatest(*[F.abs(F.col("a.pd")[i] - F.col("b.pd")[i]) for i in range(PIVOTS)])
    pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
             .filter(apart <= max_bits)
             .filter(_bits_apart(F.col("a.fp"), F.col("b.fp")) <= max_bits)
             .select(F.col("a.node").alias("src"), F.col("b.node").alias("dst")))
    crowded = shared.filter(F.col("n") > BUCKET).select("fp", "node").distinct()
    return pairs.unionByName(_neighbour_links(crowded, max_bits))


def _neighbour_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Exact links without pairs, for nodes of crowded buckets.

    Fingerprints lie within two bits of each other exactly if some value lies
    within one bit of both, so each node offers itself and its 64 one-bit
    neighbours, and the nodes that share a value are tied to the smallest of
    them: 65 rows a node whatever the crowd.  (For another even ``max_bits``, a
    value within half of it.)
    """
    flips = [0]
    for r in range(1, max_bits // 2 + 1):
        flips += [sum(1 << i for i in c) for c in combinations(range(64), r)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    around = nodes.select("node", "fp", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip"))
    around = around.select("node", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    hub = around.groupBy("value").agg(F.min("node").alias("dst"), F.count("*").alias("n")).filter("n > 1")
    return (around.join(hub, "value").filter("node <> dst")
            .select(F.col("node").alias("src"), "dst").distinct())


def components(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(id_col, digest, fp, component_id) of every row: ``digest`` is a hash of
    the text, null ids have no component."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    fps = stage(fingerprints(docs, words, id_col, text_col), "simhash-fingerprints")
    nodes = stage(fps.filter(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("node")), "simhash-nodes")
    roots = connected_components(links(nodes, max_bits), "simhash-components")
    of_fp = (nodes.join(roots, "node", "left")
             .select("fp", F.coalesce("root", "node").alias("component_id")))
    return (fps.join(of_fp, "fp", "left")
            .select(id_col, "digest", "fp", F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SimHash near-duplicates: (id_col, fingerprint, component_id).

    Words, shingles and fingerprints follow the op3 contract; ``component_id``
    is the smallest id reachable over links of ``max_bits`` or fewer differing
    bits (``max_bits`` even), the id itself included.  Equal fingerprints are one node, so a
    large group of copies is one row of the search.  A null or empty text has
    fingerprint zero and links like any other; rows with a null id keep a
    null ``component_id`` and link nothing; repeated rows are returned as
    often; an empty table gives no rows; other columns are not read.
    """
    return (components(docs, words, max_bits, id_col, text_col)
            .select(F.col(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component left: a row of its
    smallest id.  Of rows that share this id but not the text, it is the one
    with the smallest hash of the text; rows of that id in other components
    stay for those.  Rows equal in id and text become one.  Rows with a null
    id stay; an empty table gives no rows."""
    found = components(docs, words, max_bits, id_col, text_col)
    mark = "digest" + "_" * max(map(len, docs.columns))  # longer than any column of theirs
    kept = (found.filter(F.col(id_col) == F.col("component_id")).groupBy(id_col, "component_id").agg(F.min("digest").alias(mark))
            .select(id_col, mark))
    known = docs.filter(F.col(id_col).isNotNull()).withColumn(mark, text_digest(F.col(text_col)))
    return (known.join(kept, [id_col, mark], "left_semi").dropDuplicates([id_col, mark]).select(*docs.columns)
            .unionByName(docs.filter(F.col(id_col).isNull())))
