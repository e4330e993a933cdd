import random

import pytest
import xxhash
from pyspark.sql import functions as F

from martforge.llm import simhash as S
from martforge.llm.common import connected_components


def brute_fp(text, words=3):
    w = bytes((text or ""), "utf-8").lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def union(nodes, edges):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows):
    fps = {i: brute_fp(t) for i, t in rows if i is not None}
    ids = sorted(fps)
    edges = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = union(ids, edges)
    return {i: (f"{fps[i]:016x}", roots[i]) for i in ids}


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = ["Alpha", "beta", "GAMMA", "délta", "e", "ß", "İx", "z "]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"), (6, "long word " * 5000)]
    base = [rng.choice(words) + str(rng.randrange(40)) for _ in range(300)]
    for i in range(7, 160):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = "new%d" % rng.randrange(9)
        rows.append((i, rng.choice([" ", "\x0b", "\r\n"]).join(own)))
    rows += [(i, "filler %d text %d" % (i % 7, i % 3)) for i in range(200, 240)]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, fp int")
    want = brute(rows)
    for bucket in (64, 2):  # the second sends nearly all nodes through shared neighbours
        S.BUCKET, old = bucket, S.BUCKET
        try:
            got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()}
        finally:
            S.BUCKET = old
        assert got == want


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_on_close_fingerprints(spark, bucket):
    rng = random.Random(2)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(20):
            fps.add(f)
            f ^= 1 << rng.randrange(64)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "node long, fp long")
    S.BUCKET, old = bucket, S.BUCKET
    try:
        roots = {r.node: r.root for r in connected_components(S.links(nodes)).collect()}
    finally:
        S.BUCKET = old
    edges = [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps) if i < j and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    want = union(range(len(fps)), edges)
    assert {i: roots.get(i, i) for i in range(len(fps))} == want


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "a b c d")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5), (5, 5), (9, 5), (None, None)]
    kept = S.keep_one(docs).collect()
    assert sorted([r.doc_id for r in kept], key=str) == [5, None]
    assert S.near_duplicates(docs.limit(0)).collect() == []
    assert S.keep_one(docs.limit(0)).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(300)}, 2000: 2000, 2001: 2000}
    assert connected_components(df.limit(0)).collect() == []


def test_whole_table(spark):
    from martforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_pivots"](spark, d).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got == brute(rows)


def test_one_document_of_each_group_stays_and_own_texts_too(spark):
    """An id on several rows: its near copy of a smaller id goes, its own text
    stays; of unlike rows of a component's smallest id one stays."""
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w399", "x399")
    rows = [(1, base, "a", 0), (5, near, "b", 0), (5, "an own text of that id " * 9, "c", 0), (5, "an own text of that id " * 9, "d", 0),
            (7, base, "e", 0), (None, base, "f", 0), (9, None, "g", 0), (9, "", "h", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, fp int")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs.filter("doc_id in (1, 7)")).collect()}
    assert got == {1: 1, 7: 1}
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, base), (5, "an own text of that id " * 9), (None, base), *[(r.doc_id, r.text) for r in kept.collect() if r.doc_id == 9]], key=repr)
    assert sum(r.doc_id == 9 for r in kept.collect()) == 1
    # Texts of one fingerprint group under one id: one of them stays.
    two = spark.createDataFrame([(1, base, "a", 0), (1, base.upper(), "b", 0)], docs.schema)
    assert S.keep_one(two).count() == 1 and S.keep_one(two.repartition(3)).first().text == S.keep_one(two).first().text
