import random

import numpy as np
import pyarrow as pa
import pytest

from martforge.llm import lines as L
from test_simhash import union


def jaccard(a, b):
    x, y = L.shingles(a), L.shingles(b)
    return len(x & y) / len(x | y)


def brute(rows):
    occ = {(i, k): s for i, t in rows if i is not None for k, s in L._lines(t or "")}
    texts = sorted(set(occ.values()))
    edges = [(a, b) for k, a in enumerate(texts) for b in texts[:k] if jaccard(a, b) >= 0.8]
    root = union(texts, edges)
    first = {}
    for key in sorted(occ):
        first.setdefault(root[occ[key]], key)
    return sorted(k for k in occ if first[root[occ[k]]] != k), edges


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(2, 8)))
    pool = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(60)] + ["The end.", "a", "No"]
    rows = []
    for i in range(n):
        own = []
        for _ in range(rng.randrange(6)):
            t = rng.choice(pool)
            if rng.random() < 0.5:
                w = t.split(" ")
                w[rng.randrange(len(w))] = word()
                t = " ".join(w)
            own.append(t + rng.choice(["", " ", "\t"]))
            if rng.random() < 0.2:
                own.append("  ")
        rows.append((i, "\n".join(own)))
    return rows


def test_against_brute_force(spark):
    rows = corpus() + [(None, "a\nThe end."), (100, None), (101, ""), (102, "x" * 70_000 + "\na"), (103, "a\na\n\na"), (103, "a\na\n\na")]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, removed string")
    want, edges = brute(rows)
    got = sorted((r.doc_id, r.line_no) for r in L.repeated_lines(docs).collect())
    assert sorted(set(got)) == want
    report = {r.doc_id: r for r in L.line_report(docs).collect()}
    assert report[100].n_lines == 0 and report[101].n_lines == 1 and report[103].n_lines == 4
    clean = {r.doc_id: r for r in L.dedup_lines(docs).collect()}
    assert L.dedup_lines(docs).columns == docs.columns and L.dedup_lines(docs).count() == docs.count()
    for i, t in rows:
        if i is not None:
            gone = {k for d, k in want if d == i}
            assert clean[i].text == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    assert L.repeated_lines(docs.limit(0)).collect() == [] and L.dedup_lines(docs.limit(0)).collect() == []


def test_recall_of_banding():
    rng = random.Random(6)
    hit = total = 0
    for _ in range(300):
        t = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(6, 80)))
        u = list(t)
        for _ in range(max(1, len(t) // 90)):
            u[rng.randrange(len(u))] = rng.choice("xyz ")
        u = "".join(u)
        if jaccard(t, u) >= 0.8:
            a, b = L.signatures([t, u])
            hit, total = hit + bool((a == b).any()), total + 1
    assert total > 100 and hit / total > 0.97


@pytest.mark.parametrize("size", [1, 3, 50, 1000])
def test_bucket_pairs_over_batches(size):
    rng = np.random.default_rng(0)
    rows = sorted({(int(b), int(h)) for b, h in zip(rng.integers(0, 40, 500), rng.integers(0, 60, 500))} | {(99, h) for h in range(200)})
    rows = sorted(rows + rows[::5])
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + size]]), pa.array([r[1] for r in rows[i:i + size]])], ["band", "h"])
               for i in range(0, len(rows), size)]
    got = {(a, b) for x in L._bucket_pairs(iter(batches)) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())}
    want = set()
    for band in {b for b, _ in rows}:
        own = sorted({h for b, h in rows if b == band})
        want |= {(own[max(0, i - s)] if s <= L.WINDOW else own[0], x) for i, x in enumerate(own) for s in range(1, L.WINDOW + 2) if i - s >= 0 or s > L.WINDOW and i}
    assert got == want


def test_large_group_of_near_copies(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    rows = []
    for i in range(1500):
        own = list(words)
        own[rng.randrange(60)] = "w%d" % rng.randrange(10 ** 6)
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.count() - L.repeated_lines(docs).count() == 1


@pytest.mark.parametrize("cell", [8, 256])
def test_template_lines_that_do_not_all_link(spark, monkeypatch, cell):
    monkeypatch.setattr(L, "CELL", cell, raising=False)
    rng = random.Random(9)
    name = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    lines = []
    for _ in range(200):
        own = f"Permission to use this software is granted to all by {name(11)} under the terms of the licence below"
        lines += [own, name(9) + own[9:]]
    rows = list(enumerate(lines))
    got = sorted((r.doc_id, r.line_no) for r in L.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want, edges = brute(rows)
    assert len(edges) == 200 and got == want


def test_columns_of_the_table_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "the same long line\nown", 1, "x"), (2, "the same long line\nother", 2, "y")],
                                 "doc_id long, text string, _removed int, removed string")
    got = sorted(tuple(r) for r in L.dedup_lines(docs).collect())
    assert got == [(1, "the same long line\nown", 1, "x"), (2, "other", 2, "y")] and L.dedup_lines(docs).schema == docs.schema


def test_similarities_from_hashes_are_those_of_the_sets():
    rng = random.Random(31)
    letters = "ab é中"
    line = lambda: "".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 7, 8, 30, 200])))
    left, right = [line() for _ in range(400)], [line() for _ in range(400)]
    right[:50] = left[:50]
    right[50:150] = [t[:-1] + "x" for t in left[50:150]]
    got = L._jaccards(left, right, 0.0)
    assert np.allclose(got, [jaccard(a, b) for a, b in zip(left, right)])
    near = L._jaccards(left, right, 0.8)
    assert all(abs(x - y) < 1e-12 for x, y in zip(near, got) if y >= 0.8)


def test_template_lines_meet_only_by_what_tells_them_apart(spark):
    """Lines of one template that are below the similarity: hardly a pair is made."""
    import uuid
    rng = random.Random(32)
    lines = [f"Listing of the regional office, printed for the holder {uuid.UUID(int=rng.getrandbits(128)).hex[:14]} on demand" for _ in range(600)]
    df = spark.createDataFrame([(L.line_hash(t), L.line_hash(t), t) for t in lines], "h long, root long, line string")
    pairs = {(r.a, r.b) for r in L._crowd_pairs(df, 0.8).collect()}
    of = {L.line_hash(t): t for t in lines}
    want = {(min(x, y), max(x, y)) for i, x in enumerate(of) for y in list(of)[:i] if jaccard(of[x], of[y]) >= 0.8}
    assert want <= pairs and len(pairs) < len(want) + 5 * len(lines)


def test_bands_are_shuffled_in_packs(spark):
    rows = corpus(33, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text").coalesce(1)
    lines = sorted({s for _, t in rows for _, s in L._lines(t)})
    got = L._bands(docs, L.PARTS).collect()
    have = {(r.part, b, h) for r in got for b, h in zip(np.frombuffer(r.band, np.int64).tolist(), np.frombuffer(r.h, np.int64).tolist())}
    bands = L.signatures(lines) >> L.LOW << L.LOW
    want = {(int(np.uint64(b & (2 ** 64 - 1)) >> np.uint64(54)), b, L.line_hash(t)) for t, own in zip(lines, bands.tolist()) for b in own}
    assert L.PARTS == 1024 and have == want and len(got) <= L.PARTS < len(want) / 4
    assert L._parts(docs) == L.PARTS and L._parts(docs.limit(0)) == L.PARTS


def test_parts_grow_with_the_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "PART", 64)
    assert L._parts(spark.createDataFrame([(1, "x" * 200_000)], "doc_id long, text string")) == 4096


@pytest.mark.parametrize("held", [64, 1 << 21])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pairs_of_packed_bands(monkeypatch, held, size):
    """Buckets of all sizes in parts that are held whole, or thinned as they come."""
    monkeypatch.setattr(L, "HELD", held)
    rng = np.random.default_rng(3)
    bucket = np.concatenate((rng.integers(0, 300, 600), rng.integers(300, 304, 900), np.full(900, 304)))
    band = (L._mix(bucket.astype(np.uint64) + np.uint64(1)) >> np.uint64(L.LOW) << np.uint64(L.LOW)).view(np.int64)
    h = L._mix(rng.integers(1, 2000, len(band)).astype(np.uint64)).view(np.int64)
    order = rng.permutation(len(band))
    packs = [L._packed(band[x], h[x], 8) for x in np.array_split(order, 40)]
    table = pa.Table.from_batches(packs).sort_by("part")
    out = list(L._part_pairs(iter(table.to_batches(max_chunksize=size))))
    got = {(a, b): c for x in out for a, b, c in zip(*(x.column(i).to_pylist() for i in range(3)))}
    crowd = {x for (a, b), c in got.items() if c for x in (a, b)}
    crowd |= {x for o in out for a, b, c in zip(*(o.column(i).to_pylist() for i in range(3))) if c for x in (a, b)}
    plain = set()
    for one in np.unique(band):
        own = np.unique(h[band == one]).tolist()
        assert len(own) <= 1 or len(set(union(own, [p for p in got if p[0] in own and p[1] in own]).values())) == 1
        assert len(own) <= L.WINDOW + 1 or crowd.issuperset(own)
        if len(own) <= L.WINDOW + 2:
            assert all((x, y) in got or (y, x) in got for i, x in enumerate(own) for y in own[:i])
    if held > len(band):
        b, x = L._in_order([(band, h)])
        for o in L._bucket_pairs(iter([pa.RecordBatch.from_arrays([pa.array(b), pa.array(x)], ["band", "h"])])):
            plain |= set(zip(*(o.column(i).to_pylist() for i in range(2))))
        assert plain == set(got)
    assert len(got) <= (L.WINDOW + 1) * len(band) * 2


def test_repeated_rows_are_removed_from_once(spark):
    rows = [(1, "a line of its own\nthe same long line"), (2, "the same long line"), (2, "the same long line"), (2, "the same long line"),
            (3, "other\nthe same long line"), (3, "the same long line\nthe same long line"), (4, "met in one document only"), (4, "met in one document only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.line_no) for r in L.repeated_lines(docs).collect()) == [(2, 0), (3, 0), (3, 1)]
    report = sorted((r.doc_id, r.n_lines, r.n_removed, tuple(r.removed)) for r in L.line_report(docs).collect())
    assert report == [(1, 2, 0, ()), (2, 1, 1, (0,)), (2, 1, 1, (0,)), (2, 1, 1, (0,)), (3, 2, 2, (0, 1)), (3, 2, 2, (0, 1)), (4, 1, 0, ()), (4, 1, 0, ())]


def test_unlike_lines_are_told_apart_before_their_sets_are_made(monkeypatch):
    rng = random.Random(34)
    line = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30))
    sorted_numbers = []
    distinct = L._distinct
    monkeypatch.setattr(L, "_distinct", lambda x: sorted_numbers.append(len(x)) or distinct(x))
    left, right = [line() for _ in range(200)], [line() for _ in range(200)]
    assert not L._jaccards(left, right, 0.8).any() and sum(sorted_numbers) == 0
    near = L._jaccards(left, [t[:-1] + "x" for t in left], 0.8)
    assert (near > 0.9).all()
