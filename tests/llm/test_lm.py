import math
import zlib
from collections import Counter

import numpy as np
import pytest

from martforge.llm import lm


def words(text):
    return bytes(text or "", "utf-8").lower().split() + [b"\n"]


def brute(rows):
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not out_of(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return {i: (out_of(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in rows}


def quantised(c, least):
    return least * lm.STEP ** (math.floor(math.log(c / least) / math.log(lm.STEP) + 1e-9) + 0.5) if c >= least else 0


def exact_score(rows):
    """The pair model with a dictionary in place of the filter."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [words(t) for i, t in rows if not held(i)]
    uni = Counter(w for t in train for w in t)
    n, v = sum(uni.values()), len(uni)
    least = max(2, math.ceil(n * lm.LEAST))
    pair = Counter(p for t in train for p in zip([b"\n"] + t[:-1], t))
    mass = Counter()
    for (a, _), c in pair.items():
        if c >= least:
            mass[a] += c
    kept = {w: c for w, c in uni.items() if c >= least}
    rare = (n - sum(kept.values())) / (v - len(kept)) if v > len(kept) else 0
    out = {}
    for i, t in rows:
        s, last = 0, b"\n"
        for w in words(t):
            c = quantised(uni[w], least)
            own = ((c or rare) + 1) / (n + v + 1)
            share = min(math.ceil(mass[last] / uni[last] * lm.SHARES), lm.SHARES - 1) / lm.SHARES if last in kept else 0
            p = (1 - share) * own
            if share and c:
                p += min(quantised(pair[last, w], least) / quantised(uni[last], least), share)
            s, last = s + math.log10(min(p, 1)), w
        out[i] = s
    return out


ROWS = [(0, None), (1, ""), (2, " \t\n"), (3, "One one ONE"), (4, "İ ß é É"), (9, "x " * 30_000)]


def check(got, rows, loose=0.0):
    want, model = brute(rows), exact_score(rows)
    assert len(got) == len(rows)
    near = 0
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], abs=1e-6 * r.n_tokens)
        assert r.score <= 0
        near += abs(r.score - model[r.doc_id]) < 1e-6 + loose * r.n_tokens
    assert near > 0.95 * len(got)


@pytest.mark.parametrize("common", [1 << 20, 5])
def test_against_brute_force(spark, common):
    rng = np.random.default_rng(1)
    rows = ROWS + [(i, " ".join("w%d" % min(199, x) for x in rng.geometric(0.03, 60))) for i in range(10, 200)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    old, lm.COMMON = lm.COMMON, common
    try:
        check(lm.score(docs).collect(), rows, 0.02)
    finally:
        lm.COMMON = old


def test_filter_reads_counts_back(spark):
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(-2**62, 2**62, 4000))
    counts = rng.geometric(0.01, len(keys)) + 1
    df = spark.createDataFrame([(lm.WORD, int(k), 0, int(c)) for k, c in zip(keys, counts)], "kind int, v long, w long, c long")
    f = lm.build(df.withColumn("levels", lm.steps(df.c, 2)), 2)
    got = f.counts(lm.base(lm.WORD, keys))
    want = np.array([quantised(c, 2) for c in counts.tolist()])
    assert (got >= want - 1e-9).all() and (np.abs(got - want) < 1e-9).mean() > 0.98
    other = f.levels(lm.base(lm.WORD, rng.integers(-2**62, 2**62, 20_000)))
    assert (other > 0).mean() < 0.02


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (5, "a b"), (5, "a b")], "doc_id long, text string")
    got = lm.score(docs).collect()
    assert len(got) == 3 and {r.train_tokens for r in got} == {9} and {r.n_known for r in got} == {3}
    assert lm.score(docs.limit(0)).collect() == []
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_whole_table(spark):
    from martforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op7_log_frequency_lm"](spark, d).collect()
    check(got, rows, 0.02)
    out = [r for r in got if r.held_out]
    print("held out: base", sum(r.base_score for r in out) / sum(r.n_tokens for r in out), "model", sum(r.score for r in out) / sum(r.n_tokens for r in out))
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_what_occurs_twice_counts_in_a_large_corpus(spark):
    """Nine million tokens of other words leave the model of a text that occurs twice as it is."""
    twice = " ".join("q%d" % i for i in range(20))
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2]
    docs = (spark.createDataFrame([(ids[0], twice), (ids[1], twice)], "doc_id long, text string")
            .unionByName(spark.createDataFrame([(i,) for i in ids[2:32]], "doc_id long").selectExpr("doc_id", "repeat('z ', 300000) AS text")))
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    assert got[ids[0]].train_tokens > 9_000_000
    # All but the first and the last pair have the whole of their words' followers.
    assert got[ids[0]].score == got[ids[1]].score > -16
    assert got[ids[0]].base_score < -100


@pytest.mark.parametrize("part,hot", [(500, 1 << 17), (500, 4), (100_000, 1 << 17)])
def test_filter_in_parts_against_brute_force(spark, monkeypatch, part, hot):
    rng = np.random.default_rng(4)
    rows = ROWS + [(i, " ".join("w%d" % min(199, x) for x in rng.geometric(0.03, 60))) for i in range(10, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(lm, "PART_TOKENS", part)
    monkeypatch.setattr(lm, "HOT", hot)
    check(lm.score(docs).collect(), rows, 0.02)
