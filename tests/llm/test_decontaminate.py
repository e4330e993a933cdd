import random
from collections import Counter

import numpy as np

from martforge.llm import decontaminate as D


def cut(text):
    return [w for w in map(D.normal, (text or "").lower().split()) if w]


def grams(words):
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(docs, items):
    """Weighted Jaccard over every window, without fingerprints."""
    items = [(i, cut(t)) for i, t in items if i is not None and cut(t)]
    df = Counter(g for _, w in items for g in grams(w))
    weight = lambda g: np.log1p(len(items) / df[g]) if df[g] else np.log1p(len(items))
    out = {}
    for d, t in docs:
        words = cut(t)
        for i, own in items:
            k, want, best = min(5, len(own)), grams(own), 0
            for s in range(max(1, len(words) - len(own) + 1)):
                win = words[s:s + len(own)]
                if len(win) < k:
                    continue
                have = Counter(tuple(win[j:j + k]) for j in range(len(win) - k + 1))
                both = sum(weight(g) * min(n, want[g]) for g, n in have.items())
                every = sum(weight(g) * max(have[g], want[g]) for g in have | want)
                best = max(best, both / every)
            if d is not None and best >= 0.8:
                out[d, i] = best
    return out


def fixture(seed=1):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(50)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 14, 20, 30, 45, 59, 59])]
    items += [(50, items[7][1]), (51, None), (52, " ... "), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(120):
        words = [rng.choice(vocab + ["Other%d" % d, "--"]) for _ in range(rng.choice([3, 20, 90]))]
        if d % 2:
            own = (rng.choice(items[3:11])[1]).split()
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = "edit"
            own = own[rng.randrange(3):len(own) - rng.randrange(3)]
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "!!"]) for w in own]
        docs.append((d, " ".join(words)))
    return docs + [(200, None), (201, ""), (202, items[9][1]), (203, items[9][1] + "\n" + items[7][1])], items


def test_against_brute_force(spark):
    docs, items = fixture()
    df = spark.createDataFrame([(d, t, 0.5) for d, t in docs + [(None, items[9][1])]], "doc_id long, text string, similarity double")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items + items[:3]], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.leaks(df, bench).collect()}
    want = brute(docs, items)
    assert set(got) <= set(want) and all(abs(got[x] - want[x]) < 1e-9 for x in got)
    missed = set(want) - set(got)
    assert len(missed) <= 0.01 * len(want) and all(want[x] < 0.9 for x in missed)
    kept = {r.doc_id for r in D.drop_leaks(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}
    assert D.drop_leaks(df, bench).columns == df.columns
    old, D.BLOCK_WORDS = D.BLOCK_WORDS, 10
    try:
        assert len(list(D._blocks(bench, "item_id", "text"))) > 3
        assert D.drop_leaks(df, bench).count() <= df.count()
    finally:
        D.BLOCK_WORDS = old


def test_blocks_find_all_within_the_radius():
    docs, items = fixture(2)
    index = D.Index([x for x in items if x[0] is not None and x[1]])
    rng = random.Random(3)
    for i, p in enumerate(index.prints):
        for n in (0, 1, D.RADIUS, D.RADIUS + 1):
            f = p
            for b in rng.sample(range(64), n):
                f ^= 1 << b
            assert (i in index.near(f, index.size[i])) == (n <= D.RADIUS)


def test_empty(spark):
    docs, items = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.leaks(df.limit(0), bench).collect() == []
    assert D.leaks(df, bench.limit(0)).collect() == []
    assert D.drop_leaks(df, bench.limit(0)).count() == df.count()


def test_whole_table(spark):
    from martforge.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontaminate"](spark, d).collect()}
    sets = {i: set(grams(cut(t))) for i, t in items}
    near = [(x, t) for x, t in docs if any(len(s & set(grams5(t))) >= 0.5 * len(s) for s in sets.values())]
    want = {}
    for x, t in near:
        for i, it in items:
            if len(sets[i] & set(grams5(t))) >= 0.5 * len(sets[i]):
                want |= {k: v for k, v in one(x, t, i, it, items).items()}
    print(len(got), len(want))
    assert got <= set(want) and len(set(want) - got) <= 0.01 * len(want)


def grams5(text):
    w = cut(text)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def one(d, text, i, item, items):
    """The brute force of a single pair, with the weights of all items."""
    global _DF
    words, own = cut(text), cut(item)
    if "_DF" not in globals():
        _DF = Counter(g for _, t in items for g in grams(cut(t)))
    weight = lambda g: np.log1p(len(items) / _DF[g]) if _DF[g] else np.log1p(len(items))
    want = grams(own)
    hits = [s for s in range(len(words) - 4) if tuple(words[s:s + 5]) in want]
    best = 0
    for s in sorted({max(0, min(h + o, len(words) - len(own))) for h in hits for o in range(-len(own), 6)}):
        win = words[s:s + len(own)]
        have = Counter(tuple(win[j:j + 5]) for j in range(len(win) - 4))
        both = sum(weight(g) * min(n, want[g]) for g, n in have.items())
        best = max(best, both / sum(weight(g) * max(have[g], want[g]) for g in have | want))
    return {(d, i): best} if best >= 0.8 else {}
