import math
import random
import re

from martforge.llm import ranked as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    docs = [(i, cut(t)) for i, t in docs if i is not None]
    n_docs, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(cut(t))
    out = []
    for item, names in asked.items():
        found = []
        for d, w in docs:
            m = 100 - 90 + (90 * len(w) * n_docs) // total if total else 0
            score = 0
            for t in names & set(w):
                df, tf = sum(t in set(x) for _, x in docs), w.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def answer(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id int, term string").repartition(5)
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id string, text string, doc_id int")
    df = R.search(d, i, **more)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed=13):
    rng = random.Random(seed)
    words = [f"{rng.choice(['Ab', 'é', '中', '7', 'zß', 'Ä'])}{i}" for i in range(60)]
    text = lambda n: rng.choice([" ", "-", "\x00", " "]).join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 4, 30, 200]))) for i in range(80)]
    docs += [(200 + i, docs[3][1]) for i in range(15)] + [(5, docs[5][1]), (None, text(9)), (300, None), (301, "!?"), (302, "ab0 " * 40_000)]
    items = [(f"i{i}", text(rng.choice([1, 5, 40]))) for i in range(12)]
    return docs, items + [("i0", text(3)), (None, text(3)), ("empty", "-"), ("null", None), ("none", "nowhere")]


def test_against_brute_force(spark):
    docs, items = corpus()
    want = brute(docs, items)
    assert answer(spark, docs, items) == want
    assert answer(spark, docs, items, block=400) == want       # several blocks
    assert answer(spark, docs, items, k=3) == brute(docs, items, 3)


def test_small_heap_flushes(spark, monkeypatch):
    docs, items = corpus(14)
    monkeypatch.setattr(R, "CELLS", 40)
    monkeypatch.setattr(R, "ADDED", 7)
    assert answer(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    assert answer(spark, [], items) == [] and answer(spark, docs, []) == [] and answer(spark, [(1, ""), (2, None)], items) == []
