import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from martforge.llm import fingerprints as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def shingles(text, words=P.WORDS):
    w = WORD.findall(text or "")
    out = set()
    for i in range(max(len(w) - words, 0) + 1 if w else 0):
        h = 42
        for x in w[i:i + words]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        out.add(signed(h))
    return out


def bottom(hashes, k=P.K):
    return sorted(hashes)[:k]


def likeness(a, b, k=P.K):
    u = bottom(set(a) | set(b), k)
    return len(set(u) & set(a) & set(b)) / len(u) if u else 1.0


def text_of(s):
    return "".join(f"{h & (1 << 64) - 1:016X}" for h in s)


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    below = lambda i: (i is not None, i or 0)
    ids = sorted({i for i, _ in rows}, key=below, reverse=True)
    out = []
    for i, t in rows:
        nxt = ids[(ids.index(i) + 1) % len(ids)]
        u = min((u for j, u in rows if j == nxt), key=lambda u: hashlib.sha256(u.encode()).digest())
        m = len(t) // 3
        edited = t[:len(t) - m] + u[:m]
        a, b, c = (bottom(shingles(x)) for x in (t, edited, u))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def answer(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, next string, id int")
    return sorted((tuple(r)[:7] for r in P.fingerprint_documents(docs).collect()), key=repr)


def corpus():
    rng = random.Random(12)
    words = [f"w{i}é" for i in range(300)]
    rows = [(i * 7 - 40, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 5, 6, 40, 400])))) for i in range(40)]
    return rows + [(2, rows[5][1]), (500, None), (501, ""), (600, "𝔸 b c\td\ne\x0bf g"), (601, "z " * 30_000 + "end")]


def test_against_brute_force(spark):
    rows = corpus()
    assert answer(spark, rows) == brute(rows)


def test_null_ids_repeats_and_few_rows(spark):
    rows = [(None, "a b c d e f"), (None, "u v w x y z"), (3, "one two three"), (3, "one two three"), (3, "1 2 3 4 5 6 7"), (9, "p q r s t u v w")]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, [(1, "only one here now ok yes")]) == brute([(1, "only one here now ok yes")])
    assert answer(spark, []) == []


def test_merge_equals_sketch_of_the_whole(spark):
    rng = random.Random(13)
    parts = [[rng.randrange(-1 << 63, 1 << 63) for _ in range(n)] for n in (300, 5, 0, 1000)]
    df = spark.createDataFrame([("g", bottom(p)) for p in parts] + [("e", []), ("e", None), (None, [4])], "g string, s array<bigint>")
    got = {r.g: r.sketch for r in P.merge_groups(df, "g", "s").collect()}
    assert got == {"g": bottom({h for p in parts for h in p}), "e": [], None: [4]}


@pytest.mark.parametrize("shared", [0, 500, 1500, 2000])
def test_estimates(spark, shared):
    rng = random.Random(14 + shared)
    draw = lambda n: [rng.randrange(-1 << 63, 1 << 63) for _ in range(n)]
    both = draw(shared)
    a, b = both + draw(2000 - shared), both + draw(3000 - shared)
    df = spark.createDataFrame([(bottom(a, 512), bottom(b, 512))], "a array<bigint>, b array<bigint>")
    r = df.select(P.resemblance(F.col("a"), F.col("b"), 512), P.containment(F.col("a"), F.col("b"), 512), P.distinct_shingles(F.col("a"), 512),
                  P.from_text(P.as_text(F.col("a"))) == F.col("a")).first()
    assert abs(r[0] - shared / (5000 - shared)) < 0.08 and abs(r[1] - shared / 2000) < 0.17 and abs(r[2] / 2000 - 1) < 0.2 and r[3]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = P.fingerprint_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
