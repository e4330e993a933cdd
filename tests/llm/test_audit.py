import random
import re
from itertools import permutations

from martforge.llm import audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Plain loops over rows, orders and steps."""
    good, toxic = {}, {}
    for i, q, t in labels:
        if i is not None:
            good[i], toxic[i] = good.get(i, 0) or int(q == 1), toxic.get(i, 0) or int(t == 1)
    rows = []
    for i, s, t in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {c for c, hit in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i and (u or "") == t for j, _, u in docs))) if hit}
        rows.append((s or "", fails, good.get(i, 0), toxic.get(i, 0)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(range(len(own)))
            for k, f in enumerate(order):
                gone = [x for x in left if f in own[x][1]]
                earlier = [x for x in range(len(own)) if x not in left and f in own[x][1]]
                left = [x for x in left if f not in own[x][1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), len(earlier), sum(r[1] == {f} for r in own),
                                                    sum(own[x][2] for x in gone), sum(own[x][3] for x in gone)]
        for (p, o, k), v in out.items():
            if p == part:
                v.append(shapley[o[k - 1]])
    return out


def answer(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, source string, text string, mask int, part int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = A.audit_filters(d, lab)
    assert df.columns == ["part", "filter_order", "step", *A.COUNTS, "shapley"]
    return {(r[0], r[1], r[2]): list(r[3:]) for r in df.collect()}


def test_against_brute_force(spark):
    rng = random.Random(11)
    pool = ["", "a b", "A B C", "x $ y", " ".join(f"w{i}" for i in range(60)), " ".join(["q"] * 70), " é" * 40, "Z" + " y\x0bz" * 60,
            "w " * 20_000 + "| W"]
    docs = [(rng.choice([i, i, i, None]), rng.choice(["s", "t", None]), rng.choice(pool)) for i in range(60)]
    docs += [(3, "s", "a b"), (3, "s", "a b"), (3, "t", "a b"), (70, "s", None), (71, "s", None), (71, "s", "other")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(2, 1, 1), (None, 1, 1), (70, 1, 0)]
    assert answer(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert answer(spark, [], []) == {}
    assert len(answer(spark, [(1, "s", "a")], [])) == 600
