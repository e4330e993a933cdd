import zlib

import numpy as np
import pytest

from martforge.llm import quality as Q


def rows_of(spark, d):
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels


def test_pairwise_identity():
    rng = np.random.default_rng(0)
    m = Q.Machine(0.3, rng.normal(size=Q.SLOTS + len(Q.STATS)), rng.normal(size=(Q.SLOTS + len(Q.STATS), Q.FACTORS)),
                  np.zeros(len(Q.STATS)), np.ones(len(Q.STATS)))
    features = Q.Features()(["a b c a", "", "One two\nTWO"], [7, None, 3])
    idx, val, first = m.inputs(*features)
    got = m.raw(idx, val, first)[0]
    for t, (s, e) in enumerate(zip(first, [*first[1:], len(idx)])):
        i, x = idx[s:e], val[s:e]
        want = m.bias + m.weight[i] @ x + sum(m.factor[i[a]] @ m.factor[i[b]] * x[a] * x[b] for a in range(e - s) for b in range(a))
        assert got[t] == pytest.approx(want)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    from martforge.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    docs, labels = rows_of(spark, d)
    got = {r.doc_id: r for r in QUERIES["op4_quality_fm"](spark, d).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    marks = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    s, y = np.array(marks).T
    right = ((s >= 0.5) == y).mean()
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean()
    kept = (s[y == 1] >= 0.5).mean()
    print(sf, "accuracy", right, "AUC", auc, "kept", kept, "rejected", (s[y == 0] < 0.5).mean())
    assert right > 0.95 and auc > 0.97 and kept > 0.97


def test_labels_ids_and_sources_are_no_inputs(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = rows_of(spark, d)
    model = Q.train(docs, labels)
    a = sorted(r.score for r in Q.score(docs, model).collect())
    b = sorted(r.score for r in Q.score(docs.selectExpr("doc_id + 100000 as doc_id", "text", "'x' as lang", "'y' as source", "n_chars"), model).collect())
    assert a == b


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, None, 1), (1, "", 0, 1), (2, "a " * 60_000, 9, 1), (2, "a " * 60_000, 9, 1)],
                                 "doc_id long, text string, n_chars long, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 0)], "doc_id long, quality int")
    got = Q.score(docs, Q.train(docs, labels)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "None"] and all(0 <= r.score <= 1 for r in got)
    none = Q.train(docs, labels.limit(0))
    assert {r.predicted for r in Q.score(docs, none).collect()} == {1}
    assert Q.score(docs.limit(0), none).collect() == []
    kept = Q.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4


def test_an_id_on_very_many_rows_is_one_row_of_the_sample(spark):
    from pyspark.sql import functions as F
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("text of"), "id").alias("text"), F.lit(None).cast("long").alias("n_chars"))
    hot = spark.range(3_000).select(F.lit(4).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("other"), F.col("id") % 7).alias("text"),
                                    F.lit(None).cast("long").alias("n_chars"))
    sent = spark.sparkContext.accumulator(0)
    made = Q.Features.__call__

    class Counted(Q.Features):
        def __call__(self, texts, stated):
            sent.add(len(texts))
            return made(self, texts, stated)

    old, Q.Features = Q.Features, Counted
    try:
        a = Q.train(docs.unionByName(hot), labels)
        assert sent.value <= 40
        b = Q.train(docs.unionByName(hot).repartition(7), labels)
    finally:
        Q.Features = old
    x, y = ([r.score for r in Q.score(docs.orderBy("doc_id"), m).collect()] for m in (a, b))
    assert x == y  # whichever row arrives first
