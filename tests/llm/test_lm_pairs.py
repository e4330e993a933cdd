"""The pair counts leave out no pair that the filter's least frequency asks for."""
import pickle
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from martforge.llm import lm


def test_every_frequent_pair_is_counted(spark):
    r = random.Random(3)
    texts = [" ".join(f"w{min(r.randrange(60), r.randrange(60))}" for _ in range(r.randrange(40))).encode() for _ in range(200)]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "text binary").repartition(3)
    known, want = lm.Hashes(), Counter()
    for t in texts:
        own = [int(x) for x in known.of([t])[0]]
        want.update(zip([int(lm.END), *own], own))
    for least in (2, 9, 40):
        words = (lm.word_counts(df).filter(F.col("c") >= least)
                 .select(F.lit(lm.WORD).alias("kind"), F.col("w").alias("v"), F.lit(0).cast("long").alias("w"), lm.steps(F.col("c"), least).alias("levels")))
        got = {(x.v, x.w): x.n for x in lm.pair_counts(df, lm.build(words, least)).filter(F.col("n") >= least).collect()}
        assert got == {k: n for k, n in want.items() if n >= least}


def test_known_levels_are_not_probed_again(monkeypatch):
    keys = lm.base(lm.WORD, np.arange(3000))
    want = np.arange(3000) % 40
    bits = np.zeros((2, lm.REGION), np.uint8)
    for level in range(1, 40):
        own = keys[want >= level]
        a, b = lm.halves(own, level)
        for i in range(lm.PROBES):
            bits[(own % np.uint64(2)).astype(np.int64), lm.place(a, b, i)] = 1
    sent = pickle.dumps(lm.Filter(np.packbits(bits, axis=1, bitorder="little"), 2))
    assert len(sent) < 1.1 * 2 * lm.REGION / 8  # the bits once, nothing remembered
    probed, probe = [], lm.Filter._probe
    monkeypatch.setattr(lm.Filter, "_probe", lambda self, key, *a: probed.append(len(key)) or probe(self, key, *a))
    for places in (1 << 20, 64):  # with few places keys push each other out
        monkeypatch.setattr(lm, "PLACES", places)
        f = pickle.loads(sent)
        first = f.levels(keys)
        assert (first >= want).all() and (first == want).mean() > 0.98
        levels, once = dict(zip(keys.tolist(), first.tolist())), sum(probed)
        probed.clear()
        for part in (keys, keys[::-1], np.repeat(keys, 3)[::2], keys[:0]):
            assert f.levels(part).tolist() == [levels[k] for k in part.tolist()]
        if places > len(keys):
            assert sum(probed) < once / 4
        probed.clear()
