import os
import subprocess
import sys

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from martforge.llm import decontaminate, lines, quality
from martforge.llm.common import read, stage
from test_decontaminate import one
from test_simhash import brute as simhash_brute

D = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = read(spark, D, "documents")
    columns, kept = docs.columns, []
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, stage(f(spark, docs, D), "test-" + name)
        kept.append((name, rows(before), rows(docs)))
        if name != "bpe":
            assert docs.columns == columns
    assert [k[0] for k in kept] == ["quality", "line_dedup", "simhash_dedup", "decontaminate", "bpe"]

    _, a, b = kept[0]
    source = read(spark, D, "documents")
    score = rows(quality.score(source, quality.train(source, read(spark, D, "labels"))))
    assert b == {i: r for i, r in a.items() if score[i]["predicted"] == 1}
    labels = {r.doc_id: r.quality for r in read(spark, D, "labels").collect()}
    assert all(i in b for i, q in labels.items() if q == 1)

    _, a, b = kept[1]
    assert set(a) == set(b)
    seen, nodes = {}, []
    for i in sorted(a):
        for k, s in lines._lines(a[i]["text"]):
            nodes.append((i, k, s))
    sets = {s: lines.shingles(s) for _, _, s in nodes}
    texts = sorted(sets)
    up = {t: t for t in texts}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t
    for n, x in enumerate(texts):
        for y in texts[:n]:
            both = len(sets[x] & sets[y])
            if both and both / (len(sets[x]) + len(sets[y]) - both) >= 0.8:
                up[root(x)] = root(y)
    gone = set()
    for i, k, s in nodes:
        if seen.setdefault(root(s), (i, k)) != (i, k):
            gone.add((i, k))
    for i in a:
        assert b[i]["text"] == "\n".join(t for k, t in enumerate(a[i]["text"].split("\n")) if (i, k) not in gone)

    _, a, b = kept[2]
    groups = simhash_brute([(i, r["text"]) for i, r in a.items()])
    assert b == {i: a[i] for i, (_, c) in groups.items() if c == i}

    _, a, b = kept[3]
    items = [tuple(r) for r in read(spark, D, "benchmark").select("item_id", "text").collect()]
    leaks = {i for i, r in a.items() if any(one(i, r["text"], k, t, items) for k, t in items)}
    assert leaks and set(b) == set(a) - leaks

    _, a, b = kept[4]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert {i: r["ids"] for i, r in b.items()} == {i: t.encode(r["text"], add_special_tokens=False).ids for i, r in a.items()}


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, D)
    assert got.count() > 50 and got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_empty_and_null_documents(spark, tmp_path):
    source = read(spark, D, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "s", None), (8, "", "en", "s", 0)], source.schema)
    for docs, n in ((source.limit(0), 0), (odd, 2)):
        out = docs
        for name, f in corpus_pipeline.STAGES:
            out = stage(f(spark, out, D), "test-odd")
        assert out.count() == n  # the null and the empty text are one SimHash group; the row without an id stays


def test_entry_without_the_subpackage(tmp_path):
    """__spark_entry__ imports and lists the other queries when the llm code is gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    os.mkdir(tmp_path / "martforge")
    for p in os.listdir(f"{root}/martforge"):
        if p != "llm":
            os.symlink(f"{root}/martforge/{p}", tmp_path / "martforge" / p)
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', '__spark_entry__.py'); e = u.module_from_spec(s); s.loader.exec_module(e); "
            "q = e.queries(); assert len(q) > 90 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)
