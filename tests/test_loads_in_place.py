"""Loads that leave the records where a join put them, and files read in place."""
import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from martforge import views as V
from martforge.llm import lines as L
from martforge.operators import keys as K
from martforge.plans import sales_load as SL
from martforge.plans import strikes_load as STL
from martforge.sources import csv as CSV
from martforge.sources import xml as X
from martforge.streaming.epoch_tables import EpochTables

from conftest import SF001
from tests_support import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lead", ["id % 97", "if(id % 3 = 0, null, id % 97)", "if(id % 2 = 0, 7, id)"])
def test_ids_in_place_follow_the_order(spark, monkeypatch, lead):
    monkeypatch.setattr(K, "_COMMON", 100)
    df = spark.range(3_000).select(F.expr(lead).alias("k"), F.expr("(id * 7919) % 50").alias("b"), F.col("id").cast("string").alias("t"))
    got = rows(K.dense_ids_in_place(df, ["k", "b", "t"], "n", offset=5), "n", "k", "b", "t")
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
    assert sorted(got) == [(i + 6, *r) for i, r in enumerate(want)]
    assert K.dense_ids_in_place(df.limit(0), ["k"], "n").collect() == []


def _records(spark):
    data = [(i // 3, i % 5, str(i // 3 % 40), "1/2/2001", [None, "Peru", "Chad"][i // 3 % 3], "Air", "747", "1,000", "Yes", "No Cloud", "2", "F", "no")
            for i in range(600)]
    return spark.createDataFrame(data, "o long, l int, " + ", ".join(f"{c} string" for c in STL.CSV_FIELDS))


def test_flights_and_airports_take_one_run_of_the_records(spark):
    raw, seen = _records(spark), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    load = STL.StrikesLoad(raw.mapInArrow(count, raw.schema), ["o", "l"])
    got = rows(load.flights)
    assert seen.value == 600
    numbered = STL.StrikesLoad(raw, ["o", "l"])
    numbered.staged
    assert got == rows(numbered.flights) and rows(load.airports) == rows(numbered.airports)


def test_first_of_equal_rows_with_shared_first_values(spark):
    data = [(1, 3, "a", 1), (1, 2, "b", None), (1, 2, "a", 1), (None, 9, "c", 2), (5, 1, "c", 2), (2, None, "d", 0), (2, 4, "d", 0), (4, 1, "e", 0),
            (None, 8, "f", 0)]
    got = K.first_of_equal_rows(spark.createDataFrame(data, "o long, p int, t string, x int"), ["o", "p"], "at")
    order = [r.t for r in got.orderBy("at").collect()]
    assert order == ["f", "c", "b", "a", "d", "e"] or order == ["f", "c", "a", "b", "d", "e"]
    assert rows(got.select("t", "at.o")) == sorted([("a", 1), ("b", 1), ("c", None), ("d", 2), ("e", 4), ("f", None)], key=repr)


def test_small_dimensions_do_not_move_the_records(spark):
    txn = spark.createDataFrame([(i, "1/1/2001", f"c{i % 9}", f"p{i % 4}", "1", "2", "US", str(i % 3)) for i in range(200)],
                                "o long, " + ", ".join(f"{c} string" for c in SL.TXN_FIELDS))
    reps = spark.createDataFrame([(f"r{i}", "a", "b", "c") for i in range(3)], ", ".join(f"{c} string" for c in SL.REP_FIELDS))
    load = SL.SalesLoad(txn, reps, ["o"], "null")
    assert "hashpartitioning(prod" not in _plan(load.salestxn)
    assert load.salestxn.where("pidFK is null or cidFK is null or ridFK is null").count() == 0 and load.salestxn.count() == 200
    assert "hashpartitioning(sky" not in _plan(STL.StrikesLoad(_records(spark), ["o", "l"]).strikes)


def test_compaction_leaves_the_rows_in_their_files(spark, tmp_path):
    s = EpochTables(spark, str(tmp_path), {"t": []})
    for e in range(2):
        s.write("t", spark.range(e * 10, e * 10 + 10).coalesce(1), e)
    assert s.compact(1) and rows(s.read("t")) == sorted([(i,) for i in range(20)], key=repr)
    assert len(glob.glob(f"{tmp_path}/_compact/*/t/part-*")) <= 2


def test_csv_records_are_put_together_in_their_split():
    def batch(block, texts, inside, records):
        n = len(texts)
        odd = [t.count('"') % 2 for t in texts]
        return pa.RecordBatch.from_arrays([pa.array(["f"] * n), pa.array([block] * n), pa.array(odd), pa.array(texts), pa.array([inside] * n),
                                           pa.array([records] * n)], ["file", "block", "odd", "line", "inside", "records"])

    batches = [batch(0, ["a,b", '1,"x'], 0, 0), batch(0, ['y"', "2,z", '3,"p'], 0, 0), batch(90, ["q", 'r"', "4,t"], 1, 4)]
    got = sorted((r["no"], r["block"], r["line"], r["whole"]) for b in CSV._split_records(iter(batches)) for r in b.to_pylist())
    assert got == [(0, 0, "a,b", True), (1, 0, '1,"x\ny"', True), (2, 0, "2,z", True), (3, 0, '3,"p', False), (3, 90, 'q\nr"', False), (4, 90, "4,t", True)]
    counts = [r for b in CSV._split_counts(x.select([0, 1, 2]) for x in batches) for r in b.to_pylist()]
    assert counts == [{"file": "f", "block": 0, "odd": 1, "h0": 4, "h1": 1}, {"file": "f", "block": 90, "odd": 1, "h0": 2, "h1": 1}]


def test_xml_rows_are_not_moved_to_count_them(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<log>" + "".join(f"<txn><qty>{i}</qty></txn>" for i in range(50)) + "</log>")
    for read in (X.read_xml_documents, X.read_xml_split):
        got = read(spark, str(tmp_path), "txn", ["qty"])
        assert "SortMergeJoin" not in _plan(got)
        assert rows(got, "qty", "_pos") == sorted([(str(i), i) for i in range(50)], key=repr)


def test_bands_and_line_hashes_sort_as_one_number(spark):
    docs = spark.createDataFrame([(f"line {i} of the text\nthe end of them",) for i in range(40)], "text string").coalesce(1)
    got = L._bands(docs).toArrow()
    assert not (got.column("band").to_numpy() & ((1 << L.LOW) - 1)).any()
    assert len(np.unique(got.column("band").to_numpy())) > 20


def test_an_orders_texts_are_made_before_the_line_items_meet_it(spark):
    raw = V.raw_strikes(spark, SF001).select("l_orderkey", "altitude_ft", "flight_date")
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("format_number") and plan.index("Join Inner") < plan.index("date_format")


def test_xml_files_are_written_without_a_sort_and_indents(spark, tmp_path, monkeypatch):
    df = spark.range(0, 60, numPartitions=2).select(
        F.struct(F.col("id").cast("string").alias("qty"), F.when(F.col("id") % 7 > 0, "<&>").alias("prod")).alias("txn"),
        F.concat(F.lit("f"), (F.col("id") % 5).cast("string")).alias("file"))
    want = sorted((f"f{i % 5}", str(i), "<&>" if i % 7 else None) for i in range(60))
    conf, used, save = X.OPEN_FILES_CONF, [], DataFrameWriter.save
    before = spark.conf.get(conf)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **b: (used.append(int(spark.conf.get(conf))), save(self, *a, **b))[1])
    for n, files in enumerate((16, 2)):  # with fewer open files than values a task sorts the rest
        monkeypatch.setattr(X, "OPEN_FILES", files)
        root = str(tmp_path / f"out{n}")
        X.write_xml_files(df, root, "entry", "sales", "file")
        assert used.pop() == files and spark.conf.get(conf) == before
        text = [p.read_text() for p in (tmp_path / f"out{n}").glob("f*.xml")]
        assert len(text) == 10 and not any("\n " in t for t in text)
        got = X.read_xml_records(spark, root, "txn", ["qty", "prod"])
        name = F.regexp_extract("_file", r"(f\d)-\d+\.xml$", 1)
        assert sorted((tuple(r) for r in got.select(name, "qty", "prod").collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(Exception):
        X.write_xml_files(df.withColumn("file", F.raise_error(F.lit("bad")).cast("string")), str(tmp_path / "bad"), "entry", "sales", "file")
    assert spark.conf.get(conf) == before
