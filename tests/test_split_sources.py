"""Large files read by many tasks: the same rows as one task reads."""
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martforge.sources import csv as CSV
from martforge.sources import xml as X

from tests_support import rows


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def csv_text(n=300, end="\n", seed=3):
    rng = random.Random(seed)
    field = lambda: rng.choice(["", "NA", "x", "é 中", '"a,b"', f'"line{end}two"', '"say ""hi"""', f'"{end}{end}"', '"NA"', '""', '","', f'"a""{end}b"'])
    return end.join(["id,a,b,c"] + [f"{i},{field()},{field()},{field()}" for i in range(n)]) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_splits_equal_one_task(spark, tmp_path, small_splits, end):
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_bytes(csv_text(300, end, k).encode())
    got = CSV.read_csv_split(spark, str(tmp_path), position=True)
    assert CSV._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    want = CSV.read_csv_text(spark, str(tmp_path))
    assert rows(got.drop("_file", "_pos")) == rows(want) and want.count() == 600
    # Positions count the records of each file in order.
    assert rows(got.select("_file", F.col("_pos").cast("string").alias("p"))) == rows(got.select("_file", F.col("id").alias("p")))
    assert rows(CSV.read_csv_split(spark, str(tmp_path), ["c", "id"])) == rows(want.select("c", "id"))


def test_csv_blank_lines_and_no_last_line_end(spark, tmp_path, small_splits):
    p = tmp_path / "a.csv"
    p.write_text('k,v\n\n1,"x\n\ny"\n\n2,z')
    assert rows(CSV.read_csv_split(spark, str(p))) == [("1", "x\n\ny"), ("2", "z")] == rows(CSV.read_csv_text(spark, str(p)))


def test_csv_open_quotes_fail(spark, tmp_path, small_splits):
    p = tmp_path / "a.csv"
    p.write_text(csv_text(100) + '7,"never closed,x,y\n')
    with pytest.raises(Exception, match="quotes not closed"):
        CSV.read_csv_split(spark, str(p)).collect()


@pytest.mark.parametrize("read", [CSV.read_csv_text, CSV.read_csv_split])
def test_csv_fill(spark, tmp_path, read):
    p = tmp_path / "a.csv"
    p.write_text('a,b,c\n1,2,3\n4\n5,"x,\ny"\n,NA\n')
    assert rows(read(spark, str(p), fill=True)) == sorted([("1", "2", "3"), ("4", "", ""), ("5", "x,\ny", ""), ("", None, "")], key=repr)
    with pytest.raises(Exception):
        read(spark, str(p)).collect()
    p.write_text('a,b\n1,2\n3,4,5\n')
    with pytest.raises(Exception, match="more than 2 fields"):
        read(spark, str(p), fill=True).collect()


def xml_text(n, seed=1, tail="\n</log>\n"):
    rng = random.Random(seed)
    out = ["<?xml version=\"1.0\"?>\n<log>"]
    for i in range(n):
        out.append(rng.choice(["", "\n", "<day no=\"1\"/>", "<!-- a <txn> of old -->", "<txn/>"]))
        out.append(f'<txn no="{i}" note="a &gt; b > c"><cust>{"é" * rng.randrange(30)} &amp; Co</cust>\n<qty>{i}</qty></txn>')
    return "".join(out) + tail


FIELDS = ["_no", "_note", "cust", "qty"]


def test_xml_splits_equal_one_task(spark, tmp_path, small_splits):
    for k in range(2):
        (tmp_path / f"log{k}.xml").write_text(xml_text(200, k), encoding="utf-8")
    got = X.read_xml_split(spark, str(tmp_path), "txn", FIELDS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    want = X.read_xml_documents(spark, str(tmp_path), "txn", FIELDS)
    cols = [*FIELDS, "_file", "_pos"]
    assert rows(got, *cols) == rows(want, *cols)
    assert got.where("qty is not null").count() == 400 and got.count() > 400
    assert rows(X.read_xml_split(spark, str(tmp_path), "txn", FIELDS, file_regex="log1"), "qty") == rows(want.where(F.col("_file").endswith("log1.xml")), "qty")


def test_xml_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    p = tmp_path / "log.xml"
    p.write_text(xml_text(300), encoding="utf-8")
    tasks = spark.read.option("lineSep", "</txn>").text(str(p)).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 10


@pytest.mark.parametrize("text", [
    xml_text(40, tail=""),                                             # no closing tag of the root
    xml_text(40, tail="<txn><qty>1</qty>\n"),                          # cut off in a record
    xml_text(40, tail="<txn><qty>1</cust></txn></log>"),               # malformed record
    xml_text(40, tail="<txn><txn></txn></txn></log>"),                 # nested
    xml_text(40, tail="<!-- </txn> --></log>"),                        # closing tag in a comment
    xml_text(40, tail="<txn><qty><![CDATA[</txn>]]></qty></txn></log>"),
    xml_text(40, tail="</txn></log>"),                                 # closed twice
])
def test_xml_that_does_not_fit_fails(spark, tmp_path, text):
    p = tmp_path / "bad.xml"
    p.write_text(text, encoding="utf-8")
    with pytest.raises(Exception):
        X.read_xml_split(spark, str(p), "txn", FIELDS).collect()


def test_xml_without_records(spark, tmp_path):
    (tmp_path / "none.xml").write_text("<log><day/></log>")
    assert X.read_xml_split(spark, str(tmp_path), "txn", FIELDS).count() == 0


def test_csv_lines_travel_without_their_path_and_once(spark, tmp_path):
    """The path of a file, longer than its lines, goes with none of them, and
    what splits share is all that is gathered (seeded)."""
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    assert CSV._lines(spark, str(tmp_path), False).schema["file"].dataType.simpleString() == "bigint"
    r = random.Random(5)
    for _ in range(60):
        lines = [r.choice(["1,2", 'a,"b', 'c"', '"d"', '",x,"', ""]) for _ in range(r.randrange(1, 40))]
        if sum(x.count('"') for x in lines) % 2:
            lines.append('"')
        want, state = [], 0
        for x in lines:
            want = [*want[:-1], want[-1] + "\n" + x] if state else [*want, x]
            state = (state + x.count('"')) % 2
        batches, at, state, records = [], 0, 0, 0
        while at < len(lines):
            split, known = lines[at:at + r.randrange(1, 9)], (state, records)
            block = at
            while split:
                own, split = split[:(k := r.randrange(1, 5))], split[k:]
                odd = [x.count('"') % 2 for x in own]
                batches.append(pa.RecordBatch.from_arrays([pa.array([7] * len(own)), pa.array([block] * len(own)), pa.array(odd, pa.int8()), pa.array(own),
                                                           pa.array([known[0]] * len(own)), pa.array([known[1]] * len(own))],
                                                          ["file", "block", "odd", "line", "inside", "records"]))
                for x in odd:
                    records += state == 0
                    state = (state + x) % 2
                at += len(own)
        whole, shared = ([x for b in CSV._split_records(iter(batches), [w]) for x in b.to_pylist()] for w in (True, False))
        got = {x["no"]: x["line"] for x in whole}
        assert len(got) == len(whole)
        for x in sorted(shared, key=lambda x: x["block"]):
            assert x["no"] not in {y["no"] for y in whole}
            got[x["no"]] = got[x["no"]] + "\n" + x["line"] if x["no"] in got else x["line"]
        assert [got[i] for i in range(len(want))] == want and len(got) == len(want)
