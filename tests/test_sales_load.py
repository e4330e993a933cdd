"""Sales normalisation on the FIXTURES.md §1 sample written as XML files."""
import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martforge.operators import marts as M
from martforge.plans import sales_load as SL
from martforge.sources import xml as X

TXN1 = [("1/5/2020", "Acme", "Alpha", "3", "100", "US", "1"),
        ("03/31/2020", "Bolt's", "Beta", "4", "90", "DE", "2"),
        ("4/1/2020", "Acme", "Beta", "5", "80", "US", "2")]
TXN2 = [("12/31/2020", "Acme", "Alpha", "2", "70.9", "FR", "1"),
        ("2/30/2021", "Core", "Gamma", "1", "60", "UK", "1"),
        ("1/1/2021", "Core", "Alpha", "x", "50", "UK", "9")]
REPS = [("r1", "Ann", "Lee", "East"), ("r2", "Bo", "Kim", "West"), ("r3", "Cy", "Ode", "East")]


def _doc(rows):
    body = "".join(
        "<txn>" + "".join(f"<{f}>{v.replace('&', '&amp;')}</{f}>"
                          for f, v in zip(SL.TXN_FIELDS, r)) + "</txn>" for r in rows)
    return f'<?xml version="1.0"?>\n<sales>{body}</sales>'


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "pharmaSale1.xml").write_text(_doc(TXN1))
    (tmp_path / "pharmaSale2.xml").write_text(_doc(TXN2))
    (tmp_path / "otherSales.xml").write_text(_doc(TXN1))          # must be skipped
    reps = "".join(f'<rep rID="{a}"><firstName>{b}</firstName><lastName>{c}</lastName>'
                   f"<territory>{d}</territory></rep>" for a, b, c, d in REPS)
    (tmp_path / "pharmaReps.xml").write_text(f"<reps>{reps}</reps>")
    return str(tmp_path)


def _load(spark, folder, policy):
    txn = X.read_xml_documents(spark, folder, "txn", SL.TXN_FIELDS,
                               file_regex=r"pharmaSale.*\.xml")
    reps = X.read_xml_records(spark, os.path.join(folder, "pharmaReps.xml"), "rep",
                              ["_rID", "firstName", "lastName", "territory"])
    reps = reps.withColumnRenamed("_rID", "rID")
    return SL.SalesLoad(txn, reps, ["_file", "_pos"], policy)


def test_file_pattern_and_order(spark, folder):
    txn = X.read_xml_documents(spark, folder, "txn", SL.TXN_FIELDS,
                               file_regex=r"pharmaSale.*\.xml")
    got = [(os.path.basename(r._file), r._pos, r.cust) for r in
           txn.orderBy("_file", "_pos").collect()]
    assert [g[2] for g in got] == ["Acme", "Bolt's", "Acme", "Acme", "Core", "Core"]
    assert {g[0] for g in got} == {"pharmaSale1.xml", "pharmaSale2.xml"}


def test_dimensions(spark, folder):
    s = _load(spark, folder, "null")
    assert sorted(tuple(r) for r in s.products.collect()) == [(1, "Alpha"), (2, "Beta"), (3, "Gamma")]
    assert sorted(tuple(r) for r in s.customers.collect()) == [
        (101, "Acme", "US"), (102, "Bolt's", "DE"), (103, "Core", "UK")]
    assert sorted(tuple(r) for r in s.reps.collect()) == [
        (1, "Ann", "Lee", "East"), (2, "Bo", "Kim", "West"), (3, "Cy", "Ode", "East")]


def test_fact_rows(spark, folder):
    s = _load(spark, folder, "null")
    got = sorted(tuple(r) for r in s.salestxn.collect())
    assert got == [
        (1, dt.date(2020, 1, 5), 3, 100, 1, 1, 101),
        (2, dt.date(2020, 3, 31), 4, 90, 2, 2, 102),
        (3, dt.date(2020, 4, 1), 5, 80, 2, 2, 101),
        (4, dt.date(2020, 12, 31), 2, 70, 1, 1, 101),
        (5, None, 1, 60, 1, 3, 103),           # 2/30 is no date
        (6, dt.date(2021, 1, 1), None, 50, None, 1, 103),   # bad qty, orphan rep
    ]
    pairs = sorted(tuple(r) for r in s.cust_reps.where(F.col("rid").isNotNull()).collect())
    assert pairs == [(101, 1), (101, 2), (102, 2), (103, 1)]


def test_orphan_policy_error_aborts(spark, folder):
    s = _load(spark, folder, "error")
    with pytest.raises(PySparkException) as e:
        s.salestxn.collect()
    assert "OrphanKeyError" in str(e.value)


def test_orphan_policy_drop(spark, folder):
    s = _load(spark, folder, "drop")
    assert sorted(r.tid for r in s.salestxn.collect()) == [1, 2, 3, 4, 5]


def test_marts_on_loaded_tables(spark, folder):
    s = _load(spark, folder, "drop")
    facts = M.prod_facts(s.salestxn, s.products, s.reps)
    three = M.prod_facts(s.salestxn, s.products, s.reps, shared_base=True)
    assert sorted(map(tuple, facts.collect()), key=repr) == sorted(map(tuple, three.collect()), key=repr)
    totals = {r.pname: r.total_sold for r in M.prod_total(s.salestxn, s.products).collect()}
    assert totals == {"Alpha": 5, "Beta": 9, "Gamma": 1}
    # Fan-out: rows per product = quarters x regions.
    n = {r.pname: r["count"] for r in facts.groupBy("pname").count().collect()}
    assert n == {"Alpha": 2 * 1, "Beta": 2 * 1, "Gamma": 1}
    month = sorted(tuple(r) for r in M.prod_month(s.salestxn, s.products).collect())
    assert (3, "Gamma", None, 1) in month
