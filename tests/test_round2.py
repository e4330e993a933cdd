"""Large keys and sums, orphan policies, input loss, restarts, hot grams, html grids."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import session as S
from martforge import views as V
from martforge.functions import clean as C
from martforge.operators import keys as K
from martforge.operators import people as P
from martforge.operators import quality as Q
from martforge.plans import sales_load as SL
from martforge.plans import strikes_load as STL
from martforge.sources import csv as CSV
from martforge.sources import html as H
from martforge.sources import sinks as SK
from martforge.sources import xml as X
from tests_support import rows


# ------------------------------------------------------------------- caps

def test_codes_of_long_keys_differ(spark):
    keys = [1, 123456, 1234567, 1234569, 12345670]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(V._code(F.col("k"))).collect()]
    assert len(set(got)) == len(keys) and got[0] == "Aaaaae"


def test_large_sums_stay_and_misfits_fail(spark, tmp_out):
    df = spark.createDataFrame([(1, 3_000_000_000)], "pid long, total long")
    big = T.StructType([T.StructField("pid", T.LongType()), T.StructField("total", T.LongType())])
    small = T.StructType([T.StructField("pid", T.LongType()), T.StructField("total", T.IntegerType())])
    assert rows(SK.materialize(df, "big", big, path=f"{tmp_out}/a")) == [(1, 3_000_000_000)]
    with pytest.raises(Exception, match="does not fit"):
        SK.materialize(df, "small", small, path=f"{tmp_out}/b")
    assert rows(SK.materialize(df, "small", small, path=f"{tmp_out}/c", lenient=True)) == [(1, None)]


def test_rep_ids_above_32_bits(spark):
    df = spark.createDataFrame([("r5000000000",), ("r7",), ("x",)], "r string")
    assert [r[0] for r in df.select(C.rep_id_parse("r")).collect()] == [5_000_000_000, 7, None]


def test_lanes_are_64_bit(spark):
    people = spark.createDataFrame([(0, "A", 900, 950, 920, 940, None), (400_000_000, "B", 900, 950, 920, 940, None)],
                                   "idx long, Name string, Birth int, Death int, start int, end int, Claim string")
    assert rows(P.timeline_layout(people)) == [(0, 10, 600), (400_000_000, 10, 600 - 4_000_000_000)]


# ---------------------------------------------------------------- policies

TXN = "n long, date string, cust string, prod string, qty string, amount string, country string, repID string"


def _load(spark, records, policy):
    reps = spark.createDataFrame([("r1", "a", "b", "x"), ("r5000000000", "c", "d", "y")], "rID string, firstName string, lastName string, territory string")
    return SL.SalesLoad(spark.createDataFrame(records, TXN), reps, ["n"], policy)


GOOD = [(0, "1/2/2020", "Acme", "P", "1", "2", "US", "1"), (1, "1/2/2020", "Bolt", "P", "1", "2", "US", "5000000000")]


@pytest.mark.parametrize("bad", [(2, "1/2/2020", "Acme", "P", "1", "2", "US", "abc"), (2, "1/2/2020", "Acme", "P", "1", "2", "US", None),
                                 (2, "1/2/2020", None, "P", "1", "2", "US", "1"), (2, "1/2/2020", "Acme", None, "1", "2", "US", "1")])
def test_error_policy_stops_the_load(spark, bad):
    assert _load(spark, GOOD, "error").salestxn.count() == 2
    with pytest.raises(Exception, match="OrphanKeyError"):
        _load(spark, [*GOOD, bad], "error").salestxn.collect()
    assert _load(spark, [*GOOD, bad], "drop").salestxn.count() == 2
    assert _load(spark, [*GOOD, bad], "null").salestxn.count() == 3


def test_append_policy_looks_at_the_table(spark, tmp_out):
    a = spark.createDataFrame([(1, "old"), (None, "old")], "k long, v string")
    b = spark.createDataFrame([(1, "new"), (2, "new"), (None, "new")], "k long, v string")
    for part in (a, b):
        t = SK.materialize(part, "t", mode="append", key="k", key_policy="keep_first", order_cols=["v"], path=f"{tmp_out}/t")
    assert rows(t) == [(1, "old"), (2, "new"), (None, "old")]
    with pytest.raises(ValueError):
        SK.materialize(b, "t", mode="append", key="k", key_policy="error", path=f"{tmp_out}/t")


def test_missing_orders_keep_their_sales(spark, tmp_out):
    src = "/root/testdata/sf0.001"
    for t in ("lineitem", "orders", "customer", "part", "nation", "region", "supplier"):
        df = spark.read.parquet(f"{src}/{t}.parquet")
        (df.where("o_orderkey % 2 = 0") if t == "orders" else df).write.parquet(f"{tmp_out}/{t}.parquet")
    n = spark.read.parquet(f"{src}/lineitem.parquet").count()
    sales = V.sales(spark, tmp_out, with_customer=True)
    assert sales.count() == n and V.raw_txn(spark, tmp_out).count() == n
    found = {r["column"]: r["nulls"] for r in Q.not_null_violations(sales, ["cidFK", "ridFK"]).collect()}
    assert found["cidFK"] > 0 and found["ridFK"] == 0


# -------------------------------------------------------------- input loss

def test_csv_quotes_and_line_ends(spark, tmp_out):
    text = 'a,b\n"He said ""hi"", ok",x\n"two\nlines",NA\n,""\n'
    with open(f"{tmp_out}/t.csv", "w") as f:
        f.write(text)
    assert rows(CSV.read_csv_text(spark, f"{tmp_out}/t.csv")) == sorted([('He said "hi", ok', "x"), ("two\nlines", None), ("", "")], key=repr)
    df = spark.createDataFrame([('"q", x', "l1\nl2"), (None, "")], "a string, b string")
    CSV.write_csv_text(df, f"{tmp_out}/w")
    assert rows(CSV.read_csv_text(spark, f"{tmp_out}/w")) == rows(df)


def _xml(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_xml_any_depth_order_and_names(spark, tmp_path):
    _xml(tmp_path / "in", "pharmaSale2.xml", "<r><w><txn><prod>c</prod></txn></w><txn><prod>d</prod></txn></r>")
    _xml(tmp_path / "in", "pharmaSale1.xml", '<?xml version="1.0"?><r>' + "".join(f"<txn><prod>{i}</prod></txn>" for i in range(50)) + "</r>")
    _xml(tmp_path / "in" / "pharmaSale_old", "reps.xml", "<r><txn><prod>no</prod></txn></r>")
    got = X.read_xml_documents(spark, str(tmp_path / "in"), "txn", ["prod"], file_regex=r"pharmaSale.*\.xml")
    own = sorted((r._file.rsplit("/", 1)[1], r._pos, r.prod) for r in got.collect())
    assert own == [("pharmaSale1.xml", i, str(i)) for i in range(50)] + [("pharmaSale2.xml", 0, "c"), ("pharmaSale2.xml", 1, "d")]
    ids = K.ids_from_positions(got, "_file", "_pos")
    assert [r.prod for r in ids.orderBy("id").collect()] == [*map(str, range(50)), "c", "d"]


@pytest.mark.parametrize("text", ["<r><txn><prod>a</prod></txn><txn><prod>b</pr", "<r><txn><prod>a</wrong></txn></r>"])
def test_malformed_xml_fails(spark, tmp_path, text):
    _xml(tmp_path, "a.xml", text)
    for reader in (X.read_xml_records, X.read_xml_documents):
        with pytest.raises(Exception):
            reader(spark, str(tmp_path), "txn", ["prod"]).collect()


# ------------------------------------------------------------------ session

class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}

    def setCheckpointDir(self, path):
        self.path = path


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            S.ensure_checkpoint_dir(_Session(master))
    for master in ("local", "local[4]", "local[*]"):
        S.ensure_checkpoint_dir(_Session(master))


# --------------------------------------------------------------- dimensions

def test_dimensions_number_and_write_no_records(spark):
    d = "/root/testdata/sf0.001"
    load = SL.SalesLoad(V.raw_txn(spark, d), V.raw_rep_records(spark, d), V.LINEITEM_ORDER)
    alone = [rows(load.products), rows(load.customers), rows(load.cust_reps)]
    assert "staged" not in load._cache
    full = SL.SalesLoad(V.raw_txn(spark, d), V.raw_rep_records(spark, d), V.LINEITEM_ORDER)
    full.salestxn.count()
    assert "staged" in full._cache
    assert alone == [rows(full.products), rows(full.customers), rows(full.cust_reps)]
    strikes = STL.StrikesLoad(V.raw_strikes(spark, d), V.LINEITEM_ORDER)
    alone = [rows(strikes.airports), rows(strikes.conditions), rows(strikes.flights)]
    assert "staged" not in strikes._cache
    whole = STL.StrikesLoad(V.raw_strikes(spark, d), V.LINEITEM_ORDER)
    whole.strikes.count()
    assert alone == [rows(whole.airports), rows(whole.conditions), rows(whole.flights)]


def test_dimension_views_follow_their_inputs(spark, tmp_out):
    for t in ("supplier", "nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_out}/{t}.parquet")
    n = V.reps(spark, tmp_out).count()
    more = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").limit(1).withColumn("s_suppkey", F.lit(10 ** 7).cast(spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").schema["s_suppkey"].dataType))
    more.select(spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").columns).write.mode("append").parquet(f"{tmp_out}/supplier.parquet")
    assert V.reps(spark, tmp_out).count() == n + 1


# -------------------------------------------------------------- hot lineage

PEOPLE = "idx long, Name string, Claim string"


def test_hot_claims_and_grams(spark):
    people = [(i, f"Sovereign of the Realm number {i}", "sovereign of the realm number 9999") for i in range(10_000)]
    start = time.time()
    got = P.lineage(spark.createDataFrame(people, PEOPLE))
    assert got.count() == 10_000 and {r.parent_idx for r in got.select("parent_idx").distinct().collect()} == {9999}
    assert time.time() - start < 90


def test_lineage_against_a_full_scan(spark):
    import random
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
    people = [(i, " ".join(word() for _ in range(3)) if i % 11 else None, rng.choice([None, "", word(), word() + " " + word()])) for i in range(300)]
    for earlier in (False, True):
        want = []
        for c, _, claim in people:
            found = [i for i, n, _ in people if claim and n and claim.lower() in n.lower() and (i < c or not earlier)]
            if found:
                want.append((c, min(found)))
        got = P.lineage(spark.createDataFrame(people, PEOPLE), earlier_only=earlier)
        assert sorted(tuple(r) for r in got.collect()) == want


# ----------------------------------------------------------- drawing tables

def test_second_reigns_get_no_lane_and_no_edge(spark):
    people = spark.createDataFrame([
        (0, "(1st reign) Otto", 900, None, 920, 930, None), (1, "(2nd reign) Otto", 900, None, 935, 940, "otto"),
        (2, "Child", 930, 960, 941, 950, "otto")],
        "idx long, Name string, Birth int, Death int, start int, end int, Claim string")
    assert rows(P.second_reign(people)) == [(0, 1)]
    pairs = P.second_reign(people)
    assert [r[0] for r in rows(P.timeline_layout(people, pairs=pairs))] == [0, 2]


def test_grid_starts_with_the_first_birth(spark):
    people = spark.createDataFrame([(0, 1953, 2040), (1, 1960, None)], "idx long, Birth int, Death int")
    years = [r.year for r in P.year_grid(people).orderBy("year").collect()]
    assert years[0] == 1900 and 1950 in years and years[-1] == 2075
    assert P.year_grid(people.where("idx = 9")).collect() == []


# ---------------------------------------------------------------------- html

@pytest.mark.parametrize("html, want", [
    ("<table><tr><td rowspan=2>a<td>b<td rowspan=2>c<tr><td>d</table>", [["a", "b", "c"], ["a", "d", "c"]]),
    ("<table><tr><td>a<td>b<td rowspan=3>c<tr><td>d<tr><td>e<td>f</table>", [["a", "b", "c"], ["d", "c"], ["e", "f", "c"]]),
    ("<table><tr><td rowspan=3>a<td>b</table>", [["a", "b"], ["a"], ["a"]]),
    ("<table><tr><td>a<td>b", [["a", "b"]]),
    ("<table><tr><td>0<span style='color:red; DISPLAY : none'>x<b>y</b></span>871</td></tr><tr style='display:none'><td>no</td></tr><tr><td>z</td></tr></table>",
     [["0871"], ["z"]]),
    ("<table><tr><td>a<td colspan=99999999>b</table>", [["a"] + ["b"] * 1000]),
])
def test_html_grids(html, want):
    (header, body), = H.parse_tables(html, None)
    assert header is None and body == want


def test_all_header_rows_count():
    (header, body), = H.parse_tables("<table><tr><th rowspan=2>Name<th colspan=2>Reign<tr><th>from<th>to<tr><td>A<td>1<td>2</table>", None)
    assert header == ["Name", "Reign from", "Reign to"] and body == [["A", "1", "2"]]


# ----------------------------------------------------------------- corrections

def test_overrides_of_many_cells(spark):
    df = spark.createDataFrame([(0, "a", "b", 1), (1, "c", "d", 2), (2, None, None, 3)], "row_index long, Name string, Claim string, n int")
    fixes = P.overrides_frame(spark, [(0, "Name", "x"), (0, "Claim", None), (2, "Claim", "y"), (7, "Name", "z"), (1, "nowhere", "q")])
    assert rows(P.point_overrides(df, fixes)) == [(0, "x", None, 1), (1, "c", "d", 2), (2, None, "y", 3)]
