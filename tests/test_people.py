"""Person-record cleaning, lineage, segments on the FIXTURES.md §4 sample,
read through the HTML table source."""
import pytest
from pyspark.sql import functions as F

from martforge.operators import keys as K
from martforge.operators import people as P
from martforge.sources import html as H

ROWS = [
    ("Aldo the Old[3] 26 May 901 – 17 July 924", "c. 870[a]", "17 July 924", "Son of Osric"),
    ("Bera Bera 17 July 924 – 939", "894", "939", "Great-grandson of Aldo"),
]
ROWS_NO_CLAIM = [
    ("(1st reign) Harold 4 March 940 – 950", "900", "970"),
    ("(2nd reign) Harold 1 May 955 – 965", "900", "970"),
]


def _html():
    def table(header, rows, cls="wikitable"):
        th = "".join(f"<th>{h}</th>" for h in header)
        trs = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
        return f'<table class="{cls}"><tr>{th}</tr>{trs}</table>'
    return ("<html><body>" + table(["Name", "Birth", "Death", "Claim"], ROWS)
            + table(["Other"], [("x",)], cls="navbox")
            + table(["Name", "Birth", "Death"], ROWS_NO_CLAIM) + "</body></html>")


@pytest.fixture()
def raw(spark):
    docs = spark.createDataFrame([(1, _html())], "doc_id int, html string")
    t = H.html_tables(docs, "html", "wikitable", keep=["doc_id"])
    cols = t.select("doc_id", "table_no", "row_no", H.table_column("Name"),
                    H.table_column("Birth"), H.table_column("Death"), H.table_column("Claim"))
    out = K.dense_ids(cols, ["doc_id", "table_no", "row_no"], "row_index", offset=-1,
                      tie_breaker="row_no")
    return out.select("row_index", "Name", "Birth", "Death", "Claim")


@pytest.fixture()
def people(raw):
    return P.monarch_clean(raw)


def test_html_tables_and_missing_claim(raw):
    got = sorted((r.row_index, r.Claim) for r in raw.collect())
    assert got == [(0, "Son of Osric"), (1, "Great-grandson of Aldo"), (2, None), (3, None)]


def test_html_spans():
    html = ('<table class="wikitable"><tr><th>A</th><th>B</th></tr>'
            '<tr><td rowspan="2">x</td><td>1</td></tr><tr><td>2</td></tr>'
            '<tr><td colspan="2">y</td></tr></table>')
    (header, body), = H.parse_tables(html, "wikitable")
    assert header == ["A", "B"]
    assert body == [["x", "1"], ["x", "2"], ["y", "y"]]


def test_cleaned(people):
    got = {r.idx: r for r in people.collect()}
    assert [(got[i].start, got[i].end) for i in range(4)] == [(901, 924), (924, 939),
                                                              (940, 950), (955, 965)]
    assert got[0].Name == "Aldo the Old" and got[1].Name == "Bera"
    assert got[0].Birth == 870 and got[0].Death == 924
    assert got[1].ClaimRelation == "Great-grandson" and got[1].Claim == "Aldo"


def test_lineage_and_second_reign(people):
    assert [tuple(r) for r in P.lineage(people).collect()] == [(1, 0)]
    assert [tuple(r) for r in P.second_reign(people).collect()] == [(2, 3)]


def test_segments(people):
    segs = {(r.idx, r.seg_no): (r.kind, r.length) for r in P.reign_segments(people).collect()}
    assert [segs[(2, i)] for i in range(5)] == [("before", 40), ("reign", 10), ("between", 5),
                                                ("reign", 10), ("after", 5)]
    assert not any(k[0] == 3 for k in segs)              # second reign drawn with the first
    assert (1, 4) not in segs                            # zero-width "after" dropped


def test_timeline(people):
    span = people.transform(P.year_span).first()
    assert (span.min_birth, span.max_death, span.date_range) == (870, 970, 120)
    grid = sorted((r.year, r.kind, r.x) for r in P.year_grid(people).collect())
    assert grid[0] == (800, "century", -70)
    assert max(g[0] for g in grid) == 975                # centuries 8..9 (round(1.2) = 1)
    lay = {r.idx: (r.x, r.lane) for r in P.timeline_layout(people).collect()}
    assert lay[0] == (10, 600) and lay[1] == (34, 590)


def test_lineage_exact_for_short_and_inner_matches(spark):
    df = spark.createDataFrame(
        [(0, "Alfred the Great", None), (1, "Edgar", "ed"), (2, "Bo", "o"),
         (3, "Ed", "fred the"), (4, "X", "zzz")], "idx long, Name string, Claim string")
    got = sorted(tuple(r) for r in P.lineage(df).collect())
    assert got == [(1, 0), (2, 2), (3, 0)]   # "o" only in "Bo" itself (self allowed)


def test_reject_and_overrides(spark, raw):
    kept = P.reject_rows(raw, [1])
    assert sorted(r.row_index for r in kept.collect()) == [0, 1, 2]
    ov = P.overrides_frame(spark, [(0, "Name", "Alfred the Great"), (1, "Claim", None)])
    out = {r.row_index: r for r in P.point_overrides(raw, ov).collect()}
    assert out[0].Name == "Alfred the Great" and out[1].Claim is None
    assert out[2].Name.startswith("(1st reign)")


def test_lineage_earlier_only(spark):
    df = spark.createDataFrame(
        [(0, "Ann Lee", "bo"), (1, "Bo Kim", "ann lee"), (2, "Cy Bo", "bo")],
        "idx long, Name string, Claim string")
    assert sorted(tuple(r) for r in P.lineage(df).collect()) == [(0, 1), (1, 0), (2, 1)]
    assert sorted(tuple(r) for r in P.lineage(df, earlier_only=True).collect()) == [(1, 0), (2, 1)]
