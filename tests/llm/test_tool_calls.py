import json

import duckdb
import pytest
from pyspark.sql import functions as F

from martforge.llm import tool_calls as T
from martforge.llm.oracle import SQL
from martforge.llm.queries import QUERIES

CALLS = "conv_id long, turn long, call_index int, call_id string, name string, arguments string, after array<string>, status string"
RESULTS = "conv_id long, turn long, call_id string, content string, name string"


def link(spark, calls, results):
    df = T.link_tool_calls(spark.createDataFrame([(*c, "x") for c in calls], CALLS), spark.createDataFrame([(*r, "x") for r in results], RESULTS), T.SCHEMAS)
    return {(r.conv_id, r.turn, r.call_index, r.status): r for r in df.collect()}, df


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    df = QUERIES["op2_tool_calls"](spark, d)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{d}/conversations.parquet'")
    res = con.sql(SQL["op2_tool_calls"])
    assert res.columns == df.columns
    want = sorted(res.fetchall(), key=repr)
    assert got == want
    if sf == "sf0.01":
        assert {r[5] for r in got} >= {"ok", "invalid", "cycle", "no_result"} and len({r[9] for r in got}) > 2
    for r in got:
        if r[7]:
            assert r[7] == json.dumps(json.loads(r[7]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        if r[10]:
            json.loads(r[10])


def test_plan_has_no_python(spark):
    plan = QUERIES["op2_tool_calls"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_faults(spark):
    args = {0: '{"query":"a","limit":1.0}', 1: '{"query":"a","limit":1.5}', 2: '{"query":null}', 3: "[1]", 4: "null", 5: None, 6: "", 7: '{"query":"a","query":"b"}',
            8: ' {"limit" : 3 , "query":"\\u00e9\\n\\"" , "filters":{"b":{"d":1,"c":[]},"a":1}} ', 9: "{}", 10: '{"query":"' + "x" * 100_000 + '"}'}
    got, _ = link(spark, [(1, t, 0, f"c{t}", "search", a, None) for t, a in args.items()] + [(1, 50, 0, "c50", None, "{}", [None])], [])
    err = {k[1]: r.errors for k, r in got.items()}
    assert err == {0: "", 1: "type:limit", 2: "type:query", 3: "object", 4: "object", 5: "json", 6: "json", 7: "json", 8: "", 9: "missing:query", 10: "", 50: "tool"}
    canon = {k[1]: r.arguments for k, r in got.items()}
    assert canon[8] == '{"filters":{"a":1,"b":{"c":[],"d":1}},"limit":3,"query":"é\\n\\""}' and canon[3] is None and canon[9] == "{}"


def test_links_order_and_duplicates(spark):
    ok = '{"query":"a"}'
    calls = [(1, 0, 0, "a", "search", ok, ["c"]), (1, 0, 1, "b", "search", ok, ["a", "zz"]), (1, 1, 0, "c", "search", ok, []), (1, 1, 1, "d", "search", ok, ["b"]),
             (2, 0, 0, "a", "search", ok, []), (2, 1, 0, "b", "search", ok, ["a"]), (2, 2, 0, "a", "search", ok, []), (2, 2, 0, "a", "search", ok, []),
             (3, 0, 0, "a", "search", ok, ["b"]), (3, 1, 0, "b", "search", ok, ["a"]), (3, 2, 0, "c", "search", ok, ["b"]), (3, 3, 0, "d", "search", ok, []),
             (4, 0, 0, "s", "search", ok, ["s"]), (None, 0, 0, "a", "search", ok, []), (5, 0, 0, None, "search", ok, [])]
    results = [(1, 2, "a", "r\n1"), (1, 3, "a", "r2"), (2, 5, "b", None), (2, 5, "b", None), (2, 6, "q", "lost"), (None, 1, "a", "z"), (3, 9, "d", "")]
    got, df = link(spark, calls, results)
    assert {(k[0], k[1], k[2]): (k[3], r.wave, r.result_turn) for k, r in got.items()} == {
        (1, 0, 0): ("ok", 2, 2), (1, 0, 1): ("invalid", 3, None), (1, 1, 0): ("no_result", 1, None), (1, 1, 1): ("no_result", 4, None),
        (2, 0, 0): ("no_result", 0, None), (2, 1, 0): ("ok", 0, 5), (2, 2, 0): ("duplicate", None, None), (2, 6, None): ("orphan", None, 6),
        (3, 0, 0): ("cycle", None, None), (3, 1, 0): ("cycle", None, None), (3, 2, 0): ("cycle", None, None), (3, 3, 0): ("ok", 1, 9),
        (4, 0, 0): ("cycle", None, None), (None, 0, 0): ("no_id", None, None), (5, 0, 0): ("no_id", None, None), (None, 1, None): ("orphan", None, 1)}
    assert got[1, 0, 1, "invalid"].errors == "after:zz"
    assert got[1, 0, 0, "ok"].message == '{"arguments":{"query":"a"},"id":"a","name":"search","result":"r\\n1"}'
    assert df.count() == 16


def test_empty(spark):
    got, _ = link(spark, [], [])
    assert got == {}
    calls, results = T.calls_of(spark.createDataFrame([(1, None, None, None), (None, 1, "user", ""), (2, 0, "user", None)],
                                                      "conv_id long, turn long, role string, text string"))
    assert T.link_tool_calls(calls, results, T.SCHEMAS).count() == 1
