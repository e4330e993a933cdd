"""Plan checks: pruning and pushdown reach the scan; no nested-loop joins;
dimension broadcasts only for fixed-size tables or behind AQE's size check."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prod_facts_prunes_columns(spark):
    p = plan(E.queries()["prod_facts"](spark, SF))
    for line in p.splitlines():
        if "lineitem.parquet" in line and "ReadSchema" in line:
            schema = line.split("ReadSchema: ")[1]
            assert "l_comment" not in schema and "l_tax" not in schema
            assert schema.count(":") <= 4


def test_no_nested_loop_or_cartesian(spark):
    for key in ["prod_facts", "rep_facts", "lineage", "above_avg_airlines", "strikes_by_state",
                "second_reign", "year_grid"]:
        p = plan(E.queries()[key](spark, SF))
        assert "BroadcastNestedLoopJoin" not in p, key
        assert "CartesianProduct" not in p, key


def test_top_k_is_take_ordered(spark):
    p = plan(E.queries()["strikes_by_state"](spark, SF))
    assert "TakeOrderedAndProject" in p
