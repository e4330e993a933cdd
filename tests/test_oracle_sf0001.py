"""Every registered query against its DuckDB SQL at sf0.001 (row count,
column names and types, order-insensitive values)."""
import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, open_duckdb

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(SF)


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, key):
    status, msg, _ = compare(spark, duck, key, SF)
    assert status in ("OK", "ROWS"), msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["pid", "pname", "total_sold", "year", "quarter", "region",
                          "total_sold_per_region"]
