"""Table sink: declared schema, key policy, overwrite / append, row count."""
from pyspark.sql import types as T

from martforge.sources import sinks as SK

SCHEMA = T.StructType([T.StructField("pid", T.IntegerType()),
                       T.StructField("pname", T.StringType()),
                       T.StructField("total", T.IntegerType()),
                       T.StructField("note", T.StringType())])


def test_materialize_casts_and_policies(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "c", 3_000_000_000)],
                               "pid long, pname string, total long")
    path = str(tmp_path / "t")
    out = SK.materialize(df, "t", schema=SCHEMA, key="pid", key_policy="keep_first",
                         order_cols=["pname"], path=path, lenient=True)
    got = sorted(tuple(r) for r in out.collect())
    # keep_first by pname; a value that does not fit INT becomes null when lenient; the
    # declared column missing from the query is a typed null.
    assert got == [(1, "a", 5, None), (2, "c", None, None)]
    assert out.schema == SCHEMA
    again = SK.materialize(df, "t", schema=SCHEMA, path=path, lenient=True)            # overwrite
    assert again.count() == 3
    more = SK.materialize(df, "t", schema=SCHEMA, mode="append", path=path, lenient=True)
    assert more.count() == 6
    assert SK.row_count(more).first()["count"] == 6
    listing = [tuple(r) for r in SK.describe(more).collect()]
    assert listing[0] == (0, "pid", "int", True)
