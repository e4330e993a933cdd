"""Table sinks.

``materialize`` is the create-or-replace / append of a query result into a
named table cast to its declared schema (the source's fill-a-mart helper),
with a policy for several rows per declared key.  Tables are Parquet folders
under the shared checkpoint folder (``spark.checkpoint.dir``) unless a path
is given; writing and reading back also cuts the lineage of a long plan.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.keys import apply_key_policy
from martforge.session import ensure_checkpoint_dir


def table_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "martforge-tables", name)


def cast_to_schema(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Select the declared columns in order, cast to their declared types.

    A declared column missing from the query becomes a typed null.  A value
    that does not fit the declared type makes the job fail, whatever the
    session's ANSI setting; with ``lenient`` it becomes null.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            fitted = F.col(f.name).try_cast(f.dataType)
            if not lenient:
                misfit = F.col(f.name).isNotNull() & fitted.isNull()
                fitted = F.when(misfit, F.raise_error(F.concat(
                    F.lit(f"value of {f.name} does not fit {f.dataType.simpleString()}: "),
                    F.col(f.name).cast("string"))).cast(f.dataType)).otherwise(fitted)
            cols.append(fitted.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at ``path`` (any file system Spark knows)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    both = F.lit(True)
    for k in keys:
        both = both & left[k].eqNullSafe(right[k])
    return both


def stored_keys_met(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``rows`` that ``table`` holds.  The table is the
    streamed side: its key columns are scanned, and moved only if the keys of
    ``rows`` are too many to broadcast."""
    asked = rows.select(*keys).distinct()
    have = table.select(*keys)
    return have.join(asked, _same_keys(have, asked, keys), "left_semi").distinct()


def materialize(df: DataFrame, name: str, schema: T.StructType | None = None,
                mode: str = "overwrite", key: str | Sequence[str] | None = None,
                key_policy: str = "keep_all", order_cols: Sequence | None = None,
                path: str | None = None, lenient: bool = False) -> DataFrame:
    """Write ``df`` as table ``name`` and return the table.

    ``mode`` is ``overwrite`` (drop and recreate: rerunnable, S13) or
    ``append``.  ``key_policy`` applies to ``key`` (see keys.apply_key_policy);
    when appending it also covers the rows already in the table: with
    ``keep_first`` a key that the table holds is not added again, with
    ``error`` it makes the job fail (null keys match null keys).  The stored
    keys are scanned once against the new ones, which are the side that may be
    broadcast; only keys found in both go on.
    """
    spark = df.sparkSession
    out = cast_to_schema(df, schema, lenient) if schema is not None else df
    target = path or table_path(spark, name)
    if key is not None:
        out = apply_key_policy(out, key, key_policy, order_cols)
        if mode == "append" and key_policy != "keep_all" and table_exists(spark, target):
            keys = [key] if isinstance(key, str) else list(key)
            met = stored_keys_met(spark.read.parquet(target), out, keys)
            if key_policy == "error" and not met.isEmpty():
                raise ValueError(f"key {keys} already in {name}")
            out = out.join(met, _same_keys(out, met, keys), "left_anti")
    out.write.mode(mode).parquet(target)
    return spark.read.parquet(target)


def describe(df: DataFrame) -> DataFrame:
    """Schema listing (cid, name, type, nullable) as a DataFrame."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "cid int, name string, type string, nullable boolean")


def row_count(df: DataFrame) -> DataFrame:
    """Global ``count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("count"))
