"""Data-quality checks standing in for declared constraints (V1-V4).

The source declares PRIMARY KEY, UNIQUE, NOT NULL, FOREIGN KEY and CHECK
constraints and lets the database enforce them.  Spark enforces none, so
each becomes a distributed check that returns the violating rows (or
counts), never collecting data to the driver.

A load can be checked on the way: ``observed`` counts nulls and failed rules as
metrics of the very job that writes the table, and ``fk_orphans_of`` tests all
foreign keys of a table in one pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def fk_orphans(child: DataFrame, child_col: str, parent: DataFrame,
               parent_col: str) -> DataFrame:
    """V1: child rows whose non-null foreign key has no parent row."""
    p = parent.select(F.col(parent_col).alias("_fk_parent")).distinct()
    return (child.where(F.col(child_col).isNotNull())
            .join(p, F.col(child_col) == F.col("_fk_parent"), "left_anti"))


def fk_orphan_counts(child: DataFrame, parent: DataFrame,
                     pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """V1 summary: one row per (fk column) with the orphan count."""
    out = None
    for child_col, parent_col in pairs:
        n = (fk_orphans(child, child_col, parent, parent_col)
             .agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(child_col).alias("fk"), "orphans"))
        out = n if out is None else out.unionByName(n)
    return out


def pk_duplicates(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """V2: key values held by more than one row, with their row count."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V3: null count per NOT NULL column, in one pass (one row per column)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) AS (column, nulls)")


def check_violations(df: DataFrame, condition: Column) -> DataFrame:
    """V4: rows failing a CHECK; like SQL, a null result passes."""
    return df.where(~condition)


def fk_orphans_of(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """V1 for all foreign keys of a table: (fk, orphans), one row per key
    column, from one pass over ``child``.

    ``parents`` maps a key column to its parent table and column.  The values
    are counted by (key column, value) on the map side, so a value on a third
    of the rows is one row before anything moves; the distinct values of all
    key columns then meet the parents' keys in one join.
    """
    kind = "string"
    pairs = F.array(*[F.struct(F.lit(c).alias("fk"), F.col(c).cast(kind).alias("v")) for c in parents])
    values = child.select(F.inline(pairs)).groupBy("fk", "v").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for c, (parent, key) in parents.items():
        own = parent.select(F.lit(c).alias("fk"), F.col(key).cast(child.schema[c].dataType).cast(kind).alias("v"), F.lit(True).alias("known"))
        known = own if known is None else known.unionByName(own)
    met = values.join(known.where("v is not null").distinct(), ["fk", "v"], "left")
    lost = F.col("v").isNotNull() & F.col("known").isNull()
    counts = met.groupBy("fk").agg(F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("orphans"))
    # A row for every key, also of an empty table.
    names = child.sparkSession.createDataFrame([(c,) for c in parents], "fk string")
    return names.join(counts, "fk", "left").select("fk", F.coalesce("orphans", F.lit(0)).cast("long").alias("orphans"))


def observed(df: DataFrame, not_null: Sequence[str] = (), checks: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """V3 / V4 as metrics: ``df`` itself, and an observation that has, once
    an action has run over it, the number of ``rows``, of nulls by column
    (``null <column>``) and of rows that fail a rule (``check <name>``; a null
    result passes).  No pass over the data besides that action's."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in not_null]
    metrics += [F.count_if(~rule).alias(f"check {name}") for name, rule in (checks or {}).items()]
    seen = Observation()
    return df.observe(seen, *metrics), seen


def checked_write(df: DataFrame, path: str, not_null: Sequence[str] = (), checks: Mapping[str, Column] | None = None,
                  mode: str = "errorifexists") -> dict[str, int]:
    """Write a table and return what ``observed`` counted in it."""
    rows, seen = observed(df, not_null, checks)
    rows.write.mode(mode).parquet(path)
    return seen.get
