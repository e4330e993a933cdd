"""Range partitioning by bounds that are known beforehand.

Spark's own range partitioner samples the rows it is about to move, which runs
their plan a second time.  Here the bounds come from approximate percentiles
of the key columns alone (any frame with about their distribution will do, for
bounds only decide how evenly the ranges are filled), and a row finds its range
by a binary search in a constant array.

Keys are compared column by column, ascending, nulls first.  A value of the
first column that fills several ranges by itself is split by the second one,
and so on, so one very common value doesn't land in one task.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANKED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def rankable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The leading ones of ``cols`` that have percentiles (numbers, dates, times)."""
    out = []
    for c in cols:
        if not isinstance(df.schema[c].dataType, _RANKED):
            break
        out.append(c)
    return out


def range_bounds(df: DataFrame, cols: Sequence[str], parts: int) -> list[tuple]:
    """At most ``parts`` - 1 lower bounds of ranges of about equal size, as
    tuples of leading key values, ascending; a null is a bound's None.

    One aggregate for the first column; another for each further column that
    is needed to split values (or the null) that fill a range by themselves.
    The driver holds at most ``parts`` values a column.
    """
    accuracy = max(1000, 20 * parts)

    def quantiles(frame: DataFrame, by: list[str], col: str, n: int) -> dict[tuple, tuple[list, float]]:
        """group -> (values at i/n, share of nulls)."""
        at = F.array(*[F.lit(i / n) for i in range(1, n)])
        agg = frame.groupBy(*by).agg(F.percentile_approx(col, at, accuracy).alias("_q"),
                                     F.avg(F.col(col).isNull().cast("int")).alias("_nulls"))
        return {tuple(r[c] for c in by): (r["_q"] or [], r["_nulls"] or 0.0) for r in agg.collect()}

    def split(prefix: tuple, q: list, nulls: float, want: int) -> tuple[list[tuple], dict[tuple, int]]:
        """Bounds below ``prefix``, and the values to be split further with
        the number of ranges that each fills.  The nulls come first, and their
        ranges are theirs alone."""
        own = max(1, want - round(nulls * want))
        if q and own < want:
            q = [q[min(len(q) - 1, (i * len(q)) // own)] for i in range(own)]
        bounds = [prefix + (v,) for v in dict.fromkeys(q)]
        hot = {prefix + (v,): k for v, k in Counter(q).items() if k > 1}
        if want - own > 1:
            hot[prefix + (None,)] = want - own
        return bounds, hot

    if parts < 2 or not cols:
        return []
    q, nulls = quantiles(df, [], cols[0], parts)[()]
    bounds, hot = split((), q, nulls, parts)
    for depth in range(1, len(cols)):
        if not hot:
            break
        found: dict[tuple, int] = {}
        by = list(cols[:depth])
        # At most ``parts`` / 2 values are that common.
        asked = df.sparkSession.createDataFrame([(*k, 1) for k in hot], T.StructType(
            [T.StructField(f"_h{i}", df.schema[c].dataType) for i, c in enumerate(by)] + [T.StructField("_hot", T.IntegerType())]))
        same = F.lit(True)
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_h{i}"))
        rows = df.join(F.broadcast(asked), same, "left_semi")
        for key, (q, nulls) in quantiles(rows, by, cols[depth], max(hot.values()) + 1).items():
            want = hot[key] + 1
            step = [q[(i * len(q)) // want] for i in range(1, want)] if q else []
            more, again = split(key, step, nulls, want)
            bounds += more
            found |= again
        hot = found
    return sorted(set(bounds), key=lambda b: [(v is not None, v) for v in b])


def range_number(df: DataFrame, cols: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """The number of ``bounds`` at or below a row's key: 0 to len(bounds).

    A binary search written as a fold over the powers of two; the bounds are
    one constant of the plan.
    """
    if not bounds:
        return F.lit(0)
    depth = max(map(len, bounds))
    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(cols[:depth])]
    rows = [{f"c{i}": v for i, v in enumerate(b)} for b in bounds]
    text = json.dumps(rows, default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v))
    table = F.from_json(F.lit(text), T.ArrayType(T.StructType(fields)))
    key = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols[:depth])])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def search(k: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(table, low + step - 1) <= k, low + step).otherwise(low))

    # The key is bound once, as it may be an expression that costs.
    return F.element_at(F.transform(F.array(key), search), 1)
