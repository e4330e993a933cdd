"""Keys: first row per key, distributed dense ids, surrogate-key look-ups.

Dense ids ``offset + 1..n`` in a given order (D5 for dimensions, D6 for
facts) are assigned WITHOUT an unpartitioned window (which would move every
row into one task):

1. range-partition the rows on the order columns plus a deterministic
   tie-breaker (a hash of the whole row, or a caller-given column such as a
   source position), so rows sharing an order value still spread over
   partitions, and sort within partitions;
2. tag each row with its partition and its position inside it, and write
   that once as a Parquet table in the shared checkpoint folder (this cuts
   the lineage: counts and ids below read the same written rows, so a
   re-evaluated or lost input can never make them disagree);
3. count the rows of each partition (reads one small column) and
   prefix-sum the counts -- the only single-task step, over one row per
   partition -- then broadcast the offsets (size bounded by the partition
   count);
4. id = offset of the partition + position inside the partition + 1.

Rows identical in every column get consecutive ids in an arbitrary order;
they are interchangeable.

``dense_ids`` leaves step 1 to Spark's range partitioner, which samples the
rows by running their plan once more.  ``dense_ids_by_range``, for wide records
that are the result of joins, takes the bounds from the order columns alone
(see ``operators.ranges``), so the records are computed, moved and written once.
``dense_ids_in_place`` doesn't even move them if the first order column is a
whole number without nulls or very common values: the rows of each of its values
are counted and numbered where a join on that column left them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.operators import ranges as RG
from martforge.session import scratch_dir, stored

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position
#: Rows of one value of the first order column that one task may sort.
_COMMON = 1 << 16


def _ordering(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, str):
            out.append(F.col(c).asc_nulls_first())
        else:
            out.append(c)
    return out


def _num_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_hash(df: DataFrame) -> Column:
    """Deterministic 64-bit hash of all columns of a row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def dense_ids(df: DataFrame, order_cols: Sequence, id_col: str = "id",
              offset: int = 0, num_partitions: int | None = None,
              tie_breaker: str | None = None, path: str | None = None,
              stage_input: bool = False, keep_order_cols: bool = True) -> DataFrame:
    """Add ``id_col`` = offset + 1..n following ``order_cols``.

    ``tie_breaker`` names a column that makes the order total (e.g. a source
    position); by default a hash of the whole row is used.  The tagged rows
    are written to ``path`` (default: a fresh folder under the checkpoint
    folder) and the result reads them back.

    Spark's range partitioner samples its input in a job of its own, so an
    expensive input (joins, parsing) would be computed twice;
    ``stage_input=True`` writes it once first and samples the written copy.
    ``keep_order_cols=False`` leaves the order columns out of the written
    table when only the id is needed afterwards.
    """
    spark = df.sparkSession
    n = num_partitions or _num_partitions(spark)
    work = df
    if stage_input:
        staged_path = scratch_dir(spark, "dense-input")
        df.write.mode("overwrite").parquet(staged_path)
        work = spark.read.parquet(staged_path)
    tb = tie_breaker
    if tb is None:
        tb = "_dense_tb"
        work = work.withColumn(tb, row_hash(df))
    order = _ordering(list(order_cols) + [tb])
    ranged = work.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = (ranged
              .withColumn("_dense_part", F.spark_partition_id())
              .withColumn("_dense_pos", F.monotonically_increasing_id()
                          .bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    if not keep_order_cols:
        tagged = tagged.drop(*[c for c in order_cols if isinstance(c, str)])
    target = path or scratch_dir(spark, "dense-ids")
    tagged.write.mode("overwrite").parquet(target)
    written = spark.read.parquet(target)
    counts = written.groupBy("_dense_part").agg(F.count(F.lit(1)).alias("_dense_n"))
    # One row per partition: the window below sees at most `n` rows.
    w = Window.orderBy("_dense_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_dense_part",
        F.coalesce(F.sum("_dense_n").over(w), F.lit(0)).alias("_dense_off"))
    out = (written.join(F.broadcast(offsets), "_dense_part")
           .withColumn(id_col, (F.col("_dense_off") + F.col("_dense_pos")
                                + F.lit(offset + 1)).cast("long")))
    drop = ["_dense_part", "_dense_pos", "_dense_off"]
    if tie_breaker is None:
        drop.append(tb)
    return out.drop(*drop)


def dense_ids_by_range(df: DataFrame, order_cols: Sequence[str], id_col: str = "id", offset: int = 0,
                       num_partitions: int | None = None, bounds_from: DataFrame | None = None,
                       keep_order_cols: bool = True) -> DataFrame:
    """``dense_ids`` in ascending order of named columns (nulls first,
    rows equal in all of them by a hash of the row) with one write of the
    records and nothing else that reads them whole.

    ``bounds_from``: a frame with the order columns and about the same
    distribution, e.g. the table that the records were joined from; by default
    ``df`` pruned to its order columns.  It decides how even the parts are,
    never an id.  The leading order columns must be numbers, dates or times as
    far as they are needed to split common values; if the first is not,
    ``dense_ids`` does the work.
    """
    spark = df.sparkSession
    n = num_partitions or _num_partitions(spark)
    narrow = (df if bounds_from is None else bounds_from).select(*order_cols)
    ranked = RG.rankable(df, order_cols)
    if not ranked:
        return dense_ids(df, order_cols, id_col, offset, n, stage_input=True, keep_order_cols=keep_order_cols)
    bounds = RG.range_bounds(narrow, ranked, n)
    work = df.withColumn("_dense_part", RG.range_number(df, ranked, bounds))
    tagged = (work.repartitionById(len(bounds) + 1, F.col("_dense_part"))
              .withColumn("_dense_tb", row_hash(df))
              .sortWithinPartitions(*_ordering([*order_cols, "_dense_tb"]))  # which orders the ranges, too
              .withColumn("_dense_pos", F.monotonically_increasing_id())
              .drop("_dense_tb", *([] if keep_order_cols else order_cols)))
    target = scratch_dir(spark, "dense-ids")
    tagged.write.parquet(target)
    written = spark.read.parquet(target)
    # Positions count on from the first one of a range, wherever it was written.
    counts = written.groupBy("_dense_part").agg(F.count(F.lit(1)).alias("_dense_n"), F.min("_dense_pos").alias("_dense_first"))
    w = Window.orderBy("_dense_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_dense_part", (F.coalesce(F.sum("_dense_n").over(w), F.lit(0)) - F.col("_dense_first")).alias("_dense_off"))
    return (written.join(F.broadcast(offsets), "_dense_part")
            .withColumn(id_col, (F.col("_dense_off") + F.col("_dense_pos") + F.lit(offset + 1)).cast("long"))
            .drop("_dense_part", "_dense_pos", "_dense_off"))


def _starts_by_value(df: DataFrame, lead: str, parts: int) -> DataFrame | None:
    """(lead, _dense_off): for each value of ``lead`` the number of rows with
    smaller ones; None if it has nulls or a value with over ``_COMMON`` rows.

    The counts are written once, and all that follows reads them: ranges of
    values, a prefix sum over the ranges (one row each) and one in each range.
    """
    path = scratch_dir(df.sparkSession, "dense-counts")
    df.groupBy(lead).agg(F.count(F.lit(1)).alias("_dense_n")).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    found = counts.agg(F.max("_dense_n"), F.count_if(F.col(lead).isNull()), F.count(lead)).first()
    if found[1] or (found[0] or 0) > _COMMON:
        return None
    # At most 2^16 values a range, however they lie.
    bounds = RG.range_bounds(counts.select(lead), [lead], max(parts, -(-found[2] // _COMMON)))
    ranged = counts.withColumn("_dense_part", RG.range_number(counts, [lead], bounds))
    before = Window.orderBy("_dense_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    firsts = (ranged.groupBy("_dense_part").agg(F.sum("_dense_n").alias("_dense_n"))
              .select("_dense_part", F.coalesce(F.sum("_dense_n").over(before), F.lit(0)).alias("_dense_first")))
    own = Window.partitionBy("_dense_part").orderBy(lead).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_dense_off", F.coalesce(F.sum("_dense_n").over(own), F.lit(0)))
            .join(F.broadcast(firsts), "_dense_part")
            .select(lead, (F.col("_dense_off") + F.col("_dense_first")).alias("_dense_off")))


def dense_ids_in_place(df: DataFrame, order_cols: Sequence[str], id_col: str = "id", offset: int = 0,
                       bounds_from: DataFrame | None = None, keep_order_cols: bool = True) -> DataFrame:
    """``dense_ids_by_range`` for records joined from tables: the id is the
    start of the row's first order value and its place among the value's rows.

    The plan of ``df`` is run twice, first for the first order column alone, so
    it must give the same rows each time.  Rows are moved only if they don't
    lie together by that column; ids are written with the records.  Where the
    column has nulls, very common values or another type, the work is left to
    ``dense_ids_by_range``.
    """
    spark, lead = df.sparkSession, order_cols[0]
    starts = _starts_by_value(df, lead, _num_partitions(spark)) if isinstance(df.schema[lead].dataType, _WHOLE) else None
    if starts is None:
        return dense_ids_by_range(df, order_cols, id_col, offset, bounds_from=bounds_from, keep_order_cols=keep_order_cols)
    own = Window.partitionBy(lead).orderBy(*_ordering([*order_cols[1:], "_dense_tb"]))
    numbered = (df.join(starts, lead).withColumn("_dense_tb", row_hash(df))
                .withColumn(id_col, (F.col("_dense_off") + F.row_number().over(own) + F.lit(offset)).cast("long")))
    return stored(numbered.select(*[c for c in df.columns if keep_order_cols or c not in order_cols], id_col), "dense-ids")


def dense_ids_by_int_key(df: DataFrame, key: str, id_col: str = "id", offset: int = 0,
                         bucket_size: int = 1 << 20) -> DataFrame:
    """Dense ids ``offset + 1..n`` in the order of a UNIQUE non-negative integer key.

    With a known integer domain no sampling and no written table are needed:
    rows are bucketed by value (``key // bucket_size``, so a bucket holds at
    most ``bucket_size`` rows whatever the skew), numbered with ``row_number``
    inside their bucket, and offset by the prefix sum of the bucket counts
    (one row per non-empty bucket).  Every step depends only on values, so a
    re-evaluation gives the same ids.
    """
    b = df.withColumn("_ib", F.floor(F.col(key) / F.lit(bucket_size)).cast("long"))
    counts = b.groupBy("_ib").agg(F.count(F.lit(1)).alias("_in"))
    w = Window.orderBy("_ib").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ib", F.coalesce(F.sum("_in").over(w), F.lit(0)).alias("_ioff"))
    within = Window.partitionBy("_ib").orderBy(F.col(key))
    return (b.withColumn("_ir", F.row_number().over(within))
            .join(offsets, "_ib")
            .withColumn(id_col, (F.col("_ioff") + F.col("_ir") + F.lit(offset)).cast("long"))
            .drop("_ib", "_ir", "_ioff"))


def ids_from_positions(df: DataFrame, group_col: str, pos_col: str, id_col: str = "id",
                       offset: int = 0) -> DataFrame:
    """D6 for records read from files: id = (rows of earlier files) + pos + 1.

    ``pos_col`` must be the dense 0-based position inside ``group_col`` (as
    ``posexplode`` gives).  Needs no sort and no range shuffle: one count per
    file, a prefix sum over the files (one row per file), and a join.
    """
    counts = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_fn"))
    w = Window.orderBy(F.col(group_col).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, F.coalesce(F.sum("_fn").over(w), F.lit(0)).alias("_foff"))
    return (df.join(offsets, df[group_col].eqNullSafe(offsets[group_col]))
            .drop(offsets[group_col])
            .withColumn(id_col, (F.col("_foff") + F.col(pos_col) + F.lit(offset + 1)).cast("long"))
            .drop("_foff"))


def first_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                  value_cols: Sequence[str]) -> DataFrame:
    """One row per key, the other columns taken from the FIRST row.

    ``min_by`` aggregates partially on the map side, so a hot key collapses
    before the shuffle; no window over wide rows.  As Spark sorts the rows for
    a ``min_by``, a numeric or date order is first reduced to its minimum per
    key and values by hashing, and only those few rows are sorted.
    Output: key columns, ``first_order`` = min(order), and ``value_cols``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not value_cols:
        return df.groupBy(*keys).agg(F.min(order_col).alias("first_order"))
    if RG.rankable(df, [order_col]) and not set(value_cols) & {*keys, order_col}:
        df = df.groupBy(*keys, *value_cols).agg(F.min(order_col).alias(order_col))
    packed = F.struct(*[F.col(c) for c in value_cols])
    agg = df.groupBy(*keys).agg(F.min(order_col).alias("first_order"),
                                F.min_by(packed, F.col(order_col)).alias("_first"))
    return agg.select(*keys, "first_order", *[F.col("_first." + c).alias(c) for c in value_cols])


def first_of_equal_rows(df: DataFrame, order_cols: Sequence[str], order: str) -> DataFrame:
    """The distinct rows of ``df`` without ``order_cols``, each with ``order``,
    a struct that orders them by the first record (in ``order_cols`` order,
    nulls first) that each came from.  Written once.

    The first order column decides alone wherever it differs, so only it is
    read for all records; the others are for the rows that have it in common.
    """
    lead, rest = order_cols[0], list(order_cols[1:])
    fields = [c for c in df.columns if c not in order_cols]
    if not isinstance(df.schema[lead].dataType, _IN_PLACE):  # a min of it isn't hashed
        return stored(df.groupBy(*fields).agg(F.min(F.struct(*order_cols)).alias(order)), "first-rows")

    def low() -> list[Column]:
        return [F.min(lead).alias(lead), F.max(F.col(lead).isNull()).alias("_none")]

    def lowest(frame: DataFrame) -> DataFrame:
        return frame.withColumn(lead, F.when(~F.col("_none"), F.col(lead))).drop("_none")

    found = stored(lowest(df.groupBy(*fields).agg(*low())), "first-rows")
    shared = stored(found.groupBy(lead).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(lead).alias("_shared")), "shared-firsts")
    if not rest or shared.isEmpty():
        return found.select(*fields, F.struct(lead).alias(order))
    common = F.col(lead).eqNullSafe(F.col("_shared"))
    exact = (df.join(shared, common, "left_semi").groupBy(*fields).agg(F.min(F.struct(*order_cols)).alias(order)))
    # A row that shares its first value was met there with all its order columns.
    alone = found.join(shared, common, "left_anti")
    kind = exact.schema[order].dataType
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]]
    met = found.join(shared, common, "left_semi").select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)], F.col(lead).alias("_low"))
    same = F.col(f"{order}.{lead}").eqNullSafe(F.col("_low"))
    for i, c in enumerate(fields):
        same = same & F.col(c).eqNullSafe(F.col(f"_f{i}"))
    return stored(alone.select(*fields, F.struct(lead, *none).alias(order)).unionByName(exact.join(met, same, "left_semi")), "first-rows")


def dense_key(df: DataFrame, key: str | Sequence[str], order_col: str | Sequence[str],
              id_col: str, offset: int = 0,
              value_cols: Sequence[str] = ()) -> DataFrame:
    """D1 + D5: distinct keys numbered offset + 1..n by first appearance.

    When ``order_col`` is an integer record id (the records were numbered
    first), the first ids are unique integers and are ranked with
    ``dense_ids_by_int_key``.  Otherwise, as with several order columns of
    records that nobody has numbered, the DISTINCT keys are ranked by their
    first order values with ``dense_ids``: the records themselves are only
    aggregated (partially before the shuffle), not sorted or written.
    """
    if not isinstance(order_col, str):
        df, order_col = df.withColumn("_order", F.struct(*order_col)), "_order"
    firsts = first_per_key(df, key, order_col, value_cols)
    keys = [key] if isinstance(key, str) else list(key)
    if isinstance(df.schema[order_col].dataType, (T.LongType, T.IntegerType)):
        return dense_ids_by_int_key(firsts, "first_order", id_col, offset).drop("first_order")
    return dense_ids(firsts, ["first_order"], id_col, offset,
                     tie_breaker=keys[0]).drop("first_order")


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
               key_col: str, out_col: str | None = None, policy: str = "null",
               null_safe: bool = False, raw_col: str | None = None) -> DataFrame:
    """Replace a natural key by the dimension's surrogate key.

    The dimension must hold one row per natural key (deduplicate it first
    with ``first_per_key`` when it does not).  ``policy`` for unmatched rows:
    ``null`` keeps them with a null key, ``drop`` removes them, ``error``
    makes the job fail with ``OrphanKeyError`` in its message (the source
    load aborts on an unmatched name); the test runs inside the same job.
    ``null_safe`` lets null match a null natural key (R ``match``);
    otherwise null never matches, so under ``error`` and ``drop`` a null (or
    unparsable) key is unmatched like any other.  ``raw_col`` names the
    column to show in the message (the text that a key was parsed from).
    """
    out_col = out_col or key_col
    d = dim.select(F.col(dim_col).alias("_lk_nat"), F.col(key_col).alias("_lk_key"))
    cond = (fact[fact_col].eqNullSafe(d["_lk_nat"]) if null_safe
            else fact[fact_col] == d["_lk_nat"])
    how = "inner" if policy == "drop" else "left"
    joined = fact.join(d, cond, how).drop("_lk_nat")
    if policy == "error":
        # Checked lazily, inside the same job: no extra pass over the facts.
        shown = raw_col or fact_col
        joined = joined.withColumn(
            "_lk_key",
            F.when(F.col("_lk_key").isNull(), F.raise_error(F.concat(
                F.lit(f"OrphanKeyError: {shown}="),
                F.coalesce(F.col(shown).cast("string"), F.lit("NULL")),
                F.lit(f" has no match in {dim_col}"))).cast(d.schema["_lk_key"].dataType))
            .otherwise(F.col("_lk_key")))
    elif policy not in ("null", "drop"):
        raise ValueError(f"unknown orphan policy {policy}")
    return joined.withColumnRenamed("_lk_key", out_col)


#: Types whose values an aggregate holds in place, and those that it groups by.
_IN_PLACE = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
_GROUPED = (T.StringType, T.BinaryType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _fewer_rows(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The first row, in the order of a column of whole numbers, of all rows
    with the same keys and texts; ``df`` as it is if it has other types.

    Texts can't be replaced in a hash aggregate's row, so a ``min_by`` of them
    sorts all its input.  This one is hashed, and leaves few rows to sort.
    All columns are taken by the same order, so from the same row.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [c for c in df.columns if c not in (*keys, order_col)]
    texts = [c for c in values if isinstance(types[c], _GROUPED)]
    if not isinstance(types[order_col], _WHOLE) or not all(isinstance(types[c], _IN_PLACE + _GROUPED) for c in values):
        return df
    order = F.coalesce(F.col(order_col), F.lit(0))  # rows without one are groups of their own
    firsts = df.groupBy(*keys, *texts, F.col(order_col).isNull().alias("_none")).agg(
        F.min(order_col).alias(order_col), *[F.min_by(c, order).alias(c) for c in values if c not in texts])
    return firsts.select(*df.columns)


def apply_key_policy(df: DataFrame, key: str | Sequence[str], policy: str = "keep_all",
                     order_cols: Sequence | None = None) -> DataFrame:
    """What to do with several rows per declared key.

    ``keep_all`` (default; the query defines the table), ``keep_first``
    (first row per key in ``order_cols`` order, via ``min_by`` on the row
    struct), ``error`` (raise when any key repeats).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if policy == "keep_all":
        return df
    if policy == "error":
        dup = df.groupBy(*keys).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"duplicate key {keys}")
        return df
    if policy == "keep_first":
        if not order_cols:
            raise ValueError("keep_first needs order_cols")
        others = [c for c in df.columns if c not in keys]
        if len(order_cols) == 1 and isinstance(order_cols[0], str) and order_cols[0] not in keys:
            df = _fewer_rows(df, keys, order_cols[0])
        order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
        agg = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
        return agg.select(*keys, *[F.col("_row." + c).alias(c) for c in others]).select(*df.columns)
    raise ValueError(f"unknown key policy {policy}")
