"""Apply the incident upsert to every micro-batch of a stream.

The source records strikes one call at a time; the batch operator
``operators.upsert.record_strikes`` handles any number at once, so a
Structured Streaming query can feed it with ``foreachBatch``.

The tables grow by epochs (``streaming.epoch_tables``): the loaded tables are
epoch -1, and micro-batch ``e`` writes only the rows it adds into its own
folder.  A retried micro-batch replaces its own rows instead of adding them
twice, and it reads the tables as of the epochs before it, so a half-written
earlier attempt never leaks into its own input.

What a batch costs doesn't grow with the tables.  Beside them there are

* ``flight_keys``: the natural keys of the flights with their ids, in folders
  by a hash of the key.  A batch reads the folders that its own keys fall into;
* ``marks``: the highest id handed out, by table (for flights, by folder of
  ``flight_keys``) and epoch.  A batch takes the next ids from there and adds
  its own marks; no maximum is taken over a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martforge.operators.upsert import FLIGHT_KEY, record_strikes
from martforge.session import scratch_dir
from martforge.streaming.epoch_tables import EpochTables

TABLES = ("airports", "flights", "strikes", "conditions")
GROWING = ("airports", "flights", "strikes")
IDS = {"airports": "aid", "flights": "fid", "strikes": "sid"}
#: Folders of the key index: each batch reads one for each of its keys at most.
BUCKETS = 256
MARKS = T.StructType([T.StructField("table", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("high", T.LongType())])


def store(spark: SparkSession, root: str) -> EpochTables:
    return EpochTables(spark, root, {**{t: [] for t in TABLES}, "flight_keys": ["bucket"], "marks": []})


def flight_bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*FLIGHT_KEY), F.lit(buckets)).cast("int")


def _keys(flights: DataFrame) -> DataFrame:
    """One row per natural key: its lowest flight."""
    return (flights.groupBy(*FLIGHT_KEY).agg(F.min("fid").cast("long").alias("fid"))
            .withColumn("bucket", flight_bucket()))


def _key_schema(flights: DataFrame) -> T.StructType:
    return T.StructType([flights.schema[c] for c in FLIGHT_KEY]
                        + [T.StructField("fid", T.LongType()), T.StructField("bucket", T.IntegerType())])


def _write(s: EpochTables, tables: dict[str, DataFrame], epoch: int) -> None:
    """The rows that an epoch adds, their keys and their marks."""
    marks = None
    for name, rows in tables.items():
        s.write(name, rows, epoch)
        if name in GROWING:
            own = s.spark.read.schema(rows.schema).parquet(f"{s.root}/{name}/epoch={epoch}")
            if name == "flights":
                s.write("flight_keys", _keys(own), epoch)
            bucket = flight_bucket() if name == "flights" else F.lit(0)
            high = (own.groupBy(bucket.alias("bucket")).agg(F.max(IDS[name]).cast("long").alias("high"))
                    .select(F.lit(name).alias("table"), "bucket", "high"))
            marks = high if marks is None else marks.unionByName(high)
    s.write("marks", marks, epoch)


def init_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Write the loaded tables, their keys and marks as epoch -1."""
    spark = tables["flights"].sparkSession
    _write(store(spark, root), {name: tables[name] for name in TABLES}, -1)


def read_tables(spark: SparkSession, root: str, before_epoch: int | None = None) -> dict:
    s = store(spark, root)
    return {name: s.read(name, before_epoch) for name in TABLES}


def high_marks(s: EpochTables, before_epoch: int | None = None) -> dict[str, int]:
    """table -> highest id in use (0 for an empty table), from the marks."""
    rows = s.read("marks", before_epoch, MARKS).groupBy("table").agg(F.max("high")).collect()
    return {t: 0 for t in GROWING} | {r[0]: r[1] for r in rows}


def known_flights(s: EpochTables, flights: DataFrame, before_epoch: int | None = None):
    """A look-up (wanted keys) -> their rows of the key index, which reads
    only the folders that the wanted keys fall into."""

    def look_up(wanted: DataFrame) -> DataFrame:
        # At most BUCKETS small integers.
        buckets = [r[0] for r in wanted.select(flight_bucket().alias("b")).distinct().collect()]
        index = s.read("flight_keys", before_epoch, _key_schema(flights))
        return index.where(F.col("bucket").isin(buckets)).select(*FLIGHT_KEY, "fid")

    return look_up


def upsert_batch(batch: DataFrame, epoch_id: int, root: str, order_cols: Sequence[str],
                 compact_every: int | None = None) -> None:
    """foreachBatch body: add one micro-batch to the tables under ``root``.

    Every ``compact_every`` epochs those before this one, which are complete,
    are merged first.
    """
    spark = batch.sparkSession
    s = store(spark, root)
    if compact_every and epoch_id > 0 and epoch_id % compact_every == 0:
        compact(spark, root, epoch_id - 1)
    # Read twice below (its keys, then its rows): written once.
    path = scratch_dir(spark, "upsert-batch")
    batch.write.parquet(path)
    t = {name: s.read(name, epoch_id) for name in TABLES}
    out = record_strikes(spark.read.schema(batch.schema).parquet(path), t["airports"], t["flights"], t["strikes"], t["conditions"],
                         order_cols, known_flights(s, t["flights"], epoch_id), high_marks(s, epoch_id))
    _write(s, {name: out["new_" + name] for name in GROWING}, epoch_id)


def compact(spark: SparkSession, root: str, upto: int) -> bool:
    """Merge the epochs up to ``upto``: one folder a table, one mark a bucket."""
    s = store(spark, root)
    highest = lambda df: df.groupBy("table", "bucket").agg(F.max("high").alias("high"))
    flights = s.read("flights", upto + 1)
    return s.compact(upto, {"marks": highest}, {"marks": MARKS, "flight_keys": _key_schema(flights)})


def upsert_stream(stream: DataFrame, root: str, order_cols: Sequence[str],
                  checkpoint: str | None = None, available_now: bool = True,
                  compact_every: int | None = None) -> StreamingQuery:
    """Start a query that upserts every micro-batch of ``stream``.

    The query's progress is kept beside the tables (``root``/_checkpoint)
    unless ``checkpoint`` names another lasting folder: epochs must go on
    where they stopped, or a restart would replace earlier epochs' rows.  One
    table folder therefore belongs to one stream.
    """
    ckpt = checkpoint or f"{root}/_checkpoint"
    writer = (stream.writeStream
              .foreachBatch(lambda df, e: upsert_batch(df, e, root, order_cols, compact_every))
              .option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
