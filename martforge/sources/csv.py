"""CSV source (S5) with R ``read.csv`` missing-value rules.

R treats only ``NA`` as missing and keeps blank text as ``""``; Spark's CSV
reader does the opposite by default (blank -> null, ``NA`` stays text).  The
file is read with every column as text (header names kept, nothing inferred,
so no extra pass over the data) and then:  null -> ``""``, ``"NA"`` -> null.
Quotes inside quoted text are doubled, as ``read.csv`` and spreadsheets write
them, and quoted text may hold line ends.

``read_csv_text``   a file with line ends in quotes is read by one task.
``read_csv_split``  any number of tasks read one file, line ends in quotes or
                    not: a line starts inside quotes if the quotes before it in
                    the file are odd in number, so each split counts its own
                    and a prefix sum over the splits tells the rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_BAD = "_bad_record"


def r_missing(c: str):
    col = F.col(f"`{c}`")
    return (F.when(col.isNull(), F.lit(""))
            .when(col == F.lit("NA"), F.lit(None).cast("string"))
            .otherwise(col).alias(c))


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first record."""
    return (spark.read.option("header", "true").option("inferSchema", "false").option("escape", '"')
            .option("multiLine", "true").csv(path).columns)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def n_fields(record: Column) -> Column:
    """Fields of a CSV record: the commas outside quotes, and one."""
    return F.regexp_count(F.regexp_replace(record, '"[^"]*"', ""), F.lit(",")) + 1


def _too_long(record: Column, width: int) -> Column:
    """True, or an error if the record has more than ``width`` fields."""
    return F.when(n_fields(record) > width, F.raise_error(F.concat(
        F.lit(f"record has more than {width} fields: "), F.substring(record, 1, 200))).cast("boolean")).otherwise(F.lit(True))


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  multi_line: bool = True, fill: bool = False) -> DataFrame:
    """All-text CSV scan with a header row; ``columns`` selects by name.

    With ``multi_line`` (the default, as in ``read.csv``) quoted text may hold
    line ends, and a file is read by one task; set it to False for large files
    known to have one record per line, which Spark then splits, or use
    ``read_csv_split``.  A record that does not fit the header makes the job
    fail instead of losing text.  ``fill``, like R's option of that name, adds
    blank fields to records that are too short; longer ones still fail.
    """
    reader = (spark.read.option("header", "true").option("inferSchema", "false")
              .option("escape", '"').option("multiLine", str(multi_line).lower()))
    if not fill:
        df = reader.option("mode", "FAILFAST").csv(path)
        names = df.columns
    else:
        names = _header(spark, path)
        # Records that don't fit arrive with their text.
        schema = _text_schema([*names, _BAD])
        df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).schema(schema).csv(path)
        df = df.where(F.col(_BAD).isNull() | _too_long(F.col(_BAD), len(names)))
    return df.select(*[r_missing(c) for c in (columns or names)])


def _lines(spark: SparkSession, path: str, names: bool = True) -> DataFrame:
    """(file, block, odd, line): the lines of all splits; ``odd`` is 1 if the
    line has an odd number of quotes.  A split is read by one task from start
    to end, and a task reads its splits one after the other.  A file's path is
    longer than most lines, so that it is sent as its hash unless asked for."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    file = F.col("_metadata.file_path")
    return (spark.read.option("lineSep", "\n").text(path)
            .select((file if names else F.xxhash64(file)).alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    (quotes % 2).cast("byte").alias("odd"), F.col("value").alias("line")))


def _of_one_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str | int, int], pa.RecordBatch]]:
    """((file, block), rows): the batches of a task cut where its splits end."""
    for batch in batches:
        file, block = batch.column(0), batch.column(1).to_numpy()
        other = block[1:] != block[:-1]
        if len(block) > 1:
            other |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(other) + 1).tolist(), len(block)]
        for s, e in zip(cuts, cuts[1:]):
            if e > s:
                yield (file[s].as_py(), int(block[s])), batch.slice(s, e - s)


def _split_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: the parity of its quotes, and how many records
    start in it if it starts outside / inside quotes."""
    rows: list[tuple] = []
    for key, part in _of_one_split(batches):
        if not rows or rows[-1][:2] != key:
            rows.append((*key, 0, 0, 0))
        *_, odd, h0, h1 = rows[-1]
        own = part.column(2).to_numpy()
        inside = int(((odd + np.cumsum(own) - own) % 2).sum())
        rows[-1] = (*key, (odd + int(own.sum())) % 2, h0 + len(own) - inside, h1 + inside)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["file", "block", "odd", "h0", "h1"])


def _split_records(batches: Iterator[pa.RecordBatch], wanted: Sequence[bool] = (True, False)) -> Iterator[pa.RecordBatch]:
    """(file, block, no, line, whole) from the lines with what is known of
    their split: each record, or what a split holds of it if that isn't all
    (two rows of a split at most); only those whose ``whole`` is wanted."""
    key, inside, count, held, held_no, begun = None, 0, 0, [], 0, False

    def out(no: np.ndarray, lines: pa.Array, whole: bool) -> pa.RecordBatch:
        n = len(no)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array(no, pa.int64()), lines, pa.array([whole] * n, pa.bool_())],
                                          ["file", "block", "no", "line", "whole"])

    def joined() -> pa.Array:
        return pa.array(["\n".join(held)], pa.string())

    for at, part in _of_one_split(batches):
        if at != key:
            if held and False in wanted:
                yield out([held_no], joined(), False)
            key, inside, count = at, part.column(4)[0].as_py(), part.column(5)[0].as_py()
            held, held_no, begun = [], count - 1, False
        odd, lines = part.column(2).to_numpy(), part.column(3)
        after = inside + np.cumsum(odd)
        head, tail = (after - odd) % 2 == 0, after % 2 == 0
        no = count + np.cumsum(head) - 1
        start, stop = 0, len(odd)
        if inside:               # a record goes on
            start = int(tail.argmax()) + 1 if tail.any() else len(odd)
            held += lines[:start].to_pylist()
            if tail.any():
                if begun in wanted:
                    yield out([held_no], joined(), begun)
                held = []
        if after[-1] % 2 and head.any():
            stop = int(np.flatnonzero(head)[-1])
        if True in wanted and stop > start:
            single = (head & tail)[start:stop]
            rest, own = np.flatnonzero(~single) + start, lines[start:stop]
            ends = np.flatnonzero(tail[rest]) + 1
            several = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), lines.take(pa.array(rest))), "\n")
            yield out(np.concatenate((no[start:stop][single], no[rest[ends - 1]])), pa.concat_arrays([own.filter(pa.array(single)), several]), True)
        if stop < len(odd):
            held, held_no, begun = lines[stop:].to_pylist(), int(no[stop]), True
        inside, count = int(after[-1] % 2), int(no[-1]) + 1
    if held and False in wanted:
        yield out([held_no], joined(), False)


def read_csv_split(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   fill: bool = False, position: bool = False) -> DataFrame:
    """``read_csv_text`` with quoted line ends for files of any size: the
    splits of a file are read by many tasks.

    Quotes must be written as in RFC 4180: around a field, and doubled within
    it.  Then a line is inside quotes if the quotes before it are odd in
    number.  Each split's lines are put together to records where they are
    read; only records that several splits share are shuffled.  A file whose quotes are odd in
    number makes the job fail, and so does a record that doesn't fit (see
    ``fill``).  ``position`` adds ``_file`` and ``_pos``, the record's place
    in its file from 0.

    The lines are read twice, for the quotes and for the records; what
    depends on the splits before it is one row a split.  Line ends of two
    characters become one, in quotes too, as in ``read_csv_text``.
    """
    names = _header(spark, path)
    lines = _lines(spark, path, position)
    kind = lines.schema["file"].dataType.simpleString()
    blocks = lines.select("file", "block", "odd").mapInArrow(_split_counts, f"file {kind}, block long, odd long, h0 long, h1 long")
    files = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("inside", F.coalesce(F.sum("odd").over(files), F.lit(0)) % 2)
              .withColumn("records", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("h0")).otherwise(F.col("h1"))).over(files), F.lit(0)))
              .withColumn("open", F.sum("odd").over(Window.partitionBy("file")) % 2 == 1)
              .select("file", "block", "inside",
                      F.when(F.col("open"), F.raise_error(F.concat(F.lit("quotes not closed in "), F.col("file") if position else F.lit(f"a file of {path}"))).cast("long"))
                      .otherwise(F.col("records")).alias("records")))
    placed = lines.join(F.broadcast(blocks), ["file", "block"]).select("file", "block", "odd", "line", "inside", "records")
    used = ["file", "no", "line"] if position else ["line"]

    def records_of(wanted: bool, columns: Sequence[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _split_records(batches, [wanted]):
                yield batch.filter(pc.greater(batch.column(2), 0)).select(columns)  # the first record of a file is its header

        types = {"file": kind, "line": "string"}
        return placed.mapInArrow(run, ", ".join(f"{c} {types.get(c, 'long')}" for c in columns))

    parts = F.array_sort(F.collect_list(F.struct("block", "line")))  # what the splits hold of one record
    several = (records_of(False, ["file", "block", "no", "line"]).groupBy("file", "no")
               .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line")))
    line = F.when(F.contains("line", F.lit("\r")), F.regexp_replace("line", "\r(\n|$)", "$1")).otherwise(F.col("line"))
    records = records_of(True, used).unionByName(several.select(*used)).withColumn("line", line).where("line <> ''")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE" if fill else "FAILFAST"}
    if fill:
        records = records.where(_too_long(F.col("line"), len(names)))
    place = [F.col("file").alias("_file"), (F.col("no") - 1).alias("_pos")] if position else []
    parsed = records.select(*used[:-1], F.from_csv("line", _ddl(names), options).alias("r"))
    rows = parsed.select(*place, *[F.col("r").getField(n).alias(n) for n in names])
    return rows.select(*(["_file", "_pos"] if position else []), *[r_missing(c) for c in (columns or names)])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def write_csv_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write text columns as CSV with a header; nulls written as ``NA``,
    quotes doubled."""
    (df.write.option("header", "true").option("nullValue", "NA").option("escape", '"')
     .option("emptyValue", '""').mode(mode).csv(path))
