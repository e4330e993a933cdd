"""XML record sources (S1-S4) on Spark's built-in XML data source.

Every element named ``row_tag``, at any depth, becomes a row, child elements
become string columns, attributes arrive as ``_<name>``.  Malformed XML makes
the job fail (``FAILFAST``), it loses no records.

``read_xml_records``   Spark's ``rowTag`` reader, one task per file; rows carry
                       their file (``_file``), in no order.
``read_xml_documents`` the same with exact order: adds ``_pos``, the position
                       in the file; the parsed rows are written once below the
                       checkpoint folder, so each file is parsed once.
``read_xml_split``     ``read_xml_documents`` for large files: many tasks read
                       one file, cut at the records' closing tags.

``file_regex`` keeps only files whose own name matches the unanchored regex
(like listing a folder with a name pattern); folder names don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.session import scratch_dir


#: Files that a task writes side by side, without a sort of its rows by file.
OPEN_FILES, OPEN_FILES_CONF = 16, "spark.sql.maxConcurrentOutputFileWriters"


def string_schema(fields: Sequence[str]) -> T.StructType:
    """All-text schema: XML values arrive as text and are typed afterwards."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def _filter_files(df: DataFrame, file_regex: str | None) -> DataFrame:
    df = df.withColumn("_file", F.col("_metadata.file_path"))
    return df.where(F.col("_metadata.file_name").rlike(file_regex)) if file_regex else df


def read_xml_records(spark: SparkSession, path: str, row_tag: str,
                     fields: Sequence[str] | T.StructType,
                     file_regex: str | None = None) -> DataFrame:
    """One row per ``row_tag`` element, all columns text."""
    schema = fields if isinstance(fields, T.StructType) else string_schema(fields)
    df = (spark.read.format("xml").option("rowTag", row_tag)
          .option("mode", "FAILFAST").option("multiLine", "true")
          .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml*")
          .schema(schema).load(path))
    return _filter_files(df, file_regex)


def read_xml_documents(spark: SparkSession, path: str, row_tag: str,
                       fields: Sequence[str] | T.StructType,
                       file_regex: str | None = None) -> DataFrame:
    """S1 / S4 with exact order: adds ``_file`` and ``_pos`` (0-based)."""
    df = read_xml_records(spark, path, row_tag, fields, file_regex)
    target = scratch_dir(spark, "xml-rows")
    # A file is read by one task from start to end, so this id follows its order.
    df.withColumn("_seq", F.monotonically_increasing_id()).write.parquet(target)
    rows = spark.read.parquet(target)
    first = rows.groupBy("_file").agg(F.min("_seq").alias("_first"))  # one row per file
    return (rows.join(F.broadcast(first), "_file").withColumn("_pos", F.col("_seq") - F.col("_first"))
            .select(*df.columns, "_pos"))


def _pieces(text: Column, row_tag: str) -> Column:
    """Struct (records, odd) of the text before a closing tag: the elements
    that it holds, complete, and whether none is left open in it (as after the
    last record).  What can't be cut at closing tags raises an error."""
    name = rf"<{row_tag}(?=[\s/>])"
    attributes = r"""(?:\s+[^\s=<>"'/]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*"""
    clean = F.regexp_replace(text, r"(?s)<!--.*?-->", "")

    def fail(why: str, c: Column, kind: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{why}, read it with read_xml_documents: "), F.substring(c, 1, 200))).cast(kind)

    def of(c: Column) -> Column:
        # Before the first start tag that isn't an empty element's; that tag and all after it.
        before = F.regexp_replace(c, rf"(?s)<{row_tag}{attributes}>.*$", "")
        last = F.substring(c, F.length(before) + 1, F.length(c))
        body = F.regexp_replace(last, rf"^<{row_tag}{attributes}>", "")
        empty = F.regexp_extract_all(before, F.lit(rf"<{row_tag}{attributes}/>"), F.lit(0))
        cdata = F.regexp_replace(c, r"(?s)<!\[CDATA\[.*?\]\]>", "")
        open_ = F.length(last) > 0
        kind = "array<string>"
        records = (F.when(F.contains(c, F.lit("<!--")) | F.contains(cdata, F.lit("<![CDATA[")), fail("closing tag in a comment or CDATA", c, kind))
                   .when(F.rlike(body, F.lit(name)), fail(f"{row_tag} inside {row_tag}", c, kind))
                   .when(F.size(empty) < F.regexp_count(before, F.lit(name)), fail(f"odd start tag of {row_tag}", c, kind))
                   .when(open_, F.concat(empty, F.array(F.concat(last, F.lit(f"</{row_tag}>"))))).otherwise(empty))
        return F.struct(records.alias("records"), (~open_).alias("closed"), (~open_ & F.rlike(c, F.lit(r"</[^<>]+>\s*$"))).alias("ends"))

    # Most pieces hold one plain start tag and nothing that may hide another.
    start = F.lit(f"<{row_tag}>")
    at = F.instr(text, start)
    once = F.length(text) - F.length(F.replace(text, F.lit(f"<{row_tag}"), F.lit(""))) == len(row_tag) + 1
    plain = (at > 0) & once & ~F.contains(text, F.lit("<!"))
    record = F.concat(F.substring(text, at, F.length(text)), F.lit(f"</{row_tag}>"))
    return F.when(plain, F.struct(F.array(record).alias("records"), F.lit(False).alias("closed"), F.lit(False).alias("ends"))).otherwise(
        F.element_at(F.transform(F.array(clean), of), 1))


def read_xml_split(spark: SparkSession, path: str, row_tag: str,
                   fields: Sequence[str] | T.StructType,
                   file_regex: str | None = None) -> DataFrame:
    """S1 / S4 like ``read_xml_documents`` (``_file``, ``_pos``), for files of
    any size: each is read by many tasks.

    The text reader splits a file by bytes with ``</row_tag>`` as its record
    separator, so what a task gets is one record and what stands before it.
    Files are UTF-8 and end with a closing tag of their own, after the last
    record; one that doesn't (a cut-off file) makes the job fail, as do a
    malformed record, records inside each other and closing tags in comments
    or CDATA.  Text between the records is not checked.  The parsed rows are
    written once; positions are counted from them.
    """
    schema = fields if isinstance(fields, T.StructType) else string_schema(fields)
    text = (spark.read.option("lineSep", f"</{row_tag}>").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.xml*").text(path))
    text = _filter_files(text.withColumn("_block", F.col("_metadata.file_block_start")), file_regex)
    cut = text.select("_file", "_block", _pieces(F.col("value"), row_tag).alias("p"))
    # A row for each record, and one with none for each piece that leaves no record open.
    flat = cut.select("_file", "_block", F.col("p.ends").alias("_ends"), F.explode(F.concat(
        "p.records", F.when(F.col("p.closed"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>")))).alias("x"))
    rows = flat.select("_file", "_block", (F.col("x").isNull() & F.col("_ends")).alias("_ends"), F.col("x").isNull().alias("_after"),
                       F.from_xml("x", schema, {"mode": "FAILFAST", "rowTag": row_tag}).alias("r"))
    target = scratch_dir(spark, "xml-rows")
    # A split is read by one task from start to end, so this id follows its order.
    rows.withColumn("_seq", F.monotonically_increasing_id()).write.parquet(target)
    stored = spark.read.parquet(target)
    blocks = stored.groupBy("_file", "_block").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    blocks = blocks.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    # The last piece of a file, and only that, is one without a record.
    files = stored.groupBy("_file").agg(F.count_if("_after").alias("_tails"), F.max_by("_ends", F.struct("_block", "_seq")).alias("_whole"))
    whole = (F.col("_tails") == 1) & F.col("_whole")
    placed = stored.where(~F.col("_after")).join(F.broadcast(blocks), ["_file", "_block"]).join(F.broadcast(files), "_file")
    file = F.when(whole, F.col("_file")).otherwise(F.raise_error(F.concat(F.lit(f"{row_tag} not closed, or text cut off, in "), F.col("_file"))).cast("string"))
    return placed.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields], file.alias("_file"),
                         (F.col("_shift") + F.col("_seq")).alias("_pos"))


def leaf_text(df: DataFrame, element: str) -> DataFrame:
    """S3: a leaf element list as one column called ``text`` (no second read)."""
    return df.select(F.col(element).alias("text"))


def records_to_xml(df: DataFrame, row_tag: str, fields: Sequence[str],
                   attributes: Sequence[str] = ()) -> DataFrame:
    """Serialise rows to one XML element string each (``xml`` column).

    ``attributes`` become XML attributes; other fields child elements.
    """
    cols = [F.col(a).cast("string").alias("_" + a) for a in attributes]
    cols += [F.col(f).cast("string").alias(f) for f in fields if f not in attributes]
    return df.select(F.to_xml(F.struct(*cols), {"rowTag": row_tag}).alias("xml"))


def parse_xml_column(df: DataFrame, column: str, fields: Sequence[str],
                     attributes: Sequence[str] = ()) -> DataFrame:
    """Parse one-element XML strings back into text columns (``from_xml``).

    Attributes come back under their plain names.
    """
    schema = string_schema(["_" + a for a in attributes] +
                           [f for f in fields if f not in attributes])
    parsed = df.select(F.from_xml(F.col(column), schema).alias("_x"))
    return parsed.select(*[F.col("_x._" + a).alias(a) for a in attributes],
                         *[F.col("_x." + f).alias(f) for f in fields if f not in attributes])


def write_xml_files(df: DataFrame, path: str, row_tag: str, root_tag: str,
                    file_col: str | None = None, mode: str = "overwrite") -> None:
    """Write records as XML documents, not indented.

    With ``file_col`` the files of each of its values are named after it
    (``<value>-<n>.xml``), in one folder; it has few values.  A task keeps the
    files of up to ``OPEN_FILES`` values open, and sorts only if it has more.
    """
    w = df.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag).option("indent", "").mode(mode)
    if not file_col:
        w.save(path)
        return
    spark = df.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    parts = scratch_dir(spark, "xml-parts")
    kept = spark.conf.get(OPEN_FILES_CONF)
    spark.conf.set(OPEN_FILES_CONF, str(max(int(kept), OPEN_FILES)))
    try:
        w.mode("errorifexists").partitionBy(file_col).save(parts)
    finally:
        spark.conf.set(OPEN_FILES_CONF, kept)
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "overwrite":
        fs.delete(jvm_path(path), True)
    fs.mkdirs(jvm_path(path))
    for n, part in enumerate(fs.globStatus(jvm_path(f"{parts}/{file_col}=*/part-*"))):
        value = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), jvm_path(f"{path}/{value}-{n:05d}.xml"))
