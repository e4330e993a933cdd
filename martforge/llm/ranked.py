"""Ranked lexical search, reversed: the items' terms are the index, documents stream through it.

The items' terms form a small inverted index (term -> items) that goes to every
task.  A first pass counts, over all documents, what the weights need; a second
one sends each document's term counts through the index, adds up its score for
every item it meets, and keeps the best few documents of each item in a bounded
heap.  The tasks' heaps are merged by windows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import stage

#: Bytes of an index block (each (item, term) pair counts 32 and its term); an
#: item that alone is larger is a block by itself.
BLOCK = 1 << 24
#: Cells of the documents x items score table that a task fills at once, and
#: additions to it after which the table is read (one document adds no more
#: than the block has pairs).
CELLS, ADDED = 1 << 20, 1 << 20
#: Parts in which the tasks' heaps are merged first.
SALTS = 16

#: Term bytes map to themselves (A-Z to a-z), all other ASCII bytes to a blank.
#: UTF-8 bytes of other characters are term bytes, so this cuts as code points do.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.translate(_TABLE).split()


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term) pairs, once each, of items with an id; rows that share an
    id are one item."""
    kind = items.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            of = np.repeat(np.arange(len(cut)), [len(x) for x in cut])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array([t for x in cut for t in x], pa.binary())], ["item", "term"])

    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(run, T.StructType([T.StructField("item", kind), T.StructField("term", T.BinaryType())])).distinct()


def _blocks(pairs: DataFrame, limit: int) -> Iterator[pa.Table]:
    """The pairs of one block of items after the other, sorted; blocks follow
    a hash of the item, so a block's items don't depend on the rows' order."""
    size = pairs.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    n = max(1, -(-size // limit))
    for i in range(n):
        got = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == i).toArrow().sort_by([("item", "ascending"), ("term", "ascending")])
        if got.num_rows:
            yield got


class Index:
    """Inverted index of a block: term number by term, and the items of each
    term (numbers into ``items``) as one array cut by ``at``."""

    def __init__(self, block: pa.Table):
        items = block.column("item").combine_chunks().dictionary_encode()
        self.items = items.dictionary
        names = block.column("term").to_pylist()
        self.number = {t: i for i, t in enumerate(sorted(set(names)))}
        of = np.fromiter((self.number[t] for t in names), np.int64, len(names))
        order = np.argsort(of, kind="stable")
        self.posting = items.indices.to_numpy(zero_copy_only=False).astype(np.int64)[order]
        self.at = np.searchsorted(of[order], np.arange(len(self.number) + 1))


def _statistics(texts: DataFrame, number) -> DataFrame:
    """(term, n) over all documents: documents holding each numbered term; -1:
    documents with any term; -2: all terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, holders, docs, total = number.value, Counter(), 0, 0
        names = known.keys()
        for batch in batches:
            for text in batch.column("t"):
                found = terms(text.as_py())
                total += len(found)
                docs += bool(found)
                holders.update(names & set(found))
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *(known[t] for t in holders)], pa.int64()),
                                          pa.array([docs, total, *holders.values()], pa.int64())], ["term", "n"])

    return texts.select("t").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Heaps:
    """The best ``k`` documents of each item so far: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.zeros(items, np.int64)  # score of an item's last place, once all are taken

    def update(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        fit = score >= np.maximum(self.least[item], 1)
        if not fit.any():
            return
        item, doc, score = (np.concatenate(x) for x in ((self.item, item[fit]), (self.doc, doc[fit]), (self.score, score[fit])))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        starts = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        keep = place < self.k
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]


def _scores(texts: DataFrame, index, weight, docs: int, total: int, k: int, kind: T.DataType) -> DataFrame:
    """(item, doc_id, score): the heaps of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, w = index.value, weight.value
        number, names = ix.number, ix.number.keys()
        width, sizes = len(ix.items), np.diff(ix.at).tolist()
        heaps, room = _Heaps(width, k), max(1, CELLS // width)

        def push(ids: list, rows: list, held: list, value: list) -> None:
            row, term, v = (np.array(x, np.int64) for x in (rows, held, value))
            start, size = ix.at[term], ix.at[term + 1] - ix.at[term]
            each = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
            cell = np.repeat(row, size) * width + ix.posting[each]
            table = np.zeros(len(ids) * width, np.int64)
            np.add.at(table, cell, np.repeat(v, size))
            at = np.flatnonzero(table)
            heaps.update(at % width, np.array(ids, np.int64)[at // width], table[at])

        for batch in batches:
            ids, rows, held, value, added = [], [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                tf = Counter(found)
                m8 = 8 * (10 + (90 * len(found) * docs) // total) if found else 0
                for t in names & tf.keys():
                    c, i = tf[t], number[t]
                    rows.append(len(ids))
                    held.append(i)
                    value.append(w[i] * ((1_000_000_000 * c) // (1000 * c + m8)))
                    added += sizes[i]
                ids.append(doc)
                if len(ids) == room or added >= ADDED:
                    push(ids, rows, held, value)
                    ids, rows, held, value, added = [], [], [], [], 0
            push(ids, rows, held, value)
        yield pa.RecordBatch.from_arrays([ix.items.take(pa.array(heaps.item)), pa.array(heaps.doc), pa.array(heaps.score)], ["item", "doc", "score"])

    return texts.mapInArrow(run, T.StructType([T.StructField("item", kind), T.StructField("doc", T.LongType()), T.StructField("score", T.LongType())]))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """The ``k`` best documents of each item: (item_col, rank from 1, id_col
    long, score long), highest score first, equal scores by ascending id.

    A term is a longest run of letters, digits and non-ASCII characters, A-Z
    lower-cased.  N documents hold any term, L is all their terms, n those of
    one document, df the documents that hold a term, tf its occurrences.  The
    weight w of a term is floor(1000 * ln((2N + 2) / (2df + 1))), m of a
    document is 10 + (90 n N) div L, its score the sum of
    w * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, once each.

    Only scores above 0 are returned.  A null text has no terms.  A row with a
    null id takes no part, on either side.  Rows of ``items`` that share an id
    are one item; each row of ``docs`` is a document, a repeated one again.
    Items without terms, or empty tables, give no rows.  A block of ``block``
    bytes is broadcast at a time, so the index in a task has a fixed bound;
    each block reads the documents twice.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType
    texts = (docs.filter(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t")))
    sc, heaps = spark.sparkContext, None
    for got in _blocks(stage(_item_terms(items, item_col, item_text), "search-terms"), block):
        index = Index(got)
        number = sc.broadcast(index.number)
        counts = dict(_statistics(texts, number).toArrow().to_pandas().itertuples(index=False, name=None))
        number.unpersist()
        n, total = int(counts.get(-1, 0)), int(counts.get(-2, 0))
        if not n:
            break
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(counts.get(i, 0)) + 1))) for i in range(len(index.number))]
        sent = sc.broadcast(index), sc.broadcast(weight)
        best = stage(_scores(texts, *sent, n, total, k, kind), "search-heaps")
        for b in sent:
            b.unpersist()
        heaps = best if heaps is None else heaps.unionByName(best)
    if heaps is None:
        return spark.createDataFrame([], T.StructType([T.StructField(item_col, kind), T.StructField("rank", T.IntegerType()),
                                                       T.StructField(id_col, T.LongType()), T.StructField("score", T.LongType())]))
    order = [F.desc("score"), F.asc("doc")]
    part = heaps.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    part = part.withColumn("r", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("r") <= k)
    last = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return last.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
