"""Filter interaction audit: what each filter removes under every order of filters.

Each text becomes a mask with one bit for each filter that it fails.  Rows are
counted by part and mask (32 cells a part at most), and only those cells meet
the orders: a cell folds over the broadcast array of all orders with
higher-order functions, giving one weighted struct for each step of each order,
and the cells of a part are merged by elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filters, in the order of the mask's bits (lowest first).
LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
#: Counts of a step, in the order of the result's columns.
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]

#: White space between words.
_SPACE = r"[\x20\x09-\x0D]+"


def text_mask(text: Column) -> Column:
    """Bits of the conditions A to D that a text fails (not null).

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals
    A-Z > 5 * code points; D: holds any of ``#$%&*|``.
    """
    words = F.filter(F.split(text, _SPACE, -1), lambda w: w != "")

    def of(ws: Column) -> Column:
        n, distinct = F.size(ws), F.size(F.array_distinct(ws))
        return (n < 50).cast("int") + (100 * distinct.cast("long") < 65 * n.cast("long")).cast("int") * 2

    # The array is bound once, so that the text is split once.
    by_words = F.element_at(F.transform(F.array(words), of), 1)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return (by_words + (100 * capitals > 5 * F.length(text).cast("long")).cast("int") * 4
            + F.rlike(text, F.lit(r"[#$%&*|]")).cast("int") * 8)


def mask_cells(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part by the filters they fail.

    Condition E (16): the text is that of a row with a smaller id anywhere in
    the table.  Texts are compared by SHA-256.  Copies are aggregated before
    they are shuffled: of each text only (part, labels, n, smallest id) moves,
    so a text held by a third of all rows is one small group.

    A null text is empty, a null part the empty string.  A null id is smaller
    than no id and larger than none: such a row never fails E, makes no other
    row fail it, and has no labels.  Rows with equal ids don't make each other
    fail E; each row counts, repeated ones too.  If ``labels`` repeats an id, a
    quality or toxic of 1 in any of its rows holds.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")))
    # Repeated rows first: then one row holds all that share an id and a text.
    single = rows.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marked = single.join(marks, "id", "left").select("id", "part", "mask", "digest", "n", F.coalesce("good", F.lit(0)).alias("good"),
                                                      F.coalesce("toxic", F.lit(0)).alias("toxic"))
    known = F.col("id").isNotNull()
    group = (marked.groupBy("digest", "part", "mask", "good", "toxic")
             .agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown"),
                  F.min(F.when(known, F.struct("id", "n"))).alias("least")))
    first = group.groupBy("digest").agg(F.min("least.id").alias("first"))
    # Rows with the text's smallest id, or with none, pass E.
    free = F.col("unknown") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = group.join(first, "digest").withColumn("free", free)
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("free").alias("n")),
                   F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("free")).alias("n")))
    return (split.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
            .groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                         F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def _steps(mask: Column, n: Column, good: Column, toxic: Column, orders: Column) -> Column:
    """600 structs of ``COUNTS``, one for each step of each order: a fold over
    an order's bits carries whether the cell's rows are still there."""
    zero = F.lit(0).cast("long")

    def fold(order: Column) -> Column:
        start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<{','.join(c + ':bigint' for c in COUNTS)}>>").alias("out"))

        def step(state: Column, bit: Column) -> Column:
            fails = mask.bitwiseAND(bit) != 0
            alive, stays, goes = state["alive"], state["alive"] & ~fails, state["alive"] & fails
            row = F.struct(F.when(stays, n).otherwise(zero).alias("kept"), F.when(goes, n).otherwise(zero).alias("removed"),
                           F.when(~alive & fails, n).otherwise(zero).alias("redundant"), F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
                           F.when(goes, good).otherwise(zero).alias("good_lost"), F.when(goes, toxic).otherwise(zero).alias("toxic_lost"))
            return F.struct(stays.alias("alive"), F.concat(state["out"], F.array(row)).alias("out"))

        return F.aggregate(order, start, step, lambda s: s["out"])

    return F.flatten(F.transform(orders, fold))


def audit_filters(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order and step: part, filter_order, step (1 to 5) and
    long counts: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, and shapley, the step's filter's removals summed over all
    orders.  Zeros are included; an empty table has no parts, hence no rows.
    ``mask_cells`` says how nulls, ties and repeated rows count.
    """
    cells = mask_cells(docs, labels, part_col, id_col, text_col)
    # All orders as bits: a constant of the plan, which Spark broadcasts with the stage's task binary.
    orders = F.array(*[F.array(*[F.lit(1 << LETTERS.index(c)) for c in o]) for o in ORDERS])
    folded = cells.select("part", _steps(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic"), orders).alias("steps"))

    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))

    # A part has 32 cells at most, so the list has a fixed bound.
    lists = folded.groupBy("part").agg(F.collect_list("steps").alias("lists"))
    merged = lists.select("part", F.aggregate(F.slice("lists", 2, 32), F.element_at("lists", 1), add).alias("steps"))
    names = F.array(*[F.lit(o) for o in ORDERS])
    filters = F.array(*[F.lit(c) for o in ORDERS for c in o])
    one = F.array(*[F.lit(c) for c in LETTERS])
    totals = F.map_from_arrays(one, F.transform(one, lambda c: F.aggregate(
        F.zip_with(F.col("steps"), filters, lambda s, f: F.when(f == c, s["removed"]).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a + b)))
    flat = merged.select("part", totals.alias("totals"), F.posexplode("steps").alias("at", "s"))
    letter = F.element_at(filters, F.col("at") + 1)
    return flat.select("part", F.element_at(names, F.expr("at div 5").cast("int") + 1).alias("filter_order"),
                       (F.col("at") % 5 + 1).cast("int").alias("step"), *[F.col("s")[c].alias(c) for c in COUNTS],
                       F.element_at("totals", letter).alias("shapley"))
