"""Document fingerprints: bottom-k sketches of shingle hashes [native].

A sketch is the ascending array of the ``K`` smallest distinct 64-bit hashes of
a text's word shingles (all of them, if fewer).  Sketches of the parts of a text
or of a corpus merge into the sketch of the whole, and two of them estimate
resemblance and containment; one estimates its number of distinct shingles.
Everything here is DataFrame functions over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.operators.keys import dense_ids

#: Hashes of a sketch (a resemblance of one half has a standard error of 0.044) and words of a shingle.
K, WORDS = 128, 5
#: Parts in which the hashes of one group are merged first.
SALTS = 32

#: White space between words.
_SPACE = r"[\x20\x09-\x0D]+"


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (a bound variable)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Sketch of a text: hashes (XXH64 of the words in a row, seed 42) of its
    shingles of ``words`` words, lower-cased in no way.  A text with fewer
    words is one shingle; one without words has the empty sketch, and so has a
    null text."""
    cut = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE, -1), lambda w: w != "")

    def hashes(ws: Column) -> Column:
        last = F.greatest(F.size(ws) - words, F.lit(0))
        return F.when(F.size(ws) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(words)])))

    return smallest(_with(cut, hashes), k)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of both shingle sets."""
    return smallest(F.concat(a, b), k)


def merge_groups(rows: DataFrame, group: str, sketch_col: str, k: int = K) -> DataFrame:
    """(group, sketch): the merged sketch of each group's rows (equal texts
    and null groups included; a null or empty sketch adds nothing).

    Hashes travel as rows; the k smallest of each group are taken per task
    before the shuffle, then per salted part, then of all parts, so a group
    with a third of all rows never meets in one task."""
    flat = rows.select(F.col(group).alias("g"), F.explode_outer(sketch_col).alias("h"))
    hashes = flat.filter("h is not null").select("g", "h", F.pmod("h", F.lit(SALTS)).alias("salt")).distinct()
    rank = F.row_number().over(Window.partitionBy("g", "salt").orderBy("h"))
    part = hashes.withColumn("r", rank).filter(F.col("r") <= k)
    best = part.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h"))).filter(F.col("r") <= k)
    # k hashes a group at most.
    merged = best.groupBy("g").agg(F.sort_array(F.collect_list("h")).alias("s"))
    groups = rows.select(F.col(group).alias("g")).distinct()
    return (groups.alias("x").join(merged.alias("y"), F.col("x.g").eqNullSafe(F.col("y.g")), "left")
            .select(F.col("x.g").alias(group), F.coalesce("y.s", F.array().cast("array<bigint>")).alias("sketch")))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    share = (F.element_at(s, k).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / F.greatest(share, F.lit(2.0 ** -64)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets: the share of both
    sketches' k smallest hashes that is in both.  Two empty ones: 1."""
    return _with(merge(a, b, k), lambda u: F.when(F.size(u) == 0, 1.0).otherwise(
        F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds (0 to 1; 1 if
    ``a`` has none)."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def as_text(s: Column) -> Column:
    """The sketch as a string: 16 hex digits a hash, ascending (negative first)."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def from_text(s: Column) -> Column:
    """The sketch that ``as_text`` wrote."""
    n = F.length(s) / 16

    def value(i: Column) -> Column:  # two halves, as a signed long has no unsigned parse
        high, low = F.conv(F.substring(s, i * 16 + 1, F.lit(8)), 16, 10), F.conv(F.substring(s, i * 16 + 9, F.lit(8)), 16, 10)
        return F.shiftleft(high.cast("long"), 32).bitwiseOR(low.cast("long"))

    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n.cast("int") - 1), value))


def neighbours(docs: DataFrame, id_col: str) -> DataFrame:
    """(id, chars, next): each distinct id with the next one in descending
    order; after the last comes the first.  ``docs`` has (id_col, chars), of
    which the largest per id holds.  Only ids are numbered and moved."""
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.max("chars").alias("chars"))
    ranked = dense_ids(ids, ["id"], "rank", tie_breaker="id")
    below = ranked.select((F.col("rank") + 1).alias("rank"), F.col("id").alias("below"))
    top = ranked.select(F.max(F.struct("rank", "id"))["id"].alias("top")).scalar()
    return (ranked.join(below, "rank", "left")
            .select("id", "chars", F.when(F.col("rank") == 1, top).otherwise(F.col("below")).alias("next")))


def _key(value: Column, name: str = "") -> list[Column]:
    """A null-safe join key as two columns without nulls, so that groups and
    joins by it are dealt alike and share a shuffle."""
    start = name and name + "_"
    return [F.coalesce(value, F.lit(0)).alias(start + "key"), value.isNull().alias(start + "none")]


def edit_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """(id, text, edited, next_sketch) for every row of ``docs``.

    ``edited`` is the text whose last third (code points, rounded down) gives
    way to the first as many code points (all, if fewer) of the next document
    in descending order of ids; after the smallest id comes the largest.

    A null text is empty.  A null id counts as an id below all others.  Rows
    that share an id are one document to the one before it, which takes the
    text with the smallest SHA-256 of theirs; each row is returned.  A single
    document is its own next one.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    # The same columns on both sides of what follows, so that the texts are shuffled once.
    rows = docs.select(*_key(F.col(id_col)), text)
    ring = neighbours(docs.select(F.col(id_col).alias("id"), F.length(text).alias("chars")), "id")
    ring = ring.select(*_key(F.col("next")), *_key(F.col("id"), "owner"), "chars")
    given = rows.join(ring, ["key", "none"]).select(
        "owner_key", "owner_none", F.struct(
            F.unhex(F.sha2("text", 256)).alias("sha"), F.expr("substring(text, 1, cast(chars div 3 as int))").alias("head"),
            sketch(F.col("text"), k, words).alias("sketch")).alias("next"))
    # One row for each id, unless ids repeat: then the tasks keep the least before the shuffle.
    given = given.groupBy(F.col("owner_key").alias("key"), F.col("owner_none").alias("none")).agg(F.min("next").alias("next"))
    third = F.expr("cast(length(text) div 3 as int)")
    kept = F.substring("text", F.lit(1), F.length("text") - third)
    return (rows.join(given, ["key", "none"])
            .select(F.when(~F.col("none"), F.col("key")).alias("id"), "text", F.concat(kept, F.substring(F.col("next.head"), F.lit(1), third)).alias("edited"),
                    F.col("next.sketch").alias("next_sketch")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """One row for each row of ``docs``: id_col, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next (resemblance to
    the edited text and to the next document), n_shingles (estimated) and
    in_edited (containment in the edited text).  ``edit_documents`` says what
    the edited text is and how nulls, repeated rows and empty tables count."""
    rows = edit_documents(docs, id_col, text_col, k, words)
    own = rows.select("id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "next_sketch",
                      F.struct(sketch(F.col("text"), k, words).alias("a"), sketch(F.col("edited"), k, words).alias("b")).alias("s"))

    def result(s: Column) -> Column:
        return F.struct(as_text(s["a"]).alias("fingerprint"), as_text(s["b"]).alias("edited_fingerprint"),
                        resemblance(s["a"], s["b"], k).alias("near_edited"), resemblance(s["a"], F.col("next_sketch"), k).alias("near_next"),
                        distinct_shingles(s["a"], k).alias("n_shingles"), containment(s["a"], s["b"], k).alias("in_edited"))

    return (own.select("id", "n_chars", "edited_sha256", F.inline(F.transform(F.array("s"), result)))
            .withColumnRenamed("id", id_col))
