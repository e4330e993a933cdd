"""Person records -> cleaned reign table, lineage, reign segments, timeline.

Input rows hold scraped text: ``Name`` (name, footnotes and a reign date
range), ``Birth``, ``Death`` (text with a year) and ``Claim`` (``Son of X``;
missing for tables without that column).  ``row_index`` gives their order.

Cleaning (``clean_people``) is built-in Spark expressions only (see
``functions.clean``).  Position-based edits -- dropping rows by position
(W4) and point corrections (P14) -- are joins with small override tables.
The sort by reign start (O4) numbers rows with ``keys.dense_ids``.

Lineage (J9): a child's parent is the lowest-numbered row whose name
contains the child's claim, case-insensitively (self allowed).  That is a
substring ("theta") join.  It is computed exactly, without a nested-loop join
and without pairs, by a sweep over claims and name suffixes in text order (see
``lineage``).  The result is identical to a full containment scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.functions import clean as C
from martforge.operators import keys as K
from martforge.operators import ranges as RG
from martforge.session import scratch_dir

KEYS = 4  # pieces of seven bytes by which the lineage sweep may split ranges of texts

# Fixed values of the source cleaning: row positions dropped as invalid and
# point corrections, as (row position, column, value).
SOURCE_REJECT_POSITIONS = [18, 25, 48]
SOURCE_OVERRIDES = [
    (0, "Name", "Alfred the Great"),
    (29, "dates", "1307 – 1327"),
    (3, "dates", "927 – 939"),
    (10, "Claim", None),
    (45, "Claim", "spouse"),
]
FIRST_REIGN = "(1st reign)"
SECOND_REIGN_PREFIX = "(2nd reign) "


# ------------------------------------------------------------- row edits

def reject_rows(df: DataFrame, positions: DataFrame | Sequence[int],
                index_col: str = "row_index") -> DataFrame:
    """Drop rows at the given positions, then renumber 0..n-1."""
    spark = df.sparkSession
    if not isinstance(positions, DataFrame):
        positions = spark.createDataFrame([(int(p),) for p in positions], f"{index_col} long")
    kept = df.join(positions.select(index_col).distinct(), index_col, "left_anti")
    return renumber(kept, [index_col], index_col)


def renumber(df: DataFrame, order_cols: Sequence, index_col: str = "row_index") -> DataFrame:
    """Dense 0-based positions in ``order_cols`` order (distributed)."""
    tmp = "_renum"
    out = K.dense_ids(df, order_cols, tmp, offset=-1)
    return out.drop(index_col).withColumnRenamed(tmp, index_col) if index_col in df.columns \
        else out.withColumnRenamed(tmp, index_col)


def point_overrides(df: DataFrame, overrides: DataFrame, index_col: str = "row_index") -> DataFrame:
    """Set ``df[column][row] = value`` for rows of an override table.

    ``overrides`` has (row_index, column, value, is_null); ``is_null`` marks a
    correction TO null (a plain null value would mean "no correction").
    Columns are text.  The corrections of a row become one map, so there is
    one left join, whatever the columns; of several corrections of a cell one
    (the largest value, null last) holds.
    """
    fix = F.struct(F.col("value").alias("v"), F.coalesce(F.col("is_null"), F.lit(False)).alias("n"))
    per_cell = overrides.groupBy(index_col, "column").agg(F.max(fix).alias("f"))
    per_row = per_cell.groupBy(index_col).agg(F.map_from_entries(F.collect_list(F.struct("column", "f"))).alias("_ov"))
    out = df.join(per_row, index_col, "left")
    text = [f.name for f in df.schema.fields if f.name != index_col and f.dataType.simpleString() == "string"]
    for c in text:
        f = F.try_element_at("_ov", F.lit(c))
        out = out.withColumn(c, F.when(f["n"], F.lit(None).cast("string")).otherwise(F.coalesce(f["v"], F.col(c))))
    return out.drop("_ov")


def overrides_frame(spark, rows: Sequence[tuple]) -> DataFrame:
    """(row, column, value) tuples -> override table; value None = set null."""
    data = [(int(r), c, v, v is None) for r, c, v in rows]
    return spark.createDataFrame(data, "row_index long, column string, value string, is_null boolean")


# ---------------------------------------------------------------- cleaning

def clean_people(df: DataFrame, keep_digit: bool = False) -> DataFrame:
    """F1-F11 on (row_index, Name, Birth, Death, Claim)."""
    name0 = C.strip_footnotes("Name")
    name, desc = C.name_desc_split(name0, keep_digit)
    out = df.select("row_index", C.dedupe_words(name).alias("Name"), desc.alias("desc"),
                    "Birth", "Death", "Claim")
    out = out.withColumn("dates", C.date_range_extract("desc"))
    return out


def finish_people(df: DataFrame) -> DataFrame:
    """Second half of cleaning, after date overrides: years and claims."""
    dates = C.drop_day_month("dates")
    start, end = C.reign_bounds(dates)
    claim = C.claim_of("Claim")
    return df.select(
        "row_index", "Name", "desc", dates.alias("dates"),
        start.alias("start"), end.alias("end"),
        C.year_extract("Birth").alias("Birth"), C.year_extract("Death").alias("Death"),
        C.glued_name_cut(C.claim_parent(claim)).alias("Claim"),
        C.claim_relation(claim).alias("ClaimRelation"))


def monarch_clean(raw: DataFrame, rejects: Sequence[int] = (),
                  early_overrides: DataFrame | None = None,
                  late_overrides: DataFrame | None = None) -> DataFrame:
    """Raw person rows -> cleaned rows sorted by reign start (``idx``).

    ``early_overrides`` apply to Name / dates before the date parsing,
    ``late_overrides`` to Claim after the claim parsing (as in the source).
    """
    rows = reject_rows(raw, rejects) if rejects else raw
    c = clean_people(rows)
    if early_overrides is not None:
        c = point_overrides(c, early_overrides)
    c = finish_people(c)
    if late_overrides is not None:
        c = point_overrides(c, late_overrides)
    return sort_people(c)


def sort_people(df: DataFrame) -> DataFrame:
    """Order by reign start (missing last), ties by row position -> idx."""
    out = K.dense_ids(df, [F.col("start").asc_nulls_last(), F.col("row_index").asc()],
                      "idx", offset=-1, tie_breaker="row_index")
    return out


# ----------------------------------------------------------------- lineage

def _suffixes(people: DataFrame, idx: str, name: str, longest: int) -> DataFrame:
    """(text, p_idx): the distinct suffixes of the lower-cased names, cut to
    ``longest`` characters, each with the lowest row that has it."""
    n = F.lower(F.col(name))
    names = (people.select(n.alias("n"), F.col(idx).alias("p_idx")).where(F.length("n") > 0)
             .groupBy("n").agg(F.min("p_idx").alias("p_idx")))
    cut = F.transform(F.sequence(F.lit(1), F.length("n")), lambda i: F.substring(F.col("n"), i, F.lit(longest)))
    return names.select(F.explode(cut).alias("text"), "p_idx").groupBy("text").agg(F.min("p_idx").alias("p_idx"))


def _text_keys(text: Column) -> dict[str, Column]:
    """Whole numbers that order texts as their bytes do, seven bytes each."""
    return {f"_k{i}": F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 7 * i + 1, 7)), 14, "0"), 16, 10).cast("long") for i in range(KEYS)}


def lineage(people: DataFrame, idx: str = "idx", name: str = "Name", claim: str = "Claim",
            earlier_only: bool = False) -> DataFrame:
    """(child idx, parent idx) -- lowest row whose name contains the claim.

    Exact (equal to a full containment scan) and in one sorted pass, with no
    (claim, name) pairs.  A name contains a claim if one of its suffixes starts
    with it, and in text order those suffixes follow the claim directly, with
    only longer claims that start with it, and their suffixes, among them.  So
    the distinct claims and the distinct suffixes of the names are dealt to
    ranges of texts and sorted; each suffix sees the last claim before it
    (carried into a range from the ranges before), and starts with just those
    claims that are beginnings of what both have in common.  The lowest row of
    each common beginning, cut to a length that some claim has, is then passed
    on to its own beginnings of such lengths.

    Rows that move: one per distinct suffix, a few per distinct claim.  Equal
    suffixes (a third of the names may end alike) are merged before they move,
    and ranges split any common beginning.  Null and empty claims have no
    parent.  ``earlier_only`` restricts parents to rows before the child.
    """
    spark = people.sparkSession
    children = (people.select(F.col(idx).alias("c_idx"), F.lower(F.col(claim)).alias("c_claim"))
                .where(F.length("c_claim") > 0))
    claims = children.select(F.col("c_claim").alias("text")).distinct()
    # Distinct lengths of claims: a short list of small integers.
    lengths = sorted(r[0] for r in children.select(F.length("c_claim")).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], "child_idx long, parent_idx long")
    sizes = F.array(*[F.lit(n) for n in lengths])
    path = scratch_dir(spark, "name-suffixes")
    _suffixes(people, idx, name, lengths[-1]).write.parquet(path)
    suffixes = spark.read.parquet(path)

    keys = _text_keys(F.col("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = RG.range_bounds(suffixes.withColumns(keys), list(keys), parts)

    def dealt(df: DataFrame) -> DataFrame:
        keyed = df.withColumns(keys)
        return keyed.withColumn("part", RG.range_number(keyed, list(keys), bounds)).drop(*keys)

    opened = dealt(claims)
    # One row per range: the last claim of all ranges before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = opened.groupBy("part").agg(F.max("text").alias("text"))
    carried = (spark.range(len(bounds) + 1).select(F.col("id").cast("int").alias("part")).join(last, "part", "left")
               .select(F.last("text", ignorenulls=True).over(before).alias("text"), "part").where("text is not null"))
    no_row = F.lit(None).cast(suffixes.schema["p_idx"].dataType)
    swept = opened.unionByName(carried).withColumn("p_idx", no_row).unionByName(dealt(suffixes))
    upto = (Window.partitionBy("part").orderBy(F.col("text"), F.col("p_idx").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    claim = F.last(F.when(F.col("p_idx").isNull(), F.col("text")), ignorenulls=True).over(upto)
    met = swept.withColumn("claim", claim).where("p_idx is not null and claim is not null")
    common = F.array_max(F.filter(sizes, lambda n: (n <= F.length("claim")) & F.startswith(F.col("text"), F.substring(F.col("claim"), F.lit(1), n))))
    begins = (met.select("p_idx", F.substring("claim", F.lit(1), common).alias("begin")).where("begin is not null")
              .groupBy("begin").agg(F.min("p_idx").alias("p_idx")))
    heads = F.filter(sizes, lambda n: n <= F.length("begin"))
    lowest = (begins.select("p_idx", F.explode(F.transform(heads, lambda n: F.substring(F.col("begin"), F.lit(1), n))).alias("c_claim"))
              .groupBy("c_claim").agg(F.min("p_idx").alias("parent_idx")))
    edges = children.join(lowest, "c_claim").select(F.col("c_idx").alias("child_idx"), "parent_idx")
    return edges.where("parent_idx < child_idx") if earlier_only else edges


# ------------------------------------------------------------ second reigns

def second_reign(people: DataFrame, idx: str = "idx", literal: bool = False) -> DataFrame:
    """Pair a ``(1st reign) X`` row with the ``(2nd reign) X`` row.

    ``X`` is the name stripped of the CHARACTER SET ``(1st reign)`` at both
    ends, as the source does (``Stephen`` -> ``Steph``, which then finds no
    partner); ``literal=True`` strips the exact prefix instead.  Only rows
    with a non-zero life after the first reign are considered, as in the
    source (an unknown life after it is not zero, like ``NaN != 0``).  Output (idx, partner_idx) for the first partner found (lowest
    index).
    """
    firsts = (people.where(F.contains(F.col("Name"), F.lit(FIRST_REIGN))
                           & F.coalesce((F.col("Death") - F.col("end")) != 0, F.lit(True)))
              .select(F.col(idx).alias("idx"),
                      F.concat(F.lit(SECOND_REIGN_PREFIX),
                               C.char_set_trim("Name", FIRST_REIGN, literal)).alias("_key")))
    # One row per name on the partner side (its lowest index): the join then
    # emits at most one row per first-reign row, whatever the name counts.
    seconds = (people.groupBy(F.col("Name").alias("_key"))
               .agg(F.min(F.col(idx)).alias("partner_idx")))
    return firsts.join(seconds, "_key").select("idx", "partner_idx")


# ----------------------------------------------------------------- segments

def reign_segments(people: DataFrame, pairs: DataFrame | None = None,
                   idx: str = "idx") -> DataFrame:
    """One row per bar: before / reign / [between / reign2] / after.

    Rows that are the second reign of a pair are skipped (W6).  A zero-width
    ``after`` bar is dropped.  With a second reign the bars are before,
    reign, between (start2 - end1), reign2, after (death - end2).
    """
    p = people.select(F.col(idx).alias("idx"), "Birth", "Death", "start", "end")
    if pairs is None:
        pairs = second_reign(people, idx)
    skip = pairs.select(F.col("partner_idx").alias("idx"))
    second = p.select(F.col("idx").alias("partner_idx"), F.col("start").alias("start2"),
                      F.col("end").alias("end2"))
    rows = (p.join(skip, "idx", "left_anti")
            .join(pairs, "idx", "left")
            .join(second, "partner_idx", "left"))
    has2 = F.col("partner_idx").isNotNull()

    def seg(no, kind, length, keep):
        return F.named_struct(F.lit("seg_no"), F.lit(no), F.lit("kind"), F.lit(kind),
                              F.lit("length"), length.cast("int"), F.lit("keep"), keep)

    after_end = F.when(has2, F.col("end2")).otherwise(F.col("end"))
    segs = F.array(
        seg(0, "before", F.col("start") - F.col("Birth"), F.lit(True)),
        seg(1, "reign", F.col("end") - F.col("start"), F.lit(True)),
        seg(2, "between", F.col("start2") - F.col("end"), has2),
        seg(3, "reign", F.col("end2") - F.col("start2"), has2),
        seg(4, "after", F.col("Death") - after_end,
            F.coalesce(F.col("Death") - after_end != 0, F.lit(True))))
    out = rows.select("idx", F.inline(segs))
    return out.where("keep").drop("keep")


# ----------------------------------------------------------------- timeline

def year_span(people: DataFrame) -> DataFrame:
    """Min birth, max death and the drawing span (+20)."""
    return people.agg(F.min("Birth").alias("min_birth"), F.max("Death").alias("max_death")) \
        .withColumn("date_range", F.col("max_death") - F.col("min_birth") + F.lit(20))


def _first_birth(people: DataFrame, idx: str) -> Column:
    return people.where(F.col(idx) == 0).select(F.max("Birth")).scalar()


def year_grid(people: DataFrame, first_century: int | None = None, idx: str = "idx") -> DataFrame:
    """Century lines and 25-year marks, x relative to the first birth.

    Centuries ``first_century .. first_century + round(span / 100)`` (Python
    rounds half to even: ``bround``); within each, marks at +25, +50 (the
    labelled one) and +75.  The first century is that of the earliest birth
    (8 for the source's own persons, who are born from 847 on); no known
    birth or death gives no rows.
    """
    span = year_span(people).where(F.col("date_range").isNotNull())
    low = F.floor(F.col("min_birth") / F.lit(100)).cast("int") if first_century is None else F.lit(first_century)
    hi = low + F.bround(F.col("date_range") / F.lit(100)).cast("int")
    centuries = span.select(F.explode(F.sequence(low, hi)).alias("c"))
    marks = centuries.select(F.explode(F.array(*[
        F.named_struct(F.lit("year"), F.col("c") * 100 + F.lit(25 * j),
                       F.lit("kind"), F.lit(k))
        for j, k in ((0, "century"), (1, "quarter"), (2, "half"), (3, "quarter"))])).alias("m"))
    b0 = _first_birth(people, idx)
    return marks.select(F.col("m.year").alias("year"), F.col("m.kind").alias("kind"),
                        (F.col("m.year") - b0).cast("int").alias("x"))


def timeline_layout(people: DataFrame, idx: str = "idx", height: int = 600,
                    lane_step: int = 10, margin: int = 10,
                    pairs: DataFrame | None = None) -> DataFrame:
    """x = birth - first birth + margin, lane y = height - step * idx.

    The second reign of a pair is drawn on the first one's lane and gets none
    of its own (W6)."""
    b0 = _first_birth(people, idx)
    pairs = second_reign(people, idx) if pairs is None else pairs
    drawn = people.join(pairs.select(F.col("partner_idx").alias(idx)), idx, "left_anti")
    return drawn.select(F.col(idx).alias("idx"),
                         (F.col("Birth") - b0 + F.lit(margin)).cast("long").alias("x"),
                         (F.lit(height) - F.lit(lane_step) * F.col(idx)).cast("long").alias("lane"))


def lineage_edges(people: DataFrame, idx: str = "idx", height: int = 600,
                  lane_step: int = 10, margin: int = 10) -> DataFrame:
    """Lineage with both lanes and the parent's x, for drawing; no edge
    from or to the second reign of a pair (W6)."""
    layout = timeline_layout(people, idx, height, lane_step, margin)
    edges = lineage(people, idx)
    child = layout.select(F.col("idx").alias("child_idx"), F.col("lane").alias("child_lane"))
    parent = layout.select(F.col("idx").alias("parent_idx"), F.col("x").alias("parent_x"),
                           F.col("lane").alias("parent_lane"))
    return edges.join(child, "child_idx").join(parent, "parent_idx") \
        .select("child_idx", "parent_idx", "child_lane", "parent_lane", "parent_x")


def lineage_token_blocked(people: DataFrame, idx: str = "idx", name: str = "Name",
                          claim: str = "Claim") -> DataFrame:
    """Opt-in approximation of ``lineage``: candidates share the claim's FIRST
    WORD as a whole word of the name, then ``contains`` is verified.

    Cheaper on long names, but a claim found only inside a word (``ed`` in
    ``alfred``) is missed; ``lineage`` is the exact form.
    """
    word = r"[^\p{L}\p{N}]+"
    names = people.select(F.col(idx).alias("p_idx"), F.lower(F.col(name)).alias("p_name"))
    tokens = names.select("p_idx", "p_name",
                          F.explode(F.array_distinct(F.split("p_name", word))).alias("tok"))
    claims = (people.select(F.col(idx).alias("c_idx"), F.lower(F.col(claim)).alias("c_claim"))
              .where(F.col("c_claim").isNotNull() & (F.length("c_claim") > 0))
              .withColumn("tok", F.get(F.filter(F.split("c_claim", word),
                                                lambda t: t != F.lit("")), 0)))
    pairs = (claims.join(tokens.where(F.col("tok") != ""), "tok")
             .where(F.contains(F.col("p_name"), F.col("c_claim"))))
    return (pairs.groupBy("c_idx").agg(F.min("p_idx").alias("parent_idx"))
            .select(F.col("c_idx").alias("child_idx"), "parent_idx"))
