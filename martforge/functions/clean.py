"""Column -> Column cleaning and parsing helpers.

All of them are built-in Spark expressions (JVM side, inside whole-stage
codegen); none needs Python at run time.  ANSI mode is on in Spark 4, so
every cast that can fail uses a ``try_`` form and yields null instead of
raising, like the lenient R / pandas conversions they replace.

Regex dialect notes: Java regexes treat ``\\w``, ``\\s`` and ``\\d`` as ASCII
unless the ``(?U)`` flag is set; Python 3 treats them as Unicode.  Patterns
ported from the Python cleaning therefore carry ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ------------------------------------------------------------ fixed values
# Patterns whose text must stay as given for results to match the source
# cleaning of person records (footnotes, name/description split, date range,
# day-and-month removal, years, claim relation and parent name, glued names).
FOOTNOTE_PATTERN = r"\[.*?\]"
NAME_DESC_SPLIT_PATTERN = r"\s\d|\[\d+\]"
DATE_RANGE_PATTERN = r"(\s*\d{3,4}\s*(?:–\s*\d{0,2}\s*\w*\s*\d{3,4})?)"
DAY_MONTH_PATTERN = r"\s+\d{0,2}\s+\w*\s+"
YEAR_PATTERN = r"(\d{3,4})"
CLAIM_OF_PATTERN = r"/.*?of"
CLAIM_RELATION_PATTERN = r"(\w*(?:-\w+)*(?:Son|Daughter))\s+"
CLAIM_PARENT_PATTERN = r"(?:Son|Daughter)\s+of\s+(\w+\s*(?:[IV]+|of\s+\w+|the\s+\w+)*)"
GLUED_NAME_PATTERN = r"(?<=[^ ])(?<![IV])([A-Z])(.*?)$"
RANGE_DASH = "–"  # U+2013 EN DASH separates the years of a range
US_DATE_PREFIX = r"^\s*(\d{1,2}/\d{1,2}/\d{1,4})"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -------------------------------------------------------- P2 - P8 (loading)

def strip_first(c, ch: str = "r") -> Column:
    """Remove only the FIRST occurrence of a literal character (R ``sub``)."""
    return F.regexp_replace(col_(c), "^([^" + ch + "]*)" + ch, "$1")


def lenient_int(c, to: str = "int") -> Column:
    """R ``as.integer`` on text: decimals truncate, junk / NaN / overflow -> null.

    Whole-number text converts exactly; other text goes through double.
    A failing ``try_cast`` throws inside and costs some ten times a fitting
    one, so text that can't fit isn't tried: without a digit no number is
    finite, and with a point none is whole.
    """
    c = col_(c)
    d = c.try_cast("double")
    via_double = F.when(F.isnan(d), F.lit(None)).otherwise(d.try_cast(to))
    whole = F.when(~F.contains(c, F.lit(".")), F.trim(c).try_cast(to))
    return F.when(F.rlike(c, F.lit("[0-9]")), F.coalesce(whole, via_double)).cast(to)


def rep_id_parse(c, prefix: str = "r") -> Column:
    """``r345`` -> 345 (first ``r`` removed, lenient 64-bit int)."""
    return lenient_int(strip_first(c, prefix), "bigint")


def parse_us_date(c) -> Column:
    """``m/d/Y`` text -> date; trailing text (a time) ignored; bad -> null."""
    prefix = F.regexp_extract(col_(c), US_DATE_PREFIX, 1)
    return F.try_to_date(F.nullif(prefix, F.lit("")), "M/d/yyyy")


def drop_thousands(c) -> Column:
    return F.regexp_replace(col_(c), ",", "")


def altitude_parse(c) -> Column:
    """P5: ``6,000`` -> 6000."""
    return lenient_int(drop_thousands(c))


def null_default(c, default: str) -> Column:
    """Null -> default; blank text is not null and stays blank."""
    return F.coalesce(col_(c), F.lit(default))


def text_flag(c, value: str) -> Column:
    """1 where text == value, 0 otherwise, null stays null."""
    return (col_(c) == F.lit(value)).cast("int")


def typed_null(dtype: str = "string") -> Column:
    """An all-null column of a given type."""
    return F.lit(None).cast(dtype)


def us_date_text(c) -> Column:
    """Format a date as unpadded ``M/d/yyyy`` text (inverse of parse_us_date)."""
    return F.date_format(col_(c), "M/d/yyyy")


# ---------------------------------------------- F1 - F16 (person records)

def strip_footnotes(c) -> Column:
    """remove bracketed footnotes ``[a]``, ``[12]``."""
    return F.regexp_replace(col_(c), FOOTNOTE_PATTERN, "")


def name_desc_split(c, keep_digit: bool = False) -> tuple[Column, Column]:
    """split once at a blank+digit or a ``[n]`` marker -> (name, desc).

    Like the source, the digit after the blank is consumed (``871`` -> ``71``)
    unless ``keep_digit`` is set, which splits with a look-ahead instead.
    """
    pat = r"\s(?=\d)|\[\d+\]" if keep_digit else NAME_DESC_SPLIT_PATTERN
    parts = F.split(col_(c), "(?U)" + pat, 2)
    return F.get(parts, 0), F.get(parts, 1)


def dedupe_words(c) -> Column:
    """drop repeated words keeping first-appearance order; collapse blanks."""
    words = F.split(col_(c), r"(?U)\s+")
    return F.array_join(F.array_distinct(F.filter(words, lambda x: x != F.lit(""))), " ")


def date_range_extract(c) -> Column:
    """first ``ddd[d] [– [dd] [Month] dddd]`` range in the text, else null."""
    return F.nullif(F.regexp_extract(col_(c), "(?U)" + DATE_RANGE_PATTERN, 1), F.lit(""))


def drop_day_month(c) -> Column:
    """``26 May 901 – 17 July 924`` -> ``901 – 924``-like text."""
    return F.regexp_replace(col_(c), "(?U)" + DAY_MONTH_PATTERN, " ")


def reign_bounds(c) -> tuple[Column, Column]:
    """split a range at the en dash, trim, int both sides (missing -> null)."""
    parts = F.split(F.trim(col_(c)), RANGE_DASH)
    start = F.trim(F.get(parts, 0)).try_cast("int")
    end = F.trim(F.get(parts, 1)).try_cast("int")
    return start, end


def year_extract(c) -> Column:
    """first run of 3-4 digits as int, else null."""
    return F.nullif(F.regexp_extract(col_(c), "(?U)" + YEAR_PATTERN, 1), F.lit("")).try_cast("int")


def claim_of(c) -> Column:
    """F8: ``Son/grandson of`` -> ``Son of`` (``/.*?of`` -> ``of``)."""
    return F.regexp_replace(col_(c), CLAIM_OF_PATTERN, "of")


def claim_relation(c) -> Column:
    """relation word (``Great-grandson``), case-insensitive, else null."""
    return F.nullif(F.regexp_extract(col_(c), "(?iU)" + CLAIM_RELATION_PATTERN, 1), F.lit(""))


def claim_parent(c) -> Column:
    """parent name after ``son / daughter of``, else null."""
    return F.nullif(F.regexp_extract(col_(c), "(?iU)" + CLAIM_PARENT_PATTERN, 1), F.lit(""))


def glued_name_cut(c) -> Column:
    """cut a second name glued to the first (``EdwardEdward`` -> ``Edward``)."""
    return F.regexp_replace(col_(c), GLUED_NAME_PATTERN, "")


def char_set_trim(c, chars: str, literal: bool = False) -> Column:
    """strip a character SET from both ends (Python ``str.strip(chars)``).

    ``literal=True`` removes the exact text as a prefix / suffix instead.
    """
    if not literal:
        return F.btrim(col_(c), F.lit(chars))
    quoted = "\\Q" + chars + "\\E"
    return F.regexp_replace(col_(c), "^(" + quoted + ")+|(" + quoted + ")+$", "")


def icontains(haystack, needle) -> Column:
    """case-insensitive literal containment; null never matches."""
    return F.coalesce(F.contains(F.lower(col_(haystack)), F.lower(col_(needle))), F.lit(False))
