"""Cleaning and testing the cells of delimited files. All arguments and results are columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing cell, in any case.
NULL_WORDS = ("null", "na", "n/a", "nan", "nil", "nill")
#: Numbers as the JVM's double parser takes them; usable unchanged in DuckDB.
NUMBER = r"^[+-]?(?:(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?\d+)[fFdD]?|NaN|Infinity)$"
BLANKS = "".join(map(chr, range(0x21)))
# The literals of a boolean option.
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "y", "1", "on"), ("false", "no", "n", "0", "off")


def trimmed(c: Column) -> Column:
    """Without characters up to U+0020 at either end."""
    return F.btrim(c, F.lit(BLANKS))


def trim_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def csv_quote(c: Column) -> Column:
    """Quoted only where a comma, quote or line break asks for it; null is empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(c.rlike('[,"\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def quoted_line(*cells: Column) -> Column:
    """All cells quoted and joined by commas; null is empty."""
    return F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])


def is_null_word(c: Column) -> Column:
    return F.lower(trimmed(c)).isin(*NULL_WORDS)


def is_number(c: Column) -> Column:
    return trimmed(c).rlike(NUMBER)


def text_value(c: Column) -> Column:
    """Double quotes become single ones in text values."""
    return F.translate(c, '"', "'")


def visible(c: Column) -> Column:
    """Tabs and line breaks written out, for reports."""
    for raw, shown in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def one_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\\s+", " "))


def has_separator(c: Column, chars: str) -> Column:
    """Whether any of ``chars`` occurs: it would break a cell out of its list, column or row."""
    return F.coalesce(F.translate(c, chars, "") != c, F.lit(False))


def is_patient_cell(c: Column) -> Column:
    """Whether a row's first cell names a patient: not blank, no comment, no repository header."""
    return names_patient(trimmed(F.coalesce(c, F.lit(""))))


def names_patient(cell: Column) -> Column:
    """``is_patient_cell`` of a trimmed cell."""
    return (cell != "") & ~cell.startswith("#") & ~F.lower(cell).contains("dbgap")


def yes_no(c: Column) -> Column:
    """Blank is false; null for anything but yes and no, which callers report."""
    word = F.lower(trimmed(F.coalesce(c, F.lit(""))))
    return F.when(word == "yes", True).when(word.isin("no", ""), False)


def bool_literal(c: Column) -> Column:
    word = F.lower(trimmed(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def listed(c: Column) -> Column:
    """A comma list's entries, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), trimmed), lambda x: x != "")
