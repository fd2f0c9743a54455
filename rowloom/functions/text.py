"""Cleaning of text cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowloom import fixed_values as fv

# White space as Python's str.split() sees it: as a set of characters, and as a regex (Java's
# own \s leaves out the no-break space, and its Unicode \s the four separators from 1c on).
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
SPACE = r"(?U:[\s\x1c-\x1f])"
_NOT_SPACE = r"(?U:[^\s\x1c-\x1f])"
# Any character that is not in the ranges of plain letters, digits and signs: all white space
# but the blank, all control characters, and a few harmless others.
ODD = r"[^ -~\xa1-\u167f\u2010-\u2027\u2030-\u205e\u2060-\u2fff\u3001-\uffff\x{10000}-\x{10ffff}]"
# Spark's double cast also takes 'NaN', '1d' and '1f'; sheets mean none of these as numbers.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def quoted(name: str) -> str:
    """A column name that may hold points and spaces, for F.col()."""
    return "`" + name.replace("`", "``") + "`"


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.trim(c, F.lit(SPACES))


def blank_to_null(c: Column) -> Column:
    """Trimmed of spaces; NULL if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def blank_to(c: Column, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def is_blank(c: Column) -> Column:
    """True for NULL and for white space only."""
    return F.coalesce(~c.rlike(_NOT_SPACE), F.lit(True))


_LONGEST_BLANK_WORD = max(map(len, fv.BLANK_WORDS))


def clean_string(c: Column) -> Column:
    s = strip(c.cast("string"))
    # the length is looked at first: most cells are spared the lower-casing
    return F.when((F.length(s) > _LONGEST_BLANK_WORD) | ~F.lower(s).isin(*fv.BLANK_WORDS), s)


def normalize_numeric_string(c: Column) -> Column:
    """Number cells as plain text: no white space, decimal point, no currency or unit mark.

    Meant for number cells; text cells lose their inner spaces and their commas.
    """
    packed = F.replace(F.translate(clean_string(c), SPACES, ""), F.lit(","), F.lit("."))
    may_end_in_unit = F.substring(packed, -1, 1).isin(*fv.UNIT_SUFFIX_ENDS)
    return F.when(may_end_in_unit, F.regexp_replace(packed, "(?u)" + fv.UNIT_SUFFIX, "")).otherwise(packed)


def normalize_boolean(c: Column) -> Column:
    s = F.lower(clean_string(c))
    return F.when(s.isin(*fv.TRUE_WORDS), True).when(s.isin(*fv.FALSE_WORDS), False)


def normalize_value(c: Column) -> Column:
    """White space runs as one space, ends trimmed, NULL as ''; the form that is hashed."""
    return F.coalesce(F.trim(F.regexp_replace(c.cast("string"), SPACE + "+", " ")), F.lit(""))


def clean_numeric(c: Column) -> Column:
    s = strip(F.replace(F.translate(c.cast("string"), "\xa0 ", ""), F.lit(","), F.lit(".")))
    return F.when(s.rlike(NUMBER), s.try_cast("double"))


def clean_boolean(c: Column) -> Column:
    s = strip(c.cast("string"))
    return F.when(s.isin(*fv.TRUE_WORDS_EXACT), True).when(s.isin(*fv.FALSE_WORDS_EXACT), False)


def clean_text(c: Column) -> Column:
    s = strip(c.cast("string"))
    return F.when(~s.isin(*fv.BLANK_WORDS_EXACT), s)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def strip_weekday(c: Column) -> Column:
    """Without a leading weekday of two or three letters ('пн 01.12.25')."""
    return strip(F.regexp_replace(c, "(?u)" + fv.WEEKDAY_PREFIX + SPACE + "+", ""))


def logged_value(c: Column) -> Column:
    """A value as it is kept in the validation log; a missing one reads 'None'."""
    return F.substring(F.coalesce(c.cast("string"), F.lit("None")), 1, fv.LOGGED_VALUE_CHARS)
