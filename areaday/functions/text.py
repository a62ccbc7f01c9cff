"""Text expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def zero_pad(text: Column, width: int = 2) -> Column:
    """Pad with zeros on the left; unlike ``lpad``, never cut a longer text."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where nothing matches. The group must not be empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def snake(text: Column) -> Column:
    """Lower case with underscores for spaces."""
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def with_suffix(text: Column, suffix: str) -> Column:
    return F.when(text.endswith(suffix), text).otherwise(F.concat(text, F.lit(suffix)))


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(or_, [text.contains(word) for word in words])


def contains_none(text: Column, words: list[str]) -> Column:
    return reduce(and_, [~text.contains(word) for word in words])


def part(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th piece, from 1; negative counts from the end."""
    return F.split_part(text, F.lit(separator), F.lit(index))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
