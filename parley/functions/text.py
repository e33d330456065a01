"""Column builders for text; all are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split sees it, for a Java character class.
WS = r"\s\x1c-\x1f"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def word_count(c: Column | str) -> Column:
    return F.regexp_count(_c(c), F.lit(rf"(?U)[^{WS}]+")).cast("long")


def sentence_count(c: Column | str) -> Column:
    """Stretches between sentence ends that are not blank."""
    return F.regexp_count(_c(c), F.lit(rf"(?U)[^.!?{WS}][^.!?]*")).cast("long")


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def contains_any(c: Column | str, terms) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(_c(c), F.lit(t)) for t in terms))


def count_hits(c: Column | str, terms) -> Column:
    """How many of the terms occur, each once."""
    return reduce(lambda a, b: a + b, (F.contains(_c(c), F.lit(t)).cast("int") for t in terms))


def first_lower(c: Column | str) -> Column:
    return F.concat(F.lower(F.substring(_c(c), 1, 1)), F.substring(_c(c), 2, 2**31 - 1))


def first_upper(c: Column | str) -> Column:
    return F.concat(F.upper(F.substring(_c(c), 1, 1)), F.substring(_c(c), 2, 2**31 - 1))


def pick(row_id: Column | str, salt: str | Column, k: int | Column) -> Column:
    """A number from 0 to k-1 that depends on the row and the salt alone, the same in every run and layout."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.conv(F.substring(F.md5(F.concat_ws("|", _c(row_id).cast("string"), salt)), 1, 8), 16, 10).cast("long") % k


def one_of(options, number: Column) -> Column:
    return F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (number + 1).cast("int"))
