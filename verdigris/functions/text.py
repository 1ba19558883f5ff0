"""Column helpers for text, with the whitespace and case rules of Python strings.

Spark's ``trim`` knows only the space and Java's ``\\s`` misses 23 of the characters that Python
counts as whitespace, so both the character set and the pattern class are spelled out here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python's str.isspace() accepts.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a pattern: Java's Unicode class leaves out U+001C to U+001F.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Naming the value with ``withColumn`` does not hold: a filter on the result is pushed below the
    projection with the value written out at every use, and a chain of such steps grows without
    bound. A bound variable keeps the expression linear in the number of steps.
    """
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Drop whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """Replace every run of whitespace by one space."""
    return F.regexp_replace(text, WHITESPACE_RUN, " ")


def before(text: Column, literal: str) -> Column:
    """Text up to the first ``literal``; all of it when the literal is absent."""
    return F.substring_index(text, literal, 1)


def after_first(text: Column, literal: str) -> Column:
    """Text between the first and the second ``literal``; empty when it is absent."""
    return F.split_part(text, F.lit(literal), F.lit(2))


def cut_from(text: Column, pattern: str, flags: str = "s") -> Column:
    """Drop everything from the first match of ``pattern`` on."""
    return F.regexp_replace(text, f"(?{flags})(?:{pattern}).*", "")


def has_non_ascii(text: Column) -> Column:
    """True when any character lies outside ASCII: then bytes outnumber characters."""
    return F.octet_length(text) != F.length(text)


def contains_any(text: Column, literals: Sequence[str]) -> Column:
    return F.exists(F.lit(list(literals)), lambda literal: F.contains(text, literal))


def literals_found(text: Column, literals: Sequence[str]) -> Column:
    """The literals that occur in the text, in the order given."""
    return F.filter(F.lit(list(literals)), lambda literal: F.contains(text, literal))


def first_literal_found(text: Column, literals: Sequence[str]) -> Column:
    """The first literal of the list that occurs in the text, else null."""
    return F.get(literals_found(text, literals), F.lit(0))


def comma_items(text: Column) -> Column:
    """Split on commas and strip each item; empty items stay."""
    return F.transform(F.split(text, ","), strip)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def md5_key(seed: int, key: Column) -> Column:
    """Order key of a seeded shuffle: the same on every engine, partitioning and run."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
