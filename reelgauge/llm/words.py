"""Column expressions for words, as maximal runs without ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six ASCII white-space characters, and the same as a character class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def whole(text: Column) -> Column:
    """The text; null is empty."""
    return F.coalesce(text, F.lit(""))


def word_array(text: Column) -> Column:
    """Words in order; none for a null or blank text."""
    trimmed = F.btrim(whole(text), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def squeezed(text: Column) -> Column:
    """The text without any white space; null is empty."""
    return F.regexp_replace(whole(text), SPACE_CLASS + "+", "")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
