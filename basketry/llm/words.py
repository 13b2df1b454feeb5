"""Words by plain SQL functions: split, lower-case A-Z only, with positions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything that is no letter, digit or non-ASCII character; A-Z are lower-cased afterwards.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``translate`` is slow, so it only runs on the rare
    text that holds both non-ASCII characters and something that ``lower`` changes."""
    lowered = F.lower(text)
    return (F.when(text == lowered, text)
            .when(F.octet_length(text) == F.char_length(text), lowered)
            .otherwise(F.translate(text, UPPER, LOWER)))


def raw_words(text: Column) -> Column:
    """The words of a text in order, in their own case; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), lambda w: w != "")
