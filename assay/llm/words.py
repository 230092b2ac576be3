"""Words as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates alphanumeric words: every ASCII character but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before capitals are lowered.
CASED_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Characters outside ASCII that lower() would change.
OTHER_CAPITALS = r"[[\p{IsUppercase}\p{Lt}]&&[^A-Z]]"


def ascii_lower(text: str | Column) -> Column:
    """A-Z in lower case, everything else as it is; lower() where that is the same, because it is faster."""
    column = F.col(text) if isinstance(text, str) else text
    plain = F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(column.rlike(OTHER_CAPITALS), plain).otherwise(F.lower(column))


def alnum_words(text: str | Column) -> Column:
    """Runs of digits, lower-cased letters a-z and non-ASCII characters; none for null."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def word_count(text: str) -> Column:
    """How many words alnum_words() finds."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), CASED_SEPARATORS), "")).cast("long")


def item(array: str, at: Column) -> Column:
    return F.get(F.col(array), at)


def indexes(count: Column, step: int = 1) -> Column:
    """0, step, 2 * step, ... below ``count``; empty for 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))


def ngram_hashes(words: str, size: int) -> Column:
    """64-bit hash of every run of ``size`` words, in order."""
    return F.transform(
        indexes(F.size(words) - (size - 1)), lambda i: F.xxhash64(*[item(words, i + j) for j in range(size)])
    )
