"""Word tokens of a text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed pattern: anything that is neither a letter nor a digit parts two words.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.split(F.lower(text), WORD_BREAK)


def word_count(text: Column, word: str) -> Column:
    """How often the word occurs in the whole text."""
    wanted = word.lower()
    return F.size(F.filter(words(text), lambda w: w == F.lit(wanted))).cast("bigint")
