"""Word arrays as DataFrame expressions: ASCII letters lower-cased, words are
runs of everything but the ASCII marks, digits excepted."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    """array<string> of the words of a whole text; empty for NULL."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(low, NOT_WORD, -1), ""), F.array().cast("array<string>"))


def gram_hashes(words_col: str, size: int) -> Column:
    """array<long>: for each position the 64-bit hash of the ``size`` words from
    there on (of fewer near the end).  Explode it with an *outer* generator: for
    a plain one Catalyst adds a size filter that repeats the whole expression
    above the scan, for every element."""
    w = F.col(words_col)
    return F.transform(w, lambda x, i: F.xxhash64(F.lit(size), x, *[F.get(w, i + j) for j in range(1, size)]))
