"""Canonical forms of texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.runtime import col

#: A word is a longest run of letters or digits.
NOT_WORD = r"[^\p{L}\p{N}]+"


def plain(name: str) -> Column:
    """Lower-cased text of a column, null as empty."""
    return F.lower(F.coalesce(col(name).cast("string"), F.lit("")))


def format_key(names: list[str]) -> Column:
    """The texts without everything but letters and digits, one after another, parted by a NUL.

    Two records with the same key differ in formatting only. NUL is neither a letter nor a digit, so it parts the fields.
    """
    return F.concat_ws("\x00", *[F.regexp_replace(plain(n), NOT_WORD, "") for n in names])


def word_hashes(names: list[str]) -> Column:
    """Distinct words of the texts together, each as a non-negative 56-bit hash."""
    words = F.split(F.concat_ws(" ", *[plain(n) for n in names]), NOT_WORD)
    hashes = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.shiftrightunsigned(F.xxhash64(w), 8))
    return F.array_distinct(hashes)
