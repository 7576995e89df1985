"""Ethiopic letters written in Latin ones, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST = 0x1200
# fixed values: the consonant of each row of eight in the Ethiopic block, from U+1200; capitals stand for those in DOUBLE
CONSONANTS = "hlhmsrsSqqqqbvtChhnN" + "\0" + "kkkkw" + "\0" + "zZyddjggg" + "tCpTTfp"
DOUBLE = {"S": "sh", "C": "ch", "N": "ny", "Z": "zh", "T": "ts"}
# fixed values: the vowels of a row, in order
VOWELS = ("e", "u", "i", "a", "e", "", "o", "wa")


def rows() -> list[tuple[str, str]]:
    """(letters of the block with one vowel, the vowel), for every vowel."""
    return [("".join(chr(FIRST + 8 * i + j) for i in range(len(CONSONANTS))), v) for j, v in enumerate(VOWELS)]


def letters() -> tuple[str, str, str]:
    """(letters with a consonant, the consonant of each, letters without one)."""
    each = [(chr(FIRST + 8 * i + j), c) for i, c in enumerate(CONSONANTS) for j in range(8)]
    return "".join(x for x, c in each if c != "\0"), "".join(c for _, c in each if c != "\0"), "".join(x for x, c in each if c == "\0")


def romanise(c: Column) -> Column:
    """A lower-case text with its Ethiopic letters as consonant and vowel; other letters stay; null stays null."""
    out = c
    for xs, v in rows():
        if v:
            out = F.regexp_replace(out, f"([{xs}])", f"$1{v}")
    own, consonants, bare = letters()
    out = F.translate(out, own + bare, consonants)
    for one, two in DOUBLE.items():
        out = F.replace(out, F.lit(one), F.lit(two))
    return F.when(c.rlike("[ሀ-፿]"), out).otherwise(c)
