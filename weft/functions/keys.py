"""Keys and blanks, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UID = "^[A-Za-z][A-Za-z0-9]{10}$"


def strip(c: Column) -> Column:
    """Without white space of any script at either end; the plain cases stay off the regex engine."""
    plain = F.trim(c)
    return F.when(plain.rlike(r"(?U)^\s|\s$"), F.regexp_replace(plain, r"(?U)^\s+|\s+$", "")).otherwise(plain)


def uid(c: Column) -> Column:
    """The eleven-character key a field holds, or null where it holds none."""
    s = strip(c)
    return F.when((F.length(s) == 11) & s.rlike(UID), s)


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")
