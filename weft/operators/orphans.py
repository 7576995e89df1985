"""References to records that do not exist.

Keys are dictionary-encoded as integers inside hashed key ranges; each range keeps one compressed bitmap per table
and period of the keys referred to, and one per period of the keys whose record stood through the whole period.
Reference AND-NOT parent leaves the keys that were missing for at least a part of the period; their bits are decoded
and only the references to them are compared with the parent's exact times.

Nulls: a reference with a null key or time is no reference; a parent row with a null key counts for nothing, one with
a null first time as present from the start. Repeated references come out once. Either side may be empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_BITS = 16
ARRAY_MOST = 4096


class Bitmap:
    """A compressed set of the integers below 2**32: by high half, a sorted uint16 array or, when dense, packed bits."""

    __slots__ = ("parts",)

    def __init__(self, parts: dict[int, np.ndarray]):
        self.parts = parts

    @staticmethod
    def _pack(low: np.ndarray) -> np.ndarray:
        if len(low) <= ARRAY_MOST:
            return low.astype(np.uint16)
        bits = np.zeros(1 << RANGE_BITS, dtype=bool)
        bits[low] = True
        return np.packbits(bits)

    @staticmethod
    def _low(part: np.ndarray) -> np.ndarray:
        return part if part.dtype == np.uint16 else np.flatnonzero(np.unpackbits(part)).astype(np.uint16)

    @classmethod
    def of(cls, codes: np.ndarray) -> "Bitmap":
        codes = np.unique(np.asarray(codes, dtype=np.int64))
        high = codes >> RANGE_BITS
        cuts = np.flatnonzero(np.diff(high)) + 1
        return cls({int(p[0] >> RANGE_BITS): cls._pack(p & 0xFFFF) for p in np.split(codes, cuts) if len(p)})

    def and_not(self, other: "Bitmap") -> "Bitmap":
        out = {}
        for h, a in self.parts.items():
            b = other.parts.get(h)
            if b is None:
                left = a
            elif a.dtype == b.dtype == np.uint8:
                left = self._pack(np.flatnonzero(np.unpackbits(a & ~b)))
            elif b.dtype == np.uint8:
                left = a[(b[a >> 3] >> (7 - (a & 7)).astype(np.uint8)) & 1 == 0]
            else:
                left = self._pack(np.setdiff1d(self._low(a), b, assume_unique=True))
            if len(left):
                out[h] = left
        return Bitmap(out)

    def codes(self) -> np.ndarray:
        each = [(h << RANGE_BITS) | self._low(p).astype(np.int64) for h, p in sorted(self.parts.items())]
        return np.concatenate(each) if each else np.empty(0, np.int64)

    def nbytes(self) -> int:
        return sum(p.nbytes for p in self.parts.values())


def _month(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def _survivors(refs: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    codes, words = pd.factorize(pd.concat([refs["key"], parents["key"]], ignore_index=True))
    ref, par = codes[: len(refs)], codes[len(refs) :]
    first, gone = parents["first_month"].to_numpy(), parents["gone_month"].to_numpy()
    at = np.full(len(words), -1)
    at[par] = np.arange(len(par))
    standing: dict[int, Bitmap] = {}
    found = []
    months = refs["month"].to_numpy()
    for (name, month), rows in refs.groupby(["ref_table", "month"], sort=False).indices.items():
        if month not in standing:
            standing[month] = Bitmap.of(par[(first < month) & (gone > month)])
        left = Bitmap.of(ref[rows]).and_not(standing[month]).codes()
        if len(left):
            p = at[left]
            has = p >= 0
            found.append(
                pd.DataFrame(
                    {
                        "ref_table": name,
                        "month": months[rows[0]],
                        "key": np.asarray(words, dtype=object)[left],
                        "held": has,
                        "first_at": parents["first_at"].reindex(np.where(has, p, -1)).to_numpy(),
                        "gone_at": parents["gone_at"].reindex(np.where(has, p, -1)).to_numpy(),
                    }
                )
            )
    if not found:
        kinds = {"ref_table": object, "month": "int32", "key": object, "held": bool, "first_at": float, "gone_at": float}
        return pd.DataFrame({c: pd.Series([], dtype=k) for c, k in kinds.items()})
    return pd.concat(found, ignore_index=True)


def orphan_references(refs: DataFrame, parents: DataFrame, *, key_rows: int, range_keys: int = 1 << 15) -> DataFrame:
    """(ref_table, period, ref_no, key) of every reference whose record was missing at its time.

    refs: ref_table, ref_no, key, at. parents: key, first_at, gone_at, any number of rows for a key.
    key_rows: an upper bound of the distinct keys, such as the tables' row counts; ranges hold about range_keys each.
    """
    ranges = max(1, -(-key_rows // range_keys))
    rng = F.pmod(F.xxhash64("key"), F.lit(ranges)).alias("rng")
    refs = refs.select("ref_table", "ref_no", "key", "at", _month(F.col("at")).alias("month")).where("key is not null and at is not null")
    bits = refs.select("ref_table", "month", "key").distinct().select(rng, "*")
    held = (
        parents.where("key is not null")
        .groupBy("key")
        .agg(F.min(F.coalesce("first_at", F.lit("0001-01-01").cast("timestamp"))).alias("first_at"), F.min("gone_at").alias("gone_at"))
        .select(
            rng,
            "key",
            F.unix_micros("first_at").alias("first_at"),
            F.unix_micros("gone_at").alias("gone_at"),
            _month(F.col("first_at")).alias("first_month"),
            F.coalesce(_month(F.col("gone_at")), F.lit(1 << 30)).alias("gone_month"),
        )
    )
    missing = bits.groupBy("rng").cogroup(held.groupBy("rng")).applyInPandas(
        lambda a, b: _survivors(a, b), "ref_table string, month int, key string, held boolean, first_at double, gone_at double"
    )
    us = F.unix_micros("at")
    return (
        refs.join(missing, ["ref_table", "month", "key"])
        .where(~F.col("held") | (us < F.col("first_at")) | (us >= F.col("gone_at")))
        .select("ref_table", F.date_format("at", "yyyy-MM").alias("period"), "ref_no", "key")
        .distinct()
    )


def orphan_report(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """Per table and period: references, those without a record, distinct missing keys, and the share missing."""
    total = (
        refs.where("key is not null and at is not null")
        .select("ref_table", F.date_format("at", "yyyy-MM").alias("period"), "ref_no", "key")
        .distinct()
        .groupBy("ref_table", "period")
        .agg(F.count("*").alias("references"))
    )
    # distinct keys first, so that one key with a third of the rows is counted before it is shuffled
    by_key = orphans.groupBy("ref_table", "period", "key").agg(F.count("*").alias("n"))
    lost = by_key.groupBy("ref_table", "period").agg(F.sum("n").alias("orphans"), F.count("*").alias("missing_keys"))
    return total.join(lost, ["ref_table", "period"], "left").select(
        "ref_table",
        "period",
        "references",
        F.coalesce("orphans", F.lit(0)).alias("orphans"),
        F.coalesce("missing_keys", F.lit(0)).alias("missing_keys"),
        F.round(F.coalesce("orphans", F.lit(0)) / F.col("references"), 6).alias("orphan_share"),
    )
