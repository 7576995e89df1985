"""Similarities of many pairs of names at once: over arrays of pairs, letter by letter, one bit for each letter of a name.

The results are those of the functions of one pair in weft.functions.similarity, to the last bit. A batch of pairs names few
distinct texts, which are coded once; names over a machine word are compared one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weft.functions import similarity as sim

WIDTH = 64  # letters of a machine word
ONE = np.uint64(1)


def _codes(names: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(letters of each name as numbers from 1, 0 beyond its end; lengths; how many letters there are)."""
    n = np.array([len(x) for x in names], np.int64)
    at = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(at.max(initial=0)) + 1, bool)
    seen[at] = True
    out = np.zeros((len(names), int(n.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = np.cumsum(seen)[at]
    return out, n, int(seen.sum())


class Pairs:
    """Pairs (p, q) of the distinct texts x."""

    def __init__(self, x: list[str], p: np.ndarray, q: np.ndarray):
        self.x = x
        code, self.n, self.letters = _codes([s[:WIDTH] for s in x])
        self.n = np.array([len(s) for s in x], np.int64)
        masks = np.zeros((len(x), self.letters + 1), np.uint64)
        rows = np.arange(len(x))
        for j in range(code.shape[1]):
            masks[rows, code[:, j]] |= np.uint64(1 << j)
        masks[:, 0] = 0
        self.code, self.masks, self.down = code, masks.ravel(), np.ascontiguousarray(code.T)
        # pairs of the longest left name first: those whose name goes on at a letter are the first so many
        order = np.argsort(-np.minimum(self.n[p], WIDTH), kind="stable")
        self.p, self.q, self.order = p[order], q[order], order
        self.wide = (self.n[self.p] > WIDTH) | (self.n[self.q] > WIDTH)

    def _active(self, n: np.ndarray) -> np.ndarray:
        """How many of the pairs have a letter at each place; n falls."""
        return len(n) - np.searchsorted(n[::-1], np.arange(1, int(n.max(initial=0)) + 1))

    def _one_by_one(self, got: np.ndarray, at: np.ndarray, f) -> np.ndarray:
        for i in np.flatnonzero(self.wide[at]).tolist():
            got[i] = f(self.x[self.p[at[i]]], self.x[self.q[at[i]]])
        return got

    def levenshtein(self, at: np.ndarray) -> np.ndarray:
        p, q = self.p[at], self.q[at]
        n, m, base = self.n[p], self.n[q], q * (self.letters + 1)
        pv, mv, d, last = np.full(len(p), ~np.uint64(0)), np.zeros(len(p), np.uint64), m.astype(np.int64), np.clip(m - 1, 0, WIDTH - 1).astype(np.uint64)
        for j, k in enumerate(self._active(np.minimum(n, WIDTH)).tolist()):
            eq, v, w = self.masks[base[:k] + self.down[j][p[:k]]], pv[:k], mv[:k]
            xv, xh = eq | w, (((eq & v) + v) ^ v) | eq
            ph, mh = w | ~(xh | v), v & xh
            d[:k] += ((ph >> last[:k]) & ONE).astype(np.int64) - ((mh >> last[:k]) & ONE).astype(np.int64)
            ph = (ph << ONE) | ONE
            pv[:k], mv[:k] = (mh << ONE) | ~(xv | ph), ph & xv
        d = np.where(m == 0, n, d)
        longest = np.maximum(n, m)
        got = np.where(longest > 0, 1 - d / np.maximum(longest, 1), 0.0)
        return self._one_by_one(got, at, lambda a, b: 1 - _edits(a, b) / max(len(a), len(b)))

    def jaro_winkler(self, at: np.ndarray) -> np.ndarray:
        p, q = self.p[at], self.q[at]
        n, m, base = self.n[p], self.n[q], q * (self.letters + 1)
        reach = np.clip(np.maximum(n, m) // 2 - 1, 0, WIDTH // 2 - 1)
        window = [(1 << 2 * r + 1) - 1 for r in range(WIDTH // 2)]
        used, eqs, flags = np.zeros(len(p), np.uint64), [], np.zeros(len(p), np.uint64)
        for j, k in enumerate(self._active(np.minimum(n, WIDTH)).tolist()):
            near = np.array([(w >> r - j if j < r else w << j - r) & (1 << WIDTH) - 1 for r, w in enumerate(window)], np.uint64)
            eq = self.masks[base[:k] + self.down[j][p[:k]]]
            free = eq & near[reach[:k]] & ~used[:k]
            bit = free & (~free + ONE)
            used[:k] |= bit
            flags[:k] |= (bit != 0).astype(np.uint64) << np.uint64(j)
            eqs.append(eq)
        common, turned, left = np.bitwise_count(used).astype(np.int64), np.zeros(len(p), np.int64), used.copy()
        for j, eq in enumerate(eqs):
            k = len(eq)
            # the next used letter of the other name, where this letter has a partner
            bit = left[:k] & (~left[:k] + ONE) & (~((flags[:k] >> np.uint64(j)) & ONE) + ONE)
            turned[:k] += (bit != 0) & ((eq & bit) == 0)
            left[:k] ^= bit
        k = np.maximum(common, 1)
        jaro = np.where(common > 0, (common / np.maximum(n, 1) + common / np.maximum(m, 1) + (common - turned // 2) / k) / 3, 0.0)
        same, going = np.zeros(len(p), np.int64), np.ones(len(p), bool)
        for j in range(min(4, self.code.shape[1])):
            a, b = self.down[j][p], self.down[j][q]
            going &= (a == b) & (a > 0)
            same += going
        got = np.where(jaro > 0.7, jaro + same * 0.1 * (1 - jaro), jaro)
        return self._one_by_one(got, at, sim.jaro_winkler)

    def cosine(self, at: np.ndarray) -> np.ndarray:
        """Of the counts of letter pairs inside words, padded by a space on both sides."""
        words = [" ".join(filter(None, s[: WIDTH + 1].split(" "))) for s in self.x]
        code, n, letters = _codes([f" {s} " if s else "" for s in words])
        grams = np.where(np.arange(max(code.shape[1] - 1, 0)) < n[:, None] - 1, code[:, :-1] * (letters + 1) + code[:, 1:], 0)
        kinds, grams = np.unique(grams, return_inverse=True)
        grams = grams.reshape(len(self.x), -1) + (1 if not len(kinds) or kinds[0] else 0)  # 0 is no letter pair
        width = int(grams.max(initial=0)) + 1
        counts = np.bincount((np.arange(len(self.x))[:, None] * width + grams).ravel(), minlength=len(self.x) * width).reshape(-1, width)
        counts[:, 0] = 0
        norm, flat, down = np.sqrt((counts * counts).sum(axis=1)), counts.astype(np.uint8).ravel(), np.ascontiguousarray(grams.T)
        p, q = self.p[at], self.q[at]
        dot, base = np.zeros(len(p), np.int64), q * width
        # as many letter pairs as the left name has, the longest first
        size = np.maximum(n - 1, 0)[p]
        order = np.argsort(-size, kind="stable")
        p, base = p[order], base[order]
        for j, k in enumerate(self._active(size[order]).tolist()):
            dot[:k] += flat[base[:k] + down[j][p[:k]]]
        below = norm[p] * norm[q[order]]
        got = np.empty(len(p))
        got[order] = np.divide(dot, below, out=np.zeros(len(p)), where=below > 0)
        return self._one_by_one(got, at, sim._cosine)

    def spread(self, got: np.ndarray) -> np.ndarray:
        """In the order the pairs were given."""
        out = np.empty(len(got), got.dtype)
        out[self.order] = got
        return out


def _edits(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        last = row
    return last[-1]


def likeness(w: Pairs, least: float | None = None) -> np.ndarray:
    """The mean of the three similarities, in the order given; NaN where it is sure to be below `least`."""
    every = np.arange(len(w.p))
    cos, out = w.cosine(every), np.full(len(w.p), np.nan)
    at = every if least is None else np.flatnonzero((2 + cos) / 3 >= least - 1e-9)
    lev = w.levenshtein(at)
    if least is not None:
        may = (lev + 1 + cos[at]) / 3 >= least - 1e-9
        at, lev = at[may], lev[may]
    out[at] = (lev + w.jaro_winkler(at) + cos[at]) / 3
    return w.spread(out)


def _pairs(a: pa.Array, b: pa.Array) -> Pairs:
    p, q = (c.dictionary_encode(null_encoding="encode") for c in (a, b))
    x, y = ([s or "" for s in c.dictionary.to_pylist()] for c in (p, q))
    return Pairs(x + y, p.indices.to_numpy(zero_copy_only=False).astype(np.int64), q.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(x))


def name_likeness(a: Column, b: Column, least: float | None = None) -> Column:
    """The mean of three string similarities; null where a `least` is given and the mean is sure to be below it."""

    @F.arrow_udf(DoubleType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        got = likeness(_pairs(x, y), least)
        return pa.array(got, mask=np.isnan(got))

    return run(a, b)


@F.arrow_udf(DoubleType())
def jaro_winkler_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    w = _pairs(a, b)
    return pa.array(w.spread(w.jaro_winkler(np.arange(len(a)))))


@F.arrow_udf(DoubleType())
def bigram_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    w = _pairs(a, b)
    return pa.array(w.spread(w.cosine(np.arange(len(a)))))
