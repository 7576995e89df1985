"""The nearest names of each name inside equal blocks, over all pairs of the block.

Distinct names of a block meet in a grid of parts against parts, so a hot block is no single task. Inside a cell every
pair is held against a bound first: two names have no more letters in common, in order, than they have in any order, and
that number is had from the bits of both names' letters at once. Only where it reaches the k-th best score so far are the
letters in common counted exactly, and only where those reach it is the pair scored. Pairs whose bound is high are
counted before all others, so that the best scores are soon high. Left names of more than a machine word go another way:
the right names are walked in order as a trie, and names that begin alike share the counts of their beginnings. Nothing
is left out by a key or a number of pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.registry import row_number_top
from weft.session import cut

PART = 1 << 14  # left names in a cell of the grid
WIDER = 4  # times as many right names in a cell: the best scores of more names leave fewer to look at
LETTERS = 1 << 25  # bytes of masks at once
FEW = 16  # so many times as many right names, and the left ones are walked instead (ROWS times as many where names are sieved)
SOON, LATER = 8, 2048  # right names between two looks at the best scores, at first and at most
WIDTH = 64  # letters of a machine word
SIEVED = 4096  # left names whose bounds are held together, so that they stay in the cache
HIGH = 64  # right names about so many of which are counted first for each left name
BOUNDS = 1 << 26  # bytes of bounds at once
CACHED = 1 << 14  # bounds that are made at once
ROWS = 64  # right names whose bounds are looked at at once
PENDING = 1 << 18  # pairs that wait to be counted
COUNTED = 1 << 13  # pairs that are counted at once


def _edits_long(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        last = row
    return last[-1]


def _edits(masks: np.ndarray, p: np.ndarray, na: np.ndarray, text: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Levenshtein distance of each pair, by differences of the columns as bits (Myers, Hyyrö)."""
    one, pv, mv = np.uint64(1), np.full(len(p), ~np.uint64(0)), np.zeros(len(p), np.uint64)
    d, last = na.astype(np.int64), (na - 1).astype(np.uint64)
    for j in range(int(nb.max(initial=0))):
        eq = masks[p, text[:, j]]
        xv, xh = eq | mv, (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        d += np.where(j < nb, ((ph >> last) & one).astype(np.int64) - ((mh >> last) & one).astype(np.int64), 0)
        ph, mh = (ph << one) | one, mh << one
        pv, mv = mh | ~(xv | ph), ph & xv
    return d


class Measure:
    """A similarity that is a whole number of `unit`s, rounded half up: by common letters (200 lcs / both lengths) or by edits."""

    def __init__(self, by: str, unit: int):
        self.by, self.unit = by, unit

    def ratio(self, common: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        """The similarity of so many common letters, or of so many letters that need no edit."""
        of = na + nb if self.by == "common" else np.maximum(na, nb)
        times = 200 if self.by == "common" else 1
        return (2 * times * self.unit * common + of) // (2 * of)

    def least(self, units: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        """The fewest letters in common with which names of these lengths may reach so many units: by edits, those that need
        none are in common."""
        of = na + nb if self.by == "common" else np.maximum(na, nb)
        times = 200 if self.by == "common" else 1
        return np.maximum(-(of * (1 - 2 * units) // (2 * times * self.unit)), 0)


TOKEN_SORT = Measure("common", 10)  # 0 to 100, to one decimal
LEVENSHTEIN = Measure("edits", 1_000_000)  # 0 to 1, to six decimals


def _codes(*sides: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Of each list the names' letters as numbers from 1 and their lengths; how many different letters there are."""
    flat = [np.frombuffer("".join(names).encode("utf-32-le"), np.uint32) for names in sides]
    known, code = np.unique(np.concatenate(flat), return_inverse=True)
    out, at = [], 0
    for names in sides:
        n = np.fromiter(map(len, names), np.int64, len(names))
        c = np.zeros((len(names), int(n.max(initial=1))), np.int64)
        c[np.arange(c.shape[1]) < n[:, None]] = code[at : at + n.sum()] + 1
        out.append((c, n))
        at += n.sum()
    return out, len(known)


class _Walk:
    """Letters in common of some left names with right names, walked in order."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, letters: int, depth: int):
        longest = int(n.max(initial=1))
        kind, self.bits = (np.uint32, 32) if longest <= 32 else (np.uint64, 64)
        self.words = -(-longest // self.bits)
        self.masks = np.zeros((letters + 1, self.words, len(n)), kind)
        for j in range(longest):
            at = np.flatnonzero(j < n)
            self.masks[codes[at, j], j // self.bits, at] |= kind(1 << j % self.bits)
        state = np.full((depth + 1, self.words, len(n)), ~kind(0))
        u, w = np.empty((2, self.words, len(n)), kind)
        if self.words == 1:
            state, self.masks, u, w = state[:, 0], self.masks[:, 0], u[0], w[0]
        # rows of their own, each looked up many times
        self.state, self.masks, self.u, self.w, self.last = list(state), list(self.masks), u, w, []

    def to(self, name: list[int], out: np.ndarray) -> None:
        """out: the bits still set after this name, which are those of the words less the letters in common."""
        same = 0
        for a, b in zip(self.last, name):
            if a != b:
                break
            same += 1
        state, masks, u, w, one = self.state, self.masks, self.u, self.w, self.words == 1
        v = state[same]
        for d in range(same, len(name)):
            after = state[d + 1]
            np.bitwise_and(v, masks[name[d]], u)
            np.bitwise_xor(v, u, w)
            np.add(v, u, after)
            if not one:
                carry = after[0] < v[0]
                for k in range(1, self.words):
                    over = after[k] < v[k]
                    after[k] += carry
                    carry = over | (carry & (after[k] == 0))
            np.bitwise_or(after, w, after)
            v = after
        self.last = name
        if one:
            np.bitwise_count(v, out)
        else:
            out[:] = np.bitwise_count(v).sum(axis=0)


def _letter_bits(c: np.ndarray, letters: int, kinds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, letters without a bit, kinds): a bit for a letter's first, second, ... time in a name, of the 64 kinds of these
    that tell most names apart. The bits of two names that are set in both, and the fewer of the letters without a bit,
    are no fewer than the letters in common."""
    n = len(c)
    count = np.bincount((np.arange(n)[:, None] * (letters + 1) + c).ravel(), minlength=n * (letters + 1)).reshape(n, -1)[:, 1:]
    if kinds is None:
        share = np.array([(count >= t).mean(axis=0) for t in range(1, min(int(count.max(initial=1)), 8) + 1)]).ravel()
        kinds = np.argsort(-share * (1 - share), kind="stable")[:WIDTH]
    bits = np.zeros(n, np.uint64)
    for at, kind in enumerate(kinds.tolist()):
        bits |= (count[:, kind % letters] > kind // letters).astype(np.uint64) << np.uint64(at)
    return bits, count.sum(axis=1) - np.bitwise_count(bits), kinds


class _Rights:
    """Right names in the order of their lengths, with their bits."""

    def __init__(self, c: np.ndarray, n: np.ndarray, y: list[str], first: np.ndarray, letters: int):
        bits, beyond, self.kinds = _letter_bits(c, letters)
        self.order = by = np.lexsort((beyond, n))
        self.c, self.n, self.y, self.first, self.bits, self.beyond = c[by], n[by], [y[v] for v in by.tolist()], first[by], bits[by], beyond[by]
        self.down = np.ascontiguousarray(self.c.T)
        self.lengths, self.length = np.unique(self.n, return_inverse=True)
        # right names of one length with as many letters without a bit
        group, self.group = np.unique(self.length * (int(beyond.max(initial=0)) + 1) + self.beyond, return_inverse=True)
        self.group_length, self.group_beyond = np.divmod(group, int(beyond.max(initial=0)) + 1)


class _Sieve:
    """The k best right names of left names of a machine word at most."""

    def __init__(self, cx: np.ndarray, nx: np.ndarray, x: list[str], right: _Rights, k: int, measure: Measure, letters: int):
        self.nx, self.x, self.right, self.k, self.measure = nx, x, right, k, measure
        self.left, self.beyond, _ = _letter_bits(cx, letters, right.kinds)
        n, longest = len(nx), int(nx.max(initial=1))
        kind = np.uint32 if longest <= 32 else np.uint64
        self.masks = np.zeros((letters + 1, n), kind)
        for j in range(longest):
            at = np.flatnonzero(j < nx)
            self.masks[cx[at, j], at] |= kind(1 << j)
        self.by_name = np.ascontiguousarray(self.masks.T).astype(np.uint64) if measure.by == "edits" else None
        self.best = tuple(np.empty(0, np.int64) for _ in range(3))
        self.raise_to(np.zeros(n, np.int64))

    def raise_to(self, enough: np.ndarray) -> None:
        """The scores that others must reach, and the letters in common it takes with right names of every length."""
        self.enough = enough
        self.need = np.minimum(self.measure.least(enough, self.nx, self.right.lengths[:, None]), 255).astype(np.uint8)

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Letters in common of each pair."""
        n, masks, kind, got = self.masks.shape[1], self.masks.ravel(), self.masks.dtype, np.empty(len(p), np.uint8)
        for s in range(0, len(p), COUNTED):
            i, j = p[s : s + COUNTED], q[s : s + COUNTED]
            v, m, u, at = np.full(len(i), ~kind.type(0)), np.empty(len(i), kind), np.empty(len(i), kind), np.empty(len(i), np.int64)
            for letter in self.right.down[: int(self.right.n[j].max())]:
                np.take(letter, j, out=at, mode="clip")
                at *= n
                at += i
                np.take(masks, at, out=m, mode="clip")
                np.bitwise_and(v, m, u)
                np.subtract(v, u, m)
                np.add(v, u, v)
                np.bitwise_or(v, m, v)
            np.subtract(8 * kind.itemsize, np.bitwise_count(v), got[s : s + COUNTED])
        return got

    def take(self, p: np.ndarray, q: np.ndarray) -> None:
        """Count these pairs and keep the k best of each left name."""
        r, common = self.right, self.common(p, q)
        at = np.flatnonzero(common >= np.take(self.need.ravel(), r.length[q] * len(self.nx) + p, mode="clip"))
        p, q, common = p[at], q[at], common[at].astype(np.int64)
        if self.measure.by == "edits":
            common = _without_edits(self.by_name, p, q, self.nx, r.c, r.n, self.x, r.y)
        s = self.measure.ratio(common, self.nx[p], r.n[q])
        at = np.flatnonzero(s >= self.enough[p])
        p, q, s = (np.concatenate(z) for z in zip(self.best, (p[at], q[at], s[at])))
        by = np.lexsort((r.first[q], -s, p))
        p, q, s = p[by], q[by], s[by]
        place = np.arange(len(p)) - np.searchsorted(p, p)
        kth, enough = place == self.k - 1, self.enough.copy()
        enough[p[kth]] = s[kth]
        self.best = tuple(z[place < self.k] for z in (p, q, s))
        self.raise_to(enough)

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, n = self.right, len(self.nx)
        wide = -(-n // 8) * 8  # whole words of bounds
        bound, step = np.zeros((len(r.n), wide), np.uint8), max(1, CACHED // n)
        both = np.empty((step, n), np.uint64)
        for at in range(0, len(bound), step):
            own = r.bits[at : at + step, None]
            np.bitwise_count(np.bitwise_and(own, self.left, both[: len(own)]), bound[at : at + step, :n])
        # from the bounds of a few right names, those that about so many of all reach
        of = self.nx + r.lengths[:, None] if self.measure.by == "common" else np.maximum(self.nx, r.lengths[:, None])
        few = slice(0, None, max(1, HIGH // 4))
        share = np.sort(bound[few, :n] / np.maximum(of, 1)[r.length[few]].astype(np.float32), axis=0)[::-1]
        none = np.full((len(r.group_length), wide), 255, np.uint8)
        above = None  # the bounds from which pairs are counted already
        for most in HIGH, 4 * HIGH:
            level, least = share[min(most // max(1, HIGH // 4), len(share)) - 1], none.copy()
            least[:, :n] = np.ceil(level * of - 1e-3)[r.group_length]
            self.count(bound, above, lambda low=least: low)
            above = least if above is None else np.minimum(above, least)

        def rest() -> np.ndarray:
            """The bounds that let a pair be among the best."""
            low = none.copy()
            low[:, :n] = np.maximum(self.need[r.group_length].astype(np.int16) - np.minimum(self.beyond.astype(np.int16), r.group_beyond.astype(np.int16)[:, None]), 0)
            return low

        self.count(bound, above, rest)
        p, q, s = self.best
        return p, r.order[q], s

    def count(self, bound: np.ndarray, above: np.ndarray | None, least: Callable[[], np.ndarray]) -> None:
        """Count all pairs with a bound of at least `least` and below `above`, both by groups of right names."""
        got, waiting, group, low = [], 0, self.right.group, least()
        for lo in range(0, len(bound), ROWS):
            own, at = bound[lo : lo + ROWS], group[lo : lo + ROWS]
            hit = own >= low[at]
            if above is not None:
                hit &= own < above[at]
            # few words of eight bounds have one that counts
            words = hit.view(np.uint64).ravel()
            at = np.flatnonzero(words)
            k = np.flatnonzero(words[at].view(bool))
            i, j = np.divmod((at[k >> 3] << 3) + (k & 7), bound.shape[1])
            got.append((j, i + lo))
            waiting += len(k)
            if waiting >= PENDING or lo + ROWS >= len(bound):
                self.take(*(np.concatenate(z) for z in zip(*got)))
                got, waiting, low = [], 0, least()


def _states(names: list[str]) -> int:
    """How many states it takes to walk these names."""
    ((c, n),), _ = _codes(sorted(names))
    same = np.logical_and.accumulate((c[1:] == c[:-1]) & (c[1:] > 0), axis=1)
    return int(n.sum() - same.sum())


def nearest(x: list[str], y: list[str], first: np.ndarray, k: int, measure: Measure) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score in units): the k best y of each x, equal scores by `first`, none of which may repeat."""
    if not x or not y:
        return (np.empty(0, np.int64),) * 3
    ((cx, nx), (cy, ny)), letters = _codes(x, y)
    # names of half a word, of one, and of each further number of words
    words = np.where(nx <= 32, 0, -(-nx // WIDTH))
    rows = max(1, LETTERS // (8 * (letters + 1)))
    out, right = [], None
    for c in np.unique(words):
        part = np.flatnonzero(words == c)
        if len(part) * FEW * (ROWS if c <= 1 else 1) < len(y):
            out.append(_few(part, cx, nx, x, cy, ny, y, first, k, measure, letters, rows))
            continue
        if c > 1:
            i, j, s = _walked([x[v] for v in part.tolist()], y, first, k, measure, rows)
            out.append((part[i], j, s))
            continue
        right = right or _Rights(cy, ny, y, first, letters)
        step = max(1, min(rows, SIEVED, BOUNDS // len(y)))
        for at in range(0, len(part), step):
            own = part[at : at + step]
            i, j, s = _Sieve(cx[own], nx[own], [x[v] for v in own.tolist()], right, k, measure, letters).run()
            out.append((own[i], j, s))
    i, j, s = (np.concatenate(z) for z in zip(*out))
    at = np.argsort(i, kind="stable")
    return i[at], j[at], s[at]


def _walked(x: list[str], y: list[str], first: np.ndarray, k: int, measure: Measure, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for left names of as many machine words each."""
    back = [v[::-1] for v in y]
    if _states(back) < _states(y):
        # names that end alike rather than begin alike; neither measure minds which way a name is read
        x, y = [v[::-1] for v in x], back
    ((cx, nx), (cy, ny)), letters = _codes(x, y)
    names = [c[:n].tolist() for c, n in zip(cy, ny.tolist())]
    # right names of no order first, so that the best scores are soon high; the others in order, so that they share states
    order = np.random.default_rng(1).permutation(len(y))
    order = np.concatenate([order[:LATER], np.array(sorted(order[LATER:].tolist(), key=names.__getitem__), np.int64)])
    ends, step = [0], SOON
    while ends[-1] < len(y):
        ends.append(min(ends[-1] + step, len(y)))
        step = min(2 * step, LATER)
    out = []
    for at in range(0, len(x), rows):
        i, j, s = _best(cx[at : at + rows], nx[at : at + rows], x[at : at + rows], names, cy, ny, y, first, k, measure, letters, order, ends)
        out.append((i + at, j, s))
    return tuple(np.concatenate(z) for z in zip(*out))


def _few(part: np.ndarray, cx, nx, x, cy, ny, y, first, k: int, measure: Measure, letters: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for few left names: these are walked, and the right names are held against them all at once."""
    got = []
    for lo in range(0, len(y), rows):
        b, nb, before = cy[lo : lo + rows], ny[lo : lo + rows], first[lo : lo + rows]
        walk = _Walk(b, nb, letters, int(nx[part].max()))
        left = np.empty(len(nb), np.uint8 if walk.bits * walk.words < 256 else np.int64)
        for i in part.tolist():
            walk.to(cx[i, : nx[i]].tolist(), left)
            na = np.full(len(nb), nx[i])
            units = measure.ratio(walk.bits * walk.words - left.astype(np.int64), na, nb)
            if measure.by == "edits":
                # a bound so far: the k best bounds give a score that the others must reach
                masks = np.zeros((1, letters + 1), np.uint64)
                for j in range(min(int(nx[i]), WIDTH)):
                    masks[0, cx[i, j]] |= np.uint64(1 << j)
                exact = lambda q: measure.ratio(_without_edits(masks, np.zeros(len(q), np.int64), q, nx[i : i + 1], b, nb, x[i : i + 1], y[lo : lo + rows]), na[q], nb[q])  # noqa: B023, E731
                m = min(k, len(nb))
                enough = exact(np.argpartition(-units, m - 1)[:m]).min()
                q = np.flatnonzero(units >= enough)
                s = exact(q)
            else:
                m = min(k, len(nb))
                q = np.flatnonzero(units >= -np.partition(-units, m - 1)[m - 1])
                s = units[q]
            best = np.lexsort((before[q], -s))[:k]
            got.append((np.full(len(best), i), q[best] + lo, s[best]))
    p, q, s = (np.concatenate(z) for z in zip(*got))
    by = np.lexsort((first[q], -s, p))
    p, q, s = p[by], q[by], s[by]
    kept = np.arange(len(p)) - np.searchsorted(p, p) < k
    return p[kept], q[kept], s[kept]


def _best(cx, nx, x, names, cy, ny, y, first, k: int, measure: Measure, letters: int, order: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    walk = _Walk(cx, nx, letters, int(ny.max(initial=1)))
    of, enough = walk.bits * walk.words, np.zeros(len(nx), np.int64)
    p, q, s = (np.empty(0, np.int64) for _ in range(3))
    small = np.uint8 if of < 255 else np.int64
    if measure.by == "edits":
        masks = np.zeros((len(nx), letters + 1), np.uint64)
        for j in range(min(cx.shape[1], WIDTH)):
            masks[np.arange(len(nx)), cx[:, j]] |= np.uint64(1 << j)
        masks[:, 0] = 0
    for lo, hi in zip(ends, ends[1:]):
        chunk = np.array(sorted(order[lo:hi].tolist(), key=names.__getitem__))
        lengths, at = np.unique(ny[chunk], return_inverse=True)
        # more bits left than these are too few letters in common
        most = of - measure.least(enough[None, :], nx[None, :], lengths[:, None])
        most = (np.maximum(most, -1) + 1).astype(small)
        found = []
        for i in range(0, len(chunk), 64):
            own = chunk[i : i + 64]
            left = np.empty((len(own), len(nx)), small)
            for r, c in enumerate(own.tolist()):
                walk.to(names[c], left[r])
            r, c = np.divmod(np.flatnonzero(left < most[at[i : i + 64]]), len(nx))
            found.append((c, own[r], of - left[r, c].astype(np.int64)))
        p2, q2, common = (np.concatenate(z) for z in zip(*found))
        s2 = measure.ratio(common, nx[p2], ny[q2]) if measure.by == "common" else measure.ratio(_without_edits(masks, p2, q2, nx, cy, ny, x, y), nx[p2], ny[q2])
        p, q, s = np.concatenate([p, p2]), np.concatenate([q, q2]), np.concatenate([s, s2])
        by = np.lexsort((first[q], -s, p))
        p, q, s = p[by], q[by], s[by]
        place = np.arange(len(p)) - np.searchsorted(p, p)
        kth = place == k - 1
        enough[p[kth]] = s[kth]
        p, q, s = (v[place < k] for v in (p, q, s))
    return p, q, s


def _without_edits(masks: np.ndarray, p: np.ndarray, q: np.ndarray, nx: np.ndarray, cy: np.ndarray, ny: np.ndarray, x: list[str], y: list[str]) -> np.ndarray:
    """Letters of the longer name of each pair that need no edit."""
    got = np.empty(len(p), np.int64)
    for s in range(0, len(p), 1 << 15):
        i, j = p[s : s + (1 << 15)], q[s : s + (1 << 15)]
        edits = _edits(masks, i, nx[i], cy[j], ny[j])
        for w in np.flatnonzero(nx[i] > WIDTH).tolist():
            edits[w] = _edits_long(x[i[w]], y[j[w]])
        got[s : s + (1 << 15)] = np.maximum(nx[i], ny[j]) - edits
    return got


def top_names(left: DataFrame, right: DataFrame, on: str, a_id: str, b_id: str, name_a: str, name_b: str, measure: Measure, *, k: int = 5, words_sorted: bool = False, part: int = PART) -> DataFrame:
    """Left rows (a_id, on, name) with the k best right rows among all of equal `on`, and the score; equal scores in the
    right rows' order. words_sorted: names are compared by their sorted words."""
    left = cut(left, "left-rows")
    a = left.where(F.col(on).isNotNull()).select(on, name_a).distinct()
    # the k best rows have no more than k of one name; each name has a number, by which its rows are fetched last
    rows = row_number_top(right.where(F.col(on).isNotNull()), [on, name_b], [F.asc(b_id)], k)
    held = F.sort_array(F.collect_list(F.struct(F.col(b_id).alias("__id"), F.struct(*[c for c in rows.columns if c not in (on, name_b)]).alias("__row"))))
    named = cut(rows.groupBy(on, name_b).agg(held.alias("__rows")).withColumn("__name", F.monotonically_increasing_id()), "right-names")
    b = named.select(on, name_b, "__name", F.col("__rows")[0]["__id"].alias("__first"), F.to_json("__rows.__id").alias("__ids"))  # an array can't be handed to the search
    parts = lambda df, c, most: df.groupBy(on).agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(c))
    grid = parts(a, "__na", part).join(parts(b, "__nb", WIDER * part), on)
    deal = lambda df, name, own, other, c, d: df.join(grid, on).withColumn(c, F.pmod(F.xxhash64(name), F.col(own)).cast("int")).withColumn(d, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    x, y = deal(a, name_a, "__na", "__nb", "__pa", "__pb"), deal(b, name_b, "__nb", "__na", "__pb", "__pa")
    cell = [on, "__pa", "__pb"]
    word = (lambda s: " ".join(sorted(filter(None, s.split(" "))))) if words_sorted else str

    def run(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        i, j, s = nearest([word(v) for v in p[name_a]], [word(v) for v in q[name_b]], q["__first"].to_numpy(), k, measure)
        found = {c: q[c].to_numpy()[j] for c in ("__name", "__first", "__ids")}
        return pd.DataFrame({on: p[on].to_numpy()[i], name_a: p[name_a].to_numpy()[i], **found, "__units": s})

    kind = dict(right.dtypes)[b_id]
    got = x.select(*cell, name_a).groupBy(*cell).cogroup(y.select(*cell, name_b, "__name", "__first", "__ids").groupBy(*cell)).applyInPandas(run, f"{on} string, {name_a} string, __name bigint, __first {kind}, __ids string, __units bigint")
    # the k best rows have no more than k names, and those come first by score and first row
    best = row_number_top(got, [on, name_a], [F.desc("__units"), F.asc("__first")], k)
    best = row_number_top(best.select(on, name_a, "__name", "__units", F.posexplode(F.from_json("__ids", f"array<{kind}>")).alias("__at", "__id")), [on, name_a], [F.desc("__units"), F.asc("__id")], k).drop("__id")
    fetched = named.select("__name", name_b, F.posexplode("__rows").alias("__at", "__held")).select("__name", "__at", name_b, "__held.__row.*")
    return left.join(best, [on, name_a]).join(fetched, ["__name", "__at"]).withColumn("score", F.col("__units") / F.lit(float(measure.unit))).drop("__units", "__name", "__at")
