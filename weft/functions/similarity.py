"""Similarities of two texts or vectors; native where the engine has the parts, vectorised functions where not."""

from __future__ import annotations

from collections import Counter
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def exact(a: Column, b: Column) -> Column:
    return F.coalesce((a == b).cast("double"), F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 for a missing side or two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.coalesce(F.when(longest > 0, 1 - F.levenshtein(a, b) / longest), F.lit(0.0))


def at_least(similarity: Column, threshold: float = 0.6) -> Column:
    return (F.coalesce(similarity, F.lit(0.0)) >= threshold).cast("double")


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Jaro similarity with a bonus for up to four equal first letters where it is above 0.7."""
    if a == b:
        return 1.0 if a else 0.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(0, max(n, m) // 2 - 1)
    used, got = [False] * m, []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                got.append(c)
                break
    k = len(got)
    if not k:
        return 0.0
    other = [b[j] for j in range(m) if used[j]]
    turned = sum(x != y for x, y in zip(got, other)) // 2
    jaro = (k / n + k / m + (k - turned) / k) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return jaro + same * scale * (1 - jaro)


def _by_pair(a: pd.Series, b: pd.Series, f) -> pd.Series:
    """f over the distinct pairs of a batch only."""
    both = pd.MultiIndex.from_arrays([a.fillna(""), b.fillna("")])
    codes, pairs = pd.factorize(both)
    return pd.Series(np.array([f(x, y) for x, y in pairs] or [0.0])[codes] if len(codes) else np.empty(0))


@F.pandas_udf(DoubleType())
def jaro_winkler_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return _by_pair(a, b, jaro_winkler)


def bigrams(text: str) -> Counter:
    """Counts of the character bigrams inside words, each word padded by a space on both sides."""
    out: Counter = Counter()
    for w in text.split(" "):
        if w:
            p = f" {w} "
            out.update(p[i : i + 2] for i in range(len(p) - 1))
    return out


def _cosine(a: str, b: str) -> float:
    x, y = bigrams(a), bigrams(b)
    below = sqrt(sum(v * v for v in x.values())) * sqrt(sum(v * v for v in y.values()))
    return sum(v * y[g] for g, v in x.items() if g in y) / below if below else 0.0


@F.pandas_udf(DoubleType())
def bigram_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    # as array expressions the engine would build both lists anew for every gram it counts
    return _by_pair(a, b, _cosine)


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")), " ")


def common_subsequence(a: str, b: str) -> int:
    last = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        last = row
    return last[-1]


@F.pandas_udf(DoubleType())
def _indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _by_pair(a, b, lambda x, y: 200.0 * common_subsequence(x, y) / (len(x) + len(y)) if x or y else 100.0)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """100 x the normalised indel similarity of the sorted words."""
    return _indel_ratio(sorted_tokens(a), sorted_tokens(b))


def vector_cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    below = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(below > 0, dot(a, b) / below)


def dice_list(a: list[str], b: list[str]) -> list[float]:
    """The share of equal bigrams of each pair of texts; texts without any are alike only if they are equal."""
    grams = lambda t: {t[i : i + 2] for i in range(len(t) - 1)}
    return [2 * len(x & y) / (len(x) + len(y)) if x or y else float(p == q) for p, q in zip(a, b) for x, y in ((grams(p), grams(q)),)]
