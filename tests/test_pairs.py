"""Similarities of many pairs at once, against those of one pair."""

import random

import numpy as np

from weft.functions import pairs
from weft.functions import similarity as sim


def _names(n: int) -> list[str]:
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdeዳ", k=r.randint(1, 7)))
    some = [" ".join([*(word() for _ in range(r.randint(1, 3))), r.choice(["health post", "clinic"])]) for _ in range(n)]
    return [*some, "", " ", "a", "ab", "b  a", "ab " * 30, "x" * 64, "x" * 63 + "y", "xy" * 33, "abcab" * 20]


def test_many_pairs_as_one_by_one():
    x = _names(60)
    p, q = (c.ravel() for c in np.meshgrid(np.arange(len(x)), np.arange(len(x))))
    w, every = pairs.Pairs(x, p, q), np.arange(len(p))
    both = [(x[i], x[j]) for i, j in zip(p.tolist(), q.tolist())]
    lev = [1 - pairs._edits(a, b) / max(len(a), len(b)) if a or b else 0.0 for a, b in both]
    jaro, cos = [sim.jaro_winkler(a, b) for a, b in both], [sim._cosine(a, b) for a, b in both]
    assert w.spread(w.levenshtein(every)).tolist() == lev
    assert w.spread(w.jaro_winkler(every)).tolist() == jaro
    assert np.allclose(w.spread(w.cosine(every)), cos, rtol=0, atol=1e-15)
    mean = np.array([(a + b + c) / 3 for a, b, c in zip(lev, jaro, cos)])
    assert np.allclose(pairs.likeness(w), mean, rtol=0, atol=1e-15)
    kept = pairs.likeness(w, 0.75)
    assert (~np.isnan(kept[mean >= 0.75])).all() and np.allclose(kept[~np.isnan(kept)], mean[~np.isnan(kept)], rtol=0, atol=1e-15)
