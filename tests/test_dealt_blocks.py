"""What is shuffled for the pairs of crowded blocks keeps in proportion to the names, and every pair is made once."""

import random

import pytest

from weft.operators import blocking


def sides(spark, n: int, seed: int = 5):
    r = random.Random(seed)
    rows = [(i, "R", r.choice("kkkl"), f"{r.choice('ab')}{i:05d}") for i in range(2 * n)]
    return tuple(spark.createDataFrame(x, "rid int, region string, phonetic string, name string") for x in (rows[:n], rows[n:])), rows[:n], rows[n:]


def test_names_are_copied_in_proportion(spark, monkeypatch):
    dealt = []
    of = type(spark.range(1))
    real = of.repartition
    monkeypatch.setattr(of, "repartition", lambda self, *a: dealt.append(self) or real(self, *a))
    copies = []
    for n in (300, 1200):
        dealt.clear()
        (a, b), _, _ = sides(spark, n)
        blocking.name_pairs(a, b, "rid", "rid", phonetic="phonetic", region="region", name="name", part=4)
        copies.append(sum(x.count() for x in dealt if "__sound" in x.columns) / n)
    assert copies[0] <= 16 and copies[1] <= 1.2 * copies[0]


@pytest.mark.parametrize(("part", "grid"), [(1, 3), (7, 8), (64, 2), (512, 8)])
def test_grid_makes_every_pair_once(spark, part, grid):
    (a, b), left, right = sides(spark, 60)
    names = sorted(x[3] for x in left + right)
    want = sorted((x[0], y[0]) for x in left for y in right if x[2] == y[2] or abs(names.index(x[3]) - names.index(y[3])) <= 1)
    got = blocking.expand(blocking.name_pairs(a, b, "rid", "rid", phonetic="phonetic", region=None, name="name", part=part, grid=grid))
    assert sorted(map(tuple, got.select("a_rid", "b_rid").collect())) == want
