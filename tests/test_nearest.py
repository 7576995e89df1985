"""The nearest names inside a block, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.functions import similarity as sim
from weft.operators import nearest


def _name(r: random.Random) -> str:
    words = ["".join(r.choices("abcዳ", k=r.randint(1, 6))) for _ in range(r.randint(1, 3))] + [r.choice(["health", "post", "hospital"])]
    return " ".join(words) + r.choice(["", "", "", " " + "ab" * 40])


@pytest.mark.parametrize("measure", [nearest.TOKEN_SORT, nearest.LEVENSHTEIN])
def test_nearest_against_all_pairs(measure):
    r = random.Random(3)
    x, y = (sorted({_name(r) for _ in range(n)}) for n in (150, 200))
    first = np.array(r.sample(range(1000), len(y)))
    i, j, s = nearest.nearest(x, y, first, 5, measure)

    def units(a, b):
        if measure is nearest.TOKEN_SORT:
            return int(200 * measure.unit * sim.common_subsequence(a, b) / (len(a) + len(b)) + 0.5)
        return int(measure.unit * (1 - nearest._edits_long(a, b) / max(len(a), len(b))) + 0.5)

    want = [(p, *q) for p, a in enumerate(x) for q in sorted((-units(a, b), first[k], k) for k, b in enumerate(y))[:5]]
    assert [(p, -u, first[q], q) for p, q, u in zip(i.tolist(), j.tolist(), s.tolist())] == want


def test_top_names_search_the_whole_block(spark):
    a = spark.createDataFrame([(1, "r", "bole health post"), (2, "r", "kera clinic"), (3, None, "bole"), (4, "s", "bole")], "a int, on string, na string")
    # another first consonant, another order, the kind in front: each has another phonetic key
    b = spark.createDataFrame([(1, "r", "cole health post"), (2, "r", "health post bole"), (3, "r", "kera clinic"), (4, "r", "kera clinic"), (5, None, "bole")], "b int, on string, nb string")
    for part in (1, 4096):
        got = nearest.top_names(a, b, "on", "a", "b", "na", "nb", nearest.TOKEN_SORT, k=2, words_sorted=True, part=part)
        assert sorted((r.a, r.b, r.score) for r in got.collect()) == [(1, 1, 93.8), (1, 2, 100.0), (2, 3, 100.0), (2, 4, 100.0)]


def test_candidates_of_the_region(spark, sf):
    import __spark_entry__ as entry
    from weft.queries import linkage

    a, b = linkage._sides(spark, sf, linkage._whole_keys)
    p = a.where("existing_dhis2_id is null and name <> ''").select(F.col("rid").alias("a_rid"), F.col("name").alias("na"), "region").join(b.where("name <> ''").select(F.col("rid").alias("b_rid"), F.col("name").alias("nb"), "region"), "region")
    p = p.withColumn("score", F.round(sim.token_sort_ratio(F.col("na"), F.col("nb")), 1))
    want = linkage.registry.row_number_top(p, ["a_rid"], [F.desc("score"), F.asc("b_rid")], 5).select("a_rid", "b_rid", "score")
    got = entry.queries()["j10_topk_candidates"](spark, sf).select("a_rid", "b_rid", "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("few", [0, 10**6])
@pytest.mark.parametrize("measure", [nearest.TOKEN_SORT, nearest.LEVENSHTEIN])
def test_names_of_every_width(measure, few, monkeypatch):
    """Half a machine word, one, several; walked from either side, in pieces of any size; a name's end or its beginning shared."""
    monkeypatch.setattr(nearest, "FEW", few)
    monkeypatch.setattr(nearest, "LETTERS", 2000)
    monkeypatch.setattr(nearest, "LATER", 16)
    r = random.Random(5)
    mk = lambda: "".join(r.choices("abcdeዳ", k=r.choice([1, 20, 31, 32, 33, 63, 64, 65, 128, 200]))) + r.choice(["", " health post"])
    x, y = (sorted({mk() for _ in range(n)}) for n in (20, 60))
    first = np.array(r.sample(range(1000), len(y)))

    def units(a, b):
        if measure is nearest.TOKEN_SORT:
            return (4000 * sim.common_subsequence(a, b) + len(a) + len(b)) // (2 * (len(a) + len(b)))
        n = max(len(a), len(b))
        return (2_000_000 * (n - nearest._edits_long(a, b)) + n) // (2 * n)

    want = [(p, *q) for p, a in enumerate(x) for q in sorted((-units(a, b), first[k], k) for k, b in enumerate(y))[:3]]
    i, j, s = nearest.nearest(x, y, first, 3, measure)
    assert [(p, -u, first[q], q) for p, q, u in zip(i.tolist(), j.tolist(), s.tolist())] == want


@pytest.mark.parametrize(("measure", "k"), [(nearest.TOKEN_SORT, 5), (nearest.LEVENSHTEIN, 1)])
def test_few_pairs_get_a_score(measure, k, monkeypatch):
    """All pairs are told apart by their letters in common; only what can be among the best is scored."""
    r = random.Random(6)
    x = sorted({"".join(r.choices("abcdefghijklmnop", k=r.randint(8, 14))) + r.choice([" clinic", " health post"]) for _ in range(300)})
    # each name is there in some spellings, among others
    y = sorted({v[:i] + r.choice("abc") + v[i + 1 :] for v in x for i in range(5)} | {"".join(r.choices("abcdefghijklmnop", k=12)) + " clinic" for _ in range(2500)})
    scored, ratio = [0], nearest.Measure.ratio
    monkeypatch.setattr(nearest.Measure, "ratio", lambda self, common, na, nb: (scored.__setitem__(0, scored[0] + np.size(common)), ratio(self, common, na, nb))[1])
    nearest.nearest(x, y, np.arange(len(y)), k, measure)
    assert 0 < scored[0] < 0.1 * len(x) * len(y)


@pytest.mark.parametrize(("measure", "k"), [(nearest.TOKEN_SORT, 5), (nearest.LEVENSHTEIN, 1)])
def test_few_pairs_are_counted(measure, k, monkeypatch):
    """Most pairs are told apart by their letters in any order; the rest are counted, and nothing is lost by that."""
    r = random.Random(7)
    mk = lambda: "".join(r.choice("bcdfghjklmnpqrstvwz") + r.choice("aeiou") for _ in range(r.randint(4, 6))) + r.choice([" clinic", " health post", " hospital 02"])
    x, y = sorted({mk() for _ in range(400)}), sorted({mk() for _ in range(6000)} | {"aaaa" * 15 + "b" * i for i in range(1, 9)})
    first, counted, common = np.array(r.sample(range(10**6), len(y))), [0], nearest._Sieve.common
    monkeypatch.setattr(nearest._Sieve, "common", lambda self, p, q: (counted.__setitem__(0, counted[0] + len(p)), common(self, p, q))[1])
    monkeypatch.setattr(nearest, "PENDING", 1 << 12)
    i, j, s = nearest.nearest(x, y, first, k, measure)
    assert 0 < counted[0] < 0.15 * len(x) * len(y)
    monkeypatch.setattr(nearest, "FEW", 10**6)  # each left name against all right names
    for got, want in zip((i, j, s), nearest.nearest(x, y, first, k, measure)):
        assert got.tolist() == want.tolist()
