"""Pairs of candidates are made where they are used: none is shuffled, gathered or written on the way."""

import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weft.operators import blocking, scoring
from weft.queries import linkage

PAIR = ({"name_a", "name_b"}, {"a_rid", "b_rid"}, {"fid_a", "fid_b"})
STREAMED = [
    "j08_candidates_union", "p08_no_region", "j17_a17_reduction", "g01_a11_features", "g04_bigram_cosine", "g06_a09_scored_pairs", "a03_score_stats", "p13_matches", "c03_combined",
    "a12_confusion", "a13_threshold_sweep", "a14_best_threshold", "snk05_calibration_json", "w06_scored_blocks",
]


def moved(df) -> list[str]:
    """The joins, groupings and dealings of a plan that take pairs."""
    found = []

    def walk(node):
        name, children = node.nodeName(), [node.children().apply(i) for i in range(node.children().size())]
        takes = (name == "Join" and node.condition().isDefined()) or (name == "Aggregate" and not node.groupingExpressions().isEmpty() and "__bin" not in str(node)) or name.startswith("Repartition")
        for c in children:
            columns = {c.output().apply(i).name() for i in range(c.output().size())}
            if takes and any(p <= columns for p in PAIR):
                found.append(name)
            walk(c)

    walk(df._jdf.queryExecution().optimizedPlan())
    return found


@pytest.mark.parametrize("name", STREAMED)
def test_no_pair_is_moved(spark, sf, name):
    assert moved(entry.queries()[name](spark, sf)) == []


@pytest.mark.parametrize("name", ["c01_pipeline", "c13_report", "c08_subset_link"])
def test_scored_pairs_are_not_written(spark, sf, name, monkeypatch):
    written = []
    monkeypatch.setattr(linkage, "cut", lambda df, label="stage", real=linkage.cut: written.append(label) or real(df, label))
    entry.queries()[name](spark, sf)
    assert not {"scored", "name-pairs"} & set(written)


def test_labels_are_looked_up_and_not_all_candidates(spark, sf, monkeypatch):
    m = linkage.table(spark, sf, "stg_mfr_facilities").select(F.trim("mfr_id").alias("mfr_id"), F.trim("existing_dhis2_id").alias("dhis2_id")).where("dhis2_id is not null").distinct()
    pairs = blocking.expand(linkage._pairs(*linkage._sides(spark, sf), ["fid"])).select(F.trim("fid_a").alias("mfr_id"), F.trim("fid_b").alias("dhis2_id")).distinct()
    want = sorted(map(tuple, pairs.join(m, ["mfr_id", "dhis2_id"]).collect()))
    monkeypatch.setattr(blocking, "name_pairs", None)  # not asked for
    assert sorted(map(tuple, entry.queries()["j02_label_join"](spark, sf).collect())) == want


def test_crowded_blocks_are_dealt(spark):
    r = random.Random(2)
    rows = [(i, r.choice("RS"), "k", r.choice("ab") + str(r.randint(0, 12))) for i in range(80)]
    a, b = (spark.createDataFrame(x, "rid int, region string, phonetic string, name string") for x in (rows[:40], rows[40:]))
    want = sorted((x[0], y[0]) for x in rows[:40] for y in rows[40:] if x[1] == y[1])
    for part in (1, 3, 512):
        got = blocking.expand(blocking.name_pairs(a, b, "rid", "rid", phonetic="phonetic", region="region", name="name", part=part))
        assert sorted(map(tuple, got.select("a_rid", "b_rid").collect())) == want


def test_statistics_and_sweep_by_counts(spark):
    r = random.Random(4)
    scores = [round(r.random(), 6) for _ in range(400)] + [0.5 + i * 0.01 for i in range(50)] + [0.0, 1.0]
    for n in (0, 1, 2, 7, len(scores)):
        df = spark.createDataFrame([(s, i % 2) for i, s in enumerate(scores[:n])], "score double, label int")
        c = F.col("score")
        want = df.agg(F.avg(c), F.median(c), F.min(c), F.max(c), F.stddev(c), F.count(c)).first()
        got = scoring.score_stats(df).first()
        assert all(x == y if x is None or y is None else math.isclose(x, y, abs_tol=5e-6 if i == 1 else 1e-9) for i, (x, y) in enumerate(zip(got, want)))
    grid = [0.5 + i * ((0.5 + 0.01) - 0.5) for i in range(50)]
    for s in scoring.threshold_sweep(df).collect():
        t = min(grid, key=lambda g: abs(g - s.threshold))
        assert (s.tp, s.fp) == tuple(sum(x >= t and i % 2 == y for i, x in enumerate(scores)) for y in (1, 0))
