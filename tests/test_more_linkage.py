"""Pairs of names, scores in blocks, generators, listings and romanised letters."""

import logging

import pytest
from pyspark.sql import functions as F

from weft.functions import scripts
from weft.functions import similarity as sim
from weft.operators import blocking, scoring
from weft.sources import files, generate


def ids(df):
    return sorted(map(tuple, df.collect()))


def test_pairs_of_names_spread_to_records_equal_pairs_of_records(spark):
    a = spark.createDataFrame([(1, "r", "A1", "ab"), (2, "r", "A1", "ab"), (3, None, "A1", "ab"), (4, "s", "B1", "ba"), (5, "r", "", ""), (6, "r", None, None)], "rid int, region string, phonetic string, name string")
    b = spark.createDataFrame([(1, "r", "A1", "ac"), (2, "r", "A1", "ab"), (3, "s", "C1", "bb"), (4, "r", "", "")], "rid int, region string, phonetic string, name string")
    # ranks: ab ac ba bb
    want = [(1, 1), (1, 2), (2, 1), (2, 2), (4, 3)]
    assert ids(blocking.candidates(a, b, "rid", "rid", phonetic="phonetic", region="region", sort_key="name")) == want
    assert blocking.candidates(a.limit(0), b, "rid", "rid", phonetic="phonetic", region="region", sort_key="name").count() == 0
    # without regions on one side the phonetic key and the neighbourhood alone; region clashes with nothing
    got = ids(blocking.candidates(a, b.drop("region"), "rid", "rid", phonetic="phonetic", region="region", sort_key="name"))
    assert (3, 2) in got and (4, 1) in got and not [p for p in got if 5 in p or p[1] == 4]


@pytest.mark.parametrize("batch", [1, 3, 64])
def test_scores_in_blocks(spark, batch):
    rows = [(i, x, y) for i, (x, y) in enumerate([("abc", "abd"), ("", ""), (None, "a"), ("x" * 5000, "x" * 5000), ("abc", "abc"), ("abc", "abc")])]
    df = spark.createDataFrame(rows, "i int, p string, q string").withColumn("score", F.lit("clash"))
    sizes = lambda x, y: sim.dice_list(x, y) if len(x) <= batch else 1 / 0
    got = {r.i: r.score for r in scoring.batched(df, sizes, "p", "q", batch=batch).collect()}
    assert got == {0: 0.5, 1: 1.0, 2: 0.0, 3: 1.0, 4: 1.0, 5: 1.0}
    assert scoring.batched(df.limit(0), sizes, "p", "q").count() == 0
    seen_rows, seen = scoring.progress(scoring.batched(df, sizes, "p", "q", batch=batch))
    assert seen_rows.count() == 6 and seen.get == {"pairs": 6, "scored": 6, "best": 1.0}


def test_calibration_document(spark):
    s = spark.createDataFrame([(0.5, 0.4, 1.0, 0.57, 4, 6, 0, 0), (0.6, 0.8, 0.8, 0.8, 3, 1, 1, 5), (0.7, 0.8, 0.8, 0.8, 3, 1, 1, 5)], "threshold double, precision double, recall double, f1 double, tp int, fp int, fn int, tn int")
    row = scoring.calibration_document(s).selectExpr("get_json_object(document, '$.optimal_threshold') t", "get_json_object(document, '$.all_results[2].tp') tp").first()
    assert (float(row.t), int(row.tp)) == (0.6, 3)


def test_generated_registries(spark):
    a, b, c = generate.three_registries(spark, 80)
    assert a.count() == 80 and set(r.region for r in a.select("region").distinct().collect()) <= set(generate.VARIANTS["left"].values())
    assert c.join(b, c.dhis2_id == b.facility_id, "left_anti").count() == 0 and c.count() > 0
    lab = generate.positional_labels(a, b, "facility_id", "facility_id", sample=20)
    assert lab.where("label = 1").count() == 10 and lab.where("label = 0").count() == 10 and lab.count() == lab.distinct().count()
    assert generate.positional_labels(a.limit(0), b, "facility_id", "facility_id").count() == 0


def test_listing_and_log(spark, tmp_path):
    (tmp_path / "b.txt").write_text("12345")
    (tmp_path / "a.txt").write_text("1")
    got = files.file_listing(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.bytes) for r in got] == [("a.txt", 1), ("b.txt", 5)]
    log = files.log_to(str(tmp_path / "run.log"))
    assert files.log_to(str(tmp_path / "run.log")) is log and len([h for h in log.handlers if isinstance(h, logging.FileHandler)]) == 1
    log.info("one line")
    assert (tmp_path / "run.log").read_text().endswith("one line\n")


def test_letters_of_another_script(spark):
    rows = [("ቦቺኖ ቶሼ",), ("ሄሹፋ",), ("plain SZ",), (None,), ("",), ("ኘ ጸ ዀ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(scripts.romanise(F.col("s"))).collect()]
    assert got[:5] == ["bochino toshe", "heshufa", "plain SZ", None, ""] and len(set(got)) == 6
