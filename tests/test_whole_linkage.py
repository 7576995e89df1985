"""Linkage over the keys of the survey, on registries of a few rows."""

import pytest

import __spark_entry__ as entry

MFR = "record_no int, mfr_id string, facility_name string, region string, woreda string, zone string, existing_dhis2_id string, facility_type string"
DHIS2 = "record_no int, dhis2_uid string, dhis2_name string, regional string, wereda string, zonal string, facilitytype string"


@pytest.fixture
def registries(spark, tmp_path):
    def write(mfr, dhis2):
        at = str(tmp_path / "sf")
        for name, rows, kind in (("stg_mfr_facilities", mfr, MFR), ("stg_dhis2_facilities", dhis2, DHIS2)):
            spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{at}/{name}.parquet")
        return at

    return write


def ids(df):
    return sorted(map(tuple, df.collect()))


def test_names_are_translated_and_expanded_before_blocking(spark, registries):
    m = [(1, "m1", "Bole HC", "R", None, None, None, None), (2, "m2", "አበባ", "R", None, None, None, None), (3, "m3", "ጤና post", "R", None, None, None, None)]
    u = [(1, "u1", "Bole Health Center", "R", None, None, None), (2, "u2", "ሰላም", "R", None, None, None), (3, "u3", "Health post", "R", None, None, None)]
    d = registries(m, u)
    # the brute force: all pairs of equal region whose preprocessed keys agree
    assert ids(entry.queries()["j04_compound_block"](spark, d)) == [(1, 1), (3, 3)]
    exact = entry.queries()["g01_a11_features"](spark, d).where("name_exact = 1").select("a_rid", "b_rid")
    assert ids(exact) == [(1, 1), (3, 3)]
    assert ids(entry.queries()["j10_topk_candidates"](spark, d).where("score = 100").select("a_rid", "b_rid")) == [(1, 1), (3, 3)]


def test_pipeline_takes_its_threshold_from_the_labels(spark, registries):
    # m1-u1 is the only true link and scores under 0.8 without places; the other candidates score lower
    m = [(1, "m1", "Bole Kebena Alem", "R", None, None, "u1", None), (2, "m2", "Tulu", "R", None, None, None, None)]
    u = [(1, "u1", "Bole Kebena Alam", "R", None, None, None), (2, "u2", "Tulu", "R", None, None, None)]
    q = entry.queries()["c01_pipeline"]
    row = q(spark, registries(m, u)).first()
    assert (row.total, row.mfr_matched, row.dhis2_matched, row.mfr_coverage) == (2, 2, 2, "100.0%")
    # without a candidate that has a label the default holds, where 0.8 x 1 reaches it
    row = q(spark, registries([(*x[:6], None, None) for x in m], [(1, "u1", "Bole Kebena Alam", "R", None, None, None)])).first()
    assert (row.total, row.mfr_coverage) == (0, "0.0%")


def test_phonetic_blocks_hold_variant_spellings(spark, registries):
    m = [(1, "m1", "Bole", "R", None, None, None, None), (2, "m2", "Tulu", "S", None, None, None, None), (3, "m3", "", "S", None, None, None, None)]
    u = [(1, "u1", "Bolle", None, None, None, None), (2, "u2", "Tullu", "R", None, None, None), (3, "u3", "", "S", None, None, None)]
    assert ids(entry.queries()["j05_phonetic_block"](spark, registries(m, u))) == [(1, 1), (2, 2)]


def test_unmatched_of_both_sides_and_subset_matches(spark, registries):
    m = [(1, "m1", "Bole HC", "R Region", "w", "z", None, "Health Center"), (2, "m2", "Tulu", "S", None, None, None, "General Hospital")]
    u = [(1, "u1", "Bole Health Center", "R", "w", "z", "Health Center"), (2, "u2", "Kera", "S", None, None, "General Hospital")]
    d = registries(m, u)
    spark.createDataFrame([("m1", "u1")], "mfr_id string, dhis2_uid string").write.parquet(f"{d}/facility_linkage.parquet")
    q = entry.queries()
    want = [(s, by, v, 1, by == "facility_type") for s in ("dhis2", "mfr") for by, v in (("facility_type", "General Hospital"), ("region", "S"))]
    assert ids(q["c06_unmatched_sides"](spark, d)) == want
    assert ids(q["c08_subset_link"](spark, d)) == [("m1", "u1", 1.0)]
