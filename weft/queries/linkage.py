"""Queries of record linkage between the two registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import pairs as many
from weft.functions import scripts
from weft.functions import similarity as sim
from weft.functions import text as t
from weft.operators import blocking, judge, nearest, registry, scoring
from weft.queries import text as tq
from weft.session import cut, table


def _sides(spark: SparkSession, d: str, keys=None) -> tuple[DataFrame, DataFrame]:
    """Both registries conformed to one schema: id, name, region, woreda, zone, with the derived keys (_keys unless others are named)."""
    m = table(spark, d, "stg_mfr_facilities").select(F.col("record_no").alias("rid"), F.col("mfr_id").alias("fid"), "facility_name", "region", "woreda", "zone", "existing_dhis2_id")
    u = table(spark, d, "stg_dhis2_facilities").select(
        F.col("record_no").alias("rid"), F.col("dhis2_uid").alias("fid"), F.col("dhis2_name").alias("facility_name"), F.col("regional").alias("region"), F.col("wereda").alias("woreda"), F.col("zonal").alias("zone")
    )
    return tuple((keys or _keys)(x) for x in (m, u))


def _name(c) -> Column:
    """A name translated, expanded, normalised and, what is then left in the other script, romanised; so letters are told
    apart, spellings of either script meet, and every engine counts letters alike."""
    return scripts.romanise(t.normalize_text(t.expand_abbreviations(t.transliterate_amharic(F.col(c)))))


def _keys(df: DataFrame) -> DataFrame:
    """The keys of a record. The region as delivered is kept beside the one that is compared."""
    x = df.distinct().withColumns({"region_raw": F.col("region"), "region": t.normalize_region(F.col("region")), "name": _name("facility_name")})  # rows delivered twice are one record
    return x.withColumn("phonetic", t.phonetic_key(F.col("name")))


#: the keys of the whole name
_whole_keys = _keys


def p18_raw_region(spark: SparkSession, d: str) -> DataFrame:
    """The region as delivered beside the one that took its place."""
    return _sides(spark, d)[0].select("rid", "region_raw", "region")


def _named(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return tuple(x.where("name <> ''") for x in _sides(spark, d))


def j04_compound_block(spark: SparkSession, d: str) -> DataFrame:
    return blocking.block(*_named(spark, d), ["region", "phonetic"], "rid", "rid")


def j05_phonetic_block(spark: SparkSession, d: str) -> DataFrame:
    """Blocking by the phonetic key alone, where a registry has no region. Hot keys are dealt over the right rows' salt."""
    salts = F.sequence(F.lit(0), F.lit(7))
    a, b = _named(spark, d)
    a = a.withColumn("salt", F.explode(salts))
    b = b.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(8)).cast("int"))
    return blocking.block(a, b, ["phonetic", "salt"], "rid", "rid")


def j06_sorted_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    return blocking.sorted_neighbourhood(*_named(spark, d), "name", "rid", "rid", block_keys=["region"])


def j07_neighbourhood_anywhere(spark: SparkSession, d: str) -> DataFrame:
    return blocking.sorted_neighbourhood(*_named(spark, d), "name", "rid", "rid")


PLACES = ["fid", "region", "woreda", "zone"]


def _pairs(a: DataFrame, b: DataFrame, columns: list[str] = ()) -> DataFrame:
    return blocking.name_pairs(a, b, "rid", "rid", phonetic="phonetic", region="region", name="name", columns=columns)


def j08_candidates_union(spark: SparkSession, d: str) -> DataFrame:
    return blocking.expand(_pairs(*_sides(spark, d))).select("a_rid", "b_rid")


def p08_no_region(spark: SparkSession, d: str) -> DataFrame:
    """The candidates of a plan without regions, where the right registry has no such column."""
    a, b = _sides(spark, d, lambda df: df.select("rid", "region", _name("facility_name").alias("name")).withColumn("phonetic", t.phonetic_key(F.col("name"))))
    return blocking.candidates(a, b.drop("region"), "rid", "rid", phonetic="phonetic", region="region", sort_key="name")


def j17_a17_reduction(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    return blocking.reduction(a, b, _pairs(a, b))


def _features(pairs: DataFrame) -> DataFrame:
    """Names are compared as pairs of names and then spread to records."""
    return scoring.features(blocking.expand(scoring.name_features(pairs, "name")), "name", ["region", "woreda"])


def g01_a11_features(spark: SparkSession, d: str) -> DataFrame:
    f = _features(_pairs(*_sides(spark, d), ["region", "woreda"]))
    return f.select("a_rid", "b_rid", "name_exact", "name_levenshtein", "name_jaro_winkler", "region_exact", "woreda_exact")


def g04_bigram_cosine(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(*_sides(spark, d), ["region", "woreda"])
    f = _features(p.withColumn("cosine", F.round(many.bigram_cosine(F.col("name_a"), F.col("name_b")), 6)))
    return f.select("a_rid", "b_rid", "cosine", "feature_sum", F.round("feature_mean", 6).alias("feature_mean"))


def _score(pairs: DataFrame, least: float | None = None) -> DataFrame:
    """Names are compared as pairs of names and then spread to records. least: pairs of names that no places can lift to this
    score are left out before that."""
    text = None if least is None else (least - 0.2) / 0.8 - 1e-6
    pairs = pairs.withColumn("__text", scoring.name_likeness(F.col("name_a"), F.col("name_b"), text))
    return scoring.lexical_score("name")(blocking.expand(pairs if text is None else pairs.where(F.col("__text") >= text)))


def _scored(spark: SparkSession, d: str, least: float | None = None) -> DataFrame:
    return _score(_pairs(*_sides(spark, d), PLACES), least)


def g06_a09_scored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with the score over its range in this batch."""
    s = scoring.min_max(_scored(spark, d))
    return s.select("a_rid", "b_rid", F.round("score", 5).alias("score"))


def a03_score_stats(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.score_stats(_scored(spark, d))
    return s.select(*[F.round(c, 5).alias(c) for c in ("mean", "median", "min", "max", "std")], "n")


def p13_matches(spark: SparkSession, d: str) -> DataFrame:
    """Matches from the threshold up, all that reach it."""
    s = _scored(spark, d, 0.8).where(F.round("score", 6) >= 0.8)
    return s.select(F.col("fid_a").alias("mfr_id"), F.col("fid_b").alias("dhis2_id"), F.round("score", 5).alias("score"), F.lit("inferred").alias("match_type"))


def _label_pairs(spark: SparkSession, d: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Candidate pairs of names whose left records carry the references of their facility."""
    m = table(spark, d, "stg_mfr_facilities").select(F.trim("mfr_id").alias("__key"), F.trim("existing_dhis2_id").alias("ref")).where("ref is not null")
    refs = m.groupBy("__key").agg(F.collect_set("ref").alias("refs"))
    return _pairs(a.withColumn("__key", F.trim("fid")).join(refs, "__key", "left"), b, [*PLACES, "refs"])


def _labelled(pairs: DataFrame) -> DataFrame:
    """Candidate pairs (_label_pairs) labelled by the links both registries name, 1 where the reference says so."""
    has = F.exists("__rows_a", lambda r: r["refs_a"].isNotNull())
    s = _score(pairs.where(has)).select(F.trim("fid_b").alias("dhis2_id"), F.round("score", 6).alias("score"), F.explode("refs_a").alias("ref"))
    return s.withColumn("label", (F.col("ref") == F.col("dhis2_id")).cast("int"))


def j02_label_join(spark: SparkSession, d: str) -> DataFrame:
    """Labels that are candidates too; the others are lost to calibration."""
    m = table(spark, d, "stg_mfr_facilities").select(F.trim("mfr_id").alias("mfr_id"), F.trim("existing_dhis2_id").alias("dhis2_id")).where("dhis2_id is not null").distinct()
    a, b = _sides(spark, d)
    a, b = (cut(x.select(F.trim("fid").alias(k), "region", "phonetic", "name"), "label-side") for x, k in ((a, "mfr_id"), (b, "dhis2_id")))
    return blocking.candidates_among(m, a, b, a_key="mfr_id", b_key="dhis2_id", phonetic="phonetic", region="region", name="name").select("mfr_id", "dhis2_id")


def a13_threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    s = scoring.threshold_sweep(_labelled(_label_pairs(spark, d, *_sides(spark, d))))
    return s.select(*[F.round(c, 6).alias(c) for c in ("threshold", "precision", "recall", "f1")], "tp", "fp", "fn", "tn")


def a14_best_threshold(spark: SparkSession, d: str) -> DataFrame:
    return scoring.best_threshold(a13_threshold_sweep(spark, d))


def a12_confusion(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(_label_pairs(spark, d, *_sides(spark, d))).agg(*scoring.confusion(None, 0.8))


def j10_topk_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest names in the region of each facility without a reference, by sorted words."""
    a, b = _sides(spark, d)
    a = a.where(F.col("existing_dhis2_id").isNull() & (F.col("name") != "")).select(F.col("rid").alias("a_rid"), F.col("name").alias("name_a"), "region")
    b = b.where("name <> ''").select(F.col("rid").alias("b_rid"), F.col("fid").alias("uid"), F.col("name").alias("name_b"), "region", F.col("zone").alias("zone_b"), F.col("woreda").alias("woreda_b"))
    top = nearest.top_names(a, b, "region", "a_rid", "b_rid", "name_a", "name_b", nearest.TOKEN_SORT, words_sorted=True)
    return top.select("a_rid", "b_rid", "uid", "name_b", "zone_b", "woreda_b", "score")


def j20_candidate_json(spark: SparkSession, d: str) -> DataFrame:
    c = j10_topk_candidates(spark, d).withColumns({"name": F.col("name_b"), "worst": -F.col("score")})
    return registry.candidate_lists(c, "a_rid", ["uid", "name", "score"], ["worst", "b_rid"])


def g08_c10_judged(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of the rule judge on those lists, for facilities not judged by an earlier run."""
    c = j10_topk_candidates(spark, d).withColumns({"name": F.col("name_b"), "zone": F.col("zone_b"), "woreda": F.col("woreda_b"), "worst": -F.col("score")})
    lists = registry.candidate_lists(c, "a_rid", ["uid", "name", "zone", "woreda", "score"], ["worst", "b_rid"])
    m = table(spark, d, "stg_mfr_facilities").select(F.col("record_no").alias("a_rid"), "zone", "woreda").distinct()
    return judge.judge_rows(judge.todo(m.join(lists, "a_rid", "left"), None, "a_rid"), "a_rid")


def g07_j09_embedding_top1(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other vector of the same label."""
    e = table(spark, d, "embeddings")
    b = e.select(F.col("vec_id").alias("other"), F.col("embedding").alias("e2"), "label")
    p = e.join(b, "label").where("vec_id <> other").withColumn("score", F.round(sim.vector_cosine(F.col("embedding"), F.col("e2")), 6))
    return registry.row_number_top(p.select("vec_id", "other", "score"), ["vec_id"], [F.desc("score"), F.asc("other")])


def j11_j12_c02_split(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of either registry are linked by a valid reference, and how many are not."""
    m, u = table(spark, d, "stg_mfr_facilities"), table(spark, d, "stg_dhis2_facilities")
    linked, a, b = registry.split_linked(m, u, "existing_dhis2_id", "dhis2_uid")
    n = lambda df, part: df.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
    return n(linked, "linked").unionByName(n(a, "mfr_unlinked")).unionByName(n(b, "dhis2_unlinked"))


def j12_anti(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities").select("record_no", F.col("existing_dhis2_id").alias("dhis2_uid"))
    return registry.unmatched(m, table(spark, d, "stg_dhis2_facilities"), "dhis2_uid").select("record_no", "dhis2_uid")


def _verified(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities").select("record_no", "mfr_id", F.col("facility_name").alias("mfr_name"), "existing_dhis2_id")
    u = registry.latest(table(spark, d, "stg_dhis2_facilities"), "dhis2_uid", ["record_no"])
    linked, _, _ = registry.split_linked(m, u, "existing_dhis2_id", "dhis2_uid")
    return registry.already_linked(linked, u, "existing_dhis2_id", "dhis2_uid", {"dhis2_name": "dhis2_name", "regional": "dhis2_region"})


def j13_verified(spark: SparkSession, d: str) -> DataFrame:
    return _verified(spark, d).distinct()


def c03_combined(spark: SparkSession, d: str) -> DataFrame:
    v = _verified(spark, d).distinct().select("mfr_id", F.col("existing_dhis2_id").alias("dhis2_id"), "score", "match_source")
    return registry.combine(v, p13_matches(spark, d).drop("match_source"))


def j03_c05_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Facilities of the first registry tied to judged facilities through the uid that both name."""
    ab = table(spark, d, "stg_mfr_facilities").select("mfr_id", F.trim("existing_dhis2_id").alias("uid")).where("uid is not null").distinct()
    bc = table(spark, d, "facility_linkage").select(F.trim("dhis2_uid").alias("uid"), F.col("mfr_id").alias("other_id"), "mfr_name").where("uid is not null and uid not in ('', 'null', 'None')").distinct()
    return registry.bridge(ab, bc, "uid", ["mfr_id", "uid", "other_id", "mfr_name"])


def j16_left_preserving(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities").select("mfr_id").distinct()
    k = table(spark, d, "facility_linkage").where("dhis2_uid is not null").groupBy("mfr_id").agg(F.min("dhis2_uid").alias("dhis2_uid"), F.min("reason").alias("reason"))
    return registry.with_reasons(m, k, "mfr_id", {"reason": "No candidate in the same region"})


def c04_unmapped_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions as typed that the fixed table doesn't know, without nulls."""
    known = {f"{r} Region": r for r in ("Tase Fisharu", "Kechipa", "Logida", "Semene", "Retoreje", "Gechunu")}
    m = table(spark, d, "stg_mfr_facilities").where("region is not null")
    return m.where(t.lookup(F.col("region"), known).isNull()).select("region").distinct()


def c06_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Facilities of the left registry without any link, by type. c06_unmatched_sides has both registries and regions."""
    m = table(spark, d, "stg_mfr_facilities")
    k = table(spark, d, "facility_linkage").where("dhis2_uid is not null")
    g = registry.unmatched(m, k, "mfr_id").where("facility_type is not null").groupBy("facility_type").agg(F.count("*").alias("n"))
    return g.withColumn("review", F.col("facility_type").isin("General Hospital", "Referral Hospital", "Primary Hospital"))


def c06_unmatched_sides(spark: SparkSession, d: str) -> DataFrame:
    """Facilities of either registry without any link, by region and by type, hospitals marked for review."""
    k = table(spark, d, "facility_linkage").where("dhis2_uid is not null")
    m = registry.unmatched(table(spark, d, "stg_mfr_facilities"), k, "mfr_id").select(F.lit("mfr").alias("side"), "region", "facility_type")
    u = registry.unmatched(table(spark, d, "stg_dhis2_facilities"), k, "dhis2_uid").select(F.lit("dhis2").alias("side"), F.col("regional").alias("region"), F.col("facilitytype").alias("facility_type"))
    rows = m.unionByName(u).withColumn("region", t.normalize_region(F.col("region")))
    by = lambda c: rows.where(F.col(c).isNotNull()).groupBy("side", F.lit(c).alias("by"), F.col(c).alias("value")).agg(F.count("*").alias("n"))
    return by("region").unionByName(by("facility_type")).withColumn("review", (F.col("by") == "facility_type") & F.lower("value").contains("hospital"))


def c09_batch_linkage(spark: SparkSession, d: str) -> DataFrame:
    """For each unlinked row the nearest of all names under the same cleaned place, with band and reason; no row is dropped."""
    return _batch_linkage(spark, d, table(spark, d, "stg_mfr_facilities"))


def _batch_linkage(spark: SparkSession, d: str, m: DataFrame) -> DataFrame:
    """The batch linkage of these rows of the first registry."""
    m = m.where(t.blank_to_null(F.col("existing_dhis2_id")).isNull()).distinct()
    u = table(spark, d, "stg_dhis2_facilities").distinct()
    clean = lambda c: scripts.romanise(t.clean_facility_name(F.col(c)))
    a = m.select("record_no", "mfr_id", t.normalize_geo(F.col("region")).alias("region_norm"), clean("facility_name").alias("name_a"))
    b = u.select(F.col("record_no").alias("other"), F.col("dhis2_uid").alias("uid"), t.normalize_geo(F.regexp_replace("regional", r"(?i)reg\.", "region")).alias("region_norm"), clean("dhis2_name").alias("name_b"))
    best = nearest.top_names(a.where("name_a <> ''"), b.where("name_b <> ''"), "region_norm", "record_no", "other", "name_a", "name_b", nearest.LEVENSHTEIN, k=1)
    out = m.select("record_no", "mfr_id").join(best.select("record_no", "uid", "score"), "record_no", "left").withColumn("confidence", t.confidence_band(F.col("score")))
    return out.select("record_no", "mfr_id", F.when(F.col("confidence") != "none", F.col("uid")).alias("dhis2_uid"), "confidence", t.reason_text(F.col("score"), F.col("confidence")).alias("reason"))


def c01_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The whole run: candidates, scores, the threshold calibrated by the labels, matches and their coverage."""
    a, b = _sides(spark, d)
    return _coverage(_calibrated(_label_pairs(spark, d, a, b)), a, b)


def _coverage(hits: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    n = a.agg(F.countDistinct("fid").alias("l")).crossJoin(F.broadcast(b.agg(F.countDistinct("fid").alias("r"))))
    got = hits.agg(F.count("*").alias("total"), F.countDistinct("fid_a").alias("mfr_matched"), F.countDistinct("fid_b").alias("dhis2_matched"))
    return got.crossJoin(F.broadcast(n)).select(
        "total", "mfr_matched", "dhis2_matched", t.percent(F.col("mfr_matched"), F.col("l")).alias("mfr_coverage"), t.percent(F.col("dhis2_matched"), F.col("r")).alias("dhis2_coverage")
    )


def _calibrated(pairs: DataFrame) -> DataFrame:
    """The scored pairs from the best threshold up, which is 0.8 only where no candidate has a label. No pair is kept between
    the two looks: the labels are scored for the threshold, and all pairs again for what reaches it."""
    best = scoring.best_threshold(scoring.threshold_sweep(_labelled(pairs))).select(F.round("threshold", 6)).first()
    least = best[0] if best else 0.8
    return _score(pairs, least).where(F.round("score", 6) >= least).select("fid_a", "fid_b", "score")


def c08_subset_link(spark: SparkSession, d: str) -> DataFrame:
    """A second link for health centers only: candidates, scores and matches from the calibrated threshold up."""
    a, b = (x.where(F.col("name").like("%health center")) for x in _sides(spark, d))
    hits = _calibrated(_label_pairs(spark, d, a, b))
    return hits.select(F.col("fid_a").alias("mfr_id"), F.col("fid_b").alias("dhis2_id"), F.round("score", 5).alias("score"))


def snk05_calibration_json(spark: SparkSession, d: str) -> DataFrame:
    """The calibration curve as one JSON document: the best threshold and all rows of the sweep."""
    return scoring.calibration_document(a13_threshold_sweep(spark, d))


def w06_scored_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Candidate names scored in blocks of 64 pairs, as a model would be asked; here by their share of equal bigrams."""
    return scoring.batched(_pairs(*_sides(spark, d)), sim.dice_list, "name_a", "name_b").select(F.col("__block").alias("region"), "name_a", "name_b", F.round("score", 6).alias("score"))


def p21_display_name(spark: SparkSession, d: str) -> DataFrame:
    """The name to show for each facility: that of the second registry where it is linked, else its own."""
    m = table(spark, d, "stg_mfr_facilities").select("mfr_id", "facility_name", "existing_dhis2_id").distinct()
    u = table(spark, d, "stg_dhis2_facilities").groupBy(F.col("dhis2_uid").alias("existing_dhis2_id")).agg(F.min("dhis2_name").alias("dhis2_name"))
    return m.join(u, "existing_dhis2_id", "left").select("mfr_id", F.coalesce("dhis2_name", "facility_name", F.lit("Unknown")).alias("display_name"))


def c14_subset_run(spark: SparkSession, d: str) -> DataFrame:
    """The batch linkage of the hospitals of one region only; only their names are searched for."""
    m = table(spark, d, "stg_mfr_facilities")
    own = m.where(F.col("facility_type").isin("General Hospital", "Referral Hospital", "Primary Hospital") & (t.normalize_geo(F.col("region")) == "logida"))
    return _batch_linkage(spark, d, m.join(own.select("record_no").distinct(), "record_no", "left_semi"))


def c13_report(spark: SparkSession, d: str) -> DataFrame:
    """The report of a run as lines of (section, item, value): sizes, coverage, scores, bands and the unmatched by region."""
    a, b = _sides(spark, d)
    pairs = _label_pairs(spark, d, a, b)
    hits = cut(_calibrated(pairs), "hits")
    lines = lambda df, section, columns: df.select(F.lit(section).alias("section"), F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("value")) for c in columns])).alias("l")).select("section", "l.*")
    cover = lines(_coverage(hits, a, b), "coverage", ["total", "mfr_matched", "dhis2_matched", "mfr_coverage", "dhis2_coverage"])
    stats = scoring.score_stats(_score(pairs))
    scores = lines(stats.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "median", "min", "max")]), "scores", ["n", "mean", "median", "min", "max"])
    bands = hits.groupBy(t.confidence_band(F.col("score")).alias("item")).agg(F.count("*").cast("string").alias("value")).select(F.lit("bands").alias("section"), "item", "value")
    lost = registry.unmatched(a.select(F.col("fid").alias("fid_a"), "region").distinct(), hits, "fid_a").where("region is not null")
    lost = lost.groupBy(F.col("region").alias("item")).agg(F.count("*").cast("string").alias("value")).select(F.lit("unmatched").alias("section"), "item", "value")
    return cover.unionByName(scores).unionByName(bands).unionByName(lost)


QUERIES = {
    f.__name__: f
    for f in (
        j02_label_join, j03_c05_canonical, j04_compound_block, j05_phonetic_block, j06_sorted_neighbourhood, j07_neighbourhood_anywhere, j08_candidates_union, j10_topk_candidates,
        j11_j12_c02_split, j12_anti, j13_verified, j16_left_preserving, j17_a17_reduction, j20_candidate_json, g01_a11_features, g04_bigram_cosine, g06_a09_scored_pairs, g07_j09_embedding_top1,
        g08_c10_judged, a03_score_stats, a12_confusion, a13_threshold_sweep, a14_best_threshold, p13_matches, c01_pipeline, c03_combined, c04_unmapped_regions, c06_unmatched, c06_unmatched_sides,
        c08_subset_link, c09_batch_linkage, p08_no_region, p18_raw_region, snk05_calibration_json, w06_scored_blocks, p21_display_name, c13_report, c14_subset_run,
    )
}

# -- the same in SQL --------------------------------------------------------------------------------------------------


def _side(src: str) -> str:
    region = "region"
    for e in t.REGION_ENDINGS:
        region = f"replace({region}, {tq.q(e)}, '')"
    region = f"CASE trim({region}) " + " ".join(f"WHEN {tq.q(a)} THEN {tq.q(b)}" for a, b in t.REGION_FIXES.items()) + f" ELSE trim({region}) END"
    steps = f"(SELECT *, {tq.sql_expand(tq.sql_transliterate('facility_name'))} AS expanded FROM ({src}))"
    steps = f"(SELECT *, {tq.sql_normalize('expanded')} AS normal FROM {steps})"
    return f"(SELECT * REPLACE ({region} AS region), region AS region_raw, {tq.sql_phonetic('name')} AS phonetic FROM (SELECT *, {tq.sql_romanise('normal')} AS name FROM {steps}))"


_BASE = f"""a AS MATERIALIZED {_side('SELECT DISTINCT record_no AS rid, mfr_id AS fid, facility_name, region, woreda, zone, existing_dhis2_id FROM stg_mfr_facilities')},
b AS MATERIALIZED {_side('SELECT DISTINCT record_no AS rid, dhis2_uid AS fid, dhis2_name AS facility_name, regional AS region, wereda AS woreda, zonal AS zone FROM stg_dhis2_facilities')}"""
_RANKS = "ranks AS MATERIALIZED (SELECT name, dense_rank() OVER (ORDER BY name) AS r FROM (SELECT name FROM a UNION SELECT name FROM b) WHERE name <> '')"
_NEAR = "SELECT a.rid AS a_rid, b.rid AS b_rid FROM a JOIN ranks x ON a.name = x.name JOIN ranks y ON y.r BETWEEN x.r - 1 AND x.r + 1 JOIN b ON b.name = y.name AND b.region = a.region"
_BLOCK = "SELECT a.rid AS a_rid, b.rid AS b_rid FROM a JOIN b ON a.region = b.region AND a.phonetic = b.phonetic AND a.name <> '' AND b.name <> ''"
_CAND = f"{_BASE}, {_RANKS}, cand AS MATERIALIZED ({_BLOCK} UNION {_NEAR})"
_HYD = f"{_CAND}, h AS (SELECT a_rid, b_rid, a.fid AS fid_a, b.fid AS fid_b, a.name AS na, b.name AS nb, a.region AS ra, b.region AS rb, a.woreda AS wa, b.woreda AS wb, a.zone AS za, b.zone AS zb FROM cand JOIN a ON a.rid = a_rid JOIN b ON b.rid = b_rid)"
_LEV = "CASE WHEN greatest(length(na), length(nb)) > 0 THEN 1 - levenshtein(na, nb)::DOUBLE / greatest(length(na), length(nb)) ELSE 0 END"
_JW = "CASE WHEN na = '' OR nb = '' THEN 0 ELSE jaro_winkler_similarity(na, nb) END"
_EXACT = "coalesce((lower(trim({0}a)) = lower(trim({0}b)))::INT::DOUBLE, 0)"

ORACLE = {
    "j04_compound_block": f"WITH {_BASE} {_BLOCK}",
    "j05_phonetic_block": f"WITH {_BASE} SELECT a.rid AS a_rid, b.rid AS b_rid FROM a JOIN b ON a.phonetic = b.phonetic WHERE a.name <> '' AND b.name <> ''",
    "p18_raw_region": f"WITH {_BASE} SELECT rid, region_raw, region FROM a",
    "p08_no_region": f"""WITH {_BASE}, {_RANKS} SELECT a.rid AS a_rid, b.rid AS b_rid FROM a JOIN b ON a.phonetic = b.phonetic WHERE a.name <> '' AND b.name <> ''
      UNION {_NEAR.replace(' AND b.region = a.region', '')}""",
    "j06_sorted_neighbourhood": f"WITH {_BASE}, {_RANKS} {_NEAR}",
    "j07_neighbourhood_anywhere": f"WITH {_BASE}, {_RANKS} {_NEAR.replace(' AND b.region = a.region', '')}",
    "j08_candidates_union": f"WITH {_CAND} SELECT * FROM cand",
    "j17_a17_reduction": f"""WITH {_CAND}, n AS (SELECT (SELECT count(*) FROM a) AS l, (SELECT count(*) FROM b) AS r, (SELECT count(*) FROM cand) AS c)
      SELECT l AS left_rows, r AS right_rows, c AS candidate_pairs, l * r AS possible_pairs, round(100 * (1 - c / (l * r)), 6) AS reduction_pct FROM n""",
    "g01_a11_features": f"""WITH {_HYD} SELECT a_rid, b_rid, (na = nb)::INT::DOUBLE AS name_exact, ({_LEV} >= 0.6)::INT::DOUBLE AS name_levenshtein, ({_JW} >= 0.6)::INT::DOUBLE AS name_jaro_winkler,
      (coalesce(ra, '') = coalesce(rb, ''))::INT::DOUBLE AS region_exact, (coalesce(wa, '') = coalesce(wb, ''))::INT::DOUBLE AS woreda_exact FROM h""",
    "j02_label_join": f"""WITH {_CAND}, lab AS (SELECT DISTINCT trim(mfr_id) AS mfr_id, trim(existing_dhis2_id) AS dhis2_id FROM stg_mfr_facilities WHERE existing_dhis2_id IS NOT NULL)
      SELECT DISTINCT lab.mfr_id, lab.dhis2_id FROM cand JOIN a ON a.rid = a_rid JOIN b ON b.rid = b_rid JOIN lab ON lab.mfr_id = trim(a.fid) AND lab.dhis2_id = trim(b.fid)""",
    "g07_j09_embedding_top1": """SELECT vec_id, other, score FROM (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
      FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, other) = 1""",
    "j11_j12_c02_split": """SELECT 'linked' AS part, count(*) AS n FROM stg_mfr_facilities WHERE existing_dhis2_id IN (SELECT dhis2_uid FROM stg_dhis2_facilities)
      UNION ALL SELECT 'mfr_unlinked', count(*) FROM stg_mfr_facilities WHERE coalesce(existing_dhis2_id NOT IN (SELECT dhis2_uid FROM stg_dhis2_facilities), true)
      UNION ALL SELECT 'dhis2_unlinked', count(*) FROM stg_dhis2_facilities WHERE dhis2_uid NOT IN (SELECT existing_dhis2_id FROM stg_mfr_facilities WHERE existing_dhis2_id IS NOT NULL)""",
    "j12_anti": "SELECT record_no, existing_dhis2_id AS dhis2_uid FROM stg_mfr_facilities m WHERE NOT EXISTS (SELECT 1 FROM stg_dhis2_facilities u WHERE u.dhis2_uid = m.existing_dhis2_id)",
    "j13_verified": """WITH u AS (SELECT * FROM stg_dhis2_facilities QUALIFY row_number() OVER (PARTITION BY dhis2_uid ORDER BY record_no DESC) = 1)
      SELECT DISTINCT m.record_no, mfr_id, facility_name AS mfr_name, existing_dhis2_id, dhis2_name, regional AS dhis2_region, 1.0::DOUBLE AS score, 'verified' AS match_source
      FROM stg_mfr_facilities m JOIN u ON u.dhis2_uid = existing_dhis2_id""",
    "j03_c05_canonical": """SELECT DISTINCT m.mfr_id, uid, k.mfr_id AS other_id, mfr_name FROM (SELECT DISTINCT mfr_id, trim(existing_dhis2_id) AS uid FROM stg_mfr_facilities) m
      JOIN (SELECT DISTINCT trim(dhis2_uid) AS uid, mfr_id, mfr_name FROM facility_linkage) k USING (uid) WHERE uid NOT IN ('', 'null', 'None')""",
    "j16_left_preserving": """SELECT mfr_id, dhis2_uid, coalesce(reason, 'No candidate in the same region') AS reason FROM (SELECT DISTINCT mfr_id FROM stg_mfr_facilities)
      LEFT JOIN (SELECT mfr_id, min(dhis2_uid) AS dhis2_uid, min(reason) AS reason FROM facility_linkage WHERE dhis2_uid IS NOT NULL GROUP BY 1) USING (mfr_id)""",
    "c04_unmapped_regions": "SELECT DISTINCT region FROM stg_mfr_facilities WHERE region NOT IN ('Tase Fisharu Region', 'Kechipa Region', 'Logida Region', 'Semene Region', 'Retoreje Region', 'Gechunu Region')",
    "c06_unmatched": """SELECT facility_type, count(*) AS n, facility_type IN ('General Hospital', 'Referral Hospital', 'Primary Hospital') AS review FROM stg_mfr_facilities m
      WHERE facility_type IS NOT NULL AND NOT EXISTS (SELECT 1 FROM facility_linkage k WHERE k.mfr_id = m.mfr_id AND dhis2_uid IS NOT NULL) GROUP BY 1""",
}
_GRAMS = "flatten(list_transform(list_filter(string_split({0}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i::BIGINT, 2))))"
_COS = f"""names AS MATERIALIZED (SELECT DISTINCT na, nb FROM h),
grams AS (SELECT n, g, count(*)::DOUBLE AS c FROM (SELECT n, unnest({_GRAMS.format('n')}) AS g FROM (SELECT na AS n FROM names UNION SELECT nb FROM names)) GROUP BY ALL),
norms AS (SELECT n, sqrt(sum(c * c)) AS l FROM grams GROUP BY 1),
dots AS (SELECT na, nb, sum(x.c * y.c) AS dot FROM names JOIN grams x ON x.n = na JOIN grams y ON y.n = nb AND y.g = x.g GROUP BY ALL),
cos AS MATERIALIZED (SELECT names.na, names.nb, coalesce(dot / (p.l * q.l), 0) AS cosine FROM names LEFT JOIN dots USING (na, nb) LEFT JOIN norms p ON p.n = names.na LEFT JOIN norms q ON q.n = names.nb)"""
_SCORE = f"{_HYD}, {_COS}, s AS MATERIALIZED (SELECT h.*, cosine, 0.8 * (({_LEV}) + ({_JW}) + cosine) / 3 + 0.2 * ({_EXACT.format('w')} + {_EXACT.format('z')}) / 2 AS score FROM h JOIN cos USING (na, nb))"
_FSUM = f"(na = nb)::INT + ({_LEV} >= 0.6)::INT + ({_JW} >= 0.6)::INT + (cosine >= 0.6)::INT + (coalesce(ra, '') = coalesce(rb, ''))::INT + (coalesce(wa, '') = coalesce(wb, ''))::INT"
_LAB = f"""{_SCORE}, lab AS MATERIALIZED (SELECT round(score, 6) AS score, (ref = trim(fid_b))::INT AS label FROM s
  JOIN (SELECT DISTINCT trim(mfr_id) AS mfr_id, trim(existing_dhis2_id) AS ref FROM stg_mfr_facilities WHERE existing_dhis2_id IS NOT NULL) m ON m.mfr_id = trim(fid_a))"""
_SWEEP = f"""{_LAB}, sweep AS (SELECT t, count(*) FILTER (score >= t AND label = 1) AS tp, count(*) FILTER (score >= t AND label <> 1) AS fp, count(*) FILTER (score < t AND label = 1) AS fn, count(*) FILTER (score < t AND label <> 1) AS tn
  FROM lab, (SELECT 0.5::DOUBLE + i * ((0.5::DOUBLE + 0.01::DOUBLE) - 0.5::DOUBLE) AS t FROM range(50) r(i)) GROUP BY t),
pr AS (SELECT *, tp / (tp + fp + 1e-10) AS p, tp / (tp + fn + 1e-10) AS r FROM sweep),
full_sweep AS (SELECT round(t, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-10), 6) AS f1, tp, fp, fn, tn FROM pr)"""
_BEST = "best AS (SELECT coalesce(max(threshold), 0.8) AS least FROM (SELECT threshold FROM full_sweep ORDER BY f1 DESC, threshold LIMIT 1))"
_P13 = f"WITH {_SCORE} SELECT fid_a AS mfr_id, fid_b AS dhis2_id, round(score, 5) AS score, 'inferred' AS match_type FROM s WHERE round(score, 6) >= 0.8"

ORACLE |= {
    "g04_bigram_cosine": f"WITH {_HYD}, {_COS}, f AS (SELECT a_rid, b_rid, cosine, ({_FSUM})::DOUBLE AS fs FROM h JOIN cos USING (na, nb)) SELECT a_rid, b_rid, round(cosine, 6) AS cosine, fs AS feature_sum, round(2 * fs / 7, 6) AS feature_mean FROM f",
    "g06_a09_scored_pairs": f"WITH {_SCORE} SELECT a_rid, b_rid, round((score - (SELECT min(score) FROM s)) / ((SELECT max(score) - min(score) FROM s) + 1e-10), 5) AS score FROM s",
    "a03_score_stats": f"WITH {_SCORE} SELECT round(avg(score), 5) AS mean, round(median(score), 5) AS median, round(min(score), 5) AS min, round(max(score), 5) AS max, round(stddev_samp(score), 5) AS std, count(score) AS n FROM s",
    "p13_matches": _P13,
    "a12_confusion": f"WITH {_LAB} SELECT count(*) FILTER (score >= 0.8 AND label = 1) AS tp, count(*) FILTER (score >= 0.8 AND label <> 1) AS fp, count(*) FILTER (score < 0.8 AND label = 1) AS fn, count(*) FILTER (score < 0.8 AND label <> 1) AS tn FROM lab",
    "a13_threshold_sweep": f"WITH {_SWEEP} SELECT * FROM full_sweep",
    "a14_best_threshold": f"WITH {_SWEEP} SELECT * FROM full_sweep ORDER BY f1 DESC, threshold LIMIT 1",
    "c03_combined": f"""WITH m AS ({_P13}), u AS (SELECT DISTINCT dhis2_uid FROM stg_dhis2_facilities)
      SELECT mfr_id, existing_dhis2_id AS dhis2_id, 1.0::DOUBLE AS score, 'verified' AS match_source, NULL AS match_type FROM (SELECT DISTINCT record_no, mfr_id, existing_dhis2_id, facility_name FROM stg_mfr_facilities) JOIN u ON dhis2_uid = existing_dhis2_id
      UNION ALL SELECT mfr_id, dhis2_id, score, 'inferred', match_type FROM m""",
    "c01_pipeline": f"""WITH {_SWEEP}, {_BEST}, n AS (SELECT count(*) AS total, count(DISTINCT fid_a) AS ma, count(DISTINCT fid_b) AS mb FROM s, best WHERE round(score, 6) >= least)
      SELECT total, ma AS mfr_matched, mb AS dhis2_matched, printf('%.1f%%', 100.0 * ma / (SELECT count(DISTINCT fid) FROM a)) AS mfr_coverage, printf('%.1f%%', 100.0 * mb / (SELECT count(DISTINCT fid) FROM b)) AS dhis2_coverage FROM n""",
}
_SUBSET = f"WITH {_SWEEP}, {_BEST} SELECT fid_a AS mfr_id, fid_b AS dhis2_id, round(score, 5) AS score FROM s, best WHERE round(score, 6) >= least"
for _x in "ab":
    # the keys of the subset only
    _SUBSET = _SUBSET.replace(f"{_x} AS MATERIALIZED (SELECT * REPLACE", f"{_x} AS MATERIALIZED (SELECT * FROM (SELECT * REPLACE", 1)
_SUBSET = _SUBSET.replace("FROM stg_mfr_facilities)))))", "FROM stg_mfr_facilities))))) WHERE name LIKE '%health center')", 1).replace("FROM stg_dhis2_facilities)))))", "FROM stg_dhis2_facilities))))) WHERE name LIKE '%health center')", 1)
ORACLE["c08_subset_link"] = _SUBSET
_GEO_B = tq.sql_geo(r"regexp_replace(regional, 'reg\.', 'region', 'gi')")
ORACLE["c09_batch_linkage"] = rf"""WITH m AS MATERIALIZED (SELECT DISTINCT record_no, mfr_id, {tq.sql_geo('region')} AS g, {tq.sql_romanise(tq.sql_clean('facility_name'))} AS na FROM stg_mfr_facilities WHERE coalesce(regexp_matches(existing_dhis2_id, '^[\s\p{{Z}}]*$'), true)),
  u AS MATERIALIZED (SELECT DISTINCT record_no AS other, dhis2_uid AS uid, {_GEO_B} AS g, {tq.sql_romanise(tq.sql_clean('dhis2_name'))} AS nb FROM stg_dhis2_facilities),
  p AS (SELECT m.record_no, uid, other, round({_LEV}, 6) AS score FROM m JOIN u ON m.g = u.g WHERE na <> '' AND nb <> ''),
  best AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY record_no ORDER BY score DESC, other) = 1),
  o AS (SELECT m.record_no, mfr_id, uid, score, CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.8 THEN 'medium' WHEN score >= 0.7 THEN 'low' ELSE 'none' END AS confidence FROM m LEFT JOIN best ON best.record_no = m.record_no)
  SELECT record_no, mfr_id, CASE WHEN confidence <> 'none' THEN uid END AS dhis2_uid, confidence, CASE WHEN score IS NULL THEN 'No candidate in the same region'
    WHEN confidence = 'none' THEN 'Best score ' || printf('%.3f', score) || ' is below the lowest band' ELSE 'Name similarity ' || printf('%.3f', score) || ' in the same region' END AS reason FROM o"""
_C09 = ORACLE["c09_batch_linkage"]
ORACLE["c14_subset_run"] = f"""SELECT * FROM ({_C09}) WHERE record_no IN (SELECT record_no FROM stg_mfr_facilities
  WHERE facility_type IN ('General Hospital', 'Referral Hospital', 'Primary Hospital') AND {tq.sql_geo('region')} = 'logida')"""
ORACLE["p21_display_name"] = """SELECT m.mfr_id, coalesce(dhis2_name, facility_name, 'Unknown') AS display_name FROM (SELECT DISTINCT mfr_id, facility_name, existing_dhis2_id FROM stg_mfr_facilities) m
  LEFT JOIN (SELECT dhis2_uid, min(dhis2_name) AS dhis2_name FROM stg_dhis2_facilities GROUP BY 1) u ON u.dhis2_uid = m.existing_dhis2_id"""
ORACLE["w06_scored_blocks"] = f"""WITH {_BASE}, {_RANKS}, np AS (SELECT DISTINCT a.region, a.name AS na, b.name AS nb FROM a JOIN b ON a.region = b.region AND a.phonetic = b.phonetic AND a.name <> '' AND b.name <> ''
    UNION SELECT a.region, a.name, b.name FROM a JOIN ranks x ON a.name = x.name JOIN ranks y ON y.r BETWEEN x.r - 1 AND x.r + 1 JOIN b ON b.name = y.name AND b.region = a.region),
  g AS (SELECT *, list_distinct(list_transform(range(1, length(na)), lambda i: substr(na, i::BIGINT, 2))) AS ga, list_distinct(list_transform(range(1, length(nb)), lambda i: substr(nb, i::BIGINT, 2))) AS gb FROM np)
  SELECT region, na AS name_a, nb AS name_b, round(CASE WHEN len(ga) + len(gb) > 0 THEN 2.0 * len(list_intersect(ga, gb)) / (len(ga) + len(gb)) ELSE (na = nb)::INT END, 6)::DOUBLE AS score FROM g"""
