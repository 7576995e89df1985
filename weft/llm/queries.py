"""Queries of this package's operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.keys import strip, uid
from weft.llm import canonical, groups, mixing, nameparse, names, packing, sentences, survivors, tokens
from weft.llm.sql import ORACLE  # noqa: F401
from weft.session import cut, table


def _trusted(spark: SparkSession, d: str, name: str, key: str, columns: list[str]) -> DataFrame:
    rows = table(spark, d, name).select(strip(F.col(key)).alias("key"), "record_no", "source_system", "updated_at", *columns)
    return rows.join(F.broadcast(table(spark, d, "source_trust")), "source_system", "left")  # six fixed rows


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    out = []
    for name, key, columns in (("stg_mfr_facilities", "mfr_id", ["facility_type", "ownership"]), ("stg_dhis2_facilities", "dhis2_uid", ["facilitytype"])):
        best = survivors.best_by_field(_trusted(spark, d, name, key, columns), "key", "record_no", columns, rank="trust_rank", at="updated_at")
        out.append(best.select(F.lit(name).alias("table_name"), F.col("key").alias("facility_key"), "column_name", F.col("record").alias("record_no")))
    return out[0].unionByName(out[1])


def p3_bundles(spark: SparkSession, d: str) -> DataFrame:
    """One consistent record per mfr_id: place, kind and owner as bundles, the region bound to the zone's usual region."""
    columns = ["region", "zone", "woreda", "facility_type", "subtype", "ownership"]
    rows = _trusted(spark, d, "stg_mfr_facilities", "mfr_id", columns)
    usual = rows.where(survivors.says(F.col("zone")) & survivors.says(F.col("region"))).groupBy(survivors.plain(F.col("zone")).alias("lhs_value"), survivors.plain(F.col("region")).alias("rhs_value")).agg(F.count("*").alias("n"))
    usual = usual.groupBy("lhs_value").agg(F.max_by("rhs_value", F.struct("n", "rhs_value")).alias("rhs_value"))
    bundles = {"region": ["region"], "place": ["zone", "woreda"], "kind": ["facility_type", "subtype"], "owner": ["ownership"]}
    return survivors.survivors(
        rows, "key", "record_no", bundles, rank="trust_rank", at="updated_at", dependencies=[survivors.Dependency(("place", "zone"), ("region", "region"), usual)]
    ).select(F.col("key").alias("mfr_id"), "bundle", F.col("record").alias("record_no"), F.array_join("values", " | ", "").alias("value"), "consistent")


def _links(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "facility_linkage").where(F.lower(strip(F.coalesce("confidence", F.lit("")))) != "none")
    m = strip(F.col("mfr_id"))
    return k.select(F.when(m != "", m).alias("mfr_id"), uid(F.col("dhis2_uid")).alias("dhis2_uid"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return groups.connected_groups(_links(spark, d), "mfr_id", "dhis2_uid")


def p5_sizes(spark: SparkSession, d: str) -> DataFrame:
    return groups.group_sizes(p5_found(spark, d))


PLACES = (("stg_mfr_facilities", "region", "region"), ("stg_dhis2_facilities", "regional", "region"), ("stg_dhis2_facilities", "zonal", "zone"))


def _places(spark: SparkSession, d: str) -> DataFrame:
    geo, out = table(spark, d, "geo_reference"), []
    for name, column, level in PLACES:
        rows = table(spark, d, name).select("record_no", F.col(column).alias("value")).distinct()
        entries = canonical.entries_of(geo.where(F.col("geo_level") == level), "geo_id", "geo_name", "short_name")
        entries = canonical.typed_frequencies(table(spark, d, name), column, entries)
        out.append(canonical.map_values(rows, "value", entries, out="geo_id").withColumn("field_name", F.lit(f"{name}.{column}")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).select("field_name", "record_no", "geo_id")


def p6_misses(spark: SparkSession, d: str) -> DataFrame:
    return canonical.misses(_places(spark, d), F.struct("field_name", "value"), "geo_id").select("value.field_name", F.col("value.value").alias("value"), "n")


CAPACITY = 2048


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.pack(tokens.token_counts(docs), CAPACITY, rows=docs.count())


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p8_packing(spark, d), CAPACITY)


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, target = table(spark, d, "documents"), table(spark, d, "mix_target")
    sized = cut(mixing.measured(docs), "measured")
    weights = mixing.calibrate(sized, target)
    cells = spark.createDataFrame(weights, "source string, lang string, topic int, tokens bigint, weight double")
    return mixing.draw(sized, cells, rows=docs.count()), target, sized


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares_reached(*_mixed(spark, d)[:2])


def p9_margins(spark: SparkSession, d: str) -> DataFrame:
    """The shares of languages and topics, of what could be drawn and of what was."""
    drawn, target, sized = _mixed(spark, d)
    drawn, may = cut(drawn, "drawn"), sized.where("n_tokens > 0").join(F.broadcast(target.select("source")), "source", "left_semi")  # a list of sources
    return mixing.margins_reached(may, drawn, "lang").unionByName(mixing.margins_reached(may, drawn, "topic"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "documents"))


_PARSED = "side int, key string, core string, extra string, number int, kind int, type_kind int, region int, zone int, place string"


def _placed(rows: DataFrame, levels: dict[str, DataFrame], parents: DataFrame) -> DataFrame:
    """Rows with the ids of their region and zone in place of what was typed, which is looked up once for each way to type it."""
    ways = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("value")) for level in levels]))
    typed = cut(rows.select(ways.alias("w")).select("w.*").where("value is not null").distinct(), "name-places")
    for level, entries in levels.items():
        found = canonical.map_values(typed.where(F.col("level") == level).select("value"), "value", entries, out="geo_id")
        rows = rows.join(found.where("geo_id > 0").select(F.col("value").alias(level), F.col("geo_id").alias(f"{level}_id")), level, "left")
    rows = rows.join(parents, "zone_id", "left")
    return rows.select("side", "key", "name", "type", "place", F.coalesce("region_id", "parent_id", F.lit(0)).alias("region"), F.coalesce("zone_id", F.lit(0)).alias("zone"))


def _name_rows(spark: SparkSession, d: str) -> DataFrame:
    """Both registries' rows with their names taken apart and their places looked up."""
    m = table(spark, d, "stg_mfr_facilities").select(
        F.lit(0).alias("side"), strip(F.col("mfr_id")).alias("key"), F.col("facility_name").alias("name"), F.col("facility_type").alias("type"), "region", "zone", F.col("woreda").alias("place")
    )
    u = table(spark, d, "stg_dhis2_facilities").select(
        F.lit(1).alias("side"), strip(F.col("dhis2_uid")).alias("key"), F.col("dhis2_name").alias("name"), F.col("facilitytype").alias("type"), F.col("regional").alias("region"), F.col("zonal").alias("zone"), F.col("wereda").alias("place")
    )
    rows = m.unionByName(u).where("key <> ''")
    geo = table(spark, d, "geo_reference")
    levels = {level: canonical.entries_of(geo.where(F.col("geo_level") == level), "geo_id", "geo_name", "short_name") for level in ("region", "zone")}
    parents = geo.where("geo_level = 'zone'").select(F.col("geo_id").alias("zone_id"), F.col("parent_geo_id").alias("parent_id"))
    held = None
    if sum(canonical.dictionary_strings(e) for e in levels.values()) <= canonical.BROADCAST_STRINGS:
        # dictionaries of a counted size, looked up beside the names; a longer list is joined by the ways places are typed
        regions, zones = (canonical.Dictionary([(r["id"], r["name"], r["short"], r["freq"]) for r in levels[level].toLocalIterator()]) for level in ("region", "zone"))
        held = spark.sparkContext.broadcast((regions, zones, {r["zone_id"]: r["parent_id"] for r in parents.toLocalIterator()}))
    else:
        rows = _placed(rows, levels, parents)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if held:
            regions, zones, up = held.value
            # each way to type a place is looked up once in a task
            find = [lru_cache(1 << 16)(x.look_up) for x in (regions, zones)]
        number_of = {k: n for n, k in enumerate(nameparse.KINDS)}
        kinds = lru_cache(1 << 16)(lambda t: number_of.get(nameparse.kind_of(t)))
        places, parse = lru_cache(1 << 16)(nameparse.place), lru_cache(1 << 15)(nameparse.parse)  # a district often repeats the name
        named_place = lru_cache(1 << 16)(lambda t: parse(t)[0])
        for pdf in it:
            named = [parse(n) for n in pdf["name"]] if (pdf["side"] == 1).any() else [nameparse.parse(n) for n in pdf["name"]]
            at = [places(p) for p in pdf["place"]]
            # the second registry's district often holds the facility's name instead
            other = [named_place(p) if s and p else "" for s, p in zip(pdf["side"], pdf["place"])]
            ask = [k for k, (n, o) in enumerate(zip(named, other)) if o and n[0] and at[k]]
            known = names.Words([named[k][0] for k in ask] + [other[k] for k in ask])
            like = dict(zip(ask, names.likeness_of(known, np.arange(len(ask)), np.arange(len(ask)) + len(ask)).tolist()))
            extra: list[str | None] = [None] * len(named)
            for k in [k for k, o in enumerate(other) if o]:
                core, o = named[k][0], other[k]
                if k in like:
                    if " " in o:
                        if o != core and (like[k] >= 0.4 or not set(core.split()).isdisjoint(o.split())):
                            extra[k] = o
                        at[k] = None
                    elif o == core or like[k] >= 0.55:
                        at[k] = None
                else:
                    at[k] = None
            cols = [n[0] or None for n in named], extra, [n[1] for n in named], [number_of.get(n[2]) for n in named], at
            if held:
                zone = [find[1](z) if z else 0 for z in pdf["zone"]]
                region = [r and find[0](r) or up.get(z, 0) for r, z in zip(pdf["region"], zone)]
                pdf = pdf.assign(region=pd.array(region, "int32"), zone=pd.array(zone, "int32"))
            types = [kinds(t) for t in pdf["type"]]
            yield pd.DataFrame(
                {"side": pdf["side"], "key": pdf["key"], "core": cols[0], "extra": cols[1], "number": cols[2], "kind": pd.array(cols[3], "Int32"), "type_kind": pd.array(types, "Int32"), "region": pdf["region"], "zone": pdf["zone"], "place": cols[4]}
            )

    return rows.mapInPandas(run, _PARSED)


def _name_groups(spark: SparkSession, d: str) -> DataFrame:
    """(side, key, group): each key's most frequent region, zone, number, kind and district, and all its names, linked."""
    rows = _name_rows(spark, d)
    known = lambda c: F.mode(F.when(F.col(c) > 0, F.col(c)))
    keys = rows.groupBy("side", "key").agg(
        known("region").alias("region"),
        F.coalesce(known("zone"), F.lit(0)).alias("zone"),
        F.coalesce(F.mode(F.when(F.col("core").isNotNull(), F.col("number"))), F.lit(0)).alias("number"),
        F.coalesce(F.mode("kind"), F.mode("type_kind")).alias("kind"),
        F.mode("place").alias("place"),
        F.array_union(F.collect_set("core"), F.collect_set("extra")).alias("cores"),
    )
    keys = cut(keys, "name-keys")
    regions = [r["geo_id"] for r in table(spark, d, "geo_reference").where("geo_level = 'region'").toLocalIterator()]
    return names.link_names(keys, ["region", "number", "kind"], district_of=["region"], tried={"region": regions, "kind": list(range(len(nameparse.KINDS)))})


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Each key of either registry that is linked, its group, and the number of keys of the other registry in it."""
    g = cut(_name_groups(spark, d), "name-groups")
    n = g.groupBy("group").agg(F.count_if(F.col("side") == 0).alias("mfr"), F.count_if(F.col("side") == 1).alias("dhis2")).where("mfr > 0 and dhis2 > 0")
    links = F.when(F.col("side") == 0, F.col("dhis2")).otherwise(F.col("mfr"))
    return g.join(n, "group").select(F.when(F.col("side") == 0, "mfr").otherwise("dhis2").alias("registry"), F.col("key").alias("facility_key"), F.col("group").alias("group_key"), links.alias("links"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_pairs(_name_groups(spark, d)).select(F.col("left_key").alias("mfr_id"), F.col("right_key").alias("dhis2_uid"))


QUERIES = {f.__name__: f for f in (p1_found, p1_links, p3_found, p3_bundles, p5_found, p5_sizes, p6_found, p6_misses, p8_packing, p8_report, p9_mix, p9_shares, p9_margins, p10_found)}
