"""Names and places normalised, as native column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Order matters: each rule sees what the ones before it made.
ABBREVIATIONS = [
    ("HC", "Health Center"),
    ("HP", "Health Post"),
    ("FMOH", "Federal Ministry of Health"),
    ("RHB", "Regional Health Bureau"),
    ("Hosp", "Hospital"),
    ("Hosp.", "Hospital"),
    ("Cli", "Clinic"),
    ("Clinic", "Clinic"),
    ("D/W", "Delivery Ward"),
    ("PHC", "Primary Health Center"),
    ("GH", "General Hospital"),
    ("SH", "Specialized Hospital"),
    ("Ref", "Referral"),
    ("HEF", "Health Extension Post"),
    ("Med", "Medical"),
    ("Lab", "Laboratory"),
    ("Disp", "Dispensary"),
]
AMHARIC = [("ሆስፒታል", "Hospital"), ("ክሊኒክ", "Clinic"), ("ጤና", "Health"), ("መሀል", "Central")]
GEO_NOISE = [
    "regional health bureau", "region", "city administration", "administration", "zone health department", "zonal health department", "health department",
    "department", "zone", "zonal", "town", "rural", "city", "zhd", "hd", "office", "dept",
]
GEO_FIXES = [
    ("gojam", "gojjam"), ("gonder", "gondar"), ("shewa", "shoa"), ("gumuz", "gumz"), ("oromiya", "oromia"), ("oromya", "oromia"), ("wolaita", "welayta"),
    ("wolayta", "welayta"), ("swe", "southwestethiopia"), ("semien", "north"), ("debub", "south"), ("misraq", "east"), ("mirab", "west"),
]
NAME_SUFFIXES = [
    "health center", "health post", "primary hospital", "general hospital", "referral hospital", "phcu", "worho", "drug store", "pharmacy", "clinic", "hc", "hp", "hospital",
]
REGION_ENDINGS = [" Regional Health Bureau", " Region", " City Administration"]
REGION_FIXES = {"Oromiya": "Oromia", "SWE": "South West Ethiopia", "Benishangul-Gumuz": "Benishangul Gumuz"}
# fixed values: both registries' spellings of the regions, each with its key
REGION_MAP = {
    "Harari Region": "harari",
    "Harari Regional Health Bureau": "harari",
    "Tigray Region": "tigray",
    "Tigray Regional Health Bureau": "tigray",
    "Oromia Region": "oromia",
    "Oromiya Regional Health Bureau": "oromia",
    "Sidama Region": "sidama",
    "Sidama Regional Health Bureau": "sidama",
    "South West Ethiopia Region": "south west ethiopia",
    "SWE Regional Health Bureau": "south west ethiopia",
    "Gambella Region": "gambella",
    "Gambella Regional Health Bureau": "gambella",
    "Benishangul-Gumuz Region": "benishangul gumuz",
    "Benishangul Gumuz Regional Health Bureau": "benishangul gumuz",
    "Afar Region": "afar",
    "Afar Regional Health Bureau": "afar",
    "Somali Region": "somali",
    "Somali Regional Health Bureau": "somali",
    "Amhara Region": "amhara",
    "Amhara Regional Health Bureau": "amhara",
    "SNNP Region": "snnp",
    "SNNP Regional Health Bureau": "snnp",
    "Dire Dawa City Administration": "dire dawa",
    "Dire Dawa Regional Health Bureau": "dire dawa",
    "Addis Ababa City Administration": "addis ababa",
    "Addis Ababa Regional Health Bureau": "addis ababa",
}

_FLAGS = "(?iuU)"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def transliterate_amharic(c: Column) -> Column:
    """Four words of the other script, in order; null becomes empty."""
    out = _text(c)
    for a, b in AMHARIC:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def expand_abbreviations(c: Column) -> Column:
    """Whole-word abbreviations in full, whatever their case; null becomes empty."""
    own = out = _text(c)
    for a, b in ABBREVIATIONS:
        out = F.regexp_replace(out, rf"{_FLAGS}\b{re.escape(a)}\b", b)
    # most names have none, which one look tells
    return F.when(own.rlike(rf"{_FLAGS}\b(?:{'|'.join(re.escape(a) for a, _ in ABBREVIATIONS)})\b"), out).otherwise(own)


def normalize_text(c: Column) -> Column:
    """Lower case, punctuation as space, single spaces; null becomes empty."""
    out = F.lower(F.regexp_replace(_text(c), r"(?U)\s+", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[.,\-/():]", " "), r"(?U)\s+", " "))


def phonetic_key(c: Column) -> Column:
    """Soundex of a text that starts with an ASCII letter; the first four characters of any other; empty for null."""
    t = F.trim(_text(c))
    return F.when(t.rlike("^[A-Za-z]"), F.soundex(t)).otherwise(F.substring(t, 1, 4))


def prefix_key(c: Column, n: int = 4) -> Column:
    return F.substring(_text(c), 1, n)


def normalize_geo(c: Column) -> Column:
    """A place without the words for its level and without spaces and hyphens, known spellings made one; unknown if
    nothing is left."""
    out = F.trim(F.lower(_text(c)))
    words = "|".join(sorted(map(re.escape, GEO_NOISE), key=len, reverse=True))
    out = F.regexp_replace(out, rf"{_FLAGS}\b(?:{words})\b", "")
    out = F.regexp_replace(out, r"(?U)[\s\-]+", "")
    for a, b in GEO_FIXES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(out == "", "unknown").otherwise(out)


def clean_facility_name(c: Column) -> Column:
    """A name without the words for its kind; null becomes empty."""
    out = F.trim(F.lower(_text(c)))
    for s in NAME_SUFFIXES:
        out = F.regexp_replace(out, rf"{_FLAGS}\b{re.escape(s)}\b", "")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The entry of a fixed table, null for a miss."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def lookup_or_self(c: Column, table: dict[str, str]) -> Column:
    return F.coalesce(lookup(c, table), c)


def normalize_region(c: Column) -> Column:
    """A region without its ending, three spellings made one; null stays null."""
    out = c
    for e in REGION_ENDINGS:
        out = F.replace(out, F.lit(e), F.lit(""))
    return lookup_or_self(F.trim(out), REGION_FIXES)


def canonical_region(c: Column) -> Column:
    return lookup(c, REGION_MAP)


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(r"(?U)^\s*$"), c)


def pair_text(name: Column, fields: dict[str, Column]) -> Column:
    """The name and its labelled places, what is missing left out."""
    parts = [F.when(name != "", name)] + [F.when(v.isNotNull(), F.concat(F.lit(f"{k}:"), v)) for k, v in fields.items()]
    return F.concat_ws(" ", *parts)


def confidence_band(score: Column) -> Column:
    return F.when(score >= 0.9, "high").when(score >= 0.8, "medium").when(score >= 0.7, "low").otherwise("none")


def reason_text(score: Column, band: Column) -> Column:
    shown = F.when(score.isNull(), "N/A").otherwise(F.format_string("%.3f", F.bround(score, 3)))
    return (
        F.when(score.isNull(), "No candidate in the same region")
        .when(band == "none", F.concat(F.lit("Best score "), shown, F.lit(" is below the lowest band")))
        .otherwise(F.concat(F.lit("Name similarity "), shown, F.lit(" in the same region")))
    )


def padded_id(prefix: str, n: Column) -> Column:
    return F.format_string(f"{prefix}%06d", n)


def drop_last_letter_of_first_word(c: Column) -> Column:
    words = F.split(c, " ")
    first = F.substring(words[0], 1, F.greatest(F.length(words[0]) - 1, F.lit(0)))
    return F.array_join(F.concat(F.array(first), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))), " ")


def percent(part: Column, whole: Column) -> Column:
    return F.format_string("%.1f%%", F.when(whole > 0, 100.0 * part / whole).otherwise(0.0))


def preprocess(df, name: str = "facility_name", places: tuple[str, ...] = ("region", "zone", "woreda")):
    """The derived columns of a registry: the name translated, expanded, normalised and keyed, the places normalised."""
    base = name.removesuffix("_name")
    x, e, n = f"{base}_amharic_xlat", f"{base}_expanded", f"{base}_normalized"
    df = df.withColumn(x, transliterate_amharic(F.col(name)))
    df = df.withColumn(e, expand_abbreviations(F.col(x)))
    df = df.withColumn(n, normalize_text(F.col(e)))
    df = df.withColumn(f"{base}_phonetic", phonetic_key(F.col(n)))
    return df.withColumns({f"{p}_normalized": normalize_text(F.col(p)) for p in places if p in df.columns})


def metaphone_key(length: int = 4):
    """A vectorised function for the first letters of a consonant skeleton by sound; the built-ins have no metaphone."""
    rules = [(re.compile(a), b) for a, b in ((r"^(kn|gn|pn|wr|ae)", lambda m: m[0][1]), (r"ph", "f"), (r"[ts]h", lambda m: "0" if m[0][0] == "t" else "x"), (r"ch", "x"), (r"ck|q", "k"), (r"c(?=[iey])", "s"), (r"c", "k"), (r"x(?!$)", "ks"), (r"z", "s"), (r"dg(?=[iey])", "j"), (r"d", "t"), (r"v", "f"), (r"gh", "k"), (r"(.)\1+", r"\1"), (r"(?<=.)[aeiouhwy]", ""))]

    @F.pandas_udf("string")
    def key(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> str:
            w = re.sub("[^a-z]", "", (t or "").lower())
            for a, b in rules:
                w = a.sub(b, w)
            return w[:length].upper()

        return s.map(one)

    return key
