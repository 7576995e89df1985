"""The operators for training-data pipelines against brute force, and their edge cases."""

import random
import zlib
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weft.llm import canonical, groups, mixing, nameparse, names, packing, sentences, survivors, tokens
from weft.llm.textkit import damerau, latin, plain_edits
from weft.session import table

# -- groups -----------------------------------------------------------------------------------------------------------


def _components(pairs):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[root(a)] = root(b)
    least = {}
    for x in sorted(up):
        least.setdefault(root(x), x)
    return {(least[root(x)], x) for x in up}


@pytest.mark.parametrize("one_task", [0, 1 << 9])
def test_groups_against_union_find(spark, monkeypatch, one_task):
    monkeypatch.setattr(groups, "ONE_TASK", one_task)
    rnd = random.Random(one_task)
    chain = [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)]
    star = [("hub", f"s{i:02}") for i in range(40)]
    loose = [(f"m{rnd.randint(0, 60)}", f"u{rnd.randint(0, 60)}") for _ in range(45)]
    pairs = chain + star + loose + [("self", "self")]
    df = spark.createDataFrame(pairs + [(b, a) for a, b in pairs[:20]] + [(None, "x"), ("y", None)], "a string, b string").withColumn("u", F.lit(1)).withColumn("c", F.lit("clash"))
    got = [(r.group_key, r.member_key) for r in groups.connected_groups(df, "a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == _components(pairs)


def test_no_links_no_groups(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert groups.connected_groups(df, "a", "b").count() == 0
    only = spark.createDataFrame([("x", "x")], "a string, b string")
    assert [tuple(r) for r in groups.connected_groups(only, "a", "b").collect()] == [("x", "x")]


# -- survivors --------------------------------------------------------------------------------------------------------

T = lambda d: datetime(2024, 1, d)


def test_best_by_field(spark):
    rows = [
        ("k", 1, 2, T(1), "Clinic", None), ("k", 2, 1, T(1), "N/A", "Public"), ("k", 3, 2, T(5), "Post", "?"), ("k", 3, 2, T(5), "Post", "?"), ("k", 4, 2, None, "Other", "NGO"),
        ("single", 9, 1, T(1), "Clinic", "NGO"), ("single", 9, 1, T(1), "Clinic", "NGO"), ("mute", 5, 1, T(1), "አይታወቅም", "--"), ("mute", 6, 1, T(1), " ", None),
        ("tie", 8, None, T(1), "A", "x"), ("tie", 7, None, T(1), "B", "x"), (None, 20, 1, T(1), "A", "x"),
    ]
    df = spark.createDataFrame(rows, "k string, record_no bigint, r int, at timestamp, kind string, owner string").withColumn("bundle", F.lit("clash"))
    got = {(r.key, r.column_name): r.record for r in survivors.best_by_field(df, "k", "record_no", ["kind", "owner"], rank="r", at="at").collect()}
    assert got == {("k", "kind"): 3, ("k", "owner"): 2, ("tie", "kind"): 7, ("tie", "owner"): 7}
    assert survivors.best_by_field(df.limit(0), "k", "record_no", ["kind"], rank="r", at="at").count() == 0


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(1, 3), st.sampled_from(["n", "s"]), st.sampled_from(["n", "s", None])), min_size=2, max_size=8))
@settings(max_examples=80, deadline=None)
def test_branch_and_bound_finds_the_best(raw):
    # zone candidates imply a region, region candidates have one
    cands = {"z": [], "r": []}
    for i, (which, rank, has, implied) in enumerate(raw):
        cands["zr"[which]].append((rank, -i, i, [implied if which == 0 else None], [has if which else None]))
    if not cands["z"] or not cands["r"]:
        return
    whole = [((z[0] + r[0], z[1] + r[1]), z[2], r[2]) for z in cands["z"] for r in cands["r"] if z[3][0] is None or z[3][0] == r[4][0]]
    got = survivors._search(["z", "r"], cands, 1)
    assert (got is None) == (not whole)
    if whole:
        assert (got["z"][0] + got["r"][0], got["z"][1] + got["r"][1]) == min(whole)[0]


def test_bundles_follow_dependencies(spark):
    rows = [("k", 1, 1, T(2), "North", "za"), ("k", 2, 2, T(1), "South", "zb"), ("ok", 3, 1, T(1), "South", "zb"), ("ok", 4, 2, T(1), "South", None)]
    df = spark.createDataFrame(rows, "k string, no bigint, r int, at timestamp, region string, zone string")
    law = spark.createDataFrame([("ZA", "south"), ("zb", "South")], "lhs_value string, rhs_value string")
    got = {(x.key, x.bundle): (x.record, x.consistent) for x in survivors.survivors(df, "k", "no", {"reg": ["region"], "zon": ["zone"]}, rank="r", at="at", dependencies=[survivors.Dependency(("zon", "zone"), ("reg", "region"), law)]).collect()}
    assert got[("k", "zon")] == (1, True) and got[("k", "reg")] == (2, True) and got[("ok", "reg")] == (3, True)


def test_bundles_without_dependencies_take_the_same_way(spark):
    # "No" and "data" each say something; together they read like a filler
    rows = [("k", 1, 1, T(2), "No", "data", "x"), ("k", 2, 2, T(3), "Post", None, "y"), ("big", 3, 2, T(1), None, "a", None), ("big", 4, 1, T(1), "?", None, "z")]
    df = spark.createDataFrame(rows, "k string, no bigint, r int, at timestamp, a string, b string, c string")
    bundles = {"ab": ["a", "b"], "c": ["c"]}
    free = survivors.survivors(df, "k", "no", bundles, rank="r", at="at")
    law = survivors.Dependency(("ab", "a"), ("c", "c"), spark.createDataFrame([], "lhs_value string, rhs_value string"))
    bound = survivors.survivors(df, "k", "no", bundles, rank="r", at="at", dependencies=[law])
    rows_of = lambda x: sorted((r.key, r.bundle, r.record, tuple(map(str, r["values"])), r.consistent) for r in x.collect())
    assert rows_of(free) == rows_of(bound)
    assert [r[:4] for r in rows_of(free)] == [("big", "ab", 3, ("None", "a")), ("big", "c", 4, ("z", "None")), ("k", "ab", 1, ("No", "data")), ("k", "c", 1, ("x", "None"))]


# -- canonical --------------------------------------------------------------------------------------------------------

GEO = [(1, "Tase Fisharu", "TF"), (2, "South West Natopulo", "SWN"), (3, "Semene", None), (10, "North Wurano", None), (11, "South Wurano", None)]


def test_look_up():
    d = canonical.Dictionary([(i, n, s, 1.0) for i, n, s in GEO])
    want = {
        "Tase Fisharu Region": 1, "TF RHB": 1, "tasefishru": 1, "ታሴ ፊሻሩ ክልል": 1, "S. West Natopulo": 2, "S/West Natopulo R.H.B.": 2, "SW Natopulo": 2, "Semne Reg.": 3, "Semeenee": 3,
        "N/Wurano ZHD": 10, "Wurano South Zone": 11, "Debub Wurano": 11, "ሰሜን ዉራኖ": 10, "Wurano": 0, "N/A": 0, "99": 0, "T": 0, "Region": 0, "Xvrenthil": 0,
    }
    assert {v: d.look_up(v) for v in want} == want
    assert d.look_up("x" * 100_000) == 0


def test_map_values_by_broadcast_and_by_join_agree(spark, monkeypatch):
    vals = [(i, v) for i, v in enumerate(["Tase Fisharu Region", None, " ", "SW Natopulo", "nothing here", "Wurano South Zone", "TF", "Tase Fisharu Region", "Semeenee", "y" * 3000])]
    df = spark.createDataFrame(vals, "i int, value string").withColumn("id", F.lit("clash")).withColumn("term", F.lit("clash"))
    ref = canonical.entries_of(spark.createDataFrame(GEO, "geo int, name string, short string"), "geo", "name", "short")
    want = {0: 1, 3: 2, 4: 0, 5: 11, 6: 1, 7: 1, 8: 3, 9: 0}
    assert {r.i: r.entry_id for r in canonical.map_values(df, "value", ref).collect()} == want
    monkeypatch.setattr(canonical, "BROADCAST_STRINGS", 2)
    assert {r.i: r.entry_id for r in canonical.map_values(df, "value", ref).collect()} == want
    assert canonical.map_values(df.limit(0), "value", ref).count() == 0
    assert {r.value: r.n for r in canonical.misses(canonical.map_values(df, "value", ref), F.col("value")).collect()}["nothing here"] == 1


@given(st.text("abeho", max_size=7), st.text("abeho", max_size=7))
@settings(max_examples=150, deadline=None)
def test_distances(a, b):
    assert damerau(a, b, 99) == pytest.approx(damerau(b, a, 99)) and damerau(a, b, 99) <= plain_edits(a, b, 99) + 1e-9
    if plain_edits(a, b, 2) <= 2:
        assert canonical.deletes(a, 2) & canonical.deletes(b, 2)


# -- names ------------------------------------------------------------------------------------------------------------


def test_names_taken_apart():
    want = {
        "Sefe Neshoba 01 Health Center": ("sefe neshoba", 1, "health center"), "Health Center Toke Momejo.": ("toke momejo", 0, "health center"), "HC (Tezehi Town) Nikamu Shequ": ("nikamu shequ", 0, "health center"),
        "M. LELOCHA, MEDIUM CLINIC": ("m lelocha", 0, "medium clinic"), "Kogike-mami #2 Health post": ("kogike mami", 2, "health post"), "Chiyupa Teb No. 2 Health Centre": ("chiyupa teb", 2, "health center"),
        "ቦቺኖ ቶሼ መድኃኒት መደብር": ("bochino toshe", 0, "drug store"), "Qoge Kipibo Health Center, Bipijoke": ("qoge kipibo", 0, "health center"), "Jepiha Shujo 02": ("jepiha shujo", 2, None), "Namuyagose no 09 Health Center": ("namuyagose", 9, "health center"), "": ("", 0, None),
    }
    assert {n: nameparse.parse(n) for n in want} == want
    assert nameparse.parse(None) == ("", 0, None) and nameparse.kind_of("Pry. Clinic") == "primary clinic" and latin("E@st") == "east"


def test_array_forms_equal_the_plain_ones():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abehoyw") for _ in range(rnd.randint(1, 7))) for _ in range(60)})
    a, b = (np.array([rnd.randrange(len(words)) for _ in range(800)]) for _ in range(2))
    assert np.allclose(names.word_likeness(names.Spelt(words), a, b), [names._word(words[x], words[y]) for x, y in zip(a, b)], atol=1e-5)
    full = [f"{rnd.choice(words)} {rnd.choice(words)}" if rnd.random() < 0.8 else rnd.choice(words) for _ in range(50)]
    i, j = (x.ravel() for x in np.meshgrid(range(50), range(50)))
    want = [names.likeness(full[x], full[y]) for x, y in zip(i, j)]
    assert np.abs(names.likeness_of(names.Words(full), i, j) - want).max() <= 0.0101


def test_cosine_pairs_against_dense_products():
    rnd = random.Random(5)
    full = sorted({" ".join("".join(rnd.choice("abcdehou") for _ in range(rnd.randint(1, 5))) for _ in range(2)) for _ in range(60)})
    row, gram = names.gram_rows(full)
    m = np.zeros((len(full), names.LETTERS**3))
    np.add.at(m, (row, gram), 1)
    idf = np.log1p(len(full) / np.maximum((m > 0).sum(axis=0), 1))
    m *= idf
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    s = m @ m.T
    for chunk in (names.CHUNK, 50):
        names.CHUNK, old = chunk, names.CHUNK
        i, j, cosine = names.cosine_pairs(full, np.zeros(len(full), np.int64), idf, 0.2)
        got = set(zip(i.tolist(), j.tolist()))
        assert np.abs(cosine - s[i, j]).max() < 1e-5 and len(got) == len(i)
        # two cells apart, and parts of one cell
        half = np.arange(len(full)) % 2
        i, j, _ = names.cosine_pairs(full, half, idf, 0.2)
        assert set(zip(i.tolist(), j.tolist())) == {(i, j) for i, j in got if (i - j) % 2 == 0}
        i, j, _ = names.cosine_pairs(full, np.zeros(len(full), np.int64), idf, 0.2, half)
        assert set(zip(i.tolist(), j.tolist())) == {(i, j) for i, j in got if (i - j) % 2}
        names.CHUNK = old
        sure = {(i, j) for i in range(len(full)) for j in range(i + 1, len(full)) if s[i, j] > 0.2001}
        maybe = {(i, j) for i in range(len(full)) for j in range(i + 1, len(full)) if s[i, j] > 0.1999}
        assert sure <= got <= maybe


def _linkage(pairs, weight=None, least=755):
    a, b, sim = (np.array(x) for x in zip(*pairs))
    w = weight or {}
    item, cluster = names.average_linkage(a, b, sim, np.array([w.get(x, 1) for x in a]), np.array([w.get(x, 1) for x in b]), least)
    return dict(zip(item.tolist(), cluster.tolist()))


def _greedy(pairs, least):
    """Average linkage, the best pair of clusters merged first, absent pairs counting 0."""
    sim = {frozenset((a, b)): s for a, b, s in pairs}
    groups = [{x} for x in sorted({x for a, b, _ in pairs for x in (a, b)})]
    while True:
        best = max(((sum(sim.get(frozenset((x, y)), 0) for x in p for y in q) / (len(p) * len(q)), i, j) for i, p in enumerate(groups) for j, q in enumerate(groups) if i < j), default=(0, 0, 0))
        if best[0] < least:
            return {x: min(g) for g in groups for x in g}
        groups[best[1]] |= groups.pop(best[2])


def test_average_linkage_cuts_chains():
    # a - b - c: the ends are unlike, so only the better pair merges
    assert len(set(_linkage([(0, 1, 900), (1, 2, 850)]).values())) == 2
    assert len(set(_linkage([(0, 1, 900), (1, 2, 850), (0, 2, 800)]).values())) == 1
    # a class of many copies weighs as much as its copies
    assert len(set(_linkage([(0, 1, 900), (1, 2, 850), (0, 2, 600)]).values())) == 2 and len(set(_linkage([(0, 1, 900), (1, 2, 850), (0, 2, 600)], {1: 9}).values())) == 1
    assert _linkage([(0, 1, 700)]) == {0: 0, 1: 1}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_average_linkage_against_the_best_pair_first(seed):
    rnd = random.Random(seed)
    pairs = [(a, b, s) for (a, b), s in zip([(a, b) for a in range(9) for b in range(a + 1, 9) if rnd.random() < 0.6], rnd.sample(range(500, 1000), 36))]
    if pairs:
        assert _linkage(pairs) == _greedy(pairs, 755)


def test_linkage_by_joins_equals_linkage_in_a_task(spark):
    rnd = random.Random(8)
    pairs = [(a, b, rnd.choice([700, 760, 800, 800, 900, 1000])) for a in range(60) for b in range(a + 1, 60) if rnd.random() < 0.08]
    weight = {x: rnd.choice([1, 1, 3]) for x in range(60)}
    df = spark.createDataFrame([(a, b, s, weight[a], weight[b]) for a, b, s in pairs], "a bigint, b bigint, similarity int, wa bigint, wb bigint")
    got = {r["item"]: r["cluster"] for r in names.linkage_rounds(df, 755).collect()}
    want = _linkage(pairs, weight)
    assert got == {x: c for x, c in want.items() if x != c} and len(got) > 10
    assert names.linkage_rounds(df.where("similarity < 0"), 755).count() == 0


KEYS = "side int, key string, core string, zone int, place string"


def _keys(df, block="kind"):
    extra = [F.max(c).alias(c) for c in df.columns if c not in ("side", "key", "core", "zone", "place", block)]
    return df.groupBy("side", "key", block).agg(F.collect_set("core").alias("cores"), F.max("zone").alias("zone"), F.max("place").alias("place"), *extra)


@pytest.mark.parametrize("task_names,task_edges", [(1 << 15, 1 << 20), (3, 1 << 20), (1 << 15, 1), (2, 0)])
def test_linked_names(spark, task_names, task_edges):
    rows = [
        (0, "m1", "toke momejo", 5, None), (0, "m2", "toke momejo", 5, None), (1, "u1", "momejo tokke", 5, None), (1, "u1", "toke momej", 5, None), (1, "u1", "toke momej", 5, None),
        (0, "m3", "sefe neshoba", 0, "p"), (1, "u3", "s neshoba", 6, "p"), (1, "u4", "sefe neshoba", 6, "q"), (1, "u5", "hodu gohisi", 5, None), (0, "m6", "gumuqu meshi", 7, None), (1, "u6", "gumuqu meshi", 8, None),
        (0, None, "x y", 5, None), (0, "m9", None, 5, None), (0, "m8", "", 5, None),
    ]
    df = _keys(spark.createDataFrame(rows, KEYS).withColumn("kind", F.lit("hc")).withColumn("part", F.lit(9)).withColumn("similarity", F.lit("clash")))
    links = lambda x: names.linked_pairs(names.link_names(x, ["kind"], task_names=task_names, task_edges=task_edges))
    assert {(r.left_key, r.right_key) for r in links(df).collect()} == {("m1", "u1"), ("m2", "u1"), ("m3", "u3")}
    assert links(df.limit(0)).count() == 0


def test_keys_tried_in_several_blocks(spark):
    rows = [
        (0, "m", "toke momejo", 5, 1), (1, "u1", "toke momejo", 5, None), (0, "n1", "sefe neshoba", 6, 1), (0, "n2", "sefe neshoba", 6, 2), (1, "u2", "sefe neshoba", 6, None), (1, "u3", "hodu gohisi", 6, None),
        (0, "o", "hodu gohissi", 6, 2), (1, "u4", "lazo peku", 6, None), (0, "p", "lazo peku", 6, None),
    ]
    df = _keys(spark.createDataFrame([(a, b, c, d, None, e) for a, b, c, d, e in rows], KEYS + ", region int").withColumn("kind", F.lit("hc")), "region")
    got = names.linked_pairs(names.link_names(df, ["region", "kind"], tried={"region": [1, 2, 3]}))
    # u1 and u3 have one best region; u2 has two; of u4 and p no region is known at all
    assert sorted(tuple(r) for r in got.collect()) == [("m", "u1"), ("o", "u3")]


# -- sentences --------------------------------------------------------------------------------------------------------


def cut(text):
    return [text[a:b] for a, b in sentences.units(text)]


def test_sentence_units():
    assert cut(None) == cut("") == cut(" \n\n ") == []
    assert cut('Dr. A. B. Cee answered: "The road is cut. Nobody came." The nurse left.') == ['Dr. A. B. Cee answered: "The road is cut. Nobody came."', "The nurse left."]
    assert cut('"Who signed?" asked Mr. X, and nobody knew. OK.') == ['"Who signed?" asked Mr. X, and nobody knew.', "OK."]
    assert cut("We got soap, etc. in May. It has soap, etc. The rest (see p. 8)! e-mail is down.") == ["We got soap, etc. in May.", "It has soap, etc.", "The rest (see p. 8)!", "e-mail is down."]
    assert cut("It was 4.5 kg at 11.30 p.m. sharp. 38 vials were left?! We waited... Then one… The end") == ["It was 4.5 kg at 11.30 p.m. sharp.", "38 vials were left?!", "We waited...", "Then one…", "The end"]
    assert cut("Dry ... and sold.Then we left near Gen. Hosp. Names vary.") == ["Dry ... and sold.", "Then we left near Gen. Hosp.", "Names vary."]
    assert cut("Summary\n\nTo do:\n1. keys of X H.C.\n2. a scale (max. 2 kg)\n\nDone by 5 p.m.\n- and then left.") == ["Summary", "To do:", "1. keys of X H.C.", "2. a scale (max. 2 kg)", "Done by 5 p.m.\n- and then left."]
    assert cut("በ2013 ዓ.ም. ተከፈተ። ቆጠረ።በ2011 ተመለሰ:: ወይ፧") == ["በ2013 ዓ.ም. ተከፈተ።", "ቆጠረ።", "በ2011 ተመለሰ::", "ወይ፧"]
    assert cut("“谁签的字？”主任问。护士说：“路断了。没有人来。”在上周没有水！去年10人……比去年多。") == ["“谁签的字？”主任问。", "护士说：“路断了。没有人来。”", "在上周没有水！", "去年10人……比去年多。"]
    assert cut("قالت: «لا يوجد ماء. نحن ننتظر». زار د. Ganupu المركز؟") == ["قالت: «لا يوجد ماء. نحن ننتظر».", "زار د. Ganupu المركز؟"]
    assert cut("ยาหมด21.15กิโล ไม่มีน้ำ\nทะเบียน The roof leaks. OK.") == ["ยาหมด21.15กิโล", "ไม่มีน้ำ", "ทะเบียน", "The roof leaks.", "OK."]
    assert cut("« Il n'y a plus d'eau. Nous attendons », a dit Mme Xa. Quel retard ! M. Ya attend.") == ["« Il n'y a plus d'eau. Nous attendons », a dit Mme Xa.", "Quel retard !", "M. Ya attend."]
    assert cut('An open " quote. And (a bracket. End') == ['An open " quote.', "And (a bracket.", "End"]
    assert len(cut("One here. " * 20_000)) == 20_000


@given(st.text(alphabet='aB1 .!?"()\n:-።。ก…', max_size=60))
@settings(max_examples=300, deadline=None)
def test_units_are_in_order_and_cover_the_text(text):
    spans = sentences.units(text)
    last = 0
    for a, b in spans:
        assert last <= a < b and not text[a].isspace() and not text[b - 1].isspace() and not text[last:a].strip()
        last = b
    assert not text[last:].strip()


def test_sentences_of_documents(spark):
    df = spark.createDataFrame([(1, "A b. C d."), (2, None), (3, ""), (1, "A b. C d.")], "doc_id bigint, text string").withColumn("id", F.lit("clash"))
    assert sorted(map(tuple, sentences.sentence_units(df).collect())) == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9)]


# -- packing ----------------------------------------------------------------------------------------------------------


def _plain_sum_of_squares(sizes, capacity):
    gaps, out = [], []
    for s in sizes:
        best = None
        for g in sorted({g for g in gaps if g >= s}) + [None]:
            after = Counter(x for x in gaps if x)
            if g is not None:
                after[g] -= 1
            left = (capacity if g is None else g) - s
            if left:
                after[left] += 1
            cost = sum(v * v for v in after.values())
            if best is None or cost < best[0]:
                best = (cost, g)
        k = len(gaps) if best[1] is None else next(i for i in range(len(gaps) - 1, -1, -1) if gaps[i] == best[1])
        if best[1] is None:
            gaps.append(capacity)
        gaps[k] -= s
        out.append(gaps[k])
    return out, len(gaps)


@given(st.lists(st.integers(1, 12), max_size=30))
@settings(max_examples=80, deadline=None)
def test_sum_of_squares_against_its_definition(sizes):
    where, used = packing.sum_of_squares(sizes, 12)
    fill = Counter()
    left = []
    for b, s in zip(where, sizes):
        fill[b] += s
        left.append(12 - fill[b])
    assert max(fill.values(), default=0) <= 12
    want, n = _plain_sum_of_squares(sizes, 12)
    assert used == n and left == want


def test_packed_documents(spark):
    rows = [(i, n) for i, n in enumerate([0, None, 3, 2048, 2049, 5000, 7, 1000, 1000, 48])]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint").withColumn("shard", F.lit("clash")).withColumn("n", F.lit("clash"))
    for shard_rows in (1 << 14, 3):
        got = packing.pack(df, 2048, rows=10, shard_rows=shard_rows).collect()
        fill, per = Counter(), Counter()
        for r in got:
            fill[r.container] += r.tokens
            per[r.doc_id] += r.tokens
            assert r.start_token == r.piece * 2048
        assert max(fill.values()) <= 2048 and {i: per[i] for i, _ in rows} == {i: n or 0 for i, n in rows}
        assert {r.doc_id for r in got if r.piece} == {4, 5}
    assert packing.pack(df.limit(0), 2048, rows=0).count() == 0


def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "ab " * 50_000), (2, None), (3, "")], "doc_id bigint, text string")
    n = {r.doc_id: r.n_tokens for r in tokens.token_counts(df).collect()}
    assert n[2] == n[3] == 0 and n[1] == len(tokens.encoding().encode_ordinary("ab " * 50_000))


# -- mixing -----------------------------------------------------------------------------------------------------------


def test_raking_meets_margins_within_caps():
    rng = np.random.default_rng(1)
    dims = [np.repeat(np.arange(3), 8), np.tile(np.repeat(np.arange(4), 2), 3), np.tile(np.arange(2), 12)]
    t = rng.uniform(50, 200, 24)
    shares = [np.array([0.5, 0.3, 0.2]), np.full(4, 0.25), np.array([0.6, 0.4])]
    w = mixing.rake(t, dims, shares, np.array([9.0, 9.0, 9.0]), 1000.0)
    for d, s in zip(dims, shares):
        assert np.allclose(np.bincount(d, w * t), s * 1000, rtol=1e-4)
    tight = mixing.rake(t, dims, shares, np.array([1.0, 2.0, 3.0]), 800.0)
    assert np.all(tight <= np.array([1.0, 2.0, 3.0])[dims[0]] + 1e-9) and np.allclose(np.bincount(dims[0], tight * t), shares[0] * 800, rtol=1e-3)


def test_shares_of_drawn_documents(spark):
    rnd = random.Random(1)
    docs = [(i, rnd.choice(["a", "a", "a", "b", "c", None, "untargeted"]), rnd.choice(["en", "EN-gb", "amh", None]), "word " * rnd.randint(1, 60)) for i in range(900)] + [(900, "a", "en", None), (901, "a", "en", "")]
    target = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    sized = mixing.measured(spark.createDataFrame(docs, "doc_id bigint, source string, lang string, text string").withColumn("h", F.lit("clash"))).cache()
    assert {r.lang for r in sized.select("lang").distinct().collect()} == {"en", "am", "und"}
    w = mixing.calibrate(sized, target)
    drawn = mixing.draw(sized, spark.createDataFrame(w, "source string, lang string, topic int, tokens bigint, weight double"), rows=902, chunk_rows=64).cache()
    got = {r.source: r for r in mixing.shares_reached(drawn, target).collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert abs(got[s].share_reached - share / 0.9) < 0.02 and got[s].most_copies <= got[s].max_repeats
    assert got["none"].tokens == 0 and {r.source for r in drawn.select("source").distinct().collect()} == {"a", "b", "c"}
    assert len(mixing.calibrate(sized.limit(0), target)) == 0


def test_topics_are_fitted_on_all_documents(spark):
    rnd = random.Random(4)
    # more documents than a sample would hold; half of their words are those of another topic
    texts = [" ".join(f"{w}{rnd.randint(0, 30)}" for w in rnd.choices("abcdefgh", [6 if k == i % 8 else 1 for k in range(8)], k=30)) for i in range(3000)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("doc_id", "'s' source", "'en' lang", "text").repartition(3)
    own = np.array([r.topic for r in mixing.measured(docs).orderBy("doc_id").collect()])
    x = np.zeros((len(texts), 512))
    for i, t in enumerate(texts):
        for w, k in Counter((t or "").split()).items():
            x[i, zlib.crc32(w.encode()) % 512] += 1 + np.log(k)
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    centres = np.array([x[own == k].sum(axis=0) for k in range(8)])
    centres /= np.sqrt((centres * centres).sum(axis=1, keepdims=True))
    # each document is under the topic whose mean, taken over all documents, is nearest
    assert (own == (x @ centres.T).argmax(axis=1)).all()
    again = np.array([r.topic for r in mixing.measured(docs.repartition(7)).orderBy("doc_id").collect()])
    assert (own == again).all()


# -- queries ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["p3_found"])
def test_queries_match_sql(spark, sf, name):
    import os

    import duckdb

    from weft.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    want = con.execute("select " + ", ".join(f'"{c}"' for c in cols) + f" from ({ORACLE[name]})").fetchall()
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == sorted(want)


def test_found_queries_have_their_columns(spark, sf):
    from weft.llm.queries import QUERIES

    want = {"p1_found": ["mfr_id", "dhis2_uid"], "p3_found": ["table_name", "facility_key", "column_name", "record_no"], "p5_found": ["group_key", "member_key"], "p6_found": ["field_name", "record_no", "geo_id"], "p10_found": ["doc_id", "start_char", "end_char"]}
    for name, cols in want.items():
        df = QUERIES[name](spark, sf)
        assert df.columns == cols and df.count() > 0 and df.count() == df.distinct().count(), name
    assert table(spark, sf, "documents").count() > 0
