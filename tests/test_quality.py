"""Orphans, profile and nearness against brute force, and their edge cases."""

import math
import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weft.operators import near, orphans
from weft.operators import profile as prof


@given(st.sets(st.integers(0, 200_000), max_size=200), st.sets(st.integers(0, 200_000), max_size=200))
@settings(max_examples=40, deadline=None)
def test_bitmap_and_not(a, b):
    assert set(orphans.Bitmap.of(np.array(sorted(a), dtype=int)).and_not(orphans.Bitmap.of(np.array(sorted(b), dtype=int))).codes()) == a - b


def test_bitmap_dense_parts_are_packed():
    dense, sparse = np.arange(0, 60_000), np.arange(0, 60_000, 7)
    d, s = orphans.Bitmap.of(dense), orphans.Bitmap.of(sparse)
    assert d.nbytes() == 8192
    assert list(d.and_not(s).codes()) == sorted(set(dense) - set(sparse))
    assert list(s.and_not(d).codes()) == []


def _t(m, day=1):
    return datetime(2024, m, day)


def test_orphans_cases(spark):
    refs = spark.createDataFrame(
        [("a", 1, "K1", _t(3)), ("a", 1, "K1", _t(3)), ("a", 2, "K2", _t(3)), ("a", 3, "K3", _t(3, 10)), ("a", 4, "K3", _t(3, 20)), ("b", 5, "K4", _t(5)), ("b", 6, "K4", _t(7)), ("b", 7, None, _t(7)), ("b", 8, "K1", None)],
        "ref_table string, ref_no bigint, key string, at timestamp",
    )
    parents = spark.createDataFrame(
        [("K1", _t(1), None), ("K3", _t(3, 15), None), ("K3", _t(4), None), ("K4", _t(1), _t(6)), ("K4", _t(2), _t(6)), (None, _t(1), None)],
        "key string, first_at timestamp, gone_at timestamp",
    )
    for keys in (1, 10**6):
        got = {(r.ref_table, r.period, r.ref_no, r.key) for r in orphans.orphan_references(refs, parents, key_rows=keys, range_keys=1 << 15).collect()}
        assert got == {("a", "2024-03", 2, "K2"), ("a", "2024-03", 3, "K3"), ("b", "2024-07", 6, "K4")}
    assert orphans.orphan_references(refs.limit(0), parents, key_rows=0).count() == 0
    assert orphans.orphan_references(refs, parents.limit(0), key_rows=9).count() == 6
    rep = {(r.ref_table, r.period): (r.references, r.orphans, r.missing_keys) for r in orphans.orphan_report(refs, orphans.orphan_references(refs, parents, key_rows=9)).collect()}
    assert rep["a", "2024-03"] == (4, 2, 2) and rep["b", "2024-05"] == (1, 0, 0)


def test_profile_counts_and_changes(spark):
    rows = [(1, str(v)) for v in (10, 20, 30, 40)] + [(1, None), (1, "  "), (1, "4o"), (1, "007"), (2, "100"), (2, "90"), (2, None), (2, None), (2, None), (2, "99999999999999999999999")]
    df = spark.createDataFrame(rows, "load_no int, beds string").selectExpr("*", "1 AS n", "'x' AS value")
    spec = prof.ProfileSpec("load_no", [prof.ColumnRule("beds", "number", 2000)])
    p = {r.load_no: r for r in prof.profile(df, spec).collect()}
    assert (p[1].rows, p[1].null_rate, p[1].violation_rate, p[1].median, p[1].least, p[1].most) == (8, 0.25, 0.125, 20.0, 7, 40)
    assert (p[2].rows, p[2].null_rate, p[2].median) == (6, 0.5, 95.0)
    got = {(r.load_no, r.measure) for r in prof.changes(prof.profile(df, spec)).collect()}
    assert {(2, "null_rate"), (2, "median")} <= got and (2, "violation_rate") not in got
    assert prof.profile(df.limit(0), spec).count() == 0


def test_induced_expressions_prefer_runs_over_lists(spark):
    values = [("c", f"{i}") for i in range(100, 400)] + [("c", f"AB-{i}") for i in range(10, 90)] + [("c", "?!")] + [("c", None)]
    got = {r.value: r.expression for r in prof.induce(spark.createDataFrame(values, "column_name string, value string")).collect()}
    assert got["100"] == got["399"] and r"\d" in got["100"]
    assert got["AB-10"] == got["AB-89"] != got["100"]
    assert None not in got


def test_ear_clip_covers_a_concave_ring():
    ring = np.array([[0, 0], [4, 0], [4, 4], [2, 1], [0, 4]], float)
    tri = near.ear_clip(ring)
    area = sum(abs((t[1, 0] - t[0, 0]) * (t[2, 1] - t[0, 1]) - (t[1, 1] - t[0, 1]) * (t[2, 0] - t[0, 0])) / 2 for t in tri)
    x, y = ring[:, 0], ring[:, 1]
    assert math.isclose(area, abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)
    assert len(near.ear_clip(ring[::-1])) == 3 and len(near.ear_clip(ring[:2])) == 0
    assert len(near.ear_clip(np.vstack([ring, ring[:1], ring[:1]]))) == 3


def _covered(tri):
    return sum(abs((t[1, 0] - t[0, 0]) * (t[2, 1] - t[0, 1]) - (t[1, 1] - t[0, 1]) * (t[2, 0] - t[0, 0])) / 2 for t in tri)


def test_ear_clip_with_holes_and_crossing_rings():
    square = np.array([[0, 0], [10, 0], [10, 10], [0, 10]], float)
    holes = [np.array([[1, 1], [1, 3], [3, 3], [3, 1]], float), np.array([[6, 6], [8, 6], [7, 8]], float)]
    tri = near.ear_clip(square, holes)
    assert math.isclose(_covered(tri), 100 - 4 - 2)
    inside = lambda x, y: near.in_triangles(np.array([[x, y]] * len(tri), float), tri).any()
    assert inside(5, 5) and inside(0.5, 9) and not inside(2, 2) and not inside(7, 7) and inside(1, 2)
    # a bow tie crosses itself; corners on a straight line cost nothing
    assert len(near.ear_clip(np.array([[0, 0], [2, 2], [2, 0], [0, 2.5]], float))) == 0
    assert math.isclose(_covered(near.ear_clip(np.array([[0, 0], [1, 0], [2, 0], [2, 1], [2, 2], [0, 2]], float))), 4)


@given(st.lists(st.floats(0.2, 5), min_size=3, max_size=14))
@settings(max_examples=60, deadline=None)
def test_ear_clip_covers_star_shaped_rings(radii):
    turn = 2 * np.pi * np.arange(len(radii)) / len(radii)
    ring = np.stack([np.array(radii) * np.cos(turn), np.array(radii) * np.sin(turn)], axis=1)
    x, y = ring.T
    assert math.isclose(_covered(near.ear_clip(ring)), abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2, rel_tol=1e-6)


def _inside(p, ring):
    n, c = len(ring), False
    for i in range(n):
        (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
            c = not c
    return c


def test_containment_against_ray_casting(spark):
    rnd = random.Random(4)
    regions = []
    for k in range(12):
        cx, cy, n = rnd.uniform(34, 46), rnd.uniform(4, 14), rnd.randint(3, 9)
        regions.append((f"r{k}", [(cx + rnd.uniform(0.2, 2) * math.cos(2 * math.pi * i / n), cy + rnd.uniform(0.2, 2) * math.sin(2 * math.pi * i / n)) for i in range(n)]))
    pts = [(f"p{i}", rnd.uniform(33, 47), rnd.uniform(3, 15)) for i in range(300)] + [("p0x", None, 4.0), (None, 40.0, 8.0)]
    pdf = spark.createDataFrame(pts + pts[:5], "point_id string, lon double, lat double")
    rdf = spark.createDataFrame([(k, [c for xy in r for c in xy]) for k, r in regions] + [("none", None)], "region_id string, ring array<double>")
    want = {(p, k) for p, x, y in pts if p and x is not None for k, r in regions if _inside((x, y), r)}
    for node_points in (4096, 8):
        got = [(r.point_id, r.region_id) for r in near.containing_regions(pdf, rdf, node_points=node_points, block_triangles=16).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    # a point on the edge that two regions share lies in both, once each
    two = spark.createDataFrame([("w", [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0]), ("e", [1.0, 0.0, 2.0, 0.0, 2.0, 1.0, 1.0, 1.0])], "region_id string, ring array<double>")
    edge = spark.createDataFrame([("p", 1.0, 0.5)], "point_id string, lon double, lat double")
    assert sorted(r.region_id for r in near.containing_regions(edge, two).collect()) == ["e", "w"]


def _metres(a, b):
    h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * near.EARTH_M * math.asin(math.sqrt(h))


@pytest.mark.parametrize("node_points", [4096, 4])
def test_near_pairs_against_brute_force(spark, node_points):
    rnd = random.Random(2)
    pts = {f"f{i:03}": (40 + rnd.uniform(0, 0.01), 9 + rnd.uniform(0, 0.01)) for i in range(80)}
    pts |= {f"g{i:02}": (40.0, 9.0) for i in range(12)}  # a crowd at one spot
    rows = [(k, x, y) for k, (x, y) in pts.items()]
    df = spark.createDataFrame(rows + rows[:7] + [("f999", None, None)], "point_id string, lon double, lat double")
    got = {(r.id_a, r.id_b) for r in near.near_pairs(df, 100.0, node_points=node_points).collect()}
    assert got == {(a, b) for a in pts for b in pts if a < b and _metres(pts[a], pts[b]) <= 100}
    assert near.near_pairs(df.limit(0), 100.0).count() == 0
