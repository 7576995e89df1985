"""Points near other points or inside regions.

Polygons are cut into triangles by ear clipping. The triangles are distributed by a bounding-volume hierarchy: its
upper levels are the nodes of a quadtree, split wherever more than `node_points` points lie, so that they follow the
density; below each node a task builds a binary hierarchy of bounding boxes over the triangles that reach it and walks
the node's points down, all points at once. A point inside a box is tested against the triangle exactly, and a point
on the edge two triangles or regions share comes out once per region.

A node at the last level that still holds too many points is dealt in blocks of points by blocks of triangles, each
pair of blocks once: no task grows with the crowd, and no pair is left out.

Nulls: a point without id or position lies nowhere; a polygon of fewer than three distinct corners, or one that crosses
itself, covers nothing. Holes are no part of a polygon but for their edges.
Repeated points of one id come out once per region. Either side may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.session import cut

EARTH_M = 6_371_008.8
STEP = 2
LEVELS = range(4, 19, STEP)  # quadtree levels: the finest cell is 360 / 2**18 degrees, about 150 m
LEAF = 8


# -- ear clipping -----------------------------------------------------------------------------------------------------


def _cross(o: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[..., 0] - o[..., 0]) * (b[..., 1] - o[..., 1]) - (a[..., 1] - o[..., 1]) * (b[..., 0] - o[..., 0])


def _clean(ring: np.ndarray) -> np.ndarray:
    """Without repeated corners and the closing one, counter-clockwise."""
    if len(ring) > 1:
        ring = ring[np.r_[True, np.any(np.diff(ring, axis=0) != 0, axis=1)]]
    if len(ring) > 1 and np.array_equal(ring[0], ring[-1]):
        ring = ring[:-1]
    if len(ring) < 3:
        return ring[:0]
    x, y = ring[:, 0], ring[:, 1]
    area = np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))
    return ring[::-1] if area < 0 else ring


def bridged(outer: np.ndarray, holes: list[np.ndarray]) -> np.ndarray:
    """One ring of an outer ring and its holes, each tied in by a bridge walked both ways, from its rightmost corner to the
    nearest corner of the ring to the right that it can see."""
    ring = _clean(np.asarray(outer, dtype=float).reshape(-1, 2))
    rest = [h for h in (_clean(np.asarray(h, dtype=float).reshape(-1, 2))[::-1] for h in holes) if len(h)]
    for h in sorted(rest, key=lambda h: -h[:, 0].max()):
        k = int(np.argmax(h[:, 0]))
        m = h[k]
        a, b = ring, np.roll(ring, -1, axis=0)
        away = np.hypot(*(ring - m).T)
        for j in np.argsort(np.where(ring[:, 0] >= m[0], away, np.inf), kind="stable"):
            q = ring[j]
            # the bridge must cross no side; sides that end at the corner itself don't count
            ends = (a == q).all(1) | (b == q).all(1)
            cross = (_cross(m, q, a) * _cross(m, q, b) < 0) & (_cross(a, b, m) * _cross(a, b, q) < 0)
            if not (cross & ~ends).any():
                ring = np.concatenate([ring[: j + 1], np.roll(h, -k, axis=0), m[None], ring[j:]])
                break
    return ring


def ear_clip_all(rings: np.ndarray) -> np.ndarray:
    """The triangles (m, n - 2, 3, 2) of many simple rings of n corners (m, n, 2), counter-clockwise, clipped together: in
    each step every ring loses its first ear, a corner that turns left and whose triangle holds no other corner. A corner on
    a straight line is clipped as an empty triangle; a ring without an ear crosses itself and gives not-a-number."""
    m, n, _ = rings.shape
    left = rings.astype(float)
    out = np.full((m, max(n - 2, 0), 3, 2), np.nan)
    ok = np.ones(m, bool)
    for step in range(n - 2):
        k = left.shape[1]
        before, after, at = np.roll(left, 1, axis=1), np.roll(left, -1, axis=1), np.arange(m)
        turn = _cross(before, left, after)
        first = np.full(m, -1)
        for c in range(k):
            may = (first < 0) & (turn[:, c] > 0)
            if k > 3 and may.any():
                a, b, d = before[may, c, None], left[may, c, None], after[may, c, None]
                p = left[may]
                inside = (_cross(a, b, p) >= 0) & (_cross(b, d, p) >= 0) & (_cross(d, a, p) >= 0)
                corner = (p == a).all(2) | (p == b).all(2) | (p == d).all(2)
                may[may] = ~(inside & ~corner).any(axis=1)
            first[may] = c
            if (first >= 0).all():
                break
        # a flat corner goes only where nothing else can be cut
        flat = (turn == 0).any(axis=1)
        ok &= (first >= 0) | flat
        first = np.where(first >= 0, first, np.argmax(turn == 0, axis=1))
        out[:, step] = np.stack([before[at, first], left[at, first], after[at, first]], axis=1)
        left = left[np.arange(k)[None, :] != first[:, None]].reshape(m, k - 1, 2)
    out[~ok] = np.nan
    return out


def _area(x: np.ndarray) -> np.ndarray:
    return np.abs(np.sum(x[..., 0] * np.roll(x[..., 1], -1, axis=-1) - x[..., 1] * np.roll(x[..., 0], -1, axis=-1), axis=-1)) / 2


def ear_clip(ring: np.ndarray, holes: list[np.ndarray] = ()) -> np.ndarray:
    """The triangles (k, 3, 2) of one polygon with its holes. One that crosses itself, whose triangles do not sum up to its
    area, has none."""
    ring = bridged(ring, list(holes))
    if len(ring) < 3:
        return np.empty((0, 3, 2))
    tri = ear_clip_all(ring[None])[0]
    area = _area(ring)
    if np.isnan(tri).any() or abs(_area(tri).sum() - area) > 1e-9 * max(area, 1e-300):
        return np.empty((0, 3, 2))
    return tri[_area(tri) > 0]


# -- hierarchy below a node -------------------------------------------------------------------------------------------


class Boxes:
    """A binary hierarchy of bounding boxes over triangles, split at the median of the wider side."""

    def __init__(self, tri: np.ndarray):
        lo, hi = tri.min(axis=1), tri.max(axis=1)
        mid = (lo + hi) / 2
        self.order = np.arange(len(tri))
        self.lo, self.hi, self.kids, self.span = [], [], [], []
        todo = [(0, len(tri), -1, 0)] if len(tri) else []
        while todo:
            a, b, parent, side = todo.pop()
            me, own = len(self.lo), self.order[a:b]
            if parent >= 0:
                self.kids[parent][side] = me
            self.lo.append(lo[own].min(axis=0))
            self.hi.append(hi[own].max(axis=0))
            self.kids.append([-1, -1])
            self.span.append((a, b))
            if b - a > LEAF:
                axis = int(np.argmax(np.ptp(mid[own], axis=0)))
                k = (b - a) // 2
                self.order[a:b] = own[np.argpartition(mid[own, axis], k)]
                todo += [(a, a + k, me, 0), (a + k, b, me, 1)]
        self.lo, self.hi = np.array(self.lo).reshape(-1, 2), np.array(self.hi).reshape(-1, 2)
        self.kids, self.span = np.array(self.kids, int).reshape(-1, 2), np.array(self.span, int).reshape(-1, 2)

    def candidates(self, pts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(point, triangle) positions whose boxes meet; the walk goes level by level for all points at once."""
        if not len(self.lo) or not len(pts):
            return
        p, node = np.arange(len(pts)), np.zeros(len(pts), int)
        while len(p):
            inside = np.all((pts[p] >= self.lo[node]) & (pts[p] <= self.hi[node]), axis=1)
            p, node = p[inside], node[inside]
            leaf = self.kids[node, 0] < 0
            lp, ln = p[leaf], node[leaf]
            if len(lp):
                a, n = self.span[ln, 0], self.span[ln, 1] - self.span[ln, 0]
                at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(lp, n), self.order[at]
            p, node = p[~leaf], node[~leaf]
            p, node = np.concatenate([p, p]), np.concatenate([self.kids[node, 0], self.kids[node, 1]])


def in_triangles(pts: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """Inside or on the edge, either orientation."""
    a, b, c = (_cross(tri[:, i], tri[:, (i + 1) % 3], pts) for i in range(3))
    return ((a >= 0) & (b >= 0) & (c >= 0)) | ((a <= 0) & (b <= 0) & (c <= 0))


# -- distribution -----------------------------------------------------------------------------------------------------


def _cell(x: Column, level: Column | int) -> Column:
    """The quadtree's cell along one axis: 2**level cells over 360 degrees, the same for both axes."""
    per = F.shiftleft(F.lit(1), level) if isinstance(level, Column) else F.lit(1 << level)
    return F.least(F.greatest(F.floor((x + 180.0) * per / 360.0), F.lit(0)), per - 1).cast("int")


def _nodes(points: DataFrame, node_points: int) -> DataFrame:
    """(level, x, y, n, leaf): the quadtree's nodes with their numbers of points; counts go up level by level."""
    fine = points.groupBy(_cell(F.col("lon"), LEVELS[-1]).alias("x"), _cell(F.col("lat"), LEVELS[-1]).alias("y")).agg(F.count("*").alias("n"))
    up = lambda c, k: F.shiftright(c, LEVELS[-1] - k).alias(c)
    ups = F.array(*[F.struct(F.lit(k).alias("level"), up("x", k), up("y", k)) for k in LEVELS])
    tree = fine.select("n", F.explode(ups).alias("c")).groupBy("c.level", "c.x", "c.y").agg(F.sum("n").alias("n"))
    tree = tree.withColumn("leaf", (F.col("n") <= node_points) | (F.col("level") == LEVELS[-1]))
    full = tree.where("not leaf").select((F.col("level") + STEP).alias("level"), F.col("x").alias("px"), F.col("y").alias("py"))
    below = tree.where(F.col("level") > LEVELS[0]).withColumns({"px": F.shiftright("x", STEP), "py": F.shiftright("y", STEP)})
    return tree.where(F.col("level") == LEVELS[0]).unionByName(below.join(full, ["level", "px", "py"], "left_semi").select(tree.columns))


def _triangles(it: Iterator[pd.DataFrame], sides: int, carry: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        if sides:
            rings = np.stack(pdf["ring"].to_list()) if len(pdf) else np.empty((0, 2 * sides))
            tri = ear_clip_all(rings.reshape(-1, sides, 2))
            each = np.full(len(pdf), tri.shape[1])
            tri = tri.reshape(-1, 3, 2)
        else:
            inner = pdf["holes"] if "holes" in pdf else [[]] * len(pdf)
            cut_up = [ear_clip(np.asarray(r, dtype=float), [np.asarray(h, dtype=float) for h in (hs if hs is not None else [])]) for r, hs in zip(pdf["ring"], inner)]
            each = np.array([len(e) for e in cut_up], dtype=int)
            tri = np.concatenate(cut_up) if cut_up else np.empty((0, 3, 2))
        flat = tri.reshape(-1, 6)
        yield pd.DataFrame({c: np.repeat(pdf[c].to_numpy(), each) for c in ["region_id", *carry]} | {f"t{i}": flat[:, i] for i in range(6)})


def _meet(pts: pd.DataFrame, tris: pd.DataFrame, carry: list[str]) -> pd.DataFrame:
    tri = tris[[f"t{i}" for i in range(6)]].to_numpy().reshape(-1, 3, 2)
    xy = pts[["lon", "lat"]].to_numpy()
    found = []
    for p, t in Boxes(tri).candidates(xy):
        hit = in_triangles(xy[p], tri[t])
        found.append((p[hit], t[hit]))
    p, t = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))
    region = pd.factorize(tris["region_id"])[0]
    # one triangle for each point and region: a shared edge counts once
    _, first = np.unique(p * np.int64(len(tris) + 1) + region[t], return_index=True)
    p, t = p[first], t[first]
    return pd.DataFrame(
        {"point_id": pts["point_id"].to_numpy()[p], "lon": xy[p, 0], "lat": xy[p, 1], "region_id": tris["region_id"].to_numpy()[t]} | {c: tris[c].to_numpy()[t] for c in carry}
    )


def containing_regions(
    points: DataFrame, regions: DataFrame, *, carry: list[str] = (), sides: int = 0, node_points: int = 4096, block_triangles: int = 1 << 15
) -> DataFrame:
    """(point_id, lon, lat, region_id, *carry): the regions each point lies in or on.

    points: point_id string, lon, lat in degrees. regions: region_id string, ring array<double> of lon, lat in turn, if need
    be holes array<array<double>> of such rings, and the double columns to carry; rings do not cross the date line. sides: set
    where all rings are simple, counter-clockwise, without holes and of so many corners; they are then clipped together.
    """
    carry = list(carry)
    pts = points.where("point_id is not null and lon between -180 and 180 and lat between -90 and 90").select("point_id", "lon", "lat").distinct()
    nodes = cut(_nodes(pts, node_points), "near-nodes")
    inner = nodes.select("level", "x", "y", "leaf")

    tris = regions.where("region_id is not null and ring is not null").select("region_id", "ring", *(["holes"] if "holes" in regions.columns and not sides else []), *carry)
    tris = tris.mapInPandas(
        lambda it: _triangles(it, sides, carry), "region_id string, " + "".join(f"{c} double, " for c in carry) + ", ".join(f"t{i} double" for i in range(6))
    )
    box = {"x": [F.least("t0", "t2", "t4"), F.greatest("t0", "t2", "t4")], "y": [F.least("t1", "t3", "t5"), F.greatest("t1", "t3", "t5")]}
    span = lambda a, k: (_cell(box[a][0], k), _cell(box[a][1], k))
    reach = tris.withColumns({"level": F.lit(LEVELS[0]), "x": F.explode(F.sequence(*span("x", LEVELS[0])))}).withColumn("y", F.explode(F.sequence(*span("y", LEVELS[0]))))
    reach = reach.join(inner, ["level", "x", "y"])
    for k in LEVELS[1:]:
        # a triangle goes down from a full node into those of its cells that its box meets; cells without points fall out
        for a in ("x", "y"):
            lo, hi = span(a, k)
            c = F.col(a)
            kids = F.sequence(F.greatest(lo, F.shiftleft(c, STEP)), F.least(hi, F.shiftleft(c, STEP) + (1 << STEP) - 1))
            reach = reach.withColumn(f"{a}k", F.explode(F.when(F.col("leaf"), F.array(c)).otherwise(kids)))
        reach = reach.select(*tris.columns, F.when(F.col("leaf"), F.col("level")).otherwise(F.lit(k)).alias("level"), F.col("xk").alias("x"), F.col("yk").alias("y"))
        reach = reach.join(inner, ["level", "x", "y"])
    reach = cut(reach.drop("leaf"), "near-reach")

    # crowded cells of the last level: blocks of points by blocks of triangles
    crowd = reach.groupBy("level", "x", "y").agg(F.count("*").alias("triangles"))
    blocks = nodes.where("leaf").join(crowd, ["level", "x", "y"]).select(
        "level", "x", "y", F.ceil(F.col("n") / F.lit(2 * node_points)).cast("int").alias("pb"), F.ceil(F.col("triangles") / F.lit(block_triangles)).cast("int").alias("tb")
    )
    blocks = cut(blocks, "near-blocks")
    cells = F.array(*[F.struct(F.lit(k).alias("level"), _cell(F.col("lon"), k).alias("x"), _cell(F.col("lat"), k).alias("y")) for k in LEVELS])
    placed = pts.select("*", F.explode(cells).alias("c")).select("point_id", "lon", "lat", "c.*").join(blocks, ["level", "x", "y"])
    placed = placed.withColumn("p", F.pmod(F.xxhash64("point_id"), "pb").cast("int")).withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tb") - 1)))
    sent = reach.join(blocks, ["level", "x", "y"])
    sent = sent.withColumn("t", F.pmod(F.xxhash64("region_id"), "tb").cast("int")).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
    key = ["level", "x", "y", "p", "t"]
    return (
        placed.drop("pb", "tb")
        .groupBy(*key)
        .cogroup(sent.drop("pb", "tb").groupBy(*key))
        .applyInPandas(lambda a, b: _meet(a, b, carry), "point_id string, lon double, lat double, region_id string" + "".join(f", {c} double" for c in carry))
    )


# -- points near points -----------------------------------------------------------------------------------------------


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def buffers(points: DataFrame, metres: float) -> DataFrame:
    """(region_id, ring, clon, clat): around each point, the four-sided region that just holds the circle."""
    r = metres / EARTH_M
    dlat = F.lit(np.degrees(r) * (1 + 1e-9))
    dlon = F.degrees(F.asin(F.least(F.lit(np.sin(r)) / F.cos(F.radians("lat")), F.lit(1.0)))) * (1 + 1e-9)
    w, e, s, n = F.col("lon") - dlon, F.col("lon") + dlon, F.col("lat") - dlat, F.col("lat") + dlat
    return points.select(F.col("point_id").alias("region_id"), F.array(w, s, e, s, e, n, w, n).alias("ring"), F.col("lon").alias("clon"), F.col("lat").alias("clat"))


def near_pairs(points: DataFrame, metres: float, *, node_points: int = 4096) -> DataFrame:
    """(id_a, id_b, metres), id_a < id_b: the points at most so far apart on the sphere. Not for the poles and the date line."""
    pts = points.where("point_id is not null and lon is not null and lat is not null").select("point_id", "lon", "lat").distinct()
    hits = containing_regions(pts, buffers(pts, metres), carry=["clon", "clat"], sides=4, node_points=node_points)
    far = haversine_m(F.col("lon"), F.col("lat"), F.col("clon"), F.col("clat"))
    return hits.where("point_id < region_id").withColumn("metres", far).where(F.col("metres") <= metres).groupBy(F.col("point_id").alias("id_a"), F.col("region_id").alias("id_b")).agg(F.min("metres").alias("metres"))
