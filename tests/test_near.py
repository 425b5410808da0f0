import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ambitus.functions import geo, regions
from ambitus.operators import near
from ambitus.operators.near import points_in_regions, points_near_points
from ambitus.plans import place_queries


def miles(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_MILES * math.asin(math.sqrt(min(1, h)))


def cluster(rng, n):
    centres = [(10.0, 20.0), (89.999, 30.0), (-89.9995, -170.0), (5.0, 180.0), (45.0, 45.0), (35.2644, 45.0)]
    out = []
    for i in range(n):
        la, lo = centres[i % len(centres)]
        la, lo = la + rng.uniform(-0.02, 0.02), lo + rng.uniform(-0.03, 0.03)
        out.append((i, max(-90.0, min(90.0, la)), (lo + 180) % 360 - 180))
    return out


def test_near_same_as_brute_force(spark):
    rng = random.Random(4)
    pts, tgt = cluster(rng, 240), [(i, la, lo, [0.0, 0.3, 0.9, 40.0][i % 4]) for i, la, lo in cluster(rng, 160)]
    want = {(p[0], t[0]) for p in pts for t in tgt if miles(p[1], p[2], t[1], t[2]) <= t[3]}
    # clashing and further columns, repeated rows, missing and impossible positions
    p = spark.createDataFrame([(*x, "a", 1) for x in pts + pts[:5]] + [(900, None, 1.0, "a", 1), (901, 0.0, 0.0, "a", 1), (902, 91.0, 0.0, "a", 1), (903, float("nan"), 0.0, "a", 1)], "id int, latitude double, longitude double, _cell string, radius int")
    t = spark.createDataFrame([(*x, 7) for x in tgt + tgt[:3]] + [(800, 10.0, 20.0, None, 7), (801, 10.0, 20.0, -1.0, 7)], "tid int, latitude double, longitude double, r double, _p int")
    got = {tuple(r) for r in points_near_points(p, t, "id", "tid", "r").collect()}
    assert got == want and len(want) > 1000


def test_any_radius_same_as_brute_force(spark):
    """More than a thousand different radii, from none to around the globe."""
    rng = random.Random(8)
    pts = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(80)]
    tgt = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180), rng.choice([0.0, 13_000.0, rng.uniform(0, 12_500), 10 ** rng.uniform(-2, 3)])) for i in range(1300)]
    want = {(p[0], t[0]) for p in pts for t in tgt if miles(p[1], p[2], t[1], t[2]) <= t[3]}
    p, t = spark.createDataFrame(pts, "id int, latitude double, longitude double"), spark.createDataFrame(tgt, "tid int, latitude double, longitude double, r double")
    assert {tuple(r) for r in points_near_points(p, t, "id", "tid", "r").collect()} == want and len({x[3] for x in tgt}) > 600


def test_near_by_and_empty(spark):
    p = spark.createDataFrame([(1, 1.0, 1.0, "x"), (2, 1.0, 1.0, None)], "id int, latitude double, longitude double, k string")
    t = spark.createDataFrame([(5, 1.0, 1.0, 1.0, "x"), (6, 1.0, 1.0, 1.0, "y"), (7, 1.0, 1.0, 1.0, None)], "tid int, latitude double, longitude double, r double, k string")
    assert [tuple(r) for r in points_near_points(p, t, "id", "tid", "r", by="k").collect()] == [(1, 5)]
    assert points_near_points(p, t.limit(0), "id", "tid", "r").collect() == []


def test_cover_cells_do_not_overlap_and_inner_cells_are_inside():
    lat, lon = np.array([10.0, 89.9999, 5.0]), np.array([20.0, 0.0, 179.9999])
    who, cells, inside = geo.cover_circles(lat, lon, 0.4)
    assert len(set(zip(who.tolist(), cells.tolist()))) == len(who)
    assert inside.any() and (~inside).any()


def test_regions_same_as_brute_force(spark):
    rng = random.Random(5)
    square = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
    hole = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]
    star = [(10.0, 10.0), (10.5, 14.0), (11.0, 10.0), (13.0, 12.0), (8.0, 12.5)]
    shapes = {"s": [square, hole], "t": [star], "flat": [[(1.0, 1.0), (2.0, 2.0)]], "none": []}
    pts = [(i, rng.uniform(-1, 14), rng.uniform(-1, 15)) for i in range(600)]

    def inside(rings, la, lo):
        odd = False
        for r in rings:
            if len(r) < 3:
                continue
            for (y1, x1), (y2, x2) in zip(r, r[1:] + r[:1]):
                if (y1 > la) != (y2 > la) and lo < (x2 - x1) * (la - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd

    want = {(i, k) for i, la, lo in pts for k, rings in shapes.items() if inside(rings, la, lo)}
    p = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    a = spark.createDataFrame([(k, [[{"latitude": y, "longitude": x} for y, x in r] for r in rings]) for k, rings in shapes.items()], "area string, rings array<array<struct<latitude:double,longitude:double>>>")
    assert {tuple(r) for r in points_in_regions(p, a, "id", "area", "rings").collect()} == want and want


def test_nearest_parent_all_same_as_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["location_id"]: (r["parent"], r["distance_miles"]) for r in place_queries.QUERIES["nearest_parent_all"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/locations.parquet").where(geo.is_position("latitude", "longitude")).select("location_id", "category", "latitude", "longitude").distinct().toPandas()
    want = {}
    for _, own in rows.groupby("category"):
        ids, la, lo = own["location_id"].to_numpy(), np.radians(own["latitude"].to_numpy()), np.radians(own["longitude"].to_numpy())
        h = np.sin((la[:, None] - la) / 2) ** 2 + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2
        far = 2 * geo.EARTH_RADIUS_MILES * np.arcsin(np.sqrt(np.minimum(1, h)))
        np.fill_diagonal(far, np.inf)
        for k in np.flatnonzero(far.min(axis=1) <= 0.5):
            want[int(ids[k])] = (far[k].min(), {int(x) for x in ids[far[k] <= far[k].min() + 1e-9]})
    assert set(got) == set(want)
    assert all(p in want[k][1] and abs(d - want[k][0]) < 2e-6 for k, (p, d) in got.items())
    assert any(k % 2 == p % 2 for k, (p, _) in got.items()) and any(k % 2 == 0 for k in got) and any(d > 0.25 for _, d in got.values())


def test_places_in_parks_same_as_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = [tuple(r) for r in place_queries.QUERIES["places_in_parks"](spark, sf).select("place_id", "p_partkey").collect()]
    pl, pk = place_queries._places(spark, sf).toPandas(), place_queries._parks(spark, sf).toPandas()
    x, y, h = (pk[c].to_numpy()[:, None] for c in ("longitude", "latitude", "h"))
    room = np.minimum(h - np.abs(pl["latitude"].to_numpy() - y), 3 * h - np.abs(pl["longitude"].to_numpy() - x))
    sure, edge = ({(int(pl["place_id"][b]), int(pk["p_partkey"][a])) for a, b in zip(*np.nonzero(m))} for m in (room > 1e-9, np.abs(room) <= 1e-9))
    assert len(got) == len(set(got)) and sure <= set(got) <= sure | edge
    assert any(a != b for a, b in got)


def test_region_cells_are_not_broadcast(spark):
    """They are many times the bytes of the regions that Spark goes by."""
    plan = place_queries.QUERIES["places_in_parks"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_regions_repeated_ids_positions_and_shapes(spark, monkeypatch):
    """Ids with several positions or shapes, without an id, and more ids of one position or shape than a row holds."""
    monkeypatch.setattr(near, "IDS_AT_ONCE", 2)
    pts = [(1, 1.0, 1.0), (1, 1.5, 1.5), (1, 9.0, 9.0), (2, 1.0, 1.0), (3, 1.0, 1.0), (4, 1.0, 1.0), (6, 1.0, 1.0), (7, 1.0, 1.0), (8, 1.0, 1.0), (5, 9.0, 9.0), (None, 1.0, 1.0), (2, 1.0, 1.0)]
    box = lambda y, x, w: [[{"latitude": y + a, "longitude": x + b} for a, b in ((0.0, 0.0), (0.0, w), (w, w), (w, 0.0))]]
    boxes = [("a", 0.5, 0.5, 2.0), ("b", 0.5, 0.5, 2.0), ("c", 0.5, 0.5, 2.0), ("d", 0.5, 0.5, 2.0), ("d", 0.9, 0.9, 0.3), ("d", 8.5, 8.5, 1.0), (None, 8.0, 8.0, 2.0)]
    p = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    a = spark.createDataFrame([(k, box(*x)) for k, *x in boxes] + [("bad", box(float("nan"), 0.0, 2.0)), ("gap", [[{"latitude": None, "longitude": 1.0}] * 3])], "area string, rings array<array<struct<latitude:double,longitude:double>>>")
    want = {(i, k) for i, y, x in pts for k, s, w, d in boxes if s < y < s + d and w < x < w + d}
    for m, n in ((p, a), (p, a.where("area < 'd'")), (p.where("id > 1"), a), (p.where("id > 1"), a.where("area < 'd'"))):
        got = [tuple(r) for r in points_in_regions(m, n, "id", "area", "rings").collect()]
        ids, areas = {r[0] for r in m.collect()}, {r[0] for r in n.collect()}
        assert len(got) == len(set(got)) and set(got) == {(i, k) for i, k in want if i in ids and k in areas} and got


def test_cover_of_many_polygons_is_that_of_each():
    """Polygons of all sizes at once, cut into parts: the cells of each are those it has alone, and hold its area."""
    rng = random.Random(9)
    rows = []
    for k in range(40):
        y, x, w = rng.uniform(-60, 60), rng.uniform(-150, 150), 10 ** rng.uniform(-5, 1)
        rows.append([[{"latitude": y + w * math.sin(t) * rng.uniform(0.5, 1), "longitude": x + w * math.cos(t)} for t in np.linspace(0, 6, rng.choice([3, 5, 60]))] for _ in range(1 + k % 2)])
    ring = pa.list_(pa.list_(pa.struct([("latitude", pa.float64()), ("longitude", pa.float64())])))

    def cells(own):
        batch = pa.RecordBatch.from_arrays([pa.array([[k] for k, _ in own]), pa.array([r for _, r in own], ring), pa.array([3 + k % 9 for k, _ in own], pa.int32())], names=["_ids", "_rings", "_coarse"])
        return sorted((r["_ids"][0], r["_level"], r["_cell"], r["_inside"], r["_odd"], tuple(r["_edges"] or ())) for b in regions.covers(3)([batch]) for r in b.to_pylist())

    old = regions.EDGES_AT_ONCE
    try:
        regions.EDGES_AT_ONCE = 50
        whole = cells(list(enumerate(rows)))
    finally:
        regions.EDGES_AT_ONCE = old
    assert whole == cells(list(enumerate(rows))) == sorted(c for own in enumerate(rows) for c in cells([own]))
    assert len({c[:3] for c in whole}) == len(whole) and {c[0] for c in whole} == set(range(40)) and any(c[3] for c in whole)


def test_positions(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 5.0), (90.0, 180.0), (-90.1, 0.0), (None, 1.0)], "latitude double, longitude double")
    assert [r[0] for r in rows.select(geo.is_position("latitude", "longitude")).collect()] == [False, True, True, False, False]
    assert abs(rows.select(geo.haversine(F.lit(33.0), F.lit(-84.0), F.lit(34.0), F.lit(-84.0)).alias("d")).first()["d"] - miles(33, -84, 34, -84)) < 1e-9
