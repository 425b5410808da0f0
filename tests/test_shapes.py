import numpy as np
from pyspark.sql import functions as F

from ambitus.functions import polygons, projection
from ambitus.functions import shapes as G
from ambitus.operators.overlay import overlay_groups
from ambitus.operators.tiles import tile_rows
from ambitus.plans import map_queries, place_queries
from ambitus.sinks import kml as kml_sink
from ambitus.sources import kml as kml_source


def test_projection_round_trip():
    rng = np.random.default_rng(1)
    lat, lon = 33.8 + rng.uniform(-0.5, 0.5, 200), -84.3 + rng.uniform(-0.5, 0.5, 200)
    x, y = projection.forward(lat, lon, 33.8, -84.3)
    la, lo = projection.inverse(x, y, 33.8, -84.3)
    assert np.abs(la - lat).max() < 1e-9 and np.abs(lo - lon).max() < 1e-9
    assert abs(projection.forward(np.array([34.8]), np.array([-84.3]), 33.8, -84.3)[1][0] - 110_919) < 60  # a degree of latitude there


def test_overlay_area_same_as_grid():
    rng = np.random.default_rng(3)
    pieces = [polygons.disc(*rng.uniform(-600, 600, 2), 500) for _ in range(9)] + [polygons.capsule(rng.uniform(-600, 600, 2), rng.uniform(-600, 600, 2), 300) for _ in range(5)]
    category = np.array([i % 2 for i in range(9)] + [1] * 5)
    rings = polygons.overlay(pieces, category, 2)
    area = sum(polygons.signed_area(r) for r in rings)
    xs = np.arange(-1400, 1400, 7.0) + 3.5
    grid = np.stack(np.meshgrid(xs, xs), axis=-1).reshape(-1, 2)
    hit = polygons._inside(grid, pieces)
    both = hit[:, category == 0].any(axis=1) & hit[:, category == 1].any(axis=1)
    assert rings and abs(area - both.sum() * 49) / area < 0.01


def test_overlay_without_overlap():
    far = [polygons.disc(0, 0, 10), polygons.disc(1000, 0, 10)]
    assert polygons.overlay(far, np.array([0, 1]), 2) == [] and polygons.overlay(far, np.array([0, 0]), 2) == []


def test_overlay_groups(spark):
    rows = [("t", "Gym", 0.2, [(33.75, -84.39)]), ("t", "grocery", 0.2, [(33.7512, -84.3888)]), ("u", "gym", 0.2, [(33.75, -84.39)])]
    df = spark.createDataFrame([(a, b, c, [{"latitude": y, "longitude": x} for y, x in p]) for a, b, c, p in rows], "g string, category string, radius_miles double, points array<struct<latitude:double,longitude:double>>")
    out = overlay_groups(df, "g", ["gym", "grocery"]).collect()
    assert [r["group_key"] for r in out] == ["t"] and 0 < out[0]["square_meters"] < 3.1416 * (0.2 * 1609.344) ** 2


def test_overlay_holes(spark):
    """A ring of places around an open middle, with an island in the middle that is itself a ring."""
    place = lambda c, r, y, x: ("t", c, r, [{"latitude": 33.75 + y, "longitude": -84.39 + x}])
    around = lambda n, d, r: [place(c, r, d * np.cos(t), d * np.sin(t) / np.cos(np.radians(33.75))) for t in np.arange(n) * 2 * np.pi / n for c in ("gym", "grocery")]
    rows = around(24, 0.03, 0.4) + around(12, 0.01, 0.25)
    df = spark.createDataFrame([(a, b, float(c), [{k: float(v) for k, v in p.items()} for p in d]) for a, b, c, d in rows], "g string, category string, radius_miles double, points array<struct<latitude:double,longitude:double>>")
    found = overlay_groups(df, "g", ["gym", "grocery"])
    out = sorted(found.collect(), key=lambda r: r["polygon_no"])
    assert [len(r["holes"]) for r in out] == [1, 1]

    def square_meters(ring):
        x, y = projection.forward(np.array([c["latitude"] for c in ring]), np.array([c["longitude"] for c in ring]), 33.75, -84.39)
        return abs(polygons.signed_area(np.stack([x, y], axis=1)))

    for r in out:
        assert abs(square_meters(r["outer"]) - sum(square_meters(h) for h in r["holes"]) - r["square_meters"]) < 1e-3 * r["square_meters"]
    features = found.select(F.col("polygon_no").cast("string").alias("name"), F.lit("area").alias("category"), F.col("outer").alias("points"), F.lit("polygon").alias("kind"), "holes")
    docs = kml_sink.documents(features, "name", 100, 2)
    back = kml_source.placemarks(docs.select("source_file", F.col("document").cast("binary").alias("content"))).collect()
    assert {(r["name"], len(r["polygons"][0]), len(r["polygons"][0][1])) for r in back} == {(str(r["polygon_no"]), 2, len(r["holes"][0])) for r in out}


def test_overlay_leaves_no_edge_out():
    rng = np.random.default_rng(6)
    pieces = [polygons.disc(*rng.uniform(-900, 900, 2), rng.uniform(100, 700)) for _ in range(40)] + [polygons.capsule(rng.uniform(-900, 900, 2), rng.uniform(-900, 900, 2), 150) for _ in range(6)]
    pieces += pieces[:3]  # the same place twice
    category = np.arange(len(pieces)) % 3
    rings = polygons.overlay(pieces, category, 3)
    xs = np.arange(-1700, 1700, 8.0) + 4
    grid = np.stack(np.meshgrid(xs, xs), axis=-1).reshape(-1, 2)
    hit = polygons._inside(grid, pieces)
    held = np.all([hit[:, category == g].any(axis=1) for g in range(3)], axis=0)
    assert abs(sum(polygons.signed_area(r) for r in rings) - held.sum() * 64) < 0.005 * held.sum() * 64
    assert sum(len(e[0]) for e in polygons._outer_edges(pieces, category, np.array([[*p.min(axis=0), *p.max(axis=0)] for p in pieces]))) < sum(map(len, pieces)) / 2


def test_overlay_tiles_same_as_samples(spark):
    """The query's areas: all categories, each with its own radius, against sample points by great-circle distance."""
    sf, need = "/root/testdata/sf0.01", ["building", "automobile", "machinery", "household", "furniture"]
    got = {r["group_key"]: r["square_meters"] for r in map_queries.overlay_tiles(spark, sf).collect()}
    p = place_queries._places(spark, sf).toPandas()
    p["r"] = p["category"].map(place_queries.RADII).fillna(place_queries.DEFAULT_RADIUS)
    tiles = tile_rows(*place_queries.GRID)
    assert set(got) == {t[0] for t in tiles}
    for name, _, _, n, s, w, e in tiles[::4]:
        pad = p["r"] / 69.0
        own = p[(p["latitude"] + pad >= s) & (p["latitude"] - pad <= n) & (p["longitude"] + pad >= w) & (p["longitude"] - pad <= e)]
        step = 0.0006
        la, lo = (x.ravel() for x in np.meshgrid(np.arange(s - 0.04, n + 0.04, step), np.arange(w - 0.05, e + 0.05, step)))
        held = np.ones(len(la), bool)
        for c in need:
            q = own[own["category"] == c]
            a, b = np.radians(q["latitude"].to_numpy()), np.radians(q["longitude"].to_numpy())
            h = np.sin((np.radians(la)[:, None] - a) / 2) ** 2 + np.cos(np.radians(la))[:, None] * np.cos(a) * np.sin((np.radians(lo)[:, None] - b) / 2) ** 2
            held &= (2 * 3958.7613 * np.arcsin(np.sqrt(h)) <= q["r"].to_numpy()).any(axis=1)
        want = (held * np.cos(np.radians(la))).sum() * (np.radians(step) * 6371008.8) ** 2
        assert abs(got[name] - want) < 0.02 * want


def test_lines_and_rings(spark):
    line = F.array(*[G.coord(F.lit(y), F.lit(x)) for y, x in [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]])
    one = spark.range(1)
    r = one.select(
        G.point_in_ring(line, F.lit(0.2), F.lit(0.9)).alias("inside"), G.point_in_ring(line, F.lit(0.9), F.lit(0.2)).alias("outside"),
        F.size(G.densify(line, 100_000.0)).alias("dense"), F.size(G.distinct_points(F.concat(line, line))).alias("distinct"),
        G.line_distance(F.slice(line, 1, 0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("empty"), G.ring_area(F.slice(line, 1, 2)).alias("flat"),
    ).first()
    assert r["inside"] and not r["outside"] and r["dense"] == 7 and r["distinct"] == 3 and r["empty"] == float("inf") and r["flat"] == 0
