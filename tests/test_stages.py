import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ambitus.functions import polygons, projection
from ambitus.functions.geo import haversine
from ambitus.operators import diagnose, extract, filters, lists, overlay, places, requests, tiles
from ambitus.plans import stage_queries
from ambitus.sinks import files, kml as kml_sink
from ambitus.sources import exports, kml, service

SQUARE = "-84.39,33.75 -84.389,33.75 -84.389,33.751 -84.39,33.751 -84.39,33.75"


def document(*marks):
    return ('<kml xmlns="http://www.opengis.net/kml/2.2"><Document>' + "".join(marks) + "</Document></kml>").encode()


def polygon(name, ring, data=""):
    return f"<Placemark><name>{name}</name>{data}<Polygon><outerBoundaryIs><LinearRing><coordinates>{ring}</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"


def line(name, points, **data):
    body = "".join(f'<Data name="{k}"><value>{v}</value></Data>' for k, v in data.items())
    return f"<Placemark><name>{name}</name><ExtendedData>{body}</ExtendedData><LineString><coordinates>{points}</coordinates></LineString></Placemark>"


def extracted(spark, named, square_feet=1000.0, miles=1e-5, spacing=200.0):
    f = spark.createDataFrame([(n, bytearray(b)) for n, b in named], "source_file string, content binary")
    return extract.extract(kml.placemarks(f), square_feet, miles, spacing)


def test_parks_and_trails(spark):
    doc = document(polygon("Park", SQUARE), line("A multi-use", "-84.39,33.75 -84.3899,33.7501", Project_Type="Multi-Use Trail"), line("B", "-84.39,33.75 -84.38,33.76", Project_Type="On-Street Bicycle Facility"))
    e = extracted(spark, [("ways.kml", doc)])
    got = {r["name"]: r for r in e.collect()}
    assert set(got) == {"Park", "A multi-use"} and len(got["A multi-use"]["dense"]) == 2 and len(got["Park"]["dense"]) > 3
    records = extract.place_records(e).collect()
    assert {r["types"][1] for r in records if r["category"] == "park"} == {"polygon-densified-edge"} and len({r["placeId"] for r in records}) == len(records)
    corner = extract.place_records(e).where("category = 'park'").select(F.min(haversine(F.lit(33.75), F.lit(-84.39), "latitude", "longitude")).alias("d")).first()["d"]
    assert corner * 5280 < 60
    assert {r["geometryType"] for r in extract.geometry_features(e).collect()} == {"polygon", "linestring"}


def test_trail_inventory_and_classes(spark):
    far = "-84.39,33.75 -84.38,33.76"
    inventory = document(line("a", far, Project_Type="Multi-Use Trail"), line("b", far, Project_Type="Active Transportation"), line("c", far, Project_Type="Null"))
    classes = document(line("d", far, HC_Class="Off-Street", HC_Status="Existing"), line("e", far, HC_Class="On-Street"), line("f", far, HC_Class="Off-Street", HC_Status="Gone"))
    e = extracted(spark, [("Trail_Plan_Inventory.kml", inventory), ("roads.kml", classes)], miles=0.5)
    assert {r["name"] for r in e.collect()} == {"a", "d"}


def test_small_geometries_are_left_out(spark):
    flat = polygon("flat", "-84.39,33.75 -84.39,33.75 -84.39,33.75 -84.39,33.75")
    both = "<Placemark><name>both</name><MultiGeometry><Polygon><outerBoundaryIs><LinearRing><coordinates>-84.39,33.75 -84.38999,33.75 -84.38999,33.75001 -84.39,33.75</coordinates></LinearRing></outerBoundaryIs></Polygon><LineString><coordinates>-84.39,33.75 -84.30,33.80</coordinates></LineString></MultiGeometry></Placemark>"
    e = extracted(spark, [("paths.kml", document(flat, polygon("good", SQUARE), both, line("short trail", "-84.39,33.75 -84.3899,33.7501"), line("long trail", "-84.39,33.75 -84.382,33.755")))], miles=0.5)
    assert {r["name"] for r in e.collect()} == {"good", "long trail"}


def test_stations(spark):
    mark = '<Placemark><name>Decatur</name><ExtendedData><Data name="STATION"><value>D</value></Data></ExtendedData><Point><coordinates> -84.29,33.77</coordinates></Point></Placemark>'
    park = "<Placemark><name>x</name><MultiGeometry><Point><coordinates>-84.29,33.77</coordinates></Point><LineString><coordinates>-84.39,33.75 -84.30,33.80</coordinates></LineString></MultiGeometry></Placemark>"
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("doc.kml", document("<Folder>" + mark + "</Folder>"))
    e = extracted(spark, [("MARTA_Rail_Stations.kmz", z.getvalue()), ("city-park-paths.kml", document(park))])
    assert [(r["name"], r["category"], r["kind"]) for r in e.collect()] == [("Decatur", "transit", "point")]
    s = extract.feature_summary(e).first()
    assert (s["geometry_type"], s["n_points"], s["metadata"]) == ("point", 1, {"STATION": "D"})


def test_tables_and_broken_documents(spark, tmp_path):
    table = "<description><![CDATA[<table><tr><td>name</td><td>A &amp; B</td></tr></table>]]></description>"
    good = document(f'<Placemark>{table}<ExtendedData><Data name="NAME"><value>x</value></Data><Data name="k"><value>y</value></Data></ExtendedData><Point><coordinates>1,2</coordinates></Point></Placemark>')
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("other.kml", good)
    rows = [("a.kml", bytearray(good)), ("b.kml", bytearray(b"<kml><")), ("c.kml", bytearray(b"<html/>")), ("d.kmz", bytearray(z.getvalue())), ("e.kml", None)]
    df = spark.createDataFrame(rows, "source_file string, content binary")
    assert kml.placemarks(df, strict=False).first()["metadata"] == {"k": "y", "name": "A & B"}
    assert {r["source_file"] for r in kml.broken(df).collect()} == {"b.kml", "c.kml", "d.kmz"}
    with pytest.raises(Exception, match="broken XML|doc.kml|kml element"):
        kml.placemarks(df).collect()
    for n in ("park-outlines.old.kml", "z.kml", "a.kml"):
        (tmp_path / n).write_bytes(good)
    assert [r["source_file"] for r in kml.read_files(spark, str(tmp_path), r"^park-outlines\.").collect()] == ["a.kml"]


def test_config_and_assembly(spark):
    with pytest.raises(requests.InvalidRequest):
        requests.CategoryConfig.from_json('{"categoryRadiusMiles": {"Gym": 1, "gym ": 2}}')
    config = requests.CategoryConfig.from_json(json.dumps({"includedCategories": ["park"], "categoryGroups": [{"targetCategory": "park", "sourceCategories": ["park", "trail"]}]}))
    records = spark.createDataFrame([("park", "A", 1.0, 2.0), ("Trail", "B", 1.0, 3.0), ("gym", "C", 1.0, 4.0), ("park", "A", 1.0, 2.0)], "category string, name string, latitude double, longitude double")
    geometry = requests.record_features(records.where("name = 'B'"), config)
    got = requests.assemble([records, records], [geometry], config).collect()
    assert sorted((r["category"], r["label"]) for r in got) == [("park", "A"), ("park", "B")]


REQUEST = {"features": [], "radiusMiles": 0.2, "locations": [{"latitude": a, "longitude": b, "category": c, "label": n} for a, b, c, n in ((33.75, -84.39, "gym", "G & 1"), (33.7512, -84.3888, "Grocery", "S"), (33.7506, -84.3893, "transit", "T"))]}


def test_answer(spark):
    out = requests.answer(spark, json.dumps(REQUEST))
    back = kml.parse_document(out["kml"].encode())
    assert out["intersectionPolygonCount"] == 1 == out["coveredCellCount"] and out["featureCount"] == 3 and out["fileName"] == "outline.kml"
    assert [(r[0], r[1]) for r in back] == [("Intersection", "Intersection 1"), ("Source Features/Grocery", "S"), ("Source Features/gym", "G & 1"), ("Source Features/transit", "T")]
    ring = back[0][6][0][0]
    middle = {k: sum(c[k] for c in ring[:-1] or ring) / len(ring[:-1] or ring) for k in ring[0]}
    assert abs(middle["latitude"] - 33.7506) < 0.002 and out["bounds"]["north"] > 33.7512
    for bad in ("x", "[]", json.dumps({"features": []}), json.dumps(REQUEST | {"radiusMiles": 0}), json.dumps(REQUEST | {"step": -1, "paddingDegrees": -1}), json.dumps({"locations": [{"latitude": 91, "longitude": 0, "category": "a", "label": "b"}]})):
        with pytest.raises(requests.InvalidRequest):
            requests.answer(spark, bad)
    apart = json.loads(json.dumps(REQUEST))
    apart["locations"][0]["latitude"] = 34.5
    assert requests.answer(spark, json.dumps(apart))["intersectionPolygonCount"] == 0


def test_features_win_over_locations(spark):
    own = {"category": "park", "label": "P", "geometryType": "Polygon", "polygons": [{"outerRing": [{"latitude": 0, "longitude": 0}, {"latitude": 0, "longitude": 1}, {"latitude": 1, "longitude": 1}]}]}
    d = spark.createDataFrame([("a", json.dumps(REQUEST | {"features": [own]})), ("b", json.dumps(REQUEST)), ("c", "no json"), ("d", None)], "id string, t string")
    f = requests.request_features(requests.read_requests(d, "id", "t"), "id").collect()
    assert [(r["id"], r["geometryType"], len(r["polygons"])) for r in f if r["id"] == "a"] == [("a", "polygon", 1)] and len(f) == 4
    boxes = {r["id"]: (r["south"], r["east"]) for r in requests.bounds(requests.request_features(requests.read_requests(d, "id", "t"), "id"), "id").collect()}
    assert boxes["a"] == (0.0, 1.0)


def test_result_json(spark):
    f = spark.createDataFrame([("t", "gym", 0.2, [{"latitude": 33.75, "longitude": -84.39}])], "g string, category string, radius_miles double, points array<struct<latitude:double,longitude:double>>")
    areas = overlay.overlay_groups(f, "g", ["gym"])
    boxes = spark.createDataFrame([("t", 1.0, 2.0, 3.0, 4.0), ("u", 1.0, 2.0, 3.0, 4.0)], "group_key string, south double, north double, west double, east double")
    got = {r["group_key"]: json.loads(r["document"]) for r in requests.result_json(areas, boxes, spark.createDataFrame([("t", 1)], "group_key string, n_features long")).collect()}
    assert got["t"]["intersectionPolygonCount"] == 1 and got["u"]["polygons"] == [] and got["t"]["bounds"]["maxLongitude"] == 4.0 and len(got["t"]["polygons"][0]["outerRing"]) == 64


def test_buffer_of_a_polygon_with_a_hole_same_as_grid():
    outer = np.array([[0, 0], [1000, 0], [1000, 800], [500, 300], [0, 800]], float)
    hole = np.array([[200, 150], [400, 150], [400, 250], [200, 250]], float)
    for rings, r in (([outer, hole], 20.0), ([outer, hole], 120.0), ([outer[::-1], hole], 20.0), ([np.vstack([outer, outer[:1]])], 30.0)):
        pieces = polygons.area_pieces(rings, r)
        got = polygons.with_holes(polygons.overlay(pieces, np.zeros(len(pieces), int), 1))
        area = sum(polygons.signed_area(a) + sum(polygons.signed_area(h) for h in hs) for a, hs in got)
        xs = np.arange(-150, 1150, 10.0) + 5
        grid = np.stack(np.meshgrid(xs, xs), axis=-1).reshape(-1, 2)

        def near(p):
            best = np.full(len(p), np.inf)
            for q in rings:
                a, b = q, np.roll(q, -1, axis=0)
                for s, e in zip(a, b):
                    d = e - s
                    if not d.any():
                        continue
                    t = np.clip(((p - s) @ d) / (d @ d), 0, 1)
                    best = np.minimum(best, np.hypot(*(p - s - t[:, None] * d).T))
            odd = np.array([sum(polygons.inside_ring(q, x) for q in rings) % 2 for x in p], bool)
            return odd | (best <= r)

        want = near(grid).sum() * 100
        assert len(got) == 1 and len(got[0][1]) == (1 if len(rings) == 2 and r < 50 else 0) and abs(area - want) < 0.015 * want


def test_repaired_rings():
    bow = np.array([[0, 0], [100, 100], [100, 0], [0, 100]], float)
    made = polygons.repaired([bow])
    assert len(made) == 2 and all(not h for _, h in made) and abs(sum(polygons.signed_area(r) for r, _ in made) - 5000) < 1
    flat = np.array([[0, 0], [1, 1], [0, 0]], float)
    assert polygons.repaired([flat])[0][0] is flat


def test_overlay_of_polygons_and_lines(spark):
    c = lambda y, x: {"latitude": 33.75 + y, "longitude": -84.39 + x}
    park = [[c(0, 0), c(0, 0.02), c(0.02, 0.02), c(0.02, 0)], [c(0.008, 0.008), c(0.008, 0.012), c(0.012, 0.012), c(0.012, 0.008)]]
    rows = [("t", "park", 0.05, [], [], [park]), ("t", "trail", 2.0, [], [[c(0.01, -0.01), c(0.01, 0.03)]], []), ("t", "other", 1.0, [c(0, 0)], [], [])]
    df = spark.createDataFrame(rows, "g string, category string, radius_miles double, points array<struct<latitude:double,longitude:double>>, lines array<array<struct<latitude:double,longitude:double>>>, polygons array<array<array<struct<latitude:double,longitude:double>>>>")
    (r,) = overlay.overlay_groups(df, "g", ["park", "trail"]).collect()
    side = [projection.forward(np.array([33.77]), np.array([-84.39]), 33.76, -84.38), projection.forward(np.array([33.77]), np.array([-84.37]), 33.76, -84.38)]
    assert len(r["holes"]) == 1 and r["square_meters"] > 0.9 * float(side[1][0][0] - side[0][0][0]) * 2000


def test_tile_statuses(spark):
    b = (34.0, 33.7, -84.6, -84.1, 0.15, 0.25)
    rows = [(1, 33.95, -84.54, "gym", 1.0), (2, 33.949, -84.539, "grocery", 1.0), (3, 33.80, -84.20, "gym", 1.0), (4, 33.95, -84.2, "gym", 0.1), (5, 33.90, -84.2, "grocery", 0.1)]
    f = spark.createDataFrame(rows, "id int, latitude double, longitude double, category string, radius_miles double")
    grid = tiles.tiles(spark, *b)
    a = tiles.assign(f, grid, b[0], b[2], b[4], b[5], "id")
    pts = F.array(F.struct("latitude", "longitude"))
    areas = overlay.overlay_groups(a.join(f.select("id", "radius_miles", pts.alias("points")), "id").withColumnRenamed("category_key", "category"), "name", ["gym", "grocery"])
    s = tiles.statuses(grid, a, areas, ["gym", "grocery"])
    got = {(r["row"], r["col"]): (r["status"], r["boundary_count"], r["categories_present"]) for r in s.collect()}
    assert got[0, 0] == ("written", 1, ["grocery", "gym"]) and got[0, 1] == ("empty_outline", 0, ["grocery", "gym"]) and got[1, 1][0] == "missing_categories"
    assert {r["status"]: r["n"] for r in tiles.status_counts(s).collect()} == {"written": 1, "empty_outline": 1, "missing_categories": 2}
    docs = kml_sink.result_documents(areas, a.join(f, "id").select(F.col("name").alias("group_key"), "category", F.col("id").cast("string").alias("label"), pts.alias("points"), F.array().cast("array<array<struct<latitude:double,longitude:double>>>").alias("lines"), F.array().cast("array<array<array<struct<latitude:double,longitude:double>>>>").alias("polygons")))
    assert docs.where("group_key = 'tile_r00_c00'").first()["document"].count("<Placemark>") == 3


def test_list_config(spark):
    good = {"bounds": {"north": 34.0, "south": 33.9, "west": -84.4, "east": -84.3}, "tileLatitudeStep": 0.06, "tileLongitudeStep": 0.06, "groups": [{"name": "gyms", "searches": [{"query": "LA Fitness", "category": "gym", "expansion": {"enabled": True, "templates": ["{query} north", " "]}}]}]}
    c = lists.ListConfig.from_json(json.dumps(good), ["gyms"])
    assert c.fetches(spark).count() == 2 * 4
    for change, text in (({"groups": []}, "at least one group"), ({"groups": [{"name": "transit", "searches": [{}]}]}, "not supported"), ({"groups": [good["groups"][0] | {"mode": "direct"}]}, "tiled"), ({"bounds": {"north": 1, "south": 2, "west": 0, "east": 1}}, "bounds"), ({"tileLatitudeStep": 0}, "steps"), ({"groups": [{"name": "gyms", "searches": [{"query": "x", "category": " "}]}]}, "category")):
        with pytest.raises(requests.InvalidRequest, match=text):
            lists.ListConfig.from_json(json.dumps(good | change), ["gyms"])


def test_judged_lists(spark):
    rows = [("LA Fitness", "gym", "BACH Fitness", ["gym"]), ("LA Fitness", "gym", "LA Fitness Buckhead", ["GYM"]), ("Publix", "grocery", "Buckhead Butcher Shop", ["store"]), ("YMCA", "gym", "YMCA of X", ["school"]), ("Other", "gym", "Anything", ["gym"]), (None, None, None, None)]
    r = spark.createDataFrame(rows, "query string, category string, name string, types array<string>").withColumns({"formattedAddress": F.lit(None).cast("string"), "sourceQueryType": F.lit("base"), "placeId": F.col("name"), "latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    aliases = spark.createDataFrame([("la fitness", "LA Fitness"), ("Publix", "Publix"), ("YMCA", "YMCA")], "query string, alias string")
    j = lists.judge(r, aliases, spark.createDataFrame([("juice",)], "keyword string"), spark.createDataFrame([("gym", "gym"), ("grocery", "store")], "category string, type string"))
    got = {x["name"]: x["reason"] for x in j.collect()}
    assert got == {"BACH Fitness": "missing_required_brand_tokens", "LA Fitness Buckhead": None, "Buckhead Butcher Shop": "missing_required_brand_tokens", "YMCA of X": "type_mismatch", "Anything": None, None: None}
    assert lists.rejected(j).count() == 3
    audit = {x["group_name"]: x for x in lists.full_audit(j, lists.master_list(j, [F.col("name")])).collect()}
    assert (audit["gym"]["raw_count"], audit["gym"]["kept_count"], audit["gym"]["final_count"]) == (4, 2, 1)


def test_support_entities(spark):
    r = spark.createDataFrame([("a", "Shop", "q", 33.75, -84.39), ("b", "Shop Pharmacy", "q", 33.7501, -84.39), ("c", "Shop Pharmacy", "q", 34.5, -84.39)], "id string, name string, query string, latitude double, longitude double")
    support = lists.first_word_in(lists.plain_text(F.col("name")), ["pharmacy", "bakery"]).isNotNull()
    parents = places.nearest_parent(r, r.where(~support), "id", "query")
    kept, removed = lists.without_support(r, support, parents, "id")
    assert {x["id"] for x in kept.collect()} == {"a", "c"} and [(x["id"], x["parent_id"]) for x in removed.collect()] == [("b", "a")]


def test_nearest_of_each_category_same_as_brute_force(spark):
    rng = np.random.default_rng(2)
    f = [(f"p{i}", ["a", "b", "Rare", None][0 if i % 50 else 2 if i % 100 else 3] if i % 2 else "b", float(la), float(lo)) for i, (la, lo) in enumerate(np.vstack([rng.uniform(-1, 1, (300, 2)), rng.uniform(40, 41, (60, 2)), [[89.9, 10.0], [89.9, -170.0]]]))]
    p = [(i, float(la), float(lo)) for i, (la, lo) in enumerate(np.vstack([rng.uniform(-1, 1, (12, 2)), rng.uniform(-80, 80, (6, 2)), [[89.95, 0.0], [0.0, 0.0]]]))]
    features = spark.createDataFrame([*f, ("x", "a", None, 1.0)], "label string, category string, latitude double, longitude double")
    probes = spark.createDataFrame([*p, (99, None, 1.0)], "probe_id int, latitude double, longitude double")
    got = {}
    for r in diagnose.nearest_per_category(features, probes, 3).collect():
        got.setdefault((r["probe_id"], r["category_key"]), []).append((r["rank"], r["label"]))
    for i, la, lo in p:
        for c in {x[1] for x in f}:
            own = sorted((float(np.hypot((lo - x[3]) * np.cos(np.radians(la)) * 69, (la - x[2]) * 69)), x[0]) for x in f if x[1] == c)[:3]
            assert [n for _, n in sorted(got[i, c.strip().lower() if c else None])] == [n for _, n in own]
    assert diagnose.nearest_per_category(features.limit(0), probes, 3).collect() == []
    with pytest.raises(ValueError, match="missing within radius"):
        diagnose.assert_reached(diagnose.nearest_per_category(features, probes, 1), 0.001)


def test_aggregates_and_files(spark, tmp_path):
    row = [None, [0, 0, "Title", 0, "Addr", [None, None, 1.5, -2.5], ["7", "8"], ""], "t"]
    docs = spark.createDataFrame([("a", ")]}'" + json.dumps([[0] * 8 + [[row, [1], None, row[:1] + [row[1][:5]]]]])), ("b", "no"), ("c", None)], "doc string, t string")
    assert [tuple(r) for r in exports.aggregate_rows(docs, "t").collect()] == [("a", 0, "Title", "Addr", "7:8", 1.5, -2.5)]
    (tmp_path / "Café  Größe 1.json").write_text("{}")
    assert exports.find_file(str(tmp_path), "cafe größe 1").endswith("1.json")
    with pytest.raises(FileNotFoundError):
        exports.find_file(str(tmp_path), "other")
    (tmp_path / "t.jsonl").write_text('{"implementationType":"X","methodName":"Run","outcome":"ok","durationMs":1.5}\n')
    s = exports.trace_summary(exports.read_traces(spark, str(tmp_path / "t.jsonl")), spark.createDataFrame([("X", "x.cs")], "type string, source_file string"))
    assert s.first()["hits"] == 1 and exports.touched_files(s).first()[0] == "x.cs"
    (tmp_path / "s.csv").write_text("brand,location_name,address,city,state,zip,status,source_file\nB,L,1 A St,T,RG,01234,open,f.png\n")
    assert exports.read_screenshots(spark, str(tmp_path / "s.csv")).first()["zip"] == "01234"
    (tmp_path / "r.json").write_text('{"sources":[{"brand":"B"}]}')
    assert exports.read_registry(spark, str(tmp_path / "r.json")).first()["brand"] == "B"


def test_file_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "A B", 1.5)], "brand string, place_name string, lat double")
    files.write_json_lines(df, str(tmp_path / "out"), "brand")
    assert spark.read.json(str(tmp_path / "out")).first().asDict() == {"placeName": "A B", "lat": 1.5, "brand": "b"}
    written = files.write_named(spark.createDataFrame([("a.kml", "<x/>"), ("../b.kml", None)], "n string, t string"), "n", "t", str(tmp_path / "named")).collect()
    assert {r["name"]: r["bytes"] for r in written} == {"a.kml": 4, "../b.kml": 0} and sorted(p.name for p in (tmp_path / "named").iterdir()) == ["a.kml", "b.kml"]
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("doc.kml", "old")
        f.writestr("x.png", b"1")
    with zipfile.ZipFile(io.BytesIO(files.rewrite_kmz(z.getvalue(), lambda t: t.replace("old", "new")))) as f:
        assert f.read("doc.kml") == b"new" and f.read("x.png") == b"1"
    with pytest.raises(ValueError):
        z2 = io.BytesIO()
        zipfile.ZipFile(z2, "w").close()
        files.rewrite_kmz(z2.getvalue(), str)
    folder, name = files.routed(F.col("n"), {"Old.kml": ("parks", "new.kml")})
    assert [tuple(r) for r in spark.createDataFrame([("old.KML",), ("z",)], "n string").select(folder, name).collect()] == [("parks", "new.kml"), ("other", "z")]


def test_folder_filters(spark):
    df = spark.createDataFrame([("f", "A/BIKEWAYS", "x"), ("f", "A/other", "y"), ("f", "", "z")], "source_file string, folder string, name string")
    kept, removed = filters.partition(df, filters.in_folders(F.col("folder"), ["Bikeways"]))
    assert [r["name"] for r in kept.collect()] == ["x"] and removed.count() == 2
    folders = spark.createDataFrame([("f", "A"), ("f", "A/BIKEWAYS"), ("f", "A/other"), ("f", "B")], "source_file string, folder string")
    assert {r["folder"] for r in filters.drop_empty_folders(kept, folders).collect()} == {"A", "A/BIKEWAYS"}
    p = spark.createDataFrame([([{"latitude": 1.0, "longitude": 1.0}], [], []), ([{"latitude": 5.0, "longitude": 1.0}], [], [])], "points array<struct<latitude:double,longitude:double>>, lines array<array<struct<latitude:double,longitude:double>>>, polygons array<array<array<struct<latitude:double,longitude:double>>>>")
    assert [r[0] for r in p.select(filters.touches(F.col("points"), F.col("lines"), F.col("polygons"), 0, 2, 0, 2)).collect()] == [True, False]


def test_places_service(spark, tmp_path):
    answer = {"places": [{"id": "1", "displayName": {"text": "N"}, "location": {"latitude": 1.0, "longitude": 2.0}, "types": ["gym"]}, {"id": "2"}]}
    (tmp_path / "LA Fitness.json").write_text(json.dumps(answer))
    config = lists.ListConfig.from_json(json.dumps({"bounds": {"north": 34.0, "south": 33.9, "west": -84.4, "east": -84.3}, "tileLatitudeStep": 0.1, "tileLongitudeStep": 0.1, "groups": [{"name": "g", "searches": [{"query": "LA Fitness", "category": "gym"}]}]}))
    got = service.read_service(spark, config.fetches(spark), folder=str(tmp_path)).collect()
    assert {(r["placeId"], r["name"], r["formattedAddress"], r["sourceQueryType"]) for r in got} == {("1", "N", "", "base")}
    tries = iter([(503, ""), (503, ""), (200, json.dumps(answer))])
    search = {"search": "s", "query": "q", "category": "c", "north": 1, "south": 0, "west": 0, "east": 1}
    waited: list[float] = []
    assert len(list(service.places_of(service.ask(lambda _: next(tries), search, sleep=waited.append), search))) == 1 and waited == [2.0, 5.0]
    for status in (503, 404):
        with pytest.raises(OSError):
            service.ask(lambda _, s=status: (s, ""), search, sleep=lambda _: None)


def test_tiles_of_boxes_are_not_broadcast(spark, monkeypatch):
    """They are many times the bytes of the boxes that Spark goes by: the grid is broadcast if it is small, else neither side."""
    boxes = stage_queries.QUERIES["tile_boxes"]
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    small = boxes(spark, "/root/testdata/sf0.01")
    assert "BuildRight" in plan(small) and "BuildLeft" not in plan(small)
    monkeypatch.setattr(tiles, "TILES_TO_BROADCAST", 19)  # the grid has 20
    large = boxes(spark, "/root/testdata/sf0.01")
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) and small.count()
