"""Queries of the place and geometry operators over the test tables, with their SQL.

The star-schema tables have no coordinates: places (from customer) and probes (from supplier) get them by arithmetic on their
keys, with the same text in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions import shapes as G
from ambitus.functions import text as X
from ambitus.functions.geo import EARTH_RADIUS_FEET, FEET_PER_DEGREE, is_position
from ambitus.operators import coverage, dedupe, diagnose, near, places, tiles
from ambitus.session import read

S, W, N, E, STEP = 33.70, -84.55, 33.95, -84.10, 0.005
GRID = (N, S, W, E, 0.07, 0.09)
RADII = {"building": 1.0, "automobile": 0.8, "machinery": 1.2}
DEFAULT_RADIUS = 0.9
KEYWORDS = ["nutrition", "& spa", "climbing"]
ALLOWED = ["gym", "fitness_center"]
_D = "CAST({} AS DOUBLE)".format


def _xy(key: str, a: int, b: int) -> str:
    return f"{_D('33.70')} + CAST(({key} * {a}) % 2500 AS DOUBLE) / {_D('10000')} AS latitude, {_D('-84.55')} + CAST(({key} * {b}) % 4500 AS DOUBLE) / {_D('10000')} AS longitude"


PLACES = f"SELECT c_custkey AS place_id, lower(c_mktsegment) AS category, c_name AS label, c_nationkey, {_xy('c_custkey', 7919, 104729)} FROM customer"
PROBES = f"SELECT s_suppkey AS probe_id, {_xy('s_suppkey', 7907, 104723)} FROM supplier"


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    table = sql.rsplit("FROM ", 1)[1].strip()
    return read(spark, sf_dir, table).selectExpr(*_columns(sql))


def _columns(sql: str) -> list[str]:
    body, out, depth, start = sql[len("SELECT ") : sql.rindex(" FROM ")], [], 0, 0
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


def _places(spark, d):
    return _view(spark, d, PLACES)


def _placed(spark, d, times: float = 1.0):
    r = spark.createDataFrame([(c, x * times) for c, x in RADII.items()], "category string, radius_miles double")
    return places.with_radius(_places(spark, d), r, DEFAULT_RADIUS * times)


def _cells(spark, d, times: float = 1.0):
    return coverage.coverage_cells(_placed(spark, d, times), S, W, N, E, STEP)


def coverage_cells(spark, d):
    return _cells(spark, d)


def flagship(spark, d):
    """The covered cells where every place reaches three times as far: there are some on the smallest tables as well."""
    return _cells(spark, d, 3.0)


def coverage_runs(spark, d):
    return coverage.row_runs(_cells(spark, d))


def coverage_rects(spark, d):
    return coverage.rectangles(coverage.row_runs(_cells(spark, d)))


def _nearest(spark, d):
    return diagnose.nearest_per_category(_places(spark, d), _view(spark, d, PROBES), 3)


def knn_per_category(spark, d):
    return _nearest(spark, d).select("probe_id", "category_key", "rank", "label", F.round("distance_miles", 6).alias("distance_miles"))


def missing_categories(spark, d):
    return diagnose.reach(_nearest(spark, d), 1.0).where(~F.col("has_match")).select("probe_id", "category_key")


def diagnose_report(spark, d):
    return diagnose.report_lines(diagnose.nested(_nearest(spark, d), 1.0), _view(spark, d, PROBES), 1.0)


def _assigned(spark, d):
    grid = tiles.tiles(spark, *GRID)
    return grid, tiles.assign(_placed(spark, d), grid, N, W, GRID[4], GRID[5], "place_id")


def tile_assign(spark, d):
    return _assigned(spark, d)[1]


def tile_status(spark, d):
    grid, a = _assigned(spark, d)
    return tiles.completeness(grid, a, ["building", "automobile", "machinery", "household", "furniture"])


def tile_counts(spark, d):
    return tile_status(spark, d).agg(F.count_if("complete").alias("complete"), F.count_if(~F.col("complete")).alias("incomplete"))


def tile_grid(spark, d):
    return tiles.tiles(spark, *GRID)


def category_map(spark, d):
    g = spark.createDataFrame([("park", "green"), ("Trail", "green"), ("transit", "transit")], "source string, target string")
    return places.map_categories(read(spark, d, "locations"), g, ["green", "transit"]).groupBy("category_key", "grouped_from").agg(F.count("*").alias("n"))


def radius_lookup(spark, d):
    return places.with_radius(read(spark, d, "locations"), read(spark, d, "category_radii"), 0.5).groupBy("category", "radius_miles").agg(F.count("*").alias("n"))




def dedupe_locations(spark, d):
    k = [F.lower(F.coalesce("category", F.lit(""))), F.lower(F.coalesce("label", F.lit(""))), F.col("latitude"), F.col("longitude")]
    return dedupe.first_wins(read(spark, d, "locations"), k, [F.col("location_id")]).select("location_id", "category", "label")


def dedupe_two_stage(spark, d):
    g = read(spark, d, "gyms_master").select("record_id", "category", "placeId", "latitude", "longitude").distinct()
    return dedupe.two_stage(g, "category", "placeId", "latitude", "longitude", [F.col("record_id")]).select("record_id")


def grid_thin(spark, d):
    loc = read(spark, d, "locations").where(is_position("latitude", "longitude"))
    return dedupe.thin(loc, F.col("longitude"), F.col("latitude"), 0.01, [F.col("location_id")]).select("location_id")


def name_normalize(spark, d):
    g = read(spark, d, "gyms_master").select("record_id", "query", "category", "placeId", "name", "formattedAddress", "sourceQueryType").distinct()
    return places.normalize_names(g, [F.col("record_id")]).select("record_id", "normalized_name")


def _judged(spark, d):
    g = read(spark, d, "official_brand_records").select("record_id", "brand", "category", "name", "formattedAddress", "types").distinct()
    return g.withColumn("reason", places.reject_reason(F.col("name"), F.col("formattedAddress"), F.col("types"), F.array(F.col("brand")), KEYWORDS, ALLOWED))


def brand_filter(spark, d):
    return _judged(spark, d).select("record_id", "reason")


def audit_counts(spark, d):
    return places.audit(_judged(spark, d), "brand")


def search_expansion(spark, d):
    b = read(spark, d, "brand_list").withColumn("templates", F.array(F.lit("near {QUERY} center"), F.lit(" "), F.lit("north")))
    return places.expand_searches(b, "brand", "templates").select("brand_id", "search", "ord")


def tiles_x_searches(spark, d):
    return search_expansion(spark, d).crossJoin(F.broadcast(tiles.tiles(spark, *GRID).select("name"))).groupBy("name").agg(F.count("*").alias("n_searches"))  # a fixed grid


def _trails(spark, d):
    o = read(spark, d, "orders").selectExpr("o_custkey", "o_orderdate", "o_orderkey", *[c for c in _columns(f"SELECT {_xy('o_orderkey', 31, 47)} FROM orders")])
    pts = F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", F.struct("latitude", "longitude").alias("c"))))
    return o.groupBy("o_custkey").agg(F.transform(pts, lambda p: p["c"]).alias("points"))


def trail_length(spark, d):
    return _trails(spark, d).select("o_custkey", F.size("points").alias("n_points"), F.round(G.line_length(F.col("points")), 3).alias("feet"))


def trail_keep(spark, d):
    return _trails(spark, d).where(G.line_length(F.col("points")) >= 150.0 * 5280).select("o_custkey")


def densify_lines(spark, d):
    return _trails(spark, d).select("o_custkey", F.size(G.densify(F.col("points"), 2000.0)).alias("n_points"))


def _parks(spark, d):
    p = read(spark, d, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) / 20000 AS h", *_columns(f"SELECT {_xy('p_partkey', 7901, 104717)} FROM part"))
    at = lambda a, b: G.coord(F.col("latitude") + a * F.col("h"), F.col("longitude") + b * F.col("h") * 3)
    return p.withColumn("rings", F.array(F.array(at(-1, -1), at(-1, 1), at(1, 1), at(1, -1), at(-1, -1))))


def park_area(spark, d):
    p = _parks(spark, d).select("p_partkey", G.polygon_area(F.col("rings")).alias("a"), G.perimeter(F.col("rings")).alias("p"))
    length, width = G.rectangle_sides(F.col("a"), F.col("p"))
    return p.select("p_partkey", F.round("a", 2).alias("square_feet"), F.round("p", 3).alias("perimeter_feet"), F.round(F.try_divide(length, F.round(width, 6)), 3).alias("aspect"))


def point_in_parks(spark, d):
    """Parks that contain the place of the same key, and how far the others are from it."""
    pl = _places(spark, d).select(F.col("place_id").alias("p_partkey"), F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    j = _parks(spark, d).join(pl, "p_partkey")
    lat0, lon0 = F.lit(33.8), F.lit(-84.3)
    dist = G.polygon_distance(F.col("rings"), F.col("la"), F.col("lo"), lat0, lon0)
    return j.select("p_partkey", G.point_in_polygon(F.col("rings"), F.col("la"), F.col("lo")).alias("inside"), F.round(dist, 2).alias("feet"))


def places_in_parks(spark, d):
    """Every place with every park that contains it."""
    return near.points_in_regions(_places(spark, d), _parks(spark, d), "place_id", "p_partkey", "rings")


def bbox_frame(spark, d):
    return _places(spark, d).groupBy("category").agg(F.min("latitude").alias("south"), F.max("latitude").alias("north"), F.min("longitude").alias("west"), F.max("longitude").alias("east"), F.round((F.min("latitude") + F.max("latitude")) / 2, 9).alias("lat0"), F.round((F.min("longitude") + F.max("longitude")) / 2, 9).alias("lon0"))


def segment_distances(spark, d):
    """Distance of every probe from the segment between its own place and the next."""
    p = _view(spark, d, PROBES)
    a = _places(spark, d).select(F.col("place_id").alias("probe_id"), F.col("latitude").alias("alat"), F.col("longitude").alias("alon"))
    b = _places(spark, d).select((F.col("place_id") - 1).alias("probe_id"), F.col("latitude").alias("blat"), F.col("longitude").alias("blon"))
    j = p.join(a, "probe_id").join(b, "probe_id")
    line = F.array(G.coord(F.col("alat"), F.col("alon")), G.coord(F.col("blat"), F.col("blon")))
    return j.select("probe_id", F.round(G.line_distance(line, F.col("latitude"), F.col("longitude"), F.lit(33.8), F.lit(-84.3)), 3).alias("feet"))


def place_hash(spark, d):
    return read(spark, d, "locations").select("location_id", "label", "category").distinct().select("location_id", X.place_hash(F.coalesce("label", F.lit("")), F.col("location_id").cast("string"), F.lit("point")).alias("hash"))


def street_keys(spark, d):
    return read(spark, d, "official_brand_records").select("record_id", "formattedAddress").distinct().select("record_id", X.street_key(F.col("formattedAddress"), "Norvale").alias("street_key"))


def address_join(spark, d):
    left = read(spark, d, "official_brand_records").select("record_id", "formattedAddress").distinct()
    right = read(spark, d, "gyms_master").select(F.col("record_id").alias("master_id"), F.col("formattedAddress").alias("master_address")).distinct()
    return places.join_on_address(left, right, "formattedAddress", "master_address", [F.col("master_id")], ["master_id"]).select("record_id", "matched_master_id", "resolution")


def nearest_parent(spark, d):
    g = read(spark, d, "locations").where(is_position("latitude", "longitude")).select("location_id", "category", "latitude", "longitude").dropDuplicates(["location_id"])
    kids, parents = g.where(F.pmod("location_id", F.lit(2)) == 1), g.where(F.pmod("location_id", F.lit(2)) == 0)
    return places.nearest_parent(kids, parents, "location_id", "category", 0.25).withColumn("distance_miles", F.round("distance_miles", 6))


def nearest_parent_all(spark, d):
    """The nearest other location of the same category within 0.5 miles: every location is a child and a parent."""
    g = read(spark, d, "locations").where(is_position("latitude", "longitude")).select("location_id", "category", "latitude", "longitude").dropDuplicates(["location_id"])
    return places.nearest_parent(g, g, "location_id", "category").withColumn("distance_miles", F.round("distance_miles", 6))


def table_cells(spark, d):
    """Cells read back from an HTML table made of each brand."""
    html = F.concat(F.lit("<table><TR> <td>Name</td><td> "), "brand", F.lit(" </td></TR>\n<tr><td>Kind</td>\n<td>"), "category", F.lit("</td></tr></table>"))
    return read(spark, d, "brand_list").select("brand_id", F.explode(X.table_cells(html)).alias("c")).select("brand_id", "c.key", "c.value")


def distinct_types(spark, d):
    g = read(spark, d, "gyms_master").select("record_id", "types").distinct().withColumn("types", F.concat(F.coalesce("types", F.array().cast("array<string>")), F.array(F.lit("GYM"), F.lit(""))))
    return g.select("record_id", F.array_join(X.distinct_ignoring_case(F.col("types")), ",").alias("types"))


QUERIES = {f.__name__: f for f in (
    coverage_cells, coverage_runs, coverage_rects, knn_per_category, missing_categories, diagnose_report, tile_assign, tile_status, tile_counts, tile_grid,
    category_map, radius_lookup, dedupe_locations, dedupe_two_stage, grid_thin, name_normalize, brand_filter, audit_counts, search_expansion, tiles_x_searches,
    trail_length, trail_keep, densify_lines, park_area, point_in_parks, places_in_parks, bbox_frame, segment_distances, place_hash, street_keys, address_join, nearest_parent, nearest_parent_all,
    table_cells, distinct_types,
)}

_RADIUS = "CASE category " + " ".join(f"WHEN '{c}' THEN {r}" for c, r in RADII.items()) + f" ELSE {DEFAULT_RADIUS} END"
_PL = f"pl AS ({PLACES}), pr AS (SELECT *, CAST({_RADIUS} AS DOUBLE) r FROM pl)"
_FX = f"({FEET_PER_DEGREE} * cos(radians({(S + N) / 2!r})))"
_CELLS = f"""{_PL}, g AS (SELECT i AS "row", j AS col, {S} + (i + 0.5) * {STEP} la, {W} + (j + 0.5) * {STEP} lo FROM range({round((N - S) / STEP)}) a(i), range({round((E - W) / STEP)}) b(j)),
cells AS (SELECT CAST("row" AS INT) "row", CAST(col AS INT) col FROM g JOIN pr ON abs(la - latitude) <= r / 60.0
 AND sqrt(pow((la - latitude) * {FEET_PER_DEGREE}, 2) + pow((lo - longitude) * {_FX}, 2)) <= r * 5280 GROUP BY ALL HAVING count(DISTINCT category) = (SELECT count(DISTINCT category) FROM pl))"""
_RUNS = _CELLS + """, runs AS (SELECT "row", min(col) start_col, max(col) end_col FROM (SELECT *, col - row_number() OVER (PARTITION BY "row" ORDER BY col) i FROM cells) GROUP BY "row", i)"""
_DIST = "sqrt(pow((p.longitude - pl.longitude) * cos(radians(p.latitude)) * 69.0, 2) + pow((p.latitude - pl.latitude) * 69.0, 2))"
_KNN = f"""WITH pl AS ({PLACES}), p AS ({PROBES}), x AS (SELECT probe_id, category AS category_key, label, {_DIST} dist, pl.latitude la, pl.longitude lo FROM p, pl),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY probe_id, category_key ORDER BY dist, lower(label), label, la, lo) AS INT) AS "rank" FROM x)"""
_TILES = "t AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', {r}, {c}, {_D(repr(a))}, {_D(repr(b))}, {_D(repr(x))}, {_D(repr(y))})" for n, r, c, a, b, x, y in tiles.tile_rows(*GRID)) + """) v(name, "row", col, north, south, west, east))"""
_ASSIGN = f"""WITH {_PL}, {_TILES}, a AS (SELECT t.name, t."row", t.col, place_id, category AS category_key FROM t JOIN pr ON latitude + r / 69.0 >= south AND latitude - r / 69.0 <= north AND longitude + r / 69.0 >= west AND longitude - r / 69.0 <= east)"""
_STATUS = _ASSIGN + """, s AS (SELECT t.name, CAST(t."row" AS INT) "row", CAST(t.col AS INT) col, count(place_id) AS point_count, CAST(count(DISTINCT category_key) AS INT) AS n_categories, count(DISTINCT category_key) = 5 AS complete FROM t LEFT JOIN a USING (name) GROUP BY ALL)"""
_NORM = r"trim(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{Nd}}]+', ' ', 'g'))".format
_JUDGED = f"""WITH g AS (SELECT DISTINCT record_id, brand, category, name, formattedAddress, types FROM official_brand_records),
n AS (SELECT *, lower(coalesce(name, '')) || ' ' || lower(coalesce(formattedAddress, '')) b, {_NORM('name')} nn, {_NORM('brand')} nb FROM g),
j AS (SELECT *, CASE {' '.join(f"WHEN contains(b, '{k}') THEN 'reject_keyword:{k}'" for k in KEYWORDS)}
 WHEN NOT (contains(' ' || nn || ' ', ' ' || nb || ' ') OR list_has_all(string_split(nn, ' '), string_split(nb, ' '))) THEN 'missing_required_brand_tokens'
 WHEN NOT list_has_any(list_transform(coalesce(types, []), lambda t: lower(t)), ['gym', 'fitness_center']) THEN 'type_mismatch' END AS reason FROM n)"""
_HAV = "2 * {R} * asin(sqrt(least(1, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))".format
_TR = f"""WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, {_xy('o_orderkey', 31, 47)} FROM orders),
s AS (SELECT o_custkey, latitude a, longitude b, lead(latitude) OVER w c, lead(longitude) OVER w d FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
l AS (SELECT o_custkey, CASE WHEN c IS NOT NULL THEN {_HAV(R=EARTH_RADIUS_FEET, a='a', b='b', c='c', d='d')} END f FROM s)"""
_PK = f"""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) / 20000 h, {_xy('p_partkey', 7901, 104717)} FROM part),
q AS (SELECT *, latitude - h y0, latitude + h y1, longitude - h * 3 x0, longitude + h * 3 x1 FROM p)"""


def _street_sql(col: str, country: str) -> str:
    s = f"regexp_replace(lower(coalesce({col}, '')), '[^a-z0-9]+', ' ', 'g')"
    if country:
        s = rf"regexp_replace({s}, '\b{country}\s*$', ' ', 'g')"
    for long, short in X.STREET_WORDS.items():
        s = rf"regexp_replace({s}, '\b{long}\b', '{short}', 'g')"
    return rf"regexp_replace(trim({s}), '\s+', ' ', 'g')"


_BASE = r"regexp_replace(trim(CASE WHEN coalesce(trim(name), '') <> '' THEN name ELSE coalesce(query, '') END), '\s+', ' ', 'g')"
_HINT = r"nullif(regexp_replace(trim(regexp_replace(split_part(coalesce(formattedAddress, ''), ',', 1), '^\s*\d+[A-Za-z\-]*\s+', '')), '\s+', ' ', 'g'), '')"
_VALID = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0)"
SQL = {
    "coverage_cells": f'WITH {_CELLS} SELECT "row", col FROM cells',
    "coverage_runs": f'WITH {_RUNS} SELECT "row", start_col, end_col FROM runs',
    "coverage_rects": f"""WITH {_RUNS} SELECT min("row") start_row, max("row") end_row, start_col, end_col FROM (SELECT *, "row" - row_number() OVER (PARTITION BY start_col, end_col ORDER BY "row") i FROM runs) GROUP BY start_col, end_col, i""",
    "knn_per_category": _KNN + ' SELECT probe_id, category_key, "rank", label, round(dist, 6) AS distance_miles FROM k WHERE "rank" <= 3',
    "missing_categories": _KNN + " SELECT probe_id, category_key FROM k GROUP BY ALL HAVING min(dist) > 1.0",
    "tile_assign": _ASSIGN + ' SELECT name, CAST("row" AS INT) "row", CAST(col AS INT) col, place_id, category_key FROM a',
    "tile_status": _STATUS + " SELECT * FROM s",
    "tile_counts": _STATUS + " SELECT count(*) FILTER (complete) AS complete, count(*) FILTER (NOT complete) AS incomplete FROM s",
    "tile_grid": f'WITH {_TILES} SELECT name, CAST("row" AS INT) "row", CAST(col AS INT) col, north, south, west, east FROM t',
    "category_map": """WITH m AS (SELECT *, lower(trim(category)) own, CASE lower(trim(category)) WHEN 'park' THEN 'green' WHEN 'trail' THEN 'green' WHEN 'transit' THEN 'transit' ELSE lower(trim(category)) END k FROM locations)
SELECT k AS category_key, CASE WHEN k <> own THEN own END AS grouped_from, count(*) AS n FROM m WHERE k IN ('green', 'transit') GROUP BY ALL""",
    "radius_lookup": "SELECT l.category, coalesce(r.radius_miles, 0.5) AS radius_miles, count(*) AS n FROM locations l LEFT JOIN category_radii r ON lower(trim(l.category)) = lower(trim(r.category)) GROUP BY ALL",
    "dedupe_locations": "SELECT location_id, category, label FROM (SELECT *, row_number() OVER (PARTITION BY lower(coalesce(category, '')), lower(coalesce(label, '')), latitude, longitude ORDER BY location_id) n FROM locations) WHERE n = 1",
    "dedupe_two_stage": """WITH g AS (SELECT DISTINCT record_id, lower(trim(category)) c, placeId, latitude, longitude, coalesce(trim(placeId), '') = '' AS blank FROM gyms_master),
a AS (SELECT * FROM g WHERE blank UNION ALL SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY c, lower(placeId) ORDER BY record_id) n FROM g WHERE NOT blank) WHERE n = 1)
SELECT record_id FROM (SELECT *, row_number() OVER (PARTITION BY c, latitude, longitude ORDER BY blank DESC, record_id) m FROM a) WHERE m = 1""",
    "grid_thin": f"SELECT location_id FROM (SELECT *, row_number() OVER (PARTITION BY floor(longitude / 0.01), floor(latitude / 0.01) ORDER BY location_id) n FROM locations WHERE {_VALID}) WHERE n = 1",
    "name_normalize": f"""WITH g AS (SELECT DISTINCT record_id, query, category, placeId, name, formattedAddress, sourceQueryType FROM gyms_master),
b AS (SELECT *, {_BASE} base, {_HINT} hint FROM g),
c AS (SELECT *, count(*) OVER (PARTITION BY lower(concat_ws('::', category, base))) n, CASE WHEN hint IS NULL THEN base ELSE base || ' | ' || hint END h FROM b),
e AS (SELECT *, count(*) OVER (PARTITION BY lower(concat_ws('::', category, base)), lower(h)) m, row_number() OVER (PARTITION BY placeId, query, sourceQueryType ORDER BY record_id) f FROM c)
SELECT record_id, CASE WHEN f > 1 OR n = 1 THEN base WHEN m = 1 THEN h ELSE h || ' | ' || CASE WHEN coalesce(trim(placeId), '') = '' THEN 'id' ELSE right(trim(placeId), 4) END END AS normalized_name FROM e""",
    "brand_filter": _JUDGED + " SELECT record_id, reason FROM j",
    "audit_counts": _JUDGED + " SELECT brand, count(*) AS raw_count, count(*) FILTER (reason IS NULL) AS kept_count, count(*) FILTER (reason IS NOT NULL) AS rejected_count FROM j GROUP BY ALL",
    "search_expansion": "SELECT brand_id, unnest([trim(brand), 'near ' || brand || ' center', brand || ' north']) AS search, CAST(unnest([0, 1, 2]) AS INT) AS ord FROM brand_list",
    "tiles_x_searches": f"WITH {_TILES} SELECT name, (SELECT 3 * count(*) FROM brand_list) AS n_searches FROM t",
    "trail_length": _TR + " SELECT o_custkey, CAST(count(*) AS INT) AS n_points, round(coalesce(sum(f), 0), 3) AS feet FROM l GROUP BY ALL",
    "trail_keep": _TR + " SELECT o_custkey FROM l GROUP BY ALL HAVING sum(f) >= 150.0 * 5280",
    "densify_lines": _TR + " SELECT o_custkey, CAST(count(*) + coalesce(sum(greatest(0, floor(f / 2000.0) - 1)), 0) AS INT) AS n_points FROM l GROUP BY ALL",
    "bbox_frame": f"WITH pl AS ({PLACES}) SELECT category, min(latitude) AS south, max(latitude) AS north, min(longitude) AS west, max(longitude) AS east, round((min(latitude) + max(latitude)) / 2, 9) AS lat0, round((min(longitude) + max(longitude)) / 2, 9) AS lon0 FROM pl GROUP BY ALL",
    "segment_distances": f"""WITH pl AS ({PLACES}), p AS ({PROBES}), f AS (SELECT probe_id, (p.longitude + 84.3) * k px, (p.latitude - 33.8) * 364000 py, (a.longitude + 84.3) * k ax, (a.latitude - 33.8) * 364000 ay, (b.longitude + 84.3) * k bx, (b.latitude - 33.8) * 364000 byy
 FROM p JOIN pl a ON a.place_id = probe_id JOIN pl b ON b.place_id = probe_id + 1, (SELECT 364000 * cos(radians(33.8)) k)),
t AS (SELECT *, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (byy - ay)) / (pow(bx - ax, 2) + pow(byy - ay, 2)))) t FROM f)
SELECT probe_id, round(sqrt(pow(px - (ax + t * (bx - ax)), 2) + pow(py - (ay + t * (byy - ay)), 2)), 3) AS feet FROM t""",
    "place_hash": "SELECT location_id, upper(substr(sha256(coalesce(label, '') || '|' || location_id || '|point'), 1, 24)) AS hash FROM (SELECT DISTINCT location_id, label, category FROM locations)",
    "street_keys": f"SELECT record_id, {_street_sql('formattedAddress', 'norvale')} AS street_key FROM (SELECT DISTINCT record_id, formattedAddress FROM official_brand_records)",
    "address_join": f"""WITH m AS (SELECT min(record_id) master_id, {_street_sql('formattedAddress', '')} k FROM gyms_master GROUP BY k HAVING k <> ''),
o AS (SELECT DISTINCT record_id, formattedAddress FROM official_brand_records)
SELECT record_id, master_id AS matched_master_id, CASE WHEN master_id IS NULL THEN 'unresolved' ELSE 'address_match' END AS resolution FROM o LEFT JOIN m ON k = {_street_sql('o.formattedAddress', '')}""",
    "nearest_parent": f"""WITH g AS (SELECT DISTINCT location_id, category, latitude, longitude FROM locations WHERE {_VALID}),
x AS (SELECT k.location_id, p.location_id AS parent, {_HAV(R=3958.7613, a='k.latitude', b='k.longitude', c='p.latitude', d='p.longitude')} AS dist FROM g k JOIN g p ON k.category = p.category AND k.location_id % 2 = 1 AND p.location_id % 2 = 0 AND abs(k.latitude - p.latitude) < 0.004)
SELECT location_id, arg_min(parent, (dist, parent)) AS parent, round(min(dist), 6) AS distance_miles FROM x WHERE dist <= 0.25 GROUP BY ALL""",
    "table_cells": "SELECT brand_id, unnest(['Name', 'Kind']) AS key, unnest([trim(brand), trim(category)]) AS value FROM brand_list",
    "park_area": _PK + f""", m AS (SELECT *, (3 * y0 + 2 * y1) / 5 ml FROM q), a AS (SELECT p_partkey, (y1 - y0) * 364000 * (x1 - x0) * 364000 * cos(radians(ml)) a,
 {_HAV(R=EARTH_RADIUS_FEET, a='y0', b='x0', c='y0', d='x1')} + {_HAV(R=EARTH_RADIUS_FEET, a='y0', b='x1', c='y1', d='x1')} + {_HAV(R=EARTH_RADIUS_FEET, a='y1', b='x1', c='y1', d='x0')} + {_HAV(R=EARTH_RADIUS_FEET, a='y1', b='x0', c='y0', d='x0')} p FROM m)
SELECT p_partkey, round(a, 2) AS square_feet, round(p, 3) AS perimeter_feet, round((p + sqrt(greatest(0, p * p - 16 * a))) / 4 / nullif(round((p - sqrt(greatest(0, p * p - 16 * a))) / 4, 6), 0), 3) AS aspect FROM a""",
    "point_in_parks": _PK + f""", pl AS ({PLACES}), j AS (SELECT p_partkey, pl.latitude la, pl.longitude lo, q.* EXCLUDE (p_partkey, latitude, longitude) FROM q JOIN pl ON place_id = p_partkey),
k AS (SELECT *, la > y0 AND la < y1 AND lo > x0 AND lo < x1 AS inside, greatest(y0 - la, 0, la - y1) * 364000 dy, greatest(x0 - lo, 0, lo - x1) * 364000 * cos(radians(33.8)) dx FROM j)
SELECT p_partkey, inside, round(CASE WHEN inside THEN 0 ELSE sqrt(dx * dx + dy * dy) END, 2) AS feet FROM k""",
    "distinct_types": """WITH g AS (SELECT DISTINCT record_id, types FROM gyms_master), l AS (SELECT record_id, list_filter(list_concat(coalesce(types, []), ['GYM', '']), lambda x: x IS NOT NULL AND trim(x) <> '') v FROM g)
SELECT record_id, array_to_string(list_filter(v, lambda x, i: list_position(list_transform(v, lambda y: lower(y)), lower(x)) = i), ',') AS types FROM l""",
}
