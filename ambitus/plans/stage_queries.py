"""Queries of the extraction, assembly, list and import stages over the test tables, each beside SQL written by hand.

Placemarks are made of the rows of ``part``: their attributes and positions come from arithmetic on the key, with the same text
in both engines."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ambitus.functions import shapes
from ambitus.functions import text as X
from ambitus.functions.shapes import coord
from ambitus.operators import dedupe, extract, filters, lists, places, requests, tiles
from ambitus.session import read
from ambitus.sinks import files as file_sink
from ambitus.sinks import kml as kml_sink
from ambitus.sources import exports, service
from ambitus.sources import kml as kml_source

from .place_queries import GRID, N, W

PROJECTS = ["Multi-Use Trail", "On_Street Facility", "Sidewalk", "Greenway", "", "Road diet", "SW, Trail", "Bike, Diet, Trail"]
CLASSES = ["", "Off-Street", "On-Street", "Null", "Sidewalk", "Multi Use Path"]
STATES = ["", "Existing", "Demolished", "Proposed"]
SOURCES = ["Trail_Plan_Inventory.kml", "city-parks.kml", "Beltline.kml", "roads.kml", "MARTA_Stops.kml"]
NAMES = ["Oak path", "Elm Road", " ", "Central Station", "Mill Greenway", "Null"]


def _pick(values: list[str], index: str, spark: bool) -> str:
    body = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({body}), CAST(1 + {index} % {len(values)} AS INT))" if spark else f"([{body}])[1 + {index} % {len(values)}]"


_DIV = {True: "CAST(floor(p_partkey / {n}) AS BIGINT)", False: "(p_partkey // {n})"}


def _fields(spark: bool) -> dict[str, str]:
    by = lambda n: _DIV[spark].format(n=n)
    return {
        "source": _pick(SOURCES, "p_partkey", spark), "title": _pick(NAMES, by(5), spark), "project": _pick(PROJECTS, by(30), spark),
        "hc": _pick(CLASSES, by(3), spark), "lc": _pick(CLASSES, by(7), spark), "state": _pick(STATES, by(2), spark),
    }


def _marks(spark, d):
    """Placemarks without geometry."""
    p = read(spark, d, "part").selectExpr("p_partkey", "p_name", "p_brand", *[f"{v} AS {k}" for k, v in _fields(True).items()])
    entries = [F.struct(F.lit(k).alias("key"), F.col(c).alias("value")) for k, c in (("PROJECT_TYPE", "project"), ("HC_Class", "hc"), ("lc_class", "lc"), ("HC_Status", "state"), ("Park_Name", "p_name"), ("LABEL", "p_brand"))]
    entries += [F.when(F.col("p_partkey") % 7 == 0, F.struct(F.lit("Station").alias("key"), F.lit("S7").alias("value"))), F.when(F.col("p_partkey") % 4 == 1, F.struct(F.lit("Plan_").alias("key"), F.lit("Plan A").alias("value")))]
    return p.select("p_partkey", F.col("source").alias("source_file"), F.col("title").alias("name"), F.map_from_entries(F.array_compact(F.array(*entries))).alias("metadata"))


def line_class(spark, d):
    m = _marks(spark, d)
    c = extract.line_class(F.col("source_file"), F.col("name"), F.col("metadata"))
    return m.select("p_partkey", c["category"].alias("category"), c["reason"].alias("reason"))


def point_class(spark, d):
    return _marks(spark, d).select("p_partkey", extract.point_class(F.col("source_file"), F.col("name"), F.col("metadata")).alias("category"))


def feature_names(spark, d):
    m = _marks(spark, d).withColumn("feature", extract.feature_name(F.col("name"), F.col("metadata"), F.col("source_file")))
    names = F.array_join(extract.search_names(F.col("feature"), F.col("metadata")), "/")
    kinds = F.array_join(extract.types_of(F.lit("trail"), F.lit("line"), extract.meta(F.col("metadata"), "Project_Type")), "/")
    return m.select("p_partkey", F.col("feature").alias("name"), names.alias("search_names"), extract.address_hint(F.col("source_file"), F.col("metadata")).alias("hint"), kinds.alias("types"))


_BOX = "CAST(33.70 AS DOUBLE) + CAST((p_partkey * 7901) % 2500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS la, CAST(-84.55 AS DOUBLE) + CAST((p_partkey * 104717) % 4500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lo, CAST(0.0001 AS DOUBLE) + CAST(p_partkey % 10 AS DOUBLE) / CAST(5000 AS DOUBLE) AS h, CAST(0.001 AS DOUBLE) + CAST(p_partkey % 13 AS DOUBLE) / CAST(500 AS DOUBLE) AS w"
MIN_PARK, MIN_TRAIL, SPACING = 1_500_000.0, 0.4, 500.0


def _boxes(spark, d):
    p = read(spark, d, "part").selectExpr("p_partkey", *[c.strip() for c in _BOX.split(", ")])
    at = lambda a, b: coord(F.col("la") + a * F.col("h"), F.col("lo") + b * F.col("w"))
    return p.withColumn("ring", F.array(at(0, 0), at(0, 1), at(1, 1), at(1, 0), at(0, 0)))


def park_keep(spark, d):
    """Boxes that are kept as parks: large ones, and long narrow ones."""
    return _boxes(spark, d).where(extract.keep_park(F.array(F.array("ring")), MIN_PARK, MIN_TRAIL)).select("p_partkey")


def _extracted(spark, d):
    """A third of the placemarks are areas, a third lines, a third points."""
    b = _boxes(spark, d)
    kind = F.col("p_partkey") % 3
    none = F.array()
    line = F.array(F.slice("ring", 1, 1), F.slice("ring", 3, 1))
    p = b.select(
        F.when(kind == 2, "MARTA_Stops.kml").otherwise("trails.kml").alias("source_file"), F.col("p_partkey").cast("int").alias("placemark_index"), F.concat(F.lit("feature "), F.col("p_partkey").cast("string")).alias("name"), F.lit(None).cast("string").alias("description"),
        F.create_map(F.lit("Project_Type"), F.when(kind == 1, "Multi-Use Trail").otherwise("")).alias("metadata"),
        F.when(kind == 2, F.slice("ring", 1, 1)).otherwise(none.cast(b.schema["ring"].dataType)).alias("points"),
        F.when(kind == 1, F.array(F.flatten(line))).otherwise(F.array().cast("array<array<struct<latitude:double,longitude:double>>>")).alias("lines"),
        F.when(kind == 0, F.array(F.array("ring"))).otherwise(F.array().cast("array<array<array<struct<latitude:double,longitude:double>>>>")).alias("polygons"),
    )
    return extract.extract(p, MIN_PARK, MIN_TRAIL, SPACING)


def placemark_records(spark, d):
    """Place records along the kept lines and at the kept points."""
    r = extract.place_records(_extracted(spark, d).where("kind <> 'polygon'"))
    return r.select("query", "category", "placeId", "formattedAddress", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), F.array_join("types", "/").alias("types"))


def feature_kinds(spark, d):
    """Kept geometries by category and kind, with their vertices and dense points, and the split by category."""
    e = _extracted(spark, d)
    f, s = extract.geometry_features(e), extract.feature_summary(e)
    n = s.groupBy("category", "geometry_type").agg(F.count("*").alias("n"), F.sum("n_points").alias("n_points"))
    parts = extract.split(f, ["park", "trail", "transit"])
    own = None
    for k, v in parts.items():
        v = v.groupBy(F.lit(k).alias("category")).agg(F.count("*").alias("n_split"))
        own = v if own is None else own.unionByName(v)
    return n.join(own, "category")


CONFIG = requests.CategoryConfig.from_json(json.dumps({"defaultRadiusMiles": 0.5, "includedCategories": ["green", " Transit ", "gym", ""], "categoryRadiusMiles": {"Green": 0.75, "gym": 1.0}, "categoryGroups": [{"targetCategory": "green", "sourceCategories": ["park", "Trail", " "]}]}))


def _assembled(spark, d):
    loc = read(spark, d, "locations").select("category", F.col("label").alias("name"), "latitude", "longitude")
    gyms = read(spark, d, "gyms_master").select("category", "name", "latitude", "longitude")
    return requests.assemble([loc, gyms], [], CONFIG)


def assembled_features(spark, d):
    """Places of two tables as distinct features of grouped, included categories."""
    return _assembled(spark, d).select("category", "label", F.col("points")[0]["latitude"].alias("latitude"), F.col("points")[0]["longitude"].alias("longitude"))


def request_roundtrip(spark, d):
    """Features of each town's quarter-degree square as a request document, read back; shapes of all kinds."""
    f = _assembled(spark, d).where("label IS NOT NULL AND points[0].latitude IS NOT NULL AND points[0].longitude IS NOT NULL")
    f = f.withColumn("area", F.concat_ws("_", F.floor(F.col("points")[0]["latitude"] * 4), F.floor(F.col("points")[0]["longitude"] * 4)))
    docs = requests.request_documents(f, "area", CONFIG)
    back = requests.request_features(requests.read_requests(docs, "area", "document"), "area")
    return back.groupBy("area", "category").agg(F.count("*").alias("n"), F.count_distinct("label").alias("n_labels"), F.round(F.sum(F.col("points")[0]["latitude"]), 5).alias("sum_lat"))


def feature_faults(spark, d):
    """What is wrong with the locations as features of a request."""
    loc = read(spark, d, "locations").select(F.struct("latitude", "longitude", "category", "label").alias("x"))
    f = loc.select(*requests.flat_feature(requests.location_feature(F.col("x"))))
    return requests.faults(f)


def category_bounds(spark, d):
    """The padded box of each category of assembled features that have a position, and its first spelling."""
    g = read(spark, d, "gyms_master").select("record_id", "category", "latitude", "longitude").where("category IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")
    at = F.array(coord(F.col("latitude"), F.col("longitude")))
    f = places.with_radius(g, CONFIG.radius_table(spark), CONFIG.default_radius).withColumn("category_key", F.lower(F.trim("category")))
    f = f.select("record_id", "category", "category_key", "radius_miles", at.alias("points"), F.array().cast("array<array<struct<latitude:double,longitude:double>>>").alias("lines"), F.array().cast("array<array<array<struct<latitude:double,longitude:double>>>>").alias("polygons"))
    box = requests.padded_bounds(f, "category_key")
    return box.join(requests.first_casing(f, [F.col("record_id")]), "category_key").select("category_key", "category", "n", *[F.round(c, 9).alias(c) for c in ("south", "north", "west", "east")])


def tile_boxes(spark, d):
    """Boxes of any shape with every tile they reach at their true width."""
    b = _boxes(spark, d).select("p_partkey", F.lit("Park").alias("category"), F.lit(0.8).alias("radius_miles"), F.col("la").alias("south"), (F.col("la") + F.col("h")).alias("north"), F.col("lo").alias("west"), (F.col("lo") + F.col("w")).alias("east"))
    return tiles.assign_boxes(b, tiles.tiles(spark, *GRID), N, W, GRID[4], GRID[5], "p_partkey", true_width=True).select("name", "p_partkey")


def tile_of(spark, d):
    """The tile that holds each box's corner, clamped, and whether the corner lies in a box around the middle."""
    row, col = tiles.tile_index(F.col("la"), F.col("lo"), N, W, GRID[4], GRID[5], 4, 5)
    inside = requests.in_bounds(F.col("la"), F.col("lo"), *[F.lit(x) for x in (33.75, 33.85, -84.4, -84.2)])
    return _boxes(spark, d).select("p_partkey", row.alias("tile_row"), col.alias("tile_col"), inside.alias("central"))


KEYWORDS = ["club", "nutrition", "studio elite"]
KINDS = [("gym", "gym"), ("gym", "Fitness_Center")]


def _judged(spark, d):
    o = read(spark, d, "official_brand_records").select("record_id", F.col("brand").alias("query"), "category", "name", "formattedAddress", F.lit("base").alias("sourceQueryType"), F.lit(None).cast("string").alias("placeId"), "latitude", "longitude", "types").distinct()
    brands = read(spark, d, "brand_list")
    aliases = brands.where("brand_id % 5 <> 0").select(F.col("brand").alias("query"), F.explode(F.array(F.col("brand"), F.concat(F.element_at(F.split("brand", " "), -1), F.lit(" "), F.split("brand", " ")[0]))).alias("alias"))
    return lists.judge(o, aliases, spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string"), spark.createDataFrame(KINDS, "category string, type string"))


def rejected_records(spark, d):
    """Records that a brand, keyword or type test rejects: brands of five without aliases pass the first."""
    return _judged(spark, d).where(F.col("reason").isNotNull()).select("record_id", "reason")


def list_audit(spark, d):
    """Counts of the list before and after filters and de-duplication."""
    j = _judged(spark, d)
    return lists.full_audit(j, lists.master_list(j, [F.col("record_id")])).withColumn("by_query", F.array_join(F.transform("by_query", lambda q: F.concat(q["query"], F.lit("="), q["n"].cast("string"))), ";"))


def clean_reasons(spark, d):
    g = read(spark, d, "gyms_master").select("record_id", "query", "name").distinct()
    aliases = read(spark, d, "brand_list").select(F.col("brand").alias("query"), F.col("brand").alias("alias"))
    words = aliases.select("query").crossJoin(F.broadcast(spark.createDataFrame([("crossing", 1), ("annex", 0)], "word string, ord int")))  # two words
    return lists.clean(g, aliases, words).select("record_id", "reason")


def clean_summary(spark, d):
    """Sizes of each query's list before and after the clean-up."""
    g = read(spark, d, "gyms_master").select("record_id", "query").distinct()
    kept = g.join(clean_reasons(spark, d).where("reason IS NULL").select("record_id").distinct(), "record_id", "left_semi")
    return lists.before_after(g, kept, "query")


def address_keys(spark, d):
    a = F.concat(F.lit("Building 7 "), F.coalesce("formattedAddress", F.lit("")), F.lit(", USA"))
    return read(spark, d, "official_brand_records").select("record_id", "formattedAddress").distinct().select("record_id", lists.address_key(a).alias("address_key"))


def official_list(spark, d):
    o = read(spark, d, "official_brand_records").select("record_id", "brand", "category", "name", "formattedAddress", "sourceUrl", "types", "latitude", "longitude").distinct()
    legacy = read(spark, d, "gyms_master").select("record_id", "formattedAddress", "latitude", "longitude").distinct()
    r = lists.official_records(o, legacy, [F.col("record_id")])
    return r.select("query", "placeId", "name", "latitude", "longitude", "resolution")


def way_filter(spark, d):
    """Ways off the street that exist, counted by file."""
    return filters.keep_summary(_marks(spark, d), filters.off_street(F.col("metadata")), "source_file")


def source_filter(spark, d):
    """Placemarks kept by the rule of their own file."""
    rules = {"city-parks.kml": filters.name_contains("PATH", F.col("name")), "ROADS.kml": extract.meta(F.col("metadata"), "hc_status") == "Existing"}
    return filters.partition(_marks(spark, d), filters.by_source(F.col("source_file"), rules))[0].select("p_partkey")


def import_reasons(spark, d):
    """Imported titles left out: the brand itself, parts of a place, repeated ids."""
    g = read(spark, d, "gyms_master").select("record_id", "query", "category", "placeId", "name").where("placeId IS NOT NULL").distinct()
    reason = filters.import_reason(F.col("name"), F.col("query"), F.col("category"), ["Annex", "Outer (Yard)"], "gym")
    return filters.import_candidates(g, reason, "placeId", [F.col("record_id")]).select("record_id", "reason")


def brand_routes(spark, d):
    """The brand with which each name begins."""
    return read(spark, d, "official_brand_records").select("record_id", "name").distinct().select("record_id", filters.brand_of(F.col("name"), ["temporal gym junior", "Temporal Gym", "elanor"]).alias("brand"))


def _json_row(title: str, address, place, lat, lon):
    """One row of an aggregate export as text."""
    text = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("a"))), r'^\{"a":(.*)\}$', 1)
    return F.concat(F.lit("[null,[null,null,"), text(title), F.lit(",null,"), text(address), F.lit(",[null,null,"), lat.cast("string"), F.lit(","), lon.cast("string"), F.lit('],["1","2"],'), text(place), F.lit('],"x"]'))


def aggregate_import(spark, d):
    """Gym records written as one aggregate export for each category spelling and read back."""
    g = read(spark, d, "gyms_master").where("latitude IS NOT NULL AND longitude IS NOT NULL AND trim(name) <> ''").select("record_id", "query", F.trim("name").alias("name"), "formattedAddress", "placeId", "latitude", "longitude").distinct()
    rows = g.select("query", _json_row(F.col("name"), F.col("formattedAddress"), F.col("placeId"), F.col("latitude"), F.col("longitude")).alias("j"))
    docs = rows.groupBy(F.coalesce("query", F.lit("")).alias("doc")).agg(F.concat(F.lit(")]}'[[null,0,0,0,0,0,0,0,["), F.array_join(F.array_sort(F.collect_list("j")), ","), F.lit("]]]")).alias("t"))
    back = exports.aggregate_rows(docs, "t")
    return back.select(F.col("doc").alias("query"), "title", "address", "place_id", "latitude", "longitude")


def trace_hits(spark, d):
    """Events read as trace calls: hits by type, method and outcome, with the file of the type."""
    e = read(spark, d, "events").select(F.col("event_type").alias("implementationType"), F.when(F.col("user_id") % 2 == 0, "Run").otherwise("Read").alias("methodName"), F.when(F.col("value") > 100, "ok").otherwise("failed").alias("outcome"))
    return exports.trace_summary(e, spark.createDataFrame([("error", "b.cs"), ("error", "a.cs"), ("signup", "s.cs")], "type string, source_file string"))


def service_records(spark, d):
    """Locations as stored answers of a places service, read back."""
    loc = read(spark, d, "locations").distinct().withColumn("p", F.struct(F.col("location_id").cast("string").alias("id"), F.struct(F.col("label").alias("text")).alias("displayName"), F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("latitude", "longitude")).alias("location"), F.array("category").alias("types")))
    answers = loc.groupBy("category").agg(F.to_json(F.struct(F.collect_list("p").alias("places"))).alias("t"))
    return service.payload_records(answers, "t", "category", "category").select("category", "placeId", "name", "latitude", "longitude", F.array_join("types", ",").alias("types"))


def styled_kml(spark, d):
    """Original geometries as styled documents, read back: placemarks by folder."""
    f = extract.geometry_features(_extracted(spark, d)).withColumn("part", F.pmod(F.xxhash64("label"), F.lit(3)))
    docs = file_sink.styled_documents(f, "part")
    back = kml_source.placemarks(docs.select(F.col("part").cast("string").alias("source_file"), F.col("document").cast("binary").alias("content")))
    return back.groupBy("folder").agg(F.count("*").alias("n"), F.count_distinct("name").alias("n_names"))


def result_kml(spark, d):
    """Result documents of each tile without areas, read back: source features by category."""
    f = _assembled(spark, d).where("points[0].latitude IS NOT NULL AND points[0].longitude IS NOT NULL").withColumn("group_key", F.floor(F.col("points")[0]["latitude"]).cast("string"))
    none = spark.createDataFrame([], "group_key string, polygon_no int, outer array<struct<latitude:double,longitude:double>>, holes array<array<struct<latitude:double,longitude:double>>>")
    docs = kml_sink.result_documents(none, f)
    back = kml_source.placemarks(docs.select(F.col("group_key").alias("source_file"), F.col("document").cast("binary").alias("content")))
    return back.groupBy("folder").agg(F.count("*").alias("n"))


def feature_distances(spark, d):
    """Feet from a position beside each kept geometry to it, and the middle of each area."""
    e = _extracted(spark, d).join(_boxes(spark, d).select(F.col("p_partkey").cast("int").alias("placemark_index"), "la", "lo", "h", "w"), "placemark_index")
    far = shapes.feature_distance(F.col("kind"), F.col("points"), F.col("lines"), F.col("polygons"), F.col("la") + F.col("h") / 2, F.col("lo") - F.col("w"), F.lit(33.8), F.lit(-84.3))
    middle = shapes.ring_center(F.get(F.get("polygons", F.lit(0)), F.lit(0)))
    return e.select("placemark_index", "kind", F.round(far, 2).alias("feet"), F.round(middle["latitude"], 8).alias("mid_lat"), F.round(middle["longitude"], 8).alias("mid_lon"))


def brand_scores(spark, d):
    """How well each gym record stands for its brand."""
    g = read(spark, d, "gyms_master").select("record_id", "query", "name", "types").distinct()
    n, q = lists.plain_text(F.col("name")), lists.plain_text(F.col("query"))
    matches = (q != "") & X.contains_phrase(n, q)
    return g.select("record_id", lists.canonical_score(F.col("name"), F.col("query"), F.col("types"), matches, F.contains(n, F.lit("annex"))).alias("score"))


def dense_points(spark, d):
    """Points equal to seven decimals once: each record's position, a copy of it and one a little apart."""
    g = read(spark, d, "locations").where("latitude IS NOT NULL AND longitude IS NOT NULL").select("location_id", "latitude", "longitude").distinct()
    pts = F.array(coord(F.col("latitude"), F.col("longitude")), coord(F.col("latitude") + 1e-9, F.col("longitude")), coord(F.col("latitude") + 1e-6, F.col("longitude")))
    return g.select("location_id", F.size(shapes.distinct_points(pts)).alias("n"))


def plain_names(spark, d):
    """Names in their comparison forms."""
    g = read(spark, d, "gyms_master").select("record_id", "name").distinct()
    return g.select("record_id", X.normalize(F.col("name")).alias("normal"), X.normalize_metadata(F.col("name")).alias("meta"), lists.plain_text(F.col("name")).alias("plain"), X.file_label(F.col("name")).alias("label"))


def distinct_by_position(spark, d):
    """Locations by category and exact position: the first, by the general first-wins operator."""
    return dedupe.first_wins(read(spark, d, "locations").select("location_id", "category", "latitude", "longitude"), [F.lower("category"), F.col("latitude"), F.col("longitude")], [F.col("location_id")]).select("location_id")


QUERIES = {f.__name__: f for f in (
    line_class, point_class, feature_names, park_keep, placemark_records, feature_kinds, assembled_features, request_roundtrip, feature_faults, category_bounds, tile_boxes, tile_of,
    rejected_records, list_audit, clean_reasons, clean_summary, address_keys, official_list, way_filter, source_filter, import_reasons, brand_routes, aggregate_import, trace_hits, service_records,
    styled_kml, result_kml, feature_distances, brand_scores, dense_points, plain_names, distinct_by_position,
)}

_M = "m AS (SELECT p_partkey, p_name, p_brand, " + ", ".join(f"{v} AS {k}" for k, v in _fields(False).items()) + " FROM part)"
_NZ = "lower(trim(translate({}, '-_', '  ')))".format
_SIG = lambda c: "(" + " OR ".join(f"contains({c}, '{w}')" for w in ("trail", "greenway", "beltline", "path")) + ")"
_LINE = f"""WITH {_M}, n AS (SELECT *, {_NZ('project')} p, {_NZ('source')} s, {_NZ("title || ' '")} t,
 CASE WHEN hc NOT IN ('', 'Null') THEN {_NZ('hc')} END h, CASE WHEN lc NOT IN ('', 'Null') THEN {_NZ('lc')} END l, nullif({_NZ('state')}, '') z FROM m),
c AS (SELECT *, CASE WHEN p IN ('on street facility', 'sidewalk') THEN 1 WHEN contains(p, 'trail') OR contains(p, 'greenway') THEN 2
 WHEN s = 'trail plan inventory.kml' THEN CASE WHEN {_SIG('t')} THEN 3 ELSE 4 END
 WHEN h IN ('on street', 'sidewalk') THEN 5 WHEN l IN ('on street', 'sidewalk') THEN 6
 WHEN coalesce(h, l) IN ('off street', 'multi use path') AND (z IS NULL OR z IN ('existing', 'proposed')) THEN 7 WHEN {_SIG("s || ' ' || t")} THEN 8 ELSE 9 END k FROM n)"""
_PLAIN = r"trim(regexp_replace(replace(lower(coalesce({}, '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))".format
_B = f"b AS (SELECT p_partkey, {_BOX} FROM part)"
_HAV = "2 * 20925524.9 * asin(sqrt(least(1, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))".format
_PARK = f"""WITH {_B}, s AS (SELECT *, h * 364000 * w * 364000 * cos(radians(la + h * 0.4)) a, {_HAV(a='la', b='lo', c='la', d='(lo + w)')} + 2 * {_HAV(a='la', b='lo', c='(la + h)', d='lo')} + {_HAV(a='(la + h)', b='lo', c='(la + h)', d='(lo + w)')} p FROM b),
r AS (SELECT *, (p + sqrt(greatest(0, p * p - 16 * a))) / 4 len, (p - sqrt(greatest(0, p * p - 16 * a))) / 4 wid FROM s),
parks AS (SELECT p_partkey FROM r WHERE a >= {MIN_PARK} OR (a > 0 AND wid > 0 AND len >= {MIN_TRAIL} * 5280 AND wid <= 250 AND len >= 8 * wid))"""
_TRAIL = f"""trails AS (SELECT * FROM (SELECT *, {_HAV(a='la', b='lo', c='(la + h)', d='(lo + w)')} f FROM b WHERE p_partkey % 3 = 1) WHERE f >= {MIN_TRAIL} * 5280)"""
_ASM = """a AS (SELECT DISTINCT CASE WHEN lower(trim(category)) IN ('park', 'trail') THEN 'green' ELSE lower(trim(category)) END category, label, latitude, longitude
 FROM (SELECT category, label, latitude, longitude FROM locations UNION ALL SELECT category, name, latitude, longitude FROM gyms_master) WHERE lower(trim(category)) IN ('park', 'trail', 'green', 'transit', 'gym'))"""
_VALUES = "(VALUES " + ", ".join(f"('{n}', CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE), CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for n, _, _, a, b, x, y in tiles.tile_rows(*GRID)) + ") t(name, north, south, west, east)"
_NORM = r"trim(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{Nd}}]+', ' ', 'g'))".format
_HOLDS = "(contains(' ' || {n} || ' ', ' ' || {a} || ' ') OR list_has_all(string_split({n}, ' '), string_split({a}, ' ')))".format
_JUDGE = f"""WITH o AS (SELECT DISTINCT record_id, brand query, category, name, formattedAddress, latitude, longitude, types FROM official_brand_records),
al AS (SELECT lower(brand) q, {_NORM('brand')} a1, {_NORM("string_split(brand, ' ')[-1] || ' ' || string_split(brand, ' ')[1]")} a2 FROM brand_list WHERE brand_id % 5 <> 0),
n AS (SELECT o.*, lower(coalesce(name, '')) || ' ' || lower(coalesce(formattedAddress, '')) t, {_NORM('name')} nn, a1, a2 FROM o LEFT JOIN al ON lower(query) = q),
j AS (SELECT *, CASE {' '.join(f"WHEN contains(t, '{k}') THEN 'reject_keyword:{k}'" for k in sorted(KEYWORDS))}
 WHEN a1 IS NOT NULL AND NOT ({_HOLDS(n='nn', a='a1')} OR {_HOLDS(n='nn', a='a2')}) THEN 'missing_required_brand_tokens'
 WHEN lower(trim(category)) = 'gym' AND NOT list_has_any(list_transform(coalesce(types, []), lambda x: lower(x)), ['gym', 'fitness_center']) THEN 'type_mismatch' END reason FROM n)"""
_CLEAN = f"""WITH g AS (SELECT DISTINCT record_id, query, name FROM gyms_master), b AS (SELECT lower(brand) q, {_PLAIN('brand')} a FROM brand_list),
c AS (SELECT record_id, query, CASE WHEN a IS NOT NULL AND NOT {_HOLDS(n='nn', a='a')} THEN 'brand_mismatch' WHEN a IS NOT NULL AND contains(nn, 'annex') THEN 'non_club_entity:annex' WHEN a IS NOT NULL AND contains(nn, 'crossing') THEN 'non_club_entity:crossing' END reason
 FROM (SELECT *, {_PLAIN('name')} nn FROM g) LEFT JOIN b ON lower(query) = q)"""


def _key_sql(c: str) -> str:
    s = rf"regexp_replace(lower(coalesce({c}, '')), '\bbuilding\s+[a-z0-9]+\b', '', 'g')"
    s = rf"regexp_replace(regexp_replace({s}, '[^a-z0-9]+', ' ', 'g'), '\b(usa|united states)\b', '', 'g')"
    s = rf"regexp_replace({s}, '\b(suite|ste|unit)\b', ' ste ', 'g')"
    for a, b in (("street", "st"), ("road", "rd"), ("drive", "dr"), ("boulevard", "blvd"), ("highway", "hwy"), ("parkway", "pkwy"), ("avenue", "ave"), ("place", "pl"), ("court", "ct"), ("northeast", "ne"), ("northwest", "nw"), ("southeast", "se"), ("southwest", "sw")):
        s = rf"regexp_replace({s}, '\b{a}\b', ' {b} ', 'g')"
    return rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"


SQL = {
    "line_class": _LINE + """ SELECT p_partkey, CASE WHEN k IN (2, 3, 7, 8) THEN 'trail' END AS category, CASE k WHEN 1 THEN 'blocked-project-type:' || p WHEN 2 THEN 'project-type:' || p WHEN 3 THEN 'trail-plan-inventory-name-signal'
 WHEN 4 THEN 'trail-plan-inventory-no-signal' WHEN 5 THEN 'blocked-facility-class:' || h WHEN 6 THEN 'blocked-facility-class:' || l WHEN 7 THEN 'authoritative-off-street-metadata' WHEN 8 THEN 'name-or-source-signal' ELSE 'no-supported-category-signal' END AS reason FROM c""",
    "point_class": f"WITH {_M} SELECT p_partkey, CASE WHEN source = 'MARTA_Stops.kml' OR title = 'Central Station' OR p_partkey % 7 = 0 THEN 'transit' WHEN source = 'city-parks.kml' THEN 'park' WHEN source IN ('Trail_Plan_Inventory.kml', 'Beltline.kml') OR title IN ('Oak path', 'Mill Greenway') THEN 'trail' END AS category FROM m",
    "feature_names": f"""WITH {_M}, f AS (SELECT *, CASE WHEN trim(title) <> '' THEN title ELSE p_name END f FROM m)
SELECT p_partkey, f AS name, CASE WHEN f = p_name THEN f ELSE f || '/' || p_name END || '/' || p_brand || CASE WHEN p_partkey % 7 = 0 THEN '/S7' ELSE '' END AS search_names, source || CASE WHEN p_partkey % 4 = 1 THEN ' | Plan A' ELSE '' END AS hint,
 'trail/line' || CASE project WHEN 'Multi-Use Trail' THEN '/multi-use_trail' WHEN 'On_Street Facility' THEN '/on_street_facility' WHEN 'Sidewalk' THEN '/sidewalk' WHEN 'Greenway' THEN '/greenway' WHEN 'Road diet' THEN '/road_diet' WHEN 'SW, Trail' THEN '/sw' WHEN 'Bike, Diet, Trail' THEN '/bike/diet' ELSE '' END AS types FROM f""",
    "park_keep": _PARK + " SELECT p_partkey FROM parks",
    "placemark_records": f"""WITH {_B}, {_TRAIL}, e AS (SELECT *, greatest(0, CAST(floor(f / {SPACING}) AS BIGINT) - 1) x FROM trails),
u AS (SELECT *, unnest(range(0, x + 2)) k FROM e), r AS (SELECT p_partkey, 'trail' c, 'trails.kml' s, 'line' g, k, CASE WHEN k > x THEN la + h ELSE la + h * (k * {SPACING} / f) END y, CASE WHEN k > x THEN lo + w ELSE lo + w * (k * {SPACING} / f) END z, 'trail/line/multi-use_trail' ty FROM u
 UNION ALL SELECT p_partkey, 'transit', 'MARTA_Stops.kml', 'point', 0, la, lo, 'transit/point' FROM b WHERE p_partkey % 3 = 2)
SELECT 'feature ' || p_partkey AS query, c AS category, upper(substr(sha256(s || '|' || p_partkey || '|' || g || '|' || k), 1, 24)) AS placeId, s AS formattedAddress, round(y, 9) AS latitude, round(z, 9) AS longitude, ty AS types FROM r""",
    "feature_kinds": _PARK + f""", {_TRAIL} SELECT category, geometry_type, n, n_points, n AS n_split FROM (SELECT 'park' AS category, 'polygon' AS geometry_type, count(*) AS n, 5 * count(*) AS n_points FROM parks WHERE p_partkey % 3 = 0
 UNION ALL SELECT 'trail', 'line', count(*), 2 * count(*) FROM trails UNION ALL SELECT 'transit', 'point', count(*), count(*) FROM b WHERE p_partkey % 3 = 2)""",
    "assembled_features": f"WITH {_ASM} SELECT * FROM a",
    "request_roundtrip": f"""WITH {_ASM} SELECT CAST(floor(latitude * 4) AS BIGINT) || '_' || CAST(floor(longitude * 4) AS BIGINT) AS area, category, count(*) AS n, count(DISTINCT label) AS n_labels, round(sum(latitude), 5) AS sum_lat
 FROM a WHERE label IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL""",
    "feature_faults": """SELECT fault, count(*) AS n FROM (SELECT 'label missing' AS fault FROM locations WHERE coalesce(trim(label), '') = '' UNION ALL SELECT 'category missing' FROM locations WHERE coalesce(trim(category), '') = ''
 UNION ALL SELECT 'coordinate out of range' FROM locations WHERE NOT coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false)) GROUP BY ALL""",
    "category_bounds": """WITH g AS (SELECT record_id, category, latitude, longitude FROM gyms_master WHERE category IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)
SELECT lower(trim(category)) AS category_key, arg_min(category, record_id) AS category, count(*) AS n, round(min(latitude) - (1.0 / 69.0 + 0.01), 9) AS south, round(max(latitude) + (1.0 / 69.0 + 0.01), 9) AS north, round(min(longitude) - (1.0 / 69.0 + 0.01), 9) AS west, round(max(longitude) + (1.0 / 69.0 + 0.01), 9) AS east FROM g GROUP BY ALL""",
    "tile_boxes": f"""WITH {_B}, p AS (SELECT *, CAST(0.8 AS DOUBLE) / 69.0 y, CAST(0.8 AS DOUBLE) / 69.0 / cos(radians(la + h + 0.8 / 69.0)) x FROM b)
SELECT name, p_partkey FROM p JOIN {_VALUES} ON la + h + y >= south AND la - y <= north AND lo + w + x >= west AND lo - x <= east""",
    "tile_of": f"WITH {_B} SELECT p_partkey, CAST(greatest(0, least(3, floor(({N} - la) / {GRID[4]}))) AS INT) AS tile_row, CAST(greatest(0, least(4, floor((lo - ({W})) / {GRID[5]}))) AS INT) AS tile_col, la BETWEEN 33.75 AND 33.85 AND lo BETWEEN -84.4 AND -84.2 AS central FROM b",
    "rejected_records": _JUDGE + " SELECT record_id, reason FROM j WHERE reason IS NOT NULL",
    "list_audit": _JUDGE + """, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(category)), latitude, longitude ORDER BY record_id) r FROM j WHERE reason IS NULL) WHERE r = 1),
q AS (SELECT lower(trim(category)) g, query, count(*) n FROM f GROUP BY ALL), b AS (SELECT g, sum(n) final_n, string_agg(query || '=' || n, ';' ORDER BY query) by_q FROM q GROUP BY g)
SELECT lower(trim(category)) AS group_name, count(*) AS raw_count, count(*) FILTER (reason IS NULL) AS kept_count, count(*) FILTER (reason IS NOT NULL) AS rejected_count, CAST(any_value(b.final_n) AS BIGINT) AS final_count, any_value(b.by_q) AS by_query FROM j JOIN b ON g = lower(trim(category)) GROUP BY ALL""",
    "clean_reasons": _CLEAN + " SELECT record_id, reason FROM c",
    "clean_summary": _CLEAN + ", i AS (SELECT DISTINCT record_id, query FROM gyms_master), k AS (SELECT DISTINCT record_id FROM c WHERE reason IS NULL) SELECT query, count(*) AS before_count, count(k.record_id) AS after_count, count(*) - count(k.record_id) AS removed_count FROM i LEFT JOIN k USING (record_id) GROUP BY ALL",
    "address_keys": "SELECT record_id, " + _key_sql("'Building 7 ' || coalesce(formattedAddress, '') || ', USA'") + " AS address_key FROM (SELECT DISTINCT record_id, formattedAddress FROM official_brand_records)",
    "official_list": f"""WITH l AS (SELECT {_key_sql('formattedAddress')} k, arg_min(latitude, record_id) y, arg_min(longitude, record_id) x FROM gyms_master WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY k HAVING k <> ''),
o AS (SELECT DISTINCT record_id, brand, name, formattedAddress, sourceUrl, latitude, longitude, latitude IS NOT NULL AND longitude IS NOT NULL own FROM official_brand_records)
SELECT brand AS query, 'official::' || brand || '::' || coalesce(nullif(sourceUrl, ''), formattedAddress, '') AS placeId, name, CASE WHEN own THEN latitude ELSE y END AS latitude, CASE WHEN own THEN longitude ELSE x END AS longitude,
 CASE WHEN own THEN 'official' WHEN y IS NOT NULL THEN 'legacy-address-match' ELSE 'unresolved' END AS resolution FROM o LEFT JOIN l ON k = {_key_sql('o.formattedAddress')}""",
    "way_filter": f"WITH {_M} SELECT source AS source_file, count(*) FILTER ((hc = 'Off-Street' OR lc = 'Off-Street') AND state = 'Existing') AS kept, count(*) FILTER (NOT ((hc = 'Off-Street' OR lc = 'Off-Street') AND state = 'Existing')) AS removed FROM m GROUP BY ALL",
    "source_filter": f"WITH {_M} SELECT p_partkey FROM m WHERE CASE source WHEN 'city-parks.kml' THEN title = 'Oak path' WHEN 'roads.kml' THEN state = 'Existing' ELSE true END",
    "import_reasons": r"""WITH g AS (SELECT DISTINCT record_id, query, category, placeId, name FROM gyms_master WHERE placeId IS NOT NULL),
r AS (SELECT *, CASE WHEN lower(regexp_replace(name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) = lower(regexp_replace(query, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) THEN 'brand_header' WHEN lower(category) = 'gym' AND (contains(lower(name), 'annex') OR contains(lower(name), 'outer (yard)')) THEN 'sub_entity' END z FROM g)
SELECT record_id, CASE WHEN z IS NULL AND row_number() OVER (PARTITION BY placeId, z IS NULL ORDER BY record_id) > 1 THEN 'duplicate_id' ELSE z END AS reason FROM r""",
    "brand_routes": r"""SELECT record_id, CASE WHEN starts_with(n, 'temporal gym junior') THEN 'temporal gym junior' WHEN starts_with(n, 'temporal gym') THEN 'Temporal Gym' WHEN starts_with(n, 'elanor') THEN 'elanor' END AS brand FROM (SELECT record_id, trim(regexp_replace(lower(strip_accents(name)), '\s+', ' ', 'g')) n FROM (SELECT DISTINCT record_id, name FROM official_brand_records))""",
    "aggregate_import": """SELECT coalesce(query, '') AS query, trim(name) AS title, coalesce(trim(formattedAddress), '') AS address, CASE WHEN coalesce(trim(placeId), '') = '' THEN '1:2' ELSE trim(placeId) END AS place_id, latitude, longitude
FROM (SELECT DISTINCT record_id, query, name, formattedAddress, placeId, latitude, longitude FROM gyms_master WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND trim(name) <> '')""",
    "trace_hits": "SELECT event_type AS implementationType, CASE WHEN user_id % 2 = 0 THEN 'Run' ELSE 'Read' END AS methodName, CASE WHEN value > 100 THEN 'ok' ELSE 'failed' END AS outcome, count(*) AS hits, CASE event_type WHEN 'error' THEN 'a.cs' WHEN 'signup' THEN 's.cs' END AS source_file FROM events GROUP BY ALL",
    "service_records": "SELECT category, CAST(location_id AS VARCHAR) AS placeId, coalesce(label, '') AS name, latitude, longitude, category AS types FROM (SELECT DISTINCT * FROM locations) WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "styled_kml": _PARK + f", {_TRAIL} SELECT 'Parks' AS folder, count(*) AS n, count(*) AS n_names FROM parks WHERE p_partkey % 3 = 0 UNION ALL SELECT 'Trails', count(*), count(*) FROM trails",
    "result_kml": f"WITH {_ASM} SELECT 'Source Features/' || category AS folder, count(*) AS n FROM a WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL",
    "feature_distances": _PARK + f""", {_TRAIL}, k AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'polygon' WHEN p_partkey % 3 = 1 THEN 'linestring' ELSE 'point' END kind, *, 364000 * cos(radians(33.8)) fx FROM b
 WHERE p_partkey % 3 = 2 OR p_partkey IN (SELECT p_partkey FROM trails) OR (p_partkey % 3 = 0 AND p_partkey IN (SELECT p_partkey FROM parks))),
t AS (SELECT *, greatest(0, least(1, ((-w * fx) * (w * fx) + (h / 2 * 364000) * (h * 364000)) / (pow(w * fx, 2) + pow(h * 364000, 2)))) t FROM k)
SELECT CAST(p_partkey AS INT) AS placemark_index, kind, round(CASE kind WHEN 'polygon' THEN w * fx WHEN 'point' THEN sqrt(pow(w * fx, 2) + pow(h / 2 * 364000, 2)) ELSE sqrt(pow(-w * fx - t * w * fx, 2) + pow(h / 2 * 364000 - t * h * 364000, 2)) END, 2) AS feet,
 CASE WHEN kind = 'polygon' THEN round(la + h / 2, 8) END AS mid_lat, CASE WHEN kind = 'polygon' THEN round(lo + w / 2, 8) END AS mid_lon FROM t""",
    "brand_scores": f"""WITH g AS (SELECT DISTINCT record_id, query, name, types FROM gyms_master), p AS (SELECT *, {_PLAIN('name')} n, {_PLAIN('query')} q FROM g)
SELECT record_id, CAST(CASE WHEN q <> '' AND contains(' ' || n || ' ', ' ' || q || ' ') THEN 100 ELSE 0 END + CASE WHEN NOT contains(n, 'annex') THEN 100 ELSE 0 END + CASE WHEN list_has_any(coalesce(types, []), ['grocery_store', 'supermarket', 'gym']) THEN 25 ELSE 0 END
 + CASE WHEN contains(n, 'super market') THEN 10 ELSE 0 END + CASE WHEN n = q THEN 10 ELSE 0 END AS INT) AS score FROM p""",
    "dense_points": "SELECT location_id, 1 + CAST(round_even(latitude, 7) <> round_even(latitude + 1e-9, 7) AS INT) + CAST(round_even(latitude + 1e-6, 7) NOT IN (round_even(latitude, 7), round_even(latitude + 1e-9, 7)) AS INT) AS n FROM (SELECT DISTINCT location_id, latitude, longitude FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
    "plain_names": rf"""SELECT record_id, {_NZ('name')} AS normal, CASE WHEN trim(name) <> '' AND lower(trim(name)) <> 'null' THEN {_NZ('name')} END AS meta, {_PLAIN('name')} AS plain,
 CASE WHEN coalesce(trim(name), '') = '' THEN 'diagnostic' ELSE regexp_replace(regexp_replace(trim(name), '[<>:"/\\|?*\x00-\x1f]', '-', 'g'), '\s+', '-', 'g') END AS label FROM (SELECT DISTINCT record_id, name FROM gyms_master)""",
    "distinct_by_position": "SELECT min(location_id) AS location_id FROM locations GROUP BY lower(category), latitude, longitude",
}
