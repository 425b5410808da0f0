"""From placemarks to categorised features and place records: names, categories, size filters, densified points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.functions import shapes as G
from ambitus.functions import text as X
from ambitus.functions.geo import FEET_PER_MILE

# Project types, facility classes and states of lines, and the keys that may hold a feature's name.
ALLOWED_TRAIL_TYPES = ["multi use trail", "multi use path", "mixed use path", "trail", "greenway", "off road pedestrian trail", "bike, sw, trail", "bike, diet, trail", "sw, trail"]
BLOCKED_TRAIL_TYPES = ["on street bicycle facility", "on street bicycle network", "on street facility", "sidewalk", "sidewalk segment"]
OFF_STREET_CLASSES = ["off street", "multi use trail", "multi use path", "mixed use path", "greenway"]
BLOCKED_CLASSES = ["on street", *BLOCKED_TRAIL_TYPES]
FACILITY_STATES = ["existing", "programmed", "proposed"]
NAME_KEYS = ["AllParks_Fields_Park_Name", "Atlanta__GA_ServiceAreas_Park_N", "Park_Name", "PARK_NAME", "Name", "LABEL", "STATION", "Station", "Trail_Name"]
TRAIL_WORDS = ["trail", "greenway", "beltline", "path"]
CORRIDOR_WIDTH_FEET, CORRIDOR_ASPECT = 250.0, 8.0


def meta(metadata: Column, key: str) -> Column:
    """Value of a metadata key, ignoring case; of several keys that differ in case the last one's."""
    hits = F.filter(F.map_entries(metadata), lambda e: F.lower(e["key"]) == key.lower())
    return F.get(hits, F.size(hits) - 1)["value"]


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def _usable(c: Column) -> Column:
    """The trimmed value; null for a blank one or the word null."""
    return F.when(~_blank(c) & (F.lower(c) != "null"), F.trim(c))


def feature_name(name: Column, metadata: Column, source: Column) -> Column:
    """The placemark's own name, else the first usable of NAME_KEYS, else the name of the file."""
    return F.coalesce(F.when(~_blank(name), name), *[_usable(meta(metadata, k)) for k in NAME_KEYS], source)


def search_names(name: Column, metadata: Column) -> Column:
    """The feature's name and all usable values of NAME_KEYS, the first of those that differ in case alone."""
    return X.distinct_ignoring_case(F.array_compact(F.array(F.when(~_blank(name), F.trim(name)), *[_usable(meta(metadata, k)) for k in NAME_KEYS])))


def address_hint(source: Column, metadata: Column) -> Column:
    plan = meta(metadata, "Plan_")
    return F.concat_ws(" | ", source, F.when(~_blank(plan), plan))


def types_of(category: Column, geometry: Column, project_type: Column) -> Column:
    """Category, kind of geometry and the parts of the project type in snake case."""
    parts = F.filter(F.transform(F.split(F.coalesce(project_type, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    return X.distinct_ignoring_case(F.concat(F.array(category, geometry), F.transform(parts, lambda p: F.lower(F.replace(p, F.lit(" "), F.lit("_"))))))


def _any_word(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def first_rule(rules: list[tuple[Column, str | None, Column]]) -> Column:
    """struct(category, reason) of the first rule whose condition holds: an ordered decision table."""
    out = None
    for condition, category, reason in rules:
        value = F.struct(F.lit(category).cast("string").alias("category"), reason.alias("reason"))
        condition = F.coalesce(condition, F.lit(False))
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out


def line_class(source: Column, name: Column, metadata: Column) -> Column:
    """struct(category, reason) of a line: by its project type, then by facility class and state, then by words in its names.
    Files of a trail inventory are judged by project type and feature name alone.  category is null for what is no trail."""
    project = X.normalize(F.when(~_blank(meta(metadata, "Project_Type")), meta(metadata, "Project_Type")))
    hc, lc = (X.normalize_metadata(meta(metadata, f"{p}_Class")) for p in ("HC", "LC"))
    state = F.coalesce(*[X.normalize_metadata(meta(metadata, f"{p}_Status")) for p in ("HC", "LC")])
    own = X.normalize(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(meta(metadata, "Name"), F.lit(""))))
    inventory = F.contains(X.normalize(source), F.lit("trail plan inventory"))
    both = X.normalize(F.concat_ws(" ", source, own))
    return first_rule([
        (project.isin(BLOCKED_TRAIL_TYPES), None, F.concat(F.lit("blocked-project-type:"), project)),
        (project.isin(ALLOWED_TRAIL_TYPES) | _any_word(project, ["trail", "path", "greenway"]), "trail", F.concat(F.lit("project-type:"), project)),
        (inventory & _any_word(own, TRAIL_WORDS), "trail", F.lit("trail-plan-inventory-name-signal")),
        (inventory, None, F.lit("trail-plan-inventory-no-signal")),
        (hc.isin(BLOCKED_CLASSES), None, F.concat(F.lit("blocked-facility-class:"), hc)),
        (lc.isin(BLOCKED_CLASSES), None, F.concat(F.lit("blocked-facility-class:"), lc)),
        (F.coalesce(hc, lc).isin(OFF_STREET_CLASSES) & (state.isNull() | state.isin(FACILITY_STATES)), "trail", F.lit("authoritative-off-street-metadata")),
        (_any_word(both, TRAIL_WORDS), "trail", F.lit("name-or-source-signal")),
        (F.lit(True), None, F.lit("no-supported-category-signal")),
    ])


def point_class(source: Column, name: Column, metadata: Column) -> Column:
    """transit, park, trail or null."""
    file, own = X.normalize(source), X.normalize(name)
    keyed = F.exists(F.map_keys(metadata), lambda k: F.lower(k).isin("station", "station_code"))
    return F.when(F.contains(file, F.lit("marta")) | F.contains(own, F.lit("station")) | keyed, "transit").when(F.contains(file, F.lit("park")), "park").when(_any_word(file, TRAIL_WORDS) | _any_word(own, TRAIL_WORDS), "trail")


def linear_corridor(area: Column, around: Column, min_trail_miles: float) -> Column:
    """Whether an area is long and narrow: by the rectangle of its area and perimeter."""
    length, width = G.rectangle_sides(area, around)
    return (area > 0) & (around > 0) & (width > 0) & (length >= min_trail_miles * FEET_PER_MILE) & (width <= CORRIDOR_WIDTH_FEET) & (length >= CORRIDOR_ASPECT * width)


def keep_park(polygons: Column, min_square_feet: float, min_trail_miles: float) -> Column:
    """Whether the polygons of a placemark are together large enough, or a linear corridor."""
    area = F.aggregate(F.transform(polygons, lambda p: G.polygon_area(p)), F.lit(0.0), lambda a, x: a + x)
    around = F.aggregate(F.transform(polygons, lambda p: G.perimeter(p)), F.lit(0.0), lambda a, x: a + x)
    return (area >= min_square_feet) | F.coalesce(linear_corridor(area, around, min_trail_miles), F.lit(False))


def _ring_points(ring: Column, spacing: float) -> Column:
    return F.when(F.size(ring) > 2, G.densify(G.closed(ring), spacing)).otherwise(ring)


def extract(placemarks: DataFrame, min_square_feet: float, min_trail_miles: float, spacing_feet: float) -> DataFrame:
    """One row for each kept geometry of a placemark: (source_file, placemark_index, name, category, geometry, kind, metadata,
    n_points, points, lines, polygons, dense).

    geometry is the kind written into ids and types (polygon-densified-edge, point, line), kind that of the feature (polygon,
    point, linestring); dense are the points along it at most spacing_feet apart, the first of those equal to seven decimals.
    Polygons are parks; if they are too small, all of the placemark is dropped.  Points are kept if they are of no park or trail;
    if they are, the placemark's lines are dropped as well.  Lines are flattened before they are measured."""
    m = F.col("metadata")
    p = placemarks.withColumn("feature", feature_name(F.col("name"), m, F.col("source_file")))
    p = p.withColumn("_areas", F.filter("polygons", lambda r: F.size(r) > 0)).withColumn("_kind", point_class(F.col("source_file"), F.col("feature"), m))
    p = p.withColumn("_large", (F.size("_areas") > 0) & keep_park(F.col("_areas"), min_square_feet, min_trail_miles))
    alive = (F.size("_areas") == 0) | F.col("_large")
    has_points = (F.size("points") > 0) & F.col("_kind").isNotNull()
    p = p.withColumn("_place", alive & has_points & (F.col("_kind") == "transit")).withColumn("_line", F.flatten("lines"))
    p = p.withColumn("_class", line_class(F.col("source_file"), F.col("feature"), m))
    long = alive & ~F.coalesce(has_points & (F.col("_kind") != "transit"), F.lit(False)) & (F.size("_line") > 0) & (F.col("_class")["category"] == "trail")
    p = p.withColumn("_trail", long & (G.line_length(F.col("_line")) >= min_trail_miles * FEET_PER_MILE))
    coord = "array<struct<latitude:double,longitude:double>>"
    no_points, no_lines, no_areas = F.array().cast(coord), F.array().cast(f"array<{coord}>"), F.array().cast(f"array<array<{coord}>>")

    def one(category: Column, geometry: str, kind: str, n: Column, points: Column, lines: Column, areas: Column, dense: Column) -> Column:
        return F.struct(category.alias("category"), F.lit(geometry).alias("geometry"), F.lit(kind).alias("kind"), n.alias("n_points"), points.alias("points"), lines.alias("lines"), areas.alias("polygons"), dense.alias("dense"))

    count = F.aggregate(F.transform("_areas", lambda a: F.aggregate(F.transform(a, lambda r: F.size(r)), F.lit(0), lambda s, x: s + x)), F.lit(0), lambda s, x: s + x)
    edge = F.flatten(F.transform("_areas", lambda a: G.distinct_points(F.flatten(F.transform(a, lambda r: _ring_points(r, spacing_feet))))))
    kept = F.array(
        F.when(F.col("_large"), one(F.lit("park"), "polygon-densified-edge", "polygon", count, no_points, no_lines, F.col("_areas"), edge)),
        F.when(F.col("_place"), one(F.col("_kind"), "point", "point", F.size("points"), F.col("points"), no_lines, no_areas, F.col("points"))),
        F.when(F.col("_trail"), one(F.lit("trail"), "line", "linestring", F.size("_line"), no_points, F.filter("lines", lambda x: F.size(x) > 1), no_areas, G.distinct_points(G.densify(F.col("_line"), spacing_feet)))),
    )
    return p.select("source_file", "placemark_index", F.col("feature").alias("name"), "metadata", F.explode(F.array_compact(kept)).alias("g")).select("source_file", "placemark_index", "name", "metadata", "g.*")


def place_records(extracted: DataFrame) -> DataFrame:
    """One place record for each dense point: query, category, placeId, name, formattedAddress, position, types, searchNames."""
    e = extracted.withColumn("_query", F.when(_blank(F.col("name")), F.col("source_file")).otherwise(F.col("name"))).select("*", F.posexplode("dense").alias("_pos", "_at"))
    return e.select(
        F.col("_query").alias("query"), "category", X.place_hash(F.col("source_file"), F.col("placemark_index").cast("string"), F.col("geometry"), F.col("_pos").cast("string")).alias("placeId"), F.col("_query").alias("name"),
        address_hint(F.col("source_file"), F.col("metadata")).alias("formattedAddress"), F.col("_at.latitude").alias("latitude"), F.col("_at.longitude").alias("longitude"),
        types_of(F.col("category"), F.col("geometry"), meta(F.col("metadata"), "Project_Type")).alias("types"), F.lit("arc").alias("sourceQueryType"), search_names(F.col("name"), F.col("metadata")).alias("searchNames"),
    )


def geometry_features(extracted: DataFrame) -> DataFrame:
    """(category, label, geometryType, points, lines, polygons) of the true geometries."""
    return extracted.select("category", F.col("name").alias("label"), F.col("kind").alias("geometryType"), "points", "lines", "polygons")


def feature_summary(extracted: DataFrame) -> DataFrame:
    """(source_file, name, category, geometry_type, n_points, metadata), one row a kept geometry."""
    return extracted.where((F.col("kind") != "polygon") | (F.size("dense") > 0)).select("source_file", "name", "category", F.when(F.col("kind") == "linestring", "line").otherwise(F.col("kind")).alias("geometry_type"), "n_points", "metadata")


def split(rows: DataFrame, categories: list[str], column: str = "category") -> dict[str, DataFrame]:
    """The rows of each named category, ignoring case."""
    return {c: rows.where(F.lower(column) == c.lower()) for c in categories}
