"""Coverage requests: reading, checking, assembling and writing them, and answering one."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions.geo import MILES_PER_DEGREE
from ambitus.operators import overlay
from ambitus.operators.places import map_categories, with_radius
from ambitus.sinks import kml

COORD = "struct<latitude:double,longitude:double>"
FEATURE = f"struct<category:string,label:string,geometryType:string,points:array<{COORD}>,lines:array<struct<coordinates:array<{COORD}>>>,polygons:array<struct<outerRing:array<{COORD}>,innerRings:array<array<{COORD}>>>>>"
REQUEST = f"locations array<struct<latitude:double,longitude:double,category:string,label:string>>, features array<{FEATURE}>, step double, radiusMiles double, categoryRadiusMiles map<string,double>, paddingDegrees double"


class InvalidRequest(ValueError):
    """What is wrong with a request, one sentence a fault."""


@dataclass
class CategoryConfig:
    """Which categories count, what they are grouped to and how far they reach."""

    default_radius: float = 0.5
    include: list[str] = field(default_factory=list)
    radii: dict[str, float] = field(default_factory=dict)
    groups: dict[str, str] = field(default_factory=dict)
    min_park_square_feet: float = 0.0
    min_trail_miles: float = 0.0

    @classmethod
    def from_json(cls, text: str) -> CategoryConfig:
        """Blank names are left out, others trimmed; a category with two radii, ignoring case, is an error."""
        d = json.loads(text)
        radii: dict[str, float] = {}
        for k, v in (d.get("categoryRadiusMiles") or {}).items():
            if k.strip():
                if k.strip().lower() in radii:
                    raise InvalidRequest(f"two radii for the category {k.strip()}")
                radii[k.strip().lower()] = float(v)
        groups = {s.strip().lower(): g["targetCategory"].strip().lower() for g in d.get("categoryGroups") or [] if (g.get("targetCategory") or "").strip() for s in g.get("sourceCategories") or [] if s.strip()}
        include = [c.strip().lower() for c in d.get("includedCategories") or [] if c.strip()]
        return cls(float(d.get("defaultRadiusMiles", 0.5)), include, radii, groups, float(d.get("minimumParkSquareFeet", 0)), float(d.get("minimumTrailMiles", 0)))

    def group_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.groups.items()), "source string, target string")

    def radius_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.radii.items()), "category string, radius_miles double")


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def flat_feature(f: Column) -> list[Column]:
    """The columns of a feature: category, label, geometryType in lower case, points, lines and polygons (a polygon is an array of
    rings, the first the outer one), missing lists empty."""
    lines = F.transform(_list(f["lines"], f"array<struct<coordinates:array<{COORD}>>>"), lambda x: _list(x["coordinates"], f"array<{COORD}>"))
    rings = F.transform(_list(f["polygons"], f"array<struct<outerRing:array<{COORD}>,innerRings:array<array<{COORD}>>>>"), lambda p: F.concat(F.array(_list(p["outerRing"], f"array<{COORD}>")), _list(p["innerRings"], f"array<array<{COORD}>>")))
    return [f["category"].alias("category"), f["label"].alias("label"), F.lower(f["geometryType"]).alias("geometryType"), _list(f["points"], f"array<{COORD}>").alias("points"), lines.alias("lines"), rings.alias("polygons")]


def read_requests(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, request): JSON documents as requests; a text that is no JSON object gives a null request."""
    return documents.select(F.col(key), F.from_json(F.col(text), REQUEST).alias("request"))


def request_features(requests: DataFrame, key: str) -> DataFrame:
    """(key, category, label, geometryType, points, lines, polygons): the features of each request, or, where it has none, its
    locations as point features."""
    own = F.transform(_list(F.col("request.locations"), "array<struct<latitude:double,longitude:double,category:string,label:string>>"), location_feature)
    features = F.col("request.features")
    chosen = F.when(F.coalesce(F.size(features), F.lit(0)) > 0, features).otherwise(own)
    return requests.select(F.col(key), F.explode(chosen).alias("f")).select(F.col(key), *flat_feature(F.col("f")))


def location_feature(x: Column) -> Column:
    """A location as the struct of a point feature."""
    at = F.array(F.struct(x["latitude"].alias("latitude"), x["longitude"].alias("longitude")))
    return F.struct(x["category"].alias("category"), x["label"].alias("label"), F.lit("point").alias("geometryType"), at.alias("points"), F.array().cast(f"array<struct<coordinates:array<{COORD}>>>").alias("lines"), F.array().cast(f"array<struct<outerRing:array<{COORD}>,innerRings:array<array<{COORD}>>>>").alias("polygons"))


def coordinates(df_points: Column, lines: Column, polygons: Column) -> Column:
    """All coordinates of a feature: points, then lines, then the rings of each polygon, the outer one first."""
    return F.concat(df_points, F.flatten(lines), F.flatten(F.flatten(polygons)))


def record_features(records: DataFrame, config: CategoryConfig, label: str = "name") -> DataFrame:
    """Place records as point features of their grouped category; only included categories."""
    r = map_categories(records, config.group_table(records.sparkSession), config.include)
    at = F.array(F.struct(F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude")))
    none = F.array().cast(f"array<array<{COORD}>>")
    return r.select(F.col("category_key").alias("category"), F.col(label).alias("label"), F.lit("point").alias("geometryType"), at.alias("points"), none.alias("lines"), F.array().cast(f"array<array<array<{COORD}>>>").alias("polygons"))


def grouped_features(features: DataFrame, config: CategoryConfig) -> DataFrame:
    """Geometry features under their grouped category; only included categories."""
    f = map_categories(features, config.group_table(features.sparkSession), config.include)
    return f.withColumn("category", F.col("category_key")).drop("category_key", "grouped_from")


def distinct_features(features: DataFrame) -> DataFrame:
    """One of the features that are equal in every field; the columns stay as they are."""
    return features.groupBy(F.to_json(F.struct(*features.columns), {"ignoreNullFields": "false"}).alias("_j")).agg(F.min(F.struct(*features.columns)).alias("_f")).select("_f.*")


def assemble(records: list[DataFrame], features: list[DataFrame], config: CategoryConfig) -> DataFrame:
    """All place records and geometry features of several inputs as one set of distinct features."""
    parts = [record_features(r, config) for r in records] + [grouped_features(f, config) for f in features]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return distinct_features(out)


def feature_json(columns: list[str] = ("category", "label", "geometryType", "points", "lines", "polygons")) -> Column:
    """A feature row as the JSON of a request's feature."""
    lines = F.transform("lines", lambda x: F.struct(x.alias("coordinates")))
    rings = F.transform("polygons", lambda p: F.struct(p[0].alias("outerRing"), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))).alias("innerRings")))
    return F.to_json(F.struct("category", "label", "geometryType", "points", lines.alias("lines"), rings.alias("polygons")))


def request_documents(features: DataFrame, key: str, config: CategoryConfig, step: float = 1e-4, padding: float = 0.01) -> DataFrame:
    """(key, document): one request document for each key, features in order of their JSON.  A document is one text by its
    format; key is what keeps it within bounds (a tile, an area)."""
    tail = json.dumps({"step": step, "radiusMiles": config.default_radius, "categoryRadiusMiles": config.radii, "paddingDegrees": padding})[1:]
    rows = features.select(F.col(key).alias("_key"), feature_json().alias("_j")).groupBy("_key").agg(F.array_join(F.array_sort(F.collect_list("_j")), ",").alias("_js"))
    return rows.select(F.col("_key").alias(key), F.concat(F.lit('{"locations":[],"features":['), "_js", F.lit("],"), F.lit(tail)).alias("document"))


def first_casing(features: DataFrame, order: list[Column]) -> DataFrame:
    """(category_key, category, n): categories ignoring case, written as in the first row of each, with their number of features."""
    key = F.lower(F.trim("category"))
    return features.groupBy(key.alias("category_key")).agg(F.min_by("category", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("category"), F.count("*").alias("n"))


def feature_bounds(c: Column) -> list[Column]:
    """south, north, west, east of an array of coordinates."""
    lat, lon = F.transform(c, lambda x: x["latitude"]), F.transform(c, lambda x: x["longitude"])
    return [F.array_min(lat).alias("south"), F.array_max(lat).alias("north"), F.array_min(lon).alias("west"), F.array_max(lon).alias("east")]


def bounds(features: DataFrame, key: str | None = None) -> DataFrame:
    """(key, south, north, west, east, lat0, lon0): the box around all features of each key, and its middle."""
    b = features.select(*([F.col(key)] if key else []), *feature_bounds(coordinates(F.col("points"), F.col("lines"), F.col("polygons"))))
    b = b.groupBy(*([key] if key else [])).agg(F.min("south").alias("south"), F.max("north").alias("north"), F.min("west").alias("west"), F.max("east").alias("east"))
    return b.withColumn("lat0", (F.col("south") + F.col("north")) / 2).withColumn("lon0", (F.col("west") + F.col("east")) / 2)


def padded_bounds(features: DataFrame, key: str, radius: str = "radius_miles", padding: float = 0.01) -> DataFrame:
    """(key, south, north, west, east): the box around the features, wider by the largest radius / 69 degrees and the padding."""
    pad = features.groupBy(key).agg((F.max(radius) / MILES_PER_DEGREE + padding).alias("_pad"))
    b = bounds(features, key).join(pad, key)
    return b.select(key, (F.col("south") - F.col("_pad")).alias("south"), (F.col("north") + F.col("_pad")).alias("north"), (F.col("west") - F.col("_pad")).alias("west"), (F.col("east") + F.col("_pad")).alias("east"))


def in_bounds(lat: Column, lon: Column, south: Column, north: Column, west: Column, east: Column) -> Column:
    """Whether a position lies in a closed box."""
    return lat.between(south, north) & lon.between(west, east)


def faults(features: DataFrame) -> DataFrame:
    """(fault, n): what is wrong with features, and how many have it: no category, no label, an unknown kind of geometry, no
    coordinate of the kind, a coordinate out of range."""
    c = coordinates(F.col("points"), F.col("lines"), F.col("polygons"))
    kind = F.col("geometryType")
    own = F.when(kind == "point", F.size("points")).when(kind == "linestring", F.size(F.flatten("lines"))).when(kind == "polygon", F.size(F.flatten(F.flatten("polygons"))))
    far = F.exists(c, lambda x: ~F.coalesce(x["latitude"].between(-90, 90) & x["longitude"].between(-180, 180), F.lit(False)))
    checks = {
        "category missing": F.coalesce(F.trim("category") == "", F.lit(True)), "label missing": F.coalesce(F.trim("label") == "", F.lit(True)),
        "unknown geometry type": ~F.coalesce(kind.isin("point", "linestring", "polygon"), F.lit(False)), "no coordinates": F.coalesce(own == 0, F.lit(False)), "coordinate out of range": far,
    }
    found = features.select(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()])).alias("f"))
    return found.select(F.explode("f").alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


def check_request(features: DataFrame, step: float, radius_miles: float, radii: dict[str, float], padding: float) -> None:
    """Raises InvalidRequest naming all faults."""
    wrong = [f"{r['fault']}: {r['n']} features" for r in faults(features).orderBy("fault").collect()]  # at most five rows
    wrong += ["step must be greater than zero"] * (not step > 0) + ["radius must be greater than zero"] * (not radius_miles > 0) + ["padding must not be negative"] * (not padding >= 0)
    wrong += [f"radius of {c} must be greater than zero" for c, r in radii.items() if not r > 0]
    if features.isEmpty():
        wrong.append("there are no features")
    if wrong:
        raise InvalidRequest("; ".join(wrong))


def answer(spark: SparkSession, document: str, name: str = "outline.kml") -> dict:
    """Answers one request document: {kml, intersectionPolygonCount, coveredCellCount, featureCount, bounds, fileName}.

    The result is one document for one area, so it comes to the driver; many areas at once go through ``overlay.overlay_groups``
    and the writers of ``sinks.kml``.  A request that is no JSON object or has faults raises InvalidRequest."""
    try:
        body = json.loads(document)
    except ValueError as e:
        raise InvalidRequest("the request is no JSON") from e
    if not isinstance(body, dict):
        raise InvalidRequest("the request is no JSON object")
    radii = {k.lower(): float(v) for k, v in (body.get("categoryRadiusMiles") or {}).items()}
    radius, step, padding = float(body.get("radiusMiles", 0.5)), float(body.get("step", 1e-4)), float(body.get("paddingDegrees", 0.01))
    requests = read_requests(spark.createDataFrame([("request", document)], "id string, text string"), "id", "text")
    f = request_features(requests, "id").cache()
    try:
        check_request(f, step, radius, radii, padding)
        config = CategoryConfig(radius, radii=radii)
        placed = with_radius(f, config.radius_table(spark), radius)
        categories = [r[0] for r in f.select(F.lower(F.trim("category")).alias("c")).distinct().orderBy("c").collect()]
        areas = overlay.overlay_groups(placed, "id", categories).cache()
        doc = kml.result_documents(areas, f.withColumnRenamed("id", "group_key"), categories).first()
        n = areas.count()
        box = padded_bounds(placed, "id", padding=padding).first()
        areas.unpersist()
        return {"kml": doc["document"], "intersectionPolygonCount": n, "coveredCellCount": n, "featureCount": f.count(), "bounds": {k: box[k] for k in ("south", "north", "west", "east")}, "fileName": name}
    finally:
        f.unpersist()


def result_json(areas: DataFrame, boxes: DataFrame, counts: DataFrame) -> DataFrame:
    """(group_key, document): the result of each group as JSON: its counts, its bounds and its polygons with holes.

    areas: of ``overlay.overlay_groups``; boxes: (group_key, south, north, west, east); counts: (group_key, n_features)."""
    polygon = F.struct("polygon_no", F.col("outer").alias("outerRing"), F.col("holes").alias("innerRings"))
    own = areas.groupBy("group_key").agg(F.array_sort(F.collect_list(polygon)).alias("polygons"))
    rows = boxes.join(own, "group_key", "left").join(counts, "group_key", "left")
    empty = F.array().cast(own.schema["polygons"].dataType)
    polygons = F.transform(F.coalesce("polygons", empty), lambda p: F.struct(p["outerRing"].alias("outerRing"), p["innerRings"].alias("innerRings")))
    box = F.struct(F.col("south").alias("minLatitude"), F.col("north").alias("maxLatitude"), F.col("west").alias("minLongitude"), F.col("east").alias("maxLongitude"))
    out = F.struct(F.coalesce("n_features", F.lit(0)).alias("featureCount"), F.size(polygons).alias("intersectionPolygonCount"), F.size(polygons).alias("coveredCellCount"), box.alias("bounds"), polygons.alias("polygons"))
    return rows.select("group_key", F.to_json(out).alias("document"))
