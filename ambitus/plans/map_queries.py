"""Queries of the map document, overlay and nested JSON operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambitus.functions.shapes import coord
from ambitus.operators import overlay, tiles
from ambitus.sinks import kml as kml_sink
from ambitus.session import read
from ambitus.sources import kml as kml_source
from ambitus.sources.places import harvest

from .place_queries import GRID, N, W, _placed


def kml_roundtrip(spark, d):
    """Locations written as KML documents and read back."""
    loc = read(spark, d, "locations").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).distinct()
    f = loc.select("location_id", F.concat_ws(" ", F.col("location_id").cast("string"), F.lit("<&>"), "label").alias("name"), "category", F.array(coord(F.col("latitude"), F.col("longitude"))).alias("points"), F.lit("point").alias("kind"))
    docs = kml_sink.documents(f, "location_id", 2000)
    back = kml_source.placemarks(docs.select("source_file", F.col("document").cast("binary").alias("content")))
    return back.select("folder", "name", F.col("points")[0]["latitude"].alias("latitude"), F.col("points")[0]["longitude"].alias("longitude"))


def overlay_tiles(spark, d):
    """Areas where all five kinds of places are within their radii, by tile."""
    p = _placed(spark, d)
    grid = tiles.tiles(spark, *GRID)
    a = tiles.assign(p, grid, N, W, GRID[4], GRID[5], "place_id").join(p.select("place_id", "radius_miles", F.array(coord(F.col("latitude"), F.col("longitude"))).alias("points")), "place_id")
    out = overlay.overlay_groups(a.withColumnRenamed("category_key", "category"), "name", ["building", "automobile", "machinery", "household", "furniture"])
    return out.groupBy("group_key").agg(F.count("*").alias("n_polygons"), F.round(F.sum("square_meters"), 0).alias("square_meters"))


def json_harvest(spark, d):
    """Entries found in nested arrays made of the locations."""
    loc = read(spark, d, "locations").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("label").isNotNull()).select("location_id", "label", "latitude", "longitude").distinct()
    inner = F.to_json(F.struct(F.col("label").alias("a")))
    title = F.regexp_extract(inner, r'^\{"a":(.*)\}$', 1)
    text = F.concat(F.lit(")]}'\n[[\"x\",["), F.lit("["), title, F.lit(',"'), F.col("location_id").cast("string"), F.lit('",[null,null,'), F.col("latitude").cast("string"), F.lit(","), F.col("longitude").cast("string"), F.lit("]]]]]"))
    return harvest(loc.select(F.col("location_id").alias("doc"), text.alias("t")), "t").select("doc", "title", "latitude", "longitude")


def result_json(spark, d):
    """Tile results as nested JSON text."""
    from .place_queries import tile_status

    return tile_status(spark, d).select("name", F.to_json(F.struct("row", "col", F.col("point_count").alias("pointCount"), "complete")).alias("json"))


QUERIES = {f.__name__: f for f in (kml_roundtrip, overlay_tiles, json_harvest, result_json)}
SQL = {
    "kml_roundtrip": "SELECT category AS folder, location_id || ' <&>' || coalesce(' ' || trim(label), '') AS name, latitude, longitude FROM (SELECT DISTINCT * FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
    "json_harvest": "SELECT location_id AS doc, label AS title, latitude, longitude FROM (SELECT DISTINCT location_id, label, latitude, longitude FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND label IS NOT NULL)",
}
