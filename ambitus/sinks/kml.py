"""KML documents from features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambitus.functions.text import xml_escape

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
TAIL = "</Document></kml>"


def _pair(c: Column) -> Column:
    return F.concat_ws(",", c["longitude"].cast("string"), c["latitude"].cast("string"))


def coordinates(points: Column) -> Column:
    return F.concat(F.lit("<coordinates>"), F.concat_ws(" ", F.transform(points, _pair)), F.lit("</coordinates>"))


def ring(points: Column) -> Column:
    return F.concat(F.lit("<LinearRing>"), coordinates(points), F.lit("</LinearRing>"))


def placemark(name: Column, points: Column, kind: Column, holes: Column | None = None) -> Column:
    """One placemark; kind is point, linestring or polygon (points is then the outer ring, holes an array of inner rings)."""
    inner = F.lit("") if holes is None else F.coalesce(F.array_join(F.transform(holes, lambda h: F.concat(F.lit("<innerBoundaryIs>"), ring(h), F.lit("</innerBoundaryIs>"))), ""), F.lit(""))
    body = F.when(kind == "point", F.concat(F.lit("<Point>"), coordinates(F.slice(points, 1, 1)), F.lit("</Point>"))).when(kind == "linestring", F.concat(F.lit("<LineString>"), coordinates(points), F.lit("</LineString>"))).otherwise(F.concat(F.lit("<Polygon><outerBoundaryIs>"), ring(points), F.lit("</outerBoundaryIs>"), inner, F.lit("</Polygon>")))
    return F.concat(F.lit("<Placemark><name>"), xml_escape(F.coalesce(name, F.lit(""))), F.lit("</name>"), body, F.lit("</Placemark>"))


def result_documents(areas: DataFrame, features: DataFrame, categories: list[str] = ()) -> DataFrame:
    """(group_key, document): the result of each group: a folder Intersection with its polygons, numbered from 1 and named after
    the categories, and a folder Source Features with one folder for each category, in the order of its name.

    areas: of ``overlay.overlay_groups``; features: group_key, category, label, points, lines, polygons.  A group with features
    but without an area has an empty first folder.  One document is one text by its format: a group is a tile or a request."""
    n = F.row_number().over(Window.partitionBy("group_key").orderBy("polygon_no"))
    marks = areas.withColumn("_n", n).withColumn("_x", placemark(F.concat(F.lit("Intersection "), F.col("_n").cast("string")), F.col("outer"), F.lit("polygon"), F.col("holes")))
    first = marks.groupBy("group_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_x"))), lambda r: r["_x"]), "").alias("_first"))
    label = F.coalesce("label", F.lit(""))
    shapes = F.concat(
        F.transform("points", lambda p: placemark(label, F.array(p), F.lit("point"))),
        F.transform("lines", lambda x: placemark(label, x, F.lit("linestring"))),
        F.transform("polygons", lambda q: placemark(label, q[0], F.lit("polygon"), F.slice(q, 2, F.greatest(F.size(q) - 1, F.lit(0))))),
    )
    own = features.select("group_key", F.coalesce("category", F.lit("")).alias("_c"), F.array_join(shapes, "").alias("_x"))
    folder = own.groupBy("group_key", "_c").agg(F.array_join(F.array_sort(F.collect_list("_x")), "").alias("_x"))
    folder = folder.withColumn("_x", F.concat(F.lit("<Folder><name>"), xml_escape(F.col("_c")), F.lit("</name>"), "_x", F.lit("</Folder>")))
    second = folder.groupBy("group_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_c", "_x"))), lambda r: r["_x"]), "").alias("_second"))
    rows = second.join(first, "group_key", "full")
    body = F.concat(F.lit("<Folder><name>Intersection</name>"), F.coalesce("_first", F.lit("")), F.lit("</Folder><Folder><name>Source Features</name>"), F.coalesce("_second", F.lit("")), F.lit("</Folder>"))
    return rows.select("group_key", F.concat(F.lit(HEAD), body, F.lit(TAIL)).alias("document"))


def documents(features: DataFrame, key: str, per_document: int = 10_000, n_rows: int | None = None) -> DataFrame:
    """(source_file, document): features (name, category, points, kind, and holes if there is such a column) as
    documents with one folder per category.

    A document holds about per_document placemarks at most: rows are spread over parts by a hash of ``key``, so that a category
    of any size is written in parallel."""
    parts = max(1, -(-(n_rows if n_rows is not None else features.count()) // per_document))
    rows = features.select(F.coalesce(F.trim("category"), F.lit("")).alias("c"), F.pmod(F.xxhash64(key), F.lit(parts)).alias("p"), F.col(key).alias("k"), placemark(F.col("name"), F.col("points"), F.col("kind"), F.col("holes") if "holes" in features.columns else None).alias("x"))
    folders = rows.groupBy("p", "c").agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda r: r["x"])).alias("x"))
    folders = folders.withColumn("x", F.concat(F.lit("<Folder><name>"), xml_escape(F.col("c")), F.lit("</name>"), F.col("x"), F.lit("</Folder>")))
    out = folders.groupBy("p").agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("c", "x"))), lambda r: r["x"])).alias("x"))
    return out.select(F.format_string("part-%05d.kml", "p").alias("source_file"), F.concat(F.lit(HEAD), "x", F.lit(TAIL)).alias("document"))
