"""Queries of the general data operators (snapshots, nearness) over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions.geo import is_position
from ambitus.operators.near import points_in_regions, points_near_points
from ambitus.operators.snapshots import diff_snapshots
from ambitus.session import read


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added, removed and changed placeIds of each list's complete deliveries."""
    out = diff_snapshots(
        read(spark, sf_dir, "gyms_snapshots"), "list_name", "snapshot_no", "placeId",
        values=["name", "formattedAddress", "sourceQueryType"], sets=["types", "searchNames"], numbers=["latitude", "longitude"],
        expected=read(spark, sf_dir, "cleanup_summary"), expected_count="beforeCount",
    )
    return out.select("list_name", F.col("snapshot_no").cast("long").alias("snapshot_no"), "placeId", "change_kind")


def p3_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys of each kind each delivery changed."""
    return p3_found(spark, sf_dir).groupBy("list_name", "snapshot_no", "change_kind").agg(F.count("*").alias("n"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gym records and the points of other categories within each category's radius."""
    radii = read(spark, sf_dir, "category_radii").select(F.lower(F.trim("category")).alias("_c"), "radius_miles").dropDuplicates(["_c"])
    targets = read(spark, sf_dir, "locations").withColumn("_c", F.lower(F.trim("category"))).join(radii, "_c")
    return points_near_points(read(spark, sf_dir, "gyms_master"), targets, "record_id", "location_id", "radius_miles")


def p5_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of locations inside triangular half-degree tiles: the region form of the join, counted by tile."""
    pts = read(spark, sf_dir, "locations")
    cells = pts.where(is_position("latitude", "longitude")).select(F.floor(F.col("latitude") * 2).cast("long").alias("i"), F.floor(F.col("longitude") * 2).cast("long").alias("j")).distinct()

    def corner(di: float, dj: float):
        return F.struct(((F.col("i") + di) / 2.0).alias("latitude"), ((F.col("j") + dj) / 2.0).alias("longitude"))

    areas = cells.select(F.concat_ws("_", "i", "j").alias("tile"), F.array(F.array(corner(0.001, 0.001), corner(0.001, 0.999), corner(0.999, 0.001))).alias("rings"))
    return points_in_regions(pts, areas, "location_id", "tile", "rings").groupBy("tile").agg(F.count("*").alias("n"))


QUERIES = {"p3_found": p3_found, "p3_change_counts": p3_change_counts, "p5_found": p5_found, "p5_tiles": p5_tiles}

_P3 = """
WITH s AS (SELECT DISTINCT list_name, snapshot_no, placeId, name, formattedAddress, sourceQueryType, round(latitude, 9) la, round(longitude, 9) lo,
             list_sort(list_distinct(coalesce(types, []))) ty, list_sort(list_distinct(coalesce(searchNames, []))) sn
           FROM gyms_snapshots WHERE placeId IS NOT NULL),
n AS (SELECT list_name, snapshot_no, count(DISTINCT placeId) k FROM s GROUP BY ALL),
e AS (SELECT list_name, snapshot_no, max(beforeCount) b FROM cleanup_summary GROUP BY ALL),
d AS (SELECT list_name, snapshot_no, lag(snapshot_no) OVER (PARTITION BY list_name ORDER BY snapshot_no) p
      FROM n LEFT JOIN e USING (list_name, snapshot_no) WHERE k >= coalesce(b, 0)),
cur AS (SELECT s.*, d.p FROM s JOIN d USING (list_name, snapshot_no) WHERE d.p IS NOT NULL),
old AS (SELECT s.*, d.snapshot_no AS nxt FROM s JOIN d ON d.list_name = s.list_name AND d.p = s.snapshot_no),
r AS (
SELECT c.list_name, CAST(c.snapshot_no AS BIGINT) snapshot_no, c.placeId, CASE WHEN o.placeId IS NULL THEN 'added' ELSE 'changed' END change_kind
FROM cur c LEFT JOIN old o ON o.list_name = c.list_name AND o.nxt = c.snapshot_no AND o.placeId = c.placeId
WHERE o.placeId IS NULL OR c.name IS DISTINCT FROM o.name OR c.formattedAddress IS DISTINCT FROM o.formattedAddress
   OR c.sourceQueryType IS DISTINCT FROM o.sourceQueryType OR c.ty IS DISTINCT FROM o.ty OR c.sn IS DISTINCT FROM o.sn
   OR (c.la IS NULL) <> (o.la IS NULL) OR (c.lo IS NULL) <> (o.lo IS NULL)
   OR round(abs(c.la - o.la), 12) >= 1e-7 OR round(abs(c.lo - o.lo), 12) >= 1e-7
UNION
SELECT o.list_name, CAST(o.nxt AS BIGINT), o.placeId, 'removed'
FROM old o LEFT JOIN cur c ON o.list_name = c.list_name AND o.nxt = c.snapshot_no AND o.placeId = c.placeId WHERE c.placeId IS NULL)
"""
_VALID = "{a}.latitude BETWEEN -90 AND 90 AND {a}.longitude BETWEEN -180 AND 180 AND NOT ({a}.latitude = 0 AND {a}.longitude = 0)"
SQL = {
    "p3_found": _P3 + "SELECT DISTINCT * FROM r",
    "p3_change_counts": _P3 + "SELECT list_name, snapshot_no, change_kind, count(*) n FROM (SELECT DISTINCT * FROM r) GROUP BY ALL",
    "p5_found": f"""
WITH g AS (SELECT DISTINCT record_id, latitude, longitude FROM gyms_master g WHERE {_VALID.format(a="g")}),
l AS (SELECT DISTINCT location_id, latitude, longitude, radius_miles FROM locations l JOIN category_radii c ON lower(trim(l.category)) = lower(trim(c.category)) WHERE {_VALID.format(a="l")})
SELECT DISTINCT record_id, location_id FROM g JOIN l ON l.latitude BETWEEN g.latitude - radius_miles / 69.0 AND g.latitude + radius_miles / 69.0
WHERE 2 * 3958.7613 * asin(sqrt(least(1, pow(sin(radians(l.latitude - g.latitude) / 2), 2)
      + cos(radians(g.latitude)) * cos(radians(l.latitude)) * pow(sin(radians(l.longitude - g.longitude) / 2), 2)))) <= radius_miles""",
    "p5_tiles": f"""
WITH p AS (SELECT DISTINCT location_id, latitude, longitude FROM locations l WHERE {_VALID.format(a="l")}),
q AS (SELECT *, CAST(floor(latitude * 2) AS BIGINT) i, CAST(floor(longitude * 2) AS BIGINT) j, latitude * 2 - floor(latitude * 2) u, longitude * 2 - floor(longitude * 2) v FROM p)
SELECT i || '_' || j AS tile, count(*) n FROM q WHERE u > 0.001 AND v > 0.001 AND u + v < 1.0 GROUP BY ALL""",
}
