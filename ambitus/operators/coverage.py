"""Where every required category is within its radius: grid cells, runs and rectangles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambitus.functions.geo import FEET_PER_DEGREE, FEET_PER_MILE


def coverage_cells(features: DataFrame, south: float, west: float, north: float, east: float, step: float, required: int | None = None) -> DataFrame:
    """(row, col): cells of a grid whose centre lies within radius_miles of at least one feature of every category.

    features: latitude, longitude, category, radius_miles.  Each feature names the cells inside its own circle, so features and
    cells are never joined: the work is the cells near features.  (cell, category) is de-duplicated before the shuffle.  required
    is the number of categories, by default all that occur.  Distances are planar in feet around the middle of the bounds."""
    rows, cols = round((north - south) / step), round((east - west) / step)
    lat0 = (south + north) / 2
    fx = F.lit(FEET_PER_DEGREE) * F.cos(F.radians(F.lit(lat0)))
    f = features.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("radius_miles") >= 0))
    f = f.select(F.lower(F.trim("category")).alias("category_key"), "latitude", "longitude", (F.col("radius_miles") * FEET_PER_MILE).alias("_r")).distinct()
    dy, dx = F.col("_r") / FEET_PER_DEGREE, F.col("_r") / fx

    def span(at, reach, origin, n):
        lo = F.greatest(F.floor((at - reach - origin) / step).cast("int") - 1, F.lit(0))
        hi = F.least(F.ceil((at + reach - origin) / step).cast("int") + 1, F.lit(n - 1))
        return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi)))

    hit = f.withColumn("row", F.explode(span(F.col("latitude"), dy, south, rows))).withColumn("col", F.explode(span(F.col("longitude"), dx, west, cols)))
    y = (F.lit(south) + (F.col("row") + 0.5) * step - F.col("latitude")) * FEET_PER_DEGREE
    x = (F.lit(west) + (F.col("col") + 0.5) * step - F.col("longitude")) * fx
    near = hit.where(F.sqrt(x * x + y * y) <= F.col("_r")).select("row", "col", "category_key").distinct()
    if required is None:
        need = features.where(F.col("category").isNotNull()).select(F.lower(F.trim("category")).alias("c")).agg(F.count_distinct("c").alias("_need"))
        counted = near.groupBy("row", "col").agg(F.count("*").alias("_n")).crossJoin(F.broadcast(need))  # one row
        return counted.where(F.col("_n") == F.col("_need")).select("row", "col")
    return near.groupBy("row", "col").agg(F.count("*").alias("_n")).where(F.col("_n") == required).select("row", "col")


def row_runs(cells: DataFrame) -> DataFrame:
    """(row, start_col, end_col): maximal runs of neighbouring cells of a row."""
    island = F.col("col") - F.row_number().over(Window.partitionBy("row").orderBy("col"))
    return cells.distinct().withColumn("_i", island).groupBy("row", "_i").agg(F.min("col").alias("start_col"), F.max("col").alias("end_col")).drop("_i")


def rectangles(runs: DataFrame) -> DataFrame:
    """(start_row, end_row, start_col, end_col): equal runs of consecutive rows merged."""
    island = F.col("row") - F.row_number().over(Window.partitionBy("start_col", "end_col").orderBy("row"))
    out = runs.withColumn("_i", island).groupBy("start_col", "end_col", "_i").agg(F.min("row").alias("start_row"), F.max("row").alias("end_row"))
    return out.select("start_row", "end_row", "start_col", "end_col")
