"""Map tiles: the grid, which features belong to which tile, and which tiles have every category."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions.geo import MILES_PER_DEGREE

#: Tiles that are broadcast at most, about 10 MB.
TILES_TO_BROADCAST = 100_000


def _steps(first: float, last: float, step: float) -> list[tuple[float, float]]:
    """Consecutive intervals from first to last by repeated addition (a negative step goes down), the last one clamped."""
    out, at = [], first
    while at < last if step > 0 else at > last:
        to = min(last, at + step) if step > 0 else max(last, at + step)
        out.append((at, to))
        at = to
    return out


def tile_edges(north: float, south: float, west: float, east: float, lat_step: float, lon_step: float) -> tuple[list[tuple[float, float]], list[tuple[float, float]]]:
    """(top, bottom) of each row from the north and (left, right) of each column from the west."""
    if not (north > south and east > west and lat_step > 0 and lon_step > 0):
        raise ValueError("tile bounds must not be empty and steps must be positive")
    return _steps(north, south, -lat_step), _steps(west, east, lon_step)


def tile_rows(*bounds: float) -> list[tuple[str, int, int, float, float, float, float]]:
    """(name, row, col, north, south, west, east) of all tiles, for small grids."""
    rows, cols = tile_edges(*bounds)
    return [(f"tile_r{i:02d}_c{j:02d}", i, j, top, bottom, left, right) for i, (top, bottom) in enumerate(rows) for j, (left, right) in enumerate(cols)]


def tiles(spark: SparkSession, *bounds: float) -> DataFrame:
    """The grid as a table.  The driver holds its rows and its columns, the tiles are made where they are used."""
    rows, cols = tile_edges(*bounds)
    left, right = (np.array(x, float) for x in zip(*cols))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, top, bottom in pdf.itertuples(index=False):
                j = np.arange(len(left))
                yield pd.DataFrame({"name": [f"tile_r{i:02d}_c{k:02d}" for k in j], "row": np.int32(i), "col": j.astype(np.int32), "north": top, "south": bottom, "west": left, "east": right})

    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row int, north double, south double")
    return table.mapInPandas(run, "name string, row int, col int, north double, south double, west double, east double")


def assign(features: DataFrame, grid: DataFrame, north: float, west: float, lat_step: float, lon_step: float, key: str, radius: str = "radius_miles", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(name, row, col, key, category_key): features of each tile they may touch: their position padded by radius / 69 degrees on
    both axes overlaps the closed tile.

    The grid is regular, so a feature names the few tiles it may touch by arithmetic; an equi-join on (row, col) and an exact
    test follow.  No range join, and the tiles are broadcast only if Spark finds them small."""
    pad = F.col(radius) / MILES_PER_DEGREE
    f = features.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("_key"), F.lower(F.trim("category")).alias("category_key"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), pad.alias("_pad"))
    down = F.sequence(F.floor((F.lit(north) - F.col("_lat") - F.col("_pad")) / lat_step).cast("int") - 1, F.floor((F.lit(north) - F.col("_lat") + F.col("_pad")) / lat_step).cast("int") + 1)
    across = F.sequence(F.floor((F.col("_lon") - F.col("_pad") - west) / lon_step).cast("int") - 1, F.floor((F.col("_lon") + F.col("_pad") - west) / lon_step).cast("int") + 1)
    f = f.withColumn("row", F.explode(down)).where("row >= 0").withColumn("col", F.explode(across)).where("col >= 0")
    hit = f.join(grid, ["row", "col"])
    inside = (F.col("_lat") + F.col("_pad") >= F.col("south")) & (F.col("_lat") - F.col("_pad") <= F.col("north")) & (F.col("_lon") + F.col("_pad") >= F.col("west")) & (F.col("_lon") - F.col("_pad") <= F.col("east"))
    return hit.where(inside).select("name", "row", "col", F.col("_key").alias(key), "category_key")


def completeness(grid: DataFrame, assigned: DataFrame, required: list[str]) -> DataFrame:
    """(name, row, col, point_count, n_categories, complete): tiles with the number of features and whether every required
    category is among them."""
    by = assigned.groupBy("name").agg(F.count("*").alias("point_count"), F.collect_set("category_key").alias("_has"))
    need = F.array(*[F.lit(c.strip().lower()) for c in required]) if required else F.array().cast("array<string>")
    out = grid.select("name", "row", "col").join(by, "name", "left")
    has = F.coalesce("_has", F.array().cast("array<string>"))
    return out.select("name", "row", "col", F.coalesce("point_count", F.lit(0)).alias("point_count"), F.size(has).alias("n_categories"), (F.size(F.array_except(need, has)) == 0).alias("complete"))


def assign_boxes(features: DataFrame, grid: DataFrame, north: float, west: float, lat_step: float, lon_step: float, key: str, radius: str = "radius_miles", true_width: bool = False) -> DataFrame:
    """(name, row, col, key, category_key): features of any shape with each tile that their padded box overlaps (closed).

    features: key, category, radius, south, north, west, east (their own box).  The pad is radius / 69 degrees on both axes;
    true_width: on the east-west axis divided by the cosine of the latitude that is farthest from the equator, so that every
    tile within the radius is named.  Regular tiles: a feature names its tiles by arithmetic, and an exact test follows.  The named
    tiles are many more bytes than the features, which Spark cannot foresee, so that they are never broadcast: the grid is, up to
    TILES_TO_BROADCAST tiles, and a larger one is joined by sorting."""
    pad = F.col(radius) / MILES_PER_DEGREE
    far = F.greatest(F.abs(F.col("south")), F.abs(F.col("north"))) + pad
    wide = pad / F.greatest(F.cos(F.radians(F.least(far, F.lit(90.0)))), F.lit(1e-3)) if true_width else pad
    f = features.where(F.col("south").isNotNull() & F.col("west").isNotNull()).select(F.col(key).alias("_key"), F.lower(F.trim("category")).alias("category_key"), (F.col("south") - pad).alias("_s"), (F.col("north") + pad).alias("_n"), (F.col("west") - wide).alias("_w"), (F.col("east") + wide).alias("_e"))
    size = grid.agg(F.max("row").alias("rows"), F.max("col").alias("cols"), F.count("*").alias("n")).first()
    rows, cols = size["rows"] or 0, size["cols"] or 0

    def span(lo, hi, last: int):
        lo, hi = F.greatest(F.floor(lo).cast("int") - 1, F.lit(0)), F.least(F.floor(hi).cast("int") + 1, F.lit(last))
        return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi)))

    f = f.withColumn("row", F.explode(span((north - F.col("_n")) / lat_step, (north - F.col("_s")) / lat_step, rows))).withColumn("col", F.explode(span((F.col("_w") - west) / lon_step, (F.col("_e") - west) / lon_step, cols)))
    hit = f.join(grid.hint("broadcast" if size["n"] <= TILES_TO_BROADCAST else "merge"), ["row", "col"])
    inside = (F.col("_n") >= F.col("south")) & (F.col("_s") <= F.col("north")) & (F.col("_e") >= F.col("west")) & (F.col("_w") <= F.col("east"))
    return hit.where(inside).select("name", "row", "col", F.col("_key").alias(key), "category_key")


def tile_index(lat, lon, north: float, west: float, lat_step: float, lon_step: float, rows: int, cols: int):
    """(row, col) of the tile that holds a position, clamped to the grid."""
    row, col = F.floor((F.lit(north) - lat) / lat_step), F.floor((lon - F.lit(west)) / lon_step)
    return tuple(F.greatest(F.lit(0), F.least(x, F.lit(n - 1))).cast("int") for x, n in ((row, rows), (col, cols)))


def statuses(grid: DataFrame, assigned: DataFrame, areas: DataFrame, required: list[str]) -> DataFrame:
    """One row a tile: its box, the number of its features (point_count) and result polygons (boundary_count), the categories
    present in order, and its status: missing_categories, empty_outline or written."""
    whole = completeness(grid, assigned, required).select("name", "point_count", "complete")
    present = assigned.groupBy("name").agg(F.array_sort(F.collect_set("category_key")).alias("_present"))
    made = areas.groupBy(F.col("group_key").alias("name")).agg(F.count("*").alias("_made"))
    out = grid.join(whole, "name").join(present, "name", "left").join(made, "name", "left").withColumn("boundary_count", F.coalesce(F.when(F.col("complete"), F.col("_made")), F.lit(0)))
    status = F.when(~F.col("complete"), "missing_categories").when(F.col("boundary_count") == 0, "empty_outline").otherwise("written")
    return out.select("name", "row", "col", "north", "south", "west", "east", "point_count", "boundary_count", F.coalesce("_present", F.array().cast("array<string>")).alias("categories_present"), status.alias("status"))


def status_counts(tile_rows_: DataFrame) -> DataFrame:
    """(status, n) of the tiles, every status that occurs."""
    return tile_rows_.groupBy("status").agg(F.count("*").alias("n"))
