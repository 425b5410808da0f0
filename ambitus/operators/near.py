"""Points near points, and points inside regions, by an adaptive coverage of cells.

A circle (or polygon) is covered by cells of a quadtree: cells wholly inside, and cells on its edge.  A point names the cell
that holds it on each level in use.  The join is an equi-join on the cell: a match on an inner cell is accepted as it is, a
match on an edge cell alone gets the exact test.  The cells of one shape do not overlap, so no pair comes out twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambitus.functions import geo, regions

#: Ids of one position or one shape that a row holds at most.
IDS_AT_ONCE = 1000


def points_near_points(
    points: DataFrame, targets: DataFrame, point_id: str, target_id: str, radius: str, lat: str = "latitude", lon: str = "longitude", refine: int = 3, by: str | None = None
) -> DataFrame:
    """Pairs (point_id, target_id) whose great-circle distance is at most the target's own ``radius`` (miles).

    by: a column of both sides that must be equal as well; it becomes a second join key (rows where it is null pair with none).

    points: point_id, lat, lon; targets: target_id, lat, lon, radius; other columns are ignored, whatever their names.
    A position that is null, 0/0, NaN or out of range belongs to no pair, nor does a target with a null or negative radius.
    Repeated rows give one pair; an id with several positions gives a pair if any of them is near.  An empty side gives no
    rows.  A crowded cell makes a large shuffle partition, which adaptive execution splits: nothing is grouped into one task.
    """
    clean = geo.is_position(lat, lon)
    also = F.col(by).cast("string") if by else F.lit("")
    a = points.where(clean).select(F.col(point_id).alias("_p"), also.alias("_by"), F.col(lat).cast("double").alias("_plat"), F.col(lon).cast("double").alias("_plon")).distinct()
    b = (
        targets.where(clean & (F.col(radius) >= 0))
        .select(F.col(target_id).alias("_t"), also.alias("_by"), F.col(lat).cast("double").alias("_tlat"), F.col(lon).cast("double").alias("_tlon"), F.col(radius).cast("double").alias("_r"))
        .distinct()
    )
    b = b.withColumn("_level", geo.level_column(F.col("_r"), refine))
    starts = [r[0] for r in b.select("_level").distinct().collect()]  # at most MAX_LEVEL + 1, whatever the radii
    levels = sorted({x for start in starts for x in range(start, start + refine + 1)})
    types = {f.name: f.dataType for f in a.schema.fields} | {f.name: f.dataType for f in b.schema.fields}
    held = a.mapInPandas(_point_cells(levels), T.StructType([T.StructField("_cell", T.LongType())] + [T.StructField(c, types[c]) for c in ("_p", "_by", "_plat", "_plon")]))
    covers = b.mapInPandas(_covers(refine), T.StructType([T.StructField("_cell", T.LongType()), T.StructField("_inside", T.BooleanType())] + [T.StructField(c, types[c]) for c in ("_t", "_by", "_tlat", "_tlon", "_r")]))
    near = F.col("_inside") | (geo.haversine("_plat", "_plon", "_tlat", "_tlon") <= F.col("_r"))
    pairs = held.join(covers if by else covers.drop("_by"), ["_cell", "_by"] if by else "_cell").where(near).select(F.col("_p").alias(point_id), F.col("_t").alias(target_id))
    return pairs.distinct()


def _point_cells(levels: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cells = geo.point_cells(pdf["_plat"].to_numpy(), pdf["_plon"].to_numpy(), levels)
            at = np.repeat(np.arange(len(pdf)), len(levels))
            out = pdf.iloc[at].reset_index(drop=True)
            out.insert(0, "_cell", cells.ravel())
            yield out

    return run


def _covers(refine: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for level, own in pdf.groupby("_level"):
                who, cells, inside = geo.cover_circles(own["_tlat"].to_numpy(), own["_tlon"].to_numpy(), own["_r"].to_numpy(), refine, int(level))
                out = own.drop(columns="_level").iloc[who].reset_index(drop=True)
                out.insert(0, "_inside", inside)
                out.insert(0, "_cell", cells)
                yield out

    return run


def _several(rows: DataFrame, key: str, several: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key occurs once, and those of other keys (None: ``several`` is empty, so that there are none)."""
    if several.isEmpty():
        return rows, None
    n = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return n.where("_n = 1").drop("_n"), n.where("_n > 1").drop("_n")


def _grouped(rows: DataFrame, key: str, by: list[str], together: bool) -> DataFrame:
    """(by, _ids): the keys of equal rows together, at most IDS_AT_ONCE of them, spread over the tasks anew; or each alone."""
    if not together:
        return rows.select(*by, F.array(F.struct(key)).alias("_ids"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy(key))
    held = rows.withColumn("_chunk", F.floor((n - 1) / IDS_AT_ONCE)).groupBy(*by, "_chunk").agg(F.collect_list(F.struct(key)).alias("_ids"))  # in structs, for a list drops nulls
    return held.repartition(*by, "_chunk")


def points_in_regions(points: DataFrame, areas: DataFrame, point_id: str, area_id: str, rings: str, lat: str = "latitude", lon: str = "longitude", refine: int = 4) -> DataFrame:
    """Pairs (point_id, area_id) of each point and the regions that contain it.

    areas: area_id and ``rings``, an array of rings, each an array of structs (latitude, longitude); the edges are straight in
    degrees; a point is inside by the even-odd rule over all rings, so that further rings are holes.  A region must not cross
    the 180th meridian.  Points as in ``points_near_points``.  Rings of fewer than three vertices are left out; a region
    without a ring contains nothing.  Which side a point exactly on an edge falls on is that of the even-odd test.  A cell on the
    edge of a region carries only the edges that touch it, so a region of very many vertices is spread over its cells.

    Equal positions (where they are many), and equal rings, are searched once and stand for all their ids.  Only ids with several
    positions or several shapes can give a pair twice; their pairs alone are made distinct.  The cells of the regions are many more
    bytes than the regions, which Spark cannot foresee, so that neither side is ever broadcast.
    """
    every = points.where(geo.is_position(lat, lon)).select(F.col(point_id).alias("_p"), F.col(lat).cast("double").alias("_plat"), F.col(lon).cast("double").alias("_plon"))
    at, a = F.struct("_plat", "_plon"), every.distinct()
    n = every.agg(F.approx_count_distinct("_p").alias("ids"), F.approx_count_distinct(at).alias("positions")).first()
    together = n["ids"] > 2 * n["positions"]  # else there is little to gain; the pairs are the same
    shape = F.filter(F.transform(F.col(rings), lambda r: F.transform(r, lambda c: F.struct(c["latitude"].cast("double").alias("latitude"), c["longitude"].cast("double").alias("longitude")))), lambda r: F.size(r) >= 3)
    b = areas.select(F.col(area_id).alias("_a"), shape.alias("_rings")).where(F.size("_rings") > 0).dropDuplicates(["_a", "_rings"])
    starts = [r[0] for r in b.select(regions.level_column(F.col("_rings"), refine)).distinct().collect()]  # at most MAX_LEVEL + 1, whatever the regions
    # a region is not wider than a cell of its coarsest level, so that none of these lies inside it, unless it is wider than the world
    levels = sorted({x for start in starts or [0] for x in range(start + (start > 0 and refine > 0), start + refine + 1)})
    cells = "_level int, _cell long, _inside boolean, _edges array<double>, _odd boolean, _top double, _right double"

    def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
        b = _grouped(b, "_a", ["_rings"], True).select("_ids", "_rings", regions.level_column(F.col("_rings"), refine).alias("_coarse"))
        types = {f.name: f for f in T.StructType.fromDDL(cells).fields} | {"_ids": b.schema["_ids"]}
        covers = b.mapInArrow(regions.covers(refine), T.StructType([types[c] for c in ("_level", "_cell", "_inside", "_ids", "_edges", "_odd", "_top", "_right")]))
        held = _grouped(a, "_p", ["_plat", "_plon"], together).select("_plat", "_plon", F.col("_ids").alias("_points"), F.explode(F.array(*[F.lit(x) for x in levels])).alias("_level"))
        held = held.withColumn("_cell", regions.cell_column(F.col("_plat"), F.col("_plon"), F.col("_level")))
        hit = held.join(covers.hint("merge"), ["_level", "_cell"]).where(F.col("_inside") | regions.inside_cell(F.col("_plat"), F.col("_plon"), F.col("_edges"), F.col("_odd"), F.col("_top"), F.col("_right")))
        out = hit.select("_ids", F.explode("_points").alias("_point")).select("_point", F.explode("_ids").alias("_area"))
        return out.select(F.col("_point._p").alias(point_id), F.col("_area._a").alias(area_id))

    one, more = _several(a, "_p", every.groupBy("_p").agg(F.min(at).alias("x"), F.max(at).alias("y")).where("x <> y"))
    whole, parts = _several(b, "_a", b.groupBy("_a").count().where("count > 1"))
    rest = ([pairs(more, b)] if more is not None else []) + ([pairs(one, parts)] if parts is not None else [])
    return reduce(DataFrame.unionByName, [pairs(one, whole)] + ([reduce(DataFrame.unionByName, rest).distinct()] if rest else []))
