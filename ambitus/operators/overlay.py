"""Vector form of the coverage: buffers united by category, categories intersected, one group (request or tile) at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambitus.functions import polygons, projection
from ambitus.functions.geo import METERS_PER_MILE

SCHEMA = "group_key string, polygon_no int, square_meters double, outer array<struct<latitude:double,longitude:double>>, holes array<array<struct<latitude:double,longitude:double>>>"


def overlay_groups(features: DataFrame, group: str, categories: list[str], quadrant: int = polygons.QUADRANT) -> DataFrame:
    """(group_key, polygon_no, square_meters, outer, holes): the polygons of where every category is within its radius, for each
    group: outer ring and the rings of its own holes, whose area is not counted.

    features: the group, category, radius_miles, points (array of coordinates) and, if there are such columns, lines (array of
    lines) and polygons (array of polygons, each an array of rings, the first the outer one; a ring is closed if it is not).
    Where there is no column lines, points of more than one coordinate are one line.  A group is a tile or a request: its features
    are bounded by the tile, and groups without every category are dropped before Python."""
    need = [c.strip().lower() for c in categories]
    coord = "struct<latitude:double,longitude:double>"
    empty = {k: F.array().cast(f"{'array<' * n}{coord}{'>' * n}") for k, n in (("points", 1), ("lines", 2), ("polygons", 3))}
    shapes = {k: F.coalesce(F.col(k), empty[k]) if k in features.columns else empty[k] for k in empty}
    if "lines" not in features.columns:
        many = F.size(shapes["points"]) > 1
        shapes["lines"] = F.when(many, F.array(shapes["points"])).otherwise(empty["lines"])
        shapes["points"] = F.when(many, empty["points"]).otherwise(shapes["points"])
    f = features.select(F.col(group).cast("string").alias("group_key"), F.lower(F.trim("category")).alias("category"), F.col("radius_miles").cast("double").alias("radius_miles"), *[v.alias(k) for k, v in shapes.items()])
    f = f.where(F.col("category").isin(*need) & (F.col("radius_miles") > 0) & (F.size("points") + F.size(F.flatten("lines")) + F.size(F.flatten(F.flatten("polygons"))) > 0))
    whole = f.groupBy("group_key").agg(F.count_distinct("category").alias("n")).where(F.col("n") == len(set(need))).select("group_key")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = [([c for p in pdf["points"].iloc[k] for c in (p,)], [list(x) for x in pdf["lines"].iloc[k]], [[list(r) for r in p] for p in pdf["polygons"].iloc[k]]) for k in range(len(pdf))]
        every = [c for p, ls, ps in rings for c in (*p, *(c for x in ls for c in x), *(c for q in ps for r in q for c in r))]
        lat, lon = np.array([c["latitude"] for c in every], float), np.array([c["longitude"] for c in every], float)
        lat0, lon0 = (lat.min() + lat.max()) / 2, (lon.min() + lon.max()) / 2

        def project(cs: list) -> np.ndarray:
            x, y = projection.forward(np.array([c["latitude"] for c in cs], float), np.array([c["longitude"] for c in cs], float), lat0, lon0)
            return np.stack([x, y], axis=1)

        def coordinates(ring: np.ndarray) -> list[dict[str, float]]:
            la, lo = projection.inverse(ring[:, 0], ring[:, 1], lat0, lon0)
            return [{"latitude": float(a), "longitude": float(b)} for a, b in zip(la, lo)]

        pieces, of = [], []
        for c, r, (own, lines, areas) in zip(pdf["category"], pdf["radius_miles"], rings):
            radius = r * METERS_PER_MILE
            made = [polygons.disc(x, y, radius, quadrant) for x, y in (project(own) if own else [])]
            for line in lines:
                made += polygons.line_pieces(project(line), radius, quadrant) if line else []
            for area in areas:
                made += polygons.area_pieces([project(q) for q in area if q], radius, quadrant)
            pieces += made
            of += [need.index(c)] * len(made)
        out = []
        for ring, holes in polygons.with_holes(polygons.overlay(pieces, np.array(of), len(need))):
            area = polygons.signed_area(ring) + sum(polygons.signed_area(q) for q in holes)
            out.append((pdf["group_key"].iloc[0], len(out), float(area), coordinates(ring), [coordinates(q) for q in holes]))
        frame = pd.DataFrame(out, columns=["group_key", "polygon_no", "square_meters", "outer", "holes"], dtype=object)
        return frame.astype({"polygon_no": "int32", "square_meters": "float64"})

    return f.join(whole, "group_key", "left_semi").groupBy("group_key").applyInPandas(run, SCHEMA)
