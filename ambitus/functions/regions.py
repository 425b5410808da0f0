"""Adaptive coverage of polygons by cells of a quadtree over degrees (numpy), and the matching point cells (columns).

Every cell on the edge of a polygon carries only the edges that touch it, and whether its reference point, just beyond its upper
right corner, is inside.  A point of the cell is inside if the path from it, first along its parallel and then along the meridian
to the reference point, crosses edges an odd or even number of times accordingly: the path stays in the cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LEVEL = 30
#: Cells that a task hands on together.
CELLS_AT_ONCE = 20_000
#: Edges that a task covers together: whole polygons, about so many.
EDGES_AT_ONCE = 20_000
#: The reference point lies beyond the corner by these shares of the cell's width: no vertex is likely to be just there.
BEYOND = (1.7320508e-7, 2.2360679e-7)


def cell_column(lat: Column, lon: Column, level: Column) -> Column:
    """Id of the cell that holds a point on a level: the world is one square of 360 by 360 degrees, halved at each level."""
    n = F.pow(F.lit(2.0), level)
    i, j = (F.least(F.floor((c + 180.0) / 360.0 * n), (n - 1).cast("long")).cast("long") for c in (lat, lon))
    return F.shiftleft(i, 31).bitwiseOR(j)


def edges_of(rings: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All edges of a column of polygons as rows (lat1, lon1, lat2, lon2), and the row of the column that each belongs to, in order;
    rings are closed if they are not.  A polygon with a coordinate that is no number has no edges."""
    outer, inner = rings.offsets.to_numpy(), rings.values.offsets.to_numpy()
    inner = inner[outer[0] : outer[-1] + 1]
    at = np.column_stack([rings.values.values.field(c).to_numpy(zero_copy_only=False) for c in ("latitude", "longitude")])[inner[0] : inner[-1]].astype(float)
    inner = inner - inner[0]
    of = np.repeat(np.repeat(np.arange(len(outer) - 1), np.diff(outer)), np.diff(inner))
    to = np.arange(1, len(at) + 1)
    filled = np.diff(inner) > 0
    to[inner[1:][filled] - 1] = inner[:-1][filled]
    e = np.hstack([at, at[to]])
    bad = np.bincount(of, ~np.isfinite(e).all(axis=1), minlength=len(outer) - 1) > 0
    keep = (e[:, :2] != e[:, 2:]).any(axis=1) & ~bad[of]
    return e[keep], of[keep]


def _odd(of: np.ndarray, hit: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, hit, minlength=n).astype(np.int64) % 2 == 1


def _contains(e: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Whether each edge is crossed on the way from its point to the east."""
    y1, x1, y2, x2 = e.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)


def _within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of groups of so many members, one after the other: the group of each member and its place there."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _touches(e: np.ndarray, y0: np.ndarray, y1: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Whether each edge meets its closed box: boxes overlap and the corners are not all on one side of the edge's line."""
    a, b, c, d = e.T
    over = (np.maximum(a, c) >= y0) & (np.minimum(a, c) <= y1) & (np.maximum(b, d) >= x0) & (np.minimum(b, d) <= x1)
    sides = [(c - a) * (x - b) - (d - b) * (y - a) for y in (y0, y1) for x in (x0, x1)]
    one = np.logical_and.reduce([s > 0 for s in sides]) | np.logical_and.reduce([s < 0 for s in sides])
    return over & ~one


def _crossed(e: np.ndarray, lat: np.ndarray, lon: np.ndarray, top: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each edge crosses its path from (lat, lon) by (lat, right) to (top, right) an odd number of times."""
    y1, x1, y2, x2 = e.T
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (x2 - x1) * (lat - y1) / (y2 - y1) + x1
        y = (y2 - y1) * (right - x1) / (x2 - x1) + y1
    along = ((y1 > lat) != (y2 > lat)) & (lon < x) & (x <= right)
    up = ((x1 > right) != (x2 > right)) & (lat < y) & (y <= top)
    return along != up


def level_column(rings: Column, refine: int) -> Column:
    """Coarsest level of a polygon's cells, by its width, so that it has about the same number of cells whatever its size."""
    at = F.flatten(rings)
    width = F.greatest(*[F.array_max(x) - F.array_min(x) for x in (F.transform(at, lambda c: c["latitude"]), F.transform(at, lambda c: c["longitude"]))])
    return F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL - refine), F.coalesce(F.floor(F.log2(360.0 / F.greatest(width, F.lit(1e-7)))), F.lit(0)))).cast("int")


def cover_polygons(edges: np.ndarray, of_edge: np.ndarray, coarse: np.ndarray, refine: int) -> Iterator[tuple]:
    """(polygon, level, row, column, details) of the cells that cover polygons, of which those of one polygon do not overlap.  details
    are None for cells inside, and for cells on the edge (where each one's edges begin, the edges that touch it, whether its
    reference point is inside, the point's latitude and longitude).

    of_edge: the polygon of each edge, in order, every one from 0 on; coarse: each polygon's level, see ``level_column``."""
    count = np.bincount(of_edge)
    begin = np.cumsum(count) - count
    lo, hi = np.minimum.reduceat(np.minimum(edges[:, :2], edges[:, 2:]), begin), np.maximum.reduceat(np.maximum(edges[:, :2], edges[:, 2:]), begin)
    n = np.left_shift(np.int64(1), coarse.astype(np.int64))[:, None]
    first, last = (np.clip(np.floor((v + 180.0) / 360.0 * n), 0, n - 1).astype(np.int64) for v in (lo, hi))
    wide = (last - first + 1)[:, 1]
    who, k = _within((last - first + 1).prod(axis=1))  # nine cells each at most
    i, j, level = first[who, 0] + k // wide[who], first[who, 1] + k % wide[who], coarse[who].astype(np.int64)
    of, k = _within(count[who])
    which = begin[who][of] + k
    size = 360.0 / np.left_shift(np.int64(1), level)
    top, right = (i + 1 + BEYOND[0]) * size - 180.0, (j + 1 + BEYOND[1]) * size - 180.0
    odd, middle = (_odd(of, _contains(edges[which], a[of], b[of]), len(who)) for a, b in ((top, right), ((i + 0.5) * size - 180.0, (j + 0.5) * size - 180.0)))
    for step in range(refine + 1):
        slack = size * 1e-6
        y, x = i * size - 180.0, j * size - 180.0
        hit = _touches(edges[which], (y - slack)[of], (y + size + slack)[of], (x - slack)[of], (x + size + slack)[of])
        of, which = of[hit], which[hit]
        edge = np.zeros(len(i), bool)
        edge[of] = True
        inside = ~edge & middle
        yield who[inside], level[inside], i[inside], j[inside], None
        at = np.cumsum(edge) - 1
        of, i, j, odd, top, right, who, level, size = at[of], i[edge], j[edge], odd[edge], top[edge], right[edge], who[edge], level[edge], size[edge]
        if step == refine:
            yield who, level, i, j, (np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(i)))]), edges[which[np.argsort(of, kind="stable")]], odd, top, right)
            return
        # the four quarters of each cell, with the edges of the whole
        m = len(i)
        old_top, old_right, old_odd = np.repeat(top, 4), np.repeat(right, 4), np.repeat(odd, 4)
        q = np.tile(np.arange(4), m)
        i, j, who, level, size = 2 * np.repeat(i, 4) + q // 2, 2 * np.repeat(j, 4) + q % 2, np.repeat(who, 4), np.repeat(level, 4) + 1, np.repeat(size, 4) / 2
        of = (4 * of[:, None] + np.arange(4)[None, :]).ravel()
        which = np.repeat(which, 4)
        top, right = (i + 1 + BEYOND[0]) * size - 180.0, (j + 1 + BEYOND[1]) * size - 180.0
        middle, odd = (_odd(of, _crossed(edges[which], a[of], b[of], old_top[of], old_right[of]), len(i)) != old_odd for a, b in (((i + 0.5) * size - 180.0, (j + 0.5) * size - 180.0), (top, right)))


def covers(refine: int):
    """For mapInArrow: rows (_ids, _rings, _coarse) to rows (_level, _cell, _inside, _ids, _edges, _odd, _top, _right)."""

    columns = ["_level", "_cell", "_inside", "_ids", "_edges", "_odd", "_top", "_right"]

    def cells(ids: pa.Array, edges: np.ndarray, of: np.ndarray, coarse: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, of = np.unique(of, return_inverse=True)
        for who, level, i, j, details in cover_polygons(edges, of, coarse[rows], refine):
            n, of_row = len(who), rows[who]
            if details is None:
                near, odd, top, right = pa.nulls(n, pa.list_(pa.float64())), np.zeros(n, bool), np.zeros(n), np.zeros(n)
            else:
                begin, own, odd, top, right = details
                near = pa.ListArray.from_arrays(pa.array(4 * begin, pa.int32()), pa.array(own.ravel()))
            level, cell, inside = level.astype(np.int32), (i << 31) | j, np.full(n, details is None)
            for k in range(0, n, CELLS_AT_ONCE):
                part = slice(k, k + CELLS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([pa.array(level[part]), pa.array(cell[part]), pa.array(inside[part]), ids.take(pa.array(of_row[part])), near[part], pa.array(odd[part]), pa.array(top[part]), pa.array(right[part])], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, coarse = batch.column("_ids"), batch.column("_coarse").to_numpy()
            edges, of = edges_of(batch.column("_rings"))
            cuts = np.flatnonzero(np.diff(np.searchsorted(of, of) // EDGES_AT_ONCE)) + 1 if len(of) else []  # between polygons
            for a, b in zip([0, *cuts], [*cuts, len(of)]):
                if b > a:
                    yield from cells(ids, edges[a:b], of[a:b], coarse)

    return run


def inside_cell(lat: Column, lon: Column, edges: Column, odd: Column, top: Column, right: Column) -> Column:
    """Whether a point of a cell is inside, by the cell's edges (flat: lat1, lon1, lat2, lon2, lat1, ...) and reference point."""
    k = F.sequence(F.lit(0), (F.size(edges) / 4).cast("int") - 1)

    def crosses(i: Column) -> Column:
        y1, x1, y2, x2 = (F.element_at(edges, i * 4 + n) for n in (1, 2, 3, 4))
        along, up = (y1 > lat) != (y2 > lat), (x1 > right) != (x2 > right)
        x, y = F.try_divide((x2 - x1) * (lat - y1), y2 - y1) + x1, F.try_divide((y2 - y1) * (right - x1), x2 - x1) + y1
        return F.coalesce(along & (lon < x) & (x <= right), F.lit(False)) != F.coalesce(up & (lat < y) & (y <= top), F.lit(False))

    return F.when(F.size(edges) < 4, odd).otherwise(F.aggregate(k, odd, lambda acc, i: acc != crosses(i)))
