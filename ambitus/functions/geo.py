"""Geographic column expressions and the cell system of the spatial joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Units.
EARTH_RADIUS_MILES = 3958.7613
EARTH_RADIUS_FEET = 20_925_524.9
FEET_PER_MILE = 5280.0
FEET_PER_DEGREE = 364_000.0
MILES_PER_DEGREE = 69.0
METERS_PER_MILE = 1609.344


def _c(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def is_position(lat: Column | str, lon: Column | str) -> Column:
    """Whether the two numbers are a position: present, not 0/0, latitude within 90 and longitude within 180 degrees."""
    lat, lon = _c(lat), _c(lon)
    ok = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0) & ~((lat == 0.0) & (lon == 0.0)) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(ok, F.lit(False))


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_MILES) -> Column:
    """Great-circle distance on a sphere, in the unit of the radius."""
    a, b, c, d = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def planar_miles(lat1, lon1, lat2, lon2) -> Column:
    """69 miles a degree, longitude shrunk by the second point's latitude (so not symmetric)."""
    lat1, lon1, lat2, lon2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    x = (lon2 - lon1) * F.cos(F.radians(lat2)) * MILES_PER_DEGREE
    y = (lat2 - lat1) * MILES_PER_DEGREE
    return F.sqrt(x * x + y * y)


# ---- cells: the six faces of a cube around the sphere, each a quadtree over equal angles.  Lines of a face are great
# circles, so a cell is convex on the sphere, and neither a pole nor the 180th meridian is special.

FACES = np.array(  # axes (x, y, z) of each face, z being its centre
    [
        [[0, 1, 0], [0, 0, 1], [1, 0, 0]],
        [[-1, 0, 0], [0, 0, 1], [0, 1, 0]],
        [[0, -1, 0], [0, 0, 1], [-1, 0, 0]],
        [[1, 0, 0], [0, 0, 1], [0, -1, 0]],
        [[0, 1, 0], [-1, 0, 0], [0, 0, 1]],
        [[0, 1, 0], [1, 0, 0], [0, 0, -1]],
    ],
    dtype=float,
)
MAX_LEVEL = 26
#: Radius (as an angle) beyond which a circle is covered from the whole faces.
WIDE = 0.35


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=1)


def cell_ids(level: np.ndarray | int, face: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (np.int64(1) * level << 57) | (face.astype(np.int64) << 54) | (i.astype(np.int64) << 27) | j.astype(np.int64)


def _face_angles(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Face of each vector and its two coordinates there, from -1 to 1, in equal angles."""
    dots = p @ FACES[:, 2].T
    face = dots.argmax(axis=1)
    axes = FACES[face]
    x, y, z = (np.einsum("nk,nk->n", p, axes[:, k]) for k in range(3))
    return face, np.arctan2(x, z) / (np.pi / 4), np.arctan2(y, z) / (np.pi / 4)


def point_cells(lat: np.ndarray, lon: np.ndarray, levels: list[int]) -> np.ndarray:
    """Ids of the cells that hold each point: one column for each level."""
    face, s, t = _face_angles(unit_vectors(lat, lon))
    out = np.empty((len(lat), len(levels)), dtype=np.int64)
    for k, level in enumerate(levels):
        n = 1 << level
        i, j = (np.clip(np.floor((c + 1) / 2 * n), 0, n - 1) for c in (s, t))
        out[:, k] = cell_ids(level, face, i, j)
    return out


def radius_levels(radius_miles: float, refine: int = 3) -> tuple[int, int]:
    """Coarsest and finest level of the coverage of a circle: from cells about as wide as the circle to ``refine`` levels below."""
    width = np.pi / 2 * EARTH_RADIUS_MILES
    coarse = int(np.clip(np.floor(np.log2(width / max(2 * radius_miles, 1e-6))), 0, MAX_LEVEL - refine))
    return coarse, coarse + refine


def _corner_vectors(face: np.ndarray, level: int, i: np.ndarray, j: np.ndarray, di: float, dj: float) -> np.ndarray:
    n = 1 << level
    u, v = (np.tan(((c + d) / n * 2 - 1) * np.pi / 4) for c, d in ((i, di), (j, dj)))
    axes = FACES[face]
    p = u[:, None] * axes[:, 0] + v[:, None] * axes[:, 1] + axes[:, 2]
    return p / np.linalg.norm(p, axis=1)[:, None]


def level_column(radius: Column, refine: int = 3) -> Column:
    """The coarsest level of the coverage of a circle, as ``radius_levels`` has it."""
    width = float(np.pi / 2 * EARTH_RADIUS_MILES)
    level = F.floor(F.log2(F.lit(width) / F.greatest(2 * radius, F.lit(1e-6))))
    return F.greatest(F.lit(0), F.least(level, F.lit(MAX_LEVEL - refine))).cast("int")


def cover_circles(lat: np.ndarray, lon: np.ndarray, radius_miles: np.ndarray | float, refine: int = 3, coarse: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adaptive coverage of circles: (index of the circle, cell id, whether the cell lies wholly inside).  The circles may differ
    in radius but start from the same level, ``coarse``; by default that of the one radius.

    The cells of one circle do not overlap.  A cell that lies inside is not divided further; one that the edge of the circle
    crosses is divided down to the finest level; one outside is dropped."""
    radius = np.broadcast_to(np.asarray(radius_miles, float), np.shape(lat))
    if not (radius >= 0).all():
        raise ValueError("a radius must not be negative")
    angle = np.minimum(radius / EARTH_RADIUS_MILES, np.pi)
    rho = np.minimum(angle * (1 + 1e-9) + 1e-12, np.pi)
    coarse = radius_levels(float(radius.max(initial=0.0)), refine)[0] if coarse is None else coarse
    fine = coarse + refine
    n = 1 << coarse
    p = unit_vectors(lat, lon)
    parts = []
    wide = np.flatnonzero(rho > WIDE)  # these start from all cells of the sphere: few, since their level is coarse
    i, j = (g.ravel() for g in np.meshgrid(np.arange(n), np.arange(n), indexing="ij")) if len(wide) else (np.empty(0, np.int64),) * 2
    for f in range(6 if len(wide) else 0):
        parts.append((np.repeat(wide, len(i)), np.full(len(wide) * len(i), f), np.tile(i, len(wide)), np.tile(j, len(wide))))
    for f in range(6):
        x, y, z = (p @ FACES[f, k] for k in range(3))
        near = np.flatnonzero((rho <= WIDE) & (z > np.cos(np.arccos(1 / np.sqrt(3)) + np.minimum(rho, WIDE)) - 1e-12))
        if not len(near):
            continue
        x, y, z = x[near], y[near], z[near]
        lo, hi = [], []
        for c, other in ((x, y), (y, x)):  # a coordinate is a longitude around the other axis
            spread = np.arcsin(np.minimum(1.0, np.sin(rho[near]) / np.maximum(1e-9, np.sqrt(1 - np.minimum(1.0, other**2)))))
            at = np.arctan2(c, z)
            lo.append((at - spread) / (np.pi / 4))
            hi.append((at + spread) / (np.pi / 4))
        ok = (hi[0] >= -1) & (lo[0] <= 1) & (hi[1] >= -1) & (lo[1] <= 1)
        near = near[ok]
        i0, i1, j0, j1 = (np.clip(np.floor((b[ok] + 1) / 2 * n), 0, n - 1).astype(np.int64) for b in (lo[0], hi[0], lo[1], hi[1]))
        width, height = i1 - i0 + 1, j1 - j0 + 1
        count = width * height
        who = np.repeat(np.arange(len(near)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        parts.append((near[who], np.full(len(who), f), i0[who] + k // height[who], j0[who] + k % height[who]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    who, face, i, j = (np.concatenate(x) for x in zip(*parts))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    reach = (2 * np.sin(angle / 2)) ** 2 * (1 - 1e-9)
    beyond = 2 * np.sin((np.pi - rho) / 2)  # of a circle of more than a hemisphere the rest is a circle around the antipode
    for level in range(coarse, fine + 1):
        centre = p[who]
        corners = [_corner_vectors(face, level, i, j, a, b) for a in (0.0, 1.0) for b in (0.0, 1.0)]
        inside = np.logical_and.reduce([((c - centre) ** 2).sum(axis=1) <= reach[who] for c in corners])
        middle = _corner_vectors(face, level, i, j, 0.5, 0.5)
        half = np.sqrt(np.maximum.reduce([((c - middle) ** 2).sum(axis=1) for c in corners]))
        away = np.sqrt(((middle - centre) ** 2).sum(axis=1))
        inside &= (rho[who] < np.pi / 2) | (np.sqrt(((middle + centre) ** 2).sum(axis=1)) > beyond[who] + half * (1 + 1e-9) + 1e-12)
        touched = away <= 2 * np.sin(rho[who] / 2) + half * (1 + 1e-9) + 1e-12
        ids = cell_ids(level, face, i, j)
        out.append((who[inside], ids[inside], np.ones(inside.sum(), bool)))
        edge = touched & ~inside
        if level == fine:
            out.append((who[edge], ids[edge], np.zeros(edge.sum(), bool)))
        else:
            who, face, i, j = (np.repeat(x[edge], 4) for x in (who, face, i, j))
            quarter = np.tile(np.arange(4), edge.sum())
            i, j = 2 * i + quarter // 2, 2 * j + quarter % 2
    return tuple(np.concatenate(x) for x in zip(*out))
