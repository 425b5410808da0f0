"""Union of buffers within categories and intersection across them, on convex pieces (numpy).

A buffer is a union of convex pieces: a regular polygon around a point, the hull of two such polygons along a segment.  The edges
of all pieces are cut where they cross; a part is on the outline of the result if the predicate "inside a piece of every
category" differs between its two sides.  The parts, with the inside on their left, are joined to rings: those that run
counter-clockwise are shells, the others holes.

An edge deep inside one piece of its own category is on no outline, and crossing it changes nothing: it is left out first.
"""

from __future__ import annotations

import numpy as np

QUADRANT = 16
OFFSET = 1e-4
#: Metres within which the end of one part of an outline and the start of the next are one point.
SNAP = 0.01


def disc(x: float, y: float, r: float, quadrant: int = QUADRANT) -> np.ndarray:
    t = np.arange(4 * quadrant) * (np.pi / 2 / quadrant)
    return np.stack([x + r * np.cos(t), y + r * np.sin(t)], axis=1)


def capsule(a: np.ndarray, b: np.ndarray, r: float, quadrant: int = QUADRANT) -> np.ndarray:
    pts = np.vstack([disc(*a, r, quadrant), disc(*b, r, quadrant)])
    p = pts[np.lexsort((pts[:, 1], pts[:, 0]))]
    out = []
    for seq in (p, p[::-1]):
        h: list[tuple[float, float]] = []
        for x, y in seq:
            while len(h) > 1 and (h[-1][0] - h[-2][0]) * (y - h[-2][1]) - (h[-1][1] - h[-2][1]) * (x - h[-2][0]) <= 1e-9:
                h.pop()
            h.append((x, y))
        out += h[:-1]
    return np.array(out)


def line_pieces(points: np.ndarray, r: float, quadrant: int = QUADRANT) -> list[np.ndarray]:
    """Convex pieces whose union is the buffer of a line; of a line without length that of its point."""
    ends = [(a, b) for a, b in zip(points, points[1:]) if (a != b).any()]
    return [capsule(a, b, r, quadrant) for a, b in ends] if ends else [disc(*points[0], r, quadrant)]


def repaired(rings: list[np.ndarray]) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """The even-odd inside of rings that may cross themselves or each other, as simple shells with their holes; the rings as
    they are, the first as the shell, if they enclose nothing or cannot be repaired."""
    try:
        made = with_holes(overlay(p := area_pieces(rings, 0.0), np.zeros(len(p), int), 1))
    except ValueError:
        made = []
    return made or [(rings[0], list(rings[1:]))]


def area_pieces(rings: list[np.ndarray], r: float, quadrant: int = QUADRANT) -> list[np.ndarray]:
    """Convex pieces whose union is the buffer of a polygon with holes: the buffers of its rings, and its inside cut into
    trapezoids by the vertical lines through its corners (even-odd over all rings)."""
    rings = [q if (q[0] == q[-1]).all() else np.vstack([q, q[:1]]) for q in rings if len(q)]
    if not rings:
        return []
    out = [p for q in rings for p in line_pieces(q, r, quadrant)] if r > 0 else []
    edges = np.vstack([np.hstack([q[:-1], q[1:]]) for q in rings if len(q) > 3] or [np.empty((0, 4))])
    xs = np.unique(edges[:, [0, 2]])
    # rings may cross each other or themselves: their crossings are corners as well
    xs = np.unique(np.r_[xs, _crossings(edges)])
    for x0, x1 in zip(xs, xs[1:]):
        if x1 - x0 < 10 * OFFSET:
            continue  # thinner than a millimetre, and inside the buffer of the corner
        lo, hi = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
        e = edges[(lo < (x0 + x1) / 2) & (hi > (x0 + x1) / 2)]
        slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
        left, right = e[:, 1] + slope * (x0 - e[:, 0]), e[:, 1] + slope * (x1 - e[:, 0])
        order = np.argsort(left + right, kind="stable")
        for a, b in zip(order[::2], order[1::2]):
            p = np.array([[x0, left[a]], [x1, right[a]], [x1, right[b]], [x0, left[b]]])
            p = p[(np.abs(p - np.roll(p, 1, axis=0)) > 1e-9).any(axis=1)]
            if len(p) >= 3 and signed_area(p) > 1e-6:
                out.append(p)
    return out


def _crossings(edges: np.ndarray) -> np.ndarray:
    found = [np.empty(0)]
    for k in range(len(edges) - 1):
        (ax, ay, bx, by), rest = edges[k], edges[k + 1 :]
        rx, ry, sx, sy = bx - ax, by - ay, rest[:, 2] - rest[:, 0], rest[:, 3] - rest[:, 1]
        den = rx * sy - ry * sx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((rest[:, 0] - ax) * sy - (rest[:, 1] - ay) * sx) / den
            u = ((rest[:, 0] - ax) * ry - (rest[:, 1] - ay) * rx) / den
        hit = (np.abs(den) > 1e-12) & (t > 1e-9) & (t < 1 - 1e-9) & (u > 1e-9) & (u < 1 - 1e-9)
        found.append(ax + t[hit] * rx)
    return np.concatenate(found)


def _inside(points: np.ndarray, pieces: list[np.ndarray]) -> np.ndarray:
    """For each point and piece whether the point is inside (counter-clockwise convex pieces)."""
    out = np.empty((len(points), len(pieces)), bool)
    for k, p in enumerate(pieces):
        q = np.roll(p, -1, axis=0)
        e = q - p
        side = e[None, :, 0] * (points[:, None, 1] - p[None, :, 1]) - e[None, :, 1] * (points[:, None, 0] - p[None, :, 0])
        out[:, k] = (side > 0).all(axis=1)
    return out


def _outer_edges(pieces: list[np.ndarray], category: np.ndarray, boxes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The edges (starts, ends) of each piece, without those that lie in one other piece of the category with room on both sides."""
    start, end = np.vstack(pieces), np.vstack([np.roll(p, -1, axis=0) for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    keep = np.ones(len(start), bool)
    for g in np.unique(category):
        own = np.flatnonzero(category[owner] == g)
        for j in np.flatnonzero(category == g):
            x0, y0, x1, y1 = boxes[j]
            p = start[own]
            at = own[(p[:, 0] > x0) & (p[:, 0] < x1) & (p[:, 1] > y0) & (p[:, 1] < y1)]
            at = at[owner[at] != j]
            if len(at):
                at = at[_deep_inside(start[at], pieces[j])]
                at = at[_deep_inside(end[at], pieces[j])]
                keep[at] = False
                own = own[keep[own]]
    own = np.split(np.arange(len(start)), np.cumsum([len(p) for p in pieces])[:-1])
    return [(start[k[keep[k]]], end[k[keep[k]]]) for k in own]


def _deep_inside(points: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Whether the point is in the convex piece and further than a millimetre, ten times OFFSET, from its edges."""
    e = np.roll(piece, -1, axis=0) - piece
    side = e[None, :, 0] * (points[:, None, 1] - piece[None, :, 1]) - e[None, :, 1] * (points[:, None, 0] - piece[None, :, 0])
    return (side > 10 * OFFSET * np.hypot(e[:, 0], e[:, 1])).all(axis=1)


def overlay(pieces: list[np.ndarray], category: np.ndarray, categories: int) -> list[np.ndarray]:
    """Rings of the region that lies in a piece of every category; empty if there is none."""
    if not pieces or len(set(category.tolist())) < categories:
        return []
    boxes = np.array([[*p.min(axis=0), *p.max(axis=0)] for p in pieces])
    edges = _outer_edges(pieces, category, boxes)
    parts = []
    for i, (a, b) in enumerate(edges):
        near = np.flatnonzero((boxes[:, 0] <= boxes[i, 2] + 1) & (boxes[:, 2] >= boxes[i, 0] - 1) & (boxes[:, 1] <= boxes[i, 3] + 1) & (boxes[:, 3] >= boxes[i, 1] - 1))
        if not len(a) or len(set(category[near].tolist())) < categories:
            continue
        others = near[near != i]
        c = np.vstack([edges[j][0] for j in others]) if len(others) else np.empty((0, 2))
        d = np.vstack([edges[j][1] for j in others]) if len(others) else np.empty((0, 2))
        r, s = b - a, d - c
        den = r[:, None, 0] * s[None, :, 1] - r[:, None, 1] * s[None, :, 0]
        w = c[None, :, :] - a[:, None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[..., 0] * s[None, :, 1] - w[..., 1] * s[None, :, 0]) / den
            u = (w[..., 0] * r[:, None, 1] - w[..., 1] * r[:, None, 0]) / den
        hit = (np.abs(den) > 1e-12) & (t > 1e-9) & (t < 1 - 1e-9) & (u >= -1e-9) & (u <= 1 + 1e-9)
        for k in range(len(a)):
            cuts = np.unique(np.r_[0.0, t[k][hit[k]], 1.0])
            ends = a[k] + cuts[:, None] * r[k]
            parts.append((ends[:-1], ends[1:], np.full(len(cuts) - 1, i)))
    if not parts:
        return []
    start, end, owner = (np.concatenate(x) for x in zip(*parts))
    run = end - start
    length = np.hypot(run[:, 0], run[:, 1])
    keep = length > 10 * OFFSET
    start, end, owner, run, length = start[keep], end[keep], owner[keep], run[keep], length[keep]
    middle = (start + end) / 2
    left = middle + OFFSET * np.stack([-run[:, 1], run[:, 0]], axis=1) / length[:, None]
    right = 2 * middle - left

    def held(points: np.ndarray) -> np.ndarray:
        ok = np.ones(len(points), bool)
        for g in range(categories):
            any_ = np.zeros(len(points), bool)
            for j in np.flatnonzero(category == g):
                x0, y0, x1, y1 = boxes[j]
                at = np.flatnonzero(ok & ~any_ & (points[:, 0] >= x0) & (points[:, 0] <= x1) & (points[:, 1] >= y0) & (points[:, 1] <= y1))
                if len(at):
                    any_[at] = _inside(points[at], [pieces[j]])[:, 0]
            ok &= any_
        return ok

    l, r = held(left), held(right)
    edge = l != r
    a = np.where(l[edge, None], start[edge], end[edge])
    b = np.where(l[edge, None], end[edge], start[edge])
    return _stitch(a, b)


def _stitch(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Rings of the parts from a to b.  A part goes on with one that starts where it ends; parts of less than a millimetre are
    missing, so that the start may be some millimetres away.  Raises ValueError if a chain of parts does not close."""
    grid: dict[tuple[int, int], list[int]] = {}
    cell = lambda p: (int(np.floor(p[0] / SNAP)), int(np.floor(p[1] / SNAP)))
    same: set[tuple] = set()
    keep = []
    for i in range(len(a)):
        k = (*np.round(a[i], 3), *np.round(b[i], 3))
        if k not in same and k[:2] != k[2:]:
            same.add(k)
            keep.append(i)
            grid.setdefault(cell(a[i]), []).append(i)
    used: set[int] = set()

    def after(p: np.ndarray) -> list[int]:
        """Unused parts that start at p, or else the nearest within SNAP."""
        x, y = cell(p)
        near = [(float(np.hypot(*(a[i] - p))), i) for u in (x - 1, x, x + 1) for v in (y - 1, y, y + 1) for i in grid.get((u, v), ()) if i not in used]
        near = sorted(n for n in near if n[0] <= SNAP)
        return [i for d, i in near if d <= max(near[0][0], 2e-3)] if near else []

    rings = []
    for i in keep:
        if i in used:
            continue
        ring, j = [], i
        while True:
            used.add(j)
            ring.append(a[j])
            back = float(np.hypot(*(b[j] - a[i])))
            open_ = after(b[j])
            if not open_ or (back <= 2e-3 and np.hypot(*(a[open_[0]] - b[j])) > back):
                if back > SNAP and len(ring) > 2:
                    raise ValueError("an outline does not close")
                break
            if len(open_) > 1:  # rings touch here: turn left as sharply as can be
                d = b[j] - a[j]
                turn = [np.arctan2(d[0] * (b[x] - a[x])[1] - d[1] * (b[x] - a[x])[0], d @ (b[x] - a[x])) for x in open_]
                open_ = [open_[int(np.argmax(turn))]]
            j = open_[0]
        if len(ring) >= 3:
            rings.append(np.array(ring))
    return rings


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def inside_ring(ring: np.ndarray, point: np.ndarray) -> bool:
    a, b = ring, np.roll(ring, -1, axis=0)
    over = (a[:, 1] > point[1]) != (b[:, 1] > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (b[:, 0] - a[:, 0]) * (point[1] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
    return bool((over & (point[0] < x)).sum() % 2)


def with_holes(rings: list[np.ndarray]) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Each shell, largest first, with its own holes: a hole belongs to the smallest shell around it."""
    shells = sorted((q for q in rings if signed_area(q) > 0), key=lambda q: -signed_area(q))
    holes: list[list[np.ndarray]] = [[] for _ in shells]
    for q in rings:
        if signed_area(q) < 0:
            run = np.roll(q, -1, axis=0) - q
            k = int(np.argmax(np.hypot(run[:, 0], run[:, 1])))
            # a point of the region beside the hole: unlike a corner of the hole it is on no ring, even where rings touch
            beside = q[k] + run[k] / 2 + OFFSET * np.array([-run[k, 1], run[k, 0]]) / np.hypot(*run[k])
            around = [n for n, shell in enumerate(shells) if inside_ring(shell, beside)]
            if not around:
                raise ValueError("a hole lies in no shell")
            holes[around[-1]].append(q)
    return list(zip(shells, holes))
