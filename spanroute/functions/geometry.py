"""Kernels over rings of coordinates, for tasks that Spark parts; a ring is an array of (x, y), not closed."""

from __future__ import annotations

import numpy as np

EARTH_KM = 6371.0088


def inside(points: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Whether points are covered by a ring, its edge included: crossings of a ray, and a test against each edge."""
    x, y = points[:, :1], points[:, 1:]
    a, b = ring, np.roll(ring, -1, axis=0)
    ax, ay, bx, by = a[:, 0], a[:, 1], b[:, 0], b[:, 1]
    cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    on = (cross == 0) & (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
    spans = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        left = x < (bx - ax) * (y - ay) / (by - ay) + ax
    return on.any(1) | ((spans & left).sum(1) % 2 == 1)


def area(ring: np.ndarray) -> float:
    x, y = ring.T
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def area_km2(ring: np.ndarray) -> float:
    """Area on the sphere: edges as in an equal-area cylinder."""
    x, y = np.radians(ring[:, 0]), np.sin(np.radians(ring[:, 1]))
    return area(np.column_stack([x, y])) * EARTH_KM**2


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise from the lowest x: two monotone chains."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(rows: np.ndarray) -> list:
        out: list = []
        for r in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (r[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (r[0] - out[-2][0]):
                out.pop()
            out.append(r)
        return out

    return np.array(chain(p)[:-1] + chain(p[::-1])[:-1])


def simplify(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Points of a line that stray more than ``tolerance`` from what is left (Douglas and Peucker), without recursion."""
    keep, todo = np.zeros(len(line), bool), [(0, len(line) - 1)]
    keep[[0, -1]] = True
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        a, d = line[i], line[j] - line[i]
        rest, length = line[i + 1 : j] - a, np.hypot(*d)
        far = np.abs(d[0] * rest[:, 1] - d[1] * rest[:, 0]) / length if length else np.hypot(*rest.T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return line[keep]


def valid(ring: np.ndarray) -> bool:
    """Finite, three corners at least, some area, and no two edges that cross."""
    if len(ring) < 3 or not np.isfinite(ring).all() or area(ring) == 0:
        return False
    a, b = ring, np.roll(ring, -1, axis=0)

    def side(p, q, r):
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    i, j = np.triu_indices(len(ring), 2)
    apart = ~((i == 0) & (j == len(ring) - 1))
    i, j = i[apart], j[apart]
    return not bool(((side(a[i], b[i], a[j]) * side(a[i], b[i], b[j]) < 0) & (side(a[j], b[j], a[i]) * side(a[j], b[j], b[i]) < 0)).any())


def simplify_ring(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """As :func:`simplify` over the closed ring, at a tolerance halved until the result is valid; else the ring itself."""
    closed = np.vstack([ring, ring[:1]])
    for halvings in range(16):
        out = simplify(closed, tolerance / 2**halvings)[:-1]
        if valid(out):
            return out
    return ring


def clip(ring: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The part of a ring within a box (xmin, ymin, xmax, ymax), edge by edge of the box (Sutherland and Hodgman)."""
    for axis, bound, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        if not len(ring):
            break
        out, held = [], sign * (ring[:, axis] - bound) >= 0
        for p, q, a, b in zip(ring, np.roll(ring, -1, axis=0), held, np.roll(held, -1), strict=True):
            if a:
                out.append(p)
            if a != b:
                out.append(p + (bound - p[axis]) / (q[axis] - p[axis]) * (q - p))
        ring = np.array(out).reshape(-1, 2)
    return ring


def split_antimeridian(ring: np.ndarray, plain: dict[float, float]) -> list[tuple[int, np.ndarray]]:
    """(0, part up to 180 degrees) and (1, part beyond it, 360 degrees less) of a convex ring; one if nothing is beyond.

    ``plain`` gives a corner's longitude before it was counted on, so that it comes back without rounding.
    """
    if all(plain[x] == x for x in ring[:, 0]):
        return [(0, ring)]
    out = []
    for n, (low, high) in enumerate([(-180.0, 180.0), (180.0, 540.0)]):
        part = ring
        if ring[:, 0].min() < low or ring[:, 0].max() > high:
            part = clip(ring, (low, -90.0, high, 90.0))
        if len(part):
            xs = np.clip(part[:, 0], low, high)
            if n:
                xs = np.array([plain[x] if plain.get(x, x) != x else x - 360 for x in xs])
            out.append((n, hull(np.column_stack([xs, part[:, 1]]))))
    return out


def representative(ring: np.ndarray) -> tuple[float, float]:
    """A point within a ring: the middle of the widest stretch at half its height."""
    levels = np.unique(ring[:, 1])
    middle = (levels[0] + levels[-1]) / 2
    below, above = levels[levels <= middle].max(), levels[levels > middle].min() if (levels > middle).any() else levels[-1]
    y = (below + above) / 2
    a, b = ring, np.roll(ring, -1, axis=0)
    hit = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[hit], b[hit]
    xs = np.sort(a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]))
    if len(xs) < 2:
        return float(ring[0, 0]), float(ring[0, 1])
    k = int((xs[1::2] - xs[::2]).argmax())
    return float(xs[2 * k] + xs[2 * k + 1]) / 2, float(y)
