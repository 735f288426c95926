"""Well-known binary of polygons: Arrow batches to rings, rings to bytes."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np

POLYGON, MULTIPOLYGON = 3, 6
#: Flags of the extended form, beside the thousands of the standard one.
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000


def polygons(data: bytes) -> Iterator[list[np.ndarray]]:
    """The polygons of a polygon or multipolygon, each as its rings (the shell first) of (x, y) rows as they stand, closed.

    Either byte order, further ordinates, which are dropped, and a leading reference system
    are read. Other kinds, cut or trailing bytes raise ``ValueError``.
    """
    try:
        found, end = _read(memoryview(data), 0)
    except struct.error as e:
        raise ValueError("well-known binary ends early") from e
    if end != len(data):
        raise ValueError("bytes after the end of well-known binary")
    yield from found


def _read(data: memoryview, at: int, only: int | None = None) -> tuple[list[list[np.ndarray]], int]:
    order = "<>"[data[at] == 0] if len(data) > at else "<"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if code & HAS_SRID:
        at += 4
    kind = code & 0x0FFFFFFF
    dims = 2 + bool(code & HAS_Z) + bool(code & HAS_M) + {0: 0, 1: 1, 2: 1, 3: 2}.get(kind // 1000, 9)
    kind %= 1000
    if kind not in ((POLYGON, MULTIPOLYGON) if only is None else (only,)) or dims > 4:
        raise ValueError(f"no polygon: kind {code}")
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if kind == MULTIPOLYGON:
        out = []
        for _ in range(n):
            part, at = _read(data, at, POLYGON)
            out += part
        return out, at
    rings = []
    for _ in range(n):
        (m,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if at + 8 * dims * m > len(data):
            raise ValueError("well-known binary ends early")
        rings.append(np.frombuffer(data, order + "f8", dims * m, at).reshape(m, dims)[:, :2].astype("<f8"))
        at += 8 * dims * m
    return ([rings] if rings else []), at


def encode(parts: Iterable[list[np.ndarray]]) -> bytes:
    """A polygon, or a multipolygon of none or several, of rings that are closed here if they aren't."""
    out = []
    for rings in parts:
        body = [struct.pack("<BII", 1, POLYGON, len(rings))]
        for r in rings:
            r = np.asarray(r, "<f8")
            if len(r) and (r[0] != r[-1]).any():
                r = np.vstack([r, r[:1]])
            body.append(struct.pack("<I", len(r)) + r.tobytes())
        out.append(b"".join(body))
    return out[0] if len(out) == 1 else struct.pack("<BII", 1, MULTIPOLYGON, len(out)) + b"".join(out)


def signed_area(ring: np.ndarray) -> float:
    """Positive if the ring, closed or not, runs counter-clockwise."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2


def trace(starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Simple rings of directed edges that have the interior to their left: shells run counter-clockwise, holes clockwise.

    At a corner that several edges leave, the sharpest turn to the left stays with one face;
    a walk that comes by one corner twice falls into two rings there. Edges are joined by
    equal coordinates; those that lead nowhere are left out. Rings come without the last point.
    """
    corners, ids = np.unique(np.vstack([starts, ends]), axis=0, return_inverse=True)
    ids = ids.reshape(-1)
    a, b = ids[: len(starts)], ids[len(starts) :]
    angle = np.arctan2(ends[:, 1] - starts[:, 1], ends[:, 0] - starts[:, 0])
    order = np.argsort(a, kind="stable")
    first = np.searchsorted(a[order], np.arange(len(corners) + 1))
    used, out = np.zeros(len(a), bool), []
    for begin in range(len(a)):
        walk, at, edge = [], {}, begin
        while edge >= 0 and not used[edge]:
            used[edge] = True
            corner = int(a[edge])
            if corner in at:  # the walk closes a ring here, and goes on from it
                cut = at[corner]
                ring, walk = walk[cut:], walk[:cut]
                for c in ring:
                    del at[c]
                if len(ring) > 2:
                    out.append(corners[ring])
            at[corner] = len(walk)
            walk.append(corner)
            end = int(b[edge])
            ways = [e for e in order[first[end] : first[end + 1]] if not used[e]]
            turn = (angle[ways] - angle[edge] + np.pi) % (2 * np.pi) if ways else ()  # from a turn about, to the right, to the left
            edge, last = (int(ways[int(np.argmax(turn))]) if len(ways) else -1), end
        if walk and last in at and len(walk) - at[last] > 2:
            out.append(corners[walk[at[last] :]])
    return out


def nest(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons of simple rings as :func:`trace` gives them: each hole goes to the smallest shell around it."""
    sized = [(signed_area(r), r) for r in rings]
    shells = sorted(((s, r) for s, r in sized if s > 0), key=lambda v: v[0])
    polygons_ = [[r] for _, r in shells]
    boxes = np.array([[*r.min(0), *r.max(0)] for _, r in shells]).reshape(-1, 4)
    for size, hole in sized:
        if size >= 0:
            continue
        low, high = hole.min(0), hole.max(0)
        around = np.flatnonzero((boxes[:, :2] <= low).all(1) & (boxes[:, 2:] >= high).all(1))
        for k in around:
            if shells[k][0] > -size and _holds(shells[k][1], hole):
                polygons_[k].append(hole)
                break
    return polygons_


def _holds(shell: np.ndarray, hole: np.ndarray) -> bool:
    """Whether most of a hole's edges have their middle in a shell that they don't cross; touching corners don't decide."""
    middle = (hole + np.roll(hole, -1, axis=0)) / 2
    middle = middle[:: max(1, len(middle) // 64)]
    a, b = shell, np.roll(shell, -1, axis=0)
    votes = 0
    for x, y in middle:
        span = (a[:, 1] > y) != (b[:, 1] > y)
        p, q = a[span], b[span]
        votes += int((x < (q[:, 0] - p[:, 0]) * (y - p[:, 1]) / (q[:, 1] - p[:, 1]) + p[:, 0]).sum() % 2)
    return 2 * votes > len(middle)
