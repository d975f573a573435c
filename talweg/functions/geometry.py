"""Planar geometry on coordinate arrays (n x 2), in NumPy. Polygons are lists of rings, the first the shell."""

from __future__ import annotations

import math
import struct

import numpy as np


# --- well-known binary -------------------------------------------------------------------------------------------------
def encode_wkb(kind: str, coordinates) -> bytes:
    """Point, LineString, Polygon and their Multi forms, little-endian."""
    code = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}[kind]
    head = struct.pack("<BI", 1, code)
    line = lambda c: struct.pack("<I", len(c)) + np.asarray(c, "<f8").reshape(-1, 2).tobytes()
    if code == 1:
        return head + struct.pack("<2d", *coordinates)
    if code == 2:
        return head + line(coordinates)
    if code == 3:
        return head + struct.pack("<I", len(coordinates)) + b"".join(line(r) for r in coordinates)
    return head + struct.pack("<I", len(coordinates)) + b"".join(encode_wkb(kind[5:], c) for c in coordinates)


def decode_wkb(raw: bytes) -> tuple[str, list]:
    """(kind, coordinates): as encode_wkb takes them."""
    def one(at: int):
        order = "<" if raw[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", raw, at + 1)
        at, code = at + 5, code & 0xFF
        number = lambda a: struct.unpack_from(order + "I", raw, a)[0]

        def line(a: int):
            n = number(a)
            return np.frombuffer(raw, order + "f8", 2 * n, a + 4).reshape(n, 2).tolist(), a + 4 + 16 * n

        if code == 1:
            return "Point", list(struct.unpack_from(order + "2d", raw, at)), at + 16
        if code == 2:
            return "LineString", *line(at)
        n, at, parts = number(at), at + 4, []
        for _ in range(n):
            if code == 3:
                part, at = line(at)
            else:
                _, part, at = one(at)
            parts.append(part)
        return {3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}[code], parts, at

    return one(0)[:2]


# --- measures ----------------------------------------------------------------------------------------------------------
def ring_area(ring) -> float:
    """Signed; counter-clockwise is positive."""
    p = np.asarray(ring, float)
    if len(p) < 3:
        return 0.0
    p = p - p[0]
    x, y = p[:, 0], p[:, 1]
    return float(0.5 * np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y))


def polygon_area(rings) -> float:
    return abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:]) if len(rings) else 0.0


def line_length(line) -> float:
    p = np.asarray(line, float)
    return float(np.hypot(*np.diff(p, axis=0).T).sum()) if len(p) > 1 else 0.0


def bounds(points) -> tuple[float, float, float, float]:
    p = np.asarray(points, float)
    return (*p.min(axis=0).tolist(), *p.max(axis=0).tolist())


def inside(x, y, rings) -> np.ndarray:
    """Even-odd rule over all rings, for arrays of points."""
    x, y = np.atleast_1d(np.asarray(x, float)), np.atleast_1d(np.asarray(y, float))
    odd = np.zeros(x.shape, bool)
    for ring in rings:
        p = np.asarray(ring, float)
        for (ax, ay), (bx, by) in zip(p, np.roll(p, -1, axis=0)):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return odd


def _edges(polygons) -> np.ndarray:
    out = []
    for ring in polygons:
        p = np.asarray(ring, float)
        out.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    e = np.vstack(out) if out else np.empty((0, 4))
    return e[e[:, 1] != e[:, 3]]


def _slab_cuts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Heights between which no edge begins, ends or crosses another."""
    ys = [a[:, 1], a[:, 3], b[:, 1], b[:, 3]]
    for e, f in ((a, b),):
        for ax, ay, bx, by in e:
            d1x, d1y = bx - ax, by - ay
            d2x, d2y = f[:, 2] - f[:, 0], f[:, 3] - f[:, 1]
            cross = d1x * d2y - d1y * d2x
            with np.errstate(all="ignore"):
                s = ((f[:, 0] - ax) * d2y - (f[:, 1] - ay) * d2x) / cross
                t = ((f[:, 0] - ax) * d1y - (f[:, 1] - ay) * d1x) / cross
            hit = (cross != 0) & (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)
            ys.append(ay + s[hit] * d1y)
    return np.unique(np.concatenate(ys)) if ys else np.empty(0)


def overlap_area(a, b) -> float:
    """Area that two polygons (lists of rings, even-odd) share: between two neighbouring heights both are trapezoids."""
    ea, eb = _edges(a), _edges(b)
    if not len(ea) or not len(eb):
        return 0.0
    cuts, total = _slab_cuts(ea, eb), 0.0
    for low, high in zip(cuts[:-1], cuts[1:]):
        mid = (low + high) / 2
        if high <= low:
            continue

        def spans(e):
            own = e[(np.minimum(e[:, 1], e[:, 3]) <= mid) & (np.maximum(e[:, 1], e[:, 3]) >= mid)]
            at = lambda y: own[:, 0] + (y - own[:, 1]) * (own[:, 2] - own[:, 0]) / (own[:, 3] - own[:, 1])
            order = np.argsort(at(mid))
            return at(low)[order], at(mid)[order], at(high)[order]

        la, ma, ha = spans(ea)
        lb, mb, hb = spans(eb)
        for i in range(0, len(ma) - 1, 2):
            for j in range(0, len(mb) - 1, 2):
                if min(ma[i + 1], mb[j + 1]) > max(ma[i], mb[j]):
                    left = [max((v[0][i], v[1][j])) for v in ((la, lb), (ha, hb))]
                    right = [min((v[0][i + 1], v[1][j + 1])) for v in ((la, lb), (ha, hb))]
                    total += (max(right[0] - left[0], 0.0) + max(right[1] - left[1], 0.0)) / 2 * (high - low)
    return float(total)


def difference_area(a, b) -> float:
    return max(polygon_area(a) - overlap_area(a, b), 0.0)


def symmetric_difference_area(a, b) -> float:
    return max(polygon_area(a) + polygon_area(b) - 2 * overlap_area(a, b), 0.0)


def hausdorff(a, b) -> float:
    p, q = np.asarray(a, float), np.asarray(b, float)
    d = np.hypot(p[:, None, 0] - q[None, :, 0], p[:, None, 1] - q[None, :, 1])
    return float(max(d.min(axis=1).max(), d.min(axis=0).max()))


# --- constructions -----------------------------------------------------------------------------------------------------
def interior_point(rings) -> tuple[float, float]:
    """The middle of the widest run inside, on the line at half height."""
    p = np.asarray(rings[0], float)
    y = (p[:, 1].min() + p[:, 1].max()) / 2
    heights = np.unique(np.concatenate([np.asarray(r, float)[:, 1] for r in rings]))
    if y in heights and len(heights) > 1:  # not through a corner
        above = heights[heights > y]
        y = (y + above[0]) / 2 if len(above) else y
    xs = []
    for ring in rings:
        q = np.asarray(ring, float)
        for (ax, ay), (bx, by) in zip(q, np.roll(q, -1, axis=0)):
            if (ay > y) != (by > y):
                xs.append(ax + (y - ay) * (bx - ax) / (by - ay))
    xs.sort()
    runs = list(zip(xs[::2], xs[1::2]))
    if not runs:
        return tuple(p.mean(axis=0).tolist())
    a, b = max(runs, key=lambda r: r[1] - r[0])
    return (a + b) / 2, float(y)


def along(line, share: float) -> tuple[float, float]:
    """The point at a share of a line's length."""
    p = np.asarray(line, float)
    steps = np.hypot(*np.diff(p, axis=0).T)
    goal, before = steps.sum() * share, np.concatenate([[0], np.cumsum(steps)])
    i = min(int(np.searchsorted(before, goal, "right")) - 1, len(steps) - 1)
    t = 0.0 if steps[i] == 0 else (goal - before[i]) / steps[i]
    return tuple((p[i] + t * (p[i + 1] - p[i])).tolist())


def convex_hull(points) -> list[tuple[float, float]]:
    """Counter-clockwise corners, not closed; fewer than three for points on one line."""
    p = sorted(set(map(tuple, np.asarray(points, float).tolist())))
    if len(p) < 3:
        return p

    def half(seq):
        out = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return half(p) + half(p[::-1])


def buffer_convex(corners, radius: float, quadrant: int = 16) -> list[tuple[float, float]]:
    """A convex outline widened by a disk of 4 * quadrant corners: the hull of the disks around its corners."""
    turn = np.arange(4 * quadrant) * (math.pi / 2 / quadrant)
    disk = np.column_stack([np.cos(turn), np.sin(turn)]) * radius
    return convex_hull((np.asarray(corners, float)[:, None, :] + disk[None]).reshape(-1, 2))


def simplify(line, tolerance: float) -> list[tuple[float, float]]:
    """Douglas-Peucker: both ends stay, and each left-out point is within the tolerance."""
    p = np.asarray(line, float)
    keep, todo = np.zeros(len(p), bool), [(0, len(p) - 1)]
    keep[[0, -1]] = True
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d, m = p[b] - p[a], p[a + 1 : b]
        size = float(d @ d)
        t = np.clip((m - p[a]) @ d / size, 0, 1) if size else np.zeros(len(m))
        off = np.hypot(*(m - (p[a] + t[:, None] * d)).T)
        i = int(off.argmax())
        if off[i] > tolerance:
            keep[a + 1 + i] = True
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return [tuple(x) for x in p[keep].tolist()]


def simplify_ring(ring, tolerance: float) -> list[tuple[float, float]]:
    """A closed ring, opened at its first and its farthest corner; a ring that would collapse stays as it is."""
    p = [tuple(x) for x in np.asarray(ring, float).tolist()]
    closed = p if p[0] == p[-1] else [*p, p[0]]
    far = int(np.hypot(*(np.asarray(closed) - closed[0]).T).argmax())
    out = simplify(closed[: far + 1], tolerance)[:-1] + simplify(closed[far:], tolerance)
    return out if len(out) >= 4 else closed


def round_coordinates(value, digits: int):
    return [round_coordinates(v, digits) for v in value] if isinstance(value, (list, tuple)) else round(value, digits)


def tidy_rings(rings, digits: int = 5) -> list:
    """Rounded rings without repeated points; those without area go. (An approximation of validity repair.)"""
    out = []
    for ring in rings:
        p = [tuple(x) for x in round_coordinates([list(map(float, x)) for x in ring], digits)]
        p = [x for i, x in enumerate(p) if i == 0 or x != p[i - 1]]
        if len(p) >= 4 and abs(ring_area(p)) > 0:
            out.append(p)
    return out


def stitch(segments) -> list[list]:
    """Closed rings from way segments in any order and direction; leftovers that close no ring are dropped."""
    left, rings = [list(map(tuple, s)) for s in segments if len(s) > 1], []
    while left:
        ring = left.pop(0)
        grown = True
        while ring[0] != ring[-1] and grown:
            grown = False
            for i, s in enumerate(left):
                if s[0] == ring[-1] or s[-1] == ring[-1]:
                    ring += (s if s[0] == ring[-1] else s[::-1])[1:]
                    left.pop(i)
                    grown = True
                    break
        if ring[0] == ring[-1] and len(ring) >= 4:
            rings.append(ring)
    return rings


def dissolve(polygons) -> list[list]:
    """The outline of polygons that share whole edges: edges used in both directions cancel."""
    edges: dict = {}
    for rings in polygons:
        for k, ring in enumerate(rings):
            p = [tuple(x) for x in np.asarray(ring, float).tolist()]
            p = p[:-1] if p[0] == p[-1] else p
            if (ring_area(p) > 0) != (k == 0):
                p = p[::-1]
            for a, b in zip(p, [*p[1:], p[0]]):
                if edges.pop((b, a), None) is None:
                    edges[(a, b)] = True
    after: dict = {}
    for a, b in edges:
        after.setdefault(a, []).append(b)
    rings = []
    while after:
        start = next(iter(after))
        ring = [start]
        while True:
            options = after[ring[-1]]
            ring.append(options.pop())
            if not options:
                del after[ring[-2]]
            if ring[-1] == start:
                break
        rings.append(ring)
    return sorted(rings, key=lambda r: -abs(ring_area(r)))
