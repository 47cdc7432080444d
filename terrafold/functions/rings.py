"""The geometry tests and encodings that need numbers in arrays.

Spark hands over Arrow batches; each function works on one geometry at a time.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# A type name, or one list of points with the number of brackets before it.
_TOKEN = re.compile(r"([A-Z]{2,})|(\(*)\(([^()]*)\)")


def _simple_parts(wkt: str) -> Iterator[tuple[str, list[list[list[str]]]]]:
    """(type, list of polygons or lines) of each non-collection in ``wkt``; their ordinates as text."""
    kind, parts = None, []
    for name, opened, text in _TOKEN.findall(wkt):
        if name:
            if kind and parts:
                yield kind, parts
            kind, parts = name, []
            continue
        ordinates = text.replace(",", " ").split()
        if kind in ("POLYGON", "MULTIPOLYGON") and not opened and parts:
            parts[-1].append(ordinates)
        else:
            parts.append([ordinates])
    if kind and parts:
        yield kind, parts


def _readable(wkt: str) -> bool:
    """Whether all lists hold pairs of numbers."""
    lists = [a for _, group in _simple_parts(wkt) for polygon in group for a in polygon]
    try:
        np.array([x for a in lists for x in a], dtype=float)
    except ValueError:
        return False
    return not any(len(a) % 2 for a in lists)


def signed_area(ring: np.ndarray) -> float:
    """Positive when the ring runs counter-clockwise."""
    x, y = (ring - ring[0]).T
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2


def _edges(points: np.ndarray, ring: np.ndarray):
    """Edges of rings that lie in a row: (start, end, ring, place in it, edges of the ring).

    Corners repeated one after another make no edge.
    """
    inner = (ring[:-1] == ring[1:]) & (points[:-1] != points[1:]).any(axis=1)
    owner = ring[:-1][inner]
    first = np.searchsorted(owner, owner, "left")
    count = np.searchsorted(owner, owner, "right") - first
    return points[:-1][inner], points[1:][inner], owner, np.arange(len(owner)) - first, count


def _meeting(a: np.ndarray, b: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of edges of one group whose boxes meet.

    One sweep serves all groups; each runs along the axis on which its edges
    are shorter, as a part of the group's own extent.
    """
    low, high = np.minimum(a, b), np.maximum(a, b)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    extent = np.maximum.reduceat(high, starts) - np.minimum.reduceat(low, starts)
    covered = np.add.reduceat(high - low, starts) / np.where(extent > 0, extent, 1)
    turn = (covered[:, 1] < covered[:, 0])[np.cumsum(np.append(False, group[1:] != group[:-1]))]
    low, high = (np.where(turn[:, None], x[:, ::-1], x) for x in (low, high))
    order = np.lexsort((low[:, 0], group))
    low, high, owner = low[order], high[order], group[order]
    i, step = np.arange(len(order)), 1
    while len(i := i[i + step < len(order)]):
        j = i + step
        i = i[(owner[i] == owner[j]) & (low[j, 0] <= high[i, 0])]
        j = i + step
        near = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        if near.any():
            yield order[i[near]], order[j[near]]
        step += 1


#: Rounding of a turn's sum, as a part of its two products.
_ROUNDING = (3 + 16 * np.finfo(float).eps) * np.finfo(float).eps


def _side(p, q, r):
    """On which side of the line p-q the points r lie: exact, by rational numbers where rounding could decide."""
    left, right = (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]), (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    turn = left - right
    side = np.sign(turn)
    unsure = np.abs(turn) <= _ROUNDING * (np.abs(left) + np.abs(right))
    # ends of the line, and points in line with an axis, are on it without rounding
    unsure &= ~((r == p).all(axis=1) | (r == q).all(axis=1)) & ((left != 0) | (right != 0))
    places = np.flatnonzero(unsure)
    if len(places):
        corners = np.concatenate([x[places] for x in (p, q, r)], axis=1)
        small = (np.abs(corners) < 1 << 25).all(axis=1) & (corners == np.rint(corners)).all(axis=1)
        side[places[~small]] = [_exact_side(*row) for row in corners[~small].tolist()]
    return side


def _exact_side(px, py, qx, qy, rx, ry) -> int:
    px, py, qx, qy, rx, ry = map(Fraction, (px, py, qx, qy, rx, ry))
    turn = (qx - px) * (ry - py) - (qy - py) * (rx - px)
    return (turn > 0) - (turn < 0)


def _closes_a_chain(touches: np.ndarray) -> bool:
    """Whether rings and the points where they touch hold a circle: the inside then falls apart.

    touches: (ring, ring, x, y). Rings that share one point are no circle.
    """
    above: dict = {}

    def top(node):
        while node in above:
            node = above[node]
        return node

    links = {(ring, (x, y)) for a, b, x, y in touches.tolist() for ring in (a, b)}
    for ring, point in links:
        one, other = top(ring), top(point)
        if one == other:
            return True
        above[one] = other
    return False


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct row of the columns in order, the number of each row among them)."""
    order = np.lexsort(columns[::-1])
    new = np.arange(len(order)) == 0
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    number = np.empty(len(order), int)
    number[order] = np.cumsum(new) - 1
    return order[new], number


#: Rounds in which ends of chains are taken off all polygons at once, before the rest are followed one by one.
_STRIP_ROUNDS = 16


def _closed_chains(spots: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Polygons whose rings and touching points hold a circle.

    spots: distinct (ring, ring, x, y); of: the polygon of each. Rings and points
    with one link are in no circle; without them, polygons that keep a link have
    one. Polygons with chains too long for a few rounds are followed link by link.
    """
    _, point = _distinct(of, spots[:, 2], spots[:, 3])
    ring, point, polygon = np.append(spots[:, 0], spots[:, 1]).astype(int), np.append(point, point), np.append(of, of)
    links, _ = _distinct(ring, point)
    polygon, ring, point = polygon[links], np.unique(ring[links], return_inverse=True)[1], point[links]
    for _ in range(_STRIP_ROUNDS):
        kept = (np.bincount(ring)[ring] > 1) & (np.bincount(point)[point] > 1)
        if kept.all():
            return np.unique(polygon)
        polygon, ring, point = polygon[kept], ring[kept], point[kept]
    order = np.argsort(of, kind="stable")
    spots, of = spots[order], of[order]
    left = np.unique(polygon)
    ends = zip(left.tolist(), np.searchsorted(of, left, "left"), np.searchsorted(of, left, "right"))
    return np.array([n for n, low, high in ends if _closes_a_chain(spots[low:high])], dtype=int)


def _meetings(a, b, i, j):
    """How pairs of edges meet: (properly crossing, sharing a stretch, touching, where they touch)."""
    p, q, r, s = a[i], b[i], a[j], b[j]
    sides = [_side(p, q, r), _side(p, q, s), _side(r, s, p), _side(r, s, q)]
    cross = (sides[0] * sides[1] < 0) & (sides[2] * sides[3] < 0)
    axis = np.abs(q - p).argmax(axis=1)
    along = lambda x: x[np.arange(len(x)), axis]
    start = np.maximum(np.minimum(along(p), along(q)), np.minimum(along(r), along(s)))
    stop = np.minimum(np.maximum(along(p), along(q)), np.maximum(along(r), along(s)))
    flat = (sides[0] == 0) & (sides[1] == 0) & (start < stop)
    touch, where = np.zeros(len(i), bool), p.copy()
    for side, u, v, point in zip(sides, (p, p, r, r), (q, q, s, s), (r, s, p, q)):
        on = (side == 0) & ((np.minimum(u, v) <= point) & (point <= np.maximum(u, v))).all(axis=1)
        where[on & ~touch] = point[on & ~touch]
        touch |= on
    return cross, flat, touch & ~cross, where


def _ring_faults(points, ring, polygon, geometry) -> tuple[set[int], set[int], set[int], set[int]]:
    """(rings that cross themselves, that touch themselves, geometries whose rings cross or meet twice, whose inside is parted).

    points: corners of rings in a row; ring: the ring of each; polygon and
    geometry: by ring. Rings of a polygon may touch in one point, polygons in
    any number of points; no two rings may cross or share a stretch.
    """
    crossed, touched, between, split, touches = set(), set(), set(), set(), []
    if len(points) < 2:
        return crossed, touched, between, split
    a, b, owner, place, count = _edges(points, ring)
    if not len(a):
        return crossed, touched, between, split
    for i, j in _meeting(a, b, geometry[owner]):
        cross, flat, touch, where = _meetings(a, b, i, j)
        same = owner[i] == owner[j]
        step = np.abs(place[i] - place[j])
        neighbours = same & ((step == 1) | (step == count[i] - 1))
        crossed.update(owner[i[same & cross]].tolist())
        touched.update(owner[i[same & (flat | (touch & ~neighbours))]].tolist())
        between.update(geometry[owner[i[~same & (cross | flat)]]].tolist())
        meet = ~same & touch & (polygon[owner[i]] == polygon[owner[j]])
        pair = np.sort(np.stack([owner[i[meet]], owner[j[meet]]], axis=1), axis=1)
        touches.append(np.column_stack([pair, where[meet]]))
    if touches:
        spots = np.concatenate(touches)
        spots = spots[_distinct(*spots.T)[0]]
        pairs, which = _distinct(spots[:, 0], spots[:, 1])
        between.update(geometry[spots[pairs[np.bincount(which) > 1], 0].astype(int)].tolist())
        of = polygon[spots[:, 0].astype(int)]
        shared, times = np.unique(of, return_counts=True)
        several = np.isin(of, shared[times > 2])  # two touches close no circle of rings that meet once
        if several.any():
            parted = np.isin(of, _closed_chains(spots[several], of[several]))
            split.update(geometry[spots[parted, 0].astype(int)].tolist())
    return crossed, touched, between, split


def inner_point(ring: np.ndarray) -> np.ndarray:
    """A point strictly inside a ring of some area."""
    levels = np.unique(ring[:, 1])
    y = (levels[0] + levels[1]) / 2
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > y) != (b[:, 1] > y)
    a, b = a[over], b[over]
    xs = np.sort(a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]))
    widest = 2 * np.argmax(xs[1::2] - xs[::2])
    return np.array([(xs[widest] + xs[widest + 1]) / 2, y])


def _inner_points(points: np.ndarray, first: np.ndarray, size: np.ndarray, rings: np.ndarray) -> np.ndarray:
    """:func:`inner_point` of each of some rings, which lie in ``points`` at ``first`` with ``size`` corners."""
    at, n = _spread(first[rings], size[rings])
    starts = np.cumsum(size[rings]) - size[rings]
    y = points[at, 1]
    lowest = np.minimum.reduceat(y, starts)
    second = np.minimum.reduceat(np.where(y > lowest[n], y, np.inf), starts)
    level = (lowest + second) / 2
    at, n = _spread(first[rings], size[rings] - 1)
    over = (points[at, 1] > level[n]) != (points[at + 1, 1] > level[n])
    at, n = at[over], n[over]
    a, b = points[at], points[at + 1]
    xs = a[:, 0] + (level[n] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    order = np.lexsort((xs, n))
    left, right, own = xs[order][::2], xs[order][1::2], n[order][::2]  # a closed ring is crossed an even number of times
    crossed, begin = np.unique(own, return_index=True)
    widest = np.lexsort((left - right, own))[begin]  # the first of equal ones
    spots = np.empty((len(rings), 2))
    spots[crossed, 0], spots[:, 1] = (left[widest] + right[widest]) / 2, level
    # numbers too close together, or too large, for the way taken here
    plain = np.bincount(n, minlength=len(rings)) > 0
    plain[n[~np.isfinite(xs)]] = False
    for k in np.flatnonzero(~plain):
        spots[k] = inner_point(points[first[rings[k]] : first[rings[k]] + size[rings[k]]])
    return spots


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, owner): ``count`` places from ``first`` on, one after another, and whose each is."""
    owner = np.repeat(np.arange(len(first)), count)
    return np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner], owner


#: Edges that are looked at in one step.
_STEP_EDGES = 1_000_000


def _holds(points, first, size, rings: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """:func:`inside` of pairs: whether each ring holds the spot beside it."""
    held = np.zeros(len(rings), bool)
    edges = size[rings] - 1
    reached = np.cumsum(edges)
    start = 0
    while start < len(rings):
        before = reached[start] - edges[start]
        stop = max(start + 1, int(np.searchsorted(reached, before + _STEP_EDGES, "right")))
        some = slice(start, stop)
        at, n = _spread(first[rings[some]], edges[some])
        a, b = points[at], points[at + 1]
        x, y = spots[some][n].T
        turn = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
        low, high = np.minimum(a, b), np.maximum(a, b)
        boxed = (low[:, 0] <= x) & (x <= high[:, 0]) & (low[:, 1] <= y) & (y <= high[:, 1])
        rising = (a[:, 1] <= y) & (b[:, 1] > y) & (turn > 0)
        falling = (a[:, 1] > y) & (b[:, 1] <= y) & (turn < 0)
        own = np.cumsum(edges[some]) - edges[some]
        odd = np.add.reduceat((rising | falling).astype(int), own) % 2 == 1
        held[some] = odd | np.logical_or.reduceat((turn == 0) & boxed, own)
        start = stop
    return held


def _misplaced(points, first, size, rings: np.ndarray, shell: np.ndarray, owner: np.ndarray) -> dict[int, str]:
    """What is wrong with where the rings of geometries lie; they do not cross. By geometry, the first fault.

    rings: those to look at, the rings of a polygon and the polygons of a
    geometry in a row; shell and owner: the first ring of the polygon, and the
    geometry, of each.
    """
    at, n = _spread(first[rings], size[rings])
    starts = np.cumsum(size[rings]) - size[rings]
    low, high = (f.reduceat(points[at], starts, axis=0) for f in (np.minimum, np.maximum))
    spots = _inner_points(points, first, size, rings)
    outer = np.searchsorted(rings, shell)  # place of each ring's shell
    hole = outer != np.arange(len(rings))

    def holding(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether the rings ``other`` hold the rings ``one``."""
        held = ((low[other] <= low[one]) & (high[one] <= high[other])).all(axis=1)
        places = np.flatnonzero(held)
        held[places] = _holds(points, first, size, rings[other[places]], spots[one[places]])
        return held

    def nested(which: np.ndarray, group: np.ndarray, clear: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(inner, outer) of rings that lie in each other, for groups not yet marked as not ``clear``."""
        if len(which) < 2:
            return
        for i, j in _meeting(low[which], high[which], group):
            asked = clear[group[i]]
            i, j = which[i[asked]], which[j[asked]]
            for inner, around in ((i, j), (j, i)):
                held = holding(inner, around)
                yield inner[held], around[held]

    outside, overlap = np.zeros(len(rings), bool), np.zeros(len(rings), bool)  # by the place of the shell
    holes = np.flatnonzero(hole)
    outside[outer[holes[~holding(holes, outer[holes])]]] = True
    clear = ~outside
    for inner, _ in nested(holes, outer[holes], clear):
        overlap[outer[inner]] = True
        clear[outer[inner]] = False
    faults: dict[int, str] = {}
    for place in np.flatnonzero(outside | overlap):
        faults.setdefault(int(owner[place]), "hole_outside" if outside[place] else "holes_overlap")
    shells = np.flatnonzero(~hole & ~np.isin(owner, list(faults)))
    geometries, of = np.unique(owner[shells], return_inverse=True)
    clear = np.ones(len(geometries), bool)
    polygon_end = np.searchsorted(outer, np.arange(len(rings)), "right")
    for inner, around in nested(shells, of.reshape(-1), clear):
        # a shell may lie in a hole of the polygon around it
        at, n = _spread(around + 1, polygon_end[around] - around - 1)
        free = np.zeros(len(inner), bool)
        free[n[holding(inner[n], at)]] = True
        for place in inner[~free]:
            faults[int(owner[place])] = "shells_overlap"
        clear[np.searchsorted(geometries, owner[inner[~free]])] = False
    return faults


def inside(ring: np.ndarray, points: np.ndarray) -> bool:
    """Whether all points lie in the ring (even-odd rule) or on its border."""
    a, b = ring[:-1], ring[1:]
    low, high = np.minimum(a, b), np.maximum(a, b)
    per_step = max(1, 1_000_000 // len(ring))
    for start in range(0, len(points), per_step):
        x, y = points[start : start + per_step].T[:, :, None]
        turn = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
        boxed = (low[:, 0] <= x) & (x <= high[:, 0]) & (low[:, 1] <= y) & (y <= high[:, 1])
        on_border = ((turn == 0) & boxed).any(axis=1)
        rising = (a[:, 1] <= y) & (b[:, 1] > y) & (turn > 0)
        falling = (a[:, 1] > y) & (b[:, 1] <= y) & (turn < 0)
        odd = (rising | falling).sum(axis=1) % 2 == 1
        if not (on_border | odd).all():
            return False
    return True


def _issues(wkts: list[str | None]) -> list[str | None]:
    """First defect of each geometry; all lists of points are judged at once."""
    found = ["ok" if w else None for w in wkts]
    flat, sizes, owner, is_line, is_ring, shell = [], [], [], [], [], []
    for n, wkt in enumerate(wkts):
        if not wkt:
            continue
        parts = list(_simple_parts(wkt))
        lists = [a for _, group in parts for polygon in group for a in polygon]
        if not lists or not all(lists) or any(len(a) % 2 for a in lists):
            found[n] = "empty" if _readable(wkt) else "nonfinite"
            continue
        for a in lists:
            flat += a
        for kind, group in parts:
            for polygon in group:
                shell += [len(sizes)] * len(polygon)
                sizes += [len(a) // 2 for a in polygon]
                owner += [n] * len(polygon)
                is_line += ["LINE" in kind] * len(polygon)
                is_ring += ["POLYGON" in kind] * len(polygon)
    if not flat:
        return found

    try:
        points = np.array(flat, dtype=float).reshape(-1, 2)
    except ValueError:  # the others are judged without those that hold no numbers
        rest = [wkt if wkt and _readable(wkt) else None for wkt in wkts]
        return ["nonfinite" if wkt and not left else issue for wkt, left, issue in zip(wkts, rest, _issues(rest))]
    size, owner, shell = np.array(sizes), np.array(owner), np.array(shell)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    last, number = first + size - 1, np.repeat(np.arange(len(size)), size)
    line, ring = np.array(is_line), np.array(is_ring)
    infinite = ~np.logical_and.reduceat(np.isfinite(points).all(axis=1), first)
    points = np.where(np.isfinite(points), points, 0.0)
    spread = np.logical_or.reduceat((points != points[first][number]).any(axis=1), first)
    local = points - points[first][number]
    turns = np.zeros(len(points))
    turns[:-1] = local[:-1, 0] * local[1:, 1] - local[1:, 0] * local[:-1, 1]
    turns[last] = 0
    in_ring = ring[number]
    crossed, touched, between, split = _ring_faults(points[in_ring], number[in_ring], shell, owner)
    marked = lambda rings: np.isin(np.arange(len(size)), list(rings))
    defects = {
        "nonfinite": infinite,
        "short": (line & ~spread) | (ring & (size < 4)),
        "open_ring": ring & (points[first] != points[last]).any(axis=1),
        "self_cross": marked(crossed),
        "zero_area": ring & (np.add.reduceat(turns, first) == 0),
        "self_touch": marked(touched),
    }
    for issue, bad in defects.items():
        for n in np.unique(owner[bad]).tolist():
            if found[n] == "ok":
                found[n] = issue
    for r in np.flatnonzero(ring & (shell != np.arange(len(size))) & np.isin(owner, list(between))).tolist():
        around, own = (points[first[k] : first[k] + size[k]] for k in (shell[r], r))
        if found[owner[r]] == "ok" and not inside(around, own):
            found[owner[r]] = "hole_outside"
    for n in between:
        if found[n] == "ok":
            found[n] = "rings_cross"
    several = np.bincount(owner[ring], minlength=len(wkts)) > 1
    asked = np.flatnonzero(ring & (several & np.array([issue == "ok" for issue in found]))[owner])
    if len(asked):
        faults = _misplaced(points, first, size, asked, shell[asked], owner[asked])
        for n in np.unique(owner[asked]).tolist():
            found[n] = faults.get(n) or ("interior_split" if n in split else "ok")
    return found


# Called non-deterministic so that Spark leaves a validity filter where the plan
# puts it, behind the joins that thin out the rows, instead of moving it below.
@F.pandas_udf(T.StringType())
def _issue_udf(wkt: pd.Series) -> pd.Series:
    return pd.Series(_issues(wkt.tolist()), dtype=object)


_issue_udf = _issue_udf.asNondeterministic()


def geometry_issue(wkt: Column) -> Column:
    """First defect of a geometry, or "ok".

    Points and lines are judged by Spark itself; only geometries with rings,
    and mixed ones, take the way through Arrow.
    """
    kind = F.substring_index(wkt, " ", 1)
    number = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
    finite = lambda p: F.rlike(p, F.lit(rf"^{number} {number}$")) & ~F.concat(
        F.substring_index(p, " ", 1).try_cast("double"),
        F.substring_index(p, " ", -1).try_cast("double"),
    ).contains("Infinity")
    pair = lambda p: F.struct(
        F.substring_index(p, " ", 1).try_cast("double").alias("x"),
        F.substring_index(p, " ", -1).try_cast("double").alias("y"),
    )
    points = F.split(F.regexp_extract(wkt, r"(?s)^[A-Z]+ \((.*)\)$", 1), ", *")
    complex_only = F.when(
        ~kind.isin("POINT", "LINESTRING") & ~F.endswith(wkt, F.lit("EMPTY")), wkt
    )
    line_issue = (
        F.when(~F.forall(points, finite), "nonfinite")
        .when(~F.exists(points, lambda p: pair(p) != pair(F.get(points, F.lit(0)))), "short")
        .otherwise("ok")
    )
    return (
        F.when(F.coalesce(F.trim(wkt), F.lit("")) == "", "empty")
        .when(F.endswith(wkt, F.lit("EMPTY")), "empty")
        .when(
            kind == "POINT",
            F.when((F.size(points) == 1) & F.forall(points, finite), "ok").otherwise("nonfinite"),
        )
        .when(kind == "LINESTRING", line_issue)
        .otherwise(_issue_udf(complex_only))
    )


def _close_up(lines: list[np.ndarray]) -> list[np.ndarray] | None:
    """Join lines end to end into rings; null when one stays open."""
    rings = [a for a in lines if (a[0] == a[-1]).all()]
    open_lines = [a for a in lines if not (a[0] == a[-1]).all()]
    at_end: dict[tuple, set[int]] = {}
    for n, a in enumerate(open_lines):
        for end in (tuple(a[0]), tuple(a[-1])):
            at_end.setdefault(end, set()).add(n)
    left = set(range(len(open_lines)))
    while left:
        first = min(left)
        left.discard(first)
        chain = [open_lines[first]]
        start, end = tuple(chain[0][0]), tuple(chain[0][-1])
        while end != start:
            following = at_end[end] & left
            if not following:
                return None
            n = min(following)
            left.discard(n)
            a = open_lines[n]
            a = a if tuple(a[0]) == end else a[::-1]
            chain.append(a[1:])
            end = tuple(a[-1])
        rings.append(np.concatenate(chain))
    return [part for ring in rings for part in _apart(ring)]


def _apart(ring: np.ndarray) -> list[np.ndarray]:
    """Rings that pass no corner twice, from one that may."""
    keep = np.append(True, (ring[1:] != ring[:-1]).any(axis=1))
    ring = ring[keep]
    if len(np.unique(ring[:-1], axis=0)) == len(ring) - 1:
        return [ring]
    rings, path, place = [], [], {}
    for corner in map(tuple, ring):
        if corner in place:
            start = place[corner]
            loop = path[start:]
            rings.append(np.array([*loop, corner]))
            for gone in loop[1:]:
                del place[gone]
            del path[start + 1 :]
        else:
            place[corner] = len(path)
            path.append(corner)
    return rings


def _canonical(ring: np.ndarray, counter_clockwise: bool) -> np.ndarray:
    """Start at the smallest corner and run in the given direction."""
    if (signed_area(ring) > 0) != counter_clockwise:
        ring = ring[::-1]
    corners = ring[:-1]
    first = np.lexsort((corners[:, 1], corners[:, 0]))[0]
    turned = np.roll(corners, -first, axis=0)
    return np.vstack([turned, turned[:1]])


def _nesting(rings: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """How many rings hold each ring, and the smallest one that does."""
    low = np.array([r.min(axis=0) for r in rings])
    high = np.array([r.max(axis=0) for r in rings])
    area = np.array([abs(signed_area(r)) for r in rings])
    depth, parent = np.zeros(len(rings), dtype=int), [-1] * len(rings)
    for n, ring in enumerate(rings):
        boxes = (low <= low[n]).all(axis=1) & (high >= high[n]).all(axis=1) & (area > area[n])
        spot = inner_point(ring)[None]  # the rings may touch, so no corner will do
        holders = [m for m in np.flatnonzero(boxes) if inside(rings[m], spot)]
        depth[n] = len(holders)
        if holders:
            parent[n] = min(holders, key=lambda m: area[m])
    return depth, parent


def _multipolygon(lines: list[np.ndarray]) -> str | None:
    rings = _close_up(lines)
    if not rings or any(len(r) < 4 or signed_area(r) == 0 for r in rings):
        return None
    depth, parent = _nesting(rings)
    number = lambda v: repr(float(v)).removesuffix(".0")
    text = lambda r: "(" + ",".join(f"{number(x)} {number(y)}" for x, y in r) + ")"
    shells = {n: _canonical(rings[n], True) for n in range(len(rings)) if depth[n] % 2 == 0}
    holes: dict[int, list[np.ndarray]] = {n: [] for n in shells}
    for n in range(len(rings)):
        if depth[n] % 2:
            holes[parent[n]].append(_canonical(rings[n], False))
    in_order = lambda r: r.ravel().tolist()
    polygons = [
        "(" + ",".join(map(text, [shells[n], *sorted(holes[n], key=in_order)])) + ")"
        for n in sorted(shells, key=lambda n: in_order(shells[n]))
    ]
    return "MULTIPOLYGON (" + ",".join(polygons) + ")"


@F.pandas_udf(T.StringType())
def assemble_multipolygon(xs: pd.Series, ys: pd.Series, lengths: pd.Series) -> pd.Series:
    """WKT of the area whose border lines lie end to end in ``xs`` and ``ys``.

    Null where the columns are null, the lists empty or the lines do not close.
    """
    out = []
    for x, y, sizes in zip(xs, ys, lengths):
        if x is None or not len(sizes):
            out.append(None)
            continue
        points = np.column_stack([x, y])
        out.append(_multipolygon(np.split(points, np.cumsum(sizes)[:-1])))
    return pd.Series(out, dtype=object)


# Likewise: a test of the result for null must not be moved below and chain
# the lines a second time.
assemble_multipolygon = assemble_multipolygon.asNondeterministic()


# Executors need no copy of the package: the functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
