"""Geometries of any shape and depth as flat lists, in numpy passes over a batch.

A geometry is a list of parts in the order of its text: a type code and a count
each, and one list of ordinates. A point or list of points (code 0: a ring)
counts its points, everything else the parts directly below it. Nothing here
recurses, so collections may nest without limit. WKT is parsed by the places of
its brackets and commas: sorted by depth and place, the bracket before a place
is the one it stands in.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# --- Fixed values -----------------------------------------------------------
# Type codes of the binary form.
CODES = {
    "POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTILINESTRING": 5, "MULTIPOLYGON": 6, "GEOMETRYCOLLECTION": 7,
}
# --- End of fixed values ----------------------------------------------------

RING = 0
_NAMES = {code: name for name, code in CODES.items()}
#: What an unnamed bracket is, by what it stands in.
_INSIDE = np.full(8, -1)
_INSIDE[[3, 5, 6]] = [RING, 2, 3]
_NAMED = re.compile(rb"([A-Z]{4,})(?= \()")
_NO_NAME = re.compile(rb"[A-Z]{4,} (?=\()")
_STRANGE = re.compile(rb"[^-+0-9.eE,() ]")
_WORDS = re.compile(rb"(?i)nan|inf(?:inity)?")
_BLANK = bytes.maketrans(b",()\n", b"    ")

FLAT = T.StructType(
    [T.StructField(n, T.ArrayType(k)) for n, k in (("codes", T.IntegerType()), ("counts", T.IntegerType()), ("ordinates", T.DoubleType()))]
)


def _parsed(texts: list[bytes]):
    """(codes, counts, first part of each text, ordinates, first ordinate of each text); ValueError if one is no WKT."""
    named = [_NAMED.findall(t) for t in texts]
    data = b"\n".join(_NO_NAME.sub(b"\x01", t) for t in texts) + b"\n"
    if _STRANGE.search(_WORDS.sub(b"0", data.replace(b"\x01", b"").replace(b"\n", b""))):
        raise ValueError("no WKT")
    signs = np.frombuffer(data, np.uint8)
    opens, closes = np.flatnonzero(signs == 40), np.flatnonzero(signs == 41)
    ends = np.flatnonzero(signs == 10)
    depth = np.cumsum((signs == 40).astype(np.int64) - (signs == 41))
    if len(opens) != len(closes) or depth.min(initial=0) < 0 or depth[ends].any():
        raise ValueError("brackets")
    is_named = np.zeros(len(opens), bool)
    is_named[opens > 0] = signs[opens[opens > 0] - 1] == 1
    names = [n.decode() for row in named for n in row]
    codes = np.full(len(opens), -1)
    if is_named.sum() != len(names):
        raise ValueError("names")
    codes[is_named] = [CODES.get(n, -2) for n in names]
    # the bracket before a place, of those one level up
    level, length = depth[opens], len(signs) + 1
    order = np.argsort(level * length + opens, kind="stable")
    keys = (level * length + opens)[order]

    def around(places, levels):
        found = np.searchsorted(keys, levels * length + places) - 1
        return np.where(found >= 0, order[np.maximum(found, 0)], -1)

    parent = np.where(level > 1, around(opens, level - 1), -1)
    for _ in range(2):  # a ring of a polygon of several stands two brackets below a name
        own = (codes == -1) & (parent >= 0)
        codes[own] = _INSIDE[np.maximum(codes[parent[own]], 0)]
    inner = parent[is_named]
    if (codes < 0).any() or (codes[inner[inner >= 0]] != 7).any():
        raise ValueError("parts")
    # every text is one named geometry
    first = np.append(0, np.searchsorted(opens, ends))
    roots = np.bincount(np.searchsorted(ends, opens[level == 1]), minlength=len(ends))
    if (roots != 1).any() or not is_named[first[:-1]].all():
        raise ValueError("roots")
    commas = np.flatnonzero(signs == 44)
    if (depth[commas] < 1).any():
        raise ValueError("commas")
    counts = np.bincount(around(commas, depth[commas]), minlength=len(opens)) + 1
    leaf = codes <= 2
    below = np.bincount(parent[parent >= 0], minlength=len(opens))
    if (below[leaf] > 0).any() or (below[~leaf] != counts[~leaf]).any() or (counts[codes == 1] != 1).any():
        raise ValueError("counts")
    blanks = np.flatnonzero(signs == 32)
    if (depth[blanks] < 1).any() or (np.bincount(around(blanks, depth[blanks]), minlength=len(opens)) != np.where(leaf, counts, 0)).any():
        raise ValueError("points")
    ordinates = np.array(data.replace(b"\x01", b"").translate(_BLANK).split(), float)
    total = np.append(0, np.cumsum(np.where(leaf, counts, 0)))
    if len(ordinates) != 2 * total[-1]:
        raise ValueError("ordinates")
    return codes, counts, first, ordinates, 2 * total[first]


def parsed(texts: list[str | None]) -> list[tuple | None]:
    """(codes, counts, ordinates) of each WKT; None where it is none. A batch with a bad text is halved."""
    found: list[tuple | None] = [None] * len(texts)
    stack = [[i for i, t in enumerate(texts) if t]]
    while stack:
        rows = stack.pop()
        if not rows:
            continue
        try:
            codes, counts, first, ordinates, begin = _parsed([texts[i].strip().encode() for i in rows])
        except ValueError:
            if len(rows) > 1:
                stack += [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
            continue
        for k, i in enumerate(rows):
            parts = slice(first[k], first[k + 1])
            found[i] = codes[parts], counts[parts], ordinates[begin[k] : begin[k + 1]]
    return found


def wkb_of(geometries: list[tuple | None]) -> list[bytes | None]:
    """Little-endian WKB of flat geometries, written in one buffer."""
    there = [g for g in geometries if g is not None]
    if not there:
        return [None] * len(geometries)
    codes, counts, ordinates = (np.concatenate([g[i] for g in there]) for i in range(3))
    leaf = codes <= 2
    head, count = np.where(codes != RING, 5, 0), np.where(codes != 1, 4, 0)
    size = head + count + np.where(leaf, 16 * counts, 0)
    at = np.append(0, np.cumsum(size))
    out = np.zeros(at[-1], np.uint8)
    named = codes != RING
    out[at[:-1][named]] = 1
    for where, values in ((at[:-1][named] + 1, codes[named]), ((at[:-1] + head)[codes != 1], counts[codes != 1])):
        out[where[:, None] + np.arange(4)] = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    points = counts[leaf]
    begin = np.repeat((at[:-1] + head + count)[leaf], points) + 16 * (np.arange(points.sum()) - np.repeat(np.cumsum(points) - points, points))
    out[begin[:, None] + np.arange(16)] = ordinates.astype("<f8").view(np.uint8).reshape(-1, 16)
    cuts = at[np.append(0, np.cumsum([len(g[0]) for g in there]))]
    data = out.tobytes()
    made = iter([data[a:b] for a, b in zip(cuts, cuts[1:])])
    return [None if g is None else next(made) for g in geometries]


def wkt_of(geometry: tuple) -> str:
    """WKT of a flat geometry; whole ordinates without a point."""
    codes, counts, ordinates = geometry
    numbers = [repr(v).removesuffix(".0") for v in np.asarray(ordinates, float).tolist()]
    pieces, open_, at = [], [], 0
    within = 0
    for code, count in zip(np.asarray(codes).tolist(), np.asarray(counts).tolist()):
        named = code != RING and (not open_ or within == CODES["GEOMETRYCOLLECTION"])
        pieces.append(f"{_NAMES[code]} (" if named else "(")
        if code <= 2:
            pieces.append(",".join(f"{numbers[i]} {numbers[i + 1]}" for i in range(at, at + 2 * count, 2)))
            at += 2 * count
            pieces.append(")")
            while open_:
                open_[-1][1] -= 1
                if open_[-1][1]:
                    pieces.append(",")
                    break
                open_.pop()
                pieces.append(")")
        else:
            open_.append([code, count])
        within = open_[-1][0] if open_ else 0
    return "".join(pieces)


def unpacked(data: bytes) -> tuple:
    """The flat geometry of little-endian WKB."""
    import struct

    codes, counts, points, at = [], [], [], 0
    left: list[list[int]] = []
    while True:
        ring = bool(left) and left[-1][0] == CODES["POLYGON"]
        code = RING if ring else struct.unpack_from("<I", data, at + 1)[0]
        at += 0 if ring else 5
        count = 1
        if code != CODES["POINT"]:
            count = struct.unpack_from("<I", data, at)[0]
            at += 4
        codes.append(code)
        counts.append(count)
        if code <= 2:
            points.append(np.frombuffer(data, "<f8", 2 * count, at))
            at += 16 * count
            while left:
                left[-1][1] -= 1
                if left[-1][1]:
                    break
                left.pop()
        else:
            left.append([code, count])
        if not left:
            return np.array(codes), np.array(counts), np.concatenate(points)


@F.pandas_udf(FLAT)
def wkt_to_flat(wkt: pd.Series) -> pd.DataFrame:
    """Flat form of WKT of any shape; null lists where it cannot be read."""
    found = parsed([w if isinstance(w, str) else None for w in wkt])
    columns = [[None if g is None else g[i] for g in found] for i in range(3)]
    return pd.DataFrame(dict(zip(("codes", "counts", "ordinates"), (pd.Series(c, dtype=object) for c in columns))))


@F.pandas_udf(T.StringType())
def flat_to_wkt(flat: pd.DataFrame) -> pd.Series:
    """WKT of a flat geometry; null where it has no parts."""
    rows = zip(flat["codes"], flat["counts"], flat["ordinates"])
    return pd.Series([None if c is None else wkt_of((c, n, o)) for c, n, o in rows], dtype=object)


@F.pandas_udf(T.BinaryType())
def to_wkb(wkt: pd.Series) -> pd.Series:
    """Little-endian WKB of WKT of any shape; null when it cannot be read."""
    return pd.Series(wkb_of(parsed([w if isinstance(w, str) else None for w in wkt])), dtype=object)


@F.pandas_udf(T.StringType())
def from_wkb(wkb: pd.Series) -> pd.Series:
    """WKT of the WKB that :func:`to_wkb` writes."""
    return pd.Series([None if b is None else wkt_of(unpacked(b)) for b in wkb], dtype=object)


# Executors need no copy of the package: the functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
