"""Collections of any depth, for the few that nest deeper than Spark's functions follow."""

from __future__ import annotations

import json
import re
import sys
from decimal import Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from terrafold.functions.geometry import COLLECTION, COLLECTION_WKT, GEOMETRY_TYPES

_NUMBER = re.compile(r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?")


def _number(value) -> str | None:
    """An ordinate as Spark prints it; null where it is no number."""
    if isinstance(value, bool):
        return None
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        size = abs(value)
        if size and not 1e-3 <= size < 1e7:
            sign, digits, exponent = Decimal(repr(value)).as_tuple()
            text = "".join(map(str, digits)).rstrip("0") or "0"
            at = exponent + len(digits) - 1
            return f"{'-' * sign}{text[0]}.{text[1:] or '0'}E{at}"
        return repr(value)
    if isinstance(value, str) and _NUMBER.fullmatch(value):
        return value
    return None


def _lists(value, depth: int) -> str | None:
    """Nested lists of points as text; points are at depth 1."""
    if not isinstance(value, list) or not value:
        return None
    if depth == 1:
        if len(value) < 2 or any(isinstance(v, (list, dict)) for v in value[2:]):
            return None
        x, y = _number(value[0]), _number(value[1])
        return None if x is None or y is None else f"{x} {y}"
    parts = [_lists(v, depth - 1) for v in value]
    if None in parts:
        return None
    return "(" + ",".join(parts) + ")"


def _wkt(geometry) -> str | None:
    if not isinstance(geometry, dict):
        return None
    kind = geometry.get("type")
    if kind == COLLECTION:
        members = geometry.get("geometries")
        texts = [t for t in map(_wkt, members) if t] if isinstance(members, list) else []
        return f"{COLLECTION_WKT} ({','.join(texts)})" if texts else None
    if kind not in GEOMETRY_TYPES:
        return None
    depth, name = GEOMETRY_TYPES[kind]
    body = _lists(geometry.get("coordinates"), depth)
    if body is None:
        return None
    return f"{name} ({body})" if depth == 1 else f"{name} {body}"


def _line_wkt(line: str) -> str | None:
    try:
        return _wkt(json.loads(line).get("geometry"))
    except (ValueError, AttributeError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def deep_wkt(line: pd.Series) -> pd.Series:
    """WKT of the geometry of feature lines; null lines give null."""
    return line.map(_line_wkt, na_action="ignore")


# Called non-deterministic so that a filter on the result does not compute it twice.
deep_wkt = deep_wkt.asNondeterministic()


# Executors need no copy of the package: the functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
