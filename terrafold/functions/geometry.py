"""Geometry text: GeoJSON coordinates to WKT and back, boxes, classes.

Everything here is built from Spark's own functions; only validity tests of
rings and the binary form go through Arrow batches (see ``rings``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# --- Fixed values -----------------------------------------------------------
# Geometry types that convert: how deep their coordinates nest, and WKT name.
GEOMETRY_TYPES = {
    "Point": (1, "POINT"),
    "LineString": (2, "LINESTRING"),
    "MultiLineString": (3, "MULTILINESTRING"),
    "Polygon": (3, "POLYGON"),
    "MultiPolygon": (4, "MULTIPOLYGON"),
}
COLLECTION = "GeometryCollection"
COLLECTION_WKT = "GEOMETRYCOLLECTION"
# --- End of fixed values ----------------------------------------------------

#: Collections inside collections that Spark's own functions follow; geometries
#: that go deeper are marked and converted by ``collections.deep_wkt``.
NESTING = 3
DEEPER = "?"

_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
_PAIR = rf"({_NUMBER}) ({_NUMBER})"

# A point in JSON: two values, and what may follow them up to the bracket.
_JSON_POINT = r"\[([^\[\],]+),([^\[\],]+)(?:,[^\[\]]*+)?\]"

# WKT once the borders between rings and between polygons are commas.
_POINTS = r"\([-+0-9.eE][-+0-9.eE ,]*+\)"
_FLAT_WKT = (
    rf"^(?:(?:POINT|LINESTRING) {_POINTS}|(?:POLYGON|MULTILINESTRING) \({_POINTS}\)"
    rf"|MULTIPOLYGON \(\({_POINTS}\)\))$"
)


def geometry_schema(nesting: int = NESTING) -> str:
    """DDL of a GeoJSON geometry; coordinates stay text until typed."""
    fields = "type: string, coordinates: string"
    if nesting:
        fields += f", geometries: array<{geometry_schema(nesting - 1)}>"
    return f"struct<{fields}>"


def only_if(value: Column, test) -> Column:
    """``value`` where ``test`` holds, else null; ``value`` is computed once."""
    return F.get(F.filter(F.array(value), test), F.lit(0))


def _simple_wkt(geometry: Column) -> Column:
    """Text of a geometry that is no collection, null unless it is WKT.

    Brackets of lists become brackets of WKT once each point is "x y". The
    coordinates were written by the JSON parser, so they hold no blanks.
    """
    kind, coordinates = geometry["type"], geometry["coordinates"]
    points = F.regexp_replace(F.replace(coordinates, F.lit('"'), F.lit("")), _JSON_POINT, "$1 $2")
    lists = F.replace(F.replace(points, F.lit("["), F.lit("(")), F.lit("]"), F.lit(")"))
    name = F.lit(None).cast("string")
    for geojson, (_, wkt) in GEOMETRY_TYPES.items():
        name = F.when(kind == geojson, f"{wkt} ").otherwise(name)
    body = F.when(kind == "Point", F.concat(F.lit("("), points, F.lit(")"))).otherwise(lists)

    def is_wkt(text: Column) -> Column:
        flat = F.replace(text, F.lit(")),(("), F.lit(","))
        return F.rlike(F.replace(flat, F.lit("),("), F.lit(",")), F.lit(_FLAT_WKT))

    return only_if(F.concat(name, body), is_wkt)


def geojson_to_wkt(geometry: Column, nesting: int = NESTING) -> Column:
    """WKT of a GeoJSON geometry struct; null if it does not convert.

    Lists that are no points make the text null; members of a collection that
    do not convert are left out of it. A geometry that nests deeper than
    ``nesting`` collections gives DEEPER.
    """
    if nesting:
        members = F.transform(geometry["geometries"], lambda g: geojson_to_wkt(g, nesting - 1))
        listed = F.array_join(F.filter(members, lambda m: m.isNotNull()), ",")
        kept = only_if(listed, lambda t: t != "")
        collection = only_if(
            F.when(F.exists(members, lambda m: m == DEEPER), DEEPER).otherwise(
                F.concat(F.lit(f"{COLLECTION_WKT} ("), kept, F.lit(")"))
            ),
            lambda t: t.isNotNull(),
        )
    else:
        collection = F.lit(DEEPER)
    return F.when(geometry["type"] == COLLECTION, collection).otherwise(_simple_wkt(geometry))


def object_type(geometry_type: Column) -> Column:
    """Kind of map object that a GeoJSON geometry type stands for."""
    return (
        F.when(geometry_type == "Point", "node")
        .when(geometry_type.isin("Polygon", "MultiPolygon"), "area")
        .otherwise("way")
    )


def geom_group(osm_type: Column) -> Column:
    """Group of sinks an object type belongs to."""
    return F.when(osm_type == "node", "points").when(osm_type == "area", "polygons").otherwise(
        "lines"
    )


def plain_numbers(wkt: Column) -> Column:
    """Whole ordinates without the ``.0`` that doubles print."""
    return F.regexp_replace(wkt, r"\.0(?=[ ,)])", "")


def _body(wkt: Column) -> Column:
    """Text between the outer brackets."""
    return F.regexp_extract(wkt, r"(?s)^[A-Z]+ \((.*)\)$", 1)


def _wkt_type(wkt: Column) -> Column:
    return F.substring_index(wkt, " ", 1)


def _as_json_lists(points: Column) -> Column:
    """"x y,(x y)" as "[x,y],[[x,y]]"."""
    return F.translate(F.regexp_replace(points, _PAIR, "[$1,$2]"), "()", "[]")


def wkt_to_coords(wkt: Column) -> Column:
    """WKT as ``struct<type, coords>`` with coords polygon > ring > point > xy.

    Flatter types are padded with outer lists of one; collections and text
    that is not WKT give null.
    """
    kind = _wkt_type(wkt)
    nested = _as_json_lists(_body(wkt))
    padded = (
        F.when(kind == "POINT", F.concat(F.lit("[[["), nested, F.lit("]]]")))
        .when(kind == "LINESTRING", F.concat(F.lit("[[["), nested, F.lit("]]]")))
        .when(kind.isin("POLYGON", "MULTILINESTRING"), F.concat(F.lit("[["), nested, F.lit("]]")))
        .when(kind == "MULTIPOLYGON", F.concat(F.lit("["), nested, F.lit("]")))
    )
    well_formed = only_if(padded, lambda t: ~F.rlike(t, F.lit(r"[^-+0-9.eE,\[\]]|\[\]|\]\[")))
    coords = F.from_json(well_formed, "array<array<array<array<double>>>>")
    return only_if(F.struct(kind.alias("type"), coords.alias("coords")), lambda g: g["coords"].isNotNull())


def to_wkt(geometry: Column) -> Column:
    """WKT of what :func:`wkt_to_coords` returns."""

    def line(points: Column) -> Column:
        pair = lambda p: F.concat(p[0].cast("string"), F.lit(" "), p[1].cast("string"))
        return F.concat(F.lit("("), F.array_join(F.transform(points, pair), ","), F.lit(")"))

    def lines(rings: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(rings, line), ","), F.lit(")"))

    kind, coords = geometry["type"], geometry["coords"]
    text = (
        F.when(kind.isin("POINT", "LINESTRING"), line(coords[0][0]))
        .when(kind.isin("POLYGON", "MULTILINESTRING"), lines(coords[0]))
        .otherwise(
            F.concat(F.lit("("), F.array_join(F.transform(coords, lines), ","), F.lit(")"))
        )
    )
    return plain_numbers(F.concat(kind, F.lit(" "), text))


def wkt_to_geojson(wkt: Column) -> Column:
    """GeoJSON geometry text of WKT."""

    def member(kind: str, coordinates: Column) -> Column:
        return F.concat(
            F.lit(f'{{"type":"{kind}","coordinates":'), coordinates, F.lit("}")
        )

    kind = _wkt_type(wkt)
    lists = _as_json_lists(_body(wkt))
    out = F.lit(None).cast("string")
    for name, (depth, label) in GEOMETRY_TYPES.items():
        coordinates = lists if depth == 1 else F.concat(F.lit("["), lists, F.lit("]"))
        out = F.when(kind == label, member(name, coordinates)).otherwise(out)

    # members of a collection are rewritten where they stand, deepest type first
    ring, json_pair = r"\([^()]*+\)", r"[$1,$2]"
    rings = rf"\({ring}(?:,{ring})*+\)"
    shapes = {
        "MultiPolygon": rf"MULTIPOLYGON (\({rings}(?:,{rings})*+\))",
        "MultiLineString": rf"MULTILINESTRING ({rings})",
        "Polygon": rf"POLYGON ({rings})",
        "LineString": rf"LINESTRING ({ring})",
        "Point": r"POINT \(([^()]*+)\)",
    }
    listed = reduce(
        lambda text, s: F.regexp_replace(
            text, s[1], f'{{"type":"{s[0]}","coordinates":$1}}'
        ),
        shapes.items(),
        wkt,
    )
    listed = F.regexp_replace(listed, _PAIR, json_pair)
    listed = F.regexp_replace(
        listed, rf"{COLLECTION_WKT} \(", f'{{"type":"{COLLECTION}","geometries":<'
    )
    # the brackets left over: "<" opened a collection; one after "}", or after
    # the last such one, closes it
    listed = F.regexp_replace(listed, r"(?:(?<=\})|(?!^)\G)\)", ">")
    listed = F.translate(listed, "()", "[]")
    listed = F.replace(F.replace(listed, F.lit("<"), F.lit("[")), F.lit(">"), F.lit("]}"))
    return F.when(kind == COLLECTION_WKT, listed).otherwise(out)


def bounds(wkt: Column) -> Column:
    """``struct<min_lon, min_lat, max_lon, max_lat>`` of any WKT."""
    points = F.split(F.regexp_replace(wkt, r"[A-Z]{2,}|[()]", ""), ",")
    ordinate = lambda i: F.transform(
        points, lambda p: F.get(F.split(F.trim(p), " +"), F.lit(i)).try_cast("double")
    )
    xs, ys = ordinate(0), ordinate(1)
    return F.struct(
        F.array_min(xs).alias("min_lon"),
        F.array_min(ys).alias("min_lat"),
        F.array_max(xs).alias("max_lon"),
        F.array_max(ys).alias("max_lat"),
    )
