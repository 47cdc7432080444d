"""Geometry text, binary form, validity and ring assembly on small cases."""

import json
import math
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrafold.functions import flat, geometry, rings
from terrafold.sources.lines import geometry_schema, parse_features, rejected_lines


def _lines(spark, geometries):
    rows = [
        (json.dumps({"geometry": g, "properties": {"@id": n}}), "s") for n, g in enumerate(geometries)
    ]
    return spark.createDataFrame(rows, "value string, source string")


def _converted(spark, geometries):
    rows = parse_features(_lines(spark, geometries)).collect()
    found = {int(r["props"]["@id"]): r["geometry_wkt"] for r in rows}
    return [found.get(n) for n in range(len(geometries))]


def test_geojson_to_wkt_by_type(spark):
    line, ring = [[1, 2], [3, 4, 5]], [[0, 0], [1, 0], [1, 1], [0, 0]]
    point = {"type": "Point", "coordinates": [1.5, -2]}
    cases = {
        "POINT (1.5 -2)": point,
        "LINESTRING (1 2,3 4)": {"type": "LineString", "coordinates": line},
        "POLYGON ((0 0,1 0,1 1,0 0),(1 2,3 4))": {"type": "Polygon", "coordinates": [ring, line]},
        "MULTILINESTRING ((1 2,3 4),(1 2,3 4))": {
            "type": "MultiLineString", "coordinates": [line, line],
        },
        "MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((0 0,1 0,1 1,0 0),(1 2,3 4)))": {
            "type": "MultiPolygon", "coordinates": [[ring], [ring, line]],
        },
        "GEOMETRYCOLLECTION (POINT (1.5 -2),GEOMETRYCOLLECTION (POINT (1.5 -2)))": {
            "type": "GeometryCollection",
            "geometries": [
                point,
                {"type": "MultiPoint", "coordinates": [[1, 2]]},
                {"type": "GeometryCollection", "geometries": [point]},
            ],
        },
        "POINT (1 2)": {"type": "Point", "coordinates": ["1", "2"]},
    }
    assert _converted(spark, list(cases.values())) == list(cases)


def _nested(depth, inner, *beside):
    for _ in range(depth):
        inner = {"type": "GeometryCollection", "geometries": [*beside, inner]}
    return inner


def test_collections_of_any_depth(spark):
    point, other = {"type": "Point", "coordinates": [1, 2]}, {"type": "Point", "coordinates": [3, 4.5]}
    bad = {"type": "Point", "coordinates": [1]}
    shapes, texts = [], []
    for depth in (1, 2, 3, 4, 5, 6, 40):
        shapes += [_nested(depth, point), _nested(depth, point, other), _nested(depth, point, bad, other)]
        plain, mixed = "POINT (1 2)", "POINT (1 2)"
        for _ in range(depth):
            plain = f"GEOMETRYCOLLECTION ({plain})"
            mixed = f"GEOMETRYCOLLECTION (POINT (3 4.5),{mixed})"
        texts += [plain, mixed, mixed]
    assert _converted(spark, shapes) == texts
    assert rejected_lines(_lines(spark, shapes)).count() == 0
    # the text form is read back whatever the depth
    df = spark.createDataFrame([(t,) for t in texts], "w string")
    for row, shape in zip(df.select(geometry.wkt_to_geojson(F.col("w")).alias("g")).collect()[::3], shapes[::3]):
        assert json.loads(row["g"]) == shape


def test_numbers_in_deep_collections_print_alike(spark):
    values = [0, -7, 1.0, 1.50, 0.001, 0.00099, 1e-5, 1234567.5, 12345678.5, 1e21, -1e-300, 9007199254740993, 0.1]
    shallow = [{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [v, 1]}]} for v in values]
    deep = [_nested(4, s) for s in shallow]
    found = _converted(spark, shallow + deep)
    for plain, nested in zip(found[: len(values)], found[len(values) :]):
        assert nested == "GEOMETRYCOLLECTION (" * 4 + plain + ")" * 4


def test_single_quotes_are_no_json(spark):
    from terrafold.plans.extract import feature_records
    from terrafold.schema import ALL_TAGS

    line = "{'geometry':{'type':'Point','coordinates':[1,2]},'properties':{'power':'tower','@id':5}}"
    lines = spark.createDataFrame([(line, "a"), (line.replace("'", '"'), "a")], "value string, source string")
    assert [feature_records(lines, keys).count() for keys in (["power"], ALL_TAGS)] == [1, 1]
    assert [r["reason"] for r in rejected_lines(lines).collect()] == ["malformed"]


def test_geometries_that_do_not_convert(spark):
    bad = [
        None,
        {},
        {"type": "Point"},
        {"type": "Point", "coordinates": None},
        {"type": "Point", "coordinates": [1]},
        {"type": "Point", "coordinates": [[1, 2]]},
        {"type": "Point", "coordinates": ["a", "b"]},
        {"type": "Point", "coordinates": [True, None]},
        {"type": "LineString", "coordinates": []},
        {"type": "LineString", "coordinates": [[1, 2], [3]]},
        {"type": "LineString", "coordinates": [[1, 2], None]},
        {"type": "LineString", "coordinates": [[[1, 2]], [3, 4]]},
        {"type": "LineString", "coordinates": [[[1, 2], [3, 4]]]},
        {"type": "Polygon", "coordinates": [[1, 2]]},
        {"type": "Polygon", "coordinates": [[]]},
        {"type": "Polygon", "coordinates": [[[1, 2], [3, 4]], [[[1, 2]]]]},
        {"type": "MultiPolygon", "coordinates": [[[1, 2], [3, 4]]]},
        {"type": "MultiPolygon", "coordinates": [[[[1, 2]]], [[3, 4]]]},
        {"type": "MultiPoint", "coordinates": [[1, 2]]},
        {"type": "GeometryCollection", "geometries": []},
        {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1]}]},
        _nested(5, {"type": "Point", "coordinates": [1]}),
    ]
    assert _converted(spark, bad) == [None] * len(bad)
    reasons = {r["reason"] for r in rejected_lines(_lines(spark, bad)).collect()}
    assert reasons == {"no_geometry", "unconvertible"}


WKTS = [
    "POINT (1.5 -2)",
    "POINT (0.0001 1e-05)",
    "LINESTRING (1 2,3 4)",
    "POLYGON ((0 0,4 0,4 4,0 4,0 0),(1 1,1 2,2 2,1 1))",
    "MULTILINESTRING ((1 2,3 4),(5 6,7 8,9 10))",
    "MULTIPOLYGON (((0 0,4 0,4 4,0 0),(1 1,2 1,2 2,1 1)),((9 9,10 9,10 10,9 9)))",
    "GEOMETRYCOLLECTION (POINT (1 2),LINESTRING (1 2,3 4),POLYGON ((0 0,1 0,1 1,0 0)),"
    "MULTILINESTRING ((1 2,3 4),(5 6,7 8)),MULTIPOLYGON (((0 0,4 0,4 4,0 0),(1 1,2 1,2 2,1 1)),"
    "((9 9,10 9,10 10,9 9))),GEOMETRYCOLLECTION (POINT (7 8)))",
]


def _numbers(text):
    return [float(n) for n in re.findall(r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?", text)]


def _same(a, b):
    return re.findall(r"[A-Z]{2,}|[()]", a) == re.findall(r"[A-Z]{2,}|[()]", b) and _numbers(
        a
    ) == _numbers(b)


def test_wkb_round_trip(spark):
    df = spark.createDataFrame([(w,) for w in WKTS], "w string")
    back = df.select("w", flat.from_wkb(flat.to_wkb("w")).alias("b")).collect()
    assert all(_same(r["w"], r["b"]) for r in back)


def test_wkb_is_read_by_spark(spark):
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    df = spark.createDataFrame([(w,) for w in WKTS], "w string").select(flat.to_wkb("w").alias("b"))
    row = df.select(
        F.sum((F.expr("st_asbinary(st_geomfromwkb(b))") == F.col("b")).cast("int")).alias("n")
    ).first()
    assert row["n"] == len(WKTS)


def test_text_that_is_no_wkt_has_no_wkb(spark):
    df = spark.createDataFrame([("POINT (a b)",), ("HOUSE (1 2)",), (None,)], "w string")
    assert [r[0] for r in df.select(flat.to_wkb("w")).collect()] == [None, None, None]


def test_coords_round_trip(spark):
    df = spark.createDataFrame([(w,) for w in WKTS[:-1]], "w string")
    back = df.select("w", geometry.to_wkt(geometry.wkt_to_coords(F.col("w"))).alias("b")).collect()
    assert all(_same(r["w"], r["b"]) for r in back)
    odd = spark.createDataFrame([("POINT (a b)",), ("POLYGON EMPTY",), (WKTS[-1],)], "w string")
    assert [r[0] for r in odd.select(geometry.wkt_to_coords(F.col("w"))).collect()] == [None] * 3


def test_wkt_to_geojson_reads_back(spark):
    df = spark.createDataFrame([(w,) for w in WKTS], "w string")
    texts = df.select("w", geometry.wkt_to_geojson(F.col("w")).alias("g"))
    assert all(json.loads(r["g"]) for r in texts.collect())
    parsed = texts.withColumn("geometry", F.from_json("g", geometry_schema()))
    back = parsed.select("w", geometry.geojson_to_wkt(F.col("geometry")).alias("b")).collect()
    assert all(_same(r["w"], r["b"]) for r in back)


def test_bounds(spark):
    df = spark.createDataFrame([(w,) for w in WKTS], "w string")
    for row in df.select("w", geometry.bounds(F.col("w")).alias("b")).collect():
        flat = _numbers(row["w"])
        xs, ys = flat[::2], flat[1::2]
        assert tuple(row["b"]) == (min(xs), min(ys), max(xs), max(ys))


ISSUES = {
    "POINT (1 2)": "ok",
    "POINT (1 NaN)": "nonfinite",
    "POINT (1 1e400)": "nonfinite",
    "POINT (1)": "nonfinite",
    "": "empty",
    "POLYGON EMPTY": "empty",
    "LINESTRING EMPTY": "empty",
    "LINESTRING (1 1,2 2)": "ok",
    "LINESTRING (1 1,1.0 1)": "short",
    "LINESTRING (1 1)": "short",
    "LINESTRING (1 1,2 x)": "nonfinite",
    "MULTILINESTRING ((1 1,2 2),(3 3,3 3))": "short",
    "POLYGON ((0 0,2 0,2 2,0 2,0 0))": "ok",
    "POLYGON ((0 0,2 0,0 0))": "short",
    "POLYGON ((0 0,2 0,2 2,0 2))": "open_ring",
    "POLYGON ((0 0,2 2,2 0,0 2,0 0))": "self_cross",
    "POLYGON ((0 0,1 0,2 0,0 0))": "zero_area",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,1 2,2 2,1 1))": "ok",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,1 20,2 2,1 1))": "hole_outside",
    "MULTIPOLYGON (((0 0,2 0,2 2,0 0)),((5 5,7 7,7 5,5 7,5 5)))": "self_cross",
    "GEOMETRYCOLLECTION (POINT (1 1),POLYGON ((0 0,2 0,2 2,0 2)))": "open_ring",
    "GEOMETRYCOLLECTION (POINT (1 1),LINESTRING (1 1,2 2))": "ok",
    "POLYGON ((0 0,4 0,2 0,2 2,0 0))": "self_touch",
    "POLYGON ((0 0,4 0,2 2,4 4,0 4,2 2,0 0))": "self_touch",
    "POLYGON ((0 0,4 0,4 0,4 4,0 4,0 0))": "ok",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,1 4,4 4,4 1,1 1),(2 2,2 6,6 6,6 2,2 2))": "rings_cross",
    "POLYGON ((0 0,9 0,9 9,5 9,5 3,4 3,4 9,0 9,0 0),(3 5,3 6,6 6,6 5,3 5))": "rings_cross",
    "POLYGON ((0 0,4 0,4 4,0 4,0 0),(0 0,4 0,4 4,0 4,0 0))": "rings_cross",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(0 4,4 0,5 5,0 4))": "rings_cross",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(0 4,2 3,2 5,0 4))": "ok",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,1 8,8 8,8 1,1 1),(2 2,2 3,3 3,3 2,2 2))": "holes_overlap",
    "MULTIPOLYGON (((0 0,4 0,4 4,0 4,0 0)),((2 2,6 2,6 6,2 6,2 2)))": "rings_cross",
    "MULTIPOLYGON (((0 0,4 0,4 4,0 4,0 0)),((4 0,8 0,8 4,4 4,4 0)))": "rings_cross",
    "MULTIPOLYGON (((0 0,4 0,4 4,0 4,0 0)),((4 4,8 4,8 8,4 8,4 4)))": "ok",
    "MULTIPOLYGON (((0 0,9 0,9 9,0 9,0 0)),((2 2,6 2,6 6,2 6,2 2)))": "shells_overlap",
    "MULTIPOLYGON (((0 0,9 0,9 9,0 9,0 0),(1 1,1 8,8 8,8 1,1 1)),((2 2,6 2,6 6,2 6,2 2)))": "ok",
}


def test_geometry_issues(spark):
    df = spark.createDataFrame([(w,) for w in ISSUES] + [(None,)], "w string")
    found = df.select("w", rings.geometry_issue(F.col("w")).alias("i")).collect()
    assert {r["w"]: r["i"] for r in found} == {**ISSUES, None: "empty"}


def _proper(a, b, c, d):
    turn = lambda p, q, r: np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


corner = st.tuples(st.integers(0, 6), st.integers(0, 6))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(corner, min_size=3, max_size=9), min_size=1, max_size=4))
def test_crossings_equal_all_pairs(shapes):
    loops = [np.array([*s, s[0]], dtype=float) for s in shapes]
    number = np.repeat(np.arange(len(loops)), [len(r) for r in loops])
    expected = []
    for n, r in enumerate(loops):
        edges = list(zip(r[:-1], r[1:]))
        if any(_proper(*e, *f) for i, e in enumerate(edges) for f in edges[i + 1 :]):
            expected.append(n)
    each = np.arange(len(loops))
    crossed, *_ = rings._ring_faults(np.concatenate(loops), number, each, each)
    assert sorted(crossed) == expected


def test_a_long_ring_either_way_takes_seconds():
    import time

    x = np.linspace(0, 1000, 50_000)
    y = np.sin(50 * x) / 1000
    ring = np.vstack([np.column_stack([x, y]), np.column_stack([x[::-1], y[::-1] + 1]), [[x[0], y[0]]]])
    start = time.perf_counter()
    for points in (ring, ring[:, ::-1]):
        text = ",".join(f"{a} {b}" for a, b in points.tolist())
        assert rings._issues([f"POLYGON (({text}))"]) == ["ok"]
    assert time.perf_counter() - start < 20


def test_rings_part_where_they_touch():
    line = lambda *p: np.array(p, dtype=float)
    squares = [line((0, 0), (1, 0), (1, 1)), line((1, 1), (0, 1), (0, 0)), line((1, 1), (2, 1), (2, 2)), line((2, 2), (1, 2), (1, 1))]
    wanted = "MULTIPOLYGON (((0 0,1 0,1 1,0 1,0 0)),((1 1,2 1,2 2,1 2,1 1)))"
    assert rings._multipolygon(squares) == rings._multipolygon(squares[::-1]) == wanted
    assert rings._multipolygon([squares[1], squares[3], squares[0], squares[2]]) == wanted
    notch = line((0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3), (0, 0))
    plug = line((1, 3), (1.5, 2), (2, 3), (1, 3))
    assert rings._multipolygon([notch, plug]) == (
        "MULTIPOLYGON (((0 0,3 0,3 3,2 3,2 1,1 1,1 3,0 3,0 0)),((1 3,1.5 2,2 3,1 3)))"
    )
    figure_eight = line((0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0))
    assert rings._multipolygon([figure_eight]) == "MULTIPOLYGON (((0 0,2 2,0 4,0 0)),((2 2,4 0,4 4,2 2)))"


@settings(max_examples=200, deadline=None)
@given(st.integers(3, 9), st.floats(-2, 2), st.floats(-2, 2))
def test_inside_regular_polygon(n, x, y):
    angle = np.linspace(0, 2 * np.pi, n + 1)
    ring = np.column_stack([np.cos(angle), np.sin(angle)])
    ring[-1] = ring[0]
    # distance to the edges' lines, all positive inside
    a, b = ring[:-1], ring[1:]
    turns = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
    if np.abs(turns).min() > 1e-9:
        assert rings.inside(ring, np.array([[x, y]])) == bool((turns > 0).all())


@settings(max_examples=100, deadline=None)
@given(st.permutations(range(4)), st.lists(st.booleans(), min_size=4, max_size=4), st.integers(1, 2))
def test_rings_chain_in_any_order(order, turned, lines_per_side):
    corners = [(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)]
    sides = [np.array(corners[i : i + 2], dtype=float) for i in range(4)]
    mixed = [sides[i][::-1] if turned[i] else sides[i] for i in order]
    assert rings._multipolygon(mixed) == "MULTIPOLYGON (((0 0,8 0,8 8,0 8,0 0)))"
    assert rings._multipolygon(mixed[1:]) is None


def test_shells_and_holes_by_nesting():
    square = lambda x, y, n: np.array(
        [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)], dtype=float
    )
    text = rings._multipolygon([square(4, 4, 1), square(20, 0, 2), square(0, 0, 10), square(2, 2, 6)])
    assert text == (
        "MULTIPOLYGON (((0 0,10 0,10 10,0 10,0 0),(2 2,2 8,8 8,8 2,2 2)),"
        "((4 4,5 4,5 5,4 5,4 4)),((20 0,22 0,22 2,20 2,20 0)))"
    )
    assert math.isclose(rings.signed_area(square(0, 0, 2)), 4)


BAD = [
    "POINT (1)", "POINT 1 2", "POINT (1 2", "POINT (1 2))", "POINT (a b)", "LINESTRING (1 2,,3 4)", "LINESTRING ((1 2,3 4))",
    "POLYGON (0 0,1 1)", "FOOO (1 2)", "POINT (1 2)POINT (1 2)", "POINT (1 2) x", "MULTIPOLYGON ((0 0,1 1))", "POINT EMPTY",
    "GEOMETRYCOLLECTION ((1 2))", "(1 2)", "POINT (1 2,3 4)", "POINT (1 2 3)", "POLYGON ((0 0),1 1)", "POLYGON (POINT (1 2))",
]


def test_flat_form_holds_any_shape_and_leaves_bad_rows_out():
    both = [w for pair in zip(WKTS, BAD * 9) for w in pair] + [None, ""]
    found = [None if g is None else flat.wkt_of(g) for g in flat.parsed(both)]
    good = [w.replace(".0 ", " ") for w in WKTS]
    assert found[0 : 2 * len(good) : 2] == good and set(found[1 : 2 * len(good) : 2]) == {None} and found[-2:] == [None, None]


def test_nesting_has_no_limit(spark):
    n = 100_000
    deep = "GEOMETRYCOLLECTION (" * n + "POINT (3 4)" + ",POINT (1 2))" * n
    df = spark.createDataFrame([(deep,), ("POINT (1 2)",)], "w string").repartition(1)
    back = df.select("w", flat.from_wkb(flat.to_wkb("w")).alias("b"), flat.flat_to_wkt(flat.wkt_to_flat("w")).alias("t")).collect()
    assert all(r.w == r.b == r.t for r in back)


def test_binary_form_of_a_batch_is_that_of_its_rows():
    many = WKTS * 50
    whole = flat.wkb_of(flat.parsed(many))
    assert whole == [flat.wkb_of(flat.parsed([w]))[0] for w in WKTS] * 50


_CHAIN = "POLYGON ((0 0,12 0,12 12,0 12,0 0),(2 2,6 2,4 1,2 2),(6 2,4 6,7 5,6 2),{})"
_APART = {
    # three holes that touch in a circle, and in a row
    _CHAIN.format("(2 2,4 6,1 5,2 2)"): "interior_split",
    _CHAIN.format("(2 2,3 6,1 5,2 2)"): "ok",
    # three holes in one point
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(4 4,5 5,5 4,4 4),(4 4,4 5,3 5,4 4),(4 4,3 3,4 3,4 4))": "ok",
    # two holes that close a circle with the shell
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(0 4,3 5,4 4,0 4),(4 4,6 5,9 4,4 4))": "interior_split",
    "POLYGON ((0 0,9 0,9 9,0 9,0 0),(0 4,3 5,4 4,0 4),(4 4,6 5,8 4,4 4))": "ok",
}


def test_an_inside_that_holes_part():
    assert rings._issues(list(_APART)) == list(_APART.values())
    both = "MULTIPOLYGON (" + ",".join(w.removeprefix("POLYGON ") for w in (list(_APART)[1], "POLYGON ((20 0,29 0,29 9,20 9,20 0),(20 4,23 5,24 4,20 4),(24 4,26 5,29 4,24 4))")) + ")"
    assert rings._issues([both]) == ["interior_split"]


def test_many_small_areas_take_little_time():
    """A batch is judged at once: no work for each pair of geometries, few steps for each."""
    moved = lambda wkt, dx: re.sub(r"(\d+) (\d+)", lambda m: f"{int(m[1]) + dx} {m[2]}", wkt)
    shapes = list(_APART) + [
        "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,2 1,2 2,1 1),(20 1,22 1,22 2,20 1))",
        "POLYGON ((0 0,9 0,9 9,0 9,0 0),(1 1,5 1,5 5,1 5,1 1),(2 2,3 2,3 3,2 2))",
        "MULTIPOLYGON (((0 0,9 0,9 9,0 9,0 0),(1 1,8 1,8 8,1 8,1 1)),((2 2,7 2,7 7,2 7,2 2)))",
        "MULTIPOLYGON (((0 0,9 0,9 9,0 9,0 0),(1 1,3 1,3 3,1 3,1 1)),((4 4,7 4,7 7,4 7,4 4)))",
    ]
    issues = list(_APART.values()) + ["hole_outside", "holes_overlap", "ok", "shells_overlap"]
    many = [moved(w, n % 300) for n in range(2000) for w in shapes]
    began = time.process_time()
    assert rings._issues(many) == issues * 2000
    # 0.1 ms each; 1.5 ms each when every geometry had a walk of its own
    assert time.process_time() - began < 0.4e-3 * len(many)


def test_chains_of_any_length_that_close_or_not():
    """Holes in a row between the sides of a shell, long ones among short ones."""

    def row(n, end):
        holes = ",".join(f"({2 * i} 0,{2 * i + 1} -1,{2 * i + 2} 0,{2 * i + 1} 1,{2 * i} 0)" for i in range(n))
        return f"POLYGON ((0 -3,{end} -3,{end} 3,0 3,0 0,0 -3),{holes})"

    sizes = [3, 20, 21, 200, 5]
    shapes = [row(n, 2 * n + more) for n in sizes for more in (0, 1)]
    assert rings._issues(shapes) == ["interior_split", "ok"] * len(sizes)


def test_numbers_and_none_in_one_batch():
    """One unreadable geometry leaves the others as they are."""
    good = list(_APART)
    odd = ["POLYGON ((0 0,1 a,2 2,0 0))", "POLYGON ((0 0,1 1,2))", "MULTIPOLYGON (((0 0,1 1,x 2,0 0),()))", "POLYGON (())", None, "POLYGON ((0 0,1 nan,2 2,0 0))"]
    wanted = ["nonfinite", "nonfinite", "nonfinite", "empty", None, "nonfinite"]
    assert rings._issues(good + odd + good) == [*_APART.values(), *wanted, *_APART.values()]


def test_sides_agree_with_rational_numbers():
    rng = np.random.default_rng(3)
    p, q = rng.uniform(-180, 180, (2, 4000, 2))
    t = rng.uniform(-1, 2, (4000, 1))
    r = p + t * (q - p) + rng.choice([0, 1e-12, -1e-12, 1e-16, 1e-9], (4000, 2))
    whole = rng.integers(-9, 9, (3, 4000, 2)).astype(float)
    for a, b, c in ((p, q, r), tuple(whole), (p, q, q), (p * 1e7, q * 1e7, r * 1e7)):
        exact = [rings._exact_side(*x) for x in np.concatenate([a, b, c], axis=1).tolist()]
        assert rings._side(a, b, c).tolist() == exact
