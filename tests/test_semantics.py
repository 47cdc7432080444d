"""Rules of extraction and merging that are easy to get wrong, case by case."""

import json
import random

import pytest
from pyspark.sql import functions as F

from terrafold.functions import text
from terrafold.operators import assemble, filters, planning, project, quality, relational
from terrafold.plans.elements import extract_elements
from terrafold.plans.extract import NOT_READ, extract, feature_records, remaining_values, run
from terrafold.plans.merge import merge
from terrafold.plans.profiles import RunConfig, profile_tags
from terrafold.schema import ALL_TAGS, ELEMENTS, FEATURE_COLUMNS, WHITELIST
from terrafold.sinks import writers
from terrafold.sources import files, lines, parts


def _line(geometry=None, **props):
    shape = geometry or {"type": "Point", "coordinates": [1, 2]}
    return json.dumps({"type": "Feature", "geometry": shape, "properties": props})


def _lines(spark, *values, source="s"):
    return spark.createDataFrame([(v, source) for v in values], "value string, source string")


def _records(spark, *values, tags=("power",), subtags=None):
    return feature_records(_lines(spark, *values), list(tags), subtags)


def _one(df, *columns):
    row = df.select(*columns).first()
    return tuple(row) if len(columns) > 1 else row[0]


# --- reading ---------------------------------------------------------------------


def _file(tmp_path, data, name="in.geojsonseq"):
    path = tmp_path / name
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("end", [b"\n", b""])
def test_line_limit_is_exact(spark, tmp_path, end):
    path = _file(tmp_path, b"\n".join([b"a" * 99, b"b" * 100, b"c" * 101, b"d" * 100]) + end)
    kept = [r["value"][0] for r in lines.read_feature_lines(spark, path, max_bytes=100).collect()]
    assert kept == ["a", "b", "d"]
    assert lines.oversize_report(spark, path, max_bytes=100).first()["oversize_lines"] == 1
    over_at_end = _file(tmp_path, b"a\n" + b"c" * 101 + end, "end")
    assert lines.read_feature_lines(spark, over_at_end, max_bytes=100).count() == 1


def test_line_limit_counts_bytes(spark, tmp_path):
    path = _file(tmp_path, ("é" * 50 + "\n" + "é" * 51 + "\n").encode())
    assert lines.read_feature_lines(spark, path, max_bytes=100).count() == 1


def test_framing_blank_lines_and_bad_bytes(spark, tmp_path):
    path = _file(tmp_path, b"\x1e one \r\n\n \r\n\x1etwo\ncaf\xe9\xff\nlast")
    values = [r["value"] for r in lines.read_feature_lines(spark, path).collect()]
    assert values == ["one", "two", "caf��", "last"]


def test_source_is_the_file_without_its_ending(spark, tmp_path):
    path = _file(tmp_path, b"x\n", "filtered power.pbf.geojsonseq")
    assert _one(lines.read_feature_lines(spark, path), "source") == "filtered_power"


def test_small_files_are_left_out(spark, tmp_path):
    _file(tmp_path, b"x\n", "small")
    _file(tmp_path, b"y\n" * 100, "large")
    read = lines.read_feature_lines(spark, str(tmp_path), min_file_bytes=100)
    assert {r["value"] for r in read.collect()} == {"y"}


def test_malformed_lines_are_dropped(spark):
    good = _line(power="tower")
    bad = ['{"bad', "5", "null", '"a"', "[1]", good[:-1], good + " x", good + good, good + "," + good,
           '{"properties":[1],"geometry":null}', '{"geometry":null}']
    assert _records(spark, good, *bad).count() == 1
    reasons = lines.rejected_lines(_lines(spark, good, *bad)).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in reasons} == {"malformed": 9, "no_properties": 2}


def test_repeated_json_key_takes_the_last_value(spark):
    value = _line(power="x").replace('"power": "x"', '"power":"line","name":"a","power":"tower","name":"b"')
    assert _one(_records(spark, value), "sub_cat", "name") == ("tower", "b")
    assert json.loads(_one(_records(spark, value), "tags")) == {"power": "tower", "name": "b"}


def test_escaped_key_passes_the_text_test(spark):
    value = _line(power="tower").replace('"power"', '"p\\u006fwer"')
    assert _records(spark, value).count() == 1
    assert _records(spark, _line(building="yes", name="power")).count() == 0


# --- records ----------------------------------------------------------------------


def test_value_is_normalised_before_the_whitelist(spark):
    rows = _records(spark, _line(power="  TOWER\t"), _line(power="nothing"))
    assert [r["sub_cat"] for r in rows.collect()] == ["tower"]


@pytest.mark.parametrize(
    "subtags, kept", [(None, {"tower"}), ([], {"tower", "odd"}), (["odd"], {"odd"})]
)
def test_three_states_of_subtags(spark, subtags, kept):
    rows = _records(spark, _line(power="tower"), _line(power="Odd"), subtags=subtags)
    assert {r["sub_cat"] for r in rows.collect()} == kept


def test_unknown_key_accepts_all_values(spark):
    assert _records(spark, _line(cuisine="thai"), tags=["cuisine"]).count() == 1


def test_values_with_quotes(spark):
    rows = [_line(power="it's"), _line(power="a\\b"), _line(power="tower")]
    kept = _records(spark, *rows, subtags=["it's", "a\\b"]).collect()
    assert {r["sub_cat"] for r in kept} == {"it's", "a\\b"}


def test_null_value_is_no_tag_but_hides_a_fallback(spark):
    assert _records(spark, _line(power=None)).count() == 0
    value = _line(**{"power": "tower", "name": None, "name:en": "x", "plant:source": None,
                     "generator:source": "wind", "level": "2", "@user": None})
    row = _one(_records(spark, value), "name", "plant_source", "strat_level", "user")
    assert row == ("", "", "2", "unknown")


def test_defaults(spark):
    row = _one(_records(spark, _line(power="tower")), "osm_id", "name", "version", "timestamp",
               "user", "changeset", "admin_level", "voltage", "geom_group", "src_type")
    assert row == (0, "Unknown", "", "", "unknown", "", "", "", "points", "node")


@pytest.mark.parametrize(
    "raw, parsed",
    [(5, 5), ("7", 7), (" 8 ", 8), ("w9", 0), ("", 0), (None, 0), ("1.5", 0), (2**63, 0), (-3, -3)],
)
def test_id_parse(spark, raw, parsed):
    assert _one(_records(spark, _line(**{"power": "tower", "@id": raw})), "osm_id") == parsed


def test_tags_json_keeps_nulls_and_text_and_drops_attributes(spark):
    value = _line(**{"@id": 1, "power": "tower", "name": "Şırnak", "ref": None, "n": {"a": [1]}})
    tags = _one(_records(spark, value), "tags")
    assert "Şırnak" in tags
    assert json.loads(tags) == {"power": "tower", "name": "Şırnak", "ref": None, "n": '{"a":[1]}'}


def test_source_type_of_the_object_is_kept(spark):
    ring = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    value = _line(ring, **{"power": "plant", "@type": "relation"})
    assert _one(_records(spark, value), "osm_type", "src_type") == ("area", "relation")


def test_fan_out_gives_one_row_per_key(spark):
    value = _line(power="tower", man_made="mast", building="yes")
    rows = _records(spark, value, tags=ALL_TAGS).collect()
    assert {(r["category"], r["sub_cat"]) for r in rows} == {("power", "tower"), ("man_made", "mast")}


def test_record_layout(spark):
    assert _records(spark, _line(power="tower")).columns == [*FEATURE_COLUMNS, "source", "src_type"]


@pytest.mark.parametrize(
    "name, safe",
    [("  çé x/y-z.ü  ", "çé_x_y-z.ü"), ("a" * 60, "a" * 40), ("", ""), ("a\nb", "a_b"), ("x_1", "x_1")],
)
def test_sanitize_name(spark, name, safe):
    df = spark.createDataFrame([(name,)], "n string")
    assert _one(df.select(text.sanitize_name(F.col("n")))  , "*") == safe


@pytest.mark.parametrize(
    "argument, values",
    [(None, None), ("all", []), (" ALL ", []), ("forest, residential,", ["forest", "residential"]),
     ("", []), (" , ", [])],
)
def test_parse_subtags(spark, argument, values):
    assert text.parse_subtags(argument) == values
    column = spark.createDataFrame([(argument,)], "a string").select(text.subtags_of(F.col("a")))
    assert column.first()[0] == values


def test_short_names_collide(spark):
    with pytest.raises(ValueError):
        project.short_names(spark.createDataFrame([(1, 2)], "abcdefghijX int, abcdefghijY int"))


def test_profiles():
    assert len(profile_tags("full")) == 20 and profile_tags() == ALL_TAGS
    assert profile_tags("core") == ["military", "boundary", "telecom", "power", "amenity"]
    assert profile_tags(" shop, ,leisure ") == ["shop", "leisure"]
    assert len(WHITELIST) == 23 and sum(map(len, WHITELIST.values())) == 199


# --- merging ----------------------------------------------------------------------


def _copies(spark):
    a = _line(**{"power": "tower", "@id": 1, "@version": 2, "name": "old"})
    b = _line(**{"power": "tower", "@id": 1, "@version": 10, "name": "new"})
    c = _line(**{"power": "line", "@id": "w", "name": "x"})
    d = _line(**{"power": "line", "@id": "v", "name": "y"})
    first = _lines(spark, a, b, c, source="b")
    return feature_records(first.unionByName(_lines(spark, a, c, d, source="a")), ["power"])


def test_dedupe_order_is_source_then_version(spark):
    rows = relational.dedupe(_copies(spark).filter("osm_id = 1"))
    assert _one(rows, "name", "source") == ("old", "a")
    same_source = relational.dedupe(_copies(spark).filter("osm_id = 1 AND source = 'b'"))
    assert _one(same_source, "name") == "new"


def test_unparsable_ids_collapse_unless_kept(spark):
    rows = _copies(spark).filter("osm_id = 0")
    assert relational.dedupe(rows).count() == 1
    assert relational.dedupe(rows, keep_unidentified=True).count() == 2


def test_dedupe_is_idempotent_and_ignores_input_order(spark):
    records = _copies(spark)
    once = sorted(map(tuple, relational.dedupe(records).collect()))
    assert sorted(map(tuple, relational.dedupe(relational.dedupe(records)).collect())) == once
    shuffled = records.orderBy(F.desc("name")).repartition(5)
    assert sorted(map(tuple, relational.dedupe(shuffled).collect())) == once


def test_a_feature_is_kept_under_each_of_its_keys(spark):
    value = _line(**{"power": "tower", "man_made": "mast", "@id": 4})
    rows = extract(_lines(spark, value, value), ["power", "man_made"])
    assert rows.count() == 2


def test_area_of_way_and_of_relation_are_two(spark):
    ring = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    rows = [_line(ring, **{"power": "plant", "@id": 5, "@type": t}) for t in ("way", "relation")]
    assert extract(_lines(spark, *rows), ["power"]).count() == 2


def test_new_only_by_id_alone_or_with_type(spark):
    rows = spark.createDataFrame([(1, "node"), (1, "way"), (2, "way")], "osm_id long, osm_type string")
    existing = spark.createDataFrame([(1, "node"), (1, "node")], "osm_id long, osm_type string")
    assert relational.new_only(rows, existing).count() == 2
    assert relational.new_only(rows, existing, ["osm_id"]).count() == 1


def test_values_that_share_a_folder_are_both_kept(spark, tmp_path):
    records = _records(
        spark, _line(**{"power": "a b", "@id": 1}), _line(**{"power": "a/b", "@id": 2}),
        _line(**{"power": " ", "@id": 3}), subtags=[],
    )
    writers.write_parts(records, str(tmp_path / "p"))
    writers.write_parts(records.filter("osm_id = 1"), str(tmp_path / "p"))
    back = parts.read_parts(spark, json_path=str(tmp_path / "p"))
    assert sorted(r["sub_cat"] for r in back.collect()) == ["", "a b", "a b", "a/b"]


def test_staged_text_stays_text(spark, tmp_path):
    value = _line(**{"power": "tower", "@id": 1, "ref": "0042", "@timestamp": "2024-01-01T00:00:00Z"})
    writers.write_parts(feature_records(_lines(spark, value, source="2024"), ["power"]), str(tmp_path))
    back = parts.read_parts(spark, json_path=str(tmp_path))
    assert _one(back, "ref", "timestamp", "source", "osm_id") == ("0042", "2024-01-01T00:00:00Z", "2024", 1)


def test_bad_geometries_are_dropped_singly(spark):
    bow = {"type": "Polygon", "coordinates": [[[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]]]}
    rows = [_line(bow, **{"power": "plant", "@id": 1}), _line(**{"power": "plant", "@id": 2})]
    assert [r["osm_id"] for r in extract(_lines(spark, *rows), ["power"]).collect()] == [2]


def test_conform_pads_and_casts(spark):
    row = relational.conform(spark.createDataFrame([(None, 5)], "osm_id long, ref int")).first()
    assert (row["osm_id"], row["ref"], row["name"]) == (0, "5", "")


# --- elements ----------------------------------------------------------------------


def _elements(spark, kind, rows):
    columns = {"node": ["lon", "lat"], "way": ["node_refs"], "relation": ["members"]}[kind]
    full = [(r[0], *r[1 : 1 + len(columns)], r[1 + len(columns)], None, None, None, None) for r in rows]
    return spark.createDataFrame(full, ELEMENTS[kind])


def test_element_job(spark):
    nodes = _elements(
        spark, "node",
        [(1, 0.0, 0.0, {}), (2, 4.0, 0.0, {"power": "tower"}), (3, 4.0, 4.5, {}), (4, 0.0, 4.0, None)],
    )
    ways = _elements(
        spark, "way",
        [(5, [1, 2, 3], {"power": "line"}), (6, [1, 2, 3, 4, 1], {"power": "plant"}),
         (7, [1, 9], {"power": "line"}), (8, [1], {"power": "line"}),
         (9, [1, 2, 1], {"power": "line"}), (10, [3, 4, 1], {}), (11, [1, 2, 1, 2], {"power": "cable"})],
    )
    member = lambda ref: ("way", ref, "outer")
    relations = _elements(
        spark, "relation",
        [(5, [member(5), member(10)], {"type": "multipolygon", "power": "plant"}),
         (6, [member(5)], {"type": "multipolygon", "power": "plant"}),
         (7, [member(5), member(99)], {"type": "boundary", "power": "plant"}),
         (8, [member(5), member(10)], {"type": "route", "power": "plant"})],
    )
    rows = extract_elements(nodes, ways, relations, ["power"]).collect()
    found = {(r["src_type"], r["osm_id"]): (r["osm_type"], r["geometry_wkt"]) for r in rows}
    assert found == {
        ("node", 2): ("node", "POINT (4 0)"),
        ("way", 5): ("way", "LINESTRING (0 0,4 0,4 4.5)"),
        ("way", 6): ("area", "MULTIPOLYGON (((0 0,4 0,4 4.5,0 4,0 0)))"),
        ("way", 11): ("way", "LINESTRING (0 0,4 0,0 0,4 0)"),
        ("relation", 5): ("area", "MULTIPOLYGON (((0 0,4 0,4 4.5,0 4,0 0)))"),
    }
    assert {r["version"] for r in rows} == {"0"} and {r["user"] for r in rows} == {"unknown"}
    refs = assemble.unresolved_refs(ways, nodes).collect()
    assert [tuple(r) for r in refs] == [(7, 1, 9)]


def test_closed_way_stays_a_line_for_line_keys(spark):
    ways = _elements(spark, "way", [(1, [1, 2, 3, 1], {"highway": "track"}), (2, [1, 2, 3, 1], {})])
    as_lines, areas = assemble.split_closed(ways, line_keys=["highway"])
    assert [r["id"] for r in as_lines.collect()] == [1] and [r["id"] for r in areas.collect()] == [2]


def test_filter_keeps_what_matches_refer_to(spark):
    nodes = _elements(spark, "node", [(n, 0.0, 0.0, {}) for n in range(1, 7)])
    ways = _elements(spark, "way", [(1, [1, 2], {"power": "line"}), (2, [3], {}), (3, [4], {})])
    relations = _elements(
        spark, "relation",
        [(1, [("way", 2, ""), ("node", 5, ""), ("relation", 2, "")], {"power": "x"}), (2, [], {}),
         (3, [("way", 3, "")], {})],
    )
    kept = assemble.filter_elements(nodes, ways, relations, ["power"])
    assert [sorted(r["id"] for r in d.collect()) for d in kept] == [[1, 2, 3, 5], [1, 2], [1, 2]]


# --- planning and reports -----------------------------------------------------------


def test_slices_partition_the_input(spark):
    rows = spark.createDataFrame([(float(x),) for x in (-180, -90, -0.5, 0, 89.9, 90, 179, 180)], "lon double")
    placed = {r["lon"]: r["slice_id"] for r in planning.lon_slice(rows, 4).collect()}
    assert placed == {-180: 0, -90: 1, -0.5: 1, 0: 2, 89.9: 2, 90: 3, 179: 3, 180: 3}
    plan = planning.plan_slices(rows, target_rows=2).collect()
    assert sum(r["rows"] for r in plan) == 8
    assert planning.plan_slices(rows, target_rows=2, min_rows=3).agg(F.sum("rows")).first()[0] == 3


def test_one_format_is_enough_to_count_as_done(spark):
    done = planning.manifest(
        spark.createDataFrame(
            [("power", "line", ".parquet", 2000), ("power", "tower", ".parquet", 1024),
             ("power", "cable", ".db", 5000)],
            "category string, sub_cat_dir string, extension string, bytes long",
        )
    )
    expected = planning.expected_outputs(done, ["power", "cuisine"])
    missing = planning.missing_outputs(expected, done, ["parquet", "geojson"]).collect()
    names = {r["sub_cat"] for r in missing if r["category"] == "power"}
    assert names == set(WHITELIST["power"]) - {"line"}
    assert [r["sub_cat"] for r in missing if r["category"] == "cuisine"] == [None]
    left = planning.plan_run(expected, done, ["parquet"], "standard").collect()
    assert {r["category"] for r in left} == {"cuisine"}


def test_observed_counts(spark):
    counted, watch = quality.observed(_copies(spark))
    counted.write.format("noop").mode("overwrite").save()
    assert watch.get == {"records": 6, "unidentified": 3}


def test_run_skips_finished_keys(spark, tmp_path):
    big = [
        _line(**{"power": "tower", "@id": i, "name": f"a rather long name {i * 7919}"}) for i in range(300)
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _lines(spark, *big).select("value").write.text(source)
    config = RunConfig(tags=["power"], formats=["parquet"])
    assert run(spark, source, out, config) == [("parquet", "ok", "")]
    assert remaining_values(spark, out, config) == {}
    assert run(spark, source, out, config) == [("parquet", "skipped", NOT_READ)]
    detailed = RunConfig(tags=["power"], formats=["parquet"], skip_mode="detailed")
    assert set(remaining_values(spark, out, detailed)["power"]) == set(WHITELIST["power"]) - {"tower"}
    run(spark, source, out, RunConfig(tags=["power"], subtags=[]))
    assert spark.read.parquet(f"{out}/parquet").count() == 300


@pytest.mark.parametrize("fmt", ["parquet", "table", "geojson", "short"])
def test_each_format_is_found_again(spark, tmp_path, fmt):
    rows = [_line(**{"power": "tower", "@id": i, "name": f"long name {i * 7919}"}) for i in range(200)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _lines(spark, *rows).select("value").write.text(source)
    config = RunConfig(tags=["power"], formats=[fmt], skip_mode="detailed", table=f"again_{fmt}")
    assert run(spark, source, out, config) == [(fmt, "ok", "")]
    assert "tower" not in remaining_values(spark, out, config)["power"]
    config.subtags = ["tower"]
    assert run(spark, source, out, config) == [(fmt, "ok", "")]
    back = {
        "table": lambda: spark.table(f"again_{fmt}"),
        "geojson": lambda: spark.read.text(f"{out}/geojson"),
    }.get(fmt, lambda: spark.read.parquet(f"{out}/{fmt}"))()
    assert back.count() == 200


def test_listing_reads_folder_names(spark, tmp_path):
    records = _records(spark, _line(**{"power": "ä+b c", "@id": 1}), subtags=[])
    writers.write_parquet(records, str(tmp_path / "parquet"))
    row = files.list_outputs(spark, str(tmp_path)).filter("extension = '.parquet'").first()
    assert (row["category"], row["sub_cat_dir"]) == ("power", "ä_b_c") and row["bytes"] > 1000


def test_balanced_slices_cover_all_cells(spark):
    rng = random.Random(1)
    for _ in range(3000):
        counts = [(x, rng.choice([1, 2, 5, 9, 10, 11, 19, 20, 21, 50])) for x in sorted(rng.sample(range(40), rng.randint(0, 12)))]
        parts = planning._cut(counts, 40, 10)
        assert parts[0][0] == 0 and parts[-1][1] == 40 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        for low, high, rows in parts:
            inside = [n for x, n in counts if low <= x < high]
            assert sum(inside) == rows and (rows <= 20 or len(inside) == 1)


def test_balanced_slices_with_one_heavy_place_and_none(spark):
    rows = spark.sql("SELECT double(7) AS lon, double(id % 90) AS lat FROM range(900) UNION ALL SELECT 180D, 90D UNION ALL SELECT NULL, 1D UNION ALL SELECT double(id), 0D FROM range(20)")
    planned = planning.plan_slices_balanced(rows, 100)
    total, most = planned.agg(F.sum("rows"), F.max("rows")).first()
    assert total == 921 and most <= 200
    placed = planning.in_slices(rows, planned).groupBy("slice_id").count()
    assert sorted(map(tuple, placed.collect())) == sorted((r.slice_id, r.rows) for r in planned.collect() if r.rows)
    empty = planning.plan_slices_balanced(rows.limit(0), 100).collect()
    assert [tuple(r)[1:] for r in empty] == [(-180.0, 180.0, -90.0, 90.0, 0)]


def test_faults_of_relations(spark):
    ways = spark.createDataFrame([(1, [1, 2, 3]), (2, [3, 4, 1]), (3, [5, 6, 7, 5]), (4, [1, 9]), (5, [8])], "id long, node_refs array<long>")
    member = lambda *refs: [("way", r, "") for r in refs]
    relations = [(1, member(1, 2, 3)), (2, member(1, 2, 4)), (3, member(1, 77, 5)), (4, []), (5, None), (6, [("node", 1, "")]), (7, member(1, 1))]
    rows = spark.createDataFrame(
        [(i, m, {"type": "boundary"}) for i, m in relations] + [(8, member(4), {"type": "route"})],
        "id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>",
    )
    found = sorted((r.id, r.fault, r.point or 0, list(r.members)) for r in assemble.relation_faults(rows, ways, True).collect())
    assert found == [
        (2, "open_end", 1, [1, 2, 4]), (2, "open_end", 9, [4]),
        (3, "missing_way", 0, [5, 77]), (3, "open_end", 1, [1]), (3, "open_end", 3, [1]),
        (4, "no_ways", 0, []), (5, "no_ways", 0, []), (6, "no_ways", 0, []),
    ]
