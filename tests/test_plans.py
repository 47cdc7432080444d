"""Shape of the physical plans: what is pushed down, shuffled, and split."""

import re

import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from terrafold.operators import assemble, relational
from terrafold.plans.elements import element_records
from terrafold.plans.extract import extract, feature_records
from terrafold.plans.merge import MERGE_KEYS, merge
from terrafold.schema import ALL_TAGS
from terrafold.sinks import writers
from terrafold.sources import files, lines, parts
from terrafold.sources.whitelist import whitelist


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Sets options for one test."""
    changed = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("written"))
    records = feature_records(A.lines_with_copies(spark, sf), A.EVENT_TAGS)
    writers.write_parquet(records, f"{path}/out")
    records.write.parquet(f"{path}/records")
    A.event_lines(spark, sf).select("value").write.text(f"{path}/lines")
    return path


def test_extraction_parses_once_and_does_not_shuffle(spark, written):
    shown = plan(feature_records(lines.read_feature_lines(spark, f"{written}/lines"), ALL_TAGS))
    # the tags and geometries are typed by one parse of the line
    assert shown.count("from_json(") == 1
    assert "Exchange" not in shown and "Join" not in shown
    # one Arrow function, which gets the lines of deep collections alone
    assert shown.count("ArrowEvalPython [deep_wkt(CASE WHEN (geometry_wkt") == 1 and shown.count("EvalPython") == 1


def test_key_count_does_not_change_the_plan(spark, written):
    read = lines.read_feature_lines(spark, f"{written}/lines")
    shape = lambda df: re.findall(r"^[ :+\-*()0-9]*([A-Z]\w+)", plan(df), re.M)
    assert shape(extract(read, ["power"])) == shape(extract(read, ALL_TAGS))


def test_merge_moves_records_once_and_judges_them_last(spark, written, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    records = spark.read.parquet(f"{written}/records")
    shown = plan(merge(records, parts.existing_ids(spark, f"{written}/out", MERGE_KEYS)))
    assert shown.count("Exchange") == 2  # records, and the existing keys
    assert shown.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert shown.index("ArrowEvalPython") < shown.index("SortMergeJoin")


def test_existing_ids_read_key_columns_only(spark, written):
    shown = plan(parts.existing_ids(spark, f"{written}/out", ["category", "osm_id"]))
    assert "ReadSchema: struct<osm_id:bigint>" in shown


def test_listing_opens_no_file(spark, written):
    shown = plan(files.list_files(spark, f"{written}/out"))
    assert "content" not in re.search(r"ReadSchema: .*", shown).group()


def test_whitelist_is_broadcast_by_its_size(spark, written, settings):
    records = spark.read.parquet(f"{written}/records")
    assert "BroadcastHashJoin" in plan(relational.whitelisted(records, whitelist(spark)))
    settings(spark__sql__autoBroadcastJoinThreshold="1000")
    assert "BroadcastHashJoin" not in plan(relational.whitelisted(records, whitelist(spark)))


def test_nodes_are_read_for_coordinates_alone(spark, sf, tmp_path):
    A.nodes(spark, sf).write.parquet(str(tmp_path / "nodes"))
    A.ways(spark, sf).write.parquet(str(tmp_path / "ways"))
    shown = plan(
        assemble.way_lines(
            spark.read.parquet(str(tmp_path / "ways")), spark.read.parquet(str(tmp_path / "nodes"))
        )
    )
    node_scan = next(r for r in re.findall(r"ReadSchema: .*", shown) if "lon" in r)
    assert "tags" not in node_scan
    assert "Cartesian" not in shown and "NestedLoop" not in shown


# --- one key holds a third of all rows ------------------------------------------------


@pytest.fixture
def small_skew_limits(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )


def _hot_ways(spark):
    """30 000 ways of three nodes; the middle one is always node 0."""
    return spark.range(1, 30_001).select(
        "id",
        F.array(F.col("id"), F.lit(0).cast("long"), F.col("id") + 30_000).alias("node_refs"),
        F.create_map(F.lit("power"), F.lit("line")).alias("tags"),
        F.lit(1).alias("version"),
    )


def _grid_nodes(spark):
    return spark.range(0, 60_001).select(
        "id", (F.col("id") % 360 - 180.0).alias("lon"), (F.col("id") % 90).cast("double").alias("lat")
    )


def test_node_used_by_every_way_is_split(spark, small_skew_limits):
    built = assemble.way_lines(_hot_ways(spark), _grid_nodes(spark)).select("id", "geometry_wkt")
    assert "skew=true" in final_plan(built)
    rows = {r["id"]: r["geometry_wkt"] for r in built.collect()}
    assert len(rows) == 30_000
    point = lambda n: f"{n % 360 - 180} {n % 90}"
    assert all(rows[i] == f"LINESTRING ({point(i)},{point(0)},{point(i + 30_000)})" for i in rows)


def test_missing_node_used_by_every_way_is_split(spark, small_skew_limits):
    missing = assemble.unresolved_refs(_hot_ways(spark), _grid_nodes(spark).filter("id > 0"))
    assert "skew=true" in final_plan(missing)
    assert missing.filter("ref = 0 AND pos = 1").count() == 30_000 == missing.count()


def test_existing_id_held_by_a_third_of_the_records_is_split(spark, small_skew_limits):
    records = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("osm_id"),
        F.lit("node").alias("osm_type"),
        F.md5(F.col("id").cast("string")).alias("name"),
    )
    existing = spark.range(0, 60_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") * 2).alias("osm_id"),
        F.lit("node").alias("osm_type"),
    )
    fresh = relational.new_only(records, existing)
    assert "skew=true" in final_plan(fresh)
    known = {0, *(i * 2 for i in range(1, 60_000, 2))}
    assert fresh.count() == sum(1 for i in range(90_000) if i % 3 and i not in known)


def test_hot_id_is_thinned_out_before_the_shuffle(spark):
    records = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("osm_id"),
        F.lit("node").alias("osm_type"),
        F.concat(F.lit("POINT ("), "id", F.lit(" 1)")).alias("geometry_wkt"),
    )
    unique = relational.dedupe(records)
    assert unique.count() == 60_001
    shown = plan(unique)
    stages = re.findall(r"Exchange|WindowGroupLimit.*, (Partial|Final)", shown)
    assert stages == ["Final", "", "Partial"]  # read from the bottom up


def test_copies_of_one_way_and_node(spark):
    ways = _hot_ways(spark).limit(50)
    copies = ways.unionByName(
        ways.filter("id = 1").select("*", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("col")
    )
    nodes = _grid_nodes(spark)
    twice = nodes.unionByName(nodes)
    built = assemble.way_lines(copies, twice).select("id", "geometry_wkt")
    once = assemble.way_lines(ways, nodes, unique_ids=True).select("id", "geometry_wkt")
    assert sorted(map(tuple, built.collect())) == sorted(map(tuple, once.collect()))


def test_element_job_moves_nodes_once_and_chains_rings_once(spark, sf, tmp_path):
    for name, table in [
        ("nodes", A.nodes(spark, sf)), ("ways", A.ways(spark, sf)),
        ("relations", A.area_relations(spark, sf)),
    ]:
        table.write.parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    shown = plan(element_records(read("nodes"), read("ways"), read("relations"), ["power", "landuse"]))
    scans = re.findall(r"ReadSchema: .*", shown)
    assert len([s for s in scans if "lon" in s and "tags" not in s]) == 1
    assert shown.count("assemble_multipolygon(") == 1 and shown.count("ArrowEvalPython") == 1


def test_stored_extents_are_compared_in_the_scan(spark, tmp_path):
    from terrafold.operators import filters

    rows = spark.range(100).selectExpr("id", "concat('POINT (', id, ' ', id % 10, ')') AS geometry_wkt")
    filters.with_box(rows).write.parquet(str(tmp_path / "boxed"))
    kept = filters.bbox_filter(spark.read.parquet(str(tmp_path / "boxed")), 10, 0, 20, 5)
    assert re.search(r"PushedFilters: \[IsNotNull\(max_lon\)", plan(kept))
    assert sorted(r["id"] for r in kept.collect()) == [i for i in range(10, 21) if i % 10 <= 5]
