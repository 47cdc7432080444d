"""Bloom filters as tables: nothing wanted is lost, little else passes, nothing else moves."""

import re

from pyspark.sql import functions as F

from checks import adapters as A
from terrafold.operators import assemble, membership
from terrafold.plans.elements import element_records


def test_all_wanted_ids_pass_and_few_others(spark):
    for n in (1, 50, 40_000):
        ids = spark.range(n).select((F.col("id") * 7919 - 1000).alias("ref"))
        found = membership.maybe_among(spark.range(-2_000, 200_000), ids, "id", "ref")
        wanted = ids.filter("ref BETWEEN -2000 AND 199999").select("ref")
        assert wanted.join(found, wanted.ref == found.id, "left_anti").count() == 0
        assert found.count() - wanted.count() < 202_000 / 100


def test_nulls_and_no_ids(spark):
    ids = spark.sql("SELECT explode(array(1L, NULL, 3L)) AS ref")
    rows = spark.sql("SELECT explode(array(1L, 2L, NULL, 3L)) AS id")
    found = {r.id for r in membership.maybe_among(rows, ids, "id", "ref").collect()}
    assert {1, 3} <= found and None not in found
    assert membership.maybe_among(rows, ids.limit(0), "id", "ref").count() == 0


def test_a_filter_beyond_its_size_lets_all_pass(spark):
    found = membership.maybe_among(spark.range(1000), spark.range(10), most=1000)
    assert found.count() == 1000


def _elements(spark, sf):
    return A.nodes(spark, sf), A.ways(spark, sf), A.area_relations(spark, sf)


def test_pruned_records_are_those_of_all_nodes(spark, sf):
    records = [
        sorted(map(str, element_records(*_elements(spark, sf), ["highway"], ["motorway"], prune=prune).collect()))
        for prune in (True, False)
    ]
    assert records[0] == records[1] and records[0]


def test_nodes_are_pruned_before_their_versions_are_compared(spark, sf, tmp_path):
    path = str(tmp_path / "nodes")
    A.nodes(spark, sf).write.parquet(path)
    nodes = spark.read.parquet(path)
    ways = A.ways(spark, sf).filter("id < 20")
    features = assemble.stored(ways, "few-ways")
    kept = assemble.wanted_nodes(nodes, features)
    wanted = features.select(F.explode("node_refs").alias("ref")).distinct()
    assert wanted.count() <= kept.count() <= wanted.count() * 1.1 + 10 < nodes.count()
    coords = assemble.locate(features, kept)
    plan = coords._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "lon" in x)
    depth = len(re.match(r"[\s:]*", lines[scan]).group())
    above = [x for x in lines[:scan] if len(re.match(r"[\s:]*", x).group()) < depth][::-1]
    order = [x for line in above for x in ("Exchange hashpartitioning", "BroadcastHashJoin") if x in line]
    assert order[0] == "BroadcastHashJoin" and "Exchange hashpartitioning" in order
