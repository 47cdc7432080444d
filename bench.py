"""Benchmark: prints one JSON line with seconds per headline query.

Inputs are derived from the test tables once, outside the timing. Each query
runs twice; the second run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from checks import adapters as A
from terrafold.operators.assemble import relation_areas, way_lines
from terrafold.operators.filters import valid_geometry
from terrafold.operators.relational import dedupe
from terrafold.plans.elements import element_records
from terrafold.plans.extract import extract, feature_records
from terrafold.plans.merge import MERGE_KEYS, merge
from terrafold.schema import ALL_TAGS
from terrafold.session import local_session
from terrafold.sinks.writers import write_geojson_lines, write_parquet, write_parts
from terrafold.sources.lines import parse_features, read_feature_lines
from terrafold.sources.parts import existing_ids, read_parts

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def large_rings(spark, points: int = 20_000, rings: int = 16):
    """Rings of many points in a row and in a column, in turn."""
    half = f"sequence(0, {points // 2 - 1})"
    text = lambda order, other: (
        f"transform({order}, k -> if(id % 2 = 0, concat(k, ' ', {other}), concat({other}, ' ', k)))"
    )
    row, back = text(half, "k % 3"), text(f"reverse({half})", "(k % 3 + 9)")
    listed = f"array_join(concat({row}, {back}), ',')"
    return spark.range(rings).selectExpr(
        f"concat('POLYGON ((', {listed}, ',', split({listed}, ',')[0], '))') AS geometry_wkt"
    )


def timed(action) -> float:
    for _ in range(2):
        start = time.perf_counter()
        action()
        seconds = time.perf_counter() - start
    return round(seconds, 3)


def main() -> None:
    work = tempfile.mkdtemp(prefix="terrafold-bench-")
    spark = local_session(
        CPUS, **{"spark.sql.shuffle.partitions": CPUS, "spark.sql.warehouse.dir": f"{work}/warehouse"}
    )

    A.lines_with_copies(spark, SF_DIR).select("value").write.text(f"{work}/lines")
    # relations with their member ways and nodes, apart from the others by id
    far = 1_000_000_000
    A.ways(spark, SF_DIR).unionByName(
        A.area_ways(spark, SF_DIR).withColumns(
            {"id": F.col("id") + far, "node_refs": F.transform("node_refs", lambda r: r + far)}
        )
    ).repartition(int(CPUS)).write.parquet(f"{work}/ways")
    A.nodes(spark, SF_DIR).unionByName(
        A.area_nodes(spark, SF_DIR).withColumn("id", F.col("id") + far)
    ).repartition(int(CPUS)).write.parquet(f"{work}/nodes")
    A.area_relations(spark, SF_DIR).withColumn(
        "members", F.transform("members", lambda m: m.withField("ref", m["ref"] + far))
    ).write.parquet(f"{work}/relations")
    # a node that every way uses
    spark.read.parquet(f"{work}/ways").withColumn(
        "node_refs", F.concat(F.slice("node_refs", 1, 1), F.array(F.lit(0).cast("long")), F.col("node_refs"))
    ).write.parquet(f"{work}/hot_ways")
    large_rings(spark).write.parquet(f"{work}/rings")
    lines = read_feature_lines(spark, f"{work}/lines")
    ways, nodes = spark.read.parquet(f"{work}/ways"), spark.read.parquet(f"{work}/nodes")
    relations, hot_ways = spark.read.parquet(f"{work}/relations"), spark.read.parquet(f"{work}/hot_ways")
    rings = spark.read.parquet(f"{work}/rings")
    records = feature_records(lines, ALL_TAGS)
    write_parts(records, f"{work}/parts")
    write_parquet(merge(records), f"{work}/done")
    staged = read_parts(spark, json_path=f"{work}/parts")
    written = existing_ids(spark, f"{work}/done", MERGE_KEYS)
    runs = iter(range(1_000))

    queries = {
        "parse_features": lambda: consume(parse_features(lines)),
        "project_records": lambda: consume(records),
        "extract_1_key": lambda: consume(extract(lines, ["power"])),
        "extract_20_keys": lambda: consume(extract(lines, ALL_TAGS)),
        "dedupe": lambda: consume(dedupe(staged, ["category", "osm_id", "osm_type"])),
        "valid_geometry": lambda: consume(valid_geometry(staged)),
        "merge_nothing_new": lambda: consume(merge(staged, written)),
        "way_lines": lambda: consume(way_lines(ways, nodes)),
        "way_lines_hot_node": lambda: consume(way_lines(hot_ways, nodes)),
        "relation_areas": lambda: consume(relation_areas(relations, ways, nodes)),
        "large_rings": lambda: consume(valid_geometry(rings)),
        "element_records": lambda: consume(
            element_records(nodes, ways, relations, ["power", "highway", "landuse"])
        ),
        "write_parquet": lambda: write_parquet(staged, f"{work}/parquet{next(runs)}"),
        "write_geojson": lambda: write_geojson_lines(staged, f"{work}/geojson{next(runs)}"),
    }
    seconds = {name: timed(action) for name, action in queries.items()}
    counts = {"lines": lines.count(), "refs": ways.selectExpr("sum(size(node_refs))").first()[0]}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "rates": {
                    "parse_lines_per_sec": round(counts["lines"] / seconds["parse_features"]),
                    "extract_lines_per_sec": round(counts["lines"] / seconds["extract_20_keys"]),
                    "way_refs_per_sec": round(counts["refs"] / seconds["way_lines"]),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
