"""Map-shaped inputs derived from the test tables.

The tables hold no map data. Integer arithmetic turns their rows into feature
lines, nodes, ways and relations, in a way SQL can state as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Keys that occur in the feature lines.
EVENT_TAGS = ["power", "military", "amenity", "highway", "landuse", "man_made"]

_CATEGORY = """CASE event_type WHEN 'view' THEN 'power' WHEN 'click' THEN 'military'
  WHEN 'purchase' THEN 'amenity' WHEN 'signup' THEN 'highway' ELSE 'landuse' END"""
_GOOD_VALUE = """CASE event_type WHEN 'view' THEN 'tower' WHEN 'click' THEN 'base'
  WHEN 'purchase' THEN 'bank' WHEN 'signup' THEN 'trunk' ELSE 'forest' END"""

_GEOMETRY = """CASE kind
  WHEN 0 THEN concat('{"type":"Point","coordinates":[', x, ',', y, ',9]}')
  WHEN 1 THEN concat('{"type":"LineString","coordinates":[', p0, ',', p1, ']}')
  WHEN 2 THEN concat('{"type":"Polygon","coordinates":[', ring, ']}')
  WHEN 3 THEN concat('{"type":"MultiLineString","coordinates":[[', p0, ', ', p1, '],[',
    p0, ',', p1, ']]}')
  WHEN 4 THEN concat('{"type":"MultiPolygon","coordinates":[[', ring, ']]}')
  WHEN 5 THEN concat('{"type":"GeometryCollection","geometries":[{"type":"Point",',
    '"coordinates":', p0, '},{"type":"LineString","coordinates":[', p0, ',', p1, ']}]}')
  WHEN 6 THEN concat('{"type":"MultiPoint","coordinates":[', p0, ']}')
  ELSE 'null' END"""

_PROPERTIES = """concat_ws(',',
  concat('"@id":', if(id % 97 = 0, concat('"w', id, '"'), string(id))),
  if(id % 3 != 0, concat('"@version":', id % 5 + 1), NULL),
  if(id % 4 != 1, concat('"@timestamp":"2024-01-1', id % 9, 'T00:00:00Z"'), NULL),
  if(user_id % 2 = 0, concat('"@user":"u', user_id, '"'), NULL),
  if(id % 6 != 0, concat('"@changeset":', id * 3), NULL),
  concat('"', category, '":"',
    CASE vc WHEN 1 THEN concat(' ', upper(good), ' ') WHEN 2 THEN 'zzz' ELSE good END, '"'),
  CASE id % 4 WHEN 0 THEN concat('"name":"n', id, '"') WHEN 1 THEN concat('"name:en":"e', id, '"')
    WHEN 2 THEN '"name":null' END,
  if(user_id % 5 = 0, '"man_made":"mast"', NULL),
  if(id % 10 = 0, concat('"operator":"Şirket ', user_id, '"'), NULL),
  if(id % 11 = 0, concat('"voltage":', user_id * 10), NULL),
  if(id % 13 = 0, '"access":null', NULL),
  if(id % 9 = 0, '"plant:source":"solar"', NULL),
  if(id % 6 = 0, '"generator:source":"wind"', NULL),
  if(id % 14 = 0, concat('"strat_level":"s', id % 3, '"'), NULL),
  if(id % 7 = 0, concat('"level":"l', id % 2, '"'), NULL),
  if(id % 12 = 0, concat('"admin_level":"', id % 11, '"'), NULL))"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event: id, kind, value case, position."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS id",
        "event_id % 8 AS kind",
        "user_id % 4 AS vc",
        "user_id",
        f"{_CATEGORY} AS category",
        f"{_GOOD_VALUE} AS good",
        "event_id % 300 - 150 AS x",
        "user_id % 100 - 50 AS y",
    )


def spread(rows: DataFrame) -> DataFrame:
    """The same rows in as many tasks as a shuffle has; the rows of a small file are one task otherwise."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def event_lines(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    """(value, source): one feature line per event."""
    return (
        events(spark, sf)
        .filter(where)
        .selectExpr(
            "*",
            "concat('[', x, ',', y, ']') AS p0",
            "concat('[', x + 1, ',', y + 1, ',7]') AS p1",
            """concat('[[', x, ',', y, '],[', x + 2, ',', y, '],[', x + 2, ',', y + 2, '],[',
              x, ',', y + 2, '],[', x, ',', y, ']]') AS ring""",
        )
        .selectExpr(
            # below a generator, so that filters on the line do not build it again
            f"""explode(array(concat('{{"type":"Feature","geometry":', {_GEOMETRY},
              ',"properties":{{', {_PROPERTIES}, '}}}}'))) AS value""",
            "'a' AS source",
        )
    )


def lines_with_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Every line from source "a", each tenth event again from source "b"."""
    again = event_lines(spark, sf, "id % 10 = 0").selectExpr("value", "'b' AS source")
    return event_lines(spark, sf).unionByName(again)


def lines_with_noise(spark: SparkSession, sf: str) -> DataFrame:
    """Feature lines, framed by separators for odd ids, among broken ones."""
    good = event_lines(spark, sf)
    noise = events(spark, sf).filter("id % 50 < 6").selectExpr(
        """CASE id % 50 WHEN 0 THEN concat('{"bad ', id) WHEN 1 THEN '' WHEN 2 THEN string(id)
          WHEN 3 THEN concat('{"geometry":null,"properties":{"power":"tower","@id":', id, '}')
          WHEN 4 THEN concat('{"geometry":{"type":"Point","coordinates":[1,2]},',
            '"properties":{"power":"tower"}} ', id)
          ELSE concat('[', id, ']') END AS value""",
        "'a' AS source",
    )
    return good.unionByName(noise)


def framed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as written by sequence tools: separator in front, blanks behind."""
    return lines_with_noise(spark, sf).selectExpr("concat(char(30), value, ' \\r') AS value")


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    """One node per part."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS id",
        "double(p_partkey % 360 - 180) AS lon",
        "double(p_size) AS lat",
        """CASE WHEN p_partkey % 5 = 0 THEN map('power', 'tower', 'name', concat('N', p_partkey))
          WHEN p_partkey % 5 = 1 THEN map('power', 'zzz')
          ELSE map() END AS tags""",
        "int(1) AS version",
        "timestamp '2024-01-01 00:00:00' AS timestamp",
        "if(p_partkey % 2 = 0, concat('u', p_partkey % 7), NULL) AS user",
        "p_partkey * 2 AS changeset",
    )


def way_refs(spark: SparkSession, sf: str) -> DataFrame:
    """(id, node_refs): parts of an order, in line order; each fourth is closed."""
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(items.alias("items"))
        .selectExpr("id", "items.l_partkey AS refs")
        .selectExpr(
            "id", "CASE WHEN id % 4 = 0 THEN concat(refs, array(refs[0])) ELSE refs END AS node_refs"
        )
    )


def ways(spark: SparkSession, sf: str) -> DataFrame:
    """One way per order with line items, tagged by its priority."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        """CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'motorway' WHEN '2' THEN 'trunk'
          WHEN '3' THEN 'primary' ELSE 'zzz' END AS road""",
    )
    return way_refs(spark, sf).join(orders, "id").selectExpr(
        "id",
        "node_refs",
        "map('highway', road, 'name', concat('W', id)) AS tags",
        "int(2) AS version",
        "timestamp '2024-02-01 00:00:00' AS timestamp",
        "string(NULL) AS user",
        "bigint(NULL) AS changeset",
    )


_EDIT = [
    "int(1) AS version",
    "timestamp '2024-03-01 00:00:00' AS timestamp",
    "'m' AS user",
    "bigint(9) AS changeset",
]


def area_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Corners of a square per supplier, and of a hole for each third."""
    corners = ", ".join(
        f"named_struct('k', {k}, 'dx', {dx}, 'dy', {dy})"
        for k, (dx, dy) in enumerate(
            [(0, 0), (8, 0), (8, 8), (0, 8), (2, 2), (4, 2), (4, 4), (2, 4)]
        )
    )
    return (
        table(spark, sf, "supplier")
        .selectExpr("s_suppkey AS s", f"inline(array({corners}))")
        .selectExpr(
            "s * 10 + k AS id",
            "double(s % 30 * 10 - 150 + dx) AS lon",
            "double(s % 15 * 10 - 75 + dy) AS lat",
            "CAST(map() AS map<string,string>) AS tags",
            *_EDIT,
        )
    )


def area_ways(spark: SparkSession, sf: str) -> DataFrame:
    """The square as two lines, the second reversed for odd suppliers; the hole."""
    return (
        table(spark, sf, "supplier")
        .selectExpr(
            "s_suppkey AS s",
            """posexplode(array(array(0, 1, 2), if(s_suppkey % 2 = 1, array(0, 3, 2), array(2, 3, 0)),
              array(4, 5, 6, 7, 4))) AS (w, corners)""",
        )
        .selectExpr(
            "s * 10 + w AS id",
            "transform(corners, k -> s * 10 + k) AS node_refs",
            "CAST(map() AS map<string,string>) AS tags",
            *_EDIT,
        )
    )


def area_relations(spark: SparkSession, sf: str) -> DataFrame:
    """One area per supplier; its members come in a different order each time."""
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id",
        """concat(
          if(s_suppkey % 3 = 0,
            array(named_struct('type', 'way', 'ref', s_suppkey * 10 + 2, 'role', 'inner')), array()),
          array(named_struct('type', 'way', 'ref', s_suppkey * 10 + 1, 'role', 'outer'),
            named_struct('type', 'way', 'ref', s_suppkey * 10, 'role', 'outer'),
            named_struct('type', 'node', 'ref', s_suppkey * 10, 'role', 'label'))) AS members""",
        "map('type', 'multipolygon', 'landuse', 'forest', 'name', concat('R', s_suppkey)) AS tags",
        *_EDIT,
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """(category, sub_cat_dir, extension, bytes): an output folder, one file per event."""
    return events(spark, sf).selectExpr(
        "category",
        "good AS sub_cat_dir",
        "CASE id % 3 WHEN 0 THEN '.parquet' WHEN 1 THEN '.geojson' ELSE '.db' END AS extension",
        "user_id * 20 + id % 1500 AS bytes",
    )


def all_elements(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, ways, relations) of both kinds; ids of areas' nodes and ways begin at ten million."""
    far = 10_000_000
    all_nodes = nodes(spark, sf).unionByName(area_nodes(spark, sf).withColumn("id", F.col("id") + far))
    all_ways = ways(spark, sf).unionByName(
        area_ways(spark, sf)
        .withColumn("id", F.col("id") + far)
        .withColumn("node_refs", F.transform("node_refs", lambda r: r + far))
    )
    relations = area_relations(spark, sf).withColumn(
        "members", F.transform("members", lambda m: m.withField("ref", m["ref"] + far))
    )
    return all_nodes, all_ways, relations


def element_changes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New versions of some elements: moved, deleted, re-tagged, with other references; some are too old to count."""
    all_nodes, all_ways, relations = all_elements(spark, sf)
    edit = ["int(5) AS version", "timestamp", "user", "changeset"]
    moved = "if(id < 10000000, id % 7 = 1, (id - 10000000) div 10 % 4 = 0)"
    changed_nodes = all_nodes.filter(f"{moved} OR id < 10000000 AND (id % 501 = 0 OR id % 97 = 3)").selectExpr(
        "id",
        f"if({moved}, lon + 1, lon) AS lon",
        "lat",
        "if(id < 10000000 AND id % 97 = 3, map('power', 'plant'), tags) AS tags",
        *edit,
        "id < 10000000 AND id % 501 = 0 AS deleted",
    )
    old = all_nodes.filter("id < 10000000 AND id % 11 = 5 AND id % 7 <> 1").selectExpr(
        "id", "lon + 50 AS lon", "lat", "tags", "int(0) AS version", "timestamp", "user", "changeset", "false AS deleted"
    )
    changed_ways = all_ways.filter("id < 10000000 AND id % 9 < 3").selectExpr(
        "id",
        "if(id % 9 = 2, slice(node_refs, 1, 2), node_refs) AS node_refs",
        "if(id % 9 = 1, map('highway', 'trunk'), tags) AS tags",
        *edit,
        "id % 9 = 0 AS deleted",
    )
    changed_relations = relations.filter("id % 5 < 2").selectExpr(
        "id", "members", "if(id % 5 = 1, map_concat(map_filter(tags, (k, v) -> k <> 'landuse'), map('landuse', 'quarry')), tags) AS tags",
        *edit, "id % 5 = 0 AS deleted",
    )
    return changed_nodes.unionByName(old), changed_ways, changed_relations
