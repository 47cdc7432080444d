"""Geometry assembly: lines and areas from element tables, by joins.

The joins run on node and way ids. Their right sides hold one row per id and
are read as plain shuffles, so that Spark splits skewed partitions of the left
side at run time when many ways share a node, or many relations a way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from terrafold.functions.geometry import plain_numbers
from terrafold.functions.rings import assemble_multipolygon
from terrafold.operators.membership import maybe_among
from terrafold.operators.relational import unique_keys
from terrafold.session import scratch_path, shared_folder

# --- Fixed values -----------------------------------------------------------
# Values of a relation's "type" tag that make it an area.
AREA_RELATIONS = ["multipolygon", "boundary"]
MIN_RING_REFS = 4
# --- End of fixed values ----------------------------------------------------

_CONTENT = ["lon", "lat", "node_refs", "members"]
_EDIT = ["version", "timestamp", "changeset"]


def latest(elements: DataFrame) -> DataFrame:
    """One row per id, the latest version.

    Copies of an object, as overlapping extracts give them, collapse to one
    row per task before the shuffle. The window key holds a hash of the id for
    the reason given at :func:`~terrafold.operators.relational.unique_keys`.
    """
    columns = elements.columns
    order = [F.col(c).desc_nulls_last() for c in _EDIT if c in columns]
    order += [F.col(c).asc_nulls_last() for c in _CONTENT if c in columns]
    if "tags" in columns:
        order.append(F.xxhash64(F.map_entries("tags")).asc())
    window = Window.partitionBy("id", F.xxhash64("id")).orderBy(*order)
    ranked = elements.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_where(elements: DataFrame, condition: Column) -> DataFrame:
    """Elements whose latest version meets the condition.

    Ids of which some version meets it are asked for first, so that only their
    versions are compared.
    """
    asked = unique_keys(elements.filter(condition).select("id"), ["id"])
    return latest(elements.join(asked, "id", "left_semi")).filter(condition)


def is_closed(refs: Column) -> Column:
    """Whether a way ends where it starts."""
    return (F.size(refs) >= 1) & (F.try_element_at(refs, F.lit(1)) == F.try_element_at(refs, F.lit(-1)))


def min_vertices(ways: DataFrame, least: int = 2) -> DataFrame:
    """Ways with at least so many node references."""
    return ways.filter(F.size("node_refs") >= least)


def split_closed(ways: DataFrame, line_keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(lines, areas): closed ways of four or more references are areas.

    A closed way carrying one of ``line_keys`` (say ``highway``) stays a line.
    """
    as_line = F.lit(False)
    for key in line_keys:
        as_line = as_line | F.coalesce(F.map_contains_key("tags", key), F.lit(False))
    closed = F.coalesce(is_closed(F.col("node_refs")), F.lit(False))
    areas = ways.filter(closed & ~as_line & (F.size("node_refs") >= MIN_RING_REFS))
    lines = ways.filter(~closed | as_line)
    return lines, areas


def node_points(nodes: DataFrame) -> DataFrame:
    """Nodes with their point geometry."""
    text = F.concat(F.lit("POINT ("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")"))
    located = nodes.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return located.withColumn("geometry_wkt", plain_numbers(text))


def _located(nodes: DataFrame, unique_ids: bool) -> DataFrame:
    columns = ["id", "lon", "lat"] + [c for c in _EDIT if c in nodes.columns]
    points = nodes.select(*columns)
    points = points if unique_ids else latest(points)
    return points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        F.col("id").alias("ref"), "lon", "lat"
    )


def wanted_nodes(nodes: DataFrame, features: DataFrame) -> DataFrame:
    """All versions of the nodes that features refer to, and few others.

    A Bloom filter over the references, in the scan of the nodes: nodes that
    no feature needs are not compared by version and not shuffled.
    """
    return maybe_among(nodes, features.select(F.explode("node_refs").alias("ref")), "id", "ref")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written once in the shared folder and read from there."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def locate(
    features: DataFrame, nodes: DataFrame, keys: Sequence[str] = ("id",), unique_ids: bool = False
) -> DataFrame:
    """Features with ``xs`` and ``ys``, the ordinates of their ``node_refs`` in order.

    ``features`` holds one row per key. Those with an unresolved reference are
    left out. The other columns travel on the first reference only, so they
    move once and need no join of their own afterwards.
    """
    keys = list(keys)
    rest = [c for c in features.columns if c not in keys]
    on_first = F.when(F.col("pos") == 0, F.struct(*rest)).alias("feature")
    refs = features.select("*", F.posexplode("node_refs").alias("pos", "ref")).select(
        *keys, "pos", "ref", on_first
    )
    gathered = (
        refs.join(_located(nodes, unique_ids), "ref")
        .repartition(*keys)  # lists shrink nothing, so they are built after the shuffle
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "lon", "lat"))).alias("points"),
            F.first("feature", ignorenulls=True).alias("feature"),
        )
    )
    return gathered.filter(F.size("points") == F.size("feature.node_refs")).select(
        *keys, "feature.*", F.col("points.lon").alias("xs"), F.col("points.lat").alias("ys")
    )


def way_coords(ways: DataFrame, nodes: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Ways, one row per id, with their ordinates, see :func:`locate`.

    ``unique_ids`` skips the choice of the latest version of nodes.
    """
    return locate(ways, nodes, unique_ids=unique_ids)


def _pairs_text() -> Column:
    pair = lambda x, y: F.concat(x.cast("string"), F.lit(" "), y.cast("string"))
    return F.array_join(F.zip_with("xs", "ys", pair), ",")


def way_lines(
    ways: DataFrame, nodes: DataFrame, least: int = 2, unique_ids: bool = False
) -> DataFrame:
    """Ways with their line geometry."""
    line = F.concat(F.lit("LINESTRING ("), _pairs_text(), F.lit(")"))
    current = ways if unique_ids else latest(ways)
    coords = way_coords(min_vertices(current, least), nodes, unique_ids)
    return coords.withColumn("geometry_wkt", plain_numbers(line)).drop("xs", "ys")


def way_areas(
    ways: DataFrame, nodes: DataFrame, line_keys: Sequence[str] = (), unique_ids: bool = False
) -> DataFrame:
    """Closed ways as areas of one ring."""
    ring = F.concat(F.lit("MULTIPOLYGON ((("), _pairs_text(), F.lit(")))"))
    _, closed = split_closed(ways if unique_ids else latest(ways), line_keys)
    coords = way_coords(closed, nodes, unique_ids)
    return coords.withColumn("geometry_wkt", plain_numbers(ring)).drop("xs", "ys")


def _drawable_ways(ways: DataFrame, line_keys: Sequence[str]) -> DataFrame:
    """Ways that give a line or an area, marked by ``is_area``."""
    is_area = F.coalesce(is_closed(F.col("node_refs")), F.lit(False))
    too_short = is_area & (F.size("node_refs") < MIN_RING_REFS)
    for key in line_keys:
        keyed = F.coalesce(F.map_contains_key("tags", key), F.lit(False))
        is_area, too_short = is_area & ~keyed, too_short & ~keyed
    return min_vertices(ways).filter(~too_short).withColumn("is_area", is_area)


def _way_text() -> Column:
    return F.concat(
        F.when(F.col("is_area"), "MULTIPOLYGON (((").otherwise("LINESTRING ("),
        _pairs_text(),
        F.when(F.col("is_area"), ")))").otherwise(")"),
    )


def _way_type() -> Column:
    return F.when(F.col("is_area"), "area").otherwise("way")


def way_geometries(
    ways: DataFrame, nodes: DataFrame, line_keys: Sequence[str] = (), unique_ids: bool = False
) -> DataFrame:
    """Lines and areas of :func:`way_lines` and :func:`way_areas` in one join.

    Adds ``osm_type`` ("way" or "area").
    """
    current = ways if unique_ids else latest(ways)
    coords = way_coords(_drawable_ways(current, line_keys), nodes, unique_ids)
    return (
        coords.withColumn("geometry_wkt", plain_numbers(_way_text()))
        .withColumn("osm_type", _way_type())
        .drop("xs", "ys", "is_area")
    )


def area_relations(relations: DataFrame) -> DataFrame:
    """Relations that describe an area."""
    return relations.filter(F.col("tags")["type"].isin(*AREA_RELATIONS))


def relation_refs(
    relations: DataFrame, ways: DataFrame, unique_ids: bool = False, unique_relations: bool | None = None
) -> DataFrame:
    """Area relations with the references of their member ways, one after another.

    ``node_refs`` holds them all and ``sizes`` how many come from each way.
    Relations with an unknown member way, or without any, are left out. One
    group is one relation, so it is as large as one geometry. ``unique_ids``
    skips the choice of latest versions, ``unique_relations`` that of relations.
    """
    single = unique_ids if unique_relations is None else unique_relations
    relations = area_relations(relations if single else latest(relations))
    rest = [c for c in relations.columns if c != "id"]
    on_first = F.when(F.col("pos") == 0, F.struct(*rest, F.size("_ways").alias("_n")))
    members = (
        relations.withColumn("_ways", F.filter("members", lambda m: m["type"].isin("way", "w")))
        .select("*", F.posexplode("_ways").alias("pos", "member"))
        .select("id", "pos", F.col("member.ref").alias("ref"), on_first.alias("relation"))
    )
    narrow = ways.select("id", "node_refs", *[c for c in _EDIT if c in ways.columns])
    known = min_vertices(narrow if unique_ids else latest(narrow)).select(F.col("id").alias("ref"), "node_refs")
    gathered = (
        members.join(known, "ref")
        .repartition("id")
        .groupBy("id")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "node_refs"))).alias("lines"),
            F.first("relation", ignorenulls=True).alias("relation"),
        )
        .filter(F.size("lines") == F.col("relation._n"))
    )
    return gathered.select(
        "id",
        "relation.*",
        F.flatten("lines.node_refs").alias("node_refs"),
        F.transform("lines.node_refs", lambda refs: F.size(refs)).alias("sizes"),
    ).drop("_n")


def relation_areas(
    relations: DataFrame, ways: DataFrame, nodes: DataFrame, unique_ids: bool = False
) -> DataFrame:
    """Area relations with the multipolygon their member ways enclose.

    Members are chained into rings; a ring inside an odd number of others is a
    hole. Every ring starts at its smallest corner, shells run counter-clockwise
    and holes clockwise. A relation with an unresolved member or an open ring
    is left out.
    """
    coords = locate(relation_refs(relations, ways, unique_ids), nodes, unique_ids=unique_ids)
    area = assemble_multipolygon("xs", "ys", "sizes")
    return (
        coords.withColumn("geometry_wkt", area)
        .filter(F.col("geometry_wkt").isNotNull())
        .drop("xs", "ys", "sizes", "node_refs")
    )


def relation_faults(relations: DataFrame, ways: DataFrame, unique_ids: bool = False) -> DataFrame:
    """(id, fault, point, members): why the member ways of an area relation do not close.

    ``missing_way``: a member that is not among the ways, or has fewer than two
    references. ``open_end``: a node at which an odd number of ends of member
    ways meet, with the members that end there; ways that end where they start
    have no ends. A relation without way members has ``no_ways``. Relations
    whose members all close give no row. One group is one node of one relation,
    so members of many relations and ways of many members spread.
    """
    relations = area_relations(relations if unique_ids else latest(relations))
    listed = relations.select("id", F.filter("members", lambda m: m["type"].isin("way", "w")).alias("_ways"))
    none = listed.filter(F.coalesce(F.size("_ways"), F.lit(0)) <= 0).select("id", F.lit("no_ways").alias("fault"))
    members = listed.select("id", F.posexplode("_ways").alias("pos", "m")).select("id", "pos", F.col("m.ref").alias("ref"))
    narrow = ways.select("id", "node_refs", *[c for c in _EDIT if c in ways.columns])
    known = min_vertices(narrow if unique_ids else latest(narrow)).select(
        F.col("id").alias("ref"), F.get("node_refs", F.lit(0)).alias("first"), F.element_at("node_refs", -1).alias("last")
    )
    found = members.join(known, "ref", "left")
    lacking = found.filter(F.col("first").isNull()).groupBy("id").agg(F.sort_array(F.collect_set("ref")).alias("members"))
    ends = found.filter(F.col("first") != F.col("last")).select("id", "ref", F.explode(F.array("first", "last")).alias("point"))
    odd = ends.groupBy("id", "point").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("ref")).alias("members"))
    rows = [
        none.select("id", "fault", F.lit(None).cast("bigint").alias("point"), F.array().cast("array<bigint>").alias("members")),
        lacking.select("id", F.lit("missing_way").alias("fault"), F.lit(None).cast("bigint").alias("point"), "members"),
        odd.filter(F.col("n") % 2 == 1).select("id", F.lit("open_end").alias("fault"), "point", "members"),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def line_and_area_features(
    tagged_ways: DataFrame,
    tagged_relations: DataFrame,
    ways: DataFrame,
    nodes: DataFrame,
    line_keys: Sequence[str] = (),
    unique_ids: bool = False,
    prune: bool = True,
) -> DataFrame:
    """Geometries of ways and of area relations, with one pass over the nodes.

    The same rows as :func:`way_geometries` and :func:`relation_areas`, which
    would each move the node table. ``tagged_ways`` and ``tagged_relations``
    hold one row per id; ``ways`` are all versions of all ways a relation may
    refer to. Adds ``src_type`` and ``osm_type``. With ``prune`` the features are
    written first, and only nodes that they may refer to are looked at.
    """
    lines = _drawable_ways(tagged_ways, line_keys)
    shared = ["id", "node_refs", "tags", "version", "timestamp", "user", "changeset"]
    one_line = F.array(F.size("node_refs")).alias("sizes")
    features = lines.select(*shared, one_line, "is_area", F.lit("way").alias("src_type")).unionByName(
        relation_refs(tagged_relations, ways, unique_ids, unique_relations=True).select(
            *shared, "sizes", F.lit(True).alias("is_area"), F.lit("relation").alias("src_type")
        )
    )
    if prune:
        features = stored(features, "features")
        nodes = wanted_nodes(nodes, features)
    coords = locate(features, nodes, ["src_type", "id"], unique_ids)
    relation = F.col("src_type") == "relation"
    # empty lists for the others: Spark's writer goes over all nulls before a list again at each row
    empty = {"xs": "array<double>", "ys": "array<double>", "sizes": "array<int>"}
    area = assemble_multipolygon(*[F.when(relation, F.col(c)).otherwise(F.array().cast(t)) for c, t in empty.items()])
    text = F.when(relation, area).otherwise(plain_numbers(_way_text()))
    return (
        coords.withColumn("geometry_wkt", text)
        .withColumn("osm_type", _way_type())
        .filter(F.col("geometry_wkt").isNotNull())
        .drop("xs", "ys", "sizes", "is_area", "node_refs")
    )


def unresolved_refs(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, pos, ref) of way references without a located node, latest versions of both."""
    refs = latest(ways).select("id", F.posexplode("node_refs").alias("pos", "ref"))
    known = _located(nodes, unique_ids=False).select("ref")
    return refs.join(known, "ref", "left_anti").select("id", "pos", "ref")


def _tagged(keys: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.coalesce(F.arrays_overlap(F.map_keys("tags"), wanted), F.lit(False))


def _with_members(relations: DataFrame, chosen: DataFrame) -> DataFrame:
    """Ids of chosen relations and of all relations below them, however deep.

    Each round follows the members found in the round before; a relation seen
    once is not followed again, so circles end.
    """
    below = relations.select("id", F.explode("members").alias("member"))
    below = below.filter(F.col("member.type").isin("relation", "r")).select("id", F.col("member.ref").alias("below"))
    below = _kept(below.distinct())
    seen = _kept(unique_keys(chosen.select("id"), ["id"]))
    fresh = seen
    while True:
        found = fresh.join(below, "id").select(F.col("below").alias("id")).distinct()
        fresh = _kept(found.join(seen, "id", "left_anti"))
        if fresh.isEmpty():
            return seen
        seen = _kept(seen.unionByName(fresh))


def _kept(rows: DataFrame) -> DataFrame:
    """Rows cut from their lineage, in the shared folder."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def filter_elements(
    nodes: DataFrame, ways: DataFrame, relations: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Objects that carry one of the keys, and all objects they refer to.

    Members of matching relations, members of those in turn to any depth, and
    nodes of kept ways come along, so the geometry of every match can still be
    built. Tables may hold several versions of an object; all of a kept one stay.
    """
    tagged = _tagged(keys)

    def keep(elements: DataFrame, refs: DataFrame) -> DataFrame:
        # tagged rows need no join; the others are looked up, older versions of tagged ones too
        asked = refs.unionByName(elements.filter(tagged).select("id"))
        referred = elements.filter(~tagged).join(unique_keys(asked, ["id"]), "id", "left_semi")
        return elements.filter(tagged).unionByName(referred.select(*elements.columns))

    kept_relations = keep(relations, _with_members(relations, relations.filter(tagged)))
    members = kept_relations.select(F.explode("members").alias("member"))

    def referred(*types: str) -> DataFrame:
        return members.filter(F.col("member.type").isin(*types)).select(F.col("member.ref").alias("id"))

    kept_ways = keep(ways, referred("way", "w"))
    way_nodes = kept_ways.select(F.explode("node_refs").alias("id"))
    kept_nodes = keep(nodes, referred("node", "n").unionByName(way_nodes))
    return kept_nodes, kept_ways, kept_relations
