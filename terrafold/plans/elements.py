"""The element job: nodes, ways and relations to clean records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terrafold.operators.assemble import (
    latest_where,
    line_and_area_features,
    node_points,
)
from terrafold.operators.filters import chosen_values, wanted_values
from terrafold.operators.project import project_features
from terrafold.operators.relational import union_parts
from terrafold.plans.merge import merge

# --- Fixed values -----------------------------------------------------------
# Edit metadata of an element that lacks it.
NO_VERSION, NO_TIMESTAMP, NO_USER, NO_CHANGESET = "0", "", "unknown", "0"
# --- End of fixed values ----------------------------------------------------


def _props() -> Column:
    """Tags and edit metadata of an element, as the properties of a feature."""
    metadata = {
        "@id": F.col("id").cast("string"),
        "@type": F.col("src_type"),
        "@version": F.coalesce(F.col("version").cast("string"), F.lit(NO_VERSION)),
        "@timestamp": F.coalesce(
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ssxxx"), F.lit(NO_TIMESTAMP)
        ),
        "@user": F.coalesce(F.col("user"), F.lit(NO_USER)),
        "@changeset": F.coalesce(F.col("changeset").cast("string"), F.lit(NO_CHANGESET)),
    }
    own = F.map_filter("tags", lambda k, v: ~k.isin(*metadata))
    return F.map_concat(
        own, F.create_map(*[c for k, v in metadata.items() for c in (F.lit(k), v)])
    )


def wanted_elements(
    elements: DataFrame, wanted: Mapping[str, Sequence[str]], unique_ids: bool = False
) -> DataFrame:
    """Elements whose latest version has at least one wanted key and value."""
    condition = F.size(chosen_values(F.col("tags"), wanted)) > 0
    return elements.filter(condition) if unique_ids else latest_where(elements, condition)


def element_records(
    nodes: DataFrame,
    ways: DataFrame,
    relations: DataFrame,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    source: str = "elements",
    line_keys: Sequence[str] = (),
    unique_ids: bool = False,
    wanted: Mapping[str, Sequence[str]] | None = None,
    prune: bool = True,
) -> DataFrame:
    """Records of every wanted (element, key) pair, geometry assembled.

    Only elements whose latest version has a wanted value enter the joins; the
    coordinates of nodes serve ways and relations together. ``prune`` keeps
    nodes that nothing wanted refers to out of every shuffle.
    """
    wanted = wanted if wanted is not None else wanted_values(tags, subtags)
    node = F.lit("node")
    points = node_points(wanted_elements(nodes, wanted, unique_ids)).select(
        "*", node.alias("osm_type"), node.alias("src_type")
    )
    shapes = line_and_area_features(
        wanted_elements(ways, wanted, unique_ids),
        wanted_elements(relations, wanted, unique_ids),
        ways,
        nodes,
        line_keys,
        unique_ids,
        prune,
    )
    features = union_parts(points.drop("lon", "lat"), shapes).select(
        _props().alias("props"), "geometry_wkt", "osm_type", F.lit(source).alias("source")
    )
    chosen = chosen_values(F.col("props"), wanted)
    return project_features(
        features.select("*", F.explode(chosen).alias("category", "sub_cat"))
    )


def extract_elements(
    nodes: DataFrame,
    ways: DataFrame,
    relations: DataFrame,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    existing: DataFrame | None = None,
    **options,
) -> DataFrame:
    """New, clean records of the element tables."""
    return merge(element_records(nodes, ways, relations, tags, subtags, **options), existing)
