"""From features with a tag map to records with fixed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terrafold.functions.geometry import geom_group, object_type
from terrafold.operators.filters import chosen_values
from terrafold.functions.text import first_present, parse_id, sanitize_name, tags_json
from terrafold.schema import FEATURE_COLUMNS, LINEAGE_COLUMNS, PLAIN_ATTRIBUTES, SHORT_NAMES


def fan_out(features: DataFrame, tags: Sequence[str]) -> DataFrame:
    """One row per feature and matching key, with ``category`` and ``sub_cat``.

    One pass serves all keys; a feature gives at most ``len(tags)`` rows.
    """
    pairs = chosen_values(F.col("props"), {tag: [] for tag in tags})
    return features.select("*", F.explode(pairs).alias("category", "sub_cat"))


def _edit_metadata(props: Column) -> list[Column]:
    pick = lambda key, default: F.coalesce(props[f"@{key}"], F.lit(default)).alias(key)
    return [
        pick("version", ""), pick("timestamp", ""), pick("user", "unknown"), pick("changeset", "")
    ]


def project_features(features: DataFrame) -> DataFrame:
    """Feature records, plus lineage columns, of fanned-out features.

    Needs ``props``, ``category``, ``sub_cat``, ``geometry_wkt``, ``source`` and
    either ``geometry_type`` or ``osm_type``.
    """
    props = F.col("props")
    plain = {c: F.coalesce(props[c], F.lit("")) for c in ["admin_level", *PLAIN_ATTRIBUTES]}
    if "osm_type" not in features.columns:
        features = features.withColumn("osm_type", object_type(F.col("geometry_type")))
    osm_type = F.col("osm_type")
    columns = {
        "osm_id": parse_id(props["@id"]),
        "osm_type": osm_type,
        "name": first_present(props, ["name", "name:en"], "Unknown"),
        "category": F.col("category"),
        "sub_cat": F.col("sub_cat"),
        **plain,
        **{c: col for c, col in zip(["version", "timestamp", "user", "changeset"], _edit_metadata(props))},
        "tags": tags_json(props),
        "plant_source": first_present(props, ["plant:source", "generator:source"], ""),
        "strat_level": first_present(props, ["strat_level", "level"], ""),
        "geometry_wkt": F.col("geometry_wkt"),
        "geom_group": geom_group(osm_type),
        "source": F.col("source"),
        "src_type": F.coalesce(props["@type"], osm_type),
    }
    return features.select(*[columns[c].alias(c) for c in FEATURE_COLUMNS + LINEAGE_COLUMNS])


def edit_time(records: DataFrame) -> DataFrame:
    """Adds ``edited_at``, the edit time as a timestamp where it reads as one."""
    return records.withColumn("edited_at", F.try_to_timestamp("timestamp"))


def with_folders(records: DataFrame) -> DataFrame:
    """Adds ``sub_cat_dir``, the safe folder name of the value."""
    return records.withColumn("sub_cat_dir", sanitize_name(F.col("sub_cat")))


def short_names(records: DataFrame) -> DataFrame:
    """Columns renamed and cut to ten characters; fails when two collide."""
    names = [SHORT_NAMES.get(c, c)[:10] for c in records.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide at ten characters: {names}")
    return records.toDF(*names)
