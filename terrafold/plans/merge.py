"""The merge job: staged rows and earlier output to new, clean records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from terrafold.operators.filters import valid_geometry
from terrafold.operators.relational import dedupe, new_only

#: A feature is kept once per key it carries, whatever the number of sources.
MERGE_KEYS = ["category", "osm_id", "osm_type", "src_type"]


def merge(
    parts: DataFrame,
    existing: DataFrame | None = None,
    keys: Sequence[str] = MERGE_KEYS,
    keep_unidentified: bool = False,
) -> DataFrame:
    """One record per key, not yet exported, with a usable geometry.

    The choice of one row per key comes first: it already thins out hot keys
    inside each task, and the join with the existing keys then reuses its
    partitioning. Removing whole keys afterwards gives the same rows as
    removing them before. Geometries are judged last, on the fewest rows.
    """
    keys = [k for k in keys if k in parts.columns]
    records = dedupe(parts, keys, keep_unidentified=keep_unidentified)
    if existing is not None:
        known = [k for k in keys if k in existing.columns]
        records = new_only(records, existing, known, True, keep_unidentified)
    return valid_geometry(records)
