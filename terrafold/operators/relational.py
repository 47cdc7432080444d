"""Joins, set operations and de-duplication of feature records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from terrafold.functions.flat import to_wkb
from terrafold.schema import FEATURE, FEATURE_COLUMNS


def conform(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The record's columns in order; missing or null ones become "".

    Columns in ``keep`` ride along as they are.
    """

    def column(field) -> Column:
        if field.name not in records.columns:
            value, blank = F.lit(None), "0" if field.name == "osm_id" else ""
        else:
            value, blank = F.col(field.name), "0" if field.name == "osm_id" else ""
        return F.coalesce(value.cast("string"), F.lit(blank)).cast(field.dataType).alias(field.name)

    return records.select(
        *[column(f) for f in FEATURE.fields],
        *[F.col(c) for c in keep if c in records.columns and c not in FEATURE_COLUMNS],
    )


def union_parts(*parts: DataFrame) -> DataFrame:
    """All parts together; columns a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def whitelisted(records: DataFrame, allowed: DataFrame) -> DataFrame:
    """Records whose (category, sub_cat) is in the whitelist.

    The built-in whitelist has about 200 rows of known size, so Spark sends it
    to every task; a longer one is joined by shuffle.
    """
    return records.join(allowed, ["category", "sub_cat"], "left_semi")


def unique_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, for the right side of a join.

    Copies collapse before the shuffle. Grouping also by a hash of the keys
    changes no result, but keeps this shuffle apart from the one of the join,
    and only a join that reads plain shuffles has its skewed partitions split
    at run time. So a key that fills a third of the left side is spread.
    """
    spread = F.xxhash64(*[F.col(k) for k in keys]).alias("_spread")
    return rows.select(*keys, spread).distinct().drop("_spread")


def new_only(
    records: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("osm_id", "osm_type"),
    unique: bool = False,
    keep_unidentified: bool = False,
) -> DataFrame:
    """Records whose key is not among the existing ones.

    Say ``unique`` when :func:`dedupe` on the same keys came before: its
    partitioning is then used again and only the existing keys move.
    ``keep_unidentified`` tells rows with id 0 apart by their content, as
    :func:`dedupe` does; they pass where ``existing`` has no ``content`` column.
    """
    keys = list(keys)
    known = existing.select(*keys).distinct() if unique else unique_keys(existing, keys)
    if not keep_unidentified:
        return records.join(known, keys, "left_anti")
    new = records.filter(F.col("osm_id") != 0).join(known, keys, "left_anti")
    unknown = records.filter(F.col("osm_id") == 0)
    if "content" in existing.columns:
        written = unique_keys(existing.filter(F.col("osm_id") == 0), [*keys, "content"])
        marked = unknown.withColumn("content", content_hash(to_wkb(F.col("geometry_wkt")), F.col("tags")))
        unknown = marked.join(written, [*keys, "content"], "left_anti").select(*records.columns)
    return new.unionByName(unknown)


def content_hash(wkb: Column, tags: Column) -> Column:
    """What tells two features without id apart: geometry and tags."""
    return F.xxhash64(wkb, tags)


def record_order(columns: Sequence[str]) -> list[Column]:
    """Total order in which the first of several copies is chosen.

    Source, then latest version, then content, so that the choice does not
    depend on how the input was split or read.
    """
    first = []
    if "source" in columns:
        first.append(F.col("source").asc())
    if "version" in columns:
        first.append(F.col("version").try_cast("bigint").desc_nulls_last())
    rest = ["geometry_wkt", "sub_cat", "tags", "timestamp", "user", "changeset"]
    return first + [F.col(c).asc() for c in rest if c in columns]


def dedupe(
    records: DataFrame,
    keys: Sequence[str] = ("osm_id", "osm_type"),
    order: Sequence[Column] | None = None,
    keep_unidentified: bool = False,
) -> DataFrame:
    """First record of each key.

    Each task keeps one row per key before the shuffle, so a key that fills a
    third of the input (such as id 0) sends one row per task, not all of them.
    ``keep_unidentified`` tells rows with id 0 apart by their content.
    """
    partition = [F.col(k) for k in keys]
    if keep_unidentified:
        content = F.xxhash64("geometry_wkt", "tags")
        partition.append(F.when(F.col("osm_id") == 0, content).otherwise(F.lit(0)))
    window = Window.partitionBy(*partition).orderBy(*(order or record_order(records.columns)))
    ranked = records.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def drop_stale(parts: DataFrame, subtags: Sequence[str] | None) -> DataFrame:
    """Staged rows of the requested values.

    No list, or an empty one, keeps everything. The value itself decides, not
    its folder, whose name may stand for several values.
    """
    if not subtags:
        return parts
    return parts.filter(F.col("sub_cat").isin(*[s.strip().lower() for s in subtags]))


def routing_keys(records: DataFrame) -> DataFrame:
    """Distinct (category, sub_cat, geom_group), one per output folder."""
    return records.select("category", "sub_cat", "geom_group").distinct()
