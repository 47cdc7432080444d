"""Row filters on features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terrafold.functions.geometry import bounds
from terrafold.functions.rings import geometry_issue
from terrafold.functions.text import norm_value
from terrafold.schema import WHITELIST


def with_tag(features: DataFrame, tag: str) -> DataFrame:
    """Features that carry the key with a value."""
    return features.filter(F.col("props")[tag].isNotNull())


def with_any_tag(features: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Features that carry at least one of the keys."""
    wanted = F.array(*[F.lit(t) for t in tags])
    return features.filter(F.arrays_overlap(F.map_keys("props"), wanted))


def wanted_values(
    tags: Sequence[str], subtags: Sequence[str] | None = None
) -> dict[str, list[str]]:
    """Values to keep for each key; an empty list keeps all.

    ``subtags`` None takes the whitelist (a key without one keeps all), an
    empty list keeps all, a list keeps its values.
    """
    if subtags is None:
        return {tag: list(WHITELIST.get(tag, [])) for tag in tags}
    return {tag: list(subtags) for tag in tags}


def _value_lists(wanted: Mapping[str, Sequence[str]]) -> Column:
    """Constant map from key to the list of its values."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    entries = [
        f"{quoted(tag)}, CAST(array({', '.join(map(quoted, values))}) AS array<string>)"
        for tag, values in wanted.items()
    ]
    return F.expr(f"map({', '.join(entries)})")


def value_test(category: Column, sub_cat: Column, wanted: Mapping[str, Sequence[str]]) -> Column:
    """Whether a normalised value is wanted for its key."""
    free = [tag for tag, values in wanted.items() if not values]
    # the length first, so that no other key and value read the same; many literals become one look-up
    pair = F.concat(F.length(category).cast("string"), F.lit(":"), category, sub_cat)
    pairs = [f"{len(tag)}:{tag}{value}" for tag, values in wanted.items() for value in values]
    return F.coalesce(category.isin(free), F.lit(False)) | F.coalesce(pair.isin(pairs), F.lit(False))


def chosen_values(props: Column, wanted: Mapping[str, Sequence[str]]) -> Column:
    """Map of the wanted keys a feature carries to their normalised values."""
    lists = _value_lists(wanted)
    named = F.map_filter(props, lambda k, v: F.map_contains_key(lists, k) & v.isNotNull())
    normal = F.transform_values(named, lambda k, v: norm_value(v))
    if not any(wanted.values()):
        return normal
    return F.map_filter(normal, lambda k, v: value_test(k, v, wanted))


def filter_subtags(
    features: DataFrame, tag: str, subtags: Sequence[str] | None = None
) -> DataFrame:
    """Features whose value of ``tag`` is wanted, see :func:`wanted_values`."""
    value = norm_value(F.col("props")[tag])
    test = value_test(F.lit(tag), value, wanted_values([tag], subtags))
    return with_tag(features, tag).filter(test)


BOX = ["min_lon", "min_lat", "max_lon", "max_lat"]


def with_box(features: DataFrame) -> DataFrame:
    """Adds the extent as plain columns, to be stored beside the geometry."""
    box = features.select("*", F.explode(F.array(bounds(F.col("geometry_wkt")))).alias("_box"))
    return box.select(*features.columns, *[F.col(f"_box.{c}").alias(c) for c in BOX])


def bbox_filter(
    features: DataFrame, min_lon: float, min_lat: float, max_lon: float, max_lat: float
) -> DataFrame:
    """Features whose extent meets the box.

    Stored extents (see :func:`with_box`) are compared as they are, so that a
    Parquet scan skips row groups by them; otherwise the text is read.
    """
    stored = set(BOX) <= set(features.columns)
    boxed = features if stored else with_box(features)
    kept = boxed.filter(
        (F.col("max_lon") >= min_lon)
        & (F.col("min_lon") <= max_lon)
        & (F.col("max_lat") >= min_lat)
        & (F.col("min_lat") <= max_lat)
    )
    return kept if stored else kept.drop(*BOX)


def with_issue(features: DataFrame) -> DataFrame:
    """Adds ``issue``, the first geometry defect or "ok"."""
    return features.withColumn("issue", geometry_issue(F.col("geometry_wkt")))


def valid_geometry(features: DataFrame) -> DataFrame:
    """Features with a usable geometry."""
    return features.filter(geometry_issue(F.col("geometry_wkt")) == "ok")
