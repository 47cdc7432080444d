"""Reports on inputs and results."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from terrafold.functions.rings import geometry_issue
from terrafold.schema import MIN_OUTPUT_BYTES
from terrafold.sources.lines import rejected_lines


def run_report(records: DataFrame) -> DataFrame:
    """Records per output folder."""
    return records.groupBy("category", "sub_cat", "geom_group").agg(F.count("*").alias("records"))


def rejected_counts(lines: DataFrame) -> DataFrame:
    """(source, reason, lines): feature lines that give no feature, and why."""
    return rejected_lines(lines).groupBy("source", "reason").agg(F.count("*").alias("lines"))


def observed(records: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """The same rows, counted while some later action reads them."""
    watch = Observation(name)
    counted = records.observe(
        watch, F.count("*").alias("records"), F.count_if(F.col("osm_id") == 0).alias("unidentified")
    )
    return counted, watch


def _requested(like: DataFrame, tags: Sequence[str]) -> DataFrame:
    schema = pa.schema([("category", pa.string())])
    return like.sparkSession.createDataFrame(pa.table({"category": list(tags)}, schema))


def validate_files(
    files: DataFrame, tags: Sequence[str], min_bytes: int = MIN_OUTPUT_BYTES
) -> DataFrame:
    """Quick check: (category, bytes, status) from a listing (category, bytes)."""
    sizes = files.groupBy("category").agg(F.max("bytes").alias("bytes"))
    status = (
        F.when(F.col("bytes").isNull(), "missing")
        .when(F.col("bytes") < min_bytes, "corrupt")
        .otherwise("ok")
    )
    joined = _requested(files, tags).join(sizes, "category", "left")
    return joined.select("category", "bytes", status.alias("status"))


def validate_inputs(records: DataFrame, tags: Sequence[str], deep: bool = True) -> DataFrame:
    """Per category: records, broken geometries, repeated ids, status.

    The quick form only counts; the deep one reads every geometry.
    """
    issue = geometry_issue(F.col("geometry_wkt")) if deep else F.lit("ok")
    # counted per id first, so that a category's rows are spread over its ids
    per_id = (
        records.select("category", "osm_id", "osm_type", (issue != "ok").alias("broken"))
        .groupBy("category", "osm_id", "osm_type")
        .agg(F.count("*").alias("n"), F.count_if("broken").alias("broken"))
    )
    repeated = F.sum(F.col("n") - 1) if deep else F.lit(0)
    per_category = per_id.groupBy("category").agg(
        F.sum("n").alias("records"),
        F.sum("broken").alias("broken"),
        repeated.cast("bigint").alias("repeated"),
    )
    status = (
        F.when(F.col("records").isNull(), "missing")
        .when((F.col("broken") > 0) | (F.col("repeated") > 0), "corrupt")
        .otherwise("ok")
    )
    joined = _requested(records, tags).join(per_category, "category", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return joined.select(
        "category", zero("records"), zero("broken"), zero("repeated"), status.alias("status")
    )
