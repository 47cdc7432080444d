"""Staged parts and earlier output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from terrafold.operators.relational import conform, content_hash, union_parts
from terrafold.schema import STAGED


def read_parts(
    spark: SparkSession, json_path: str | None = None, parquet_path: str | None = None
) -> DataFrame:
    """Staged rows from JSON lines and/or Parquet, with the record's columns.

    The schema is given, so a value such as "0042" stays text, and columns a
    part lacks come out as "".
    """
    read = []
    if json_path:
        read.append(spark.read.schema(STAGED).json(json_path))
    if parquet_path:
        read.append(spark.read.schema(STAGED).parquet(parquet_path))
    return conform(union_parts(*read), keep=("source", "src_type"))


def existing_ids(
    spark: SparkSession, path: str | Sequence[str], keys: Sequence[str] = ("osm_id",)
) -> DataFrame:
    """Key columns of earlier Parquet output; nothing else is read."""
    paths = [path] if isinstance(path, str) else list(path)
    schema = T.StructType([STAGED[k] for k in keys])
    return spark.read.schema(schema).parquet(*paths).select(*keys)


def existing_contents(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Key columns of earlier Parquet output with ``content``, geometry and tags as one hash."""
    schema = T.StructType([*(STAGED[k] for k in keys), T.StructField("geometry", T.BinaryType()), STAGED["tags"]])
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*keys, content_hash(F.col("geometry"), F.col("tags")).alias("content"))


def written_ids(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Key columns of features written as GeoJSON lines."""
    schema = T.StructType([T.StructField("properties", T.StructType([STAGED[k] for k in keys]))])
    return spark.read.schema(schema).json(path).select("properties.*")
