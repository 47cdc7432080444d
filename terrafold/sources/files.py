"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrafold.functions.text import unescaped
from terrafold.schema import FORMAT_EXTENSIONS


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, bytes) of every file below ``path``.

    The content column is pruned, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("bytes"),
    )


def list_outputs(spark: SparkSession, path: str) -> DataFrame:
    """(category, sub_cat_dir, extension, bytes) of written output files.

    Reads ``{format}/category=…/sub_cat_dir=…`` from the path, whatever lies
    between them and the file. The extension is the one that stands for the
    format, whatever ending Spark gave to the file.
    """
    part = lambda key: unescaped(F.regexp_extract("path", rf"/{key}=([^/]*)/", 1))
    written = F.regexp_extract("path", "/([^/]+)/category=", 1)
    extension = F.create_map(*[F.lit(v) for pair in FORMAT_EXTENSIONS.items() for v in pair])
    return list_files(spark, path).select(
        part("category").alias("category"),
        part("sub_cat_dir").alias("sub_cat_dir"),
        extension[written].alias("extension"),
        "bytes",
    )


def select_inputs(files: DataFrame, min_bytes: int = 1) -> DataFrame:
    """Inputs to read, from (category, part, bytes).

    ``part`` is null for the base file of a category. Files below ``min_bytes``
    count as empty (by default only those that are); a category with usable
    parts leaves its base file out. See :func:`left_out_inputs`.
    """
    usable = files.filter(F.col("bytes") >= min_bytes)
    parts = usable.filter(F.col("part").isNotNull())
    bases = usable.filter(F.col("part").isNull()).join(
        parts.select("category").distinct(), "category", "left_anti"
    )
    return parts.unionByName(bases)


def left_out_inputs(files: DataFrame, min_bytes: int = 1) -> DataFrame:
    """(category, part, bytes, reason) of what :func:`select_inputs` leaves out."""
    small = files.filter(F.col("bytes") < min_bytes).withColumn("reason", F.lit("small"))
    usable = files.filter(F.col("bytes") >= min_bytes)
    parted = usable.filter(F.col("part").isNotNull()).select("category").distinct()
    bases = usable.filter(F.col("part").isNull()).join(parted, "category", "left_semi")
    return small.unionByName(bases.select(*files.columns, F.lit("has_parts").alias("reason")))
