"""Writers of feature records.

Rows are rebalanced by their output folder first: each folder is written by
few tasks, and Spark splits a folder that is too large for one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrafold.functions.geometry import wkt_to_geojson
from terrafold.functions.flat import to_wkb
from terrafold.operators.project import short_names, with_folders
from terrafold.schema import OUTPUT_ROWS, PART_ROWS
from terrafold.session import scratch_path

FOLDERS = ["category", "sub_cat_dir", "geom_group"]


def _in_folders(records: DataFrame, folders: Sequence[str]) -> DataFrame:
    return with_folders(records).hint("rebalance", *[F.col(c) for c in folders])


def write_parts(
    records: DataFrame, path: str, mode: str = "append", max_rows_per_file: int = PART_ROWS
) -> None:
    """Staged JSON lines, one folder per key, value, group and source."""
    folders = [*FOLDERS, "source"]
    (
        _in_folders(records, folders)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*folders)
        .json(path)
    )


def write_parquet(
    records: DataFrame, path: str, mode: str = "append", max_rows_per_file: int = 0
) -> None:
    """Parquet with the geometry as WKB, in folders by key, value and group."""
    rows = records.withColumn("geometry", to_wkb(F.col("geometry_wkt"))).drop("geometry_wkt")
    (
        _in_folders(rows, FOLDERS)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*FOLDERS)
        .parquet(path)
    )


def write_table(
    records: DataFrame, name: str = "features", path: str | None = None, mode: str = "append"
) -> None:
    """Catalog table with the geometry as WKT; made when it does not exist."""
    folders = FOLDERS[:2]
    rows = _in_folders(records.drop("geom_group"), folders)
    writer = rows.write.mode(mode).format("parquet").partitionBy(*folders)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def geojson_lines(records: DataFrame) -> DataFrame:
    """Folder columns and ``value``, one GeoJSON feature per record."""
    rows = with_folders(records)
    return rows.select(*FOLDERS, geojson_value(records.columns).alias("value"))


def geojson_value(columns: Sequence[str]) -> Column:
    """One GeoJSON feature, with the columns as its properties."""
    hidden = {"geometry_wkt", "sub_cat_dir"}
    return F.concat(
        F.lit('{"type":"Feature","geometry":'),
        wkt_to_geojson(F.col("geometry_wkt")),
        F.lit(',"properties":'),
        F.to_json(F.struct(*[c for c in columns if c not in hidden])),
        F.lit("}"),
    )


def write_geojson_lines(
    records: DataFrame, path: str, mode: str = "append", max_rows_per_file: int = OUTPUT_ROWS
) -> None:
    """One GeoJSON feature per line, so that readers can split the files."""
    (
        geojson_lines(records)
        .hint("rebalance", *[F.col(c) for c in FOLDERS])
        .write.mode(mode)
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*FOLDERS)
        .text(path)
    )


def write_short(
    records: DataFrame,
    path: str,
    mode: str = "append",
    max_rows_per_file: int = OUTPUT_ROWS,
    fmt: str = "parquet",
) -> None:
    """Columns with names of ten characters at most, in files of bounded length."""
    folders = FOLDERS[:2]
    rows = with_folders(records)
    # folder names are no columns of a file
    named = short_names(rows.drop(*folders)).columns
    rows = rows.select(*[c for c in rows.columns if c not in folders], *folders).toDF(*named, *folders)
    (
        rows.hint("rebalance", *[F.col(c) for c in folders])
        .write.mode(mode)
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("header", "true")
        .partitionBy(*folders)
        .format(fmt)
        .save(path)
    )


def _sinks(path: str, table: str | None) -> dict[str, Callable[[DataFrame], None]]:
    return {
        "parquet": lambda rows: write_parquet(rows, f"{path}/parquet"),
        "table": lambda rows: write_table(rows, table or "features", f"{path}/table"),
        "geojson": lambda rows: write_geojson_lines(rows, f"{path}/geojson"),
        "short": lambda rows: write_short(rows, f"{path}/short"),
    }


def write_all(
    records: DataFrame,
    path: str,
    formats: Sequence[str],
    table: str | None = None,
    new_for: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows,
) -> list[tuple[str, str, str]]:
    """Write one result in several formats: (format, status, message) each.

    More than one format reads from a table written once in the shared folder:
    nothing is computed twice, and a lost executor costs a read only. A format
    that fails does not stop the others. ``new_for`` leaves out what a format
    already holds.
    """
    sinks = _sinks(path, table)
    if len(formats) > 1:
        spark: SparkSession = records.sparkSession
        staged = scratch_path(spark, "staged")
        records.write.parquet(staged)
        records = spark.read.schema(records.schema).parquet(staged)
    outcome = []
    for name in formats:
        try:
            sinks[name](new_for(name, records))
            outcome.append((name, "ok", ""))
        except Exception as error:  # reported, so that the caller can decide
            outcome.append((name, "failed", f"{type(error).__name__}: {error}"))
    return outcome
