"""Newline-delimited features: reading, size guard, parsing."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrafold.functions.collections import deep_wkt
from terrafold.functions.geometry import DEEPER, geojson_to_wkt, geometry_schema
from terrafold.functions.text import last_wins, source_label, unescaped
from terrafold.schema import MAX_LINE_BYTES

# Characters around a line that do not belong to it: record separator, return, blank.
_FRAME = "\x1e\r "

# The reader counts the line end and drops lines that reach its limit.
_LENGTH_OPTION = "mapreduce.input.linerecordreader.line.maxlength"


def _source() -> Column:
    return source_label(unescaped(F.col("_metadata.file_name"))).alias("source")


def line_reader(reader, max_bytes: int = MAX_LINE_BYTES):
    """Text options of a batch or stream reader; long lines never leave it."""
    return reader.format("text").option("lineSep", "\n").option(_LENGTH_OPTION, max_bytes + 2)


def clean_lines(raw: DataFrame, max_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    """Valid text without framing characters, blank and too long lines left out."""
    # the reader lets one byte more pass in a last line without line end
    return (
        raw.filter(F.octet_length("value") <= max_bytes)
        .select(
            F.trim(F.make_valid_utf8(F.col("value")), F.lit(_FRAME)).alias("value"),
            _source(),
        )
        .filter(F.col("value") != "")
    )


def read_feature_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    max_bytes: int = MAX_LINE_BYTES,
    min_file_bytes: int = 0,
) -> DataFrame:
    """(value, source) of every line up to ``max_bytes`` long.

    Bytes that are not UTF-8 read as U+FFFD. Files below ``min_file_bytes``
    are left out before they are opened.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = line_reader(spark.read, max_bytes).load(paths)
    if min_file_bytes:
        raw = raw.filter(F.col("_metadata.file_size") >= min_file_bytes)
    return clean_lines(raw, max_bytes)


def oversize_report(
    spark: SparkSession, path: str | Sequence[str], max_bytes: int = MAX_LINE_BYTES
) -> DataFrame:
    """Lines over the limit, counted per source."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.format("text").option("lineSep", "\n").load(paths)
    return (
        raw.filter(F.octet_length("value") > max_bytes)
        .groupBy(_source())
        .agg(F.count("*").alias("oversize_lines"))
    )


def mentions_keys(line: Column, keys: Sequence[str]) -> Column:
    """Cheap test that can only fail when no key stands in the line.

    A key may also be written with JSON escapes, so lines holding one pass.
    Single quotes are no JSON, here as in the parser.
    """
    listed = "|".join(re.escape(key) for key in keys)
    return F.rlike(line, F.lit(rf'"(?:{listed})"|\\'))


def _from_lines(lines: DataFrame, *steps: Callable[[Column], Column]) -> DataFrame:
    """Columns made from each feature by ``steps``, beside the lines' own.

    The line is parsed as a member of a wrapping object, so that text after
    the feature makes it malformed. Each step maps the array of at most one
    struct that the step before gave; an empty array drops the line. All of it
    is one expression below ``inline``: nothing is computed twice, because
    filters are not pushed below a generator, and rows are copied once.
    """
    schema = f"feature struct<geometry: {geometry_schema()}, properties: map<string,string>>"
    wrapped = F.concat(F.lit('{"feature":'), F.col("value"), F.lit("}"))
    rows = F.transform(F.array(F.from_json(wrapped, schema, {"allowSingleQuotes": "false"})), lambda r: r["feature"])
    for step in steps:
        rows = step(rows)
    return lines.select("*", F.inline(rows))


def _with_props(rows: Column) -> Column:
    """Features that have properties: (props, geometry)."""
    kept = F.filter(rows, lambda f: f["properties"].isNotNull())
    return F.transform(
        kept,
        lambda f: F.struct(
            last_wins(f["properties"]).alias("props"), f["geometry"].alias("geometry")
        ),
    )


def _with_wkt(rows: Column, carried: Sequence[str] = ("props",)) -> Column:
    """Features whose geometry converts; type and text replace the geometry."""
    converted = F.transform(
        rows,
        lambda f: F.struct(
            *[f[c].alias(c) for c in carried],
            f["geometry"]["type"].alias("geometry_type"),
            geojson_to_wkt(f["geometry"]).alias("geometry_wkt"),
        ),
    )
    return F.filter(converted, lambda f: f["geometry_wkt"].isNotNull())


def _with_chosen(choose: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Adds ``chosen``, a map made from the properties; features without any go."""

    def step(rows: Column) -> Column:
        marked = F.transform(
            rows,
            lambda f: F.struct(
                f["props"].alias("props"),
                f["geometry"].alias("geometry"),
                choose(f["props"]).alias("chosen"),
            ),
        )
        return F.filter(marked, lambda f: F.size(f["chosen"]) > 0)

    return step


def _with_deep(features: DataFrame, column: str = "geometry_wkt") -> DataFrame:
    """Marked geometries converted from their line."""
    marked = F.col(column) == DEEPER
    return features.withColumn(
        column, F.when(marked, deep_wkt(F.when(marked, F.col("value")))).otherwise(F.col(column))
    )


def read_properties(lines: DataFrame) -> DataFrame:
    """(source, props, geometry) of well-formed lines that have properties."""
    return _from_lines(lines, _with_props).select("source", "props", "geometry")


def choose_features(lines: DataFrame, choose: Callable[[Column], Column]) -> DataFrame:
    """(source, props, chosen, geometry_type, geometry_wkt) of chosen features.

    ``choose`` maps the properties to the (key, value) pairs that are wanted.
    Only features with such a pair have their geometry converted.
    """
    converted = lambda rows: _with_wkt(rows, ("props", "chosen"))
    found = _with_deep(_from_lines(lines, _with_props, _with_chosen(choose), converted))
    return found.filter(F.col("geometry_wkt").isNotNull()).drop("value")


def parse_features(lines: DataFrame) -> DataFrame:
    """(source, props, geometry_type, geometry_wkt) of usable feature lines."""
    found = _with_deep(_from_lines(lines, _with_props, _with_wkt))
    return found.filter(F.col("geometry_wkt").isNotNull()).drop("value")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines :func:`parse_features` leaves out, with the reason."""

    def judged(rows: Column) -> Column:
        return F.transform(
            rows, lambda f: F.struct(f.alias("f"), geojson_to_wkt(f["geometry"]).alias("wkt"))
        )

    reason = (
        F.when(F.col("f").isNull(), "malformed")
        .when(F.col("f.properties").isNull(), "no_properties")
        .when(F.col("f.geometry").isNull(), "no_geometry")
        .when(F.col("wkt").isNull(), "unconvertible")
    )
    found = _with_deep(_from_lines(lines, judged), "wkt").withColumn("reason", reason)
    return found.filter(F.col("reason").isNotNull()).select("source", "value", "reason")
