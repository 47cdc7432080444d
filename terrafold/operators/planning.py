"""What is left to do: manifests, missing outputs, slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terrafold.functions.text import sanitize_name, unescaped
from terrafold.schema import FORMAT_EXTENSIONS, MIN_OUTPUT_BYTES, WHITELIST


def extensions_of(formats: Sequence[str]) -> list[str]:
    """File name endings that stand for the formats."""
    return [FORMAT_EXTENSIONS[f] for f in formats]


def manifest(files: DataFrame, min_bytes: int = MIN_OUTPUT_BYTES) -> DataFrame:
    """(category, sub_cat_dir, extensions) of outputs larger than ``min_bytes``.

    Only the known endings are gathered, so a list has five entries at most.
    """
    known = F.col("extension").isin(*FORMAT_EXTENSIONS.values())
    return (
        files.filter(known & (F.col("bytes") > min_bytes))
        .groupBy("category", "sub_cat_dir")
        .agg(F.array_sort(F.collect_set("extension")).alias("extensions"))
    )


def expected_outputs(
    like: DataFrame, tags: Sequence[str], values: Mapping[str, Sequence[str]] = WHITELIST
) -> DataFrame:
    """(category, sub_cat) a full run gives; sub_cat null where all values count."""
    pairs = [(t, v) for t in tags for v in (values.get(t) or [None])]
    schema = pa.schema([("category", pa.string()), ("sub_cat", pa.string())])
    table = pa.table({"category": [t for t, _ in pairs], "sub_cat": [v for _, v in pairs]}, schema)
    return like.sparkSession.createDataFrame(table)


def missing_outputs(expected: DataFrame, done: DataFrame, formats: Sequence[str]) -> DataFrame:
    """Expected pairs without an output in any of the formats.

    A pair with null ``sub_cat`` is missing when its category has no output at
    all.
    """
    wanted = F.array(*[F.lit(e) for e in extensions_of(formats)])
    written = done.filter(F.arrays_overlap("extensions", wanted)).select("category", "sub_cat_dir")
    listed = (
        expected.filter(F.col("sub_cat").isNotNull())
        .withColumn("sub_cat_dir", sanitize_name(F.col("sub_cat")))
        .join(written, ["category", "sub_cat_dir"], "left_anti")
    )
    open_keys = expected.filter(F.col("sub_cat").isNull()).join(
        done.select("category").distinct(), "category", "left_anti"
    )
    return listed.select("category", "sub_cat").unionByName(open_keys)


def plan_run(
    expected: DataFrame, done: DataFrame, formats: Sequence[str], mode: str = "standard"
) -> DataFrame:
    """(category, sub_cat) still to extract.

    "standard" passes over every category that has any output; "detailed"
    looks at each value.
    """
    if mode == "standard":
        return expected.join(done.select("category").distinct(), "category", "left_anti")
    return missing_outputs(expected, done, formats)


def part_summary(files: DataFrame) -> DataFrame:
    """(prefix, parts): staged files per merge group."""
    prefix = F.regexp_extract("name", r"^(.*)_b", 1)
    return (
        files.filter(F.contains(F.col("name"), F.lit("_b")))
        .groupBy(prefix.alias("prefix"))
        .agg(F.count("*").alias("parts"))
    )


def staged_summary(files: DataFrame) -> DataFrame:
    """(prefix, parts): staged files per merge group, from the paths that ``write_parts`` gives.

    The prefix names value, geometry group and source, as in :func:`part_summary`.
    """
    part = lambda key: unescaped(F.regexp_extract("path", rf"/{key}=([^/]*)/", 1))
    staged = files.filter(F.col("path").rlike("/sub_cat_dir=[^/]*/geom_group=[^/]*/source=[^/]*/[^/_.]"))
    prefix = F.concat_ws("_", part("sub_cat_dir"), part("geom_group"), part("source"))
    return staged.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("parts"))


def slice_id(lon: Column, slices: Column) -> Column:
    """Longitude slice of a point; slices are half open, the last one closed."""
    raw = F.floor((lon + 180.0) / (F.lit(360.0) / slices))
    return F.greatest(F.lit(0), F.least(slices - 1, raw)).cast("int")


def lon_slice(rows: DataFrame, slices: int, lon: str = "lon") -> DataFrame:
    """Adds ``slice_id``; each row is in exactly one slice."""
    return rows.withColumn("slice_id", slice_id(F.col(lon), F.lit(slices)))


def plan_slices(
    rows: DataFrame, target_rows: int, min_rows: int = 1, lon: str = "lon"
) -> DataFrame:
    """(slice_id, min_lon, max_lon, rows) of the slices worth reading.

    As many equal slices as hold ``target_rows`` on average; those with fewer
    than ``min_rows`` are dropped.
    """
    placed = rows.select(F.col(lon).alias("lon")).filter(F.col("lon").isNotNull())
    wanted = F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(target_rows)))
    slices = placed.agg(wanted.alias("n")).scalar()
    counted = (
        placed.select(slice_id(F.col("lon"), slices).alias("slice_id"))
        .groupBy("slice_id")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") >= min_rows)
    )
    width = F.lit(360.0) / slices
    low = F.col("slice_id") * width - 180.0
    return counted.select("slice_id", low.alias("min_lon"), (low + width).alias("max_lon"), "rows")


#: Cells in a degree that slices are cut at, in both directions.
CELLS = 64
_SLICES = "slice_id int, min_lon double, max_lon double, min_lat double, max_lat double, rows long"


def _cell(value: Column, low: int, high: int) -> Column:
    """Number of the cell of an ordinate, null without one; what lies outside counts to the first or last."""
    inside = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
    cell = F.least(F.lit((high - low) * CELLS - 1), F.floor((inside - low) * CELLS))
    return F.when(value.isNotNull() & ~F.isnan(value), cell.cast("int"))


def _cut(counts: list[tuple[int, int]], end: int, target: int) -> list[tuple[int, int, int]]:
    """(first cell, end cell, rows): stretches of about ``target`` rows that cover all cells to ``end``.

    counts: (cell, rows) ascending. None holds more than twice the target but
    for a cell that alone does, which has a stretch of its own. Stretches of
    less than half the target join the one before where both fit.
    """
    found, start, held = [], 0, 0
    for cell, rows in counts:
        if held and held + rows > target and (held >= target / 2 or held + rows > 2 * target):
            found.append((start, cell, held))
            start, held = cell, 0
        held += rows
        if held >= target:
            found.append((start, cell + 1, held))
            start, held = cell + 1, 0
    if found and (held == 0 or held < target / 2 and found[-1][2] + held <= 2 * target):
        first, _, rows = found.pop()
        start, held = first, rows + held
    return [*found, (start, end, held)]


def plan_slices_balanced(rows: DataFrame, target_rows: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(slice_id, min_lon, max_lon, min_lat, max_lat, rows): boxes of about ``target_rows`` each.

    Longitudes are cut by their counts, not by equal widths. A cell of one
    longitude that alone holds more than twice the target is cut in latitude in
    the same way. No box holds more than twice the target, unless one cell of
    1/64 degree does; the boxes cover the whole map, so no row is left out, but
    rows without a place have no box. Counts are added up in tasks; the driver
    gets one for each cell of longitude, and of latitude within the heavy ones.
    """
    cells = rows.select(_cell(F.col(lon), -180, 180).alias("x"), _cell(F.col(lat), -90, 90).alias("y"))
    cells = cells.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    by_x = [tuple(r) for r in cells.groupBy("x").count().orderBy("x").collect()]
    stretches = _cut(by_x, 360 * CELLS, target_rows)
    heavy = [x for x, n in by_x if n > 2 * target_rows]
    by_y: dict[int, list[tuple[int, int]]] = {}
    if heavy:
        for x, y, n in cells.filter(F.col("x").isin(heavy)).groupBy("x", "y").count().orderBy("x", "y").collect():
            by_y.setdefault(x, []).append((y, n))
    boxes = []
    for low, high, n in stretches:
        # a heavy cell stands alone but for empty ones around it
        inner = [x for x in by_y if low <= x < high]
        if inner:
            boxes += [(low, high, *part) for part in _cut(by_y[inner[0]], 180 * CELLS, target_rows)]
        else:
            boxes.append((low, high, 0, 180 * CELLS, n))
    table = [(i, a / CELLS - 180, b / CELLS - 180, c / CELLS - 90, d / CELLS - 90, n) for i, (a, b, c, d, n) in enumerate(boxes)]
    return rows.sparkSession.createDataFrame(table, _SLICES)


def in_slices(rows: DataFrame, slices: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows with the ``slice_id`` of their box; rows without a place are left out."""
    first, last = ((F.round((F.col(c) + 180) * CELLS)).cast("int") for c in ("min_lon", "max_lon"))
    own = slices.select(
        "slice_id",
        F.explode(F.sequence(first, last - 1)).alias("_x"),
        F.round((F.col("min_lat") + 90) * CELLS).cast("int").alias("_low"),
        F.round((F.col("max_lat") + 90) * CELLS).cast("int").alias("_high"),
    )
    placed = rows.withColumn("_x", _cell(F.col(lon), -180, 180)).withColumn("_y", _cell(F.col(lat), -90, 90))
    found = placed.join(own, "_x").filter((F.col("_y") >= F.col("_low")) & (F.col("_y") < F.col("_high")))
    return found.drop("_x", "_y", "_low", "_high")
