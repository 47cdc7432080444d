"""The extraction job: feature lines to written records, all keys in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrafold.operators.filters import chosen_values, wanted_values
from terrafold.operators.planning import expected_outputs, manifest, plan_run
from terrafold.operators.project import project_features
from terrafold.operators.quality import rejected_counts
from terrafold.operators.relational import drop_stale, new_only, unique_keys
from terrafold.plans.elements import element_records
from terrafold.plans.merge import MERGE_KEYS, merge
from terrafold.plans.profiles import RunConfig
from terrafold.sinks.writers import write_all
from terrafold.sources.files import list_outputs
from terrafold.sources.lines import choose_features, mentions_keys, oversize_report, read_feature_lines
from terrafold.sources.parts import existing_contents, existing_ids, read_parts, written_ids

#: Message of a run whose values all have output already.
NOT_READ = "input not read: every value has output"


def feature_records(
    lines: DataFrame,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    wanted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Records of every (feature, key) pair that is wanted.

    Cheap tests come first: the text must mention a key before it is parsed,
    and a value must be wanted before its geometry is converted. No shuffle.
    """
    wanted = wanted if wanted is not None else wanted_values(tags, subtags)
    lines = lines.filter(mentions_keys(F.col("value"), list(wanted)))
    features = choose_features(lines, lambda props: chosen_values(props, wanted))
    pairs = features.select("*", F.explode("chosen").alias("category", "sub_cat"))
    return project_features(pairs.drop("chosen"))


def extract(
    lines: DataFrame,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    existing: DataFrame | None = None,
    keep_unidentified: bool = False,
) -> DataFrame:
    """New, clean records of the feature lines."""
    return merge(
        feature_records(lines, tags, subtags), existing, keep_unidentified=keep_unidentified
    )


def _if_present(read) -> DataFrame | None:
    """The DataFrame, or None where its path does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def earlier_output(
    spark: SparkSession, output: str, formats: Sequence[str] = ("parquet",)
) -> DataFrame | None:
    """Keys of what a former run wrote, if any.

    Parquet is asked first, then the other formats of this run.
    """
    for name in dict.fromkeys(["parquet", *formats]):
        read = written_ids if name == "geojson" else existing_ids
        found = _if_present(lambda: read(spark, f"{output}/{name}", MERGE_KEYS))
        if found is not None:
            return found
    return None


def outputs_by_format(
    spark: SparkSession, output: str, config: RunConfig
) -> dict[str, DataFrame | None]:
    """Keys that each format of this run already holds; None where it has no output."""

    def read(name: str):
        path = f"{output}/{name}"
        if name == "geojson":
            return written_ids(spark, path, MERGE_KEYS)
        if name == "parquet" and config.keep_unidentified:
            return existing_contents(spark, path, MERGE_KEYS)
        return existing_ids(spark, path, MERGE_KEYS)

    return {name: _if_present(lambda: read(name)) for name in config.formats}


def write_new(
    records: DataFrame, output: str, config: RunConfig
) -> list[tuple[str, str, str]]:
    """Merge records and write to each format what that format does not hold yet.

    What every format holds is left out before geometries are judged; the rest
    is compared with each format on its own, so one that was added later, or
    that failed, is filled up.
    """
    earlier = outputs_by_format(records.sparkSession, output, config)
    everywhere = None
    if earlier and all(found is not None for found in earlier.values()):
        first, *others = earlier.values()
        everywhere = first
        for found in others:
            everywhere = everywhere.join(unique_keys(found, MERGE_KEYS), MERGE_KEYS, "left_semi")
    merged = merge(records, everywhere, keep_unidentified=config.keep_unidentified)

    def new_for(name: str, rows: DataFrame) -> DataFrame:
        if earlier[name] is None or len(earlier) == 1:
            return rows
        return new_only(rows, earlier[name], MERGE_KEYS, keep_unidentified=config.keep_unidentified)

    return write_all(merged, output, config.formats, config.table, new_for)


def remaining_values(
    spark: SparkSession, output: str, config: RunConfig
) -> dict[str, list[str]]:
    """Values still to extract for each key, in the form of ``wanted_values``.

    Named values are always extracted; otherwise the skip mode decides.
    "incremental" extracts all: rows written before are left out one by one.
    """
    if config.subtags is not None or config.skip_mode == "incremental":
        return wanted_values(config.tags, config.subtags)
    listing = _if_present(lambda: list_outputs(spark, output))
    if listing is None:
        return wanted_values(config.tags)
    expected = expected_outputs(listing, config.tags)
    left = plan_run(expected, manifest(listing), config.formats, config.skip_mode)
    values: dict[str, list[str]] = {}
    # at most one row per whitelist entry
    for row in left.collect():
        values.setdefault(row["category"], [])
        if row["sub_cat"] is not None:
            values[row["category"]].append(row["sub_cat"])
    return values


def run(
    spark: SparkSession, source: str | Sequence[str], output: str, config: RunConfig
) -> list[tuple[str, str, str]]:
    """Extract ``source`` into ``output``; (format, status, message) per format.

    Values whose output exists are skipped but in the incremental mode: their
    status is "skipped", or the message counts them, and new input for them is
    not read. Rows that a format already holds are not written to it again.
    """
    wanted = remaining_values(spark, output, config)
    if not wanted:
        return [(name, "skipped", NOT_READ) for name in config.formats]
    lines = read_feature_lines(
        spark, source, max_bytes=config.max_line_bytes, min_file_bytes=config.min_file_bytes
    )
    return write_new(feature_records(lines, list(wanted), wanted=wanted), output, config)


def run_elements(
    nodes: DataFrame, ways: DataFrame, relations: DataFrame, output: str, config: RunConfig, **options
) -> list[tuple[str, str, str]]:
    """Extract element tables into ``output``, as :func:`run` does feature lines."""
    wanted = remaining_values(nodes.sparkSession, output, config)
    if not wanted:
        return [(name, "skipped", NOT_READ) for name in config.formats]
    records = element_records(nodes, ways, relations, list(wanted), wanted=wanted, **options)
    return write_new(records, output, config)


def run_staged(
    spark: SparkSession, parts_path: str, output: str, config: RunConfig
) -> list[tuple[str, str, str]]:
    """Merge staged parts into ``output``; parts of values not asked for stay behind."""
    staged = drop_stale(read_parts(spark, json_path=parts_path), config.subtags)
    return write_new(staged.filter(F.col("category").isin(*config.tags)), output, config)


def input_counts(spark: SparkSession, source: str | Sequence[str], config: RunConfig) -> DataFrame:
    """(source, reason, lines): lines that a run over ``source`` leaves out, and why."""
    lines = read_feature_lines(spark, source, config.max_line_bytes, config.min_file_bytes)
    long = oversize_report(spark, source, config.max_line_bytes)
    return rejected_counts(lines).unionByName(
        long.select("source", F.lit("oversize").alias("reason"), F.col("oversize_lines").alias("lines"))
    )
