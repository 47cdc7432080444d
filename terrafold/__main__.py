"""Command line of the jobs, for ``spark-submit``.

``lines`` extracts feature lines, ``elements`` node, way and relation tables
(folders ``nodes``, ``ways`` and ``relations`` below the input), ``staged``
merges staged parts.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from terrafold.functions.text import parse_subtags
from terrafold.operators.quality import validate_inputs
from terrafold.plans.extract import feature_records, input_counts, run, run_elements, run_staged
from terrafold.plans.profiles import RunConfig, profile_tags
from terrafold.schema import MAX_LINE_BYTES
from terrafold.sources.elements import read_elements
from terrafold.sources.lines import read_feature_lines


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="terrafold", description=__doc__)
    parser.add_argument("--job", choices=["lines", "elements", "staged"], default="lines")
    parser.add_argument("--input", required=True, help="files or folder to read")
    parser.add_argument("--output", required=True, help="output folder")
    parser.add_argument("--tags", default="all", help="profile, 'all', or comma list of keys")
    parser.add_argument("--subtags", help="'all', or comma list of values")
    parser.add_argument("--formats", default="parquet", help="parquet,table,geojson,short")
    parser.add_argument("--skip-mode", choices=["standard", "detailed", "incremental"], default="standard")
    parser.add_argument("--table", help="catalog table of the 'table' format")
    parser.add_argument("--validate", choices=["quick", "deep"], help="report on the input lines first")
    parser.add_argument("--keep-unidentified", action="store_true", help="keep all features without id")
    parser.add_argument("--max-line-bytes", type=int, default=MAX_LINE_BYTES)
    parser.add_argument("--min-file-bytes", type=int, default=0)
    parser.add_argument("--line-keys", default="", help="comma list of keys whose closed ways stay lines")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("terrafold").getOrCreate()
    listed = lambda text: [part.strip() for part in text.split(",") if part.strip()]
    config = RunConfig(
        tags=profile_tags(args.tags),
        formats=listed(args.formats),
        subtags=parse_subtags(args.subtags),
        skip_mode=args.skip_mode,
        table=args.table,
        keep_unidentified=args.keep_unidentified,
        max_line_bytes=args.max_line_bytes,
        min_file_bytes=args.min_file_bytes,
    )
    if args.validate and args.job == "lines":
        if args.validate == "deep":
            lines = read_feature_lines(spark, args.input, config.max_line_bytes, config.min_file_bytes)
            records = feature_records(lines, config.tags, config.subtags)
            # a row per key that was asked for
            validate_inputs(records, config.tags).show(len(config.tags), False)
        for row in input_counts(spark, args.input, config).groupBy("reason").sum("lines").collect():
            print(*row)
    if args.job == "elements":
        tables = [read_elements(spark, f"{args.input}/{kind}s", kind) for kind in ("node", "way", "relation")]
        outcome = run_elements(*tables, args.output, config, line_keys=listed(args.line_keys))
    elif args.job == "staged":
        outcome = run_staged(spark, args.input, args.output, config)
    else:
        outcome = run(spark, args.input, args.output, config)
    for name, status, message in outcome:
        print(name, status, message)


if __name__ == "__main__":
    main()
