"""The whitelist as a dimension table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from terrafold.schema import WHITELIST


def whitelist(
    spark: SparkSession, values: Mapping[str, Sequence[str]] = WHITELIST
) -> DataFrame:
    """(category, sub_cat), one row per allowed pair.

    Made from an Arrow table, so Spark knows its size and decides by that
    whether to broadcast it.
    """
    pairs = [(key, value) for key, allowed in values.items() for value in allowed]
    columns = {"category": [k for k, _ in pairs], "sub_cat": [v for _, v in pairs]}
    schema = pa.schema([("category", pa.string()), ("sub_cat", pa.string())])
    return spark.createDataFrame(pa.table(columns, schema=schema))
