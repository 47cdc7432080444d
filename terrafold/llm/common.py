"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrafold.session import shared_folder


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, over many tasks."""
    name = "terrafold_llm_worker"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def text_or_empty(column: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def checkpointed(frame: DataFrame) -> DataFrame:
    """Rows kept in the shared folder, so that a lost executor costs a read."""
    use_checkpoints(frame.sparkSession)
    return frame.checkpoint()


def use_checkpoints(spark: SparkSession) -> None:
    """Point Spark at the shared folder, unless it already has one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def with_length(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars`` as long as the text, where they have that column."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length(text_or_empty()).cast(docs.schema["n_chars"].dataType)
    return docs.select(*(length.alias(n) if n == "n_chars" else F.col(f"`{n}`") for n in docs.columns))
