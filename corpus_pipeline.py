"""Documents to packed training sequences, in five stages.

Quality, SimHash near duplicates, repeats, secrets, packing: each stage works on
all that the one before kept, and its decisions take effect. ``run`` applies
them in turn, each result written to the shared folder and read again, so that
a lost executor costs a read. No SQL states a stage; tests compare each with
brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import packing, quality, repeats, secret_scan, simhash
from terrafold.llm.tokens import default_path
from terrafold.llm.common import with_length
from terrafold.session import drop_path, scratch_path

#: Documents that score below it go.
LEAST_QUALITY = 0.3
REDACTED = "[SECRET]"
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more, with all their columns.

    The trees learn from the labels of documents that are not held out. Null
    and empty texts have the score of empty statistics; repeated rows fare
    alike; an empty table gives none.
    """
    trees = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept(docs, trees, LEAST_QUALITY)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (shingles of three words, two bits): the one of least id.

    Null, empty and blank texts make one group with what is near them. Of rows
    that repeat an id or have none, whole rows are compared, so texts that
    differ stay where their groups do. An empty table gives none; other columns
    stay, whatever their names.
    """
    return simhash.first_of_groups(docs, shingle=3, distance=2)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has.

    A run that ends within a character leaves the whole character. Documents
    stay, with the text that remains and its length; null texts stay null; rows
    without id neither remove nor lose anything; an empty table gives none.
    """
    return with_length(repeats.without_repeats(docs, length=50))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by a mark, and their length; overlapping secrets are one.

    Null and empty texts, repeated rows and other columns stay as they are; an
    empty table gives none.
    """
    return with_length(secret_scan.redacted(docs, REDACTED))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids that hold every document.

    A null or empty text holds the end alone; repeated rows and rows without id
    are packed too; an empty table gives no piece; other columns are left behind.
    """
    return packing.pack(docs, default_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("repeats", remove_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents below ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
