"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrafold.llm import bpe, codes, fingerprint, packing, pii, quality, repeats, runs, secret_scan, simhash, token_counts, topk, warc
from terrafold.llm.common import text_or_empty
from terrafold.llm.tokens import default_path
from terrafold.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's ids in sequences of 4096, with a checksum for each piece."""
    pieces = packing.pack(_documents(spark, sf), default_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op6_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    return bpe.encode(_documents(spark, sf), default_path()).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector with all others."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return topk.top_k(vectors, F.col("id") % 20 == 0, k=20, scale=64)


@query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint and the component of documents it belongs to."""
    found = simhash.near_duplicates(_documents(spark, sf), shingle=3, distance=2)
    return found.withColumn("fingerprint", simhash.as_hex(F.col("fingerprint")))


@query
def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to archives and read back, chunk by chunk."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages.select(F.col("page_id").alias("record_id"), F.col("url").alias("uri"), F.col("html").alias("payload")), path)
    records = warc.read_chunks(spark, path, keep_blocks=False).where("last")
    return records.select(
        F.col("record_id").try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"),
        "sound",
    )


@query
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's quality score, learnt without the held-out fifth."""
    docs = _documents(spark, sf)
    trees = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = quality.score(docs.select("doc_id", "text"), trees)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds, all spans."""
    return pii.digest(pii.find(_documents(spark, sf)), pii.BASE)


@query
def op2_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next document's."""
    rows = fingerprint.with_edits(_documents(spark, sf))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query
def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base kinds, all spans."""
    return pii.digest(secret_scan.find(_documents(spark, sf)), secret_scan.BASE)


@query
def op4_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the 50-byte strings of earlier documents, as a digest."""
    found = repeats.remove_repeats(_documents(spark, sf).select("doc_id", "text"), length=50)
    return found.select(
        "doc_id",
        F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        repeats.n_removed(F.col("removed")).alias("n_removed"),
        F.floor(F.size("removed") / 2).alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words of every document, and the words that remain, as digests."""
    return runs.digest(runs.find(runs.with_planted_runs(_documents(spark, sf))))


@query
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector's 16 codes of 64 entries, its error, and that of its label."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    vectors = vectors.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    coded, books = codes.compress(vectors, parts=16, entries=64, rounds=2, scale=256)
    return codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.sha2(F.lit(codes.listed(books)), 256).alias("codebooks_sha256"),
    )


@query
def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, and whether they are more than 2048."""
    counted = token_counts.count_tokens(_documents(spark, sf), default_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
