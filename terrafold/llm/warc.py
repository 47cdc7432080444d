"""Web archives as a chunked record table.

Writing: a payload becomes one row for each chunk; the first chunk is the
response record, each further one a continuation record of the archive format
(WARC-Segment-Number, WARC-Segment-Origin-ID), so no step holds more than a
chunk beside the row it came from. Among equal payloads one is stored and the
others become revisit records that refer to it. A chunk also ends within any
text that looks like the start of a record, so that starts of records part an
archive safely. Spark's text writer puts the bytes into compressed files.

Reading: the files give one row a record; chunks of a record stream past in
order, and each row carries the digest and length of the payload up to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK = 1 << 20
VERSION = "WARC/1.1\r\n"
#: Payloads below it are stored each time (bytes).
LEAST_SHARED = 1000

CHUNKS = """record_id string, chunk int, last boolean, record_type string, refers_to string, uri string,
 payload_bytes long, payload_digest string, sound boolean, block binary"""


def with_originals(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Rows (record_id, uri, payload) with the record their payload is stored in.

    ``refers_to`` is null where a row stores its own payload.
    """
    rows = pages.withColumns({"payload_bytes": F.octet_length("payload"), "same": F.sha2(F.col("payload"), 256)})
    shared = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("same").alias("of"), F.col("payload_bytes").alias("bytes"))
        .agg(F.max("record_id").alias("original"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
    )
    met = rows.join(shared, (F.col("same") == F.col("of")) & (F.col("payload_bytes") == F.col("bytes")), "left")
    refers = F.when(~F.col("original").eqNullSafe(F.col("record_id")), F.col("original"))
    return met.select("record_id", "uri", "payload", "payload_bytes", refers.alias("refers_to"))


def _urn(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit("<urn:record:"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))


def chunk_rows(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(…, n, block, last): a row for each chunk of a payload; none for a revisit's."""
    pieces = F.split(F.col("payload"), r"(?<=WARC/1)(?=\.1\r\n)", -1)
    cut = F.flatten(
        F.transform(
            pieces,
            lambda p: F.transform(
                F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length(p) - 1, F.lit(0)) / chunk).cast("int")),
                lambda i: p.cast("binary").substr(i * chunk + 1, F.lit(chunk)),
            ),
        )
    )
    blocks = F.when(F.col("refers_to").isNull(), cut).otherwise(F.array(F.lit(b"")))
    return (
        rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
        .withColumn("blocks", blocks)
        .select("record_id", "uri", "refers_to", "payload_bytes", "digest", F.size("blocks").alias("n_chunks"), F.posexplode("blocks").alias("n", "block"))
    )


def write_archives(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", chunk: int = CHUNK) -> None:
    """Write rows (record_id, uri, payload text) as compressed archives below ``path``.

    A null payload is the empty one. Rows without id, and rows that repeat an id,
    are written as records of that id; equal payloads refer to the largest id,
    and rows that carry this id store theirs. An empty table gives no record.
    """
    rows = pages.select("record_id", F.regexp_replace("uri", r"[\r\n]", "").alias("uri"), F.coalesce("payload", F.lit("")).alias("payload"))
    chunks = chunk_rows(with_originals(rows), chunk)
    first, last = F.col("n") == 0, F.col("n") == F.col("n_chunks") - 1
    parts, revisit = F.col("n_chunks") > 1, F.col("refers_to").isNotNull()
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    own = F.when(first, _urn("record_id")).otherwise(_urn(F.concat_ws("/", F.col("record_id").cast("string"), F.col("n").cast("string"))))
    header = F.concat_ws(
        "\r\n",
        F.lit(VERSION.strip()),
        field("WARC-Type", kind),
        field("WARC-Record-ID", own),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("uri")),
        F.when(first, field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))),
        F.when(first, field("X-Payload-Length", F.col("payload_bytes"))),
        F.when(first & revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(first & revisit, field("WARC-Refers-To", _urn("refers_to"))),
        F.when(parts, field("WARC-Segment-Number", F.col("n") + 1)),
        F.when(~first, field("WARC-Segment-Origin-ID", _urn("record_id"))),
        F.when(parts & last, field("WARC-Segment-Total-Length", F.col("payload_bytes"))),
        field("Content-Length", F.octet_length("block")),
    )
    record = F.concat(header.cast("binary"), F.lit(b"\r\n\r\n"), F.col("block"), F.lit(b"\r\n"))
    chunks.select(record.cast("string").alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """The chunked record table of the archives below ``path``.

    A row per record: the id of the payload's first record, the chunk's number
    from 0, whether it is the last, type and reference of the first record, and
    length and SHA-1 of the payload so far (a revisit's are those its header
    states). ``sound`` is false where a block is shorter than its stated length,
    a chunk does not follow the one before, or the digest at the end differs
    from the stated one. keep_blocks: also return the bytes.
    """
    lines = spark.read.option("lineSep", VERSION).text(path).where(F.col("value") != "")
    head = F.substring_index("value", "\r\n\r\n", 1)
    get = lambda name: F.regexp_extract("head", rf"(?im)^{name}: *(.*?)\r?$", 1)
    rows = (
        lines.select(head.alias("head"), "value")
        .select(
            get("WARC-Type").alias("type"),
            get("WARC-Record-ID").alias("id"),
            get("WARC-Segment-Origin-ID").alias("origin"),
            get("WARC-Segment-Number").alias("segment"),
            get("WARC-Segment-Total-Length").alias("total"),
            get("WARC-Refers-To").alias("refers"),
            get("WARC-Target-URI").alias("uri"),
            get("WARC-Payload-Digest").alias("digest"),
            get("X-Payload-Length").alias("stated"),
            get("Content-Length").alias("length"),
            F.col("value").cast("binary").substr(F.octet_length("head") + F.lit(5), F.octet_length("value")).alias("rest"),
        )
        .withColumns({c: F.col(c).try_cast("long") for c in ("segment", "total", "stated", "length")})
        .withColumn("block", F.col("rest").substr(F.lit(1), F.coalesce(F.col("length"), F.lit(0)).cast("int")))
        .drop("rest")
    )

    def run(batches):
        import hashlib

        import pyarrow as pa

        bare = lambda urn: urn.removeprefix("<urn:record:").removesuffix(">")
        open_id, state, size, at, first = None, None, 0, 0, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                block, sound = r["block"] or b"", len(r["block"] or b"") == (r["length"] or 0)
                if r["type"] == "continuation":
                    at += 1
                    sound = sound and r["origin"] == open_id and r["segment"] == at + 1
                else:
                    open_id, state, size, at, first = r["id"], hashlib.sha1(), 0, 0, r
                if state is None:  # a continuation without its start
                    state, first = hashlib.sha1(), r
                state.update(block)
                size += len(block)
                last = r["segment"] is None or r["total"] is not None
                digest, stated = state.hexdigest(), first["digest"].removeprefix("sha1:")
                revisit = first["type"] == "revisit"
                if last and not revisit:
                    sound = sound and stated in ("", digest) and r["total"] in (None, size)
                out.append(
                    {
                        "record_id": bare(open_id or r["origin"]),
                        "chunk": at,
                        "last": last,
                        "record_type": first["type"],
                        "refers_to": bare(first["refers"]) or None,
                        "uri": first["uri"],
                        "payload_bytes": first["stated"] if revisit else size,
                        "payload_digest": stated if revisit else digest,
                        "sound": sound,
                        "block": block if keep_blocks else None,
                    }
                )
            kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
            names = [c.split()[0] for c in CHUNKS.split(",")]
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], k) for n, k in zip(names, kinds)], names)

    return rows.mapInArrow(run, CHUNKS)
