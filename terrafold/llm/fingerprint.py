"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending list of the k smallest distinct hashes of a text's
five-word shingles. Sketches of parts merge into the sketch of the whole; two
sketches estimate resemblance, containment and the number of distinct shingles.
Everything is Spark expressions on rows; only neighbours of documents need a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terrafold.llm.common import checkpointed, text_or_empty

K, SHINGLE = 128, 5
#: Ids that share a place when documents meet their neighbours: 2 ** it.
NEIGHBOURS = 8


def with_sketch(frame: DataFrame, text: str, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """The frame with the sketch of a text column, an array of long.

    Words are small letters between white space. Fewer words than a shingle make
    one shingle; no word, an empty sketch. Equal texts have equal sketches.
    """
    words, own = f"{name}_words", f"{name}_hashes"
    n = F.size(words)
    frame = frame.withColumn(words, F.array_remove(F.split(F.lower(F.col(text)), r"[\x20\t\n\x0B\f\r]+", -1), ""))
    frame = frame.withColumn(own, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    shingles = F.transform(
        F.slice(own, F.lit(1), F.greatest(n - (shingle - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *(F.get(own, i + j) for j in range(1, shingle))),
    )
    few = F.when(n > 0, F.array(F.xxhash64(F.col(own)))).otherwise(F.array().cast("array<long>"))
    hashes = F.when(n >= shingle, shingles).otherwise(few)
    return frame.withColumn(name, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(words, own)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(frame: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """(key, sketch): one sketch for each key, its hashes cut to k before they move."""
    hashes = frame.select(key, F.explode(sketch).alias("hash")).distinct()
    smallest = Window.partitionBy(key).orderBy("hash")
    kept = hashes.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= k)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list("hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated shared part of all distinct shingles, 0 to 1; two empty texts are alike."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    top = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's shingles that b holds, 0 to 1; an empty text is in any."""
    j = resemblance(a, b, k)
    shared = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as one string: 16 hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _before(places: DataFrame) -> DataFrame:
    """(place, earlier): each place's predecessor; the first one's is the last."""
    ranged = places.repartitionByRange("place").withColumn("part", F.spark_partition_id())
    ranged = checkpointed(ranged)
    order = Window.orderBy("part")  # a row per partition
    ends = ranged.groupBy("part").agg(F.max("place").alias("highest")).withColumn("before", F.lag("highest").over(order))
    ends = ends.withColumn("before", F.coalesce("before", F.max("highest").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    inside = Window.partitionBy("part").orderBy("place")
    placed = ranged.withColumn("earlier", F.lag("place").over(inside))
    first = ends.select(F.col("part").alias("of"), "before")
    return placed.join(first, F.col("part") == F.col("of")).select("place", F.coalesce("earlier", "before").alias("earlier"))


def with_next_text(docs: DataFrame) -> DataFrame:
    """(place, ghost, doc_id, text) so that a window over the place sees the next row.

    Documents go by ascending doc_id to places of neighbouring ids. Each place
    also gets, as a ghost, the first document of the next place that has one,
    the last place that of the first. So whole texts move once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("place", F.coalesce(F.shiftright("doc_id", NEIGHBOURS), F.lit(-(1 << 62))))
    earlier = _before(rows.select("place").distinct())
    order = Window.partitionBy("place").orderBy("doc_id", "text")
    firsts = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == 1).drop("rank")
    ghosts = firsts.join(earlier, "place").select(F.col("earlier").alias("place"), F.lit(1).alias("ghost"), "doc_id", "text")
    return rows.select("place", F.lit(0).alias("ghost"), "doc_id", "text").unionByName(ghosts)


def with_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Documents, their edited texts, and sketches of both and of the next document.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many (or all) of the next document. Documents go by doc_id, rows without
    id first, rows of one id by their text; after the last comes the first.
    Null texts are empty. A single document is its own next one; an empty table
    gives no row. Other columns are left behind, whatever their names.
    """
    following = Window.partitionBy("place").orderBy("ghost", "doc_id", "text")
    rows = with_next_text(docs).withColumn("next_text", F.lead("text").over(following))
    rows = with_sketch(rows, "text", "sketch", k).withColumn("next_sketch", F.lead("sketch").over(following))
    rows = rows.where("ghost = 0").withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half), F.col("next_text").substr(F.lit(1), half)
    )
    rows = rows.withColumn("edited", edited).drop("next_text")
    return with_sketch(rows, "edited", "edited_sketch", k).drop("place", "ghost")
