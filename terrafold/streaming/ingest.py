"""Feature files as a stream: the batch projection on newly arrived files."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from terrafold.plans.extract import earlier_output, feature_records
from terrafold.plans.merge import MERGE_KEYS, merge
from terrafold.operators.assemble import stored
from terrafold.operators.relational import unique_keys
from terrafold.schema import MAX_LINE_BYTES
from terrafold.sinks.store import BUCKET_ROWS, Content, Store
from terrafold.sinks.writers import geojson_value, write_parquet
from terrafold.sources.lines import clean_lines, line_reader


#: The state store whose keys can end one by one.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_lines(
    spark: SparkSession,
    path: str,
    max_bytes: int = MAX_LINE_BYTES,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Feature lines of the files in a folder, each file once.

    The two trigger options bound a micro-batch by files or by bytes.
    """
    reader = line_reader(spark.readStream, max_bytes)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return clean_lines(reader.load(path), max_bytes)


def stream_features(
    spark: SparkSession,
    path: str,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    **limits,
) -> DataFrame:
    """Feature records of a stream; the plan is that of the batch job."""
    return feature_records(stream_lines(spark, path, **limits), tags, subtags)


def stream_dedupe(records: DataFrame, keys: Sequence[str] = MERGE_KEYS) -> DataFrame:
    """First record to arrive of each key.

    Keeps every key seen as state, partitioned by key. Runs without an end
    should use :func:`stream_upsert`, which keeps none.
    """
    return records.dropDuplicates(list(keys))


def stream_upsert(
    records: DataFrame,
    output: str,
    checkpoint: str,
    keys: Sequence[str] = MERGE_KEYS,
) -> StreamingQuery:
    """Append what is new to Parquet output, then stop when caught up.

    Every micro-batch is merged against the stored keys of its categories, whose
    folders alone are read, so a batch that runs again after a failure, or a full
    replay, adds nothing twice. Stored rows are not replaced. A later start with
    the same checkpoint goes on after the last finished batch.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        stored = earlier_output(batch.sparkSession, output)
        if stored is not None:
            # as many categories as there are tag keys
            held = [row["category"] for row in batch.select("category").distinct().collect()]
            stored = stored.filter(F.col("category").isin(*held))
        write_parquet(merge(batch, stored, keys), f"{output}/parquet")

    return (
        records.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_to_parquet(records: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to plain Parquet files, then stop when caught up."""
    return (
        records.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _version() -> Column:
    return F.coalesce(F.col("version").try_cast("bigint"), F.lit(-1))


def merge_versions(store: Store, batch: DataFrame, keys: Sequence[str] = MERGE_KEYS, notes: str = "") -> int:
    """Take records into a store: new keys are added, higher versions replace; rows written.

    The stored keys and versions stand in a narrow table of their own, of which
    only the batch's buckets are read. Of the records, only buckets with a
    change are read and written, and with them their GeoJSON form; keys, records
    and GeoJSON appear in one commit. An equal or lower version changes nothing,
    and a version that is no number is the lowest, so a batch that comes again
    writes nothing.
    """
    keys = list(keys)
    rows = stored(merge(batch, keys=keys), "batch")
    sidecar = store.read("keys", store.buckets_of("keys", rows, keys))
    fresh = rows
    if sidecar is not None:
        held = sidecar.withColumnRenamed("held_version", "_held")
        fresh = rows.join(held, keys, "left").filter(F.col("_held").isNull() | (_version() > F.col("_held"))).select(*rows.columns)
        fresh = stored(fresh, "fresh")
    written = fresh.count()
    if not written:
        return 0
    touched = store.buckets_of("records", fresh, keys)
    own = unique_keys(fresh, keys)

    def replaced(name: str, new: DataFrame) -> DataFrame:
        before = store.read(name, touched)
        return new if before is None else before.join(own, keys, "left_anti").select(*new.columns).unionByName(new)

    records = replaced("records", fresh)
    geojson = lambda placed: placed.select("d", "p", geojson_value(fresh.columns).alias("value"))
    # both tables hold the same keys, so their buckets are the same
    store.commit(
        {
            "records": Content(records, keys, touched, {"geojson": ("text", geojson)}),
            "keys": Content(replaced("keys", fresh.select(*keys, _version().alias("held_version"))), keys, touched, {}),
        },
        notes,
    )
    return written


def stream_versions(
    records: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str] = MERGE_KEYS,
    bucket_rows: int = BUCKET_ROWS,
    keep: int | None = None,
) -> StreamingQuery:
    """Upsert the stream into a store of versions, then stop when caught up.

    Each micro-batch is one commit of :func:`merge_versions`; the number of the
    last batch is noted with it, so a batch whose commit came through is not
    looked at again after a failure. A replay from the start changes nothing.
    ``keep`` removes what older versions than that many hold; readers of those
    would lose them.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, root, bucket_rows)
        done = json.loads(store.notes() or "{}")
        if done.get(checkpoint, -1) < batch_id:
            merge_versions(store, batch, keys, json.dumps(done | {checkpoint: batch_id}))
            if keep:
                store.vacuum(keep)

    return (
        records.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Groups that the keys of a stream are dealt into by hash; each is a state of its own.
SLOTS = 1024
#: Keys of a page of state beyond which the pages of its slot are halved.
PAGE_KEYS = 1000
#: Key columns as text that differs where the keys do, nulls among them.
_KEY_TEXT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def stream_latest(
    records: DataFrame, keys: Sequence[str] = MERGE_KEYS, ttl: str = "7 days", slots: int = SLOTS
) -> DataFrame:
    """Each record that is the first of its key or a higher version, with ``late``.

    The state is one number a key, the highest version seen, and it ends when
    its key has not been written for ``ttl``: its size is bounded by the keys
    that come in twice that time, whatever the length of the stream. Copies and
    lower versions come out as late rows, so that they can be counted, and
    change no state. Of the versions of a key in one micro-batch the highest is
    kept (ties: by content); a version that is no number is the lowest. A copy
    that comes after its key's state has ended counts as new;
    :func:`stream_versions` has no such limit.

    Keys are dealt into ``slots`` by hash, and a micro-batch's rows of a slot are
    compared at once. A slot's state lies in pages of some hundred keys, of which
    only those of the rows are read and written, so a batch costs by its rows,
    however many keys are held. No more tasks than slots have work.

    The session's state store becomes the one that can drop single keys, and
    its streams stop when no input is left, as state with an end would have
    them look again for ever.
    """
    from pyspark.sql import types as T

    settings = records.sparkSession.conf
    settings.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    settings.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    schema = T.StructType([*records.schema.fields, T.StructField("late", T.BooleanType())])
    text = F.to_json(F.struct(*[F.col(k) for k in keys]), _KEY_TEXT)
    placed = records.withColumn("key_text", text).withColumn("key_hash", F.xxhash64("key_text"))
    placed = placed.withColumn("key_slot", F.pmod("key_hash", F.lit(slots)).cast("int"))
    placed = placed.withColumn("key_spot", F.shiftrightunsigned("key_hash", 24)).drop("key_hash")
    return placed.groupBy("key_slot").transformWithStateInPandas(
        statefulProcessor=_latest_processor(list(records.columns), _milliseconds(ttl), PAGE_KEYS),
        outputStructType=schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


def _milliseconds(duration: str) -> int:
    number, unit = duration.split()
    return int(number) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def _latest_processor(columns: list[str], ttl: int, page_keys: int):
    """The processor, made here so that it travels with the query by value."""
    from pyspark.sql.streaming import StatefulProcessor

    def whole(version):
        """Versions as numbers; what is none is -1."""
        import numpy as np
        import pandas as pd

        number = pd.to_numeric(version, errors="coerce")
        found = number.where(np.isfinite(number), -1).astype("int64").to_numpy().copy()
        if number.dtype.kind == "f":  # a float among them rounds the large ones
            for place in np.flatnonzero(np.isfinite(number) & (number.abs() >= 2**53)):
                found[place] = pd.to_numeric(version.iloc[place : place + 1], errors="coerce").astype("int64").iloc[0]
        return found

    def leaders(table, number, code, count):
        """(highest version, place of the row that has it) of each key; ties by content."""
        import numpy as np

        best = np.full(count, np.iinfo("int64").min)
        np.maximum.at(best, code, number)
        top = np.flatnonzero(number == best[code])
        place = np.full(count, -1)
        place[code[top[::-1]]] = top[::-1]
        tied = top[np.bincount(code[top], minlength=count)[code[top]] > 1]
        if len(tied):
            texts = ["|".join(row) for row in zip(*(table[c].iloc[tied].astype(str) for c in columns))]
            order = sorted(range(len(tied)), key=texts.__getitem__, reverse=True)
            place[code[tied[order]]] = tied[order]
        return best, place

    class Latest(StatefulProcessor):
        def init(self, handle):
            self.depth = handle.getValueState("depth", "depth int")
            self.pages = handle.getMapState("pages", "page long", "seen string", ttl)

        def _page(self, number: int, now: int) -> dict:
            """Key -> [version, when it was written, place of the key] of a page, without those that ended."""
            held = self.pages.getValue((number,))
            seen = json.loads(held[0]) if held else {}
            return {k: v for k, v in seen.items() if v[1] + ttl > now}

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            table = pd.concat(list(rows), ignore_index=True)
            code, unique = pd.factorize(table["key_text"])
            spots = np.empty(len(unique), "int64")
            spots[code] = table["key_spot"].to_numpy()
            best, place = leaders(table, whole(table["version"]), code, len(unique))
            now = timerValues.getCurrentProcessingTimeInMs()
            before = self.depth.get()
            depth = before[0] if before is not None else 0
            pages, changed, late = {}, set(), np.ones(len(table), bool)
            numbers = (spots & ((1 << depth) - 1)).tolist()
            for text, number, spot, version, leader in zip(unique, numbers, spots.tolist(), best.tolist(), place.tolist()):
                if number not in pages:
                    pages[number] = self._page(number, now)
                seen = pages[number].get(text)
                if seen is None or version > seen[0]:
                    pages[number][text] = [version, now, spot]
                    changed.add(number)
                    late[leader] = False
            deeper = depth
            while max(map(len, pages.values())) > page_keys and deeper < 32:
                pages |= {n: self._page(n, now) for n in range(1 << depth) if deeper == depth and n not in pages}
                deeper += 1
                halves = {n: {} for n in range(1 << deeper)}
                for page in pages.values():
                    for text, seen in page.items():
                        halves[seen[2] & ((1 << deeper) - 1)][text] = seen
                pages = halves
                changed = set(pages)
            if deeper != depth or before is None:
                self.depth.update((deeper,))
            for number in changed:
                self.pages.updateValue((number,), (json.dumps(pages[number]),))
            yield table[columns].assign(late=late)

        def close(self):
            pass

    return Latest()
