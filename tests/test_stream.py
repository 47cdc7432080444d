"""Incremental ingest: equal to the batch job, resumable, idempotent."""

import json
import random

import pandas as pd
from pyspark.sql import functions as F

from checks import adapters as A
from terrafold.plans.extract import extract
from terrafold.sources.lines import read_feature_lines
from terrafold.streaming import ingest


def _rows(df):
    columns = sorted(set(df.columns) - {"source"})
    return sorted(tuple(map(str, r)) for r in df.select(*columns).collect())


def test_stream_equals_batch(spark, sf, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    A.lines_with_noise(spark, sf).select("value").repartition(3).write.text(source)
    records = ingest.stream_features(spark, source, A.EVENT_TAGS, max_files_per_trigger=1)
    ingest.stream_upsert(records, out, str(tmp_path / "check")).awaitTermination()
    batch = extract(read_feature_lines(spark, source), A.EVENT_TAGS)
    keys = ["category", "osm_id", "osm_type", "src_type"]
    streamed = spark.read.parquet(f"{out}/parquet").select(*keys)
    assert _rows(streamed) == _rows(batch.select(*keys))


def test_replay_and_restart_add_nothing(spark, sf, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    A.lines_with_copies(spark, sf).select("value").repartition(2).write.text(source)
    counts = []
    for checkpoint in ["first", "first", "second"]:
        records = ingest.stream_features(spark, source, A.EVENT_TAGS)
        ingest.stream_upsert(records, out, str(tmp_path / checkpoint)).awaitTermination()
        counts.append(spark.read.parquet(f"{out}/parquet").count())
    assert counts[0] > 0 and len(set(counts)) == 1


def test_long_lines_never_enter_the_stream(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    line = lambda i, pad: json.dumps(
        {"geometry": {"type": "Point", "coordinates": [1, 2]},
         "properties": {"power": "tower", "@id": i, "name": "x" * pad}}
    )
    (source / "a").write_text(line(1, 10) + "\n" + line(2, 500) + "\n")
    records = ingest.stream_features(spark, str(source), ["power"], max_bytes=300)
    ingest.stream_to_parquet(records, out, str(tmp_path / "check")).awaitTermination()
    assert [r["osm_id"] for r in spark.read.parquet(out).collect()] == [1]


class _Held:
    """State of one slot, as the stream gives it to its processor."""

    def __init__(self):
        self.value, self.map, self.read, self.written = None, {}, set(), set()

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def getValue(self, key):
        self.read.add(key)
        return self.map.get(key)

    def updateValue(self, key, value):
        self.written.add(key)
        self.map[key] = value

    def getValueState(self, name, schema, ttl=None):
        return self

    def getMapState(self, name, key, value, ttl=None):
        return self

    def getCurrentProcessingTimeInMs(self):
        return self.now


def _late(seen, batch, now, ttl):
    """Brute force: (key, version, text) of the rows that are accepted, key by key."""
    accepted = []
    for key in dict.fromkeys(r[0] for r in batch):
        rows = sorted((r for r in batch if r[0] == key), key=lambda r: (-_number(r[1]), "|".join(map(str, r))))
        best = _number(rows[0][1])
        if key not in seen or seen[key][1] + ttl <= now or best > seen[key][0]:
            seen[key] = (best, now)
            accepted.append(rows[0])
    return accepted


def _number(version):
    try:
        return int(float(version)) if "." in version else int(version)
    except (TypeError, ValueError):
        return -1


def test_slots_of_many_keys_equal_a_state_for_each_key():
    """Versions over many batches, pages split as keys come and keys ending by time."""
    rng = random.Random(4)
    ttl = 50
    processor = ingest._latest_processor(["k", "version", "name"], ttl, 16)
    held = _Held()
    processor.init(held)
    seen = {}
    versions = ["1", "2", "3", "10", "2.5", "zzz", None, str(2**60), str(2**60 + 1), "-4"]
    for step in range(40):
        held.now, held.read, held.written = step * 7, set(), set()
        few = step in (20, 30)
        batch = [(rng.randrange(40 * step + 5), rng.choice(versions), rng.choice("abc")) for _ in range(2 if few else 150)]
        rows = pd.DataFrame(batch, columns=["k", "version", "name"])
        rows["key_text"], rows["key_spot"] = rows["k"].map(str), rows["k"] * 0x9E3779B97F4A7 % 2**40
        got = pd.concat(processor.handleInputRows((0,), iter([rows[:70], rows[70:]] if not few else [rows]), held))
        assert sorted(map(str, got[["k", "version", "name"]].itertuples(index=False, name=None))) == sorted(map(str, batch))
        accepted = got[~got["late"]][["k", "version", "name"]].itertuples(index=False, name=None)
        assert sorted(map(str, accepted)) == sorted(map(str, _late(seen, batch, held.now, ttl)))
        if few:  # a page for each row at most, of many
            assert len(held.read) <= 2 and len(held.map) > 16
    assert held.value[0] >= 4
    held.now += ttl
    rows = rows.assign(version="0")
    assert not pd.concat(processor.handleInputRows((0,), iter([rows.drop_duplicates("k")]), held))["late"].any()


def test_the_latest_are_found_by_slots(spark, tmp_path):
    """Keys, nulls among them, share a few groups; before, each was a group and a row of state of its own."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(3000).selectExpr("nullif(id % 1500, 7) AS k", "if(id % 3 = 0, NULL, 'b') AS side", "string(id div 1500) AS version")
    schema = "k long, side string, version string"
    keys = ["k", "side"]
    groups = []
    for part in (rows, rows.withColumn("version", F.expr("if(k % 2 = 0, '5', '0')"))):
        part.repartition(3).write.mode("append").json(source)
        latest = ingest.stream_latest(spark.readStream.schema(schema).json(source), keys, slots=4)
        run = ingest.stream_to_parquet(latest, out, str(tmp_path / "check"))
        run.awaitTermination()
        groups.append(run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    found = spark.read.parquet(out)
    assert found.count() == 6000 and groups[-1] < 100
    wanted = rows.groupBy(*keys).agg(F.max("version").alias("v")).select(*keys, F.expr("if(k % 2 = 0, 5, int(v))").alias("v"))
    best = found.filter("NOT late").groupBy(*keys).agg(F.max(F.col("version").cast("int")).alias("v"))
    assert _rows(best) == _rows(wanted)
    assert found.filter("NOT late").count() == wanted.count() + wanted.filter("v = 5").count()
