"""Versioned buckets: bounded, atomic, split as they grow; changes and streams on top of them."""

import json

import pytest
from pyspark.sql import functions as F

from checks import adapters as A
from terrafold.plans import changes
from terrafold.plans.elements import element_records
from terrafold.sinks.store import Content, Store
from terrafold.streaming import ingest


def content(spark, store, ids, value, name="t"):
    rows = spark.createDataFrame([(i, value) for i in ids], "id long, value string")
    touched = store.buckets_of(name, rows, ["id"])
    before = store.read(name, touched)
    if before is not None:
        rows = before.join(rows, "id", "left_anti").unionByName(rows)
    return {name: Content(rows, ["id"], touched, {"lines": ("text", lambda r: r.select("d", "p", F.concat_ws(":", "id", "value").alias("value")))})}


def test_buckets_split_and_few_are_touched(spark, tmp_path):
    store = Store(spark, str(tmp_path), bucket_rows=100)
    store.commit(content(spark, store, range(1000), "a"))
    entries = [e for e in store.manifest() if e["name"] == "t"]
    assert len(entries) == 16 and sum(e["rows"] for e in entries) == 1000
    store.commit(content(spark, store, [5, 6, 5000], "b"))
    fresh = [e for e in store.manifest() if e["name"] == "t" and e["folder"] != entries[0]["folder"]]
    assert 1 <= len(fresh) <= 3  # all other buckets are the files they were
    found = {r.id: r.value for r in store.read("t").collect()}
    assert found == {**{i: "a" for i in range(1000)}, 5: "b", 6: "b", 5000: "b"}
    text = {r.value for r in store.read("t.lines").collect()}
    assert text == {f"{i}:{v}" for i, v in found.items()}
    assert {r.value for r in store.read("t", version=1).collect()} == {"a"}
    # what has grown beyond its bound is split when it is next written
    store.commit(content(spark, store, range(10_000, 14_000), "c"))
    store.commit(content(spark, store, range(20_000, 24_000), "d"))
    assert len([e for e in store.manifest() if e["name"] == "t"]) > 32
    assert store.read("t").count() == 9001 and store.read("t").select("id").distinct().count() == 9001


def test_a_failed_commit_is_never_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit(content(spark, store, range(10), "a"))
    broken = content(spark, store, range(10), "b")
    bad = Content(broken["t"].rows, ["id"], broken["t"].touched, {"lines": ("text", lambda r: r.select("d", "p", F.raise_error(F.lit("no room")).cast("string").alias("value")))})
    with pytest.raises(Exception, match="no room"):
        store.commit({"t": bad})
    assert store.versions() == [1] and {r.value for r in store.read("t").collect()} == {"a"}
    assert {r.value[-1] for r in store.read("t.lines").collect()} == {"a"}
    store.commit(content(spark, store, range(10), "c"))
    store.vacuum(keep=1)
    assert store.versions() == [2] and {r.value for r in store.read("t").collect()} == {"c"}
    assert len(list((tmp_path / "t").iterdir())) == 1


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.commit(content(spark, store, [1], "a"))
    monkeypatch.setattr(store, "versions", lambda: [])
    with pytest.raises(RuntimeError):
        store._publish([], 1)


def test_empty_table_and_absent_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.read("t") is None and store.notes() == ""
    store.commit({"t": Content(spark.createDataFrame([], "id long, value string"), ["id"], [0], {})}, "noted")
    assert store.read("t").count() == 0 and store.notes() == "noted"


def test_a_small_change_reads_few_buckets(spark, sf, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), bucket_rows=50)
    elements = A.all_elements(spark, sf)
    changes.load_elements(store, *elements)
    total = {n: sum(e["name"] == n for e in store.manifest()) for n in ("node", "way", "node_ways")}
    opened = {}
    plain = Store.read

    def read(self, name, buckets=None, version=None):
        assert buckets is not None
        opened[name] = max(opened.get(name, 0), len(buckets))
        return plain(self, name, buckets, version)

    monkeypatch.setattr(Store, "read", read)
    moved = elements[0].filter("id = 10").selectExpr("id", "lon + 1 AS lon", "lat", "tags", "int(9) AS version", "timestamp", "user", "changeset", "false AS deleted")
    none = [e.filter("false") for e in elements[1:]]
    delta = changes.apply_changes(store, moved, *none, ["power", "highway", "landuse"])
    refers = {r.id for r in elements[1].filter("array_contains(node_refs, 10L)").collect()}
    assert {r.id for r in delta.affected["way"].collect()} == refers and refers
    assert opened["node_ways"] == 1 and opened["way"] <= len(refers) < total["way"]
    assert total["node"] > 4 and total["node_ways"] > 4
    before = element_records(*elements, ["power", "highway", "landuse"])
    after = changes.updated_records(before, delta)
    moved_nodes = elements[0].withColumn("lon", F.when(F.col("id") == 10, F.col("lon") + 1).otherwise(F.col("lon")))
    moved_nodes = moved_nodes.withColumn("version", F.when(F.col("id") == 10, 9).otherwise(F.col("version")).cast("int"))
    wanted = element_records(moved_nodes, *elements[1:], ["power", "highway", "landuse"])
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(after) == key(wanted)


def test_deleted_objects_do_not_come_back(spark, sf, tmp_path):
    store = Store(spark, str(tmp_path))
    elements = A.all_elements(spark, sf)
    changes.load_elements(store, *elements)
    none = [e.filter("false") for e in elements]
    change = lambda version, deleted: elements[0].filter("id = 10").selectExpr(
        "id", "lon", "lat", "tags", f"int({version}) AS version", "timestamp", "user", "changeset", f"{deleted} AS deleted"
    )
    changes.apply_changes(store, change(9, "true"), *none[1:], ["power"])
    delta = changes.apply_changes(store, change(8, "false"), *none[1:], ["power"])
    assert delta.removed.count() == 0 and delta.records.count() == 0


def _line(i, version, x):
    return json.dumps({"geometry": {"type": "Point", "coordinates": [x, 2]}, "properties": {"power": "tower", "@id": i, "@version": version}})


def test_stream_versions_replay_and_batch_cost(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    run = lambda checkpoint: ingest.stream_versions(
        ingest.stream_features(spark, str(source), ["power"]), root, str(tmp_path / checkpoint), bucket_rows=20
    ).awaitTermination()
    (source / "a").write_text("\n".join(_line(i, 1, i % 90) for i in range(1, 400)) + "\n")
    run("one")
    (source / "b").write_text("\n".join([_line(7, 2, 50), _line(8, 0, 51), _line(900, 1, 52), _line(7, 3, 53)]) + "\n")
    asked = {}
    plain = Store.read

    def read(self, name, buckets=None, version=None):
        asked[name] = len(buckets)
        return plain(self, name, buckets, version)

    monkeypatch.setattr(Store, "read", read)
    run("one")
    monkeypatch.undo()
    store = Store(spark, root)
    assert asked["keys"] <= 3 and asked["records"] <= 2 and sum(e["name"] == "keys" for e in store.manifest()) >= 16
    found = {r.osm_id: (r.version, r.geometry_wkt) for r in store.read("records").collect()}
    assert found[7] == ("3", "POINT (53 2)") and found[8] == ("1", "POINT (8 2)") and found[900][0] == "1" and len(found) == 400
    versions = store.versions()
    run("one"), run("two")
    assert store.versions() == versions
    lines = [json.loads(r.value) for r in store.read("records.geojson").collect()]
    assert {x["properties"]["osm_id"]: x["geometry"]["coordinates"] for x in lines}[7] == [53, 2] and len(lines) == 400


def test_small_buckets_share_files(spark, tmp_path):
    """Thousands of buckets lie in few files; before, each was a folder that every reader listed."""
    store = Store(spark, str(tmp_path), bucket_rows=10)
    store.commit({"t": Content(spark.range(20_000).selectExpr("id", "string(id) AS value"), ["id"], [0], {})})
    assert len({(e["depth"], e["prefix"]) for e in store.manifest()}) == 2048
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 16
    assert store.read("t").count() == 20_000 and store.read("t").columns == ["id", "value"]
    asked = spark.createDataFrame([(5,), (77,)], "id long")
    some = store.read("t", store.buckets_of("t", asked, ["id"]))
    assert {5, 77} <= {r.id for r in some.collect()} and some.count() < 60
    # what a later commit replaced is not read again from the files it shares
    touched = store.buckets_of("t", asked, ["id"])
    stay = store.read("t", touched).join(asked, "id", "left_anti")
    store.commit({"t": Content(stay, ["id"], touched, {})})
    assert store.read("t").count() == 19_998
    assert store.read("t", version=1).count() == 20_000
    again = Store(spark, str(tmp_path), bucket_rows=10)
    assert {r.id for r in again.read("t").collect()} == set(range(20_000)) - {5, 77}
