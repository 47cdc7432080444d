"""Changed elements: only what refers to a change is built again.

The store keeps the latest version of every node, way and relation, and two
reverse indexes: which ways refer to a node, which relations to a way. A change
is followed through them: a moved node touches its ways, those the relations
they belong to. Only the buckets of the store that hold these are read; only
the buckets whose rows change are written, all in one commit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from terrafold.operators.assemble import latest, stored
from terrafold.operators.relational import unique_keys
from terrafold.plans.elements import element_records
from terrafold.sinks.store import Content, Store

KINDS = ["node", "way", "relation"]
#: Reverse indexes, from what is referred to, with the kind of object that refers.
INDEXES = {"node_ways": "way", "way_relations": "relation"}


@dataclass(frozen=True)
class Delta:
    """What a set of changes does to the records: keys to remove, records to add, objects affected."""

    removed: DataFrame  # src_type, osm_id
    records: DataFrame
    affected: dict[str, DataFrame]


def _references(objects: DataFrame, kind: str) -> DataFrame:
    """(ref, id): what objects refer to; deleted ones refer to nothing."""
    present = objects.filter(~F.col("deleted"))
    if kind == "way":
        refs = present.select("id", F.explode("node_refs").alias("ref"))
    else:
        ways = F.filter("members", lambda m: m["type"].isin("way", "w"))
        refs = present.select("id", F.explode(ways).alias("m")).select("id", F.col("m.ref").alias("ref"))
    return refs.select("ref", "id").distinct()


def _versions(elements: DataFrame) -> DataFrame:
    """Elements with ``deleted``; of each id the latest version."""
    if "deleted" not in elements.columns:
        elements = elements.withColumn("deleted", F.lit(False))
    return latest(elements.withColumn("deleted", F.coalesce("deleted", F.lit(False))))


def load_elements(store: Store, nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> int:
    """Fill an empty store with the latest versions and their reverse indexes, in one commit."""
    if store.versions():
        raise ValueError(f"{store.root} has elements already")
    contents = {}
    for kind, elements in zip(KINDS, (nodes, ways, relations)):
        rows = stored(_versions(elements), f"load-{kind}")
        contents[kind] = Content(rows, ["id"], [0], {})
        for name, of in INDEXES.items():
            if of == kind:
                contents[name] = Content(_references(rows, kind), ["ref"], [0], {})
    return store.commit(contents)


def _held(store: Store, name: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of a table whose key is wanted; only the buckets of wanted keys are read."""
    wanted = unique_keys(wanted.select(F.col(wanted.columns[0]).alias(key)), [key])
    rows = store.read(name, store.buckets_of(name, wanted, [key]))
    return rows.join(wanted, key, "left_semi").select(*rows.columns)


def _effective(store: Store, kind: str, changes: DataFrame) -> DataFrame:
    """The changes that are the latest version of their object, against the stored one."""
    newest = _versions(changes)
    before = _held(store, kind, newest.select("id"), "id").withColumn("_stored", F.lit(True))
    both = before.unionByName(newest.select(*[c for c in before.columns if c != "_stored"]).withColumn("_stored", F.lit(False)))
    chosen = latest(both).filter(~F.col("_stored")).drop("_stored")
    return stored(chosen, f"changed-{kind}")


def _replaced(store: Store, kind: str, changed: DataFrame) -> Content:
    touched = store.buckets_of(kind, changed, ["id"])
    stay = store.read(kind, touched).join(unique_keys(changed, ["id"]), "id", "left_anti")
    return Content(stay.unionByName(changed.select(*stay.columns)), ["id"], touched, {})


def _reindexed(store: Store, name: str, kind: str, changed: DataFrame) -> Content:
    """The index without the changed objects' old references, with their new ones."""
    old = _held(store, kind, changed.select("id"), "id")
    gone, come = _references(old, kind), _references(changed, kind)
    both = stored(gone.withColumn("_come", F.lit(False)).unionByName(come.withColumn("_come", F.lit(True))), f"delta-{name}")
    touched = store.buckets_of(name, both, ["ref"])
    stay = store.read(name, touched).join(both.filter(~F.col("_come")).select("ref", "id"), ["ref", "id"], "left_anti")
    return Content(stay.select("ref", "id").unionByName(both.filter("_come").select("ref", "id")), ["ref"], touched, {})


def _overlaid(store: Store, kind: str, wanted: DataFrame, changed: DataFrame) -> DataFrame:
    """Wanted objects as they are after the changes, without deleted ones."""
    own = changed.join(unique_keys(wanted, ["id"]), "id", "left_semi")
    others = wanted.join(unique_keys(changed, ["id"]), "id", "left_anti")
    rows = _held(store, kind, others, "id").unionByName(own.select(*changed.columns))
    return rows.filter(~F.col("deleted")).drop("deleted")


def apply_changes(
    store: Store,
    nodes: DataFrame,
    ways: DataFrame,
    relations: DataFrame,
    tags: Sequence[str],
    subtags: Sequence[str] | None = None,
    wanted: Mapping[str, Sequence[str]] | None = None,
    **options,
) -> Delta:
    """Take changed elements into the store; what becomes of the records.

    The tables hold new versions of some elements; a row with ``deleted`` says
    that its object is gone. A version older than the stored one changes
    nothing; the mark of a deleted object stays, so no older version brings it
    back. Records to remove are those of all affected objects, records to add
    are built from the objects as they are now. The delta is written before the
    commit, so it stays readable, and a failed run leaves the store as it was.
    """
    changed = {k: _effective(store, k, c) for k, c in zip(KINDS, (nodes, ways, relations))}
    ids = {k: c.select("id") for k, c in changed.items()}
    # ways and relations that refer to a change, by the indexes as they were; new references are changes themselves
    by_node = _held(store, "node_ways", ids["node"], "ref").select("id")
    affected = {"node": ids["node"], "way": stored(ids["way"].unionByName(by_node).distinct(), "affected-way")}
    by_way = _held(store, "way_relations", affected["way"], "ref").select("id")
    affected["relation"] = stored(ids["relation"].unionByName(by_way).distinct(), "affected-relation")

    now_relations = stored(_overlaid(store, "relation", affected["relation"], changed["relation"]), "now-relation")
    members = _references(now_relations.withColumn("deleted", F.lit(False)), "relation").select(F.col("ref").alias("id"))
    now_ways = stored(_overlaid(store, "way", affected["way"].unionByName(members).distinct(), changed["way"]), "now-way")
    places = now_ways.select(F.explode("node_refs").alias("id"))
    now_nodes = _overlaid(store, "node", affected["node"].unionByName(places).distinct(), changed["node"])
    built = element_records(
        stored(now_nodes, "now-node"), now_ways, now_relations, tags, subtags, wanted=wanted, **({"unique_ids": True} | options)
    )
    keys = None
    for kind, found in affected.items():
        rows = found.select(F.lit(kind).alias("src_type"), F.col("id").alias("osm_id"))
        keys = rows if keys is None else keys.unionByName(rows)
    keys = stored(keys, "affected")
    # members and places of affected objects are not affected themselves
    records = stored(built.join(unique_keys(keys, ["src_type", "osm_id"]), ["src_type", "osm_id"], "left_semi").select(*built.columns), "delta")
    contents = {k: _replaced(store, k, c) for k, c in changed.items()}
    for name, kind in INDEXES.items():
        contents[name] = _reindexed(store, name, kind, changed[kind])
    store.commit(contents)
    return Delta(keys, records, affected)


def updated_records(records: DataFrame, delta: Delta) -> DataFrame:
    """Earlier records with the changes: those of affected objects replaced."""
    keys = unique_keys(delta.removed, ["src_type", "osm_id"])
    kept = records.join(keys, ["src_type", "osm_id"], "left_anti").select(*records.columns)
    return kept.unionByName(delta.records.select(*records.columns))
