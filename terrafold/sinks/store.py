"""Tables in hash buckets, in versions that readers follow.

A row belongs to a bucket by the low bits of its key's hash. Buckets are bounded:
one that has grown too large is split by further bits when it is next written,
so a change of a few keys reads and writes a few buckets, however large the
table is. Small buckets lie together in a folder, in order, so that a table has
as many files as its rows need, however small its buckets are. Nothing is changed in place: new contents of buckets go to a new
folder, and a manifest then names the folder of every bucket. It appears under
its number by one rename, for all tables and forms at once, so a reader sees
all of a commit or nothing, and what a failed commit left is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from terrafold.session import drop_path

#: Rows of a bucket beyond which it is split.
BUCKET_ROWS = 1_000_000
#: Rows up to which buckets are written into one folder.
FOLDER_ROWS = 500_000
_DEPTH_SHIFT = 48
#: together: how many of a bucket's last bits its folder leaves out, null if each bucket has a folder of its own;
#: held: buckets with rows that the folder was written with.
_MANIFEST = "name string, depth int, prefix long, folder string, rows long, schema string, form string, notes string, together int, held long"


@dataclass(frozen=True)
class Content:
    """The whole new content of the touched buckets of one table.

    ``forms`` are further renditions of the same rows: name -> (file format, rows -> rows).
    """

    rows: DataFrame
    keys: Sequence[str]
    touched: Sequence[int]
    forms: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]]


class Store:
    """Versioned tables below one folder. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.bucket_rows = spark, root.rstrip("/"), bucket_rows
        self._last: tuple[str, list] = ("", [])  # the manifest read last; none is ever changed

    # --- manifests ---

    def _files(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the commits that are there, ascending."""
        place, files = self._files(f"{self.root}/_versions")
        if not files.exists(place):
            return []
        names = [status.getPath().getName() for status in files.listStatus(place)]
        return sorted(int(n[1:]) for n in names if n[0] == "v")

    def manifest(self, version: int | None = None) -> list:
        """One row for each bucket and form of a version, the newest by default."""
        found = self.versions()
        if not found:
            return []
        path = f"{self.root}/_versions/v{found[-1] if version is None else version:012d}"
        if self._last[0] != path:
            # one row for each bucket
            self._last = path, self.spark.read.schema(_MANIFEST).json(path).collect()
        return self._last[1]

    def _publish(self, entries: list[dict], version: int) -> None:
        draft, final = f"{self.root}/_versions/_{uuid.uuid4().hex}", f"{self.root}/_versions/v{version:012d}"
        # a table's schema stands with its first bucket only
        schemas = {e["name"]: e["schema"] for e in entries if e["schema"]}
        entries = [e | {"schema": schemas.pop(e["name"], None)} for e in entries]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.json(draft)
        source, files = self._files(draft)
        target, _ = self._files(final)
        if files.exists(target) or not files.rename(source, target):
            raise RuntimeError(f"version {version} of {self.root} was written by another run")

    # --- reading ---

    def read(self, name: str, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame | None:
        """Rows of a table, of all buckets or the given ones; None where the table does not exist."""
        entries = [e for e in self.manifest(version) if e["name"] == name]
        if not entries:
            return None
        wanted = None if buckets is None else set(buckets)
        chosen = [e for e in entries if e["folder"] and (wanted is None or _code(e["depth"], e["prefix"]) in wanted)]
        schema = T.StructType.fromJson(json.loads(next(e["schema"] for e in entries if e["schema"])))
        if not chosen:
            return self.spark.createDataFrame([], schema)
        parts = []
        if apart := [self._path(e) for e in chosen if e["together"] is None]:
            parts.append(self.spark.read.schema(schema).format(chosen[0]["form"]).load(apart))
        folders: dict[str, list] = {}
        for e in chosen:
            if e["together"] is not None:
                folders.setdefault(e["folder"], []).append(e)
        for held in folders.values():
            found = self.spark.read.schema(_placed(schema)).format(held[0]["form"]).load(sorted({self._path(e) for e in held}))
            if len(held) < held[0]["held"]:  # others lie beside them, or did before later commits
                found = found.filter(_one_of(held))
            parts.append(found.select(*[F.col(f"`{c}`") for c in schema.names]))
        return reduce(DataFrame.unionByName, parts)

    def _path(self, entry) -> str:
        place = f"{self.root}/{entry['name']}/{entry['folder']}"
        if entry["together"] is None:
            return f"{place}/d={entry['depth']}/p={entry['prefix']}"
        depth = max(0, entry["depth"] - entry["together"])
        return f"{place}/part_of={depth}-{entry['prefix'] & ((1 << depth) - 1)}"

    def notes(self, version: int | None = None) -> str:
        """What the writer noted with a commit."""
        found = self.manifest(version)
        return found[0]["notes"] if found else ""

    def buckets_of(self, name: str, rows: DataFrame, keys: Sequence[str]) -> list[int]:
        """Buckets of a table that the rows' keys belong to: at most as many as there are."""
        code = self._bucket(name, _hash(keys), self.manifest())
        return [r[0] for r in rows.select(code.alias("code")).distinct().collect()]

    @staticmethod
    def _bucket(name: str, hashed: Column, manifest: list) -> Column:
        """The bucket of a key: its depth and the hash's bits of that depth."""
        prefixes: dict[int, list[int]] = {}
        for e in manifest:
            if e["name"] == name:
                prefixes.setdefault(e["depth"], []).append(e["prefix"])
        prefixes = prefixes or {0: [0]}
        cases = []
        for depth, held in sorted(prefixes.items()):
            bits = hashed.bitwiseAND(F.lit((1 << depth) - 1))
            code = bits.bitwiseOR(F.lit(depth << _DEPTH_SHIFT))
            cases.append(code if len(prefixes) == 1 else F.when(bits.isin(held), code))
        return F.coalesce(*cases)

    # --- writing ---

    def commit(self, contents: Mapping[str, Content], notes: str = "") -> int:
        """Write new contents of the touched buckets of some tables; the number of the new version.

        All other buckets stay as they are. The manifest comes last.
        """
        before = self.manifest()
        version = (self.versions() or [0])[-1] + 1
        folder = f"c{version:012d}-{uuid.uuid4().hex[:8]}"
        after = {(e["name"], e["depth"], e["prefix"]): e.asDict() | {"notes": notes} for e in before}
        for name, content in contents.items():
            names = [name, *(f"{name}.{form}" for form in content.forms)]
            for touched in content.touched:
                depth, prefix = touched >> _DEPTH_SHIFT, touched & ((1 << _DEPTH_SHIFT) - 1)
                for n in names:
                    after.pop((n, depth, prefix), None)
            for entry in self._write(name, content, folder, before, notes):
                after[entry["name"], entry["depth"], entry["prefix"]] = entry
        self._publish(list(after.values()), version)
        return version

    def _write(self, name: str, content: Content, folder: str, before: list, notes: str) -> list[dict]:
        hashed = _hash(content.keys)
        rows = content.rows.withColumn("_code", self._bucket(name, hashed, before))
        # by the sizes of the last commit: a bucket that has grown is split when it is next written
        sizes = {_code(e["depth"], e["prefix"]): e["rows"] for e in before if e["name"] == name}
        sizes = sizes or {0: content.rows.count()}
        deeper = {}
        for code in content.touched:
            depth, more = code >> _DEPTH_SHIFT, 0
            while sizes.get(code, 0) > self.bucket_rows << more:
                more += 1
            deeper[code] = depth + more
        grown = sorted({d for c, d in deeper.items() if d != c >> _DEPTH_SHIFT})
        depth = F.shiftright("_code", _DEPTH_SHIFT)
        for d in grown:
            depth = F.when(F.col("_code").isin([c for c, x in deeper.items() if x == d and c >> _DEPTH_SHIFT != d]), F.lit(d)).otherwise(depth)
        placed = rows.withColumn("d", depth.cast("int"))
        placed = placed.withColumn("p", hashed.bitwiseAND(F.expr("shiftleft(1L, d) - 1"))).drop("_code")
        path = f"{self.root}/{name}/{folder}"
        together = max(0, (FOLDER_ROWS // self.bucket_rows).bit_length() - 1)
        shared = F.greatest(F.lit(0), F.col("d") - together)
        group = F.concat(shared.cast("string"), F.lit("-"), hashed.bitwiseAND(F.expr(f"shiftleft(1L, greatest(0, d - {together})) - 1")).cast("string"))
        # Spark splits a folder that is too large for one task; buckets in order, so that a scan skips those not asked for
        placed = placed.withColumn("part_of", group).hint("rebalance", F.col("part_of")).sortWithinPartitions("part_of", "d", "p")
        placed.write.partitionBy("part_of").parquet(path)
        columns = [*content.rows.columns, "d", "p"]
        written = self.spark.read.schema(_placed(content.rows.schema)).parquet(path).select(*[F.col(f"`{c}`") for c in columns])
        held = {(r["d"], r["p"]): r["count"] for r in written.groupBy("d", "p").count().collect()}
        renditions = {name: ("parquet", content.rows.schema.json())}
        for form, (kind, make) in content.forms.items():
            made = make(written)
            made.write.partitionBy("d", "p").format(kind).save(f"{self.root}/{name}.{form}/{folder}")
            fields = [f for f in made.schema.fields if f.name not in ("d", "p")]
            renditions[f"{name}.{form}"] = (kind, T.StructType(fields).json())
        entries = []
        for code, depth_after in deeper.items():
            depth, prefix = code >> _DEPTH_SHIFT, code & ((1 << _DEPTH_SHIFT) - 1)
            for child in range(1 << (depth_after - depth)):
                p = prefix | child << depth
                n = held.get((depth_after, p), 0)
                for own, (kind, schema) in renditions.items():
                    beside = (together, len(held)) if own == name else (None, None)
                    entries.append(
                        dict(name=own, depth=depth_after, prefix=p, folder=folder if n else None, rows=n, schema=schema, form=kind, notes=notes)
                        | dict(zip(("together", "held"), beside))
                    )
        return entries

    def vacuum(self, keep: int = 2) -> None:
        """Remove folders that none of the newest ``keep`` versions names, and older manifests."""
        versions = self.versions()
        named = {(e["name"], e["folder"]) for v in versions[-keep:] for e in self.manifest(v)}
        for name in {n for n, _ in named}:
            place, files = self._files(f"{self.root}/{name}")
            if files.exists(place):
                for status in files.listStatus(place):
                    if (name, status.getPath().getName()) not in named:
                        drop_path(self.spark, status.getPath().toString())
        for version in versions[:-keep]:
            drop_path(self.spark, f"{self.root}/_versions/v{version:012d}")


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _placed(schema: T.StructType) -> T.StructType:
    """A table's columns and the bucket of each row, as they are written."""
    return T.StructType([*schema.fields, T.StructField("d", T.IntegerType()), T.StructField("p", T.LongType())])


def _one_of(entries: Sequence) -> Column:
    """Whether a row belongs to one of the buckets."""
    prefixes: dict[int, list[str]] = {}
    for e in entries:
        prefixes.setdefault(e["depth"], []).append(str(e["prefix"]))
    return F.expr(" OR ".join(f"(d = {depth} AND p IN ({'L,'.join(held)}L))" for depth, held in prefixes.items()))


def _code(depth: int, prefix: int) -> int:
    return depth << _DEPTH_SHIFT | prefix
