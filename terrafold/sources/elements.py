"""Decoded map objects: nodes, ways and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrafold.schema import ELEMENTS

# Row layouts of the XML form; attributes carry a leading underscore.
_XML_EDIT = (
    "_id bigint, _version int, _timestamp string, _user string, _changeset bigint, "
    "tag array<struct<_k: string, _v: string>>"
)
_XML_LAYOUT = {
    "node": f"{_XML_EDIT}, _lon double, _lat double",
    "way": f"{_XML_EDIT}, nd array<struct<_ref: bigint>>",
    "relation": f"{_XML_EDIT}, member array<struct<_type: string, _ref: bigint, _role: string>>",
}


def _xml_body(kind: str) -> list[Column]:
    if kind == "node":
        return [F.col("_lon").alias("lon"), F.col("_lat").alias("lat")]
    if kind == "way":
        return [F.col("nd._ref").alias("node_refs")]
    member = F.transform(
        "member",
        lambda m: F.struct(
            m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role")
        ),
    )
    return [member.alias("members")]


def _read_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    rows = spark.read.schema(_XML_LAYOUT[kind]).option("rowTag", kind).xml(path)
    pairs = F.coalesce("tag", F.array().cast("array<struct<_k: string, _v: string>>"))
    keys = F.array_distinct(F.transform(pairs, lambda t: t["_k"]))
    tags = F.map_from_arrays(
        keys,
        F.transform(keys, lambda k: F.filter(pairs, lambda t: t["_k"] == k)[0]["_v"]),
    )
    return rows.select(
        F.col("_id").alias("id"),
        *_xml_body(kind),
        tags.alias("tags"),
        F.col("_version").alias("version"),
        F.try_to_timestamp("_timestamp").alias("timestamp"),
        F.col("_user").alias("user"),
        F.col("_changeset").alias("changeset"),
    )


def read_elements(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Element table of one kind (node, way, relation) from parquet, json or xml.

    The schema is always given, so nothing is inferred and no pass over the
    data is spent on finding it.
    """
    if fmt == "xml":
        return _read_xml(spark, path, kind)
    return spark.read.schema(ELEMENTS[kind]).format(fmt).load(path)
