"""Record layouts and the fixed value lists of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Tag keys and the values kept for each of them.
WHITELIST: dict[str, list[str]] = {
    "industrial": [
        "oil_well", "gas_well", "oil", "well", "refinery", "mine", "biogas_plant",
        "chemical", "works", "petroleum",
    ],
    "power": [
        "plant", "generator", "substation", "line", "minor_line", "cable",
        "transformer", "tower", "switch", "insulator", "storage_batteries", "converter",
    ],
    "military": [
        "base", "airfield", "barracks", "bunker", "checkpoint", "danger_area", "range",
        "training_area", "naval_base", "trench", "radar", "intelligence",
        "security_post", "nuclear_weapons_facility",
    ],
    "telecom": [
        "data_center", "exchange", "connection_point", "line", "tower", "mast",
        "satellite_station", "antenna", "wireless",
    ],
    "man_made": [
        "communications_tower", "mast", "water_tower", "storage_tank", "gasometer",
        "pipeline", "bunker", "radar", "monitoring_station", "submarine_cable_landing",
        "petroleum_refinery", "shipyard", "mineshaft", "hydrogen_tank", "antenna",
        "satellite_dish", "water_works", "wastewater_plant",
    ],
    "amenity": [
        "police", "prison", "courthouse", "embassy", "fire_station", "hospital",
        "townhall", "bank", "university", "fuel", "charging_station", "consulate",
        "customs",
    ],
    "office": [
        "government", "diplomatic", "telecommunication", "energy", "ngo", "lawyer",
        "security", "intelligence",
    ],
    "landuse": [
        "residential", "industrial", "commercial", "military", "institutional",
        "cemetery", "reservoir", "forest", "quarry", "port", "logistics",
    ],
    "building": [
        "government", "hospital", "industrial", "train_station", "bunker", "ruins",
        "warehouse", "data_center", "diplomatic", "security",
    ],
    "boundary": [
        "administrative", "maritime", "political", "disputed", "protected_area",
        "national_park",
    ],
    "place": [
        "city", "town", "village", "hamlet", "suburb", "neighbourhood", "island", "islet",
    ],
    "highway": [
        "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "track",
        "construction",
    ],
    "aeroway": [
        "aerodrome", "helipad", "heliport", "runway", "taxiway", "apron", "hangar",
        "navigationaid",
    ],
    "railway": ["station", "yard", "junction", "rail", "subway", "tram", "light_rail"],
    "waterway": [
        "river", "stream", "canal", "drain", "ditch", "dam", "lock", "waterfall",
    ],
    "natural": [
        "water", "coastline", "bay", "beach", "spring", "peak", "volcano", "cliff",
        "ridge", "glacier",
    ],
    "harbour": ["port", "terminal", "quay", "marina", "dock", "yes"],
    "barrier": [
        "border_control", "city_wall", "fence", "military_checkpoint", "toll_booth",
        "block", "security_fence",
    ],
    "emergency": [
        "ambulance_station", "siren", "bunker", "disaster_response", "water_rescue",
        "control_centre",
    ],
    "route": ["pipeline", "power"],
    "shop": ["supermarket", "mall", "pharmacy", "electronics", "hardware", "convenience"],
    "tourism": ["hotel", "museum", "viewpoint", "attraction", "information", "gallery"],
    "leisure": ["park", "stadium", "sports_centre", "swimming_pool", "marina", "garden"],
}

# Tag keys of a full run.
ALL_TAGS = [
    "boundary", "place", "military", "amenity", "power", "telecom", "highway",
    "aeroway", "railway", "waterway", "harbour", "barrier", "man_made", "landuse",
    "office", "building", "natural", "emergency", "industrial", "route",
]

# Named tag selections.
PROFILES = {
    "full": ALL_TAGS,
    "core": ["military", "boundary", "telecom", "power", "amenity"],
    "infrastructure": ["highway", "railway", "aeroway", "harbour", "barrier"],
}

# Columns of a feature record, in output order; all text but osm_id.
RECORD_COLUMNS = [
    "osm_id", "osm_type", "name", "category", "sub_cat", "admin_level",
    "version", "timestamp", "user", "changeset", "tags",
    "operator", "ref", "substance", "plant_source", "voltage", "industrial",
    "communication", "telecom", "capacity", "resource", "access", "security",
    "frequency", "height", "strat_level",
]

# Columns shortened for sinks with ten-character column names.
SHORT_NAMES = {
    "admin_level": "adm_lvl",
    "timestamp": "ts",
    "changeset": "chgset",
    "plant_source": "p_src",
    "industrial": "indus",
    "communication": "comms",
    "telecom": "telcom",
}

# Output formats and the file name endings that stand for them in a manifest.
FORMAT_EXTENSIONS = {
    "parquet": ".parquet",
    "geojson": ".geojson",
    "table": ".db",
    "short": ".shp",
    "gpkg": ".gpkg",
}

# Size limits in bytes, and chunk sizes in rows.
MAX_LINE_BYTES = 50 * 1024 * 1024
MIN_INPUT_BYTES = 100 * 1024
MIN_OUTPUT_BYTES = 1024
PART_ROWS = 20_000
OUTPUT_ROWS = 100_000

SRID = 4326
# --- End of fixed values ----------------------------------------------------

#: Attributes copied from the tag of the same name, "" when absent.
PLAIN_ATTRIBUTES = [
    c for c in RECORD_COLUMNS[11:] if c not in ("plant_source", "strat_level")
]

GEOMETRY_COLUMNS = ["geometry_wkt", "geom_group"]

FEATURE_COLUMNS = RECORD_COLUMNS + GEOMETRY_COLUMNS

#: Columns the engine carries beside the record: where a row came from, and
#: which kind of map object it was before it became a node, way or area.
LINEAGE_COLUMNS = ["source", "src_type"]

FEATURE = T.StructType(
    [
        T.StructField(c, T.LongType() if c == "osm_id" else T.StringType())
        for c in FEATURE_COLUMNS
    ]
)

STAGED = T.StructType(
    FEATURE.fields
    + [T.StructField(c, T.StringType()) for c in ["src_type", "sub_cat_dir", "source"]]
)

_EDIT = (
    "tags map<string,string>, version int, timestamp timestamp, user string, changeset bigint"
)
ELEMENTS = {
    "node": f"id bigint, lon double, lat double, {_EDIT}",
    "way": f"id bigint, node_refs array<bigint>, {_EDIT}",
    "relation": (
        "id bigint, members array<struct<type:string,ref:bigint,role:string>>, " + _EDIT
    ),
}
