"""The result of each query as SQL on the test tables.

Nothing here is shared with the Spark side: geometry texts, tag objects and
whitelist rows are written out, straight from the integers of the tables.
"""

from __future__ import annotations

_EV = """
ev AS (
  SELECT event_id AS id, event_id % 8 AS kind, user_id % 4 AS vc, user_id,
    CASE event_type WHEN 'view' THEN 'power' WHEN 'click' THEN 'military'
      WHEN 'purchase' THEN 'amenity' WHEN 'signup' THEN 'highway' ELSE 'landuse' END AS cat,
    CASE event_type WHEN 'view' THEN 'tower' WHEN 'click' THEN 'base'
      WHEN 'purchase' THEN 'bank' WHEN 'signup' THEN 'trunk' ELSE 'forest' END AS good,
    event_id % 300 - 150 AS x, user_id % 100 - 50 AS y
  FROM events
)"""

_FEAT = (
    _EV
    + """,
shape AS (
  SELECT *,
    CASE WHEN id % 97 = 0 THEN 0 ELSE id END AS osm_id,
    CASE vc WHEN 2 THEN 'zzz' ELSE good END AS val,
    '(' || x || ' ' || y || ',' || (x + 2) || ' ' || y || ',' || (x + 2) || ' ' || (y + 2) || ',' ||
      x || ' ' || (y + 2) || ',' || x || ' ' || y || ')' AS ring,
    '(' || x || ' ' || y || ',' || (x + 1) || ' ' || (y + 1) || ')' AS line
  FROM ev
),
feat AS (
  SELECT *,
    CASE kind WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' WHEN 2 THEN 'Polygon'
      WHEN 3 THEN 'MultiLineString' WHEN 4 THEN 'MultiPolygon' ELSE 'GeometryCollection'
      END AS geometry_type,
    CASE kind WHEN 0 THEN 'node' WHEN 2 THEN 'area' WHEN 4 THEN 'area' ELSE 'way' END AS osm_type,
    CASE kind WHEN 0 THEN 'points' WHEN 2 THEN 'polygons' WHEN 4 THEN 'polygons' ELSE 'lines'
      END AS geom_group,
    CASE kind WHEN 0 THEN 'POINT (' || x || ' ' || y || ')'
      WHEN 1 THEN 'LINESTRING ' || line
      WHEN 2 THEN 'POLYGON (' || ring || ')'
      WHEN 3 THEN 'MULTILINESTRING (' || line || ',' || line || ')'
      WHEN 4 THEN 'MULTIPOLYGON ((' || ring || '))'
      ELSE 'GEOMETRYCOLLECTION (POINT (' || x || ' ' || y || '),LINESTRING ' || line || ')'
      END AS geometry_wkt,
    CASE id % 4 WHEN 0 THEN 'n' || id WHEN 1 THEN 'e' || id WHEN 2 THEN '' ELSE 'Unknown' END AS name,
    CASE WHEN id % 12 = 0 THEN '' || (id % 11) ELSE '' END AS admin_level,
    CASE WHEN id % 3 <> 0 THEN '' || (id % 5 + 1) ELSE '' END AS version,
    CASE WHEN id % 4 <> 1 THEN '2024-01-1' || (id % 9) || 'T00:00:00Z' ELSE '' END AS timestamp,
    CASE WHEN user_id % 2 = 0 THEN 'u' || user_id ELSE 'unknown' END AS user,
    CASE WHEN id % 6 <> 0 THEN '' || (id * 3) ELSE '' END AS changeset,
    CASE WHEN id % 10 = 0 THEN 'Şirket ' || user_id ELSE '' END AS operator,
    CASE WHEN id % 11 = 0 THEN '' || (user_id * 10) ELSE '' END AS voltage,
    CASE WHEN id % 9 = 0 THEN 'solar' WHEN id % 6 = 0 THEN 'wind' ELSE '' END AS plant_source,
    CASE WHEN id % 14 = 0 THEN 's' || (id % 3) WHEN id % 7 = 0 THEN 'l' || (id % 2) ELSE ''
      END AS strat_level,
    '{' || concat_ws(',',
      '"' || cat || '":"' ||
        CASE vc WHEN 1 THEN ' ' || upper(good) || ' ' WHEN 2 THEN 'zzz' ELSE good END || '"',
      CASE id % 4 WHEN 0 THEN '"name":"n' || id || '"' WHEN 1 THEN '"name:en":"e' || id || '"'
        WHEN 2 THEN '"name":null' END,
      CASE WHEN user_id % 5 = 0 THEN '"man_made":"mast"' END,
      CASE WHEN id % 10 = 0 THEN '"operator":"Şirket ' || user_id || '"' END,
      CASE WHEN id % 11 = 0 THEN '"voltage":"' || (user_id * 10) || '"' END,
      CASE WHEN id % 13 = 0 THEN '"access":null' END,
      CASE WHEN id % 9 = 0 THEN '"plant:source":"solar"' END,
      CASE WHEN id % 6 = 0 THEN '"generator:source":"wind"' END,
      CASE WHEN id % 14 = 0 THEN '"strat_level":"s' || (id % 3) || '"' END,
      CASE WHEN id % 7 = 0 THEN '"level":"l' || (id % 2) || '"' END,
      CASE WHEN id % 12 = 0 THEN '"admin_level":"' || (id % 11) || '"' END) || '}' AS tags
  FROM shape WHERE kind < 6
),
pairs AS (
  SELECT *, cat AS category, val AS sub_cat FROM feat
  UNION ALL
  SELECT *, 'man_made' AS category, 'mast' AS sub_cat FROM feat WHERE user_id % 5 = 0
),
rec AS (SELECT * FROM pairs WHERE sub_cat <> 'zzz'),
twice AS (
  SELECT *, 'a' AS source FROM rec
  UNION ALL
  SELECT *, 'b' AS source FROM rec WHERE id % 10 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category, osm_id, osm_type
    ORDER BY source, try_cast(version AS BIGINT) DESC NULLS LAST, geometry_wkt, sub_cat, tags,
      timestamp, "user", changeset) AS rn
  FROM twice
),
uniq AS (SELECT * FROM ranked WHERE rn = 1)"""
)

_RECORD = """osm_id, osm_type, name, category, sub_cat, admin_level, version, timestamp, "user",
  changeset, tags, operator, '' AS ref, '' AS substance, plant_source, voltage,
  '' AS industrial, '' AS communication, '' AS telecom, '' AS capacity, '' AS resource,
  '' AS access, '' AS security, '' AS frequency, '' AS height, strat_level, geometry_wkt,
  geom_group"""


# The feature line of every event, as text.
_LINES = (
    _EV
    + """,
g AS (
  SELECT *, '[' || x || ',' || y || ']' AS p0, '[' || (x + 1) || ',' || (y + 1) || ',7]' AS p1,
    '[[' || x || ',' || y || '],[' || (x + 2) || ',' || y || '],[' || (x + 2) || ',' || (y + 2) ||
      '],[' || x || ',' || (y + 2) || '],[' || x || ',' || y || ']]' AS ring
  FROM ev
),
line AS (
  SELECT id, '{"type":"Feature","geometry":' ||
    CASE kind WHEN 0 THEN '{"type":"Point","coordinates":[' || x || ',' || y || ',9]}'
      WHEN 1 THEN '{"type":"LineString","coordinates":[' || p0 || ',' || p1 || ']}'
      WHEN 2 THEN '{"type":"Polygon","coordinates":[' || ring || ']}'
      WHEN 3 THEN '{"type":"MultiLineString","coordinates":[[' || p0 || ', ' || p1 || '],[' ||
        p0 || ',' || p1 || ']]}'
      WHEN 4 THEN '{"type":"MultiPolygon","coordinates":[[' || ring || ']]}'
      WHEN 5 THEN '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":' ||
        p0 || '},{"type":"LineString","coordinates":[' || p0 || ',' || p1 || ']}]}'
      WHEN 6 THEN '{"type":"MultiPoint","coordinates":[' || p0 || ']}'
      ELSE 'null' END ||
    ',"properties":{' || concat_ws(',',
      CASE WHEN id % 97 = 0 THEN '"@id":"w' || id || '"' ELSE '"@id":' || id END,
      CASE WHEN id % 3 <> 0 THEN '"@version":' || (id % 5 + 1) END,
      CASE WHEN id % 4 <> 1 THEN '"@timestamp":"2024-01-1' || (id % 9) || 'T00:00:00Z"' END,
      CASE WHEN user_id % 2 = 0 THEN '"@user":"u' || user_id || '"' END,
      CASE WHEN id % 6 <> 0 THEN '"@changeset":' || (id * 3) END,
      '"' || cat || '":"' ||
        CASE vc WHEN 1 THEN ' ' || upper(good) || ' ' WHEN 2 THEN 'zzz' ELSE good END || '"',
      CASE id % 4 WHEN 0 THEN '"name":"n' || id || '"' WHEN 1 THEN '"name:en":"e' || id || '"'
        WHEN 2 THEN '"name":null' END,
      CASE WHEN user_id % 5 = 0 THEN '"man_made":"mast"' END,
      CASE WHEN id % 10 = 0 THEN '"operator":"Şirket ' || user_id || '"' END,
      CASE WHEN id % 11 = 0 THEN '"voltage":' || (user_id * 10) END,
      CASE WHEN id % 13 = 0 THEN '"access":null' END,
      CASE WHEN id % 9 = 0 THEN '"plant:source":"solar"' END,
      CASE WHEN id % 6 = 0 THEN '"generator:source":"wind"' END,
      CASE WHEN id % 14 = 0 THEN '"strat_level":"s' || (id % 3) || '"' END,
      CASE WHEN id % 7 = 0 THEN '"level":"l' || (id % 2) || '"' END,
      CASE WHEN id % 12 = 0 THEN '"admin_level":"' || (id % 11) || '"' END) || '}}' AS value,
    kind
  FROM g
),
noise AS (
  SELECT id, CASE id % 50 WHEN 0 THEN '{"bad ' || id WHEN 1 THEN '' WHEN 2 THEN '' || id
    WHEN 3 THEN '{"geometry":null,"properties":{"power":"tower","@id":' || id || '}'
    WHEN 4 THEN '{"geometry":{"type":"Point","coordinates":[1,2]},"properties":{"power":"tower"}} ' || id
    ELSE '[' || id || ']' END AS value
  FROM ev WHERE id % 50 < 6
)"""
)

_WAY = """
nd AS (SELECT p_partkey AS id, p_partkey % 360 - 180 AS lon, p_size AS lat FROM part),
item AS (
  SELECT l_orderkey AS id, l_partkey AS ref,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos
  FROM lineitem
),
refs AS (
  SELECT id, pos, ref FROM item
  UNION ALL
  SELECT id, 1000000, ref FROM item WHERE pos = 1 AND id % 4 = 0
),
way AS (
  SELECT refs.id, count(*) AS n, count(nd.id) AS located,
    string_agg(nd.lon || ' ' || nd.lat, ',' ORDER BY pos) AS body,
    string_agg('' || ref, ' ' ORDER BY pos) AS reftext,
    arg_min(ref, pos) = arg_max(ref, pos) AS closed
  FROM refs LEFT JOIN nd ON nd.id = refs.ref GROUP BY refs.id
),
road AS (
  SELECT o_orderkey AS id, CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'motorway'
    WHEN '2' THEN 'trunk' WHEN '3' THEN 'primary' ELSE 'zzz' END AS road
  FROM orders
),
tagged AS (SELECT way.*, road FROM way JOIN road USING (id))"""

_AREA = """
sq AS (
  SELECT s_suppkey AS id, s_suppkey % 30 * 10 - 150 AS x, s_suppkey % 15 * 10 - 75 AS y FROM supplier
),
area AS (
  SELECT id, 'MULTIPOLYGON (((' || x || ' ' || y || ',' || (x + 8) || ' ' || y || ',' || (x + 8) ||
    ' ' || (y + 8) || ',' || x || ' ' || (y + 8) || ',' || x || ' ' || y || ')' ||
    CASE WHEN id % 3 = 0 THEN ',(' || (x + 2) || ' ' || (y + 2) || ',' || (x + 2) || ' ' || (y + 4) ||
      ',' || (x + 4) || ' ' || (y + 4) || ',' || (x + 4) || ' ' || (y + 2) || ',' || (x + 2) || ' ' ||
      (y + 2) || ')' ELSE '' END || '))' AS geometry_wkt
  FROM sq
)"""

# --- Fixed values: the whitelist, as (category, value) -----------------------
_WHITELIST = """
allowed(category, sub_cat) AS (VALUES
  ('industrial', 'oil_well'), ('industrial', 'gas_well'), ('industrial', 'oil'), ('industrial', 'well'),
  ('industrial', 'refinery'), ('industrial', 'mine'), ('industrial', 'biogas_plant'),
  ('industrial', 'chemical'), ('industrial', 'works'), ('industrial', 'petroleum'),
  ('power', 'plant'), ('power', 'generator'), ('power', 'substation'), ('power', 'line'),
  ('power', 'minor_line'), ('power', 'cable'), ('power', 'transformer'), ('power', 'tower'),
  ('power', 'switch'), ('power', 'insulator'), ('power', 'storage_batteries'), ('power', 'converter'),
  ('military', 'base'), ('military', 'airfield'), ('military', 'barracks'), ('military', 'bunker'),
  ('military', 'checkpoint'), ('military', 'danger_area'), ('military', 'range'),
  ('military', 'training_area'), ('military', 'naval_base'), ('military', 'trench'),
  ('military', 'radar'), ('military', 'intelligence'), ('military', 'security_post'),
  ('military', 'nuclear_weapons_facility'),
  ('telecom', 'data_center'), ('telecom', 'exchange'), ('telecom', 'connection_point'),
  ('telecom', 'line'), ('telecom', 'tower'), ('telecom', 'mast'), ('telecom', 'satellite_station'),
  ('telecom', 'antenna'), ('telecom', 'wireless'),
  ('man_made', 'communications_tower'), ('man_made', 'mast'), ('man_made', 'water_tower'),
  ('man_made', 'storage_tank'), ('man_made', 'gasometer'), ('man_made', 'pipeline'),
  ('man_made', 'bunker'), ('man_made', 'radar'), ('man_made', 'monitoring_station'),
  ('man_made', 'submarine_cable_landing'), ('man_made', 'petroleum_refinery'), ('man_made', 'shipyard'),
  ('man_made', 'mineshaft'), ('man_made', 'hydrogen_tank'), ('man_made', 'antenna'),
  ('man_made', 'satellite_dish'), ('man_made', 'water_works'), ('man_made', 'wastewater_plant'),
  ('amenity', 'police'), ('amenity', 'prison'), ('amenity', 'courthouse'), ('amenity', 'embassy'),
  ('amenity', 'fire_station'), ('amenity', 'hospital'), ('amenity', 'townhall'), ('amenity', 'bank'),
  ('amenity', 'university'), ('amenity', 'fuel'), ('amenity', 'charging_station'),
  ('amenity', 'consulate'), ('amenity', 'customs'),
  ('office', 'government'), ('office', 'diplomatic'), ('office', 'telecommunication'),
  ('office', 'energy'), ('office', 'ngo'), ('office', 'lawyer'), ('office', 'security'),
  ('office', 'intelligence'),
  ('landuse', 'residential'), ('landuse', 'industrial'), ('landuse', 'commercial'),
  ('landuse', 'military'), ('landuse', 'institutional'), ('landuse', 'cemetery'),
  ('landuse', 'reservoir'), ('landuse', 'forest'), ('landuse', 'quarry'), ('landuse', 'port'),
  ('landuse', 'logistics'),
  ('building', 'government'), ('building', 'hospital'), ('building', 'industrial'),
  ('building', 'train_station'), ('building', 'bunker'), ('building', 'ruins'),
  ('building', 'warehouse'), ('building', 'data_center'), ('building', 'diplomatic'),
  ('building', 'security'),
  ('boundary', 'administrative'), ('boundary', 'maritime'), ('boundary', 'political'),
  ('boundary', 'disputed'), ('boundary', 'protected_area'), ('boundary', 'national_park'),
  ('place', 'city'), ('place', 'town'), ('place', 'village'), ('place', 'hamlet'), ('place', 'suburb'),
  ('place', 'neighbourhood'), ('place', 'island'), ('place', 'islet'),
  ('highway', 'motorway'), ('highway', 'trunk'), ('highway', 'primary'), ('highway', 'secondary'),
  ('highway', 'tertiary'), ('highway', 'unclassified'), ('highway', 'track'),
  ('highway', 'construction'),
  ('aeroway', 'aerodrome'), ('aeroway', 'helipad'), ('aeroway', 'heliport'), ('aeroway', 'runway'),
  ('aeroway', 'taxiway'), ('aeroway', 'apron'), ('aeroway', 'hangar'), ('aeroway', 'navigationaid'),
  ('railway', 'station'), ('railway', 'yard'), ('railway', 'junction'), ('railway', 'rail'),
  ('railway', 'subway'), ('railway', 'tram'), ('railway', 'light_rail'),
  ('waterway', 'river'), ('waterway', 'stream'), ('waterway', 'canal'), ('waterway', 'drain'),
  ('waterway', 'ditch'), ('waterway', 'dam'), ('waterway', 'lock'), ('waterway', 'waterfall'),
  ('natural', 'water'), ('natural', 'coastline'), ('natural', 'bay'), ('natural', 'beach'),
  ('natural', 'spring'), ('natural', 'peak'), ('natural', 'volcano'), ('natural', 'cliff'),
  ('natural', 'ridge'), ('natural', 'glacier'),
  ('harbour', 'port'), ('harbour', 'terminal'), ('harbour', 'quay'), ('harbour', 'marina'),
  ('harbour', 'dock'), ('harbour', 'yes'),
  ('barrier', 'border_control'), ('barrier', 'city_wall'), ('barrier', 'fence'),
  ('barrier', 'military_checkpoint'), ('barrier', 'toll_booth'), ('barrier', 'block'),
  ('barrier', 'security_fence'),
  ('emergency', 'ambulance_station'), ('emergency', 'siren'), ('emergency', 'bunker'),
  ('emergency', 'disaster_response'), ('emergency', 'water_rescue'), ('emergency', 'control_centre'),
  ('route', 'pipeline'), ('route', 'power'),
  ('shop', 'supermarket'), ('shop', 'mall'), ('shop', 'pharmacy'), ('shop', 'electronics'),
  ('shop', 'hardware'), ('shop', 'convenience'),
  ('tourism', 'hotel'), ('tourism', 'museum'), ('tourism', 'viewpoint'), ('tourism', 'attraction'),
  ('tourism', 'information'), ('tourism', 'gallery'),
  ('leisure', 'park'), ('leisure', 'stadium'), ('leisure', 'sports_centre'),
  ('leisure', 'swimming_pool'), ('leisure', 'marina'), ('leisure', 'garden'))"""
# --- End of fixed values ------------------------------------------------------

_LISTING = (
    _EV
    + """,
listing AS (
  SELECT cat AS category, good AS sub_cat_dir, user_id * 20 + id % 1500 AS bytes,
    CASE id % 3 WHEN 0 THEN '.parquet' WHEN 1 THEN '.geojson' ELSE '.db' END AS extension
  FROM ev
)"""
)

_KEY = "osm_id, osm_type, category, sub_cat"
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_SANITIZE = r"substring(regexp_replace(" + _TRIM + r", '[^-\p{{L}}\p{{N}}_.]', '_', 'g'), 1, 40)"


def _from(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _way_rows(where: str) -> str:
    return f"""SELECT id, reftext AS refs, road, 2::INTEGER AS version, '2024-02-01' AS day
      FROM tagged WHERE {where}"""


_ALL_TAGS = """('boundary','place','military','amenity','power','telecom','highway','aeroway',
  'railway','waterway','harbour','barrier','man_made','landuse','office','building','natural',
  'emergency','industrial','route')"""

_VALID_CASES = """CASE id % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'self_cross' WHEN 2 THEN 'short'
  WHEN 3 THEN 'open_ring' WHEN 4 THEN 'zero_area' WHEN 5 THEN 'hole_outside' ELSE 'empty' END"""


def _stream_pairs(select: str) -> str:
    return _from(_FEAT, f"SELECT {select} FROM rec")


def all_oracles() -> dict[str, str]:
    return {
        # scans and sources
        "scan_feature_lines": _from(
            _LINES,
            """SELECT value FROM line UNION ALL
            SELECT rtrim(value, ' ') FROM noise WHERE value <> ''""",
        ),
        "scan_oversize_guard": _from(
            _LINES, "SELECT value FROM line WHERE octet_length(encode(value)) <= 300"
        ),
        "scan_oversize_report": _from(
            _LINES,
            """SELECT count(*)::BIGINT AS oversize_lines FROM line
            WHERE octet_length(encode(value)) > 300""",
        ),
        "scan_malformed_drop": _from(
            _LINES, "SELECT CASE WHEN id % 97 = 0 THEN 'w' || id ELSE '' || id END AS raw_id FROM line"
        ),
        "scan_rejected_lines": _from(
            _LINES,
            """SELECT value, CASE kind WHEN 6 THEN 'unconvertible' ELSE 'no_geometry' END AS reason
            FROM line WHERE kind >= 6
            UNION ALL SELECT value, 'malformed' FROM noise WHERE value <> ''""",
        ),
        "scan_elements_parquet": _from(_WAY, _way_rows("true")),
        "scan_elements_json": _from(_WAY, _way_rows("true")),
        "scan_elements_xml": _from(_WAY, _way_rows("true")),
        "scan_staged_parts": _from(
            _FEAT,
            f"""SELECT {_KEY}, name, version, voltage, '' AS ref, '' AS height, geometry_wkt,
            geom_group, 'a' AS source FROM rec""",
        ),
        "scan_existing_ids": _from(_FEAT, "SELECT osm_id FROM rec"),
        "whitelist_coverage": _from(
            _FEAT + "," + _WHITELIST,
            """SELECT a.category, a.sub_cat, count(r.osm_id)::BIGINT AS features
            FROM allowed a LEFT JOIN rec r ON r.category = a.category AND r.sub_cat = a.sub_cat
            GROUP BY a.category, a.sub_cat""",
        ),
        "select_inputs": _from(
            _EV,
            """, f AS (SELECT cat AS category, CASE WHEN user_id % 4 <> 0 THEN '' || (user_id % 4) END AS part,
              (sum(id) * 7 % 200000)::BIGINT AS bytes FROM ev GROUP BY 1, 2)
            SELECT * FROM f WHERE bytes >= 102400 AND (part IS NOT NULL OR category NOT IN
              (SELECT category FROM f WHERE part IS NOT NULL AND bytes >= 102400))""",
        ),
        # filters
        "filter_elements": _from(
            _WAY,
            """, kept AS (SELECT id FROM tagged WHERE road <> 'zzz')
            SELECT 'way' AS kind, id FROM kept
            UNION ALL SELECT 'relation', s_suppkey FROM supplier
            UNION ALL SELECT 'node', id FROM nd WHERE id % 5 < 2 OR id IN
              (SELECT ref FROM refs WHERE id IN (SELECT id FROM kept))
            UNION ALL SELECT 'node', -1 - s_suppkey * 10 FROM supplier""",
        ),
        "filter_tag_presence": _from(
            _FEAT, "SELECT osm_id, 'man_made' AS tag FROM feat WHERE user_id % 5 = 0"
        ),
        "filter_subtags_three_states": _from(
            _FEAT,
            """SELECT osm_id, 'whitelist' AS state FROM feat WHERE cat = 'power' AND vc <> 2
            UNION ALL SELECT osm_id, 'all' FROM feat WHERE cat = 'power'
            UNION ALL SELECT osm_id, 'listed' FROM feat WHERE cat = 'landuse' AND vc <> 2
            UNION ALL SELECT osm_id, 'unknown_key' FROM feat WHERE id % 10 = 0""",
        ),
        "parse_subtags": _from(
            _EV,
            """SELECT id, CASE WHEN id % 5 = 0 THEN 0 ELSE 2 END::BIGINT AS n,
            CASE WHEN id % 5 = 0 THEN '' ELSE good || '|' || cat END AS subtags FROM ev""",
        ),
        "filter_missing_geometry": _from(_FEAT, "SELECT osm_id, geometry_type FROM feat"),
        "filter_min_vertices": _from(_WAY, "SELECT id FROM way WHERE n >= 3"),
        "split_closed_ways": _from(
            _WAY,
            """SELECT id, CASE WHEN closed THEN 'area' ELSE 'line' END AS kind FROM tagged
            WHERE NOT closed OR n >= 4""",
        ),
        "filter_bbox": _from(
            _FEAT,
            """SELECT osm_id, geometry_wkt FROM (SELECT *, CASE WHEN kind = 0 THEN 0
              WHEN kind IN (2, 4) THEN 2 ELSE 1 END AS d FROM feat)
            WHERE x + d >= -20 AND x <= 40.5 AND y + d >= -45 AND y <= 20""",
        ),
        "assign_lon_slices": _from(
            _EV, "SELECT id, least(3, floor((x + 180) / 90.0))::INTEGER AS slice_id FROM ev"
        ),
        "geometry_issues": _from(_EV, f"SELECT id, {_VALID_CASES} AS issue FROM ev"),
        "filter_valid_geometry": _from(_EV, "SELECT id FROM ev WHERE id % 7 = 0"),
        # projections and scalar functions
        "norm_value": """SELECT doc_id, lower(source) || ' ' || lower(lang) AS value FROM documents""",
        "parse_id": """SELECT event_id, CASE WHEN event_id % 3 = 1 THEN 0 ELSE event_id END AS osm_id
            FROM events""",
        "object_types": _from(_FEAT, "SELECT osm_id, geometry_type, osm_type FROM feat"),
        "geom_groups": _from(_FEAT, "SELECT osm_id, category, osm_type, geom_group FROM rec"),
        "name_fallback": _from(_FEAT, "SELECT osm_id, category, name FROM rec"),
        "paired_key_fallback": _from(
            _FEAT, "SELECT osm_id, category, plant_source, strat_level FROM rec"
        ),
        "attribute_pick": _from(
            _FEAT,
            """SELECT osm_id, category, admin_level, operator, voltage, '' AS access, '' AS ref
            FROM rec""",
        ),
        "edit_metadata": _from(
            _FEAT,
            """SELECT osm_id, category, version, timestamp, "user", changeset,
            CASE WHEN timestamp <> '' THEN substring(timestamp, 1, 10) END AS edited_on FROM rec""",
        ),
        "tags_json": _from(_FEAT, "SELECT osm_id, category, tags FROM rec"),
        "geojson_to_wkt": _from(_FEAT, "SELECT osm_id, geometry_wkt FROM feat"),
        "wkt_to_coords": _from(
            _FEAT,
            """SELECT osm_id, upper(geometry_type) AS wkt_type,
            CASE WHEN kind IN (3, 5) THEN 2 ELSE 1 END::BIGINT AS rings,
            CASE kind WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 3 THEN 4 WHEN 5 THEN 3 ELSE 5 END::BIGINT AS points,
            CASE kind WHEN 0 THEN x WHEN 1 THEN 2 * x + 1 WHEN 3 THEN 4 * x + 2 WHEN 5 THEN 3 * x + 1 ELSE 5 * x + 4
              END::BIGINT AS sum_x,
            CASE kind WHEN 0 THEN y WHEN 1 THEN 2 * y + 1 WHEN 3 THEN 4 * y + 2 WHEN 5 THEN 3 * y + 1 ELSE 5 * y + 4
              END::BIGINT AS sum_y
            FROM feat""",
        ),
        "encode_wkt": _from(_FEAT, "SELECT osm_id, geometry_wkt FROM feat"),
        "encode_wkb": _from(
            _FEAT,
            """SELECT osm_id, geometry_wkt, CASE kind WHEN 0 THEN 21 WHEN 1 THEN 41 WHEN 2 THEN 93
            WHEN 3 THEN 91 WHEN 4 THEN 102 ELSE 71 END::BIGINT AS bytes FROM feat""",
        ),
        "sanitize_names": f"""SELECT 'page' AS kind, page_id AS id, {_SANITIZE.format('url')} AS name
            FROM pages UNION ALL
            SELECT 'doc', doc_id, {_SANITIZE.format('text')} FROM documents""",
        "source_labels": """SELECT page_id, 'filtered_' || (page_id % 9) || '_ü' AS source FROM pages""",
        "conform_schema": _from(
            _EV,
            """SELECT id AS osm_id, '' AS osm_type, CASE WHEN id % 2 = 0 THEN good ELSE '' END AS name,
            cat AS category, '' AS sub_cat, '' AS admin_level, '' || user_id AS version,
            '' AS timestamp, '' AS "user", '' AS changeset, '' AS tags, '' AS operator, '' AS ref,
            '' AS substance, '' AS plant_source, '' AS voltage, '' AS industrial,
            '' AS communication, '' AS telecom, '' AS capacity, '' AS resource, '' AS access,
            '' AS security, '' AS frequency, '' AS height, '' AS strat_level, '' AS geometry_wkt,
            '' AS geom_group FROM ev""",
        ),
        "short_names": _from(
            _FEAT,
            """SELECT osm_id, category, admin_level AS adm_lvl, timestamp AS ts, changeset AS chgset,
            plant_source AS p_src, '' AS indus, '' AS comms, '' AS telcom, strat_level AS strat_leve,
            geometry_wkt AS geometry_w FROM rec""",
        ),
        # geometry assembly
        "node_points": _from(
            _WAY, "SELECT id, 'POINT (' || lon || ' ' || lat || ')' AS geometry_wkt FROM nd"
        ),
        "way_lines": _from(
            _WAY, "SELECT id, 'LINESTRING (' || body || ')' AS geometry_wkt FROM tagged WHERE n >= 2"
        ),
        "way_lines_of_copies": _from(
            _WAY, "SELECT id, 'LINESTRING (' || body || ')' AS geometry_wkt FROM tagged WHERE n >= 2"
        ),
        "way_areas": _from(
            _WAY,
            """SELECT id, 'MULTIPOLYGON (((' || body || ')))' AS geometry_wkt FROM tagged
            WHERE closed AND n >= 4""",
        ),
        "way_geometries": _from(
            _WAY,
            """SELECT id, 'way' AS osm_type, 'LINESTRING (' || body || ')' AS geometry_wkt FROM tagged
            WHERE NOT closed AND n >= 2
            UNION ALL SELECT id, 'area', 'MULTIPOLYGON (((' || body || ')))' FROM tagged
            WHERE closed AND n >= 4""",
        ),
        "relation_areas": _from(_AREA, "SELECT id, geometry_wkt FROM area"),
        "resolved_ways": _from(
            _WAY,
            """SELECT id FROM tagged WHERE n >= 2
            AND id NOT IN (SELECT id FROM refs WHERE ref % 501 = 0)""",
        ),
        "unresolved_refs": """
            WITH item AS (
              SELECT l_orderkey AS id, l_partkey AS ref, count(*) OVER (PARTITION BY l_orderkey) AS n,
                row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos
              FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
            )
            SELECT id, CAST(pos - 1 AS INTEGER) AS pos, ref FROM item WHERE ref % 501 = 0
            UNION ALL
            SELECT id, CAST(n AS INTEGER), ref FROM item WHERE pos = 1 AND id % 4 = 0 AND ref % 501 = 0""",
        # joins and set operations
        "new_only": _from(
            _FEAT,
            f"SELECT {_KEY} FROM rec WHERE osm_id NOT IN (SELECT event_id FROM events WHERE event_id % 7 = 0)",
        ),
        "whitelisted": _from(_FEAT, "SELECT osm_id, category, sub_cat FROM rec"),
        "fan_out": _from(_FEAT, "SELECT osm_id, category, sub_cat FROM pairs"),
        "union_parts": _from(
            _FEAT,
            f"""SELECT {_KEY}, CASE WHEN osm_type = 'node' THEN name ELSE '' END AS name,
            CASE WHEN osm_type = 'node' THEN '' ELSE voltage END AS voltage FROM rec""",
        ),
        "missing_outputs": _from(
            _LISTING + "," + _WHITELIST,
            f"""SELECT category, sub_cat FROM allowed a WHERE category IN {_ALL_TAGS}
            AND NOT EXISTS (SELECT 1 FROM listing l WHERE l.category = a.category
              AND l.sub_cat_dir = a.sub_cat AND l.category <> 'highway' AND l.bytes > 1024
              AND l.extension IN ('.parquet', '.geojson'))""",
        ),
        "plan_run": _from(
            _LISTING + "," + _WHITELIST,
            f"""SELECT category, sub_cat, 'standard' AS mode FROM allowed a
            WHERE category IN {_ALL_TAGS} AND NOT EXISTS (SELECT 1 FROM listing l
              WHERE l.category = a.category AND l.category <> 'highway' AND l.bytes > 1024)
            UNION ALL
            SELECT category, sub_cat, 'detailed' FROM allowed a
            WHERE category IN {_ALL_TAGS} AND NOT EXISTS (SELECT 1 FROM listing l
              WHERE l.category = a.category AND l.sub_cat_dir = a.sub_cat
              AND l.category <> 'highway' AND l.bytes > 1024 AND l.extension = '.parquet')""",
        ),
        "drop_stale": _from(
            _FEAT, f"SELECT {_KEY} FROM rec WHERE sub_cat IN ('tower', 'forest', 'bank')"
        ),
        # aggregation and de-duplication
        "dedupe": _from(
            _FEAT, "SELECT osm_id, osm_type, category, name, geometry_wkt, source FROM uniq"
        ),
        "dedupe_keep_unidentified": _from(
            _FEAT,
            """SELECT category, osm_type, osm_id = 0 AS unidentified,
            count(DISTINCT CASE WHEN osm_id = 0 THEN geometry_wkt || tags ELSE '' || osm_id END)::BIGINT AS n
            FROM twice GROUP BY 1, 2, 3""",
        ),
        "routing_keys": _from(_FEAT, "SELECT DISTINCT category, sub_cat, geom_group FROM rec"),
        "run_report": _from(
            _FEAT,
            """SELECT category, sub_cat, geom_group, count(*)::BIGINT AS records FROM twice
            GROUP BY 1, 2, 3""",
        ),
        "part_summary": _from(
            _EV,
            """SELECT good || '_points_src' || (user_id % 3) AS prefix, count(*)::BIGINT AS parts
            FROM ev GROUP BY 1""",
        ),
        "plan_slices": _from(
            _EV,
            """, n AS (SELECT ceil(count(*) / 150.0) AS n FROM ev)
            SELECT slice_id, rows, round(slice_id * 360.0::DOUBLE / (SELECT n FROM n) - 180, 6) AS min_lon
            FROM (SELECT least(n - 1, floor((x + 180) / (360.0::DOUBLE / n)))::INTEGER AS slice_id,
              count(*)::BIGINT AS rows FROM ev, n GROUP BY 1) WHERE rows >= 40""",
        ),
        "geometry_interior_split": """SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN 'interior_split' ELSE 'ok' END AS issue
            FROM events""",
        "relation_faults": """
            WITH s AS (SELECT s_suppkey AS id, s_suppkey * 10 AS b FROM supplier)
            SELECT id, 'open_end' AS fault, b + 1 AS point, '' || b AS members FROM s WHERE id % 7 = 0
            UNION ALL SELECT id, 'open_end', b + 2, '' || (b + 1) FROM s WHERE id % 7 = 0
            UNION ALL SELECT id, 'open_end', b + 4, '' || (b + 2) FROM s WHERE id % 7 = 1 AND id % 3 = 0
            UNION ALL SELECT id, 'open_end', b + 7, '' || (b + 2) FROM s WHERE id % 7 = 1 AND id % 3 = 0
            UNION ALL SELECT id, 'missing_way', NULL, '' || (b + 1) FROM s WHERE id % 7 = 2
            UNION ALL SELECT id, 'open_end', b, '' || b FROM s WHERE id % 7 = 2
            UNION ALL SELECT id, 'open_end', b + 2, '' || b FROM s WHERE id % 7 = 2""",
        "plan_slices_balanced": """SELECT count(*)::BIGINT AS rows, 0::BIGINT AS wrong, 0::BIGINT AS over, 0::BIGINT AS repeated
            FROM events""",
        "output_manifest": _from(
            _LISTING,
            """SELECT category, sub_cat_dir, string_agg(DISTINCT extension, ' ' ORDER BY extension)
              AS extensions FROM listing WHERE bytes > 1024 GROUP BY 1, 2""",
        ),
        "validate_files": _from(
            _LISTING,
            """, t(category) AS (VALUES ('power'), ('military'), ('amenity'), ('highway'), ('landuse'),
              ('man_made')),
            s AS (SELECT category, max(bytes) - 2000 AS bytes FROM listing WHERE category <> 'landuse'
              GROUP BY 1)
            SELECT t.category, s.bytes, CASE WHEN s.bytes IS NULL THEN 'missing'
              WHEN s.bytes < 1024 THEN 'corrupt' ELSE 'ok' END AS status
            FROM t LEFT JOIN s USING (category)""",
        ),
        "validate_inputs": _from(
            _FEAT,
            """, t(category) AS (VALUES ('power'), ('military'), ('amenity'), ('highway'), ('landuse'),
              ('man_made'), ('place')),
            s AS (SELECT category, count(*) AS records,
              count(*) - count(DISTINCT osm_id || osm_type) AS repeated FROM twice GROUP BY 1)
            SELECT t.category, coalesce(records, 0)::BIGINT AS records, 0::BIGINT AS broken,
              coalesce(repeated, 0)::BIGINT AS repeated, CASE WHEN records IS NULL THEN 'missing'
              WHEN repeated > 0 THEN 'corrupt' ELSE 'ok' END AS status
            FROM t LEFT JOIN s USING (category)""",
        ),
        # order and sinks
        "chunked_output": _from(
            _FEAT, "SELECT count(*)::BIGINT AS rows, true AS within_limit FROM rec"
        ),
        "write_parts": _from(_FEAT, f"SELECT {_RECORD}, 'a' AS source FROM rec"),
        "write_parquet": _from(_FEAT, f"SELECT {_KEY}, name, geom_group, geometry_wkt FROM rec"),
        "write_table": _from(_FEAT, f"SELECT {_KEY}, name, geometry_wkt FROM rec"),
        "write_geojson": _from(
            _FEAT, "SELECT osm_id, category, name, geometry_type, geometry_wkt FROM rec"
        ),
        "write_short": _from(
            _FEAT,
            """SELECT osm_id, category, admin_level AS adm_lvl, changeset AS chgset,
            geometry_wkt AS geometry_w FROM rec""",
        ),
        "write_all_formats": _from(
            _FEAT,
            """, n AS (SELECT count(*)::BIGINT AS rows FROM rec),
            f(format) AS (VALUES ('parquet'), ('geojson'), ('table'), ('short'), ('unknown'))
            SELECT format, CASE format WHEN 'unknown' THEN 'failed' ELSE 'ok' END AS status,
            CASE format WHEN 'unknown' THEN 0 ELSE rows END::BIGINT AS rows FROM f, n""",
        ),
        # streams
        "stream_ingest": _stream_pairs(f"{_KEY}, name, geometry_wkt"),
        "stream_batches": "SELECT count(*) > 0 AS one_batch_per_file FROM events",
        "stream_dedupe": _stream_pairs("DISTINCT category, osm_id, osm_type"),
        "stream_upsert_replay": _stream_pairs("DISTINCT category, osm_id, osm_type"),
        "stream_resume": _stream_pairs(_KEY),
        "stream_dedupe_ttl": _from(
            _FEAT,
            """SELECT category, osm_id, osm_type, CASE WHEN osm_id % 3 = 0 AND osm_id <> 0 THEN 7 ELSE 5 END::BIGINT AS version,
              (count(*) - 1 + CASE WHEN osm_id % 3 = 1 THEN 1 ELSE 0 END)::BIGINT AS late
            FROM rec GROUP BY category, osm_id, osm_type""",
        ),
        "stream_upsert_versions": _from(
            _FEAT,
            f"""SELECT {_KEY}, CASE WHEN osm_id % 3 = 0 AND osm_id % 4 = 0 AND osm_id <> 0 THEN 'new' || osm_id ELSE name END AS name,
              CASE WHEN osm_id % 3 = 0 AND osm_id <> 0 THEN '7' ELSE '5' END AS version, geometry_wkt
            FROM (SELECT *, row_number() OVER (PARTITION BY category, osm_id, osm_type
              ORDER BY geometry_wkt, sub_cat, tags, timestamp, "user", changeset) AS rn FROM rec) WHERE rn = 1""",
        ),
        # whole jobs
        "profile_selection": _from(
            _FEAT,
            """SELECT category, count(*)::BIGINT AS n, profile FROM rec JOIN (VALUES
              ('full', 'power'), ('full', 'military'), ('full', 'amenity'), ('full', 'highway'),
              ('full', 'landuse'), ('full', 'man_made'), ('core', 'power'), ('core', 'military'),
              ('core', 'amenity'), ('infrastructure', 'highway'), ('landuse, man_made', 'landuse'),
              ('landuse, man_made', 'man_made')) p(profile, key) ON p.key = rec.category
            GROUP BY category, profile""",
        ),
        "extract_features": _from(
            _FEAT,
            f"""SELECT {_RECORD}, source FROM uniq
            WHERE osm_id NOT IN (SELECT event_id FROM events WHERE event_id % 7 = 0)""",
        ),
        "extract_all_values": _from(
            _FEAT,
            f"""SELECT {_KEY} FROM (SELECT *, row_number() OVER (PARTITION BY category, osm_id, osm_type
              ORDER BY try_cast(version AS BIGINT) DESC NULLS LAST, geometry_wkt) AS rn FROM pairs
              WHERE category IN ('power', 'landuse')) WHERE rn = 1""",
        ),
        "extract_one_key": _from(_FEAT, f"SELECT {_KEY} FROM uniq WHERE category = 'power'"),
        "merge_staged": _from(
            _FEAT,
            f"""SELECT {_KEY}, name, geometry_wkt, source FROM uniq
            WHERE osm_id NOT IN (SELECT event_id FROM events WHERE event_id % 7 = 0)""",
        ),
        "extract_run_twice": _from(
            _FEAT,
            f"""SELECT {_KEY} FROM (SELECT *, row_number() OVER (PARTITION BY category, osm_id, osm_type
              ORDER BY id % 2) AS rn FROM rec) WHERE rn = 1""",
        ),
        "extract_elements": _from(
            _WAY + "," + _AREA,
            """SELECT id AS osm_id, 'way' AS osm_type, 'highway' AS category, road AS sub_cat,
              'W' || id AS name, '2' AS version, '2024-02-01 00:00:00+00:00' AS timestamp,
              'unknown' AS "user", '0' AS changeset,
              '{"highway":"' || road || '","name":"W' || id || '"}' AS tags,
              'LINESTRING (' || body || ')' AS geometry_wkt, 'lines' AS geom_group, 'way' AS src_type
            FROM tagged WHERE NOT closed AND n >= 2 AND road <> 'zzz'
            UNION ALL
            SELECT id, 'area', 'highway', road, 'W' || id, '2', '2024-02-01 00:00:00+00:00', 'unknown',
              '0', '{"highway":"' || road || '","name":"W' || id || '"}',
              'MULTIPOLYGON (((' || body || ')))', 'polygons', 'way'
            FROM tagged WHERE closed AND n >= 4 AND road <> 'zzz'
            UNION ALL
            SELECT id, 'node', 'power', 'tower', 'N' || id, '1', '2024-01-01 00:00:00+00:00',
              CASE WHEN id % 2 = 0 THEN 'u' || (id % 7) ELSE 'unknown' END, '' || (id * 2),
              '{"power":"tower","name":"N' || id || '"}', 'POINT (' || lon || ' ' || lat || ')',
              'points', 'node'
            FROM nd WHERE id % 5 = 0
            UNION ALL
            SELECT id, 'area', 'landuse', 'forest', 'R' || id, '1', '2024-03-01 00:00:00+00:00', 'm',
              '9', '{"type":"multipolygon","landuse":"forest","name":"R' || id || '"}', geometry_wkt,
              'polygons', 'relation'
            FROM area""",
        ),
        "element_changes": """
            WITH nd AS (
              SELECT p_partkey AS id, p_partkey % 360 - 180 + CASE WHEN p_partkey % 7 = 1 THEN 1 ELSE 0 END AS lon, p_size AS lat,
                CASE WHEN p_partkey % 97 = 3 THEN 'plant' WHEN p_partkey % 5 = 0 THEN 'tower' END AS power
              FROM part WHERE p_partkey % 501 <> 0
            ), item AS (
              SELECT l_orderkey AS id, l_partkey AS ref, count(*) OVER (PARTITION BY l_orderkey) AS n,
                row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos
              FROM lineitem
            ), refs AS (
              SELECT id, pos, ref FROM item UNION ALL SELECT id, n + 1, ref FROM item WHERE pos = 1 AND id % 4 = 0
            ), way AS (
              SELECT refs.id, count(*) AS n, count(nd.id) AS located, arg_min(ref, pos) = arg_max(ref, pos) AS closed,
                string_agg(nd.lon || ' ' || nd.lat, ',' ORDER BY pos) AS body
              FROM refs LEFT JOIN nd ON nd.id = refs.ref
              WHERE refs.id % 9 <> 0 AND (refs.id % 9 <> 2 OR pos <= 2) GROUP BY refs.id
            ), tagged AS (
              SELECT way.*, CASE WHEN id % 9 = 1 THEN 'trunk' ELSE CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'motorway'
                WHEN '2' THEN 'trunk' WHEN '3' THEN 'primary' END END AS road
              FROM way JOIN orders ON o_orderkey = id WHERE located = n
            ), sq AS (
              SELECT s_suppkey AS id, s_suppkey % 30 * 10 - 150 + CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS x,
                s_suppkey % 15 * 10 - 75 AS y FROM supplier WHERE s_suppkey % 5 <> 0
            )
            SELECT id AS osm_id, 'node' AS osm_type, 'power' AS category, power AS sub_cat, 'node' AS src_type,
              'POINT (' || lon || ' ' || lat || ')' AS geometry_wkt FROM nd WHERE power IS NOT NULL
            UNION ALL
            SELECT id, 'way', 'highway', road, 'way', 'LINESTRING (' || body || ')' FROM tagged
            WHERE NOT closed AND n >= 2 AND road IS NOT NULL
            UNION ALL
            SELECT id, 'area', 'highway', road, 'way', 'MULTIPOLYGON (((' || body || ')))' FROM tagged
            WHERE closed AND n >= 4 AND road IS NOT NULL
            UNION ALL
            SELECT id, 'area', 'landuse', CASE WHEN id % 5 = 1 THEN 'quarry' ELSE 'forest' END, 'relation',
              'MULTIPOLYGON (((' || x || ' ' || y || ',' || (x + 8) || ' ' || y || ',' || (x + 8) || ' ' || (y + 8) || ',' ||
              x || ' ' || (y + 8) || ',' || x || ' ' || y || ')' ||
              CASE WHEN id % 3 = 0 THEN ',(' || (x + 2) || ' ' || (y + 2) || ',' || (x + 2) || ' ' || (y + 4) || ',' ||
                (x + 4) || ' ' || (y + 4) || ',' || (x + 4) || ' ' || (y + 2) || ',' || (x + 2) || ' ' || (y + 2) || ')' ELSE '' END || '))'
            FROM sq""",
        "extract_elements_clean": _from(
            _WAY + "," + _AREA,
            """SELECT id + 10000000 AS osm_id, 'node' AS osm_type, 'power' AS category,
              'tower' AS sub_cat, 'N' || id AS name, 'POINT (' || lon || ' ' || lat || ')' AS geometry_wkt,
              'node' AS src_type FROM nd WHERE id % 5 = 0
            UNION ALL
            SELECT id, 'area', 'landuse', 'forest', 'R' || id, geometry_wkt, 'relation' FROM area""",
        ),
        "geojson_to_wkt_nested": _from(
            _EV,
            """SELECT id AS osm_id, repeat('GEOMETRYCOLLECTION (POINT (3 4),', id % 7) ||
              'POINT (' || x || ' ' || y || ')' || repeat(')', id % 7) AS geometry_wkt FROM ev""",
        ),
        "extract_key_count_invariant": _from(
            _FEAT,
            f"""SELECT {_KEY}, k AS keys FROM rec, (VALUES ('one'), ('all')) AS t(k)
            WHERE category = 'power'""",
        ),
        "validate_lines_deep": _from(
            _LINES,
            """SELECT reason, count(*)::BIGINT AS lines FROM (
              SELECT CASE kind WHEN 6 THEN 'unconvertible' ELSE 'no_geometry' END AS reason FROM line WHERE kind >= 6
              UNION ALL SELECT 'malformed' FROM noise WHERE value <> '') GROUP BY 1""",
        ),
        "element_records_of_copies": _from(
            _WAY,
            """, gone AS (SELECT id FROM nd WHERE id % 501 = 0),
            opened AS (
              SELECT item.id, count(*) AS n, string_agg(nd.lon || ' ' || nd.lat, ',' ORDER BY pos) AS body,
                arg_min(ref, pos) = arg_max(ref, pos) AS closed
              FROM item JOIN nd ON nd.id = item.ref GROUP BY item.id
            ),
            latest AS (
              SELECT id, n, body, closed FROM tagged WHERE road <> 'zzz' AND id % 10 NOT IN (1, 2, 4)
              UNION ALL
              SELECT opened.* FROM opened JOIN road USING (id) WHERE road <> 'zzz' AND id % 10 = 4
            )
            SELECT id AS osm_id, CASE WHEN closed THEN 'area' ELSE 'way' END AS osm_type,
              CASE WHEN closed THEN 'MULTIPOLYGON (((' || body || ')))' ELSE 'LINESTRING (' || body || ')' END
                AS geometry_wkt
            FROM latest WHERE n >= CASE WHEN closed THEN 4 ELSE 2 END
              AND id NOT IN (SELECT id FROM item WHERE ref IN (SELECT id FROM gone))
            UNION ALL
            SELECT id, 'node', 'POINT (' || lon || ' ' || lat || ')' FROM nd WHERE id % 5 = 0 AND id % 501 <> 0""",
        ),
        "relation_areas_touching": """
            WITH sq AS (
              SELECT s_suppkey AS id, s_suppkey % 30 * 10 - 150 AS x, s_suppkey % 15 * 10 - 75 AS y FROM supplier
            ), corner AS (
              SELECT * FROM (VALUES
                (0, 1, 1, 1, 0, 0), (0, 1, 1, 2, 4, 0), (0, 1, 1, 3, 4, 4), (0, 1, 1, 4, 0, 4), (0, 1, 1, 5, 0, 0),
                (0, 2, 1, 1, 4, 4), (0, 2, 1, 2, 8, 4), (0, 2, 1, 3, 8, 8), (0, 2, 1, 4, 4, 8), (0, 2, 1, 5, 4, 4),
                (1, 1, 1, 1, 0, 0), (1, 1, 1, 2, 6, 0), (1, 1, 1, 3, 6, 6), (1, 1, 1, 4, 4, 6), (1, 1, 1, 5, 4, 2),
                (1, 1, 1, 6, 2, 2), (1, 1, 1, 7, 2, 6), (1, 1, 1, 8, 0, 6), (1, 1, 1, 9, 0, 0),
                (1, 2, 1, 1, 2, 6), (1, 2, 1, 2, 3, 4), (1, 2, 1, 3, 4, 6), (1, 2, 1, 4, 2, 6),
                (2, 1, 1, 1, 0, 0), (2, 1, 1, 2, 8, 0), (2, 1, 1, 3, 8, 8), (2, 1, 1, 4, 0, 8), (2, 1, 1, 5, 0, 0),
                (2, 1, 2, 1, 2, 2), (2, 1, 2, 2, 2, 6), (2, 1, 2, 3, 6, 6), (2, 1, 2, 4, 6, 2), (2, 1, 2, 5, 2, 2),
                (2, 2, 1, 1, 3, 3), (2, 2, 1, 2, 5, 3), (2, 2, 1, 3, 5, 5), (2, 2, 1, 4, 3, 5), (2, 2, 1, 5, 3, 3)
              ) AS t(shape, polygon, ring, k, dx, dy)
            ), ring AS (
              SELECT id, polygon, ring,
                '(' || string_agg((x + dx) || ' ' || (y + dy), ',' ORDER BY k) || ')' AS body
              FROM sq JOIN corner ON shape = id % 3 GROUP BY ALL
            ), polygons AS (
              SELECT id, polygon, '(' || string_agg(body, ',' ORDER BY ring) || ')' AS body FROM ring GROUP BY ALL
            )
            SELECT id, 'MULTIPOLYGON (' || string_agg(body, ',' ORDER BY polygon) || ')' AS geometry_wkt
            FROM polygons GROUP BY id""",
        "filter_elements_nested": """
            WITH s AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 10 < 5)
            SELECT 'relation' AS kind, id FROM s
            UNION ALL SELECT 'way', id * 10 FROM s
            UNION ALL SELECT 'node', id * 10 + k FROM s, (VALUES (0), (1), (2)) AS t(k)""",
        "second_format_later": _from(
            _FEAT, f"SELECT {_KEY}, f AS format FROM uniq, (VALUES ('parquet'), ('geojson')) AS t(f)"
        ),
        "unidentified_two_runs": _from(
            _FEAT,
            """SELECT category, geometry_wkt, count(*)::BIGINT AS n FROM (
              SELECT DISTINCT category, osm_type, geometry_wkt, tags FROM rec WHERE osm_id = 0
            ) GROUP BY 1, 2""",
        ),
        "incremental_run": _from(_FEAT, f"SELECT {_KEY} FROM uniq"),
        "run_element_job": _from(
            _WAY + "," + _AREA,
            """SELECT id + 10000000 AS osm_id, 'node' AS osm_type, 'power' AS category,
              'tower' AS sub_cat, 'N' || id AS name, 'node' AS src_type FROM nd WHERE id % 5 = 0
            UNION ALL
            SELECT id, 'area', 'landuse', 'forest', 'R' || id, 'relation' FROM area""",
        ),
        "staged_summary": _from(
            _FEAT,
            """SELECT DISTINCT val || '_' || geom_group || '_a' AS prefix FROM rec WHERE category <> 'man_made'
            UNION SELECT DISTINCT 'mast_' || geom_group || '_a' FROM rec WHERE category = 'man_made'""",
        ),
        "scan_element_kinds": _from(
            _WAY,
            """SELECT kind, format, id, body, name, version FROM (
              SELECT 'node' AS kind, id, lon || ' ' || lat AS body,
                CASE WHEN id % 5 = 0 THEN 'N' || id ELSE '' END AS name, 1 AS version FROM nd
              UNION ALL
              SELECT 'relation', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'way:' || (s_suppkey * 10 + 2) || ':inner '
                ELSE '' END || 'way:' || (s_suppkey * 10 + 1) || ':outer way:' || (s_suppkey * 10) || ':outer node:' ||
                (s_suppkey * 10) || ':label', 'R' || s_suppkey, 1 FROM supplier
            ), (VALUES ('parquet'), ('json'), ('xml')) AS t(format)""",
        ),
        "filter_bbox_stored": _from(
            _FEAT,
            """SELECT osm_id, geometry_wkt FROM (SELECT *, CASE WHEN kind = 0 THEN 0
              WHEN kind IN (2, 4) THEN 2 ELSE 1 END AS d FROM feat)
            WHERE x + d >= -20 AND x <= 40.5 AND y + d >= -45 AND y <= 20""",
        ),
        "feature_counts": _from(
            _FEAT,
            """SELECT category, sub_cat, geom_group, count(*)::BIGINT AS records FROM uniq
            WHERE category IN ('power', 'military') GROUP BY 1, 2, 3""",
        ),
    }
