"""Queries: ingest resolution, dimension upkeep, migration maps, merging and removing."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.operators import ingest
from airloom.plans.frames import AS_OF
from airloom.plans.registry import query

_KEYS = """SELECT DISTINCT lower(p_type) AS key, CAST(CASE WHEN p_type LIKE 'E%' THEN 1 WHEN p_type LIKE 'P%' THEN 3 ELSE 5 END AS INT) AS measurands_id,
  '' AS units, 'x' AS source_name FROM {part}"""

_SPLIT = """CASE WHEN len(string_split(ingest_id, '-')) < 3 THEN 'N/A' ELSE array_to_string(string_split(ingest_id, '-')[2:-2], '-') END"""


@query(
    "split_ingest_id", "p_partkey:i source_name:s source_id:s parameter:s",
    f"""SELECT p_partkey, string_split(ingest_id, '-')[1] AS source_name, {_SPLIT} AS source_id, string_split(ingest_id, '-')[-1] AS parameter FROM {{ingest_ids}}""",
)
def _(f):
    return ingest.split_ingest_id(f.ingest_ids)


_MAP_VIEW = "SELECT measurands_id, key FROM {keys} UNION ALL SELECT DISTINCT measurands_id, measurand || units AS key FROM {measurands}"


@query("measurands_map_view", "measurands_id:i key:s", _MAP_VIEW, {"keys": _KEYS})
def _(f):
    return ingest.measurands_map_view(f.sql(_KEYS), f.measurands)


@query(
    "check_ingest_id", "p_partkey:i ingest_id:s source_name:s source_id:s parameter:s measurands_id:i measurand:s units:s",
    f"""SELECT p_partkey, ingest_id, string_split(ingest_id, '-')[1] AS source_name, {_SPLIT} AS source_id, string_split(ingest_id, '-')[-1] AS parameter,
      m.measurands_id, m.measurand, m.units FROM {{ingest_ids}} i LEFT JOIN {{map_view}} v ON v.key = string_split(i.ingest_id, '-')[-1]
    LEFT JOIN {{measurands}} m ON m.measurands_id = v.measurands_id""", {"keys": _KEYS, "map_view": _MAP_VIEW},
)
def _(f):
    return ingest.check_ingest_id(f.ingest_ids, f.sql(_KEYS), f.measurands)


_ISO = """strftime(datetime, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(datetime) % 1000000 = 0 THEN '' ELSE '.' || rtrim(strftime(datetime, '%f'), '0') END || '+00:00'"""
for _name, _facts in (("measurements_ingest_format", "measurements"), ("analyses_ingest_format", "measurements_long")):
    query(
        _name, "id:i ingest_id:s value:f datetime:s lon:f lat:f",
        f"""SELECT n.sensor_nodes_id AS id, n.source_name || '-' || s.source_id || '-' || p.measurand AS ingest_id, m.value, {_ISO} AS datetime, m.lon, m.lat
    FROM {{{_facts}}} m JOIN {{sensors}} s ON s.sensors_id = m.sensors_id JOIN {{measurands}} p ON p.measurands_id = s.measurands_id
    JOIN {{sensor_systems}} y ON y.sensor_systems_id = s.sensor_systems_id JOIN {{sensor_nodes}} n ON n.sensor_nodes_id = y.sensor_nodes_id""",
    )(lambda f, facts=_facts: ingest.ingest_format(getattr(f, facts), f.sensors, f.sensor_systems, f.sensor_nodes, f.measurands))


# staged mobile rows: parts of unknown stations, customers' segments as source names
_STAGED = """SELECT concat(c_mktsegment, '-', c_mktsegment, '/', CAST(user_id + (event_id % 3) * 1000000 AS STRING), '-', event_type) AS ingest_id, value, ts AS datetime,
  CAST(user_id % 360 - 180 AS DOUBLE) AS lon, CAST(user_id % 160 - 80 AS DOUBLE) AS lat FROM {events} JOIN {customer} ON c_custkey = user_id"""
_STATION = """SELECT DISTINCT ingest_id, string_split(ingest_id, '-')[1] AS source_name, string_split(ingest_id, '-')[2] AS source_id, string_split(ingest_id, '-')[3] AS parameter FROM {staged}"""
_RESOLVED = """SELECT st.ingest_id, n.sensor_nodes_id AS known_node, m.measurands_id FROM {station} st
  LEFT JOIN {sensor_nodes} n ON n.source_name = st.source_name AND n.source_id = st.source_id LEFT JOIN {measurands} m ON m.measurand = st.parameter"""


def _mobile(f):
    staged = f.sql(_STAGED)
    empty = f.measurements.select("sensors_id", "datetime", "value", "lon", "lat").where(F.lit(False))
    return ingest.resolve_mobile_ingest(staged, f.sensor_nodes, f.sensor_systems, f.sensors, f.measurands, empty)


@query(
    "resolve_mobile_ingest", "ingest_id:s known_node:i is_new:b measurands_id:i",
    """SELECT ingest_id, known_node, known_node IS NULL AS is_new, measurands_id FROM {resolved}""",
    {"staged": _STAGED, "station": _STATION, "resolved": _RESOLVED},
)
def _(f):
    stations = _mobile(f)["stations"]
    top = f.sensor_nodes.agg(F.max("sensor_nodes_id")).scalar()
    new = F.col("sensor_nodes_id") > top
    return stations.select("ingest_id", F.when(~new, F.col("sensor_nodes_id")).alias("known_node"), new.alias("is_new"), "measurands_id")


@query(
    "resolve_mobile_ingest_ids", "table_name:s n:i lowest:i highest:i",
    """SELECT 'nodes' AS table_name, count(*) AS n, (SELECT max(c_custkey) + 1 FROM {customer}) AS lowest, (SELECT max(c_custkey) FROM {customer}) + count(*) AS highest
    FROM (SELECT DISTINCT source_name, source_id FROM {station} s WHERE NOT EXISTS (SELECT 1 FROM {sensor_nodes} n WHERE n.source_name = s.source_name AND n.source_id = s.source_id)) x
    UNION ALL SELECT 'facts', count(*), 0, 0 FROM (SELECT DISTINCT ingest_id, datetime FROM {staged}) y""",
    {"staged": _STAGED, "station": _STATION},
)
def _(f):
    out = _mobile(f)
    fresh = out["sensor_nodes"].join(f.sensor_nodes.select("sensor_nodes_id"), "sensor_nodes_id", "left_anti")
    nodes = fresh.agg(F.count("*").alias("n"), F.min("sensor_nodes_id").alias("lowest"), F.max("sensor_nodes_id").alias("highest"))
    facts = out["measurements"].agg(F.count("*").alias("n"), F.lit(0).alias("lowest"), F.lit(0).alias("highest"))
    named = lambda df, t: df.select(F.lit(t).alias("table_name"), "n", "lowest", "highest")
    return named(nodes, "nodes").unionByName(named(facts, "facts"))


for _i, _name in enumerate(("load_dimension", "load_dimension_orphans")):
    query(
        _name, "o_orderkey:i o_custkey:i",
        f"SELECT o_orderkey, o_custkey FROM {{orders}} WHERE o_custkey {'NOT ' if _i else ''}IN (SELECT user_id FROM {{events}})",
    )(
        lambda f, i=_i: ingest.load_dimension(
            f.sql("SELECT o_orderkey, o_custkey FROM {orders}"), f.sql("SELECT user_id AS o_custkey FROM {events}"), "o_custkey"
        )[i]
    )


# ---- history ------------------------------------------------------------------------------------

_BEFORE = "SELECT c_custkey AS id, c_name AS site_name, c_mktsegment AS source_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS city FROM {customer} WHERE c_nationkey <> 3"
_AFTER = """SELECT c_custkey AS id, c_name AS site_name, CASE WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS source_name,
  CASE WHEN c_custkey % 7 = 0 THEN 'moved' WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS city FROM {customer} WHERE c_nationkey <> 4"""
_HIST = {"before": _BEFORE, "after": _AFTER}
_CHANGED = """(b.id IS NULL OR b.site_name IS DISTINCT FROM a.site_name OR b.source_name IS DISTINCT FROM a.source_name OR b.city IS DISTINCT FROM a.city)"""

for _image, _side in (("new", "a"), ("old", "b")):
    query(
        f"history_log_{_image}", "id:i site_name:s source_name:s city:s created:t",
        f"""SELECT {_side}.id, {_side}.site_name, {_side}.source_name, {_side}.city, TIMESTAMP '{AS_OF}' AS created FROM {{after}} a LEFT JOIN {{before}} b ON b.id = a.id WHERE {_CHANGED}""",
        _HIST,
    )(lambda f, image=_image: ingest.history_log(f.sql(_BEFORE), f.sql(_AFTER), "id", AS_OF, image))


@query(
    "accumulate_names", "id:i cities:s source_names:s",
    """SELECT coalesce(b.id, a.id) AS id, array_to_string(list_sort(list_filter(list_distinct(CASE WHEN a.id IS NULL THEN [b.city] WHEN b.id IS NULL THEN [a.city] ELSE [b.city, a.city] END), lambda x: x IS NOT NULL)), ',') AS cities,
      array_to_string(list_sort(list_filter(list_distinct([b.source_name, a.source_name]), lambda x: x IS NOT NULL)), ',') AS source_names
    FROM {before} b FULL JOIN {after} a ON a.id = b.id""", _HIST,
)
def _(f):
    first = f.sql(_BEFORE).select("id", F.array("city").alias("cities"), F.array("source_name").alias("source_names"))
    rows = ingest.accumulate_names(first, f.sql(_AFTER), {"cities": "city", "source_names": "source_name"}, "id")
    text = lambda c: F.array_join(F.sort_array(F.array_compact(c)), ",")
    return rows.select("id", text("cities").alias("cities"), text("source_names").alias("source_names"))


@query(
    "tracking_summary", "o_custkey:i n:i added_on:t modified_on:t",
    "SELECT o_custkey, count(*) AS n, min(o_orderdate) AS added_on, max(o_orderdate) AS modified_on FROM {orders} GROUP BY 1",
)
def _(f):
    return ingest.tracking_summary(f.sql("SELECT o_custkey, o_orderdate AS created FROM {orders}"), "o_custkey")


# ---- backfills ------------------------------------------------------------------------------------

_LOOSE_SENSORS = """SELECT p_partkey AS sensors_id, concat(CASE p_size % 5 WHEN 0 THEN 'PURPLE-' WHEN 1 THEN 'clarity-' WHEN 2 THEN 'iqair-' WHEN 3 THEN 'x-iqair-' ELSE 'Senstate/' END, p_brand) AS source_id,
  CASE WHEN p_partkey % 3 = 0 THEN 7 ELSE NULL END AS data_averaging_period_seconds, CASE WHEN p_partkey % 3 = 0 THEN 9 ELSE NULL END AS data_logging_period_seconds,
  CASE WHEN p_partkey % 4 = 0 THEN concat('{{"data_averaging_period_seconds": "', CAST(p_size AS STRING), '.6", "data_avg_dur": "', CASE WHEN p_size % 2 = 0 THEN 'Hourly mean' ELSE 'x' END, '", "logging_interval_seconds": "', CASE WHEN p_size % 7 = 0 THEN 'true' ELSE CAST(p_size AS STRING) END, '"}}')
       WHEN p_partkey % 4 = 1 THEN concat('{{"data_averaging_period_seconds": "', CAST(p_size AS STRING), '"}}') ELSE NULL END AS metadata FROM {part}"""
_LOOSE_NODES = """SELECT c_custkey AS sensor_nodes_id, upper(concat('supplier#', lpad(CAST(c_custkey % 300 AS STRING), 9, '0'))) AS source_name,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN NULL ELSE 77 END AS INT) AS providers_id, n_name AS country_name, substring(n_name, 8, 2) AS country,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 24 END AS INT) AS countries_id, CAST(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 3 END AS INT) AS timezones_id,
  CASE WHEN c_custkey % 4 = 0 THEN '{{"timezone": "Asia/Kolkata"}}' WHEN c_custkey % 4 = 1 THEN '{{"timezone": "Nowhere"}}' ELSE NULL END AS metadata
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey"""


@query(
    "backfill_metadata_providers", "sensor_nodes_id:i providers_id:i",
    "SELECT n.sensor_nodes_id, coalesce(n.providers_id, p.providers_id) AS providers_id FROM {loose} n LEFT JOIN {providers} p ON lower(p.source_name) = lower(n.source_name)",
    {"loose": _LOOSE_NODES},
)
def _(f):
    return ingest.backfill_metadata(f.sql(_LOOSE_NODES), f.sql(_LOOSE_SENSORS), f.providers)[0]


_PATTERN = "CASE WHEN regexp_matches(source_id, 'senstate', 'i') THEN {a} WHEN regexp_matches(source_id, 'purple', 'i') THEN {b} WHEN regexp_matches(source_id, 'clarity', 'i') THEN {c} WHEN regexp_matches(source_id, '^iqair', 'i') THEN 3600 END"


@query(
    "backfill_metadata_periods", "sensors_id:i data_averaging_period_seconds:i data_logging_period_seconds:i",
    f"""SELECT sensors_id, coalesce(data_averaging_period_seconds, s, {_PATTERN.format(a=60, b=120, c=90)}) AS data_averaging_period_seconds,
      CASE WHEN data_averaging_period_seconds IS NULL AND coalesce(s, {_PATTERN.format(a=60, b=120, c=90)}) IS NOT NULL THEN coalesce(s, {_PATTERN.format(a=60, b=120, c=300)})
        ELSE data_logging_period_seconds END AS data_logging_period_seconds
    FROM (SELECT *, CAST(round(CAST(json_extract_string(metadata, '$.data_averaging_period_seconds') AS DOUBLE)) AS INT) AS s FROM {{loose}}) x""",
    {"loose": _LOOSE_SENSORS},
)
def _(f):
    return ingest.backfill_metadata(f.sql(_LOOSE_NODES), f.sql(_LOOSE_SENSORS), f.providers)[1]


@query(
    "backfill_from_metadata_nodes", "sensor_nodes_id:i timezones_id:i providers_id:i countries_id:i",
    """SELECT n.sensor_nodes_id, coalesce(t.timezones_id, n.timezones_id) AS timezones_id,
      CASE WHEN n.providers_id IS NULL OR n.providers_id = 1 THEN coalesce(p.providers_id, n.providers_id) ELSE n.providers_id END AS providers_id,
      coalesce(n.countries_id, c.countries_id) AS countries_id
    FROM {loose} n LEFT JOIN {timezones} t ON t.tzid = json_extract_string(n.metadata, '$.timezone') LEFT JOIN {named} p ON p.source_name = n.source_name
    LEFT JOIN (SELECT iso, min(countries_id) AS countries_id FROM {countries} GROUP BY 1) c ON c.iso = n.country""",
    {"loose": _LOOSE_NODES, "named": "SELECT * REPLACE (upper(source_name) AS source_name) FROM {providers}"},
)
def _(f):
    named = f.providers.withColumn("source_name", F.upper("source_name"))
    return ingest.backfill_from_metadata(f.sql(_LOOSE_NODES), f.sql(_LOOSE_SENSORS), f.timezones, named, f.countries)[0]


@query(
    "backfill_from_metadata_periods", "sensors_id:i data_averaging_period_seconds:i data_logging_period_seconds:i",
    """SELECT sensors_id, CASE WHEN regexp_matches(json_extract_string(metadata, '$.data_avg_dur'), '^hourly', 'i') THEN 3600
        ELSE coalesce(TRY_CAST(CASE WHEN contains(json_extract_string(metadata, '$.data_averaging_period_seconds'), '.') THEN NULL ELSE json_extract_string(metadata, '$.data_averaging_period_seconds') END AS INT), data_averaging_period_seconds) END AS data_averaging_period_seconds,
      coalesce(CASE WHEN json_extract_string(metadata, '$.logging_interval_seconds') <> 'true' THEN CAST(json_extract_string(metadata, '$.logging_interval_seconds') AS INT) END, data_logging_period_seconds) AS data_logging_period_seconds
    FROM {loose}""", {"loose": _LOOSE_SENSORS},
)
def _(f):
    return ingest.backfill_from_metadata(f.sql(_LOOSE_NODES), f.sql(_LOOSE_SENSORS), f.timezones, f.providers, f.countries)[1]


_MADE = """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat('{{"manufacturer_name": "', p_brand, '", "model_name": "', p_name, '"}}') END AS metadata FROM {part}"""
_DEPLOYED = """SELECT s_suppkey, concat('{{"deployed_by": "', s_name, '"}}') AS metadata FROM {supplier}"""
_KNOWN = "SELECT p_brand AS full_name, min(p_partkey) AS entities_id FROM {part} WHERE p_size < 25 AND p_brand <> 'Brand#3' GROUP BY 1"


@query(
    "collect_manufacturers", "full_name:s",
    """SELECT DISTINCT v AS full_name FROM (SELECT json_extract_string(metadata, '$.manufacturer_name') AS v FROM {made} UNION ALL SELECT json_extract_string(metadata, '$.deployed_by') FROM {deployed}) x
    WHERE v IS NOT NULL AND v NOT IN (SELECT full_name FROM {known})""", {"made": _MADE, "deployed": _DEPLOYED, "known": _KNOWN},
)
def _(f):
    return ingest.collect_manufacturers(
        f.sql(_MADE), f.sql(_DEPLOYED), f.sql(_KNOWN), {"sensors": ["manufacturer_name"], "sensor_systems": ["deployed_by"]}
    )


@query(
    "collect_instruments", "label:s manufacturer_entities_id:i",
    """SELECT json_extract_string(metadata, '$.model_name') AS label, min(k.entities_id) AS manufacturer_entities_id FROM {made} m
    LEFT JOIN {known} k ON k.full_name = json_extract_string(metadata, '$.manufacturer_name') WHERE metadata IS NOT NULL GROUP BY 1""", {"made": _MADE, "known": _KNOWN},
)
def _(f):
    return ingest.collect_instruments(f.sql(_MADE), f.sql(_KNOWN))


_RULES = "SELECT DISTINCT lower(c_mktsegment) AS name, CAST(length(c_mktsegment) AS INT) AS entities_id, CAST(length(c_mktsegment) * 2 AS INT) AS instruments_id FROM {customer} WHERE c_mktsegment <> 'BUILDING'"


@query(
    "update_instruments", "sensor_systems_id:i owner_entities_id:i instruments_id:i",
    """SELECT y.sensor_systems_id, n.owner AS owner_entities_id, CASE WHEN y.instruments_id = 1 AND n.owner = n.entities_id THEN n.new_id ELSE y.instruments_id END AS instruments_id
    FROM {sensor_systems} y JOIN (SELECT n.sensor_nodes_id, r.entities_id, r.instruments_id AS new_id,
      CASE WHEN r.entities_id IS NOT NULL AND n.owner_entities_id = 1 THEN r.entities_id ELSE n.owner_entities_id END AS owner
      FROM {sensor_nodes} n LEFT JOIN {rules} r ON r.name = lower(n.source_name)) n ON n.sensor_nodes_id = y.sensor_nodes_id""", {"rules": _RULES},
)
def _(f):
    nodes, systems, _ = ingest.update_instruments(f.sensor_nodes, f.sensor_systems, f.sql(_RULES))
    return systems.join(nodes.select("sensor_nodes_id", "owner_entities_id"), "sensor_nodes_id")


@query(
    "update_instruments_forced_counts", "name:s n:i",
    """SELECT r.name, count(y.sensor_systems_id) AS n FROM {rules} r LEFT JOIN ({pairs_of_nodes}) n ON lower(n.source_name) = r.name
    LEFT JOIN {sensor_systems} y ON y.sensor_nodes_id = n.sensor_nodes_id GROUP BY 1""".replace("({pairs_of_nodes})", "{sensor_nodes}"), {"rules": _RULES},
)
def _(f):
    return ingest.update_instruments(f.sensor_nodes, f.sensor_systems, f.sql(_RULES), force=True)[2]


for _i, (_name, _out, _sql) in enumerate((
    ("set_visibility_nodes", "sensor_nodes_id:i is_public:b", "SELECT sensor_nodes_id, is_public AND NOT regexp_matches(source_name, '^mach|r#.*7$', 'i') AS is_public FROM {sensor_nodes}"),
    ("set_visibility_sensors", "sensors_id:i is_public:b", """SELECT s.sensors_id, s.is_public AND NOT regexp_matches(n.source_name, '^mach|r#.*7$', 'i') AS is_public
      FROM {sensors} s JOIN {sensor_systems} y ON y.sensor_systems_id = s.sensor_systems_id JOIN {sensor_nodes} n ON n.sensor_nodes_id = y.sensor_nodes_id"""),
    ("set_visibility_providers", "providers_id:i is_public:b", "SELECT providers_id, is_public AND NOT regexp_matches(label, '^mach|r#.*7$', 'i') AS is_public FROM {providers}"),
)):
    query(_name, _out, _sql)(
        lambda f, i=_i: ingest.set_visibility(f.sensor_nodes, f.sensor_systems, f.sensors, f.providers, "^mach|r#.*7$")[i]
    )

_NAMED_PARTS = "SELECT p_partkey AS measurands_id, CASE WHEN p_size % 3 = 0 THEN concat('Wind ', p_name) WHEN p_size % 3 = 1 THEN concat('x_RH', p_type) ELSE p_name END AS measurand, p_type AS units FROM {part}"


@query(
    "classify_parameter", "measurands_id:i parameter_type:s",
    "SELECT measurands_id, CASE WHEN regexp_matches(measurand, 'temp|rh|relative|pressure|humid|wind', 'i') THEN 'meteorological' ELSE 'pollutant' END AS parameter_type FROM {parts}",
    {"parts": _NAMED_PARTS},
)
def _(f):
    return ingest.classify_parameter(f.sql(_NAMED_PARTS), default=F.lit("pollutant"))


_MAP_KEYS = "SELECT s.s_name AS source_name, concat(s.s_name, ':', m.measurand) AS key, m.measurand, m.units FROM {supplier} s JOIN {measurands} m ON m.measurands_id = s.s_suppkey % 5 + 1"
_MAP_HELD = "SELECT concat(s_name, ':', 'click') AS key, 99 AS measurands_id, 'n' AS units, 'held' AS source_name FROM {supplier} WHERE s_acctbal > 3000"


@query(
    "build_measurand_map", "key:s measurands_id:i units:s source_name:s",
    """SELECT key, measurands_id, units, source_name FROM {held} UNION ALL SELECT k.key, m.measurands_id, k.units, k.source_name FROM {map_keys} k
    JOIN {measurands} m ON m.measurand = k.measurand AND m.units = k.units WHERE NOT EXISTS (SELECT 1 FROM {held} h WHERE h.key = k.key AND h.units = k.units)""",
    {"held": _MAP_HELD, "map_keys": _MAP_KEYS},
)
def _(f):
    return ingest.build_measurand_map(f.sql(_MAP_HELD), f.sql(_MAP_KEYS), f.measurands)


_REJECTS = """SELECT CASE WHEN l_linestatus = 'F' THEN 'missing-measurand' ELSE 'other' END AS tbl,
  concat('{{"measurand": "m', CAST(l_linenumber AS STRING), '", "units": "u', CAST(l_suppkey % 3 AS STRING), '"}}') AS r FROM {lineitem}"""


@query(
    "reject_summary", "measurand:s units:s n:i",
    "SELECT json_extract_string(r, '$.measurand') AS measurand, json_extract_string(r, '$.units') AS units, count(*) AS n FROM {rejects} WHERE tbl = 'missing-measurand' GROUP BY 1, 2",
    {"rejects": _REJECTS},
)
def _(f):
    return ingest.reject_summary(f.sql(_REJECTS), "missing-measurand", ["measurand", "units"])


# ---- sources ------------------------------------------------------------------------------------

_SRC_NODES = """SELECT c_custkey AS sensor_nodes_id, c_mktsegment AS source_name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE upper(CASE c_custkey % 3 WHEN 0 THEN 'dir' WHEN 1 THEN 'att' ELSE 'oth' END) END AS origin,
  CASE WHEN c_custkey % 3 = 0 THEN concat('{{"sensor_node_source_fullname": "Full ', c_mktsegment, '", "source_type": "s", "n": 1.5, "gone": null, "list": [1, {{"a": "b"}}]}}')
       WHEN c_custkey % 3 = 1 THEN concat('{{"attribution": [{{"name": "N', CAST(c_nationkey AS STRING), '", "url": "u', CAST(c_nationkey AS STRING), '", "rank": ', CAST(c_nationkey AS STRING), '}}, {{"name": "Common", "url": "c"}}]}}')
       ELSE '{{"entity": "e"}}' END AS metadata FROM {customer}"""


_READMES = """SELECT slug, concat('about ', slug) AS readme FROM {sources} WHERE sources_id % 4 <> 0
UNION ALL SELECT DISTINCT c_mktsegment, 'about the segment' FROM {customer} UNION ALL SELECT DISTINCT lower(c_mktsegment), 'never' FROM {customer}"""


def _sources(f):
    origins = f.sql("SELECT DISTINCT upper(CASE c_custkey % 3 WHEN 0 THEN 'dir' ELSE 'att' END) AS origin, '{{\"country\": \"x\", \"n\": 2}}' AS metadata FROM {customer}")
    held = f.sources.select("sources_id", "slug", "name", F.lit(None).cast("string").alias("metadata"), "readme")
    readmes = f.sql(_READMES)
    links = f.sensor_nodes_sources.where(F.lit(False))
    return ingest.update_sources(f.sql(_SRC_NODES), origins, held, links, "DIR", "ATT", readmes)


@query(
    "update_sources_links", "sensor_nodes_id:i name:s",
    """SELECT sensor_nodes_id, 'Full ' || source_name AS name FROM {nodes} WHERE origin = 'DIR' UNION
    SELECT sensor_nodes_id, unnest(['N' || json_extract_string(metadata, '$.attribution[0].name')[2:], 'Common']) AS name FROM {nodes} WHERE origin = 'ATT' UNION
    SELECT sensor_nodes_id, source_name FROM {nodes} WHERE (origin <> 'DIR' OR origin IS NULL) AND NOT contains(metadata, 'attribution')""",
    {"nodes": _SRC_NODES},
)
def _(f):
    nodes, sources, links = _sources(f)
    return links.join(sources.select("sources_id", "name"), "sources_id")


@query(
    "update_sources_new", "slug:s name:s metadata:s",
    """SELECT source_name AS slug, 'Full ' || source_name AS name, NULL AS metadata FROM {nodes} WHERE origin = 'DIR' UNION
    SELECT NULL, name, '{{' || coalesce('"rank":' || rank || ',', '') || '"url":"' || url || '"}}' FROM (SELECT json_extract_string(metadata, '$.attribution[0].name') AS name, json_extract_string(metadata, '$.attribution[0].url') AS url,
      json_extract_string(metadata, '$.attribution[0].rank') AS rank FROM {nodes} WHERE origin = 'ATT' UNION SELECT 'Common', 'c', NULL) a UNION
    SELECT lower(source_name), source_name, NULL FROM {nodes} WHERE (origin <> 'DIR' OR origin IS NULL) AND NOT contains(metadata, 'attribution')""",
    {"nodes": _SRC_NODES},
)
def _(f):
    _, sources, _ = _sources(f)
    return sources.join(f.sources.select("name"), "name", "left_anti")


@query(
    "update_sources_readmes", "slug:s name:s readme:s",
    """SELECT s.slug, s.name, coalesce(s.readme, r.readme) AS readme FROM {sources} s LEFT JOIN {readmes} r ON r.slug = s.slug
    UNION SELECT source_name, 'Full ' || source_name, 'about the segment' FROM {nodes} WHERE origin = 'DIR'
    UNION SELECT NULL, name, NULL FROM (SELECT json_extract_string(metadata, '$.attribution[0].name') AS name FROM {nodes} WHERE origin = 'ATT' UNION SELECT 'Common') a
    UNION SELECT lower(source_name), source_name, NULL FROM {nodes} WHERE (origin <> 'DIR' OR origin IS NULL) AND NOT contains(metadata, 'attribution')""",
    {"nodes": _SRC_NODES, "readmes": _READMES},
)
def _(f):
    return _sources(f)[1]


@query(
    "update_sources_nodes", "sensor_nodes_id:i origin:s country:s n:f kind:s elements:i inner_b:s has_gone:b attributed:s rank:i entity:s",
    """SELECT sensor_nodes_id, coalesce(origin, upper(source_name)) AS origin, CASE WHEN taken THEN 'x' END AS country,
      CASE WHEN taken THEN 2.0 WHEN json_extract(metadata, '$.n') IS NOT NULL THEN 1.5 END AS n,
      CASE WHEN NOT taken THEN json_extract_string(metadata, '$.source_type') END AS kind,
      json_array_length(metadata, '$.list') AS elements, json_extract_string(metadata, '$.list[1].a') AS inner_b,
      contains(metadata, 'gone') AND NOT taken AS has_gone, json_extract_string(metadata, '$.attribution[1].name') AS attributed,
      CAST(json_extract(metadata, '$.attribution[0].rank') AS BIGINT) AS rank, json_extract_string(metadata, '$.entity') AS entity
    FROM (SELECT *, coalesce(origin IN ('DIR', 'ATT'), false) AND NOT contains(metadata, 'entity') AS taken FROM {nodes}) x""",
    {"nodes": _SRC_NODES},
)
def _(f):
    field = lambda path: F.get_json_object("metadata", path)
    return _sources(f)[0].select(
        "sensor_nodes_id", "origin", field("$.country").alias("country"),
        F.try_variant_get(F.parse_json("metadata"), "$.n", "double").alias("n"), field("$.source_type").alias("kind"),
        F.json_array_length(field("$.list")).alias("elements"), field("$.list[1].a").alias("inner_b"),
        F.col("metadata").contains("gone").alias("has_gone"), field("$.attribution[1].name").alias("attributed"),
        F.try_variant_get(F.parse_json("metadata"), "$.attribution[0].rank", "bigint").alias("rank"), field("$.entity").alias("entity"),
    )


# ---- migration maps -------------------------------------------------------------------------------

_IMPORT_NODES = """SELECT c_custkey AS sensor_nodes_id, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat(c_mktsegment, '/', CAST(CAST(floor(c_custkey / 7) AS BIGINT) AS STRING)) END AS source_id, c_mktsegment AS source_name,
  concat(c_name, '|') AS site_name, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 360 - 180 AS DOUBLE) END AS lon, CAST(c_custkey % 160 - 80 AS DOUBLE) AS lat,
  CASE c_custkey % 4 WHEN 0 THEN 'clarity net' WHEN 1 THEN 'PURPLE' WHEN 2 THEN 'other' ELSE NULL END AS origin, c_custkey % 5 = 0 AS ismobile FROM {customer}"""
_IMPORT = """SELECT s.sensors_id, n.sensor_nodes_id, y.sensor_systems_id, m.measurands_id, s.source_id AS sensors_source_id, m.measurand, m.units,
      CASE WHEN regexp_matches(n.origin, 'CLARITY', 'i') THEN 90 WHEN regexp_matches(n.origin, 'PURPLE', 'i') THEN 120 ELSE 3600 END AS data_averaging_period_seconds,
      CASE WHEN regexp_matches(n.origin, 'CLARITY', 'i') THEN 180 WHEN regexp_matches(n.origin, 'PURPLE', 'i') THEN 120 ELSE 3600 END AS data_logging_period_seconds,
      coalesce(n.source_id, regexp_replace(n.site_name, '[|\\n\\r]+', '', 'g')) AS source_id, n.source_name, regexp_replace(n.site_name, '[|\\n\\r]+', '', 'g') AS site_name, n.lon, n.lat, n.origin
    FROM {sensors} s JOIN {measurands} m ON m.measurands_id = s.measurands_id JOIN {sensor_systems} y ON y.sensor_systems_id = s.sensor_systems_id
    JOIN {import_nodes} n ON n.sensor_nodes_id = y.sensor_nodes_id"""
_IMP = {"import_nodes": _IMPORT_NODES, "import": _IMPORT}


def _import(f):
    return ingest.sensors_import(f.sensors, f.sensor_systems, f.sql(_IMPORT_NODES), f.measurands)


@query(
    "sensors_import",
    "sensors_id:i sensor_nodes_id:i sensor_systems_id:i measurands_id:i sensors_source_id:s measurand:s units:s data_averaging_period_seconds:i "
    "data_logging_period_seconds:i source_id:s source_name:s site_name:s lon:f lat:f origin:s", _IMPORT, _IMP,
)
def _(f):
    return _import(f)


_GROUPED = """SELECT CASE WHEN special THEN source_id || '@' || CAST(CAST(lat AS INT) AS VARCHAR) || '.0' ELSE source_id END AS source_id, source_name, min(sensor_nodes_id) AS sensor_nodes_id,
      count(DISTINCT sensor_nodes_id) AS n, round(stddev(lon) + stddev(lat), 3) AS geom_var, list_sort(list(DISTINCT sensor_nodes_id)) AS nodes
    FROM (SELECT *, source_name = 'MACHINERY' AND source_id LIKE '%1' AS special FROM {import} WHERE source_name <> 'FURNITURE' OR sensor_nodes_id > 100) x
    GROUP BY CASE WHEN special THEN source_id || '@' || CAST(CAST(lat AS INT) AS VARCHAR) || '.0' ELSE source_id END, source_name, special, CASE WHEN special THEN lat END, CASE WHEN special THEN lon END"""
_GRP = {**_IMP, "grouped": _GROUPED}


def _grouped(f):
    apart = (F.col("source_name") == "MACHINERY") & F.col("source_id").like("%1")
    dropped = (F.col("source_name") == "FURNITURE") & (F.col("sensor_nodes_id") <= 100)
    return ingest.group_import_nodes(_import(f), apart, dropped)


@query(
    "group_import_nodes", "source_id:s source_name:s sensor_nodes_id:i n:i geom_var:f nodes:s",
    "SELECT * REPLACE (array_to_string(nodes, ',') AS nodes) FROM {grouped}", _GRP,
)
def _(f):
    return _grouped(f).withColumn("nodes", F.array_join(F.transform("nodes", lambda x: x.cast("string")), ","))


_NODE_MAP = """SELECT g.sensor_nodes_id, (SELECT min(y.sensor_systems_id) FROM {sensor_systems} y WHERE y.sensor_nodes_id = g.sensor_nodes_id) AS sensor_systems_id, unnest(g.nodes) AS old_sensor_nodes_id FROM {grouped} g"""
_SENSOR_MAP = """SELECT c.sensors_id, i.sensors_id AS old_sensors_id, m.sensor_nodes_id, m.old_sensor_nodes_id FROM {import} i JOIN {node_map} m ON m.old_sensor_nodes_id = i.sensor_nodes_id
  JOIN (SELECT sensor_nodes_id, measurands_id, max(sensors_id) AS sensors_id FROM {import} GROUP BY 1, 2) c ON c.sensor_nodes_id = m.sensor_nodes_id AND c.measurands_id = i.measurands_id"""
_MAPS = {**_GRP, "node_map": _NODE_MAP, "sensor_map": _SENSOR_MAP}


def _node_map(f):
    return ingest.node_map(_grouped(f), f.sensor_systems)


@query("node_map", "sensor_nodes_id:i sensor_systems_id:i old_sensor_nodes_id:i", _NODE_MAP, _MAPS)
def _(f):
    return _node_map(f)


@query("sensor_map", "sensors_id:i old_sensors_id:i sensor_nodes_id:i old_sensor_nodes_id:i", _SENSOR_MAP, _MAPS)
def _(f):
    return ingest.sensor_map(_import(f), _node_map(f))


@query(
    "map_audit_unmapped", "sensor_nodes_id:i source_name:s source_id:s",
    "SELECT sensor_nodes_id, source_name, source_id FROM {import} WHERE sensor_nodes_id NOT IN (SELECT old_sensor_nodes_id FROM {node_map})", _MAPS,
)
def _(f):
    nodes = _node_map(f)
    return ingest.map_audit(_import(f), nodes, ingest.sensor_map(_import(f), nodes))[0]


@query(
    "map_audit_counts", "imported_sensors:i mapped_sensors:i records:i diff:i",
    """SELECT count(DISTINCT sensors_id) AS imported_sensors, count(DISTINCT old_sensors_id) AS mapped_sensors, count(*) AS records,
      count(DISTINCT old_sensors_id) - count(DISTINCT sensors_id) AS diff FROM {sensor_map}""", _MAPS,
)
def _(f):
    nodes = _node_map(f)
    return ingest.map_audit(_import(f), nodes, ingest.sensor_map(_import(f), nodes))[1]


# ---- merging and removing ---------------------------------------------------------------------------

# odd customers' sensors merge into the even neighbour's; among them pairs of one sensor, with a
# missing id, repeated, into two targets, in a chain, and two sources of one target
_SENSOR_FIVES = "(SELECT *, {five} AS m FROM {customer}) c"
_PAIRS = f"""SELECT c_custkey*5 + m AS bad_sensors_id, (c_custkey - 1)*5 + m AS good_sensors_id FROM {_SENSOR_FIVES} WHERE c_custkey % 2 = 1
UNION ALL SELECT c_custkey*5 + m, c_custkey*5 + m FROM {_SENSOR_FIVES} WHERE c_custkey % 5 = 0
UNION ALL SELECT c_custkey*5 + m, CASE WHEN m < 3 THEN NULL ELSE (c_custkey - 1)*5 + m END FROM {_SENSOR_FIVES} WHERE c_custkey % 10 = 1
UNION ALL SELECT c_custkey*5 + m, (c_custkey + 1)*5 + m FROM {_SENSOR_FIVES} WHERE c_custkey % 10 = 3 AND m = 0
UNION ALL SELECT (c_custkey - 1)*5 + m, (c_custkey + 1)*5 + m FROM {_SENSOR_FIVES} WHERE c_custkey % 10 = 7 AND m = 1
UNION ALL SELECT (c_custkey + 1)*5 + m, (c_custkey - 1)*5 + m FROM {_SENSOR_FIVES} WHERE c_custkey % 10 = 9 AND m > 1"""
_PAIRS_CHECK = _PAIRS.replace("{five}", "unnest([0, 1, 2, 3, 4])")
# values depend on the sensor's place in its pair, so that a third of the pairs clash
_FACTS = """SELECT sensors_id, datetime, CASE WHEN sensors_id % 15 < 5 THEN 1.0 * sensors_id WHEN sensors_id % 15 = 7 THEN NULL ELSE 1.0 END AS value, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat, added_on FROM {measurements_long}"""
_MERGE = {
    "pairs": _PAIRS_CHECK, "facts": _FACTS,
    "sound": "SELECT DISTINCT bad_sensors_id, good_sensors_id FROM {pairs} WHERE bad_sensors_id <> good_sensors_id",
    "several": "SELECT bad_sensors_id FROM {sound} GROUP BY 1 HAVING count(*) > 1",
    "chained": """SELECT * FROM {sound} WHERE bad_sensors_id NOT IN (SELECT bad_sensors_id FROM {several})
      AND good_sensors_id IN (SELECT bad_sensors_id FROM {sound})""",
    "candidates": """SELECT * FROM {sound} s WHERE bad_sensors_id NOT IN (SELECT bad_sensors_id FROM {several})
      AND good_sensors_id NOT IN (SELECT bad_sensors_id FROM {sound})""",
    "sourced": "SELECT p.bad_sensors_id, p.good_sensors_id, b.datetime, b.value FROM {candidates} p JOIN {facts} b ON b.sensors_id = p.bad_sensors_id",
    "conflicts": """SELECT bad_sensors_id, good_sensors_id, count(*) AS conflicts FROM {sourced} s
      WHERE EXISTS (SELECT 1 FROM {facts} g WHERE g.sensors_id = s.good_sensors_id AND g.datetime = s.datetime AND g.value <> s.value)
      OR EXISTS (SELECT 1 FROM {sourced} o WHERE o.good_sensors_id = s.good_sensors_id AND o.datetime = s.datetime AND o.value <> s.value) GROUP BY 1, 2""",
    "allowed": "SELECT * FROM {candidates} WHERE bad_sensors_id NOT IN (SELECT bad_sensors_id FROM {conflicts})",
    "fresh": """SELECT a.good_sensors_id AS sensors_id, b.datetime, max(b.value) AS value FROM {allowed} a JOIN {facts} b ON b.sensors_id = a.bad_sensors_id
      WHERE NOT EXISTS (SELECT 1 FROM {facts} g WHERE g.sensors_id = a.good_sensors_id AND g.datetime = b.datetime) GROUP BY 1, 2""",
}


def _merge(f):
    return ingest.merge_sensors(f.sql(_FACTS), f.sql(_PAIRS), f.ctx, AS_OF)


@query(
    "merge_sensors", "sensors_id:i datetime:t value:f",
    """SELECT sensors_id, datetime, value FROM {facts} WHERE sensors_id NOT IN (SELECT bad_sensors_id FROM {allowed}) UNION ALL SELECT sensors_id, datetime, value FROM {fresh}""", _MERGE,
)
def _(f):
    return _merge(f).measurements


@query(
    "merge_sensors_archive", "sensors_id:i datetime:t value:f archived_on:t archive_reason:s",
    f"""SELECT f.sensors_id, f.datetime, f.value, TIMESTAMP '{AS_OF}' AS archived_on, 'merged into sensor ' || a.good_sensors_id AS archive_reason
    FROM {{facts}} f JOIN {{allowed}} a ON a.bad_sensors_id = f.sensors_id""", _MERGE,
)
def _(f):
    return _merge(f).archive


@query(
    "merge_sensors_touched", "datetime:t offset_s:i",
    """SELECT DISTINCT date_trunc('hour', datetime + (o - 1) * INTERVAL 1 SECOND) - o * INTERVAL 1 SECOND + INTERVAL 1 HOUR AS datetime, o AS offset_s
    FROM (SELECT f.datetime, CAST(epoch_us(timezone(c.tzid, timezone('UTC', f.datetime))) - epoch_us(f.datetime) AS BIGINT) // 1000000 AS o FROM {fresh} f JOIN {ctx} c ON c.sensors_id = f.sensors_id) x""", _MERGE,
)
def _(f):
    return _merge(f).touched


@query(
    "merge_sensors_refused", "bad_sensors_id:i good_sensors_id:i reason:s conflicts:i",
    """SELECT DISTINCT bad_sensors_id, good_sensors_id, CASE WHEN bad_sensors_id = good_sensors_id THEN 'same sensor' ELSE 'missing id' END AS reason, 0 AS conflicts
    FROM {pairs} WHERE bad_sensors_id = good_sensors_id OR bad_sensors_id IS NULL OR good_sensors_id IS NULL
    UNION ALL SELECT *, 'several targets', 0 FROM {sound} WHERE bad_sensors_id IN (SELECT bad_sensors_id FROM {several})
    UNION ALL SELECT *, 'target is merged itself', 0 FROM {chained}
    UNION ALL SELECT bad_sensors_id, good_sensors_id, 'values differ', conflicts FROM {conflicts}""", _MERGE,
)
def _(f):
    return _merge(f).refused


@query(
    "merge_sensors_cleanup", "sensors_id:i measurands_id:i",
    "SELECT sensors_id, measurands_id FROM {sensors} WHERE sensors_id NOT IN (SELECT bad_sensors_id FROM {allowed})", _MERGE,
)
def _(f):
    return ingest.remove_merged(_merge(f), {"sensors": f.sensors})[0]["sensors"]


_GONE = "SELECT DISTINCT user_id * 5 + 1 AS sensors_id FROM {events} WHERE event_type = 'error'"


@query(
    "remove_sensor_data_counts", "table_name:s removed:i",
    """SELECT 'measurements' AS table_name, count(*) AS removed FROM {measurements} WHERE sensors_id IN (SELECT sensors_id FROM {gone})
    UNION ALL SELECT 'hourly_data', count(*) FROM {hourly} WHERE sensors_id IN (SELECT sensors_id FROM {gone})
    UNION ALL SELECT 'sensors', count(*) FROM {sensors} WHERE sensors_id IN (SELECT sensors_id FROM {gone})""", {"gone": _GONE},
)
def _(f):
    return ingest.remove_sensor_data({"measurements": f.measurements, "hourly_data": f.hourly, "sensors": f.sensors}, f.sql(_GONE))[1]


@query("delete_sensors", "sensors_id:i datetime:t value:f",
       "SELECT sensors_id, datetime, value FROM {measurements} WHERE sensors_id NOT IN (SELECT sensors_id FROM {gone})", {"gone": _GONE})
def _(f):
    return ingest.remove_sensor_data({"measurements": f.measurements}, f.sql(_GONE))[0]["measurements"]


_CLEAN = {
    "live": "SELECT s.* FROM {sensors} s WHERE s.sensors_id IN (SELECT sensors_id FROM {lifetime})",
    "used": "SELECT y.* FROM {sensor_systems} y WHERE y.sensor_systems_id IN (SELECT sensor_systems_id FROM {live})",
}
for _i, (_name, _out, _sql) in enumerate((
    ("clean_sensor_nodes", "sensor_nodes_id:i site_name:s", "SELECT sensor_nodes_id, site_name FROM {sensor_nodes} WHERE sensor_nodes_id IN (SELECT sensor_nodes_id FROM {used})"),
    ("clean_sensor_systems", "sensor_systems_id:i", "SELECT sensor_systems_id FROM {used}"),
    ("clean_sensors", "sensors_id:i", "SELECT sensors_id FROM {live}"),
    ("clean_node_sources", "sensor_nodes_id:i sources_id:i", "SELECT sensor_nodes_id, sources_id FROM {sensor_nodes_sources} WHERE sensor_nodes_id IN (SELECT sensor_nodes_id FROM {used})"),
)):
    query(_name, _out, _sql, _CLEAN)(
        lambda f, i=_i: ingest.clean_sensor_nodes(f.sensor_nodes, f.sensor_systems, f.sensors, f.sensor_nodes_sources, f.lifetime)[i]
    )


@query(
    "json_merge_agg", "sensor_nodes_id:i merged:s",
    """SELECT user_id AS sensor_nodes_id, '{{"k":' || CAST(arg_max(k, event_id) AS VARCHAR) || ',"l":[' || CAST(arg_max(k, event_id) AS VARCHAR) || ',{{"x":"y"}}],"t":"' || arg_max(event_type, event_id) || '"}}' AS merged
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events}) e GROUP BY 1""",
)
def _(f):
    rows = f.sql(
        """SELECT user_id AS sensor_nodes_id, event_id, concat('{{"t": "', event_type, '", "k": ', k, ', "l": [', k, ', {{"x": "y"}}]}}') AS m
        FROM (SELECT *, CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS STRING) AS k FROM {events}) e"""
    )
    return ingest.merge_json(rows, ["sensor_nodes_id"], "m", F.col("event_id"), "merged")


@query(
    "first_notnull", "sensors_id:i value:f",
    "SELECT sensors_id, arg_min(value, datetime) FILTER (WHERE value IS NOT NULL) AS value FROM {measurements} GROUP BY 1",
)
def _(f):
    first = F.min_by("value", F.when(F.col("value").isNotNull(), F.col("datetime")))
    return f.measurements.groupBy("sensors_id").agg(first.alias("value"))


@query(
    "last_by_time", "sensors_id:i value:f",
    "SELECT sensors_id, arg_max_null(value, datetime) AS value FROM {measurements} GROUP BY 1",
)
def _(f):
    return f.measurements.groupBy("sensors_id").agg(F.max_by("value", "datetime").alias("value"))
