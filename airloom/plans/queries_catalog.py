"""Queries: catalog views (nested results flattened to text), versions, duplicates, groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import textops
from airloom.operators import catalog
from airloom.plans.frames import AS_OF
from airloom.plans.queries_exports import format_sql
from airloom.plans.queries_monitor import ADAPTER_TEXT, NODE_CHECK, adapter_text, deployment_adapters, node_check
from airloom.plans.registry import query


def listed(column, *fields):
    """Array of structs as text: fields joined by |, items by ;."""

    def cell(item, field):
        for part in field.split("."):
            item = item[part]
        return item.cast("string")

    return F.array_join(F.transform(column, lambda x: F.concat_ws("|", *[cell(x, f) for f in fields])), ";")


def plain_list(column):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")


_LICENSE_TEXT = "string_agg(concat_ws('|', pl.licenses_id, l.name, pl.valid_from, pl.valid_to{more}), ';' ORDER BY pl.licenses_id, l.name, pl.valid_from, pl.valid_to)"


@query(
    "provider_licenses", "providers_id:i licenses:s",
    f"SELECT providers_id, {_LICENSE_TEXT.format(more='')} AS licenses FROM {{providers_licenses}} pl JOIN {{licenses}} l ON l.licenses_id = pl.licenses_id GROUP BY 1",
)
def _(f):
    return catalog.provider_licenses(f.providers_licenses, f.licenses).withColumn("licenses", listed("licenses", "id", "name", "date_from", "date_to"))


_LOC_LICENSES = f"""SELECT n.sensor_nodes_id, {_LICENSE_TEXT.format(more=', e.full_name, e.url')} AS licenses,
      string_agg(DISTINCT CAST(pl.licenses_id AS VARCHAR), ',' ORDER BY CAST(pl.licenses_id AS VARCHAR)) AS license_ids
    FROM {{providers_licenses}} pl JOIN {{sensor_nodes}} n ON n.providers_id = pl.providers_id JOIN {{entities}} e ON e.entities_id = n.owner_entities_id
    JOIN {{licenses}} l ON l.licenses_id = pl.licenses_id GROUP BY 1"""


@query("location_licenses", "sensor_nodes_id:i licenses:s license_ids:s", _LOC_LICENSES)
def _(f):
    rows = catalog.location_licenses(f.providers_licenses, f.licenses, f.sensor_nodes, f.entities)
    return rows.withColumn("licenses", listed("licenses", "id", "name", "date_from", "date_to", "attribution.name", "attribution.url")).withColumn(
        "license_ids", plain_list("license_ids")
    )


def locations(f):
    return catalog.locations_view(
        f.sensor_nodes, f.sensor_systems, f.sensors, f.measurands, f.lifetime, f.timezones, f.countries, f.entities, f.providers,
        f.instruments, f.providers_licenses, f.licenses,
    )


_NODE_INSTRUMENTS = """SELECT y.sensor_nodes_id, bool_or(i.is_monitor) AS ismonitor,
      string_agg(concat_ws('|', i.instruments_id, i.label, e.entities_id, e.full_name), ';' ORDER BY i.instruments_id) AS instruments,
      string_agg(DISTINCT e.full_name, ',' ORDER BY e.full_name) AS manufacturers
    FROM {sensor_systems} y JOIN {instruments} i ON i.instruments_id = y.instruments_id JOIN {entities} e ON e.entities_id = i.manufacturer_entities_id GROUP BY 1"""
_NODE_SENSORS = """SELECT y.sensor_nodes_id, min(l.datetime_first) AS first, max(l.datetime_last) AS last,
      string_agg(concat_ws('|', s.sensors_id, m.measurand || ' ' || m.units, m.measurands_id, CAST(round(l.value_latest * 100) AS BIGINT), m.display), ';' ORDER BY s.sensors_id) AS sensors,
      string_agg(DISTINCT m.measurand, ',' ORDER BY m.measurand) AS parameters
    FROM {sensor_systems} y JOIN {sensors} s ON s.sensor_systems_id = y.sensor_systems_id LEFT JOIN {lifetime} l ON l.sensors_id = s.sensors_id
    JOIN {measurands} m ON m.measurands_id = s.measurands_id GROUP BY 1"""


@query(
    "locations_view",
    "id:i name:s ismobile:b timezone:s ismonitor:b city:s country_code:s country_name:s owner_name:s owner_type:s provider_name:s latitude:f longitude:f "
    "instruments:s sensors:s first_utc:s first_local:s last_local:s countries_id:i parameters:s is_analysis:b manufacturers:s licenses:s license_ids:s providers_id:i",
    f"""SELECT n.sensor_nodes_id AS id, n.site_name AS name, n.ismobile, t.tzid AS timezone, ni.ismonitor, n.city, c.iso AS country_code, c.name AS country_name,
      oc.full_name AS owner_name, oc.entity_type AS owner_type, p.label AS provider_name, n.lat AS latitude, n.lon AS longitude, ni.instruments, ns.sensors,
      {format_sql("'UTC'", 'ns.first')} AS first_utc, {format_sql('t.tzid', 'ns.first')} AS first_local, {format_sql('t.tzid', 'ns.last')} AS last_local,
      c.countries_id, ns.parameters, regexp_matches(oc.entity_type, 'research', 'i') AS is_analysis, ni.manufacturers, ll.licenses, ll.license_ids, n.providers_id
    FROM {{sensor_nodes}} n JOIN {{timezones}} t ON t.timezones_id = n.timezones_id JOIN {{countries}} c ON c.countries_id = n.countries_id
    JOIN {{entities}} oc ON oc.entities_id = n.owner_entities_id JOIN {{providers}} p ON p.providers_id = n.providers_id
    JOIN {{node_instruments}} ni ON ni.sensor_nodes_id = n.sensor_nodes_id JOIN {{node_sensors}} ns ON ns.sensor_nodes_id = n.sensor_nodes_id
    LEFT JOIN {{loc_licenses}} ll ON ll.sensor_nodes_id = n.sensor_nodes_id WHERE n.is_public""",
    {"node_instruments": _NODE_INSTRUMENTS, "node_sensors": _NODE_SENSORS, "loc_licenses": _LOC_LICENSES},
)
def _(f):
    cents = F.transform(
        "sensors",
        lambda s: F.concat_ws(
            "|", s["id"].cast("string"), s["name"], s["parameter"]["id"].cast("string"),
            F.round(s["parameter"]["value_last"] * 100).cast("bigint").cast("string"), s["parameter"]["display_name"],
        ),
    )
    return locations(f).select(
        "id", "name", "ismobile", "timezone", "ismonitor", "city", F.col("country.code").alias("country_code"), F.col("country.name").alias("country_name"),
        F.col("owner.name").alias("owner_name"), F.col("owner.type").alias("owner_type"), F.col("provider.name").alias("provider_name"),
        F.col("coordinates.latitude").alias("latitude"), F.col("coordinates.longitude").alias("longitude"),
        listed("instruments", "id", "name", "manufacturer.id", "manufacturer.name").alias("instruments"), F.array_join(cents, ";").alias("sensors"),
        F.col("datetime_first.utc").alias("first_utc"), F.col("datetime_first.local").alias("first_local"),
        F.col("datetime_last.local").alias("last_local"), "countries_id", plain_list("parameters").alias("parameters"), "is_analysis",
        plain_list("manufacturers").alias("manufacturers"),
        listed("licenses", "id", "name", "date_from", "date_to", "attribution.name", "attribution.url").alias("licenses"),
        plain_list("license_ids").alias("license_ids"), "providers_id",
    )


@query(
    "locations_manufacturers", "id:i manufacturers:s",
    """SELECT id, string_agg(label || '|' || full_name, ';' ORDER BY label, full_name) AS manufacturers FROM (SELECT DISTINCT n.sensor_nodes_id AS id, i.label, e.full_name
      FROM {sensor_nodes} n JOIN {sensor_systems} y ON y.sensor_nodes_id = n.sensor_nodes_id JOIN {instruments} i ON i.instruments_id = y.instruments_id
      JOIN {entities} e ON e.entities_id = i.manufacturer_entities_id WHERE n.is_public) x GROUP BY id""",
)
def _(f):
    rows = catalog.locations_manufacturers(f.sensor_nodes, f.sensor_systems, f.instruments, f.entities)
    return rows.withColumn("manufacturers", listed("manufacturers", "modelName", "manufacturerName"))


@query(
    "locations_latest_measurements", "id:i measurements:s counts:s parameters:s total_count:i",
    """SELECT n.sensor_nodes_id AS id, string_agg(concat_ws('|', m.measurand, m.measurands_id, m.units, CAST(round(l.value_latest * 100) AS BIGINT), epoch_us(l.datetime_last),
        n.source_name, l.value_count, s.data_averaging_period_seconds), ';' ORDER BY m.measurand, m.measurands_id, m.units, l.value_latest NULLS FIRST, l.datetime_last) AS measurements,
      string_agg(concat_ws('|', m.measurands_id, m.measurand || ' ' || m.units, l.value_count), ';' ORDER BY m.measurands_id, l.value_count) AS counts,
      string_agg(m.measurand, ',' ORDER BY m.measurand) AS parameters, sum(l.value_count) AS total_count
    FROM {sensor_nodes} n JOIN {sensor_systems} y ON y.sensor_nodes_id = n.sensor_nodes_id JOIN {sensors} s ON s.sensor_systems_id = y.sensor_systems_id
    JOIN {lifetime} l ON l.sensors_id = s.sensors_id JOIN {measurands} m ON m.measurands_id = s.measurands_id WHERE n.is_public GROUP BY 1""",
)
def _(f):
    rows = catalog.locations_latest_measurements(f.sensor_nodes, f.sensor_systems, f.sensors, f.measurands, f.lifetime)
    told = F.transform(
        "measurements",
        lambda x: F.concat_ws(
            "|", x["parameter"], x["id"].cast("string"), x["unit"], F.round(x["value"] * 100).cast("bigint").cast("string"),
            F.unix_micros(x["lastUpdated"]).cast("string"), x["sourceName"], x["count"].cast("string"), x["averagingPeriod"]["value"].cast("string"),
        ),
    )
    return rows.select(
        "id", F.array_join(told, ";").alias("measurements"), listed("counts", "id", "parameter", "count").alias("counts"),
        plain_list("parameters").alias("parameters"), "total_count",
    )


@query(
    "source_stats", "source_name:s nodes_total:i nodes_added:i nodes_active:i last_modified:t",
    f"""SELECT source_name, count(*) AS nodes_total, count(*) FILTER (WHERE added_on > TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS nodes_added,
      count(*) FILTER (WHERE last_modified > TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS nodes_active, max(last_modified) AS last_modified
    FROM (SELECT n.sensor_nodes_id, p.source_name, n.added_on, (SELECT max(l.modified_on) FROM {{lifetime}} l JOIN {{stations}} c ON c.sensors_id = l.sensors_id
      WHERE c.sensor_nodes_id = n.sensor_nodes_id) AS last_modified FROM {{sensor_nodes}} n JOIN {{providers}} p ON p.providers_id = n.providers_id) x GROUP BY 1""",
)
def _(f):
    return catalog.source_stats(f.sensor_nodes, f.providers, f.stations, f.lifetime, AS_OF)


def _parameters_sql(owner: str) -> str:
    return f"""SELECT {owner}, min(first) AS datetime_first, max(last) AS datetime_last, sum(n) AS measurements_count,
      string_agg(concat_ws('|', m.measurands_id, m.measurand, m.units), ';' ORDER BY m.measurands_id) AS parameters,
      string_agg(CAST(m.measurands_id AS VARCHAR), ',' ORDER BY m.measurands_id) AS parameter_ids
    FROM (SELECT c.{owner}, c.measurands_id, min(l.datetime_first) AS first, max(l.datetime_last) AS last, sum(l.value_count) AS n
      FROM {{stations}} c JOIN {{lifetime}} l ON l.sensors_id = c.sensors_id WHERE c.node_is_public AND c.sensor_is_public GROUP BY 1, 2) x
    JOIN {{measurands}} m ON m.measurands_id = x.measurands_id GROUP BY 1"""


@query(
    "countries_view",
    "id:i name:s code:s datetime_first:t datetime_last:t measurements_count:i locations_count:i providers_count:i parameters:s parameter_ids:s providers_ids:s",
    """SELECT c.countries_id AS id, c.name, c.iso AS code, datetime_first, datetime_last, measurements_count, locations_count, providers_count, parameters, parameter_ids, providers_ids
    FROM {countries} c JOIN (SELECT countries_id, count(*) AS locations_count, count(DISTINCT providers_id) AS providers_count,
      array_to_string(list_sort(list(DISTINCT providers_id)), ',') AS providers_ids FROM {sensor_nodes} GROUP BY 1) l ON l.countries_id = c.countries_id
    LEFT JOIN {rolled} r ON r.countries_id = c.countries_id""", {"rolled": _parameters_sql("countries_id")},
)
def _(f):
    rows = catalog.countries_view(f.countries, f.sensor_nodes, f.stations, f.lifetime, f.measurands)
    return rows.withColumns(
        {"parameters": listed("parameters", "id", "name", "units"), "parameter_ids": plain_list("parameter_ids"), "providers_ids": plain_list("providers_ids")}
    )


@query(
    "providers_view",
    "id:i name:s source_name:s export_prefix:s datetime_first:t datetime_last:t datetime_added:t measurements_count:i locations_count:i countries_count:i "
    "parameters:s parameter_ids:s owner_name:s xmin:f ymin:f xmax:f ymax:f",
    """SELECT p.providers_id AS id, p.label AS name, p.source_name, p.export_prefix, datetime_first, datetime_last, p.added_on AS datetime_added, measurements_count,
      locations_count, countries_count, parameters, parameter_ids, e.full_name AS owner_name, xmin, ymin, xmax, ymax
    FROM {providers} p JOIN {rolled} r ON r.providers_id = p.providers_id JOIN (SELECT providers_id, count(*) AS locations_count, count(DISTINCT countries_id) AS countries_count,
      min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM {sensor_nodes} WHERE is_public GROUP BY 1) l ON l.providers_id = p.providers_id
    JOIN {entities} e ON e.entities_id = p.owner_entities_id WHERE p.is_public""", {"rolled": _parameters_sql("providers_id")},
)
def _(f):
    rows = catalog.providers_view(f.providers, f.sensor_nodes, f.stations, f.lifetime, f.measurands, f.entities)
    return rows.withColumns({"parameters": listed("parameters", "id", "name", "units"), "parameter_ids": plain_list("parameter_ids")}).select(
        "*", F.col("owner_entity.name").alias("owner_name"), "extent.*"
    )


@query(
    "parameters_view", "id:i name:s display_name:s units:s locations_count:i measurements_count:i datetime_first:t datetime_last:t",
    """SELECT m.measurands_id AS id, m.measurand AS name, m.display AS display_name, m.units, count(*) AS locations_count, sum(l.value_count) AS measurements_count,
      min(l.datetime_first) AS datetime_first, max(l.datetime_last) AS datetime_last
    FROM {measurands} m JOIN {stations} c ON c.measurands_id = m.measurands_id LEFT JOIN {lifetime} l ON l.sensors_id = c.sensors_id GROUP BY 1, 2, 3, 4""",
)
def _(f):
    return catalog.parameters_view(f.measurands, f.sensors, f.stations, f.lifetime)


@query(
    "manufacturers", "entities_id:i full_name:s instruments_count:i",
    "SELECT entities_id, full_name, count(*) AS instruments_count FROM {entities} e JOIN {instruments} i ON i.manufacturer_entities_id = e.entities_id GROUP BY 1, 2",
)
def _(f):
    return catalog.manufacturers(f.instruments, f.entities)


_SOURCE_TEXT = """'{{"id":"' || s.slug || '","name":"' || s.name || '"' || CASE WHEN s.readme IS NULL THEN '' ELSE ',"readme":"/v2/sources/readme/' || s.slug || '"' END || '}}'"""


@query(
    "sensor_nodes_sources_view", "sensor_nodes_id:i sources:s",
    f"""SELECT sensor_nodes_id, string_agg(t, ';' ORDER BY t) AS sources FROM (SELECT ns.sensor_nodes_id, {_SOURCE_TEXT} AS t FROM {{sensor_nodes_sources}} ns
      LEFT JOIN {{sources}} s ON s.sources_id = ns.sources_id) x GROUP BY 1""",
)
def _(f):
    rows = catalog.node_sources(f.sensor_nodes_sources, f.sources)
    return rows.withColumn("sources", F.when(F.size("sources") > 0, F.array_join("sources", ";")))


@query(
    "sources_of_nodes", "countries_id:i sources:s",
    f"""SELECT countries_id, string_agg(t, ';' ORDER BY t) AS sources FROM (SELECT DISTINCT n.countries_id, {_SOURCE_TEXT} AS t FROM {{sensor_nodes}} n
      JOIN {{sensor_nodes_sources}} ns ON ns.sensor_nodes_id = n.sensor_nodes_id JOIN {{sources}} s ON s.sources_id = ns.sources_id) x GROUP BY 1""",
)
def _(f):
    rows = catalog.sources_of_nodes(f.sensor_nodes.select("countries_id", "sensor_nodes_id"), f.sensor_nodes_sources, f.sources, "countries_id")
    return rows.withColumn("sources", F.array_join("sources", ";"))


@query(
    "source_in_nodes", "request_id:i found:b",
    """SELECT o_orderkey AS request_id, EXISTS (SELECT 1 FROM {sensor_nodes_sources} ns JOIN {sources} s ON s.sources_id = ns.sources_id
      WHERE ns.sensor_nodes_id = o.o_custkey AND s.slug = 'slug-' || CAST(o.o_orderkey % 30 AS VARCHAR)) AS found FROM {orders} o""",
)
def _(f):
    asked = f.sql("SELECT o_orderkey AS request_id, o_custkey AS sensor_nodes_id, concat('slug-', CAST(o_orderkey % 30 AS STRING)) AS slug FROM {orders}")
    return catalog.source_in_nodes(asked, f.sensor_nodes_sources, f.sources)


for _what in ("country", "city"):
    query(
        f"sources_in_{_what}", f"{_what}:s sources_count:i",
        f"""SELECT n.{_what}, count(DISTINCT ns.sources_id) AS sources_count FROM {{sensor_nodes}} n LEFT JOIN {{sensor_nodes_sources}} ns
      ON ns.sensor_nodes_id = n.sensor_nodes_id GROUP BY 1""",
    )(lambda f, what=_what: catalog.sources_per(f.sensor_nodes, f.sensor_nodes_sources, what))


@query(
    "sensor_nodes_ext",
    "sensor_nodes_id:i country:s has_geo:b origin:s k:s own:i inside:s o:f city:s attributed:b sources_count:i first_id:s first_rank:i",
    """SELECT n.sensor_nodes_id, n.country, n.lon IS NOT NULL OR n.ismobile AS has_geo, n.origin, coalesce(n.origin, CAST(n.sensor_nodes_id AS VARCHAR)) AS k,
      n.sensor_nodes_id AS own, 'b' AS inside, CASE WHEN n.origin IS NOT NULL THEN 1.5 END AS o, n.city, false AS attributed,
      count(s.sources_id) AS sources_count, min(s.slug) AS first_id, CAST(arg_min(s.sources_id, s.slug) AS BIGINT) AS first_rank
    FROM {sensor_nodes} n LEFT JOIN {sensor_nodes_sources} l ON l.sensor_nodes_id = n.sensor_nodes_id
    LEFT JOIN {sources} s ON s.sources_id = l.sources_id GROUP BY ALL""",
)
def _(f):
    number = F.col("sensor_nodes_id").cast("string")
    text = F.concat(F.lit('{"k": "'), number, F.lit('", "attribution": "x", "gone": null, "own": ['), number, F.lit(', {"a": "b"}]}'))
    nodes = f.sensor_nodes.withColumn("metadata", text)
    history = f.sensor_nodes.select(
        "sensor_nodes_id", F.array("city").alias("cities"), F.array("source_name").alias("source_names"), F.array("site_name").alias("site_names")
    )
    origins = f.sensor_nodes.select("origin").where(F.col("origin").isNotNull()).distinct()
    origins = origins.withColumn("metadata", F.to_json(F.struct(F.col("origin").alias("k"), F.lit(1.5).alias("o"))))
    told = f.sources.withColumn("metadata", F.to_json(F.struct(F.col("sources_id").alias("rank"))))
    rows = catalog.sensor_nodes_ext(nodes, history, origins, catalog.node_sources(f.sensor_nodes_sources, told))
    whole, field = F.parse_json("metadata"), lambda path: F.get_json_object("metadata", path)
    return rows.select(
        "sensor_nodes_id", "country", "has_geo", "origin", field("$.k").alias("k"),
        F.try_variant_get(whole, "$.own[0]", "bigint").alias("own"), field("$.own[1].a").alias("inside"),
        F.try_variant_get(whole, "$.o", "double").alias("o"), F.try_variant_get(whole, "$.pvals.cities[0]", "string").alias("city"),
        F.col("metadata").rlike("attribution|gone").alias("attributed"),
        F.coalesce(F.json_array_length(field("$.sources")), F.lit(0)).alias("sources_count"), field("$.sources[0].id").alias("first_id"),
        F.try_variant_get(whole, "$.sources[0].rank", "bigint").alias("first_rank"),
    )


@query(
    "sensor_nodes_check",
    "sensor_nodes_id:i site_name:s source_name:s source_id:s origin:s provider:s lon:f lat:f timezone:s utc_offset:i sensors_id:i parameter:s "
    "datetime_first:t datetime_last:t percent_complete:f sensor_added_on:t node_added_on:t", NODE_CHECK,
)
def _(f):
    return node_check(f)


@query(
    "sensor_nodes_summary",
    "sensor_nodes_id:i site_name:s source_name:s ismobile:b has_coordinates:b systems_count:i sensors_count:i parameters_count:i distinct_systems_count:i sensors_list:s",
    """SELECT n.sensor_nodes_id, n.site_name, n.source_name, n.ismobile, n.lon IS NOT NULL AS has_coordinates, count(y.sensor_systems_id) AS systems_count,
      count(s.sensors_id) AS sensors_count, count(DISTINCT s.measurands_id) AS parameters_count, count(DISTINCT y.sensor_systems_id) AS distinct_systems_count,
      string_agg(concat_ws('|', s.sensors_id, m.measurand), ';' ORDER BY s.sensors_id) AS sensors_list
    FROM {sensor_nodes} n LEFT JOIN {sensor_systems} y ON y.sensor_nodes_id = n.sensor_nodes_id LEFT JOIN {sensors} s ON s.sensor_systems_id = y.sensor_systems_id
    LEFT JOIN {measurands} m ON m.measurands_id = s.measurands_id GROUP BY 1, 2, 3, 4, 5""",
)
def _(f):
    rows = catalog.sensor_nodes_summary(f.sensor_nodes, f.sensor_systems, f.sensors, f.measurands)
    return rows.withColumn("sensors_list", listed("sensors_list", "sensors_id", "measurand"))


@query(
    "providers_check", "label:s datetime_first:t datetime_last:t sensor_nodes_count:i sensors_avg:f sensors_count:i",
    """SELECT p.label, min(a) AS datetime_first, max(b) AS datetime_last, count(*) AS sensor_nodes_count, round(avg(n), 1) AS sensors_avg, sum(n) AS sensors_count
    FROM (SELECT c.sensor_nodes_id, c.providers_id, min(l.datetime_first) AS a, max(l.datetime_last) AS b, count(*) AS n FROM {lifetime} l
      JOIN {stations} c ON c.sensors_id = l.sensors_id GROUP BY 1, 2) x JOIN {providers} p ON p.providers_id = x.providers_id GROUP BY 1""",
)
def _(f):
    return catalog.providers_check(f.lifetime, f.stations, f.providers)


@query(
    "user_lists_view",
    "lists_id:i owner_id:i users_id:i role:s label:s visibility:s user_count:i locations_count:i sensor_nodes_ids:s x0:f y0:f x1:f y1:f bbox:s",
    """WITH members AS (SELECT lists_id, users_id, role FROM {users_lists} UNION SELECT lists_id, users_id, 'owner' FROM {lists}),
    nodes AS (SELECT lists_id, count(*) AS locations_count, array_to_string(list_sort(list(s.sensor_nodes_id)), ',') AS sensor_nodes_ids, min(lon) AS x0, min(lat) AS y0,
      max(lon) AS x1, max(lat) AS y1 FROM {sensor_nodes_list} s JOIN {sensor_nodes} n ON n.sensor_nodes_id = s.sensor_nodes_id GROUP BY 1)
    SELECT l.lists_id, l.users_id AS owner_id, m.users_id, m.role, l.label, l.visibility, (SELECT count(*) FROM members c WHERE c.lists_id = l.lists_id) AS user_count,
      coalesce(n.locations_count, 0) AS locations_count, n.sensor_nodes_ids, n.x0, n.y0, n.x1, n.y1,
      CASE WHEN (x0 < x1 AND y0 < y1) OR (x0 = x1 AND y0 = y1)
        THEN concat_ws(' ', CAST(x0 AS BIGINT), CAST(y0 AS BIGINT), CAST(x0 AS BIGINT), CAST(y1 AS BIGINT), CAST(x1 AS BIGINT), CAST(y1 AS BIGINT), CAST(x1 AS BIGINT), CAST(y0 AS BIGINT), CAST(x0 AS BIGINT), CAST(y0 AS BIGINT))
        ELSE '-180 -90 -180 90 180 90 180 -90 -180 -90' END AS bbox
    FROM {lists} l JOIN members m ON m.lists_id = l.lists_id LEFT JOIN nodes n ON n.lists_id = l.lists_id""",
)
def _(f):
    rows = catalog.user_lists_view(f.lists, f.users_lists, f.sensor_nodes_list, f.sensor_nodes)
    ring = F.array_join(F.transform(F.flatten("bbox"), lambda x: x.cast("bigint").cast("string")), " ")
    return rows.select("*", "bounds.*").withColumn("bbox", ring).withColumn("sensor_nodes_ids", plain_list("sensor_nodes_ids"))


# ---- versions, duplicates, groups --------------------------------------------------------------

_VERSIONS = "SELECT versions_id, sensors_id, parent_sensors_id, sensor_statuses_id, CAST(DATE '2020-01-01' + version_day AS DATE) AS version_date FROM {versions}"
_RANKS = """SELECT v.versions_id, v.parent_sensors_id, v.sensors_id, v.sensor_statuses_id, v.version_date, s.sort_order, s.label,
      row_number() OVER (PARTITION BY v.parent_sensors_id ORDER BY v.version_date DESC, s.sort_order DESC, v.versions_id) AS version_rank
    FROM {dated} v JOIN {sensor_statuses} s ON s.sensor_statuses_id = v.sensor_statuses_id"""
_V = {"dated": _VERSIONS, "ranks": _RANKS}


def _versions(f):
    return f.versions.withColumn("version_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("version_day")))


def _ranks(f):
    return catalog.version_ranks(_versions(f), f.sensor_statuses)


@query("version_ranks", "versions_id:i parent_sensors_id:i sensors_id:i sensor_statuses_id:i version_date:d sort_order:i label:s version_rank:i", _RANKS, _V)
def _(f):
    return _ranks(f)


@query(
    "versions_view", "versions_id:i sensors_id:i parent_sensors_id:i sensor:s parent_sensor:s version_date:d life_cycle:s version_rank:i sensor_nodes_id:i",
    """SELECT r.versions_id, r.sensors_id, r.parent_sensors_id, s.source_id AS sensor, p.source_id AS parent_sensor, r.version_date, r.label AS life_cycle, r.version_rank, y.sensor_nodes_id
    FROM {ranks} r JOIN {sensors} s ON s.sensors_id = r.sensors_id JOIN {sensors} p ON p.sensors_id = r.parent_sensors_id
    JOIN {sensor_systems} y ON y.sensor_systems_id = s.sensor_systems_id""", _V,
)
def _(f):
    return catalog.versions_view(_ranks(f), f.sensors, f.sensor_systems)


@query(
    "stale_versions", "sensors_id:i",
    "SELECT sensors_id FROM {ranks} WHERE version_rank > 1 UNION ALL SELECT parent_sensors_id FROM {dated}", _V,
)
def _(f):
    return catalog.stale_versions(_ranks(f), _versions(f))


_NEAR = "SELECT * REPLACE (lon - lon % 20 AS lon, lat - lat % 20 AS lat) FROM {sensor_nodes}"


def _duplicates_sql(nodes: str, grouper: str, systems: bool) -> str:
    extra = "(SELECT min(q.sensor_systems_id) FROM {sensor_systems} q WHERE q.sensor_nodes_id = c.sensor_nodes_id)" if systems else "0"
    has = "WHERE new_sensor_systems_id IS NOT NULL" if systems else ""
    return f"""WITH ranked AS (SELECT *, {grouper} AS grouper, row_number() OVER (PARTITION BY source_name, {grouper} ORDER BY source_id, sensor_nodes_id) AS sensor_nodes_rw
        FROM {{{nodes}}} WHERE {grouper} IS NOT NULL),
      same AS (SELECT * FROM (SELECT r.*, c.sensor_nodes_id AS new_sensor_nodes_id, {extra} AS new_sensor_systems_id FROM ranked r
        JOIN ranked c ON c.source_name = r.source_name AND c.grouper = r.grouper AND c.sensor_nodes_rw = 1) z {has}),
      rows AS (SELECT m.new_sensor_nodes_id, m.sensor_nodes_rw, m.sensor_nodes_id, s.sensors_id, s.measurands_id, m.grouper, m.new_sensor_systems_id,
        row_number() OVER (PARTITION BY m.new_sensor_nodes_id, s.measurands_id ORDER BY s.added_on, s.sensors_id) AS rw
        FROM {{sensors}} s JOIN {{sensor_systems}} y ON y.sensor_systems_id = s.sensor_systems_id JOIN same m ON m.sensor_nodes_id = y.sensor_nodes_id)
    SELECT a.*, b.sensors_id AS new_sensors_id FROM rows a JOIN rows b ON b.new_sensor_nodes_id = a.new_sensor_nodes_id AND b.measurands_id = a.measurands_id AND b.rw = 1"""


_DUP = "new_sensor_nodes_id:i sensor_nodes_rw:i sensor_nodes_id:i sensors_id:i measurands_id:i rw:i new_sensors_id:i"


@query("rank_duplicates_by_geom", _DUP, _duplicates_sql("near", "CAST(CAST(lon AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(lat AS BIGINT) AS VARCHAR)", False), {"near": _NEAR})
def _(f):
    near = f.sensor_nodes.withColumn("lon", F.col("lon") - F.col("lon") % 20).withColumn("lat", F.col("lat") - F.col("lat") % 20)
    return catalog.rank_duplicates(near, f.sensor_systems, f.sensors)


@query(
    "rank_duplicates_by_pattern", _DUP + " new_sensor_systems_id:i grouper:s",
    _duplicates_sql("sensor_nodes", "regexp_replace(source_id, '[0-9]$', '', 'g')", True),
)
def _(f):
    return catalog.rank_duplicates(f.sensor_nodes, f.sensor_systems, f.sensors, by="[0-9]$")


_GROUPS = """SELECT s_suppkey AS groups_id, s_nationkey, CAST(s_suppkey % 10 AS INT) AS p, CAST(s_suppkey % 5 AS INT) AS o, CAST(s_suppkey % 4 AS INT) AS kinds,
  CAST(s_suppkey * 3 % 300 - 180 AS DOUBLE) AS x FROM {supplier}"""


def _group_rules(f):
    g = f.sql(_GROUPS)
    ids = lambda *c: F.array(*[x.cast("bigint") for x in c])
    nobox = F.lit(None).cast("struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    noids = F.lit(None).cast("array<bigint>")
    rule = lambda kind, ids_, box: F.struct(F.lit(kind).alias("kind"), ids_.alias("ids"), box.alias("box"))
    countries = rule("countries_id", F.array_union(ids(F.col("s_nationkey")), ids((F.col("s_nationkey") + 1) % 25, (F.col("s_nationkey") + 7) % 25)), nobox)
    providers = rule("providers_id", ids(F.col("p"), (F.col("p") + 3) % 10), nobox)
    owners = rule("users_id", ids(F.col("o"), (F.col("o") + 1) % 5), nobox)
    box = rule("geom", noids, F.struct(F.col("x").alias("xmin"), F.lit(-60.0).alias("ymin"), (F.col("x") + 60).alias("xmax"), F.lit(70.0).alias("ymax")))
    chosen = (
        F.when(F.col("kinds") == 0, F.array(countries)).when(F.col("kinds") == 1, F.array(providers, owners))
        .when(F.col("kinds") == 2, F.array(providers, box)).otherwise(F.array(box, owners, countries))
    )
    return g.select("groups_id", F.explode(chosen).alias("r")).select("groups_id", "r.*")


@query(
    "group_members", "groups_id:i sensor_nodes_id:i",
    """SELECT g.groups_id, n.sensor_nodes_id FROM {grouped} g, {sensor_nodes} n WHERE n.is_public
      AND (kinds NOT IN (0, 3) OR n.countries_id IN (s_nationkey, (s_nationkey + 1) % 25, (s_nationkey + 7) % 25))
      AND (kinds NOT IN (1, 2) OR n.providers_id IN (p, (p + 3) % 10)) AND (kinds NOT IN (1, 3) OR n.owner_entities_id IN (o, (o + 1) % 5))
      AND (kinds NOT IN (2, 3) OR (n.lon BETWEEN x AND x + 60 AND n.lat BETWEEN -60 AND 70))""", {"grouped": _GROUPS},
)
def _(f):
    places = f.sensor_nodes.where(F.col("is_public")).select(
        F.col("sensor_nodes_id").alias("id"), "countries_id", "providers_id", F.col("owner_entities_id").alias("owner_id"), "lon", "lat"
    )
    return catalog.group_members(_group_rules(f), places)


@query(
    "node_paths", "c_custkey:i path:s",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN '1.' || c_nationkey || '.' || c_custkey
      ELSE c_custkey || '.' || (c_custkey + 1) END AS path FROM {customer} WHERE c_custkey > 30
    UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) WHEN c_custkey % 3 = 1 AND c_custkey IN (1, c_nationkey) THEN '1.' || c_nationkey
      WHEN c_custkey % 3 = 1 THEN '1.' || c_nationkey || '.' || c_custkey ELSE c_custkey || '.' || (c_custkey + 1) END AS path FROM {customer} WHERE c_custkey <= 30""",
)
def _(f):
    ints = lambda *c: F.array(*[x.cast("int") for x in c])
    key = F.col("c_custkey")
    path = F.when(key % 3 == 1, ints(F.lit(1), F.col("c_nationkey"))).when(key % 3 == 2, ints(key, key + 1))
    rows = catalog.node_paths(f.customer.withColumn("path", path), "path", "c_custkey")
    return rows.withColumn("path", F.array_join(F.transform("path", lambda x: x.cast("string")), "."))


@query(
    "node_from_sensor", "event_id:i sensor_nodes_id:i",
    "SELECT event_id, c.sensor_nodes_id FROM {events} e LEFT JOIN {stations} c ON c.sensors_id = e.event_id",
)
def _(f):
    return catalog.node_from_sensor(f.sql("SELECT event_id, event_id AS sensors_id FROM {events}"), f.stations)


@query(
    "nodes_from_sensors", "grp:i nodes:s",
    """SELECT user_id AS grp, coalesce(string_agg(DISTINCT CAST(c.sensor_nodes_id AS VARCHAR), ',' ORDER BY CAST(c.sensor_nodes_id AS VARCHAR)), '') AS nodes
    FROM {events} e LEFT JOIN {stations} c ON c.sensors_id = e.event_id GROUP BY 1""",
)
def _(f):
    asked = f.sql("SELECT user_id AS grp, event_id AS sensors_id FROM {events}")
    made = catalog.nodes_from_sensors(asked, f.stations, "grp")
    return made.select("grp", F.array_join(F.array_sort(F.col("sensor_nodes_ids").cast("array<string>")), ",").alias("nodes"))


@query(
    "countries_of_nodes", "grp:i countries:s",
    """SELECT o_custkey % 50 AS grp, coalesce(string_agg(DISTINCT n.country, ',' ORDER BY n.country), '') AS countries FROM {orders} o JOIN {sensor_nodes} n ON n.sensor_nodes_id = o.o_custkey GROUP BY 1""",
)
def _(f):
    asked = f.sql("SELECT o_custkey % 50 AS grp, o_custkey AS sensor_nodes_id FROM {orders}")
    return catalog.countries_of_nodes(asked, f.sensor_nodes, "grp").withColumn("countries", F.array_join("countries", ","))


@query(
    "parameter_of_sensor", "sensors_id:i parameter:s",
    """SELECT s.sensors_id, '{{"parameterId":' || m.measurands_id || ',"parameter":"' || m.measurand || '","unit":"' || m.units || '","displayName":"' || m.display || '"}}' AS parameter
    FROM {sensors} s JOIN {measurands} m ON m.measurands_id = s.measurands_id""",
)
def _(f):
    told = catalog.parameter_object(f.measurands).withColumn("parameter", F.to_json("parameter"))
    return f.sensors.select("sensors_id", "measurands_id").join(told, "measurands_id")


@query(
    "mfr", "p_partkey:i manufacturer:s model:s",
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 AND p_size % 4 <> 0 THEN p_brand END AS manufacturer, CASE WHEN p_size % 3 <> 0 AND p_size % 4 <> 0 THEN p_name END AS model FROM {part}""",
)
def _(f):
    maker = F.when(F.col("p_size") % 3 != 0, F.col("p_brand"))
    model = F.when(F.col("p_size") % 4 != 0, F.col("p_name"))
    told = f.part.select("p_partkey", catalog.mfr(maker, model).alias("m"))
    return told.select("p_partkey", F.col("m.manufacturerName").alias("manufacturer"), F.col("m.modelName").alias("model"))


@query(
    "deployment_adapters_view", "deployments_id:i label:s queue_name:s temporal_offset:i adapters:s filename_prefix:s output_format:s",
    f"""SELECT d.deployments_id, d.label, h.queue_name, d.temporal_offset, {ADAPTER_TEXT} AS adapters, d.filename_prefix, h.output_format
    FROM {{deployments}} d JOIN {{handlers}} h ON h.handlers_id = d.handlers_id""",
)
def _(f):
    return deployment_adapters(f).withColumn("adapters", adapter_text())


@query("array_merge_distinct", "c_nationkey:i segments:s",
       "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM {customer} GROUP BY 1")
def _(f):
    # arrays of one group are merged and made distinct; map-side sets keep them short
    rows = f.customer.groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("a"))
    return rows.select("c_nationkey", F.array_join(F.sort_array(textops.distinct_elements(F.col("a"))), ",").alias("segments"))
