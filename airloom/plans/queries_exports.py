"""Queries: sources and sinks, exports, and export bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import timeops
from airloom.operators import exports, upsert
from airloom.plans.frames import AS_OF, AS_OF_ORDERS
from airloom.plans.registry import query
from airloom.session import shared_folder
from airloom.sources import export_run, files

MID = "1998-06-15 12:00:00"


def _zones(f):
    return f.sensor_nodes.join(f.timezones, "timezones_id", "left").select("sensor_nodes_id", "tzid")


_ZONES = "SELECT n.sensor_nodes_id, t.tzid FROM {sensor_nodes} n LEFT JOIN {timezones} t ON t.timezones_id = n.timezones_id"


_RAW = """SELECT l_suppkey*5 + l_linenumber % 5 AS sensors_id, l_shipdate AS datetime, l_quantity AS value, l_extendedprice AS price FROM {lineitem}"""


@query(
    "insert_absent", "sensors_id:i datetime:t value:f",
    """SELECT sensors_id, datetime, CASE WHEN sensors_id % 2 = 0 THEN -min(value) ELSE min(value) END AS value FROM {raw} GROUP BY 1, 2""", {"raw": _RAW},
)
def _(f):
    rows, keys = f.sql(_RAW).select("sensors_id", "datetime", "value"), ["sensors_id", "datetime"]
    held = rows.where(F.col("sensors_id") % 2 == 0).groupBy(*keys).agg((-F.min("value")).alias("value"))
    return upsert.insert_absent(held, rows, keys)


@query(
    "upsert_merge_rules", "c_custkey:i total:f first:t last:t n:i status:s",
    """WITH b AS (SELECT o_custkey, sum(o_totalprice) AS total, min(o_orderdate) AS first, max(o_orderdate) AS last, count(*) AS n, max(o_orderstatus) AS status
      FROM {orders} WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1),
    a AS (SELECT o_custkey, sum(o_totalprice) AS total, min(o_orderdate) AS first, max(o_orderdate) AS last, count(*) AS n, min(o_orderstatus) AS status
      FROM {orders} WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT coalesce(a.o_custkey, b.o_custkey) AS c_custkey, coalesce(a.total, 0) + coalesce(b.total, 0) AS total, least(a.first, b.first) AS first,
      greatest(a.last, b.last) AS last, CASE WHEN b.n IS NULL THEN a.n ELSE b.n END AS n, coalesce(a.status, b.status) AS status
    FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""",
)
def _(f):
    def part(rows, status):
        return rows.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.sum("o_totalprice").alias("total"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"),
            F.count("*").alias("n"), status("o_orderstatus").alias("status"),
        )

    orders = f.sql("SELECT * FROM {orders}")
    cut = timeops.instant("1998-01-01")
    old, new = part(orders.where(F.col("o_orderdate") < cut), F.min), part(orders.where(F.col("o_orderdate") >= cut), F.max)
    return upsert.upsert(
        old, new, ["c_custkey"], merge={"total": "sum", "first": "least", "last": "greatest", "status": "keep"}
    )


_MAP = """SELECT c_custkey*5 + m AS old_sensors_id, (c_custkey - c_custkey % 3)*5 + m AS sensors_id FROM (SELECT *, {five} AS m FROM {customer}) c"""
_MAP_CHECK = _MAP.replace("{five}", "unnest([0, 1, 2, 3, 4])")


@query(
    "dump_by_period", "sensors_id:i datetime:t value:f lat:f lon:f period:s",
    """SELECT p.sensors_id, datetime, max(value) AS value, lat, lon,
      strftime(TIMESTAMP '2024-01-01' + (epoch_us(datetime) - 1 - epoch_us(TIMESTAMP '2024-01-01')) // 43200000000 * INTERVAL 12 HOUR, '%Y%m%d%H') || '_' ||
      strftime(TIMESTAMP '2024-01-01' + ((epoch_us(datetime) - 1 - epoch_us(TIMESTAMP '2024-01-01')) // 43200000000 + 1) * INTERVAL 12 HOUR, '%Y%m%d%H') AS period
    FROM {measurements} m JOIN {map} p ON p.old_sensors_id = m.sensors_id
    WHERE datetime > TIMESTAMP '2024-01-01' AND datetime <= TIMESTAMP '2024-03-01' GROUP BY ALL""",
    {"map": _MAP_CHECK},
)
def _(f):
    return files.period_rows(f.measurements, f.sql(_MAP), "2024-01-01", "2024-03-01", 43200)


_FORMAT = """strftime(timezone({z}, timezone('UTC', {t})), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {o} < 0 THEN '-' ELSE '+' END ||
   lpad(CAST(abs({o}) // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs({o}) % 3600 // 60 AS VARCHAR), 2, '0')"""


def format_sql(zone: str, at: str) -> str:
    off = f"(CAST(epoch_us(timezone({zone}, timezone('UTC', {at}))) - epoch_us({at}) AS BIGINT) // 1000000)"
    return _FORMAT.replace("{z}", zone).replace("{t}", at).replace("{o}", off)


_EXPORT = f"""SELECT s.sensors_id, n.sensor_nodes_id, n.site_name || '-' || CAST(y.sensor_systems_id AS VARCHAR) AS location, p.measurands_id,
      CASE WHEN n.ismobile THEN 'mobile' ELSE coalesce(lower(n.country), 'no-country') END AS country, n.ismobile, s.source_id AS sensor, m.datetime,
      t.tzid AS tz, {format_sql('t.tzid', 'm.datetime')} AS datetime_str, p.measurand, p.units, m.value,
      CASE WHEN n.ismobile THEN m.lon ELSE n.lon END AS lon, CASE WHEN n.ismobile THEN m.lat ELSE n.lat END AS lat, pr.export_prefix AS provider
    FROM {{measurements}} m JOIN {{sensors}} s ON s.sensors_id = m.sensors_id JOIN {{measurands}} p ON p.measurands_id = s.measurands_id
    JOIN {{sensor_systems}} y ON y.sensor_systems_id = s.sensor_systems_id JOIN {{sensor_nodes}} n ON n.sensor_nodes_id = y.sensor_nodes_id
    JOIN {{segment_providers}} pr ON pr.source_name = n.source_name JOIN {{timezones}} t ON t.timezones_id = n.timezones_id"""


def _export(f):
    return exports.measurement_data_export(
        f.measurements, f.sensors, f.sensor_systems, f.sensor_nodes, f.timezones, f.measurands, f.segment_providers
    )


@query(
    "measurement_data_export",
    "sensors_id:i sensor_nodes_id:i location:s measurands_id:i country:s ismobile:b sensor:s datetime:t tz:s datetime_str:s "
    "measurand:s units:s value:f lon:f lat:f provider:s", _EXPORT,
)
def _(f):
    return _export(f)


@query(
    "open_data_query", "sensors_id:i datetime:t value:f measurands_id:i",
    """SELECT m.sensors_id, datetime, value, measurands_id FROM {measurements} m JOIN {stations} c ON c.sensors_id = m.sensors_id
    WHERE sensor_nodes_id = 2 AND datetime > TIMESTAMP '2024-01-10' AND datetime <= TIMESTAMP '2024-01-11'""",
)
def _(f):
    return exports.open_data_rows(f.measurements, f.stations, 2, "2024-01-10")


@query(
    "has_measurement_instant", "datetime:t found:b",
    """SELECT datetime, datetime IN (SELECT datetime FROM {measurements_long}) AS found FROM (SELECT DISTINCT o_orderdate AS datetime FROM {orders}) k""",
)
def _(f):
    keys = f.sql("SELECT DISTINCT o_orderdate AS datetime FROM {orders}")
    return exports.has_measurement(f.measurements_long, keys, "instant")


_HOUR_KEYS = """SELECT DISTINCT added_on AS datetime, CASE sensors_id % 2 WHEN 0 THEN 19800 ELSE 20700 END AS offset_s FROM {measurements}"""


@query(
    "has_measurement_hour", "datetime:t offset_s:i found:b",
    """SELECT k.datetime, k.offset_s, (date_trunc('hour', k.datetime + (k.offset_s - 1) * INTERVAL 1 SECOND), k.offset_s) IN
      (SELECT DISTINCT date_trunc('hour', datetime + (o - 1) * INTERVAL 1 SECOND), o FROM {measurements}, (SELECT unnest([19800, 20700]) AS o) z) AS found
    FROM {keys} k""", {"keys": _HOUR_KEYS},
)
def _(f):
    return exports.has_measurement(f.measurements, f.sql(_HOUR_KEYS), "hour")


@query(
    "has_measurement_day", "day:d found:b",
    """SELECT day, day IN (SELECT CAST(datetime - INTERVAL 1 SECOND AS DATE) FROM {measurements_long}) AS found
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}) k""",
)
def _(f):
    keys = f.sql("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}")
    return exports.has_measurement(f.measurements_long, keys, "day")


@query(
    "has_measurement_sensor", "sensors_id:i found:b",
    "SELECT sensors_id, sensors_id IN (SELECT sensors_id FROM {measurements}) AS found FROM {sensors}",
)
def _(f):
    return exports.has_measurement(f.measurements, f.sensors.select("sensors_id"), "sensor")


_RANGES = """SELECT o_orderdate AS datetime_first, max(o_orderdate) + CAST(max(o_orderkey) % 5 + 1 AS INT) * INTERVAL '1' DAY AS datetime_last,
  max(o_orderdate) + CAST(max(o_orderkey) % 3 AS INT) * INTERVAL '1' DAY AS updated_on, max(o_orderdate) + INTERVAL '1' DAY AS exported_on,
  CASE WHEN count(*) % 2 = 0 THEN NULL ELSE max(o_orderdate) END AS imported_on, CAST(count(*) AS DOUBLE) AS import_time
FROM {orders} GROUP BY o_orderdate"""


@query(
    "latest_measurement_added", "datetime_first:t datetime_last:t updated_on:t",
    """SELECT r.datetime_first, r.datetime_last, max(m.added_on) AS updated_on FROM {ranges} r
    LEFT JOIN {measurements_long} m ON m.datetime > r.datetime_first AND m.datetime <= r.datetime_last GROUP BY 1, 2""",
    {"ranges": _RANGES},
)
def _(f):
    return exports.latest_measurement_added(f.measurements_long, f.sql(_RANGES).select("datetime_first", "datetime_last"))


# ---- bookkeeping --------------------------------------------------------------------------------


@query(
    "reset_export_logs", "sensor_nodes_id:i first_day:d last_day:d days:i records:i measurands:i",
    """SELECT sensor_nodes_id, min(day) AS first_day, max(day) AS last_day, count(day) AS days, sum(records) AS records, max(measurands) AS measurands
    FROM (SELECT sensor_nodes_id, CAST(datetime - INTERVAL 1 SECOND AS DATE) AS day, count(value) AS records, count(DISTINCT measurands_id) AS measurands
      FROM {export} GROUP BY 1, 2) d GROUP BY sensor_nodes_id""", {"export": _EXPORT},
)
def _(f):
    return exports.reset_export_logs(_export(f))[1]


@query(
    "reset_export_logs_existing",
    "sensor_nodes_id:i day:d records:i measurands:i modified_on:t exported_on:t queued_on:t added_on:t",
    f"""SELECT coalesce(l.sensor_nodes_id, d.sensor_nodes_id) AS sensor_nodes_id, coalesce(l.day, d.day) AS day, coalesce(l.records, d.records) AS records,
      coalesce(l.measurands, d.measurands) AS measurands,
      CASE WHEN d.day IS NULL THEN l.modified_on ELSE TIMESTAMP '{AS_OF}' END AS modified_on,
      CASE WHEN d.day IS NULL THEN l.exported_on END AS exported_on, CASE WHEN d.day IS NULL THEN l.queued_on END AS queued_on,
      CASE WHEN l.day IS NULL THEN TIMESTAMP '{AS_OF}' ELSE l.added_on END AS added_on
    FROM {{shifted}} l FULL JOIN (SELECT sensor_nodes_id, CAST(datetime - INTERVAL 1 SECOND AS DATE) AS day, count(value) AS records,
      count(DISTINCT measurands_id) AS measurands FROM {{export}} GROUP BY 1, 2) d ON d.sensor_nodes_id = l.sensor_nodes_id AND d.day = l.day""",
    {"export": _EXPORT, "shifted": "SELECT sensor_nodes_id, CAST(day + 8400 AS DATE) AS day, records, measurands, modified_on, exported_on, queued_on, added_on FROM {export_logs}"},
)
def _(f):
    logs = f.export_logs.select(
        "sensor_nodes_id", F.date_add("day", 8400).alias("day"), "records", "measurands", "modified_on", "exported_on", "queued_on", "added_on"
    )
    return exports.reset_export_logs(_export(f), logs, AS_OF)[0]


@query(
    "modified_location_days", "sensor_nodes_id:i day:d records:i measurands:i modified_on:t wait_seconds:i",
    f"""SELECT l.sensor_nodes_id, day, records, measurands, modified_on,
      (epoch_us(CAST(day + 1 AS TIMESTAMP)) - epoch_us(timezone(z.tzid, timezone('UTC', TIMESTAMP '{AS_OF_ORDERS}')))) // 1000000 AS wait_seconds
    FROM {{export_logs}} l JOIN {{zones}} z ON z.sensor_nodes_id = l.sensor_nodes_id WHERE queued_on IS NULL OR modified_on > queued_on""",
    {"zones": _ZONES},
)
def _(f):
    return exports.modified_location_days(f.export_logs, _zones(f), AS_OF_ORDERS)


_TESTS = f"""day < CAST(timezone(z.tzid, timezone('UTC', TIMESTAMP '{MID}')) - INTERVAL 72 HOUR AS DATE) AS old_enough,
      (exported_on IS NULL OR modified_on > exported_on) AS needs_exporting,
      (queued_on IS NULL OR queued_on < TIMESTAMP '{MID}' - INTERVAL 1 HOUR) AS not_queued, (has_error IS NULL OR NOT has_error) AS error_free"""
_PENDING = f"""SELECT sensor_nodes_id, day, records, measurands, modified_on, queued_on, exported_on,
      (epoch_us(timezone(tzid, timezone('UTC', TIMESTAMP '{MID}'))) - epoch_us(TIMESTAMP '{MID}')) // 1000000 AS utc_offset
    FROM (SELECT l.*, z.tzid, {_TESTS} FROM {{export_logs}} l JOIN {{zones}} z ON z.sensor_nodes_id = l.sensor_nodes_id) x
    WHERE old_enough AND needs_exporting AND not_queued AND error_free"""


@query(
    "pending_location_days", "sensor_nodes_id:i day:d records:i measurands:i modified_on:t queued_on:t exported_on:t utc_offset:i",
    _PENDING, {"zones": _ZONES},
)
def _(f):
    return exports.pending_location_days(f.export_logs, _zones(f), MID)


@query(
    "pending_location_days_check", "old_enough:b needs_exporting:b not_queued:b error_free:b n:i",
    f"""SELECT old_enough, needs_exporting, not_queued, error_free, count(*) AS n
    FROM (SELECT {_TESTS} FROM {{export_logs}} l JOIN {{zones}} z ON z.sensor_nodes_id = l.sensor_nodes_id) x GROUP BY ALL""", {"zones": _ZONES},
)
def _(f):
    return exports.pending_location_days_check(f.export_logs, _zones(f), MID)


_OUTDATED = f"""SELECT l.sensor_nodes_id, day, records, modified_on, queued_on, exported_on,
      (epoch_us(timezone(tzid, timezone('UTC', TIMESTAMP '{MID}'))) - epoch_us(TIMESTAMP '{MID}')) // 1000000 AS utc_offset
    FROM {{export_logs}} l JOIN {{zones}} z ON z.sensor_nodes_id = l.sensor_nodes_id
    WHERE day < DATE '1998-06-15' AND (queued_on IS NULL OR queued_on < TIMESTAMP '{MID}' - INTERVAL 4 HOUR) AND json_extract_string(metadata, '$.error') IS NULL
      AND (exported_on IS NULL OR queued_on > exported_on OR json_extract_string(metadata, '$.version') IS NULL
        OR CAST(json_extract_string(metadata, '$.version') AS INT) < 2)
    ORDER BY day, l.sensor_nodes_id LIMIT 100"""


@query(
    "outdated_location_days", "sensor_nodes_id:i day:d records:i modified_on:t queued_on:t exported_on:t utc_offset:i",
    _OUTDATED, {"zones": _ZONES},
)
def _(f):
    return exports.outdated_location_days(f.export_logs, _zones(f), version=2, limit=100, as_of=MID)


_LOG = "sensor_nodes_id:i day:d records:i modified_on:t queued_on:t exported_on:t metadata:s"


@query(
    "take_outdated_location_days", _LOG,
    f"""SELECT l.* REPLACE (CASE WHEN p.day IS NULL THEN l.queued_on ELSE TIMESTAMP '{MID}' END AS queued_on)
    FROM {{export_logs}} l LEFT JOIN {{outdated}} p ON p.sensor_nodes_id = l.sensor_nodes_id AND p.day = l.day""",
    {"zones": _ZONES, "outdated": _OUTDATED},
)
def _(f):
    return exports.take_outdated(f.export_logs, _zones(f), version=2, limit=100, as_of=MID)[1]


@query(
    "mark_pending", _LOG,
    f"""SELECT l.* REPLACE (CASE WHEN p.day IS NULL THEN l.queued_on ELSE TIMESTAMP '{MID}' END AS queued_on)
    FROM {{export_logs}} l LEFT JOIN {{pending}} p ON p.sensor_nodes_id = l.sensor_nodes_id AND p.day = l.day""",
    {"zones": _ZONES, "pending": _PENDING},
)
def _(f):
    return exports.mark_pending(f.export_logs, exports.pending_location_days(f.export_logs, _zones(f), MID), MID)


_DONE = """SELECT l_suppkey AS sensor_nodes_id, CAST(l_shipdate AS DATE) AS day, CAST(sum(l_quantity) AS BIGINT) AS records
FROM {lineitem} WHERE l_returnflag = 'A' GROUP BY 1, 2"""


@query(
    "mark_exported", _LOG,
    f"""SELECT l.* REPLACE (CASE WHEN p.day IS NULL THEN l.exported_on ELSE TIMESTAMP '{MID}' END AS exported_on,
      coalesce(p.records, l.records) AS records, CASE WHEN p.day IS NULL THEN l.metadata ELSE '{{{{}}}}' END AS metadata)
    FROM {{export_logs}} l LEFT JOIN {{done}} p ON p.sensor_nodes_id = l.sensor_nodes_id AND p.day = l.day""", {"done": _DONE},
)
def _(f):
    return exports.mark_exported(f.export_logs, f.sql(_DONE), MID)


@query(
    "mark_modified_export_day", _LOG,
    f"""SELECT l.* REPLACE (CASE WHEN p.day IS NULL THEN l.modified_on ELSE TIMESTAMP '{MID}' END AS modified_on)
    FROM {{export_logs}} l LEFT JOIN {{done}} p ON p.sensor_nodes_id = l.sensor_nodes_id AND p.day = l.day""", {"done": _DONE},
)
def _(f):
    return exports.mark_modified_day(f.export_logs, f.sql(_DONE), MID)


@query(
    "export_stats", "days_modified:i days_added:i days_exported:i days_pending:i",
    f"""SELECT count(*) FILTER (WHERE modified_on > added_on AND modified_on > TIMESTAMP '{MID}' - INTERVAL 400 DAY) AS days_modified,
      count(*) FILTER (WHERE added_on > TIMESTAMP '{MID}' - INTERVAL 400 DAY) AS days_added,
      count(*) FILTER (WHERE exported_on > TIMESTAMP '{MID}' - INTERVAL 400 DAY) AS days_exported,
      count(*) FILTER (WHERE exported_on IS NULL AND NOT has_error) AS days_pending FROM {{export_logs}}""",
)
def _(f):
    return exports.export_stats(f.export_logs, 400 * 86400, MID)


@query(
    "open_data_export_status",
    "exported:b checked:b has_error:b queued:b message:s n:i first_day:d last_day:d first_exported:t last_exported:t first_checked:t last_checked:t",
    """SELECT exported_on IS NOT NULL AS exported, checked_on IS NOT NULL AS checked, has_error, queued_on IS NOT NULL AS queued,
      substring(json_extract_string(metadata, '$.message'), 1, 29) AS message, count(*) AS n, min(day) AS first_day, max(day) AS last_day,
      min(exported_on) AS first_exported, max(exported_on) AS last_exported, min(checked_on) AS first_checked, max(checked_on) AS last_checked
    FROM {export_logs} GROUP BY 1, 2, 3, 4, 5""",
)
def _(f):
    return exports.open_data_export_status(f.export_logs)


@query(
    "exports_per_day", "exported_day:d n:i first_day:d median_date:d last_day:d first_exported:t last_exported:t",
    f"""SELECT CAST(exported_on AS DATE) AS exported_day, count(*) AS n, min(day) AS first_day,
      CAST(make_timestamp(CAST(floor(quantile_cont(epoch_us(CAST(day AS TIMESTAMP)) / 1e6, 0.5) / 86400) AS BIGINT) * 86400000000) AS DATE) AS median_date,
      max(day) AS last_day, min(exported_on) AS first_exported, max(exported_on) AS last_exported
    FROM {{export_logs}} WHERE exported_on > CAST(TIMESTAMP '{MID}' AS DATE) - 30 GROUP BY 1""",
)
def _(f):
    return exports.exports_per_day(f.export_logs, MID)


@query(
    "fill_ranges", "datetime_first:t datetime_last:t",
    """SELECT a AS datetime_first, a + INTERVAL 12 HOUR AS datetime_last FROM
      (SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2004-01-01', INTERVAL 12 HOUR)) AS a) s
    WHERE NOT EXISTS (SELECT 1 FROM {ranges} r WHERE r.datetime_first < a + INTERVAL 12 HOUR AND r.datetime_last > a)""", {"ranges": _RANGES},
)
def _(f):
    return exports.fill_ranges(f.sql(_RANGES), "1990-01-01", "2004-01-01", 43200)


@query(
    "stale_ranges", "datetime_first:t datetime_last:t updated_on:t exported_on:t",
    "SELECT datetime_first, datetime_last, updated_on, exported_on FROM {ranges} WHERE updated_on > exported_on", {"ranges": _RANGES},
)
def _(f):
    return exports.stale_ranges(f.sql(_RANGES))[0]


@query(
    "import_time_stats", "n:i min:f avg:f max:f",
    "SELECT count(*) AS n, min(import_time) AS min, avg(import_time) AS avg, max(import_time) AS max FROM {ranges} WHERE imported_on IS NOT NULL",
    {"ranges": _RANGES},
)
def _(f):
    return exports.import_time_stats(f.sql(_RANGES))


_NODE_MAP = "SELECT c_custkey AS old_sensor_nodes_id, c_custkey - c_custkey % 4 AS sensor_nodes_id FROM {customer}"


@query(
    "remap_export_logs", "sensor_nodes_id:i day:d records:i key:s bucket:s sec:f error:s version:i old_sensor_nodes_id:i",
    """SELECT m.sensor_nodes_id, day, records, json_extract_string(metadata, '$.Key') AS key, json_extract_string(metadata, '$.Bucket') AS bucket,
      CAST(json_extract_string(metadata, '$.sec') AS DOUBLE) AS sec, json_extract_string(metadata, '$.error') AS error,
      CAST(json_extract_string(metadata, '$.version') AS INT) AS version, m.old_sensor_nodes_id
    FROM {export_logs} l JOIN {node_map} m ON m.old_sensor_nodes_id = l.sensor_nodes_id""", {"node_map": _NODE_MAP},
)
def _(f):
    return exports.remap_export_logs(f.export_logs, f.sql(_NODE_MAP))


@query(
    "lookup_provider_by_name", "c_custkey:i providers_id:i",
    """SELECT c_custkey, p.providers_id FROM {customer} c LEFT JOIN (SELECT lower(label) AS k, min(providers_id) AS providers_id FROM {providers} GROUP BY 1) p
    ON p.k = lower(replace(c.c_name, 'Customer', 'SUPPLIER'))""",
)
def _(f):
    asked = f.sql("SELECT c_custkey, replace(c_name, 'Customer', 'SUPPLIER') AS text FROM {customer}")
    return exports.lookup_by_name(asked, f.providers, "text", "label", "providers_id")


@query(
    "lookup_measurand_by_name", "event_id:i measurands_id:i",
    "SELECT event_id, m.measurands_id FROM {events} e LEFT JOIN {measurands} m ON lower(m.measurand) = lower(upper(e.event_type))",
)
def _(f):
    asked = f.sql("SELECT event_id, upper(event_type) AS text FROM {events}")
    return exports.lookup_by_name(asked, f.measurands, "text", "measurand", "measurands_id")


@query(
    "lookup_timezone_by_name", "c_custkey:i timezones_id:i",
    """SELECT c_custkey, t.timezones_id FROM {customer} c LEFT JOIN {timezones} t
    ON lower(t.tzid) = CASE WHEN c_nationkey % 3 = 0 THEN 'asia/kolkata' WHEN c_nationkey % 3 = 1 THEN 'utc' ELSE 'nowhere' END""",
)
def _(f):
    asked = f.sql(
        """SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'ASIA/KOLKATA' WHEN c_nationkey % 3 = 1 THEN 'Utc' ELSE 'nowhere' END AS text FROM {customer}"""
    )
    return exports.lookup_by_name(asked, f.timezones, "text", "tzid", "timezones_id")


# ---- a whole export run ---------------------------------------------------------------------------------

_MEASURED_DAYS = """SELECT c.sensor_nodes_id, CAST(m.datetime AS DATE) AS day, count(*) AS records, count(DISTINCT c.measurands_id) AS measurands,
  min(m.datetime) AS added_on, max(m.datetime) AS modified_on,
  CASE WHEN c.sensor_nodes_id % 3 = 0 THEN NULL ELSE max(m.datetime) + (c.sensor_nodes_id % 5 - 2) * INTERVAL '1' HOUR END AS exported_on,
  CASE WHEN c.sensor_nodes_id % 4 = 0 THEN NULL ELSE max(m.datetime) + INTERVAL '1' HOUR END AS queued_on,
  c.sensor_nodes_id % 7 = 0 AS has_error, 'earlier' AS metadata
FROM {measurements} m JOIN {stations} c ON c.sensors_id = m.sensors_id GROUP BY c.sensor_nodes_id, CAST(m.datetime AS DATE)"""
_CLAIMED = _PENDING.replace(MID, AS_OF).replace("{export_logs}", "{log}")
_WRITTEN = """SELECT e.*, CAST(timezone(e.tz, timezone('UTC', e.datetime)) - INTERVAL 1 SECOND AS DATE) AS day FROM {export} e"""
_RUN = {"log": _MEASURED_DAYS, "zones": _ZONES, "claimed": _CLAIMED, "export": _EXPORT, "rows": _WRITTEN}


def _run(f):
    path = shared_folder(f.spark, "export")
    logs, done = export_run.run_export(_export(f), f.sql(_MEASURED_DAYS), _zones(f), path, AS_OF)
    return logs, done, path


@query(
    "export_run_files",
    "sensors_id:i sensor_nodes_id:i location:s measurands_id:i country:s ismobile:b sensor:s datetime:t tz:s datetime_str:s "
    "measurand:s units:s value:f lon:f lat:f provider:s day:d",
    "SELECT r.* FROM {rows} r WHERE (sensor_nodes_id, day) IN (SELECT (sensor_nodes_id, day) FROM {claimed})", _RUN,
)
def _(f):
    return files.read_export(f.spark, _run(f)[2])


@query(
    "export_run_log", _LOG,
    f"""SELECT l.* REPLACE (CASE WHEN c.day IS NULL THEN l.queued_on ELSE TIMESTAMP '{AS_OF}' END AS queued_on,
      CASE WHEN c.day IS NULL THEN l.exported_on ELSE TIMESTAMP '{AS_OF}' END AS exported_on,
      CASE WHEN c.day IS NULL THEN l.records ELSE coalesce(w.n, 0) END AS records, CASE WHEN c.day IS NULL THEN l.metadata ELSE '{{{{}}}}' END AS metadata)
    FROM {{log}} l LEFT JOIN {{claimed}} c ON c.sensor_nodes_id = l.sensor_nodes_id AND c.day = l.day
    LEFT JOIN (SELECT sensor_nodes_id, day, count(value) AS n FROM {{rows}} GROUP BY 1, 2) w ON w.sensor_nodes_id = l.sensor_nodes_id AND w.day = l.day""",
    _RUN,
)
def _(f):
    return _run(f)[0]
