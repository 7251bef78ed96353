"""Domain frames derived from the given tables.

One SQL text per frame serves both engines: Spark reads it with the parquet
tables as arguments, and the check engine as a chain of common table
expressions. Tables appear as {name}; `{five}` is the row generator 0..4.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators import rollups
from airloom.operators.context import station_chain, station_context
from airloom.session import configure

AS_OF = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-12-31 00:00:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FRAMES: dict[str, str] = {}

FRAMES["measurands"] = """
SELECT * FROM (VALUES (1,'click','n','Clicks'),(2,'error','n','Errors'),(3,'purchase','usd','Purchases'),
(4,'signup','n','Signups'),(5,'view','n','Views')) AS t(measurands_id, measurand, units, display)"""

FRAMES["timezones"] = """
SELECT r_regionkey AS timezones_id, CASE r_regionkey WHEN 0 THEN 'America/Los_Angeles' WHEN 1 THEN 'Asia/Kolkata'
WHEN 2 THEN 'Asia/Kathmandu' WHEN 3 THEN 'UTC' ELSE 'Pacific/Auckland' END AS tzid FROM {region}"""

FRAMES["thresholds"] = """
SELECT * FROM (VALUES (1,1,50.0),(2,1,100.0),(3,2,50.0),(4,3,75.0),(5,5,25.0)) AS t(thresholds_id, measurands_id, value)"""

FRAMES["flag_types"] = """
SELECT * FROM (VALUES (1,'INFO'),(2,'WARNING'),(3,'ERROR'),(4,'INFO')) AS t(flag_types_id, flag_level)"""

_EVENTS = "(SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events}) e"

FRAMES["measurements"] = f"""
SELECT user_id*5 + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
  WHEN 'signup' THEN 3 ELSE 4 END AS sensors_id, ts AS datetime,
  CASE WHEN k = 13 THEN NULL ELSE value END AS value,
  CAST((user_id*37 + k) % 360 - 180 AS DOUBLE) AS lon, CAST((user_id*13 + k) % 160 - 80 AS DOUBLE) AS lat,
  ts + k * INTERVAL '1' MINUTE AS added_on
FROM {_EVENTS}"""

FRAMES["measurements_long"] = """
SELECT l_suppkey*5 + l_linenumber % 5 AS sensors_id, l_shipdate AS datetime, max(l_quantity) AS value,
  CAST(l_suppkey % 360 - 180 AS DOUBLE) AS lon, CAST(l_suppkey % 160 - 80 AS DOUBLE) AS lat,
  max(l_shipdate) + INTERVAL '2' HOUR AS added_on
FROM {lineitem} GROUP BY 1, 2, 4, 5"""

FRAMES["sensors"] = """
SELECT c_custkey*5 + m AS sensors_id, c_custkey AS sensor_systems_id, CAST(m + 1 AS INT) AS measurands_id,
  concat(c_mktsegment, '-', CAST(c_custkey AS STRING), '-', CAST(m AS STRING)) AS source_id,
  CASE m WHEN 1 THEN 900 WHEN 3 THEN 1800 ELSE 3600 END AS data_averaging_period_seconds,
  CASE m WHEN 2 THEN 600 ELSE 3600 END AS data_logging_period_seconds,
  (c_custkey*5 + m) % 7 <> 0 AS is_public,
  TIMESTAMP '2023-12-01 00:00:00' + (c_custkey % 500) * INTERVAL '1' HOUR AS added_on,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('{{"hourly_frequency": ', CAST(c_custkey % 3 + 1 AS STRING), '}}') END AS metadata
FROM (SELECT *, {five} AS m FROM {customer}) c"""

FRAMES["sensor_systems"] = """
SELECT c_custkey AS sensor_systems_id, c_custkey - c_custkey % 2 AS sensor_nodes_id,
  CAST(c_custkey % 25 AS INT) AS instruments_id, concat('sys-', CAST(c_custkey AS STRING)) AS source_id
FROM {customer}"""

FRAMES["sensor_nodes"] = """
SELECT c_custkey AS sensor_nodes_id, c_name AS site_name, c_mktsegment AS source_name,
  concat(c_mktsegment, '/', CAST(c_custkey AS STRING)) AS source_id, c_custkey % 5 = 0 AS ismobile,
  c_custkey % 11 <> 0 AS is_public, c_nationkey AS countries_id, CASE WHEN c_custkey % 17 < 2 THEN NULL ELSE n_regionkey END AS timezones_id,
  CAST(c_custkey % 10 AS INT) AS providers_id, CAST(c_custkey % 5 AS INT) AS owner_entities_id,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey*37) % 360 - 180 AS DOUBLE) END AS lon,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey*13) % 160 - 80 AS DOUBLE) END AS lat,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE n_name END AS country,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('city ', CAST(c_custkey % 40 AS STRING)) END AS city,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ALPHA' WHEN 2 THEN 'BETA' ELSE 'GAMMA' END AS origin,
  TIMESTAMP '2024-01-20 00:00:00' + (c_custkey % 300) * INTERVAL '1' HOUR AS added_on
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey"""

FRAMES["countries"] = """
SELECT n_nationkey AS countries_id, n_name AS name, substring(n_name, 8, 2) AS iso FROM {nation}"""

FRAMES["providers"] = """
SELECT CAST(s_suppkey AS INT) AS providers_id, s_name AS label, lower(s_name) AS source_name, s_acctbal > 0 AS is_public,
  concat('prefix', CAST(s_suppkey AS STRING)) AS export_prefix, CAST(s_suppkey % 5 AS INT) AS owner_entities_id,
  TIMESTAMP '2020-01-01 00:00:00' + (s_suppkey % 500) * INTERVAL '1' DAY AS added_on
FROM {supplier}"""

FRAMES["segment_providers"] = """
SELECT c_mktsegment AS source_name, CAST(min(c_custkey) AS INT) AS providers_id,
  lower(c_mktsegment) AS export_prefix FROM {customer} GROUP BY c_mktsegment"""

FRAMES["entities"] = """
SELECT r_regionkey AS entities_id, r_name AS full_name,
  CASE r_regionkey % 3 WHEN 0 THEN 'Research Organization' WHEN 1 THEN 'Person' ELSE 'Governmental Organization' END AS entity_type,
  CASE WHEN r_regionkey % 2 = 0 THEN concat('https://', lower(r_name)) ELSE NULL END AS url FROM {region}"""

FRAMES["instruments"] = """
SELECT n_nationkey AS instruments_id, n_name AS label, n_regionkey AS manufacturer_entities_id,
  n_nationkey % 2 = 0 AS is_monitor FROM {nation}"""

FRAMES["licenses"] = """
SELECT * FROM (VALUES (1,'CC0'),(2,'CC BY'),(3,'ODbL')) AS t(licenses_id, name)"""

FRAMES["providers_licenses"] = """
SELECT CAST(s_suppkey AS INT) AS providers_id, CAST(s_suppkey % 3 + 1 AS INT) AS licenses_id,
  make_date(CAST(2010 + s_suppkey % 10 AS INT), 1, 1) AS valid_from,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE make_date(CAST(2020 + s_suppkey % 5 AS INT), 1, 1) END AS valid_to
FROM {supplier}
UNION ALL
SELECT CAST(s_suppkey AS INT), CAST((s_suppkey + 1) % 3 + 1 AS INT), make_date(2000, 6, 1), make_date(2010, 1, 1) FROM {supplier}"""

FRAMES["fetchlogs"] = """
SELECT o_orderkey AS fetchlogs_id,
  concat(CASE WHEN o_custkey % 2 = 0 THEN 'realtime/' ELSE 'stations/' END, CAST(o_orderkey AS STRING)) AS key,
  o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS init_datetime,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate + (o_orderkey % 1440 + o_custkey % 50) * INTERVAL '1' MINUTE END AS loaded_datetime,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + (o_orderkey % 1440 + o_custkey % 90 + 50) * INTERVAL '1' MINUTE END AS completed_datetime,
  o_orderdate + (o_orderkey % 1440 + 3) * INTERVAL '1' MINUTE AS last_modified,
  o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS scheduled_datetime,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate + (o_orderkey % 1440 + 1) * INTERVAL '1' MINUTE END AS queued_datetime,
  CAST(o_custkey % 3 AS INT) AS jobs, o_orderstatus = 'P' AS has_error,
  CAST(floor(o_totalprice/100) AS BIGINT) AS records, CAST(floor(o_totalprice/200) AS BIGINT) AS inserted,
  CAST(floor(o_totalprice) AS BIGINT) AS file_size, o_custkey % 100 AS deployments_id,
  concat('batch-', CAST(o_custkey % 40 AS STRING)) AS batch_uuid
FROM {orders}"""

FRAMES["export_logs"] = """
SELECT l_suppkey AS sensor_nodes_id, CAST(l_shipdate AS DATE) AS day, count(*) AS records,
  count(DISTINCT l_linenumber) AS measurands, l_shipdate + INTERVAL '5' DAY AS modified_on,
  l_shipdate + INTERVAL '1' DAY AS added_on,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_shipdate + CAST(4 + l_suppkey % 4 AS INT) * INTERVAL '1' DAY END AS exported_on,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_shipdate + CAST(3 + l_suppkey % 5 AS INT) * INTERVAL '1' DAY END AS queued_on,
  CASE WHEN l_suppkey % 6 = 0 THEN l_shipdate + INTERVAL '9' DAY ELSE NULL END AS checked_on,
  l_suppkey % 7 = 0 AS has_error,
  CASE WHEN l_suppkey % 7 = 0 THEN concat('{{"error": "e', CAST(l_suppkey % 4 AS STRING), '", "message": "failed while writing the object to storage ', CAST(l_suppkey AS STRING), '"}}')
       ELSE concat('{{"Key": "k', CAST(l_suppkey AS STRING), '", "Bucket": "b", "sec": ', CAST(l_suppkey % 9 AS STRING), '.5, "version": ', CAST(l_suppkey % 3 AS STRING), '}}') END AS metadata
FROM {lineitem} GROUP BY l_suppkey, l_shipdate"""

FRAMES["flags"] = f"""
SELECT event_id AS flags_id, user_id - user_id % 2 AS sensor_nodes_id, k % 4 + 1 AS flag_types_id, ts AS valid_from,
  CASE WHEN k = 50 THEN NULL ELSE ts + (k + 1) * INTERVAL '1' MINUTE END AS valid_to,
  CASE WHEN k % 3 = 0 THEN NULL ELSE user_id*5 + k % 5 END AS only_sensors_id
FROM {_EVENTS}"""

FRAMES["api_logs"] = f"""
SELECT user_id AS api_key, CASE WHEN k < 90 THEN 200 WHEN k < 97 THEN 404 ELSE 500 END AS status_code,
  event_type AS endpoint, concat('agent/', CAST(k % 9 AS STRING)) AS agent,
  CASE WHEN k % 7 = 3 THEN concat('{{{{"locations_id": "', CAST(user_id AS STRING), '"}}}}')
       ELSE concat('{{{{"sensors_id": "', CASE WHEN k % 10 = 0 THEN 'x' ELSE CAST(user_id*5 AS STRING) END, '"}}}}') END AS params,
  value AS timing, ts AS added_on
FROM {_EVENTS}"""

FRAMES["agents"] = """
SELECT n_nationkey AS agents_id, concat('^agent/[', CAST(n_nationkey % 7 AS STRING), CAST((n_nationkey + 2) % 7 AS STRING), ']$') AS pattern FROM {nation}"""

FRAMES["user_keys"] = """
SELECT c_custkey AS token, c_custkey % 100 AS users_id FROM {customer}"""

FRAMES["versions"] = """
SELECT p_partkey AS versions_id, p_partkey AS sensors_id, CAST(floor(p_partkey/3) AS BIGINT) AS parent_sensors_id,
  CAST(p_size % 3 + 1 AS INT) AS sensor_statuses_id, p_size AS version_day FROM {part}"""

FRAMES["sensor_statuses"] = """
SELECT * FROM (VALUES (1,3,'raw'),(2,1,'near-real-time'),(3,2,'verified')) AS t(sensor_statuses_id, sort_order, label)"""

FRAMES["ingest_ids"] = """
SELECT p_partkey, concat(p_brand, '-', replace(p_name, ' ', '-'), '-', lower(p_type)) AS ingest_id FROM {part}"""

FRAMES["ledger"] = """
SELECT date_trunc('hour', datetime) + INTERVAL '1' HOUR AS datetime,
  CASE sensors_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 19800 ELSE -28800 END AS offset_s,
  min(added_on) AS added_on, max(added_on) AS modified_on, CAST(count(*) AS INT) AS modified_count,
  CASE WHEN count(*) % 4 = 0 THEN NULL ELSE min(added_on) + INTERVAL '30' MINUTE END AS calculated_on,
  CAST(count(*) % 5 AS INT) AS calculated_count,
  CASE WHEN count(*) % 3 = 0 THEN NULL ELSE min(added_on) + INTERVAL '10' MINUTE END AS queued_on,
  count(*) / 8.0 AS calculated_seconds, CAST(count(DISTINCT sensors_id) AS BIGINT) AS sensors_count,
  CAST(count(*) AS BIGINT) AS measurements_count
FROM {measurements} GROUP BY 1, 2"""

FRAMES["lists"] = """
SELECT n_nationkey AS lists_id, n_nationkey * 3 AS users_id, n_name AS label,
  CASE WHEN n_nationkey % 2 = 0 THEN 'private' ELSE 'public' END AS visibility FROM {nation}"""

FRAMES["sensor_nodes_list"] = """
SELECT CAST(c_custkey % 29 AS INT) AS lists_id, c_custkey AS sensor_nodes_id FROM {customer}"""

FRAMES["users_lists"] = """
SELECT DISTINCT c_nationkey AS lists_id, CAST(c_custkey % 40 AS INT) AS users_id, 'viewer' AS role FROM {customer}"""

FRAMES["zone_boxes"] = """
SELECT * FROM (VALUES (1,-180.0,-90.0,-60.0,90.0),(2,-60.0,-90.0,60.0,90.0),(3,60.0,-90.0,180.0,90.0),(4,-30.0,-30.0,90.0,40.0))
AS t(zone_id, xmin, ymin, xmax, ymax)"""

FRAMES["handlers"] = """
SELECT r_regionkey AS handlers_id, concat('queue-', CAST(r_regionkey AS STRING)) AS queue_name, 'csv' AS output_format FROM {region}"""

FRAMES["deployments"] = """
SELECT s_suppkey AS deployments_id, s_name AS label, CAST(s_suppkey % 5 AS INT) AS handlers_id,
  s_suppkey % 8 <> 0 AS is_active, CAST(s_suppkey % 24 AS INT) AS temporal_offset, concat('pre', CAST(s_suppkey AS STRING)) AS filename_prefix,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE TIMESTAMP '2001-12-30 00:00:00' + (s_suppkey % 1440) * INTERVAL '1' MINUTE END AS last_deployed_datetime,
  CASE s_suppkey % 6
    WHEN 0 THEN concat('*/', CAST(s_suppkey % 50 + 10 AS STRING), ' * * * *')
    WHEN 1 THEN concat(CAST(s_suppkey % 60 AS STRING), ' 9 * * 1-5')
    WHEN 2 THEN concat(CAST(s_suppkey % 60 AS STRING), ' 1,', CAST(s_suppkey % 24 AS STRING), ' * * 2-4,6')
    WHEN 3 THEN concat('5 1 ', CAST(s_suppkey % 28 + 1 AS STRING), ' * *')
    WHEN 4 THEN concat('0-30/', CAST(s_suppkey % 20 + 1 AS STRING), ' 0 ', CAST(s_suppkey % 28 + 1 AS STRING), ' * 0')
    ELSE concat('*/61 ', CAST(s_suppkey % 30 AS STRING), ' * * *') END AS schedule
FROM {supplier}"""

FRAMES["deployment_adapters"] = """
SELECT DISTINCT p_partkey % 97 AS deployments_id, CAST(p_size % 25 AS INT) AS adapters_id FROM {part}"""

FRAMES["adapters"] = """
SELECT n_nationkey AS adapters_id, n_nationkey % 10 AS providers_id, concat('client-', CAST(n_regionkey AS STRING)) AS client_name,
  concat('cfg', CAST(n_nationkey AS STRING)) AS config FROM {nation}"""

FRAMES["fetcher_responses"] = """
SELECT p.p_brand AS source_name, l.l_shipdate AS datetime, CASE WHEN l.l_linenumber % 6 = 0 THEN 0 ELSE CAST(l.l_quantity AS INT) END AS records
FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey"""

FRAMES["sources"] = """
SELECT CAST(s_suppkey AS INT) AS sources_id, concat('slug-', CAST(s_suppkey AS STRING)) AS slug, s_name AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'text' ELSE NULL END AS readme FROM {supplier}"""

FRAMES["sensor_nodes_sources"] = """
SELECT c_custkey AS sensor_nodes_id, CAST(c_custkey % 100 AS INT) AS sources_id FROM {customer}
UNION
SELECT c_custkey, c_nationkey FROM {customer}"""

_ENGINE_FIVE = {"spark": "explode(array(0, 1, 2, 3, 4))", "check": "unnest([0, 1, 2, 3, 4])"}


def _inputs(sql: str) -> list[str]:
    names = re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)
    return [n for n in dict.fromkeys(names) if n != "five"]


class Frames:
    """Domain frames of one data folder; attributes are built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in FRAMES and name not in TABLES):
            raise AttributeError(name)
        if name not in self._built:
            if name in FRAMES:
                df = self.sql(FRAMES[name])
            else:
                df = self.table(name)
            self._built[name] = df
        return self._built[name]

    def sql(self, text: str) -> DataFrame:
        """A SQL text over frames and tables given as {name}; zoneless stamps mean UTC."""
        args = {name: getattr(self, name) for name in _inputs(text)}
        df = self.spark.sql(text.replace("{five}", _ENGINE_FIVE["spark"]), **args)
        stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps}) if stamps else df

    @cached_property
    def stations(self) -> DataFrame:
        return station_chain(self.sensors, self.sensor_systems, self.sensor_nodes)

    @cached_property
    def ctx(self) -> DataFrame:
        return station_context(self.sensors, self.sensor_systems, self.sensor_nodes, self.timezones)

    @cached_property
    def hourly(self) -> DataFrame:
        return rollups.hourly_rollup(self.measurements, self.ctx)

    @cached_property
    def hourly_long(self) -> DataFrame:
        return rollups.hourly_rollup(self.measurements_long, self.ctx)

    @cached_property
    def daily(self) -> DataFrame:
        return rollups.daily_rollup(self.hourly, self.ctx)

    @cached_property
    def daily_long(self) -> DataFrame:
        return rollups.daily_rollup(self.hourly_long, self.ctx)

    @cached_property
    def lifetime(self) -> DataFrame:
        return rollups.sensors_rollup(self.measurements)


# ---- the same frames for the check engine -------------------------------------------------

CHECK: dict[str, str] = {
    name: sql.replace("{{", "\x01").replace("}}", "\x02").replace("{five}", _ENGINE_FIVE["check"])
    for name, sql in FRAMES.items()
}

CHECK["ctx"] = """
SELECT s.sensors_id, s.measurands_id, s.sensor_systems_id, sy.sensor_nodes_id, n.timezones_id, t.tzid, s.is_public AS sensor_is_public,
  n.is_public AS node_is_public, n.providers_id, n.countries_id
FROM {sensors} s JOIN {sensor_systems} sy ON sy.sensor_systems_id = s.sensor_systems_id
JOIN {sensor_nodes} n ON n.sensor_nodes_id = sy.sensor_nodes_id JOIN {timezones} t ON t.timezones_id = n.timezones_id"""

CHECK["stations"] = """
SELECT s.sensors_id, s.measurands_id, s.sensor_systems_id, sy.sensor_nodes_id, n.timezones_id, s.is_public AS sensor_is_public,
  n.is_public AS node_is_public, n.providers_id, n.countries_id
FROM {sensors} s JOIN {sensor_systems} sy ON sy.sensor_systems_id = s.sensor_systems_id
JOIN {sensor_nodes} n ON n.sensor_nodes_id = sy.sensor_nodes_id"""

_HOURLY = """
SELECT sensors_id, measurands_id, sensor_nodes_id,
  date_trunc('hour', datetime + (off - 1) * INTERVAL 1 SECOND) - off * INTERVAL 1 SECOND + INTERVAL 1 HOUR AS datetime,
  max(added_on) AS updated_on, min(datetime) AS datetime_first, max(datetime) AS datetime_last, count(*) AS value_count,
  avg(value) AS value_avg, stddev(value) AS value_sd, min(value) AS value_min, max(value) AS value_max,
  quantile_cont(value, 0.02) AS value_p02, quantile_cont(value, 0.25) AS value_p25, quantile_cont(value, 0.5) AS value_p50,
  quantile_cont(value, 0.75) AS value_p75, quantile_cont(value, 0.98) AS value_p98,
  count(*) FILTER (WHERE value IS NULL) AS error_count
FROM (SELECT m.*, c.measurands_id, c.sensor_nodes_id,
  CAST(epoch_us(timezone(c.tzid, timezone('UTC', m.datetime))) - epoch_us(m.datetime) AS BIGINT) // 1000000 AS off
  FROM {SOURCE} m JOIN {ctx} c ON c.sensors_id = m.sensors_id) x
GROUP BY ALL"""
CHECK["hourly"] = _HOURLY.replace("SOURCE", "measurements")
CHECK["hourly_long"] = _HOURLY.replace("SOURCE", "measurements_long")

_LONGER = """
SELECT h.sensors_id, c.sensor_nodes_id, PERIOD AS datetime,
  max(updated_on) AS updated_on, min(datetime_first) AS datetime_first, max(datetime_last) AS datetime_last,
  count(*) AS value_count, avg(value_avg) AS value_avg, stddev(value_avg) AS value_sd, min(value_avg) AS value_min,
  max(value_avg) AS value_max, CAST(sum(value_count) AS BIGINT) AS value_raw_count,
  sum(value_avg * value_count) / sum(value_count) AS value_raw_avg, min(value_min) AS value_raw_min, max(value_max) AS value_raw_max,
  quantile_cont(value_avg, 0.02) AS value_p02, quantile_cont(value_avg, 0.25) AS value_p25, quantile_cont(value_avg, 0.5) AS value_p50,
  quantile_cont(value_avg, 0.75) AS value_p75, quantile_cont(value_avg, 0.98) AS value_p98,
  CAST(sum(error_count) AS BIGINT) AS error_raw_count, count(*) FILTER (WHERE value_avg IS NULL) AS error_count
FROM {SOURCE} h JOIN {ctx} c ON c.sensors_id = h.sensors_id WHERE value_count > 0
GROUP BY h.sensors_id, c.sensor_nodes_id, PERIOD"""
_DAY = "CAST(timezone(c.tzid, timezone('UTC', h.datetime - INTERVAL 1 SECOND)) AS DATE)"
_YEAR = f"CAST(date_trunc('year', {_DAY}) AS DATE)"
CHECK["daily"] = _LONGER.replace("PERIOD", _DAY).replace("SOURCE", "hourly")
CHECK["daily_long"] = _LONGER.replace("PERIOD", _DAY).replace("SOURCE", "hourly_long")
CHECK["annual_long"] = _LONGER.replace("PERIOD", _YEAR).replace("SOURCE", "hourly_long")

CHECK["lifetime"] = """
SELECT sensors_id, min(datetime) AS datetime_first, max(datetime) AS datetime_last, count(*) AS value_count,
  avg(value) AS value_avg, stddev(value) AS value_sd, min(value) AS value_min, max(value) AS value_max,
  arg_max_null(value, datetime) AS value_latest, max(added_on) AS modified_on
FROM {measurements} GROUP BY sensors_id"""


def check_sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Body over {frame} names, preceded by the frames it needs, deepest first."""
    protect = lambda sql: sql.replace("{{", "\x01").replace("}}", "\x02")
    known = {**CHECK, **{name: protect(sql) for name, sql in (extra or {}).items()}}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _inputs(sql):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    body = protect(body)

    def plain(sql: str) -> str:
        text = re.sub(r"\{(\w+)\}", r"\1", sql)
        return text.replace("\x01", "{").replace("\x02", "}").strip()

    visit(body)
    ctes = ",\n".join(f"{name} AS ({plain(known[name])})" for name in order)
    return (f"WITH {ctes}\n" if ctes else "") + plain(body)
