"""Queries: rollups, the period ledger, exceedances and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import numeric, timeops
from airloom.operators import exceedances, flags, ledger, rollups, upsert
from airloom.plans.frames import AS_OF, AS_OF_ORDERS
from airloom.plans.registry import query

_STATS = (
    "updated_on:t datetime_first:t datetime_last:t value_count:i value_avg:f value_sd:f value_min:f value_max:f "
    "value_p02:f value_p25:f value_p50:f value_p75:f value_p98:f"
)
_HOUR = f"sensors_id:i measurands_id:i sensor_nodes_id:i datetime:t {_STATS} error_count:i"
_DAY = (
    f"sensors_id:i sensor_nodes_id:i datetime:d {_STATS} value_raw_count:i value_raw_avg:f value_raw_min:f "
    "value_raw_max:f error_raw_count:i error_count:i"
)


@query("hourly_rollup", _HOUR, "SELECT * FROM {hourly}")
def _(f):
    return f.hourly


# periods derived from the data: every hour end in which user-facing errors were reported
_STALE_HOURS = """
SELECT DISTINCT date_trunc('hour', ts) + INTERVAL '1' HOUR AS datetime,
  CASE user_id % 2 WHEN 0 THEN 0 ELSE 46800 END AS offset_s FROM {events} WHERE event_type = 'error'"""


@query(
    "hourly_rollup_by_offset", _HOUR,
    """SELECT h.* FROM {hourly} h JOIN {ctx} c ON c.sensors_id = h.sensors_id
    JOIN {stale_hours} p ON p.datetime = h.datetime AND p.offset_s =
      CAST(epoch_us(timezone(c.tzid, timezone('UTC', h.datetime))) - epoch_us(h.datetime) AS BIGINT) // 1000000""",
    {"stale_hours": _STALE_HOURS},
)
def _(f):
    return rollups.hourly_rollup(f.measurements, f.ctx, periods=f.sql(_STALE_HOURS))


@query(
    "insert_hourly_data", _HOUR + " calculated_on:t",
    f"""SELECT h.*, TIMESTAMP '{AS_OF}' AS calculated_on FROM {{hourly}} h""",
)
def _(f):
    old = f.hourly.withColumn("value_avg", F.col("value_avg") - 1).where(F.col("value_count") == 1)
    new = f.hourly
    stamp = timeops.instant(AS_OF)
    return upsert.upsert(
        old.withColumn("calculated_on", timeops.instant("2024-01-01")), new.withColumn("calculated_on", stamp),
        ["sensors_id", "datetime"],
    )


@query(
    "hourly_rollup_counts", "sensor_nodes_count:i sensors_count:i measurements_count:i",
    """SELECT count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(DISTINCT sensors_id) AS sensors_count,
    sum(value_count) AS measurements_count FROM {hourly}""",
)
def _(f):
    return rollups.rollup_counts(f.hourly)


@query("daily_rollup", _DAY, "SELECT * FROM {daily}")
def _(f):
    return f.daily


@query("daily_rollup_long_dst", _DAY, "SELECT * FROM {daily_long}")
def _(f):
    return f.daily_long


@query(
    "daily_rollup_lag", _DAY,
    f"""SELECT d.* FROM {{daily}} d JOIN {{ctx}} c ON c.sensors_id = d.sensors_id
    WHERE hour(timezone(c.tzid, timezone('UTC', TIMESTAMP '{AS_OF}'))) = 16""",
)
def _(f):
    return rollups.daily_rollup(f.hourly, f.ctx, lag=16, as_of=AS_OF)


@query(
    "daily_rollup_sensor_range", _DAY,
    """SELECT * FROM {daily} WHERE datetime >= DATE '2024-01-05' AND datetime < DATE '2024-01-20'
    AND sensors_id IN (SELECT user_id * 5 FROM {events} WHERE event_type = 'error')""",
)
def _(f):
    chosen = f.sql("SELECT DISTINCT user_id * 5 AS sensors_id FROM {events} WHERE event_type = 'error'")
    return rollups.daily_rollup(f.hourly, f.ctx, sensors=chosen, start="2024-01-05", end="2024-01-20")


_STALE_DAYS = """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS datetime, CASE l_linenumber % 3 WHEN 0 THEN -25200 WHEN 1 THEN 19800 ELSE 43200 END AS offset_s
FROM {lineitem} WHERE l_returnflag = 'R'"""


@query(
    "daily_rollup_by_offset", _DAY,
    """SELECT d.* FROM {daily_long} d JOIN {ctx} c ON c.sensors_id = d.sensors_id
    WHERE EXISTS (SELECT 1 FROM {stale_days} p WHERE p.datetime = d.datetime AND p.offset_s IN (
      CAST(epoch_us(timezone(c.tzid, timezone('UTC', CAST(d.datetime AS TIMESTAMP)))) - epoch_us(CAST(d.datetime AS TIMESTAMP)) AS BIGINT) // 1000000,
      CAST(epoch_us(timezone(c.tzid, timezone('UTC', CAST(d.datetime + INTERVAL 1 DAY AS TIMESTAMP)))) - epoch_us(CAST(d.datetime + INTERVAL 1 DAY AS TIMESTAMP)) AS BIGINT) // 1000000))""",
    {"stale_days": _STALE_DAYS},
)
def _(f):
    return rollups.daily_rollup(f.hourly_long, f.ctx, periods=f.sql(_STALE_DAYS))


@query(
    "insert_daily_data_by_offset", _DAY + " calculated_on:t",
    f"""SELECT d.*, TIMESTAMP '{AS_OF}' AS calculated_on FROM {{daily}} d""",
)
def _(f):
    old = f.daily.where(F.dayofmonth("datetime") % 2 == 0).withColumn("value_sd", F.lit(-1.0))
    return upsert.upsert(
        old.withColumn("calculated_on", timeops.instant("2024-01-01")),
        f.daily.withColumn("calculated_on", timeops.instant(AS_OF)), ["sensors_id", "datetime"],
    )


@query(
    "daily_rollup_counts",
    "sensor_nodes_count:i sensors_count:i measurements_hourly_count:i measurements_count:i",
    """SELECT count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(DISTINCT sensors_id) AS sensors_count,
    sum(value_count) AS measurements_hourly_count, sum(value_raw_count) AS measurements_count FROM {daily}""",
)
def _(f):
    return rollups.rollup_counts(f.daily)


@query(
    "daily_data_check",
    "sensors_id:i sensor_nodes_id:i datetime:d utc_offset:i datetime_min:t datetime_max:t value_count:i "
    "value_raw_count:i value_avg:f value_raw_avg:f",
    """SELECT h.sensors_id, c.sensor_nodes_id, day AS datetime,
      CAST(epoch_us(timezone(c.tzid, timezone('UTC', CAST(day AS TIMESTAMP)))) - epoch_us(CAST(day AS TIMESTAMP)) AS BIGINT) // 1000000 AS utc_offset,
      min(datetime) AS datetime_min, max(datetime) AS datetime_max, count(*) AS value_count, sum(value_count) AS value_raw_count,
      avg(value_avg) AS value_avg, sum(value_avg * value_count) / sum(value_count) AS value_raw_avg
    FROM (SELECT h0.*, CAST(timezone(c0.tzid, timezone('UTC', h0.datetime - INTERVAL 1 SECOND)) AS DATE) AS day
          FROM {hourly} h0 JOIN {ctx} c0 ON c0.sensors_id = h0.sensors_id) h JOIN {ctx} c ON c.sensors_id = h.sensors_id
    WHERE value_count > 0 AND day >= DATE '2024-01-03' AND day < DATE '2024-01-25'
      AND h.sensors_id IN (SELECT user_id * 5 + 4 FROM {events} WHERE event_type = 'purchase')
    GROUP BY h.sensors_id, c.sensor_nodes_id, c.tzid, day""",
)
def _(f):
    chosen = f.sql("SELECT DISTINCT user_id * 5 + 4 AS sensors_id FROM {events} WHERE event_type = 'purchase'")
    return rollups.daily_check(f.hourly, f.ctx, chosen, "2024-01-03", "2024-01-25")


@query("annual_rollup", _DAY, "SELECT * FROM {annual_long}")
def _(f):
    return rollups.annual_rollup(f.hourly_long, f.ctx)


@query(
    "insert_annual_data_by_offset", _DAY + " calculated_on:t",
    f"""SELECT d.*, TIMESTAMP '{AS_OF_ORDERS}' AS calculated_on FROM {{annual_long}} d""",
)
def _(f):
    new = rollups.annual_rollup(f.hourly_long, f.ctx)
    old = new.where(F.year("datetime") % 2 == 0).withColumn("value_max", F.lit(-1.0))
    return upsert.upsert(
        old.withColumn("calculated_on", timeops.instant("1999-01-01")),
        new.withColumn("calculated_on", timeops.instant(AS_OF_ORDERS)), ["sensors_id", "datetime"],
    )


@query(
    "annual_rollup_counts",
    "sensor_nodes_count:i sensors_count:i measurements_hourly_count:i measurements_count:i",
    """SELECT count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(DISTINCT sensors_id) AS sensors_count,
    sum(value_count) AS measurements_hourly_count, sum(value_raw_count) AS measurements_count FROM {annual_long}""",
)
def _(f):
    return rollups.rollup_counts(rollups.annual_rollup(f.hourly_long, f.ctx))


_STAT_DAYS = "SELECT DISTINCT CAST(ts AS DATE) + 3 AS datetime FROM {events}"


@query(
    "daily_stats",
    "datetime:d sensor_nodes_count:i sensors_count:i measurements_count:i measurements_raw_count:i updated_on:t calculated_count:i",
    """SELECT g.datetime, count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(sensors_id) AS sensors_count,
      coalesce(sum(value_count), 0) AS measurements_count, coalesce(sum(value_raw_count), 0) AS measurements_raw_count,
      max(updated_on) AS updated_on, 1 AS calculated_count
    FROM {stat_days} g LEFT JOIN {daily} d ON d.datetime = g.datetime GROUP BY g.datetime""",
    {"stat_days": _STAT_DAYS},
)
def _(f):
    return rollups.daily_stats(f.daily, f.ctx, f.sql("SELECT DISTINCT date_add(CAST(ts AS DATE), 3) AS datetime FROM {events}"))


@query(
    "calculate_daily_data_full",
    "datetime:d sensor_nodes_count:i sensors_count:i measurements_count:i measurements_raw_count:i updated_on:t",
    """SELECT datetime, count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(sensors_id) AS sensors_count,
      sum(value_count) AS measurements_count, sum(value_raw_count) AS measurements_raw_count, max(updated_on) AS updated_on
    FROM {daily_long} GROUP BY datetime""",
)
def _(f):
    return rollups.daily_stats(f.daily_long, f.ctx, f.daily_long.select("datetime"))


@query(
    "rollup_reconcile",
    "sensors_id:i day:d daily_raw_count:i hourly_raw_count:i raw_count:i daily_count:i daily_avg:f hourly_avg:f raw_avg:f matches:b",
    """SELECT sensors_id, datetime AS day, value_raw_count AS daily_raw_count, value_raw_count AS hourly_raw_count,
      value_raw_count AS raw_count, value_count AS daily_count, value_avg AS daily_avg, value_avg AS hourly_avg,
      value_avg AS raw_avg, true AS matches FROM {daily}""",
)
def _(f):
    return rollups.rollup_reconcile(f.measurements, f.hourly, f.daily, f.ctx)


_LIFE = (
    "sensors_id:i datetime_first:t datetime_last:t value_count:i value_avg:f value_sd:f value_min:f value_max:f value_latest:f"
)


@query("sensors_rollup", _LIFE, "SELECT * FROM {lifetime}")
def _(f):
    return f.lifetime


@query(
    "initialize_sensors_rollup", _LIFE,
    """SELECT * REPLACE (CASE WHEN sensors_id % 3 = 1 THEN -5.0 ELSE value_latest END AS value_latest) FROM {lifetime}""",
)
def _(f):
    kind = F.col("sensors_id") % 3
    held = f.lifetime.where(kind != 0)
    unfinished = F.when(kind == 1, F.lit(None)).otherwise(F.col("value_avg")).cast("double")
    latest = F.when(kind == 1, -5.0).otherwise(F.col("value_latest"))
    return rollups.sensors_rollup(
        f.measurements, existing=held.withColumn("value_avg", unfinished).withColumn("value_latest", latest)
    )


@query(
    "sensor_rollups_summary",
    "measurand:s units:s sensors_count:i value_avg:f value_min:f value_min_p01:f value_min_p05:f value_max_p95:f "
    "value_max_p99:f value_max:f last_added:t last_modified:t",
    """SELECT measurand, units, count(*) AS sensors_count, round(avg(value_avg), 2) AS value_avg, round(min(value_min), 2) AS value_min,
      round(quantile_cont(value_min, 0.01), 2) AS value_min_p01, round(quantile_cont(value_min, 0.05), 2) AS value_min_p05,
      round(quantile_cont(value_max, 0.95), 2) AS value_max_p95, round(quantile_cont(value_max, 0.99), 2) AS value_max_p99,
      round(max(value_max), 2) AS value_max, max(s.added_on) AS last_added, max(r.modified_on) AS last_modified
    FROM {lifetime} r JOIN {sensors} s ON s.sensors_id = r.sensors_id JOIN {measurands} m ON m.measurands_id = s.measurands_id
    GROUP BY measurand, units""",
)
def _(f):
    return rollups.sensor_rollups_summary(f.lifetime, f.sensors, f.measurands)


@query(
    "analyses_summary",
    "sensors_id:i datetime_first:t datetime_last:t last_value:f value_count:i value_sum:f minx:f miny:f maxx:f maxy:f last_x:f last_y:f",
    """SELECT sensors_id, min(datetime) AS datetime_first, max(datetime) AS datetime_last, arg_max_null(value, datetime) AS last_value,
      count(*) AS value_count, sum(value) AS value_sum, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy,
      arg_max(lon, datetime) AS last_x, arg_max(lat, datetime) AS last_y FROM {measurements} GROUP BY sensors_id""",
)
def _(f):
    return rollups.analyses_summary(f.measurements).select(
        "*", F.col("last_point.lon").alias("last_x"), F.col("last_point.lat").alias("last_y")
    )


@query(
    "providers_stats",
    "providers_id:i day:d sensor_nodes_count:i sensors_count:i measurements_count:i offset_min:f offset_avg:f offset_max:f "
    "datetime_min:t datetime_max:t added_on_min:t added_on_max:t",
    """SELECT providers_id, CAST(added_on AS DATE) AS day, count(DISTINCT sensor_nodes_id) AS sensor_nodes_count,
      count(DISTINCT m.sensors_id) AS sensors_count, count(*) AS measurements_count,
      min(epoch_us(added_on) - epoch_us(datetime)) / 1e6 AS offset_min, avg(epoch_us(added_on) - epoch_us(datetime)) / 1e6 AS offset_avg,
      max(epoch_us(added_on) - epoch_us(datetime)) / 1e6 AS offset_max, min(datetime) AS datetime_min, max(datetime) AS datetime_max,
      min(added_on) AS added_on_min, max(added_on) AS added_on_max
    FROM {measurements} m JOIN {stations} c ON c.sensors_id = m.sensors_id WHERE added_on <> date_trunc('day', added_on)
    GROUP BY providers_id, CAST(added_on AS DATE)""",
)
def _(f):
    return rollups.providers_stats(f.measurements, f.stations)


@query(
    "daily_exported_stats",
    "day:d sensor_nodes_count:i sensors_count:i hours_count:i measurements_count:i",
    """SELECT CAST(datetime - INTERVAL 1 SECOND AS DATE) AS day, count(DISTINCT sensor_nodes_id) AS sensor_nodes_count,
      count(DISTINCT sensors_id) AS sensors_count, count(*) AS hours_count, sum(value_count) AS measurements_count
    FROM {hourly} GROUP BY 1""",
)
def _(f):
    return rollups.daily_exported_stats(f.hourly, f.ctx)


@query(
    "daily_exported_stats_initial",
    "day:d sensor_nodes_count:i sensors_count:i hours_count:i measurements_count:i",
    """SELECT DISTINCT CAST(datetime - INTERVAL 1 SECOND AS DATE) AS day, -1 AS sensor_nodes_count, -1 AS sensors_count,
      -1 AS hours_count, -1 AS measurements_count FROM {measurements_long}
    WHERE CAST(datetime - INTERVAL 1 SECOND AS DATE) >= (SELECT CAST(min(datetime) AS DATE) FROM {measurements_long})""",
)
def _(f):
    return rollups.initial_exported_days(f.measurements_long)


@query(
    "sensor_hourly_coverage", "sensors_id:i datetime:t value_count:i expected:i coverage:f",
    """SELECT h.sensors_id, datetime, value_count, CAST(json_extract_string(metadata, '$.hourly_frequency') AS INT) AS expected,
      CASE WHEN value_count >= CAST(json_extract_string(metadata, '$.hourly_frequency') AS INT) THEN 100.0
        ELSE round(value_count / CAST(json_extract_string(metadata, '$.hourly_frequency') AS INT) * 100) END AS coverage
    FROM {hourly} h JOIN {sensors} s ON s.sensors_id = h.sensors_id""",
)
def _(f):
    return rollups.sensor_hourly_coverage(f.hourly, f.sensors)


@query(
    "calculate_coverage",
    "sensors_id:i observed_count:i observed_interval:i expected_count:f expected_interval:n percent_complete:f percent_coverage:f",
    """SELECT l.sensors_id, value_count AS observed_count, value_count * data_averaging_period_seconds AS observed_interval,
      round(dur / data_logging_period_seconds) AS expected_count,
      dur / data_logging_period_seconds * data_averaging_period_seconds AS expected_interval,
      round(value_count / nullif(dur / data_logging_period_seconds, 0) * 100) AS percent_complete,
      round(value_count / nullif(dur / data_averaging_period_seconds, 0) * 100) AS percent_coverage
    FROM (SELECT *, (epoch_us(datetime_last) - epoch_us(datetime_first)) / 1e6 AS dur FROM {lifetime}) l
    JOIN {sensors} s ON s.sensors_id = l.sensors_id""",
)
def _(f):
    rows = f.lifetime.join(f.sensors, "sensors_id")
    told = numeric.coverage(
        F.col("value_count"), F.col("data_averaging_period_seconds"), F.col("data_logging_period_seconds"),
        timeops.seconds_between("datetime_last", "datetime_first"),
    )
    return rows.select("sensors_id", told.alias("c")).select("sensors_id", "c.*")


_REQUESTS = """
SELECT o_orderkey, o_orderdate AS sd, o_orderdate + (o_custkey % 90 + 1) * INTERVAL '1' DAY AS ed,
  CASE o_orderkey % 3 WHEN 0 THEN 'hour' WHEN 1 THEN 'day' ELSE 'month' END AS tp,
  CASE o_orderkey % 3 WHEN 0 THEN lpad(CAST(o_custkey % 24 AS STRING), 2, '0') WHEN 1 THEN CAST(o_custkey % 7 + 1 AS STRING)
    ELSE lpad(CAST(o_custkey % 12 + 1 AS STRING), 2, '0') END AS gp
FROM {orders}"""


@query(
    "expected_hours", "o_orderkey:i hours:i",
    """SELECT o_orderkey, count(*) FILTER (WHERE CASE tp WHEN 'hour' THEN strftime(d, '%H') = gp WHEN 'day' THEN CAST(isodow(d) AS VARCHAR) = gp
        ELSE strftime(d, '%m') = gp END) AS hours
    FROM (SELECT *, unnest(generate_series(date_trunc(CASE WHEN tp = 'month' THEN 'month' ELSE 'day' END, sd),
        date_trunc(CASE WHEN tp = 'month' THEN 'month' ELSE 'day' END, ed - INTERVAL 1 SECOND)
        + CASE WHEN tp = 'month' THEN INTERVAL 1 MONTH ELSE INTERVAL 1 DAY END - INTERVAL 1 SECOND, INTERVAL 1 HOUR)) AS d
      FROM {requests}) x GROUP BY o_orderkey""",
    {"requests": _REQUESTS},
)
def _(f):
    hours = numeric.expected_hours(F.col("sd"), F.col("ed"), F.col("tp"), F.col("gp"))
    return f.sql(_REQUESTS).select("o_orderkey", hours.alias("hours"))


@query(
    "daily_summary_of_averages", "datetime:d value_avg:f value_min:f value_max:f value_count:i sensors_count:i",
    """SELECT datetime, avg(value_avg) AS value_avg, min(value_avg) AS value_min, max(value_avg) AS value_max,
      sum(value_count) AS value_count, count(*) AS sensors_count FROM {daily} GROUP BY datetime""",
)
def _(f):
    return rollups.daily_summary_of_averages(f.daily)


@query(
    "latest_added_per_day", "day:d added_on:t",
    "SELECT CAST(datetime AS DATE) AS day, max(added_on) AS added_on FROM {measurements} GROUP BY 1",
)
def _(f):
    return rollups.latest_added_per_day(f.measurements)


# ---- ledger -----------------------------------------------------------------------------------

_OFF = "CAST(epoch_us(timezone({z}, timezone('UTC', {t}))) - epoch_us({t}) AS BIGINT) // 1000000"


def _off(zone: str, at: str) -> str:
    return _OFF.replace("{z}", zone).replace("{t}", at)


@query(
    "enumerate_periods_daily", "datetime:d offset_s:i",
    f"""SELECT DISTINCT CAST(d AS DATE) AS datetime, {_off('tzid', 'd')} AS offset_s
    FROM (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 DAY)) AS d FROM {{measurements_long}}) days,
      (SELECT DISTINCT tzid FROM {{ctx}}) zones""",
)
def _(f):
    return ledger.enumerate_periods(f.measurements_long, f.ctx, "day")


_SPAN = f"""SELECT offset_s, unnest(generate_series(
        date_trunc('hour', min(datetime) + (offset_s - 1) * INTERVAL 1 SECOND) - offset_s * INTERVAL 1 SECOND + INTERVAL 1 HOUR,
        date_trunc('hour', max(datetime) + (offset_s - 1) * INTERVAL 1 SECOND) - offset_s * INTERVAL 1 SECOND + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datetime
    FROM (SELECT m.datetime, {_off('c.tzid', 'm.datetime')} AS offset_s FROM {{measurements}} m JOIN {{ctx}} c ON c.sensors_id = m.sensors_id) x
    GROUP BY offset_s"""


@query("enumerate_periods_hourly", "datetime:t offset_s:i", _SPAN)
def _(f):
    return ledger.enumerate_periods(f.measurements, f.ctx, "hour")


@query(
    "reset_hourly_queue", "datetime:t offset_s:i modified_on:t added_on:t",
    f"""SELECT coalesce(p.datetime, l.datetime) AS datetime, coalesce(p.offset_s, l.offset_s) AS offset_s,
      CASE WHEN p.datetime IS NULL THEN l.modified_on ELSE greatest(TIMESTAMP '{AS_OF}', l.modified_on) END AS modified_on,
      coalesce(l.added_on, TIMESTAMP '{AS_OF}') AS added_on
    FROM {{ledger}} l FULL JOIN {{span}} p ON p.datetime = l.datetime AND p.offset_s = l.offset_s""",
    {"span": _SPAN},
)
def _(f):
    periods = ledger.enumerate_periods(f.measurements, f.ctx, "hour")
    return ledger.add_periods(f.ledger, periods, AS_OF, refresh=True)


@query(
    "enumerate_hours_with_data", "datetime:t",
    "SELECT DISTINCT datetime FROM {measurements_long} WHERE datetime = date_trunc('hour', datetime)",
)
def _(f):
    return ledger.hours_with_data(f.measurements_long)


_TOUCH_EVENTS = """
SELECT DISTINCT ts AS datetime, CASE user_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 19800 ELSE -28800 END AS offset_s
FROM {events}"""


@query(
    "mark_modified_hour", "datetime:t offset_s:i modified_on:t modified_count:i",
    f"""SELECT coalesce(t.datetime, l.datetime) AS datetime, coalesce(t.offset_s, l.offset_s) AS offset_s,
      CASE WHEN l.datetime IS NULL THEN NULL WHEN t.datetime IS NULL THEN l.modified_on ELSE TIMESTAMP '{AS_OF}' END AS modified_on,
      CASE WHEN l.datetime IS NULL THEN 0 WHEN t.datetime IS NULL THEN l.modified_count ELSE l.modified_count + 1 END AS modified_count
    FROM {{ledger}} l FULL JOIN (SELECT DISTINCT date_trunc('hour', datetime + (offset_s - 1) * INTERVAL 1 SECOND) - offset_s * INTERVAL 1 SECOND
        + INTERVAL 1 HOUR AS datetime, offset_s FROM {{touch}}) t ON t.datetime = l.datetime AND t.offset_s = l.offset_s""",
    {"touch": _TOUCH_EVENTS},
)
def _(f):
    return ledger.mark_modified(f.ledger, f.sql(_TOUCH_EVENTS), "hour", AS_OF)


_DAY_LEDGER = """
SELECT CAST(l_shipdate AS DATE) AS datetime, CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 19800 ELSE 20700 END AS offset_s,
  min(l_shipdate) AS added_on, max(l_shipdate) + (min(l_quantity) % 7) * INTERVAL '1' DAY AS modified_on, CAST(count(*) AS INT) AS modified_count,
  CASE WHEN count(*) % 4 = 0 THEN NULL ELSE min(l_shipdate) + INTERVAL '3' DAY END AS calculated_on,
  CAST(count(*) % 3 AS INT) AS calculated_count,
  CASE WHEN count(*) % 3 = 0 THEN NULL ELSE min(l_shipdate) + INTERVAL '2' DAY END AS queued_on,
  count(*) / 8.0 AS calculated_seconds, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS sensors_count, CAST(sum(l_quantity) AS BIGINT) AS measurements_count
FROM {lineitem} GROUP BY 1, 2"""
_DAY_LEDGER = _DAY_LEDGER.replace("(min(l_quantity) % 7)", "CAST(min(l_quantity) % 7 AS INT)")
_YEAR_LEDGER = _DAY_LEDGER.replace("CAST(l_shipdate AS DATE) AS datetime", "CAST(date_trunc('year', l_shipdate) AS DATE) AS datetime")


@query(
    "mark_modified_day", "datetime:d offset_s:i modified_on:t modified_count:i",
    f"""SELECT coalesce(t.datetime, l.datetime) AS datetime, coalesce(t.offset_s, l.offset_s) AS offset_s,
      CASE WHEN l.datetime IS NULL THEN NULL WHEN t.datetime IS NULL THEN l.modified_on ELSE TIMESTAMP '{AS_OF_ORDERS}' END AS modified_on,
      CASE WHEN l.datetime IS NULL THEN 0 WHEN t.datetime IS NULL THEN l.modified_count ELSE l.modified_count + 1 END AS modified_count
    FROM {{day_ledger}} l FULL JOIN (SELECT DISTINCT CAST(o.o_orderdate + ({_off('z.tzid', 'o.o_orderdate')} - 1) * INTERVAL 1 SECOND AS DATE) AS datetime,
        {_off('z.tzid', 'o.o_orderdate')} AS offset_s FROM {{orders}} o, (SELECT DISTINCT tzid FROM {{ctx}}) z) t
      ON t.datetime = l.datetime AND t.offset_s = l.offset_s""",
    {"day_ledger": _DAY_LEDGER},
)
def _(f):
    touched = f.sql("SELECT DISTINCT o_orderdate AS datetime FROM {orders}")
    return ledger.mark_modified(f.sql(_DAY_LEDGER), touched, "day", AS_OF_ORDERS, zones=ledger.zones_in_use(f.ctx))


@query(
    "mark_modified_year", "datetime:d offset_s:i modified_on:t modified_count:i",
    f"""SELECT coalesce(t.datetime, l.datetime) AS datetime, coalesce(t.offset_s, l.offset_s) AS offset_s,
      CASE WHEN l.datetime IS NULL THEN NULL WHEN t.datetime IS NULL THEN l.modified_on ELSE TIMESTAMP '{AS_OF_ORDERS}' END AS modified_on,
      CASE WHEN l.datetime IS NULL THEN 0 WHEN t.datetime IS NULL THEN l.modified_count ELSE l.modified_count + 1 END AS modified_count
    FROM {{year_ledger}} l FULL JOIN (SELECT DISTINCT CAST(date_trunc('year', o_orderdate) AS DATE) AS datetime, 19800 AS offset_s FROM {{orders}}) t
      ON t.datetime = l.datetime AND t.offset_s = l.offset_s""",
    {"year_ledger": _YEAR_LEDGER},
)
def _(f):
    touched = f.sql("SELECT DISTINCT CAST(o_orderdate AS DATE) AS datetime, 19800 AS offset_s FROM {orders}")
    return ledger.mark_modified(f.sql(_YEAR_LEDGER), touched, "year", AS_OF_ORDERS)


def _stale_sql(table: str, level: str, now: str, upper: str) -> str:
    extra = " OR calculated_on < modified_on" if level == "hour" else ""
    return f"""SELECT datetime, offset_s, queued_on FROM {{{table}}} WHERE datetime <= {upper}
      AND (calculated_on IS NULL OR modified_on > calculated_on)
      AND (queued_on IS NULL OR (queued_on < TIMESTAMP '{now}' - INTERVAL 1 HOUR
        AND (queued_on < modified_on OR calculated_on IS NULL{extra})))
      ORDER BY datetime, offset_s LIMIT 200"""


@query("stale_periods_hour", "datetime:t offset_s:i queued_on:t",
       _stale_sql("ledger", "hour", "2024-01-20 10:30:00", "TIMESTAMP '2024-01-20 10:00:00'"))
def _(f):
    return ledger.stale_periods(f.ledger, "hour", 200, as_of="2024-01-20 10:30:00")


@query("stale_periods_day", "datetime:d offset_s:i queued_on:t",
       _stale_sql("day_ledger", "day", "1998-06-01 10:30:00", "DATE '1998-05-31'"), {"day_ledger": _DAY_LEDGER})
def _(f):
    return ledger.stale_periods(f.sql(_DAY_LEDGER), "day", 200, as_of="1998-06-01 10:30:00")


@query("stale_periods_year", "datetime:d offset_s:i queued_on:t",
       _stale_sql("year_ledger", "year", "2000-06-01 10:30:00", "DATE '1999-06-01'"), {"year_ledger": _YEAR_LEDGER})
def _(f):
    return ledger.stale_periods(f.sql(_YEAR_LEDGER), "year", 200, as_of="2000-06-01 10:30:00")


@query(
    "uncalculated_periods", "datetime:t offset_s:i",
    """SELECT datetime, offset_s FROM {ledger} WHERE datetime <= TIMESTAMP '2024-01-20 09:30:00' AND calculated_on IS NULL
    ORDER BY datetime, offset_s LIMIT 50""",
)
def _(f):
    return ledger.uncalculated_periods(f.ledger, 50, as_of="2024-01-20 10:30:00")


_HOUR_LEDGER = f"""SELECT datetime, offset_s, TIMESTAMP '2024-01-01 00:00:00' AS added_on,
   CAST(NULL AS TIMESTAMP) AS queued_on, TIMESTAMP '2024-01-10 00:00:00' AS modified_on, 0 AS modified_count,
   CASE WHEN hour(datetime) % 2 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE NULL END AS calculated_on, 0 AS calculated_count
   FROM {{span}}"""


def _hour_ledger(f):
    done = F.when(F.hour("datetime") % 2 == 0, timeops.instant("2024-01-20")).cast("timestamp")
    empty = f.spark.createDataFrame([], ledger.ledger_schema("hour"))
    fresh = ledger.add_periods(empty, ledger.enumerate_periods(f.measurements, f.ctx, "hour"), "2024-01-01", refresh=False)
    return fresh.withColumn("modified_on", timeops.instant("2024-01-10")).withColumn("calculated_on", done)


# rows a target holds before: some are replaced, the others stay
_OLD = """SELECT DISTINCT sensors_id, {at} AS datetime, CAST(-1 AS BIGINT) AS value_count FROM {{{table}}} WHERE sensors_id % 2 = 0"""
_OLD_HOUR = _OLD.format(at="date_trunc('hour', datetime)", table="measurements")
_OLD_DAY = _OLD.format(at="CAST(datetime AS DATE)", table="measurements_long")
_OLD_YEAR = _OLD.format(at="CAST(date_trunc('year', datetime) AS DATE)", table="measurements_long")
_ONTO = """SELECT * FROM {fresh} UNION ALL BY NAME SELECT * FROM {old} o
    WHERE NOT EXISTS (SELECT 1 FROM {fresh} n WHERE n.sensors_id = o.sensors_id AND n.datetime = o.datetime)"""


def _target(f, like, old: str, **columns):
    empty = like.where(F.lit(False)).withColumns(columns)
    return empty.unionByName(f.sql(old), allowMissingColumns=True)


_STALE_HOURS_NEW = f"""SELECT h.* FROM {{hourly}} h JOIN {{ctx}} c ON c.sensors_id = h.sensors_id
    JOIN {{hour_ledger}} l ON l.datetime = h.datetime AND l.offset_s = {_off('c.tzid', 'h.datetime')}
    WHERE l.calculated_on IS NULL AND l.datetime <= TIMESTAMP '{AS_OF}'"""


@query(
    "recompute_hour", _HOUR, _ONTO,
    {"span": _SPAN, "hour_ledger": _HOUR_LEDGER, "fresh": _STALE_HOURS_NEW, "old": _OLD_HOUR},
)
def _(f):
    target = _target(f, f.hourly, _OLD_HOUR, calculated_on=timeops.instant(AS_OF))
    rows, _, _ = ledger.recompute(f.measurements, f.ctx, target, _hour_ledger(f), "hour", None, AS_OF)
    return rows


@query(
    "recompute_hour_ledger", "datetime:t offset_s:i calculated_on:t calculated_count:i queued_on:t sensor_nodes_count:i sensors_count:i measurements_count:i",
    f"""SELECT l.datetime, l.offset_s, coalesce(l.calculated_on, TIMESTAMP '{AS_OF}') AS calculated_on,
      CASE WHEN l.calculated_on IS NULL THEN 2 ELSE 0 END AS calculated_count,
      CASE WHEN l.calculated_on IS NULL THEN TIMESTAMP '{AS_OF}' END AS queued_on,
      CASE WHEN l.calculated_on IS NULL THEN count(DISTINCT h.sensor_nodes_id) END AS sensor_nodes_count,
      CASE WHEN l.calculated_on IS NULL THEN count(DISTINCT h.sensors_id) END AS sensors_count,
      CASE WHEN l.calculated_on IS NULL THEN sum(h.value_count) END AS measurements_count
    FROM {{hour_ledger}} l LEFT JOIN (SELECT h0.*, {_off('c.tzid', 'h0.datetime')} AS offset_s FROM {{hourly}} h0 JOIN {{ctx}} c ON c.sensors_id = h0.sensors_id) h
      ON h.datetime = l.datetime AND h.offset_s = l.offset_s
    WHERE l.datetime <= TIMESTAMP '{AS_OF}' GROUP BY l.datetime, l.offset_s, l.calculated_on""",
    {"span": _SPAN, "hour_ledger": _HOUR_LEDGER},
)
def _(f):
    target = f.hourly.where(F.lit(False)).withColumn("calculated_on", timeops.instant(AS_OF))
    _, kept, _ = ledger.recompute(f.measurements, f.ctx, target, _hour_ledger(f), "hour", None, AS_OF)
    return kept.where(F.col("datetime") <= timeops.instant(AS_OF))


@query(
    "cascade_hour_to_day", "datetime:d offset_s:i",
    f"""SELECT DISTINCT CAST(datetime + (offset_s - 1) * INTERVAL 1 SECOND AS DATE) AS datetime, offset_s FROM {{hour_ledger}}
    WHERE calculated_on IS NULL AND datetime <= TIMESTAMP '{AS_OF}'""",
    {"span": _SPAN, "hour_ledger": _HOUR_LEDGER},
)
def _(f):
    return ledger.cascade(ledger.stale_periods(_hour_ledger(f), "hour", None, as_of=AS_OF), "hour")


_DAY_WORK = f"""SELECT DISTINCT CAST(d AS DATE) AS datetime, {_off('tzid', 'd')} AS offset_s,
    CASE WHEN day(d) % 3 = 0 THEN TIMESTAMP '2001-01-01 00:00:00' END AS calculated_on
    FROM (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 DAY)) AS d FROM {{measurements_long}}) days,
      (SELECT DISTINCT tzid FROM {{ctx}}) zones"""


def _day_ledger(f):
    empty = f.spark.createDataFrame([], ledger.ledger_schema("day"))
    fresh = ledger.add_periods(empty, ledger.enumerate_periods(f.measurements_long, f.ctx, "day"), "2000-01-01")
    return fresh.withColumn(
        "calculated_on", F.when(F.dayofmonth("datetime") % 3 == 0, timeops.instant("2001-01-01")).cast("timestamp")
    )


_STALE_DAYS_NEW = f"""SELECT d.* FROM {{daily_long}} d JOIN {{ctx}} c ON c.sensors_id = d.sensors_id WHERE EXISTS (SELECT 1 FROM {{day_work}} w
      WHERE w.calculated_on IS NULL AND w.datetime <= DATE '2001-12-30' AND w.datetime = d.datetime AND w.offset_s IN (
        {_off('c.tzid', 'CAST(d.datetime AS TIMESTAMP)')}, {_off('c.tzid', 'CAST(d.datetime + INTERVAL 1 DAY AS TIMESTAMP)')}))"""


@query("recompute_day", _DAY, _ONTO, {"day_work": _DAY_WORK, "fresh": _STALE_DAYS_NEW, "old": _OLD_DAY})
def _(f):
    target = _target(f, f.daily_long, _OLD_DAY, calculated_on=timeops.instant(AS_OF), calculated_count=F.lit(1))
    rows, _, _ = ledger.recompute(f.hourly_long, f.ctx, target, _day_ledger(f), "day", None, AS_OF_ORDERS)
    return rows


@query(
    "recompute_day_ledger", "datetime:d offset_s:i calculated_on:t calculated_count:i queued_on:t sensor_nodes_count:i sensors_count:i measurements_count:i",
    f"""SELECT w.datetime, w.offset_s, coalesce(w.calculated_on, TIMESTAMP '{AS_OF_ORDERS}') AS calculated_on,
      CASE WHEN w.calculated_on IS NULL THEN 2 ELSE 0 END AS calculated_count, CASE WHEN w.calculated_on IS NULL THEN TIMESTAMP '{AS_OF_ORDERS}' END AS queued_on,
      CASE WHEN w.calculated_on IS NULL THEN count(DISTINCT d.sensor_nodes_id) END AS sensor_nodes_count,
      CASE WHEN w.calculated_on IS NULL THEN count(DISTINCT d.sensors_id) END AS sensors_count,
      CASE WHEN w.calculated_on IS NULL THEN sum(d.value_count) END AS measurements_count
    FROM {{day_work}} w LEFT JOIN (SELECT d0.*, {_off('c.tzid', 'CAST(d0.datetime AS TIMESTAMP)')} AS o1,
        {_off('c.tzid', 'CAST(d0.datetime + INTERVAL 1 DAY AS TIMESTAMP)')} AS o2 FROM {{daily_long}} d0 JOIN {{ctx}} c ON c.sensors_id = d0.sensors_id) d
      ON d.datetime = w.datetime AND w.offset_s IN (d.o1, d.o2)
    WHERE w.datetime <= DATE '2001-12-30' GROUP BY w.datetime, w.offset_s, w.calculated_on""",
    {"day_work": _DAY_WORK},
)
def _(f):
    target = f.daily_long.where(F.lit(False)).withColumns({"calculated_on": timeops.instant(AS_OF), "calculated_count": F.lit(1)})
    _, kept, _ = ledger.recompute(f.hourly_long, f.ctx, target, _day_ledger(f), "day", None, AS_OF_ORDERS)
    return kept.where(F.col("datetime") <= F.lit("2001-12-30").cast("date"))


@query(
    "cascade_day_to_year", "datetime:d offset_s:i",
    "SELECT DISTINCT CAST(date_trunc('year', datetime) AS DATE) AS datetime, offset_s FROM {day_work} WHERE calculated_on IS NULL",
    {"day_work": _DAY_WORK},
)
def _(f):
    return ledger.cascade(ledger.stale_periods(_day_ledger(f), "day", None, as_of=AS_OF_ORDERS), "day")


@query(
    "recompute_year", _DAY, _ONTO,
    {"fresh": "SELECT d.* FROM {annual_long} d WHERE d.datetime <= DATE '2000-12-31'", "old": _OLD_YEAR},
)
def _(f):
    empty = f.spark.createDataFrame([], ledger.ledger_schema("year"))
    days = ledger.enumerate_periods(f.measurements_long, f.ctx, "day")
    # a year of local days may start a day before the first UTC day: mark it too
    touched = days.unionByName(days.withColumn("datetime", F.date_sub("datetime", 1)))
    work = ledger.add_periods(empty, ledger.touched_periods(touched, "year"), "2000-01-01")
    target = _target(f, f.daily_long, _OLD_YEAR, calculated_on=timeops.instant(AS_OF), calculated_count=F.lit(1))
    rows, _, _ = ledger.recompute(f.hourly_long, f.ctx, target, work, "year", None, AS_OF_ORDERS)
    return rows


_SUMMARY = (
    "total:i pending:i done:i in_progress:i oldest_pending:{k} newest_pending:{k} avg_seconds:f max_seconds:f "
    "total_measurements:i total_sensors:i last_calculated:t"
)
_PENDING = "(calculated_on IS NULL OR modified_on > calculated_on)"
_DONE = "(calculated_on IS NOT NULL AND (modified_on IS NULL OR calculated_on >= modified_on))"


def _summary_sql(table: str) -> str:
    return f"""SELECT count(*) AS total, count(*) FILTER (WHERE {_PENDING}) AS pending, count(*) FILTER (WHERE {_DONE}) AS done,
      count(*) FILTER (WHERE queued_on IS NOT NULL AND calculated_on IS NULL) AS in_progress,
      min(datetime) FILTER (WHERE {_PENDING}) AS oldest_pending, max(datetime) FILTER (WHERE {_PENDING}) AS newest_pending,
      round(avg(calculated_seconds), 2) AS avg_seconds, round(max(calculated_seconds), 2) AS max_seconds,
      sum(measurements_count) AS total_measurements, sum(sensors_count) AS total_sensors, max(calculated_on) AS last_calculated
    FROM {{{table}}}"""


def _monthly_sql(table: str) -> str:
    return f"""SELECT date_trunc('month', CAST(datetime AS TIMESTAMP)) AS month, count(*) AS total, count(*) FILTER (WHERE {_PENDING}) AS pending,
      count(*) FILTER (WHERE {_DONE}) AS done, round(avg(calculated_seconds), 2) AS avg_seconds,
      sum(measurements_count) AS total_measurements, min(calculated_on) AS first_calculated, max(calculated_on) AS last_calculated,
      max(added_on) AS last_added_on FROM {{{table}}} GROUP BY 1"""


def _recent_sql(table: str, now: str) -> str:
    return f"""SELECT count(*) AS total, count(*) FILTER (WHERE queued_on IS NOT NULL AND calculated_on IS NULL) AS in_progress,
      round(avg(calculated_seconds), 2) AS avg_seconds, round(max(calculated_seconds), 2) AS max_seconds,
      sum(measurements_count) AS total_measurements, sum(sensors_count) AS total_sensors, max(datetime) AS last_datetime
    FROM {{{table}}} WHERE calculated_on > TIMESTAMP '{now}' - INTERVAL 1 HOUR"""


_MONTHLY = (
    "month:t total:i pending:i done:i avg_seconds:f total_measurements:i first_calculated:t last_calculated:t last_added_on:t"
)
_RECENT = "total:i in_progress:i avg_seconds:f max_seconds:f total_measurements:i total_sensors:i last_datetime:{k}"

for _level, _table, _sql, _kind, _now in (
    ("hourly", "ledger", None, "t", "2024-01-15 00:00:00"),
    ("daily", "day_ledger", _DAY_LEDGER, "d", "1998-06-01 00:30:00"),
    ("annual", "year_ledger", _YEAR_LEDGER, "d", "1998-01-05 00:30:00"),
):
    _extra = {_table: _sql} if _sql else None

    def _get(f, table=_table, sql=_sql):
        return f.sql(sql) if sql else getattr(f, table)

    query(f"ledger_summary_{_level}", _SUMMARY.format(k=_kind), _summary_sql(_table), _extra)(
        lambda f, get=_get: ledger.ledger_summary(get(f))
    )
    query(f"ledger_summary_monthly_{_level}", _MONTHLY, _monthly_sql(_table), _extra)(
        lambda f, get=_get: ledger.ledger_summary_monthly(get(f))
    )
    query(f"ledger_summary_recent_{_level}", _RECENT.format(k=_kind), _recent_sql(_table, _now), _extra)(
        lambda f, get=_get, now=_now: ledger.ledger_summary_recent(get(f), now)
    )

_STATS_DAYS = """SELECT DISTINCT CAST(l_shipdate AS DATE) AS datetime, max(l_shipdate) + INTERVAL '3' DAY AS modified_on,
  max(l_shipdate) + CAST(max(l_quantity) % 7 AS INT) * INTERVAL '1' DAY AS calculated_on FROM {lineitem} WHERE l_discount > 0.09 GROUP BY 1"""


_MISSING = """SELECT CAST(d AS DATE) AS datetime FROM (SELECT unnest(generate_series(CAST(CAST(min(datetime) AS DATE) AS TIMESTAMP),
      CAST(CAST(max(datetime) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM {hourly_long}) x
    WHERE CAST(d AS DATE) NOT IN (SELECT datetime FROM {stats_days})"""


@query("missing_daily_summaries", "datetime:d", _MISSING, {"stats_days": _STATS_DAYS})
def _(f):
    return ledger.missing_days(f.hourly_long, f.sql(_STATS_DAYS))


@query("next_missing_day", "datetime:d", _MISSING + " ORDER BY 1 LIMIT 1", {"stats_days": _STATS_DAYS})
def _(f):
    return ledger.missing_days(f.hourly_long, f.sql(_STATS_DAYS), first_only=True)


@query(
    "modified_days", "datetime:d",
    """SELECT datetime FROM {stats_days} WHERE datetime < DATE '2001-12-31' AND modified_on IS NOT NULL AND modified_on > calculated_on
    ORDER BY datetime LIMIT 40""", {"stats_days": _STATS_DAYS},
)
def _(f):
    return ledger.modified_days(f.sql(_STATS_DAYS), AS_OF_ORDERS, 40)


def _islands_sql(source: str, key: str) -> str:
    part = f"PARTITION BY {key} " if key else ""
    k = f"{key}, " if key else ""
    return f"""SELECT {k}min(d) AS day_first, max(d) AS day_last FROM (SELECT {k}d, sum(s) OVER ({part}ORDER BY d) AS g FROM (
      SELECT {k}d, CASE WHEN d - lag(d) OVER ({part}ORDER BY d) <= 1 THEN 0 ELSE 1 END AS s FROM (
        SELECT DISTINCT {k}CAST(datetime AS DATE) AS d FROM {{{source}}}) a) b) c GROUP BY {k}g"""


@query("islands", "day_first:d day_last:d", _islands_sql("stats_days", ""), {"stats_days": _STATS_DAYS})
def _(f):
    return ledger.islands(f.sql(_STATS_DAYS))


@query("islands_per_sensor", "sensors_id:i day_first:d day_last:d", _islands_sql("daily_long", "sensors_id"))
def _(f):
    return ledger.islands(f.daily_long.where(F.col("value_count") > 0), key="sensors_id")


# ---- exceedances and flags ----------------------------------------------------------------------

_EXCEED = """SELECT h.sensor_nodes_id, h.measurands_id, CAST(datetime - INTERVAL 1 SECOND AS DATE) AS day, t.value AS threshold_value,
      sum(CAST(h.value_avg >= t.value AS INT)) AS exceedance_count, sum(value_count) AS total_count, count(*) AS hourly_count
    FROM {hourly} h JOIN {thresholds} t ON t.measurands_id = h.measurands_id GROUP BY 1, 2, 3, 4"""


@query(
    "daily_exceedances",
    "sensor_nodes_id:i measurands_id:i day:d threshold_value:f exceedance_count:i total_count:i hourly_count:i", _EXCEED,
)
def _(f):
    return exceedances.daily_exceedances(f.hourly, f.ctx, f.thresholds)


@query(
    "range_exceedances",
    "sensor_nodes_id:i days:i measurands_id:i threshold_value:f exceedance_count:i total_count:i",
    f"""SELECT sensor_nodes_id, days, measurands_id, threshold_value, sum(exceedance_count) AS exceedance_count, sum(total_count) AS total_count
    FROM {{exceed}} e, (SELECT unnest([1, 14, 30, 90]) AS days) r WHERE day > DATE '2024-01-31' - CAST(days AS INT) GROUP BY 1, 2, 3, 4""",
    {"exceed": _EXCEED},
)
def _(f):
    daily = exceedances.daily_exceedances(f.hourly, f.ctx, f.thresholds)
    return exceedances.range_exceedances(daily, as_of=AS_OF)


@query(
    "latest_exceedance", "sensors_id:i thresholds_id:i threshold_value:f datetime_latest:t",
    """SELECT h.sensors_id, t.thresholds_id, t.value AS threshold_value, max(datetime) AS datetime_latest
    FROM {hourly} h JOIN {thresholds} t ON t.measurands_id = h.measurands_id WHERE h.value_avg >= t.value GROUP BY 1, 2, 3""",
)
def _(f):
    return exceedances.latest_exceedance(f.hourly, f.thresholds)


# requests: a sixth of the events ask without a sensor; every third event in a neighbour node
_ASK = """
SELECT event_id, user_id - user_id % 2 AS sensor_nodes_id,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE user_id*5 + event_id % 5 END AS sensors_id, ts + INTERVAL '40' MINUTE AS datetime
FROM {events}"""


def _flags(f):
    only = F.when(F.col("only_sensors_id").isNotNull(), F.array("only_sensors_id"))
    return f.flags.withColumn("sensors_ids", only)


def _flag_sql(scope: str, level: str | None, low: str = "r.datetime - INTERVAL 1 HOUR", high: str = "r.datetime") -> str:
    lv = f" AND ft.flag_level = '{level}'" if level else ""
    when = f"f.valid_from <= {high} AND (f.valid_to IS NULL OR f.valid_to > {low})"
    node = "f.sensor_nodes_id = r.sensor_nodes_id"
    if scope == "node":
        where = node
    elif scope == "both":
        where = node + " AND ((f.only_sensors_id IS NULL AND r.sensors_id IS NULL) OR f.only_sensors_id = r.sensors_id)"
    else:
        where = ("f.sensor_nodes_id = (SELECT c.sensor_nodes_id FROM {stations} c WHERE c.sensors_id = r.sensors_id) "
                 "AND (f.only_sensors_id IS NULL OR f.only_sensors_id = r.sensors_id)")
    return f"EXISTS (SELECT 1 FROM {{flags}} f JOIN {{flag_types}} ft ON ft.flag_types_id = f.flag_types_id WHERE {where} AND {when}{lv})"


for _scope in ("node", "sensor", "both"):
    for _lvl in (None, *flags.LEVELS):
        query(
            f"flags_exist_{_scope}_{(_lvl or 'any').lower()}", "event_id:i sensor_nodes_id:i sensors_id:i datetime:t flagged:b",
            f"SELECT r.*, {_flag_sql(_scope, _lvl)} AS flagged FROM {{ask}} r", {"ask": _ASK},
        )(
            lambda f, scope=_scope, lvl=_lvl: flags.flags_exist(
                f.sql(_ASK), _flags(f), f.flag_types, f.stations, scope, lvl
            )
        )

_MATRIX = [
    (f"{s}_{(v or 'any').lower()}", _flag_sql(s, v)) for v in (None, *flags.LEVELS) for s in ("both", "node", "sensor")
] + [("both_any_day", _flag_sql("both", None, "r.datetime", "r.datetime + INTERVAL 1 DAY"))]


@query(
    "flag_matrix", "event_id:i " + " ".join(f"{n}:b" for n, _ in _MATRIX),
    "SELECT r.event_id, " + ", ".join(f"{s} AS {n}" for n, s in _MATRIX) + " FROM {ask} r", {"ask": _ASK},
)
def _(f):
    return flags.flag_matrix(f.sql(_ASK), _flags(f), f.flag_types, f.stations)
