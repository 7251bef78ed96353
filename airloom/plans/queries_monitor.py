"""Queries: monitoring, request logs, schedules, and scalar functions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import numeric, textops, timeops
from airloom.operators import catalog, monitor, schedules
from airloom.plans.frames import AS_OF, AS_OF_ORDERS
from airloom.plans.queries_exports import format_sql
from airloom.plans.registry import query

MID = "1998-06-15 12:00:00"


@query(
    "fetchlogs_pending", "added_on:t loaded_min:t loaded_max:t oldest:f jobs:i n:i fetchlogs:s batches:s",
    f"""SELECT date_trunc('hour', init_datetime) AS added_on, min(loaded_datetime) AS loaded_min, max(loaded_datetime) AS loaded_max,
      max(epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(init_datetime)) / 1e6 AS oldest, sum(jobs) AS jobs, count(*) AS n,
      string_agg(CAST(fetchlogs_id AS VARCHAR), ',' ORDER BY fetchlogs_id) AS fetchlogs, string_agg(DISTINCT batch_uuid, ',' ORDER BY batch_uuid) AS batches
    FROM {{fetchlogs}} WHERE completed_datetime IS NULL AND init_datetime IS NOT NULL AND NOT has_error GROUP BY 1""",
)
def _(f):
    rows = monitor.fetchlogs_pending(f.fetchlogs, AS_OF_ORDERS)
    return rows.withColumn("fetchlogs", F.array_join(F.transform("fetchlogs", lambda x: x.cast("string")), ",")).withColumn(
        "batches", F.array_join("batches", ",")
    )


_GRAIN = "added_on:{k} ingest_time_min:f ingest_time_max:f ingest_time_avg:f load_time_min:f load_time_max:f load_time_avg:f files_added:i files_pending:i jobs_avg:f errors:i records:i inserted:i"
_WIDE = " total_size:i avg_size:f pct:f"


def _grain_sql(period: str, where: str, wide: bool) -> str:
    extra = (", sum(file_size) AS total_size, round(avg(file_size)) AS avg_size, round(sum(inserted) / nullif(sum(records), 0) * 100, 1) AS pct"
             if wide else "")
    i = "(epoch_us(completed_datetime) - epoch_us(init_datetime)) / 1e6"
    load = "(epoch_us(completed_datetime) - epoch_us(loaded_datetime)) / 1e6"
    return f"""SELECT {period} AS added_on, min({i}) AS ingest_time_min, max({i}) AS ingest_time_max, avg({i}) AS ingest_time_avg,
      min({load}) AS load_time_min, max({load}) AS load_time_max, avg({load}) AS load_time_avg, count(*) AS files_added,
      count(*) FILTER (WHERE completed_datetime IS NULL) AS files_pending, round(avg(jobs)) AS jobs_avg, count(*) FILTER (WHERE has_error) AS errors,
      sum(records) AS records, sum(inserted) AS inserted{extra} FROM {{fetchlogs}} WHERE {where} GROUP BY 1"""


@query("fetchlogs_recent_summary", _GRAIN.format(k="t"),
       _grain_sql("date_trunc('hour', init_datetime)", f"init_datetime > TIMESTAMP '{MID}' - INTERVAL 24 HOUR", False))
def _(f):
    return monitor.fetchlogs_summary(f.fetchlogs, "recent", MID)


@query("fetchlogs_daily_summary", _GRAIN.format(k="d") + _WIDE,
       _grain_sql("CAST(init_datetime AS DATE)", "CAST(init_datetime AS DATE) >= DATE '1998-06-15' - 14", True))
def _(f):
    return monitor.fetchlogs_summary(f.fetchlogs, "daily", MID)


@query("fetchlogs_hourly_summary", _GRAIN.format(k="t") + _WIDE,
       _grain_sql("date_trunc('hour', init_datetime)", "CAST(init_datetime AS DATE) >= DATE '1998-06-15' - 7", True))
def _(f):
    return monitor.fetchlogs_summary(f.fetchlogs, "hourly", MID)


@query(
    "fetchlogs_recent_issues",
    "fetchlogs_id:i init_datetime:t key:s jobs:i modified_time:f ingest_time:f loaded_time:f has_error:b hours_ago:f",
    f"""SELECT fetchlogs_id, init_datetime, key, jobs, (epoch_us(last_modified) - epoch_us(init_datetime)) / 1e6 AS modified_time,
      (epoch_us(completed_datetime) - epoch_us(init_datetime)) / 1e6 AS ingest_time, (epoch_us(completed_datetime) - epoch_us(loaded_datetime)) / 1e6 AS loaded_time,
      has_error, (epoch_us(completed_datetime) - epoch_us(init_datetime)) / 3.6e9 AS hours_ago FROM {{fetchlogs}}
    WHERE completed_datetime > TIMESTAMP '{MID}' - INTERVAL 24 HOUR AND NOT regexp_matches(key, 'station', 'i')
      AND (has_error OR jobs > 1 OR completed_datetime - init_datetime > INTERVAL 1 HOUR)""",
)
def _(f):
    return monitor.fetchlogs_recent_issues(f.fetchlogs, MID)


@query(
    "records_inserted", "datetime:t period:s pattern:s inserted:i records:i percentage:f files:i min:i max:i",
    """SELECT date_trunc('week', init_datetime) AS datetime, 'week' AS period, 'REAL' AS pattern, sum(inserted) AS inserted, sum(records) AS records,
      CASE WHEN sum(records) > 0 THEN round(sum(inserted) / sum(records) * 100) ELSE 0 END AS percentage, count(*) AS files, min(inserted) AS min, max(inserted) AS max
    FROM {fetchlogs} WHERE init_datetime > TIMESTAMP '1995-06-01' AND regexp_matches(key, 'REAL', 'i') GROUP BY 1""",
)
def _(f):
    return monitor.records_inserted(f.fetchlogs, "week", "1995-06-01", "REAL")


@query(
    "fetcher_source_summary",
    "source_name:s n:i zeros:i pct_success:f min:f p02:f p25:f p50:f avg:f sd:f p75:f p98:f max:f skew:f",
    """SELECT source_name, n, zeros, CASE WHEN zeros = 0 THEN 100 ELSE round((1 - zeros / n) * 100, 1) END AS pct_success, min, round(p02, 1) AS p02,
      round(p25, 1) AS p25, round(p50, 1) AS p50, round(avg, 1) AS avg, round(sd, 1) AS sd, round(p75, 1) AS p75, round(p98, 1) AS p98, max,
      CASE WHEN sd > 0 THEN round(3 * (avg - p50) / sd, 2) ELSE 0 END AS skew FROM (
      SELECT source_name, count(*) AS n, count(*) FILTER (WHERE records = 0) AS zeros, min(records) AS min, quantile_cont(records, 0.02) AS p02,
        quantile_cont(records, 0.25) AS p25, quantile_cont(records, 0.5) AS p50, avg(records) AS avg, stddev(records) AS sd,
        quantile_cont(records, 0.75) AS p75, quantile_cont(records, 0.98) AS p98, max(records) AS max
      FROM {fetcher_responses} WHERE datetime > TIMESTAMP '1995-01-01' AND datetime < TIMESTAMP '2001-12-31' GROUP BY 1) x""",
)
def _(f):
    return monitor.fetcher_source_summary(f.fetcher_responses, "1995-01-01", "2001-12-31")


@query(
    "fetcher_retention", "source_name:s datetime:t records:i",
    "SELECT * FROM {fetcher_responses} WHERE datetime >= TIMESTAMP '1999-01-01'",
)
def _(f):
    return monitor.keep_since(f.fetcher_responses, "datetime", "1999-01-01")


@query(
    "log_retention", "api_key:i endpoint:s added_on:t",
    "SELECT api_key, endpoint, added_on FROM {api_logs} WHERE added_on >= TIMESTAMP '2024-01-15'",
)
def _(f):
    return monitor.keep_since(f.api_logs, "added_on", "2024-01-15")


def node_check(f):
    return catalog.sensor_nodes_check(
        f.sensor_nodes, f.timezones, f.providers, f.sensor_systems, f.sensors, f.measurands, f.lifetime, AS_OF
    )


NODE_CHECK = f"""SELECT n.sensor_nodes_id, n.site_name, n.source_name, n.source_id, n.origin, coalesce(p.label, 'Not found') AS provider, n.lon, n.lat,
      t.tzid AS timezone, (epoch_us(timezone(t.tzid, timezone('UTC', TIMESTAMP '{AS_OF}'))) - epoch_us(TIMESTAMP '{AS_OF}')) // 1000000 AS utc_offset,
      s.sensors_id, coalesce(m.measurand || ' ' || m.units, 'Not found') AS parameter, l.datetime_first, l.datetime_last,
      CASE WHEN l.datetime_first < l.datetime_last THEN round(l.value_count / ((epoch_us(l.datetime_last) - epoch_us(l.datetime_first)) / 1e6
        / s.data_logging_period_seconds) * 100) END AS percent_complete, s.added_on AS sensor_added_on, n.added_on AS node_added_on, s.data_logging_period_seconds
    FROM {{sensor_nodes}} n LEFT JOIN {{timezones}} t ON t.timezones_id = n.timezones_id LEFT JOIN {{providers}} p ON p.providers_id = n.providers_id
    LEFT JOIN {{sensor_systems}} y ON y.sensor_nodes_id = n.sensor_nodes_id LEFT JOIN {{sensors}} s ON s.sensor_systems_id = y.sensor_systems_id
    LEFT JOIN {{measurands}} m ON m.measurands_id = s.measurands_id LEFT JOIN {{lifetime}} l ON l.sensors_id = s.sensors_id"""

for _name, _pattern in (("measurements_per_hour", None), ("measurements_per_hour_pattern", "^(error|VIEW)")):
    _cond = f" AND regexp_matches(parameter, '{_pattern}', 'i')" if _pattern else ""
    query(
        _name, "sensor_nodes_count:i sensors_count:i measurements_per_hour_expected:f measurements_per_hour_observed:f",
        f"""SELECT count(DISTINCT sensor_nodes_id) AS sensor_nodes_count, count(DISTINCT sensors_id) AS sensors_count,
      round(sum(3600.0 / data_logging_period_seconds)) AS measurements_per_hour_expected,
      round(sum(3600.0 / data_logging_period_seconds * (percent_complete / 100.0))) AS measurements_per_hour_observed
    FROM {{node_check}} WHERE datetime_last > TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY{_cond}""", {"node_check": NODE_CHECK},
    )(lambda f, p=_pattern: monitor.measurements_per_hour(node_check(f), 10 * 86400, p, AS_OF))


@query(
    "compare_timing",
    "endpoint:s before_hits:i after_hits:i before_timing:i after_timing:i diff_timing:i before_hours:f after_hours:f diff_hours:f diff_percent:f",
    """SELECT a.endpoint, b.hits AS before_hits, a.hits AS after_hits, CAST(round(b.mu) AS INT) AS before_timing, CAST(round(a.mu) AS INT) AS after_timing,
      CAST(round(a.mu - b.mu) AS INT) AS diff_timing, round(b.hours, 1) AS before_hours, round(a.hours, 1) AS after_hours,
      round((a.mu - b.mu) * a.hits / 3.6e6, 1) AS diff_hours, round((a.mu - b.mu) / b.mu * 100, 1) AS diff_percent
    FROM (SELECT endpoint, count(*) AS hits, avg(timing) AS mu, sum(timing / 3.6e6) AS hours FROM {api_logs} WHERE added_on > TIMESTAMP '2024-01-14'
      AND added_on < TIMESTAMP '2024-01-28' GROUP BY 1 HAVING count(*) > 10) a
    JOIN (SELECT endpoint, count(*) AS hits, avg(timing) AS mu, sum(timing / 3.6e6) AS hours FROM {api_logs} WHERE added_on < TIMESTAMP '2024-01-14'
      AND added_on > TIMESTAMP '2023-12-31' GROUP BY 1 HAVING count(*) > 10) b ON a.endpoint = b.endpoint""",
)
def _(f):
    return monitor.compare_timing(f.api_logs, "2024-01-14", window_s=14 * 86400, min_hits=10)


_AGENT = """SELECT agent, min(agents_id) AS agents_id FROM (SELECT DISTINCT agent FROM {api_logs}) l JOIN {agents} a ON regexp_matches(l.agent, a.pattern) GROUP BY 1"""
_SENSOR = "CASE WHEN regexp_full_match(json_extract_string(params, '$.sensors_id'), '\\d+') THEN CAST(json_extract_string(params, '$.sensors_id') AS BIGINT) END"
_NODE = "CASE WHEN regexp_full_match(json_extract_string(params, '$.locations_id'), '\\d+') THEN CAST(json_extract_string(params, '$.locations_id') AS BIGINT) END"
_TOTALS = "count(*) AS requests_count, round(sum(CAST(timing AS DECIMAL(24,6)))) AS requests_time"
_KINDS = (
    ("total", None, "{api_logs}"),
    ("status", "status_code", "{api_logs}"),
    ("resource", "resource", "(SELECT *, endpoint AS resource FROM {api_logs}) l"),
    ("agent", "agents_id", "{api_logs} l JOIN {agent} g ON g.agent = l.agent"),
    ("user", "users_id", "{api_logs} l JOIN {user_keys} u ON u.token = l.api_key"),
    ("sensor", "sensors_id", "(SELECT x.*, " + _SENSOR + " AS sensors_id FROM {api_logs} x) l WHERE sensors_id IS NOT NULL"),
    ("node", "sensor_nodes_id", "(SELECT x.timing, x.added_on, coalesce(x.n, c.sensor_nodes_id) AS sensor_nodes_id FROM (SELECT y.*, " + _SENSOR
     + " AS s, " + _NODE + " AS n FROM {api_logs} y) x LEFT JOIN {stations} c ON c.sensors_id = x.s) l WHERE sensor_nodes_id IS NOT NULL"),
)
for _kind, _col, _from in _KINDS:
    _cols = f", {_col}" if _col else ""
    _text = "s" if _kind == "resource" else "i"
    query(
        f"daily_requests_{_kind}", "day:d " + (f"{_col}:{_text} " if _col else "") + "requests_count:i requests_time:f",
        f"SELECT CAST(added_on AS DATE) AS day{_cols}, {_TOTALS} FROM {_from} GROUP BY 1{', 2' if _col else ''}", {"agent": _AGENT},
    )(
        lambda f, kind=_kind: monitor.daily_requests(
            f.api_logs, kind, lookup={"agent": lambda: f.agents, "user": lambda: f.user_keys, "node": lambda: f.stations}.get(kind, lambda: None)()
        )
    )


_OF_DAY = "SELECT * FROM {api_logs} WHERE added_on >= TIMESTAMP '2024-01-10' AND added_on < TIMESTAMP '2024-01-11'"


def _in_kinds() -> str:
    """All kinds of one day in one table; the texts above over the day's rows."""
    parts = [
        f"SELECT '{kind}' AS kind, {f'CAST({col} AS VARCHAR)' if col else 'CAST(NULL AS VARCHAR)'} AS key, CAST(added_on AS DATE) AS day, {_TOTALS} "
        f"FROM {source.replace('{api_logs}', '{of_day}')} GROUP BY 2, 3"
        for kind, col, source in _KINDS
    ]
    return "\nUNION ALL ".join(parts)


@query("process_daily_logs", "kind:s key:s day:d requests_count:i requests_time:f", _in_kinds(), {"agent": _AGENT, "of_day": _OF_DAY})
def _(f):
    return monitor.process_daily_logs(f.api_logs, "2024-01-10", f.agents, f.user_keys, f.stations)[0]


@query(
    "process_daily_logs_rest", "api_key:i status_code:i endpoint:s agent:s added_on:t",
    "SELECT * FROM {api_logs} WHERE added_on < TIMESTAMP '2024-01-10' OR added_on >= TIMESTAMP '2024-01-11'",
)
def _(f):
    return monitor.process_daily_logs(f.api_logs, "2024-01-10", f.agents, f.user_keys, f.stations, drop_processed=True)[1]


@query(
    "uncategorized_requests", "agent:s n:i time:f first_requested:t last_requested:t keys:i",
    """SELECT agent, count(*) AS n, round(sum(CAST(timing AS DECIMAL(24,6)))) AS time, min(added_on) AS first_requested, max(added_on) AS last_requested, count(DISTINCT api_key) AS keys
    FROM {api_logs} WHERE agent NOT IN (SELECT agent FROM {agent}) GROUP BY 1""", {"agent": _AGENT},
)
def _(f):
    return monitor.uncategorized_requests(f.api_logs, f.agents)


@query(
    "ingest_backlog", "total_count:i loaded_count:i pending_count:i failed_count:i oldest_minutes:f",
    f"""SELECT count(*) AS total_count, count(loaded_datetime) AS loaded_count,
      count(*) FILTER (WHERE loaded_datetime > TIMESTAMP '{MID}' - INTERVAL 15 MINUTE) AS pending_count, count(*) FILTER (WHERE has_error) AS failed_count,
      max(round((epoch_us(TIMESTAMP '{MID}') - epoch_us(init_datetime)) / 6e7)) AS oldest_minutes FROM {{fetchlogs}} WHERE completed_datetime IS NULL""",
)
def _(f):
    return monitor.ingest_backlog(f.fetchlogs, MID)


_STATS = """SELECT o_custkey, o_orderdate AS ingested_on, o_totalprice AS latest_measurements_inserted, CAST(o_custkey % 5 AS DOUBLE) AS latest_insert_time_ms,
  o_totalprice * 2 AS total_measurements_inserted, CAST(o_custkey % 7 AS DOUBLE) AS total_insert_time_ms, CAST(o_custkey % 11 AS DOUBLE) AS total_process_time_ms,
  CAST(o_custkey % 13 AS DOUBLE) AS total_cache_time_ms, CAST(o_custkey % 3 AS DOUBLE) AS ingest_count, o_orderkey FROM {orders}"""


@query(
    "ingest_rates", "o_orderkey:i latest_rows_per_ms:f total_rows_per_ms:f average_process_time:f average_insert_time:f average_cache_time:f",
    """SELECT o_orderkey, latest_measurements_inserted / nullif(latest_insert_time_ms, 0) AS latest_rows_per_ms,
      total_measurements_inserted / nullif(total_insert_time_ms, 0) AS total_rows_per_ms, total_process_time_ms / nullif(ingest_count, 0) AS average_process_time,
      total_insert_time_ms / nullif(ingest_count, 0) AS average_insert_time, total_cache_time_ms / nullif(ingest_count, 0) AS average_cache_time FROM {stats}""",
    {"stats": _STATS},
)
def _(f):
    return monitor.ingest_rates(f.sql(_STATS))


@query(
    "stuck_jobs", "fetchlogs_id:i key:s scheduled_datetime:t queued_datetime:t stuck_duration:f",
    f"""SELECT fetchlogs_id, key, scheduled_datetime, queued_datetime, (epoch_us(TIMESTAMP '{MID}') - epoch_us(queued_datetime)) / 1e6 AS stuck_duration
    FROM {{fetchlogs}} WHERE queued_datetime < TIMESTAMP '{MID}' - INTERVAL 1 HOUR AND loaded_datetime IS NULL""",
)
def _(f):
    return monitor.stuck_jobs(f.fetchlogs, MID)


@query(
    "deployment_health",
    "deployments_id:i label:s schedule:s is_active:b last_deployed_datetime:t temporal_offset:i queue_name:s time_since_last_run:f "
    "runs_last_24h:i completed_last_24h:i errors_last_24h:i adapters_count:i",
    f"""SELECT d.deployments_id, d.label, d.schedule, d.is_active, d.last_deployed_datetime, d.temporal_offset, h.queue_name,
      (epoch_us(TIMESTAMP '{MID}') - epoch_us(d.last_deployed_datetime)) / 1e6 AS time_since_last_run,
      (SELECT count(*) FROM {{fetchlogs}} f WHERE f.deployments_id = d.deployments_id AND f.scheduled_datetime > TIMESTAMP '{MID}' - INTERVAL 24 HOUR) AS runs_last_24h,
      (SELECT count(*) FROM {{fetchlogs}} f WHERE f.deployments_id = d.deployments_id AND f.completed_datetime IS NOT NULL AND f.scheduled_datetime > TIMESTAMP '{MID}' - INTERVAL 24 HOUR) AS completed_last_24h,
      (SELECT count(*) FROM {{fetchlogs}} f WHERE f.deployments_id = d.deployments_id AND f.has_error AND f.scheduled_datetime > TIMESTAMP '{MID}' - INTERVAL 24 HOUR) AS errors_last_24h,
      (SELECT count(*) FROM {{deployment_adapters}} a WHERE a.deployments_id = d.deployments_id) AS adapters_count
    FROM {{deployments}} d JOIN {{handlers}} h ON h.handlers_id = d.handlers_id""",
)
def _(f):
    return monitor.deployment_health(f.deployments, f.handlers, f.fetchlogs, f.deployment_adapters, MID)


_RUNS = """SELECT CAST(o_custkey % 50 AS BIGINT) AS jobid, o_orderdate AS start_time, o_orderdate + (o_orderkey % 77) * INTERVAL '1' SECOND AS end_time,
  CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'succeeded' END AS status FROM {orders}"""
_JOBS = "SELECT s_suppkey AS jobid, s_name AS jobname, s_suppkey % 4 <> 0 AS active FROM {supplier}"


@query(
    "job_summary", "jobid:i jobname:s active:b min_duration:f max_duration:f avg_duration:f n:i failed:i",
    f"""SELECT r.jobid, jobname, active, min(epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS min_duration, max(epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS max_duration,
      avg(epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS avg_duration, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS failed
    FROM {{runs}} r JOIN {{jobs}} j ON j.jobid = r.jobid WHERE start_time > TIMESTAMP '{MID}' - INTERVAL 365 DAY GROUP BY 1, 2, 3""",
    {"runs": _RUNS, "jobs": _JOBS},
)
def _(f):
    return monitor.job_summary(f.sql(_RUNS), f.sql(_JOBS), 365 * 86400, MID)


_PROCESS = "SELECT o_orderkey, concat('p-', o_orderpriority) AS process_name, o_orderdate AS start_datetime, o_orderdate + (o_custkey % 99) * INTERVAL '1' SECOND AS end_datetime FROM {orders}"


@query(
    "process_durations", "process_name:s start_datetime:t end_datetime:t process_time:f",
    "SELECT process_name, start_datetime, end_datetime, (epoch_us(end_datetime) - epoch_us(start_datetime)) / 1e6 AS process_time FROM {process}",
    {"process": _PROCESS},
)
def _(f):
    return monitor.process_durations(f.sql(_PROCESS))


_TIMINGS = "SELECT o_custkey % 100 AS n, o_totalprice / 1000 AS elapsed FROM {orders}"


@query(
    "timing_summary", "n:f n_sd:f r:f avg:f sd:f min:f p25:f p50:f p75:f p95:f max:f",
    """SELECT avg(n) AS n, stddev(n) AS n_sd, corr(n, elapsed) AS r, avg(elapsed) AS avg, stddev(elapsed) AS sd, min(elapsed) AS min,
      quantile_cont(elapsed, 0.25) AS p25, quantile_cont(elapsed, 0.5) AS p50, quantile_cont(elapsed, 0.75) AS p75, quantile_cont(elapsed, 0.95) AS p95,
      max(elapsed) AS max FROM {timings}""", {"timings": _TIMINGS},
)
def _(f):
    return monitor.timing_summary(f.sql(_TIMINGS))


# ---- schedules ----------------------------------------------------------------------------------


def _part_sql(field: str, value: str, low: int) -> str:
    """One schedule field tested against a value, spelled out over its comma parts."""
    return f"""({field} = '*' OR list_bool_or(list_transform(string_split({field}, ','), lambda p: coalesce(CASE
      WHEN contains(p, '/') THEN CASE WHEN string_split(p, '/')[1] = '*' THEN ({value} - {low}) % CAST(string_split(p, '/')[2] AS INT) = 0
        ELSE {value} >= TRY_CAST(string_split(string_split(p, '/')[1], '-')[1] AS INT)
          AND {value} <= coalesce(TRY_CAST(string_split(string_split(p, '/')[1], '-')[2] AS INT), TRY_CAST(string_split(string_split(p, '/')[1], '-')[1] AS INT))
          AND ({value} - TRY_CAST(string_split(string_split(p, '/')[1], '-')[1] AS INT)) % CAST(string_split(p, '/')[2] AS INT) = 0 END
      WHEN contains(p, '-') THEN {value} >= TRY_CAST(string_split(p, '-')[1] AS INT) AND {value} <= TRY_CAST(string_split(p, '-')[2] AS INT)
      ELSE {value} = TRY_CAST(p AS INT) END, false))))"""


_READY = f"""{_part_sql("f[1]", "minute(tm)", 0)} AND {_part_sql("f[2]", "hour(tm)", 0)} AND {_part_sql("f[4]", "month(tm)", 1)}
  AND ((f[3] = '*' AND f[5] = '*') OR (f[3] <> '*' AND {_part_sql("f[3]", "day(tm)", 1)}) OR (f[5] <> '*' AND {_part_sql("f[5]", "dayofweek(tm)", 0)}))"""
_EXPECTED = f"""SELECT d.deployments_id, tm AS run_at FROM (SELECT deployments_id, string_split(schedule, ' ') AS f FROM {{deployments}}) d,
      (SELECT unnest(generate_series(TIMESTAMP '1998-06-01 00:30:00', TIMESTAMP '1998-07-15 06:00:00', INTERVAL 1 MINUTE)) AS tm) t WHERE {_READY}"""


def _runs(f):
    return schedules.schedule_runs(f.deployments, "1998-06-01 00:30:00", "1998-07-15 06:00:00").select("deployments_id", "run_at")


@query("schedule_runs", "deployments_id:i run_at:t", _EXPECTED)
def _(f):
    return _runs(f)


@query(
    "missed_runs", "deployments_id:i run_at:t",
    """SELECT * FROM {expected} e WHERE NOT EXISTS (SELECT 1 FROM {fetchlogs} f WHERE f.deployments_id = e.deployments_id
      AND date_trunc('minute', f.scheduled_datetime) = e.run_at)""", {"expected": _EXPECTED},
)
def _(f):
    return schedules.missed_runs(_runs(f), f.fetchlogs)


def deployment_adapters(f):
    return catalog.deployment_adapters_view(f.deployments, f.handlers, f.deployment_adapters, f.adapters, f.providers)


ADAPTER_TEXT = """coalesce((SELECT string_agg(concat_ws('|', a.adapters_id, p.providers_id, p.source_name, a.client_name, a.config), ';' ORDER BY a.adapters_id)
      FROM {deployment_adapters} da JOIN {adapters} a ON a.adapters_id = da.adapters_id JOIN {providers} p ON p.providers_id = a.providers_id
      WHERE da.deployments_id = d.deployments_id), '')"""


def adapter_text(column="adapters"):
    one = lambda a: F.concat_ws(
        "|", a["adapters_id"].cast("string"), a["providers_id"].cast("string"), a["provider_name"], a["adapter_client"], a["adapter_config"]
    )
    return F.coalesce(F.array_join(F.transform(column, one), ";"), F.lit(""))


@query(
    "ready_deployments", "deployments_id:i label:s queue_name:s scheduled_datetime:t temporal_offset:i key:s adapters:s",
    f"""SELECT d.deployments_id, d.label, h.queue_name, tm AS scheduled_datetime, d.temporal_offset,
      strftime(tm, '%Y-%m-%d') || '/' || filename_prefix || '/' || filename_prefix || '-' || strftime(tm, '%Y%m%d%H%M') || '.' || output_format AS key,
      {ADAPTER_TEXT} AS adapters
    FROM (SELECT *, string_split(schedule, ' ') AS f, TIMESTAMP '2001-12-10 01:05:00' AS tm FROM {{deployments}}) d JOIN {{handlers}} h ON h.handlers_id = d.handlers_id
    WHERE is_active AND (last_deployed_datetime IS NULL OR date_trunc('minute', last_deployed_datetime) <> date_trunc('minute', tm)) AND {_READY}""",
)
def _(f):
    rows = schedules.ready_deployments(f.deployments, f.handlers, deployment_adapters(f), "2001-12-10 01:05:00")
    return rows.withColumn("adapters", adapter_text())


@query(
    "invalid_schedules", "deployments_id:i schedule:s",
    """SELECT deployments_id, schedule FROM (SELECT *, string_split(schedule, ' ') AS f FROM {deployments}) d
    WHERE NOT (
      CASE WHEN contains(f[1], '/') THEN string_split(f[1], '/')[1] = '*' AND CAST(string_split(f[1], '/')[2] AS INT) BETWEEN 1 AND 59 ELSE CAST(f[1] AS INT) BETWEEN 0 AND 59 END
      AND CASE WHEN contains(f[2], ',') THEN list_bool_and(list_transform(string_split(f[2], ','), lambda p: CAST(p AS INT) BETWEEN 0 AND 23))
        WHEN f[2] = '*' THEN true ELSE CAST(f[2] AS INT) BETWEEN 0 AND 23 END)""",
)
def _(f):
    return schedules.invalid_schedules(f.deployments)


# ---- audits -------------------------------------------------------------------------------------


@query(
    "table_counts_audit", "table_name:s rows:i minimum:i enough:b",
    """SELECT 'nodes' AS table_name, (SELECT count(*) FROM {sensor_nodes}) AS rows, 1000 AS minimum, (SELECT count(*) FROM {sensor_nodes}) >= 1000 AS enough
    UNION ALL SELECT 'measurements', (SELECT count(*) FROM {measurements}), 1000000, (SELECT count(*) FROM {measurements}) >= 1000000""",
)
def _(f):
    return monitor.table_counts_audit({"nodes": f.sensor_nodes, "measurements": f.measurements}, {"nodes": 1000, "measurements": 1000000})


_EXPECTED = """SELECT c_custkey AS sensor_nodes_id, CASE WHEN c_custkey % 7 = 0 THEN '??' ELSE substring(n_name, 8, 2) END AS iso
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey UNION ALL SELECT -n_nationkey - 1, 'XX' FROM {nation}"""


@query(
    "node_countries_audit", "sensor_nodes_id:i expected:s found:s as_expected:b",
    """SELECT e.sensor_nodes_id, e.iso AS expected, c.iso AS found, coalesce(c.iso = e.iso, false) AS as_expected FROM {expected} e
    LEFT JOIN {sensor_nodes} n ON n.sensor_nodes_id = e.sensor_nodes_id LEFT JOIN {countries} c ON c.countries_id = n.countries_id""",
    {"expected": _EXPECTED},
)
def _(f):
    return monitor.node_countries_audit(f.sensor_nodes, f.countries, f.sql(_EXPECTED))


_SITES = "SELECT c.sensors_id, c.tzid, n.site_name FROM {ctx} c JOIN {sensor_nodes} n ON n.sensor_nodes_id = c.sensor_nodes_id"
_COFF = "(CAST(epoch_us(timezone(s.tzid, timezone('UTC', m.datetime))) - epoch_us(m.datetime) AS BIGINT) // 1000000)"


def _canary(f, mode):
    sites = f.ctx.select("sensors_id", "tzid", "sensor_nodes_id").join(f.sensor_nodes.select("sensor_nodes_id", "site_name"), "sensor_nodes_id")
    return monitor.canary_days(f.measurements, sites.select("sensors_id", "tzid", "site_name"), mode)


_SERIES = f"""SELECT m.sensors_id, s.site_name, s.tzid, m.datetime, {_COFF} AS off, m.value FROM {{measurements}} m JOIN {{sites}} s ON s.sensors_id = m.sensors_id"""
for _mode, _at in (("utc", "datetime - INTERVAL 1 SECOND"), ("local", "datetime + (off - 1) * INTERVAL 1 SECOND")):
    query(
        f"canary_days_{_mode}", "site_name:s day:d first_datetime:t last_datetime:t value_count:i value_avg:f",
        f"""SELECT site_name, CAST({_at} AS DATE) AS day, min({_at}) AS first_datetime, max({_at}) AS last_datetime, count(value) AS value_count, avg(value) AS value_avg
    FROM {{series}} GROUP BY 1, 2""", {"sites": _SITES, "series": _SERIES},
    )(lambda f, mode=_mode: _canary(f, mode))


@query(
    "canary_days_compare", "site_name:s datetime:t local_datetime_zone:t local_datetime_interval:t value:f utc_offset:i",
    """SELECT site_name, datetime, timezone(tzid, timezone('UTC', datetime)) AS local_datetime_zone, datetime + off * INTERVAL 1 SECOND AS local_datetime_interval,
      value, off AS utc_offset FROM {series}""", {"sites": _SITES, "series": _SERIES},
)
def _(f):
    return _canary(f, "compare")


# ---- scalar functions, over whole tables ----------------------------------------------------------

_LONG = "SELECT DISTINCT m.datetime, c.tzid FROM {measurements_long} m JOIN {ctx} c ON c.sensors_id = m.sensors_id"


def _long(f):
    return f.measurements_long.join(f.ctx, "sensors_id").select("datetime", "tzid").distinct()


def _o(at: str = "datetime") -> str:
    return f"(CAST(epoch_us(timezone(tzid, timezone('UTC', {at}))) - epoch_us({at}) AS BIGINT) // 1000000)"


@query(
    "time_functions_offset", "datetime:t tzid:s offset_s:i offset_hours:i as_local:t as_local_hour:t local_hour_int:i hour_start:t as_date:d as_year:d",
    f"""SELECT datetime, tzid, {_o()} AS offset_s, CAST(trunc({_o()} / 3600) AS INT) AS offset_hours, timezone(tzid, timezone('UTC', datetime)) AS as_local,
      timezone(tzid, timezone('UTC', date_trunc('hour', datetime))) AS as_local_hour, hour(timezone(tzid, timezone('UTC', datetime))) AS local_hour_int,
      date_trunc('hour', datetime + ({_o()} - 1) * INTERVAL 1 SECOND) - {_o()} * INTERVAL 1 SECOND AS hour_start,
      CAST(timezone(tzid, timezone('UTC', datetime - INTERVAL 1 SECOND)) AS DATE) AS as_date,
      date_trunc('year', timezone(tzid, timezone('UTC', datetime - INTERVAL 1 SECOND))) AS as_year FROM {{long}}""", {"long": _LONG},
)
def _(f):
    at, tz = "datetime", F.col("tzid")
    off = timeops.offset_seconds(at, tz)
    return _long(f).select(
        at, "tzid", off.alias("offset_s"), timeops.offset_hours(at, tz).alias("offset_hours"), timeops.local_time(at, tz).alias("as_local"),
        timeops.local_hour(at, tz).alias("as_local_hour"), timeops.local_hour_int(at, tz).alias("local_hour_int"),
        timeops.hour_start(at, off).alias("hour_start"), timeops.local_date(at, tz).alias("as_date"), timeops.local_year(at, tz).alias("as_year"),
    )


@query(
    "time_functions_truncate", "event_id:i plain:t shifted:t zoned_day:t zoned_shifted:t minutes15:t wall_as_utc:t",
    """SELECT event_id, date_trunc('hour', ts - INTERVAL 1 SECOND) AS plain, date_trunc('day', ts + INTERVAL 20699 SECOND) AS shifted,
      timezone('UTC', timezone('Asia/Kathmandu', date_trunc('day', timezone('Asia/Kathmandu', timezone('UTC', ts - INTERVAL 1 SECOND))))) AS zoned_day,
      timezone('UTC', timezone('Asia/Kolkata', date_trunc('hour', timezone('Asia/Kolkata', timezone('UTC', ts + INTERVAL 3599 SECOND))))) AS zoned_shifted,
      date_trunc('hour', ts) + minute(ts) // 15 * INTERVAL 15 MINUTE AS minutes15, timezone('UTC', timezone('Pacific/Auckland', ts)) AS wall_as_utc FROM {events}""",
)
def _(f):
    rows = f.sql("SELECT event_id, ts FROM {events}")
    return rows.select(
        "event_id", timeops.truncate("ts", "hour").alias("plain"), timeops.truncate("ts", "day", offset_s=F.lit(20700)).alias("shifted"),
        timeops.truncate("ts", "day", "Asia/Kathmandu").alias("zoned_day"),
        timeops.truncate("ts", "hour", "Asia/Kolkata", F.lit(3600)).alias("zoned_shifted"),
        timeops.floor_minutes("ts", 15).alias("minutes15"), timeops.as_utc("ts", "Pacific/Auckland").alias("wall_as_utc"),
    )


@query(
    "datetime_objects", "datetime:t tzid:s utc:s local:s timezone:s from_wall:s",
    f"""SELECT datetime, tzid, {format_sql("'UTC'", 'datetime')} AS utc, {format_sql('tzid', 'datetime')} AS local, tzid AS timezone,
      strftime(timezone('UTC', timezone('Asia/Kathmandu', datetime)), '%Y-%m-%dT%H:%M:%S+00:00') AS from_wall FROM {{long}}""", {"long": _LONG},
)
def _(f):
    told = timeops.datetime_object("datetime", F.col("tzid"))
    wall = timeops.wall_datetime_object(F.to_date("datetime"), "Asia/Kathmandu")
    return _long(f).select("datetime", "tzid", told.alias("o"), wall["utc"].alias("from_wall")).select("datetime", "tzid", "o.*", "from_wall")


@query(
    "slugify", "page_id:i slug:s",
    """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(url)), '[''"]+', '', 'g'),
      '[^a-z0-9\\\\\\]^_]+', '-', 'g'), '-+$', ''), '^-', '') AS slug FROM {pages}""".replace("\\\\\\]", "\\\\\\]"),
)
def _(f):
    return f.pages.select("page_id", textops.slugify(F.col("url")).alias("slug"))


@query(
    "sig_digits", "o_orderkey:i rounded:f",
    """SELECT o_orderkey, CASE WHEN v = 0 THEN 0 ELSE round(v / pow(10, floor(log10(abs(v))) - 2)) * pow(10, floor(log10(abs(v))) - 2) END AS rounded
    FROM (SELECT o_orderkey, o_totalprice - (o_custkey % 3) * o_totalprice AS v FROM {orders}) x""",
)
def _(f):
    rows = f.sql("SELECT o_orderkey, o_totalprice - (o_custkey % 3) * o_totalprice AS v FROM {orders}")
    return rows.select("o_orderkey", numeric.sig_digits(F.col("v"), 3).alias("rounded"))


@query(
    "json_arrays", "event_id:i elements:s objects:s ints:s distinct_ints:s",
    """SELECT event_id, CAST(k AS VARCHAR) || '/"x"' AS elements, '[{{"n":' || k || '},{{"n":' || user_id || '}]' AS objects,
      k || ',' || (user_id % 3) || ',' || k AS ints, CASE WHEN k = user_id % 3 THEN CAST(k AS VARCHAR) ELSE k || ',' || (user_id % 3) END AS distinct_ints
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events}) e""".replace("}'", "}}'").replace("},{{", "}},{{").replace("}]'", "}}]'"),
)
def _(f):
    rows = f.sql("SELECT event_id, user_id, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events}")
    ints = textops.int_array(F.concat(F.lit("["), F.concat_ws(",", F.col("k"), F.col("user_id") % 3, F.col("k")), F.lit(",null]")))
    mixed = textops.json_elements(F.concat(F.lit("["), F.col("k"), F.lit(', "x"]')))
    join = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return rows.select(
        "event_id", F.array_join(mixed, "/").alias("elements"),
        textops.objects_with_key("n", F.array(F.col("k").cast("bigint"), F.col("user_id"))).alias("objects"),
        join(ints).alias("ints"), join(textops.distinct_elements(ints, ignore_nulls=True)).alias("distinct_ints"),
    )
