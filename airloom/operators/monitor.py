"""Ingest, job and request-log reports. The clock is always the parameter `as_of`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions import numeric, textops, timeops


def _since(as_of: str, seconds: int) -> Column:
    return timeops.shift(timeops.instant(as_of), -seconds)


def _exact_sum(c) -> Column:
    """Decimal sum: the same whatever order rows arrive in, so rounding is stable."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(24,6)"))


def _whole(c: Column) -> Column:
    return F.round(c).cast("double")


# ---- ingest log ----------------------------------------------------------------------------------


def fetchlogs_pending(logs: DataFrame, as_of: str) -> DataFrame:
    """Unfinished files per hour of entry, newest first."""
    rows = logs.where(F.col("completed_datetime").isNull() & F.col("init_datetime").isNotNull() & ~F.col("has_error"))
    return rows.groupBy(F.date_trunc("hour", "init_datetime").alias("added_on")).agg(
        F.min("loaded_datetime").alias("loaded_min"),
        F.max("loaded_datetime").alias("loaded_max"),
        F.max(timeops.seconds_between(timeops.instant(as_of), "init_datetime")).alias("oldest"),
        F.sum("jobs").alias("jobs"),
        F.count("*").alias("n"),
        F.sort_array(F.collect_list("fetchlogs_id")).alias("fetchlogs"),
        F.sort_array(F.collect_set("batch_uuid")).alias("batches"),
    ).orderBy(F.desc("added_on"))


def fetchlogs_summary(logs: DataFrame, grain: str, as_of: str) -> DataFrame:
    """Ingest and load times (seconds) and counts: `recent` (hours of the last day),
    `daily` (14 days) or `hourly` (7 days). The share is NULL without records."""
    today = F.to_date(timeops.instant(as_of))
    entered = F.col("init_datetime")
    period, keep = {
        "recent": (F.date_trunc("hour", entered), entered > _since(as_of, 86400)),
        "daily": (F.to_date(entered), F.to_date(entered) >= F.date_sub(today, 14)),
        "hourly": (F.date_trunc("hour", entered), F.to_date(entered) >= F.date_sub(today, 7)),
    }[grain]
    ingest = timeops.seconds_between("completed_datetime", "init_datetime")
    load = timeops.seconds_between("completed_datetime", "loaded_datetime")
    out = [
        F.min(ingest).alias("ingest_time_min"), F.max(ingest).alias("ingest_time_max"), F.avg(ingest).alias("ingest_time_avg"),
        F.min(load).alias("load_time_min"), F.max(load).alias("load_time_max"), F.avg(load).alias("load_time_avg"),
        F.count("*").alias("files_added"),
        F.count_if(F.col("completed_datetime").isNull()).alias("files_pending"),
        F.round(F.avg("jobs")).alias("jobs_avg"),
        F.count_if("has_error").alias("errors"),
        F.sum("records").alias("records"),
        F.sum("inserted").alias("inserted"),
    ]
    if grain != "recent":
        out += [
            F.sum("file_size").alias("total_size"),
            F.round(F.avg("file_size")).alias("avg_size"),
            F.round(F.try_divide(F.sum("inserted"), F.sum("records")) * 100, 1).alias("pct"),
        ]
    return logs.where(keep).groupBy(period.alias("added_on")).agg(*out).orderBy(F.desc("added_on"))


def fetchlogs_recent_issues(logs: DataFrame, as_of: str) -> DataFrame:
    """Files of the last day with errors, retries or over an hour of ingest."""
    ingest = timeops.seconds_between("completed_datetime", "init_datetime")
    rows = logs.where(
        (F.col("completed_datetime") > _since(as_of, 86400))
        & ~textops.imatch(F.col("key"), "station")
        & (F.col("has_error") | (F.col("jobs") > 1) | (ingest > 3600))
    )
    return rows.select(
        "fetchlogs_id", "init_datetime", "key", "jobs",
        timeops.seconds_between("last_modified", "init_datetime").alias("modified_time"),
        ingest.alias("ingest_time"),
        timeops.seconds_between("completed_datetime", "loaded_datetime").alias("loaded_time"),
        "has_error",
        (ingest / 3600).alias("hours_ago"),
    )


def records_inserted(logs: DataFrame, unit: str = "hour", since: str | None = None, pattern: str = "realtime") -> DataFrame:
    rows = logs.where(textops.imatch(F.col("key"), pattern))
    if since is not None:
        rows = rows.where(F.col("init_datetime") > timeops.instant(since))
    totals = rows.groupBy(F.date_trunc(unit, "init_datetime").alias("datetime")).agg(
        F.sum("inserted").alias("inserted"), F.sum("records").alias("records"), F.count("*").alias("files"),
        F.min("inserted").alias("min"), F.max("inserted").alias("max"),
    )
    share = F.when(F.col("records") > 0, F.round(F.try_divide(F.col("inserted"), F.col("records")) * 100)).otherwise(0.0)
    return totals.select(
        "datetime", F.lit(unit).alias("period"), F.lit(pattern).alias("pattern"), "inserted", "records",
        share.alias("percentage"), "files", "min", "max",
    ).orderBy("datetime")


def fetcher_source_summary(responses: DataFrame, start: str, end: str) -> DataFrame:
    """Records per response and source: success share, percentiles, skew.

    One source may hold most responses, so percentiles use the group-splitting form.
    """
    rows = responses.where((F.col("datetime") > timeops.instant(start)) & (F.col("datetime") < timeops.instant(end)))
    plain = rows.groupBy("source_name").agg(
        F.count("*").alias("n"), F.count_if(F.col("records") == 0).alias("zeros"), F.min("records").alias("min"),
        F.avg("records").alias("_avg"), F.stddev("records").alias("_sd"), F.max("records").alias("max"),
    )
    levels = numeric.exact_percentiles(
        rows, ["source_name"], "records", {"_p02": 0.02, "_p25": 0.25, "_p50": 0.5, "_p75": 0.75, "_p98": 0.98}
    )
    success = F.when(F.col("zeros") == 0, 100.0).otherwise(F.round((1 - F.col("zeros") / F.col("n")) * 100, 1))
    skew = F.when(F.col("_sd") > 0, F.round(3 * (F.col("_avg") - F.col("_p50")) / F.col("_sd"), 2)).otherwise(0.0)
    tenth = lambda c: F.round(f"_{c}", 1).alias(c)
    return plain.join(levels, "source_name", "left").select(
        "source_name", "n", "zeros", success.alias("pct_success"), "min", tenth("p02"), tenth("p25"), tenth("p50"),
        tenth("avg"), tenth("sd"), tenth("p75"), tenth("p98"), "max", skew.alias("skew"),
    )


def keep_since(rows: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows at or after a cutoff: the retention of fetcher responses and daily counters."""
    kind = rows.schema[column].dataType
    return rows.where(F.col(column) >= F.lit(cutoff).cast(kind))


def measurements_per_hour(check: DataFrame, duration_s: int = 86400, pattern: str | None = None, as_of: str | None = None) -> DataFrame:
    """Expected against observed hourly rate of sensors active within the duration.
    `check` is the node and sensor audit of the catalog."""
    rows = check.where(F.col("datetime_last") > _since(as_of, duration_s))
    if pattern is not None:
        rows = rows.where(textops.imatch(F.col("parameter"), pattern))
    rate = F.try_divide(F.lit(3600.0), F.col("data_logging_period_seconds"))
    nodes = rows.groupBy("sensor_nodes_id").agg(
        F.count("sensors_id").alias("s"), F.sum(rate).alias("e"), F.sum(rate * (F.col("percent_complete") / 100)).alias("o")
    )
    return nodes.agg(
        F.count("*").alias("sensor_nodes_count"), F.coalesce(F.sum("s"), F.lit(0)).alias("sensors_count"),
        F.round(F.sum("e")).alias("measurements_per_hour_expected"), F.round(F.sum("o")).alias("measurements_per_hour_observed"),
    )


def ingest_backlog(logs: DataFrame, as_of: str) -> DataFrame:
    """Unfinished files: all, loaded, loaded within 15 minutes, failed, age of the oldest."""
    minutes = F.round(timeops.seconds_between(timeops.instant(as_of), "init_datetime") / 60)
    return logs.where(F.col("completed_datetime").isNull()).agg(
        F.count("*").alias("total_count"),
        F.count_if(F.col("loaded_datetime").isNotNull()).alias("loaded_count"),
        F.count_if(F.col("loaded_datetime") > _since(as_of, 900)).alias("pending_count"),
        F.count_if("has_error").alias("failed_count"),
        F.max(minutes).alias("oldest_minutes"),
    )


def ingest_rates(stats: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows per millisecond and average times per ingest, of the last five minutes."""
    rows = stats if as_of is None else stats.where(F.col("ingested_on") > _since(as_of, 300))
    rate = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return rows.select(
        "*",
        rate("latest_measurements_inserted", "latest_insert_time_ms").alias("latest_rows_per_ms"),
        rate("total_measurements_inserted", "total_insert_time_ms").alias("total_rows_per_ms"),
        rate("total_process_time_ms", "ingest_count").alias("average_process_time"),
        rate("total_insert_time_ms", "ingest_count").alias("average_insert_time"),
        rate("total_cache_time_ms", "ingest_count").alias("average_cache_time"),
    )


# ---- jobs ------------------------------------------------------------------------------------------


def stuck_jobs(logs: DataFrame, as_of: str) -> DataFrame:
    """Queued over an hour ago and never loaded, oldest first."""
    rows = logs.where((F.col("queued_datetime") < _since(as_of, 3600)) & F.col("loaded_datetime").isNull())
    return rows.select(
        "fetchlogs_id", "key", "scheduled_datetime", "queued_datetime",
        timeops.seconds_between(timeops.instant(as_of), "queued_datetime").alias("stuck_duration"),
    ).orderBy("queued_datetime")


def deployment_health(deployments: DataFrame, handlers: DataFrame, logs: DataFrame, deployment_adapters: DataFrame, as_of: str) -> DataFrame:
    """Age of the last run, and runs of the last day, per deployment. One pass over the log."""
    recent = logs.where(F.col("scheduled_datetime") > _since(as_of, 86400)).groupBy("deployments_id").agg(
        F.count("*").alias("runs_last_24h"),
        F.count("completed_datetime").alias("completed_last_24h"),
        F.count_if("has_error").alias("errors_last_24h"),
    )
    adapters = deployment_adapters.groupBy("deployments_id").agg(F.count("*").alias("adapters_count"))
    counts = ["runs_last_24h", "completed_last_24h", "errors_last_24h", "adapters_count"]
    return (
        deployments.join(handlers, "handlers_id").join(recent, "deployments_id", "left").join(adapters, "deployments_id", "left")
        .select(
            "deployments_id", "label", "schedule", "is_active", "last_deployed_datetime", "temporal_offset", "queue_name",
            timeops.seconds_between(timeops.instant(as_of), "last_deployed_datetime").alias("time_since_last_run"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        )
        .orderBy(F.desc("is_active"), F.desc_nulls_last("last_deployed_datetime"))
    )


def job_summary(runs: DataFrame, jobs: DataFrame, lookback_s: int, as_of: str) -> DataFrame:
    """Duration (seconds), runs and failures per job. `runs`: jobid, start_time, end_time, status."""
    duration = timeops.seconds_between("end_time", "start_time")
    rows = runs.where(F.col("start_time") > _since(as_of, lookback_s)).join(jobs, "jobid")
    return rows.groupBy("jobid", "jobname", "active").agg(
        F.min(duration).alias("min_duration"), F.max(duration).alias("max_duration"), F.avg(duration).alias("avg_duration"),
        F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("failed"),
    ).orderBy("jobid", F.desc("jobname"))


def process_durations(log: DataFrame) -> DataFrame:
    return log.select(
        "process_name", "start_datetime", "end_datetime", timeops.seconds_between("end_datetime", "start_datetime").alias("process_time")
    )


def timing_summary(timings: DataFrame) -> DataFrame:
    """`timings`: n (rows of a run), elapsed."""
    plain = timings.agg(
        F.avg("n").alias("n"), F.stddev("n").alias("n_sd"), F.corr(F.col("n").cast("double"), F.col("elapsed")).alias("r"),
        F.avg("elapsed").alias("avg"), F.stddev("elapsed").alias("sd"), F.min("elapsed").alias("min"), F.max("elapsed").alias("max"),
    )
    levels = numeric.exact_percentiles(timings, [], "elapsed", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    quarters = levels.select(F.struct(*levels.columns)).scalar()
    return plain.select("*", quarters.alias("_q")).select(*plain.columns, "_q.*")


# ---- request log -------------------------------------------------------------------------------------


def compare_timing(logs: DataFrame, cutoff: str, window_s: int | None = None, min_hits: int = 1000, as_of: str | None = None) -> DataFrame:
    """Requests per endpoint before and after a change, in one pass; only endpoints with
    more than `min_hits` on both sides. Timing is in milliseconds."""
    at = timeops.instant(cutoff)
    width = F.lit(window_s) if window_s is not None else F.unix_seconds(timeops.instant(as_of)) - F.unix_seconds(at)
    before = (F.col("added_on") < at) & (F.col("added_on") > timeops.shift(at, -width))
    after = (F.col("added_on") > at) & (F.col("added_on") < timeops.shift(at, width))
    timing = F.col("timing").cast("double")
    rows = logs.groupBy("endpoint").agg(
        F.count_if(before).alias("before_hits"), F.count_if(after).alias("after_hits"),
        F.avg(F.when(before, timing)).alias("b"), F.avg(F.when(after, timing)).alias("a"),
        F.sum(F.when(before, timing / 3_600_000)).alias("bh"), F.sum(F.when(after, timing / 3_600_000)).alias("ah"),
    ).where((F.col("before_hits") > min_hits) & (F.col("after_hits") > min_hits))
    gap = F.col("a") - F.col("b")
    return rows.select(
        "endpoint", "before_hits", "after_hits",
        F.round("b").cast("int").alias("before_timing"), F.round("a").cast("int").alias("after_timing"),
        F.round(gap).cast("int").alias("diff_timing"), F.round("bh", 1).alias("before_hours"), F.round("ah", 1).alias("after_hours"),
        F.round(gap * F.col("after_hits") / 3_600_000, 1).alias("diff_hours"),
        F.round(F.try_divide(gap, F.col("b")) * 100, 1).alias("diff_percent"),
    ).orderBy("diff_timing")


def first_pattern(texts: DataFrame, patterns: DataFrame, text: str, id_col: str, pattern: str = "pattern", block: int = 200) -> DataFrame:
    """Texts with the lowest id whose regular expression matches, NULL when none does.

    Patterns are dealt to blocks of about `block`; every text visits every block by an
    equi-join and only its best match leaves. Works for lists too long to broadcast.
    """
    count = patterns.agg(F.greatest(F.ceil(F.count("*") / block), F.lit(1)).cast("int")).scalar()
    dealt = patterns.withColumn("_b", F.pmod(F.xxhash64(id_col), count).cast("int"))
    blocks = dealt.groupBy("_b").agg(F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("id"), F.col(pattern).alias("p")))).alias("_ps"))
    visits = texts.withColumn("_b", F.explode(F.sequence(F.lit(0), count - 1)))
    hits = F.filter("_ps", lambda q: F.rlike(F.col(text), q["p"]))
    tried = visits.join(blocks, "_b", "left").select(*texts.columns, F.get(hits, F.lit(0))["id"].alias(id_col))
    return tried.groupBy(*texts.columns).agg(F.min(id_col).alias(id_col))


def uncategorized_requests(logs: DataFrame, agents: DataFrame) -> DataFrame:
    """Agents no pattern matches. Agents collapse to one row each before any matching."""
    pairs = logs.groupBy("agent", "api_key").agg(
        F.count("*").alias("n"), _exact_sum("timing").alias("time"), F.min("added_on").alias("a"), F.max("added_on").alias("b")
    )
    per_agent = pairs.groupBy("agent").agg(
        F.sum("n").alias("n"), _whole(F.sum("time")).alias("time"), F.min("a").alias("first_requested"),
        F.max("b").alias("last_requested"), F.count("api_key").alias("keys"),
    )
    named = first_pattern(per_agent.select("agent"), agents, "agent", "agents_id")
    return per_agent.join(named.where(F.col("agents_id").isNull()).select("agent"), "agent", "left_semi")


def daily_requests(logs: DataFrame, kind: str, process_date: str | None = None, lookup: DataFrame | None = None) -> DataFrame:
    """Requests and time per day and kind: total, agent, status, resource, user, sensor, node.

    One UTC day with `process_date`, else all days. `lookup` is the agent patterns, the
    user keys (token, users_id), or for nodes sensors_id and sensor_nodes_id.
    """
    rows = logs
    if process_date is not None:
        start = timeops.instant(process_date)
        rows = rows.where((F.col("added_on") >= start) & (F.col("added_on") < timeops.shift(start, 86400)))
    rows = rows.withColumn("day", F.to_date("added_on"))
    totals = (F.count("*").alias("requests_count"), _whole(_exact_sum("timing")).alias("requests_time"))
    again = (F.sum("n").alias("requests_count"), _whole(F.sum("t")).alias("requests_time"))
    small = (F.count("*").alias("n"), _exact_sum("timing").alias("t"))
    sensor = textops.json_number(F.col("params"), "sensors_id")
    node = textops.json_number(F.col("params"), "locations_id")
    if kind == "total":
        return rows.groupBy("day").agg(*totals)
    if kind in ("status", "resource"):
        return rows.groupBy("day", {"status": F.col("status_code"), "resource": F.col("endpoint").alias("resource")}[kind]).agg(*totals)
    if kind == "agent":
        per_agent = rows.groupBy("day", "agent").agg(*small)
        named = first_pattern(per_agent.select("agent").distinct(), lookup, "agent", "agents_id")
        return per_agent.join(named.where(F.col("agents_id").isNotNull()), "agent").groupBy("day", "agents_id").agg(*again)
    if kind == "user":
        keyed = rows.groupBy("day", "api_key").agg(*small)
        return keyed.join(lookup.select(F.col("token").alias("api_key"), "users_id"), "api_key").groupBy("day", "users_id").agg(*again)
    if kind == "sensor":
        return rows.withColumn("sensors_id", sensor).where(F.col("sensors_id").isNotNull()).groupBy("day", "sensors_id").agg(*totals)
    if kind == "node":
        # requests that name only a location count too
        asked = rows.select("day", "timing", sensor.alias("sensors_id"), node.alias("_node")).where(
            F.col("sensors_id").isNotNull() | F.col("_node").isNotNull()
        )
        small_rows = asked.groupBy("day", "sensors_id", "_node").agg(*small)
        placed = small_rows.join(lookup.select("sensors_id", "sensor_nodes_id"), "sensors_id", "left").withColumn(
            "sensor_nodes_id", F.coalesce("_node", "sensor_nodes_id")
        )
        return placed.where(F.col("sensor_nodes_id").isNotNull()).groupBy("day", "sensor_nodes_id").agg(*again)
    raise ValueError(f"unknown kind {kind}")


#: Kinds of daily request counts and the column that tells their rows apart.
REQUEST_KEYS = {
    "total": None, "agent": "agents_id", "status": "status_code", "resource": "resource", "user": "users_id",
    "sensor": "sensors_id", "node": "sensor_nodes_id",
}


def process_daily_logs(
    logs: DataFrame, process_date: str, agents: DataFrame, user_keys: DataFrame, stations: DataFrame, drop_processed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(counts of one day in all kinds: kind, key, day, requests_count, requests_time; the log).

    With `drop_processed` the log returned lacks the rows of that day.
    """
    lookups = {"agent": agents, "user": user_keys, "node": stations}
    out = None
    for kind, key in REQUEST_KEYS.items():
        counts = daily_requests(logs, kind, process_date, lookups.get(kind))
        rows = counts.select(
            F.lit(kind).alias("kind"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"), "day", "requests_count", "requests_time"
        )
        out = rows if out is None else out.unionByName(rows)
    start = timeops.instant(process_date)
    of_day = (F.col("added_on") >= start) & (F.col("added_on") < timeops.shift(start, 86400))
    return out, logs.where(~F.coalesce(of_day, F.lit(False))) if drop_processed else logs


# ---- audits ------------------------------------------------------------------------------------------


def table_counts_audit(tables: Mapping[str, DataFrame], minimums: Mapping[str, int]) -> DataFrame:
    """Row count of each table against its minimum."""
    out = None
    for name, table in tables.items():
        row = table.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(minimums[name]).cast("bigint").alias("minimum")
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("enough", F.col("rows") >= F.col("minimum"))


def node_countries_audit(nodes: DataFrame, countries: DataFrame, expected: DataFrame) -> DataFrame:
    """Country of nodes against the one expected (`expected`: sensor_nodes_id, iso)."""
    placed = nodes.join(countries.select("countries_id", F.col("iso").alias("found")), "countries_id")
    told = expected.withColumnRenamed("iso", "expected").join(placed.select("sensor_nodes_id", "found"), "sensor_nodes_id", "left")
    return told.select(
        "sensor_nodes_id", "expected", "found", F.coalesce(F.col("found") == F.col("expected"), F.lit(False)).alias("as_expected")
    )


def canary_days(measurements: DataFrame, sites: DataFrame, mode: str) -> DataFrame:
    """Daily averages per site, meant for a calendar series (value = local day of month).

    `sites`: sensors_id, site_name, tzid. utc and local group by that day; a local day's
    average must equal its day number. compare shows the stamps side by side.
    """
    rows = measurements.select("sensors_id", "datetime", "value").join(sites, "sensors_id")
    offset = timeops.offset_seconds("datetime", F.col("tzid"))
    if mode == "compare":
        return rows.select(
            "site_name", "datetime", timeops.local_time("datetime", F.col("tzid")).alias("local_datetime_zone"),
            timeops.shift("datetime", offset).alias("local_datetime_interval"), "value", offset.alias("utc_offset"),
        )
    at = timeops.shift("datetime", -1) if mode == "utc" else timeops.shift("datetime", offset - 1)
    return rows.withColumn("_at", at).groupBy("site_name", F.to_date("_at").alias("day")).agg(
        F.min("_at").alias("first_datetime"), F.max("_at").alias("last_datetime"), F.count("value").alias("value_count"),
        F.avg("value").alias("value_avg"),
    )
