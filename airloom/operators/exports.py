"""Export rows and the bookkeeping of what was exported when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions import timeops
from airloom.functions.joins import never_broadcast
from airloom.operators.context import broadcast_if_few, literal_zones, zone_branches
from airloom.operators.intervals import max_in_ranges, overlap_marks
from airloom.operators.upsert import upsert
from airloom.session import cut_lineage

KEYS = ["sensor_nodes_id", "day"]


def measurement_data_export(
    measurements: DataFrame,
    sensors: DataFrame,
    sensor_systems: DataFrame,
    sensor_nodes: DataFrame,
    timezones: DataFrame,
    measurands: DataFrame,
    providers: DataFrame,
) -> DataFrame:
    """The row written to export files, one per measurement of a known provider."""
    nodes = (
        sensor_nodes.select(
            "sensor_nodes_id", "site_name", "ismobile", "country", "timezones_id", "source_name",
            F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat"),
        )
        .join(timezones.select("timezones_id", F.col("tzid").alias("tz")), "timezones_id")
        .join(providers.select("source_name", F.col("export_prefix").alias("provider")), "source_name")
    )
    stations = (
        sensors.select("sensors_id", "sensor_systems_id", "measurands_id", F.col("source_id").alias("sensor"))
        .join(measurands.select("measurands_id", "measurand", "units"), "measurands_id")
        .join(never_broadcast(sensor_systems.select("sensor_systems_id", "sensor_nodes_id")), "sensor_systems_id")
        .join(never_broadcast(nodes), "sensor_nodes_id")
    )
    mobile = F.col("ismobile")
    facts = measurements.select("sensors_id", "datetime", "value", "lon", "lat")
    return facts.join(broadcast_if_few(stations, sensors), "sensors_id").select(
        "sensors_id",
        "sensor_nodes_id",
        F.concat("site_name", F.lit("-"), F.col("sensor_systems_id").cast("string")).alias("location"),
        "measurands_id",
        F.when(mobile, "mobile").otherwise(F.coalesce(F.lower("country"), F.lit("no-country"))).alias("country"),
        "ismobile",
        "sensor",
        "datetime",
        "tz",
        zone_branches(literal_zones(timezones, sensor_nodes), lambda z: timeops.iso_local("datetime", z), "tz").alias(
            "datetime_str"
        ),
        "measurand",
        "units",
        "value",
        F.when(mobile, F.col("lon")).otherwise(F.col("node_lon")).alias("lon"),
        F.when(mobile, F.col("lat")).otherwise(F.col("node_lat")).alias("lat"),
        "provider",
    )


def open_data_rows(measurements: DataFrame, ctx: DataFrame, sensor_nodes_id: int, day: str) -> DataFrame:
    """Raw rows of one node and one UTC day, time-ending."""
    start = timeops.instant(day)
    rows = measurements.where((F.col("datetime") > start) & (F.col("datetime") <= timeops.shift(start, 86400)))
    chosen = ctx.where(F.col("sensor_nodes_id") == sensor_nodes_id).select("sensors_id", "sensor_nodes_id", "measurands_id")
    return rows.join(chosen, "sensors_id")


def has_measurement(measurements: DataFrame, keys: DataFrame, kind: str) -> DataFrame:
    """Keys with `found`: any row at an `instant` (datetime), in an `hour` (datetime,
    offset_s), on a `day` (day, UTC, time-ending), or of a `sensor` (sensors_id).

    The keys' own range bounds the scan, facts of other keys go by a semi-join, and the rest
    reduce to distinct keys, so busy keys cost nothing extra.
    """
    if kind == "instant":
        asked, at, on = keys.withColumn("_k", F.col("datetime")), F.col("datetime"), ["_k"]
        facts = _between(measurements, at, asked).select(at.alias("_k"))
    elif kind == "hour":
        asked, on = keys.withColumn("_k", timeops.hour_end("datetime", F.col("offset_s"))), ["_k", "offset_s"]
        offsets = keys.agg(F.collect_set("offset_s")).scalar()  # bounded: offsets in use
        stamps = _between(measurements, F.col("datetime"), asked, before_s=3600).select("datetime").distinct()
        stamps = stamps.select("datetime", F.explode(offsets).alias("offset_s"))
        facts = stamps.select(timeops.hour_end("datetime", F.col("offset_s")).alias("_k"), "offset_s")
    elif kind == "day":
        asked, on = keys.withColumn("_k", F.col("day")), ["_k"]
        times = asked.select(F.col("_k").cast("timestamp").alias("_k"))
        near = _between(measurements, F.col("datetime"), times, after_s=86400)
        facts = near.select(timeops.utc_date("datetime").alias("_k"))
    elif kind == "sensor":
        asked, at, on = keys.withColumn("_k", F.col("sensors_id")), F.col("sensors_id"), ["_k"]
        facts = _between(measurements, at, asked).select(at.alias("_k"))
    else:
        raise ValueError(f"unknown kind {kind}")
    wanted = broadcast_if_few(asked.select(*on).distinct(), asked)
    found = facts.join(wanted, on, "left_semi").distinct().withColumn("found", F.lit(True))
    return asked.join(found, on, "left").select(*keys.columns, F.coalesce("found", F.lit(False)).alias("found"))


def _between(facts: DataFrame, at: Column, asked: DataFrame, before_s: int = 0, after_s: int = 0) -> DataFrame:
    """Facts from the first `_k` asked for to the last, as a predicate for the scan."""
    low, high = asked.agg(F.min("_k").alias("_k")), asked.agg(F.max("_k").alias("_k"))
    if before_s or after_s:
        low = low.select(timeops.shift("_k", -before_s).alias("_k"))
        high = high.select(timeops.shift("_k", after_s).alias("_k"))
    return facts.where((at >= low.scalar()) & (at <= high.scalar()))


def latest_measurement_added(measurements: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges (datetime_first, datetime_last] with the last arrival time of their rows."""
    return max_in_ranges(
        measurements, ranges, at="datetime", value="added_on", low="datetime_first", high="datetime_last", name="updated_on"
    )


def export_day_counts(export_rows: DataFrame) -> DataFrame:
    """Records and distinct measurands per node and UTC day."""
    per_measurand = export_rows.groupBy(
        "sensor_nodes_id", timeops.utc_date("datetime").alias("day"), "measurands_id"
    ).agg(F.count("value").alias("n"))
    return per_measurand.groupBy(*KEYS).agg(F.sum("n").alias("records"), F.count("*").alias("measurands"))


def reset_export_logs(export_rows: DataFrame, existing: DataFrame | None = None, as_of: str | None = None):
    """(updated log, summary per node). Rows already logged keep their counts, become
    modified at `as_of` and lose their queued and exported times; new ones begin at `as_of`."""
    counts = export_day_counts(export_rows)
    if existing is None:
        kept, returned = counts, counts
    else:
        null = F.lit(None).cast("timestamp")
        kept = upsert(
            existing, counts, KEYS,
            merge={
                "records": "keep", "measurands": "keep", "modified_on": timeops.instant(as_of),
                "exported_on": null, "queued_on": null,
            },
            insert={c: timeops.instant(as_of) for c in ("added_on", "modified_on") if c in existing.columns},
        )
        returned = kept.join(counts.select(*KEYS), KEYS, "left_semi")
    summary = returned.groupBy("sensor_nodes_id").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("day").alias("days"),
        F.sum("records").alias("records"), F.max("measurands").alias("measurands"),
    )
    return kept, summary


def modified_location_days(logs: DataFrame, zones: DataFrame, as_of: str) -> DataFrame:
    """Log rows changed since queued, with the seconds since the end of the day by the
    node's clock (`zones`: sensor_nodes_id, tzid; a NULL zone leaves them NULL)."""
    rows = logs.where(F.col("queued_on").isNull() | (F.col("modified_on") > F.col("queued_on")))
    local_now = timeops.local_time(timeops.instant(as_of), F.col("tzid"))
    wait = F.unix_seconds(F.date_add("day", 1).cast("timestamp")) - F.unix_seconds(local_now)
    return rows.join(zones.select("sensor_nodes_id", "tzid"), "sensor_nodes_id").select(
        *KEYS, "records", "measurands", "modified_on", wait.alias("wait_seconds")
    )


def _conditions(as_of: str, wait_hours: int, requeue_s: int) -> dict[str, Column]:
    now = timeops.instant(as_of)
    settled = F.to_date(timeops.shift(timeops.local_time(now, F.col("tzid")), -wait_hours * 3600))
    return {
        "old_enough": F.col("day") < settled,
        "needs_exporting": F.col("exported_on").isNull() | (F.col("modified_on") > F.col("exported_on")),
        "not_queued": F.col("queued_on").isNull() | (F.col("queued_on") < timeops.shift(now, -requeue_s)),
        "error_free": F.col("has_error").isNull() | ~F.col("has_error"),
    }


def pending_location_days(
    logs: DataFrame, zones: DataFrame, as_of: str, wait_hours: int = 72, requeue_s: int = 3600, limit: int | None = None
) -> DataFrame:
    """Node-days ready to export, with the zone's offset at `as_of`."""
    rows = logs.join(zones.select("sensor_nodes_id", "tzid"), "sensor_nodes_id")
    for test in _conditions(as_of, wait_hours, requeue_s).values():
        rows = rows.where(test)
    out = rows.select(
        *KEYS, "records", "measurands", "modified_on", "queued_on", "exported_on",
        timeops.offset_seconds(timeops.instant(as_of), F.col("tzid")).alias("utc_offset"),
    )
    return out if limit is None else out.orderBy("day", "sensor_nodes_id").limit(limit)


def pending_location_days_check(logs: DataFrame, zones: DataFrame, as_of: str, wait_hours: int = 72, requeue_s: int = 3600) -> DataFrame:
    tests = _conditions(as_of, wait_hours, requeue_s)
    rows = logs.join(zones.select("sensor_nodes_id", "tzid"), "sensor_nodes_id")
    return rows.groupBy(*[test.alias(name) for name, test in tests.items()]).agg(F.count("*").alias("n"))


def outdated_location_days(
    logs: DataFrame, zones: DataFrame, version: int = 0, limit: int = 100, as_of: str | None = None
) -> DataFrame:
    """Past node-days never exported, queued again since, or written by an older format."""
    now = timeops.instant(as_of)
    written = F.get_json_object("metadata", "$.version")
    rows = logs.where(
        (F.col("day") < F.to_date(now))
        & (F.col("queued_on").isNull() | (F.col("queued_on") < timeops.shift(now, -4 * 3600)))
        & F.get_json_object("metadata", "$.error").isNull()
        & (
            F.col("exported_on").isNull()
            | (F.col("queued_on") > F.col("exported_on"))
            | written.isNull()
            | (written.try_cast("int") < version)
        )
    ).join(zones.select("sensor_nodes_id", "tzid"), "sensor_nodes_id")
    return rows.select(
        *KEYS, "records", "measurands", "modified_on", "queued_on", "exported_on",
        timeops.offset_seconds(now, F.col("tzid")).alias("utc_offset"), "metadata",
    ).orderBy("day", "sensor_nodes_id").limit(limit)


def take_outdated(
    logs: DataFrame, zones: DataFrame, version: int = 0, limit: int = 100, as_of: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(outdated node-days handed out, the log with them marked as queued)."""
    rows = cut_lineage(outdated_location_days(logs, zones, version, limit, as_of))
    return rows, mark_pending(logs, rows, as_of)


def mark_pending(logs: DataFrame, pending: DataFrame, as_of: str) -> DataFrame:
    return upsert(logs, pending.select(*KEYS), KEYS, merge={"queued_on": timeops.instant(as_of)})


def mark_exported(logs: DataFrame, exported: DataFrame, as_of: str) -> DataFrame:
    """`exported`: sensor_nodes_id, day, records."""
    return upsert(
        logs, exported.select(*KEYS, "records").join(logs.select(*KEYS), KEYS, "left_semi"), KEYS,
        merge={"exported_on": timeops.instant(as_of), "metadata": F.lit("{}")},
    )


def mark_modified_day(logs: DataFrame, days: DataFrame, as_of: str) -> DataFrame:
    known = days.select(*KEYS).distinct().join(logs.select(*KEYS), KEYS, "left_semi")
    return upsert(logs, known, KEYS, merge={"modified_on": timeops.instant(as_of)})


def export_stats(logs: DataFrame, interval_s: int, as_of: str) -> DataFrame:
    since = timeops.shift(timeops.instant(as_of), -interval_s)
    return logs.agg(
        F.count_if((F.col("modified_on") > F.col("added_on")) & (F.col("modified_on") > since)).alias("days_modified"),
        F.count_if(F.col("added_on") > since).alias("days_added"),
        F.count_if(F.col("exported_on") > since).alias("days_exported"),
        F.count_if(F.col("exported_on").isNull() & ~F.col("has_error")).alias("days_pending"),
    )


def open_data_export_status(logs: DataFrame) -> DataFrame:
    """Counts and ranges by state. The reference cuts the message before character 30."""
    return logs.groupBy(
        F.col("exported_on").isNotNull().alias("exported"),
        F.col("checked_on").isNotNull().alias("checked"),
        "has_error",
        F.col("queued_on").isNotNull().alias("queued"),
        F.substring(F.get_json_object("metadata", "$.message"), 1, 29).alias("message"),
    ).agg(
        F.count("*").alias("n"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.min("exported_on").alias("first_exported"),
        F.max("exported_on").alias("last_exported"),
        F.min("checked_on").alias("first_checked"),
        F.max("checked_on").alias("last_checked"),
    )


def exports_per_day(logs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per export date of the last days: count, first, median and last data day, first and last export."""
    since = F.date_sub(F.to_date(timeops.instant(as_of)), days)
    rows = logs.where(F.col("exported_on") > since).groupBy(F.to_date("exported_on").alias("exported_day"), "day").agg(
        F.count("*").alias("_n"), F.min("exported_on").alias("_first"), F.max("exported_on").alias("_last")
    )
    # at most a row for each pair of days is left, so the median walks over counts
    order = Window.partitionBy("exported_day").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy("exported_day")))
    number = F.unix_date("day")
    low = F.min(F.when(F.col("_upto") >= F.floor((F.col("_all") + 1) / 2), number))
    high = F.min(F.when(F.col("_upto") >= F.floor((F.col("_all") + 2) / 2), number))
    return rows.groupBy("exported_day").agg(
        F.sum("_n").alias("n"), F.min("day").alias("first_day"),
        F.date_from_unix_date(F.floor((low + high) / 2).cast("int")).alias("median_date"), F.max("day").alias("last_day"),
        F.min("_first").alias("first_exported"), F.max("_last").alias("last_exported"),
    )


def fill_ranges(logged: DataFrame, start: str, end: str, step_s: int) -> DataFrame:
    """Fixed ranges from start to end (inclusive first stamps) that overlap no logged range.

    `logged`: datetime_first, datetime_last, half-open.
    """
    spark = logged.sparkSession
    steps = F.sequence(timeops.instant(start), timeops.instant(end), F.make_dt_interval(secs=F.lit(step_s)))
    ranges = spark.range(1).select(F.explode(steps).alias("datetime_first"))
    # a closed window one microsecond short of the half-open end asks the same question
    asked = ranges.withColumn("datetime_last", timeops.shift("datetime_first", step_s)).withColumn(
        "_to", F.timestamp_micros(F.unix_micros("datetime_last") - 1)
    )
    marked = overlap_marks(asked, logged, [], low="datetime_first", high="_to", start="datetime_first", end="datetime_last")
    return marked.where(~F.col("overlaps")).select("datetime_first", "datetime_last")


def stale_ranges(logged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranges updated after their export, ranges kept)."""
    stale = F.coalesce(F.col("updated_on") > F.col("exported_on"), F.lit(False))
    return logged.where(stale), logged.where(~stale)


def remap_export_logs(logs: DataFrame, node_map: DataFrame) -> DataFrame:
    """Log rows under canonical nodes, the JSON fields as columns."""
    field = lambda name: F.get_json_object("metadata", f"$.{name}")
    renamed = node_map.select(F.col("sensor_nodes_id").alias("_new"), "old_sensor_nodes_id")
    rows = logs.withColumnRenamed("sensor_nodes_id", "old_sensor_nodes_id").join(renamed, "old_sensor_nodes_id")
    return rows.select(
        F.col("_new").alias("sensor_nodes_id"), "day", "records", "measurands", "modified_on", "queued_on", "exported_on",
        field("Key").alias("key"), field("Bucket").alias("bucket"), field("sec").try_cast("double").alias("sec"),
        field("error").alias("error"), field("version").try_cast("int").alias("version"), "old_sensor_nodes_id",
    )


def import_time_stats(logged: DataFrame) -> DataFrame:
    """`logged`: imported_on, import_time."""
    return logged.where(F.col("imported_on").isNotNull()).agg(
        F.count("*").alias("n"), F.min("import_time").alias("min"), F.avg("import_time").alias("avg"),
        F.max("import_time").alias("max"),
    )


def lookup_by_name(requests: DataFrame, names: DataFrame, column: str, label: str, id_col: str) -> DataFrame:
    """Requests with the id whose label equals their text in any case, the lowest of several."""
    known = names.groupBy(F.lower(label).alias("_k")).agg(F.min(id_col).alias(id_col))
    return requests.join(known, F.lower(F.col(column)) == F.col("_k"), "left").drop("_k")
