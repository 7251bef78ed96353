"""Hour, day, year and lifetime rollups in each station's local time.

Shuffle plan of the hourly rollup: facts meet the station context once (a broadcast
when it is small, else a join adaptive execution can split on a hot sensor), then
group by sensor and hour, so one busy sensor spreads over its hours. Day and year
rows come from hourly rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions import numeric, timeops
from airloom.functions.joins import never_broadcast
from airloom.operators.context import by_zone, join_context

# Percentile levels and their column names.
PERCENTILES = {"value_p02": 0.02, "value_p25": 0.25, "value_p50": 0.5, "value_p75": 0.75, "value_p98": 0.98}


def _weighted(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with their share in each percentile of their group.

    An interpolated percentile lies between two ranks: the row of rank r has the weight
    max(0, 1 - |position - r|), so each percentile is a sum. The sorted window spills
    when a group is long and no list of values is built; computing the shares ahead of
    the grouping keeps the generated aggregation small.
    """
    group = Window.partitionBy(*keys)
    ranked = rows.withColumn(
        "_rank", F.row_number().over(group.orderBy(F.col(value).asc_nulls_last())) - 1
    ).withColumn("_values", F.count(value).over(group))

    def share(p: float) -> Column:
        weight = 1 - F.abs(F.lit(p) * (F.col("_values") - 1) - F.col("_rank"))
        return F.when(weight > 0, F.col(value) * weight)

    return ranked.withColumns({f"_{name}": share(p) for name, p in PERCENTILES.items()})


def _summary(value: str) -> list[Column]:
    """Aggregates over `_weighted` rows."""
    return [
        F.count("*").alias("value_count"),
        F.avg(value).alias("value_avg"),
        F.stddev(value).alias("value_sd"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        *[F.sum(f"_{name}").alias(name) for name in PERCENTILES],
    ]


def with_hour(facts: DataFrame, ctx: DataFrame) -> DataFrame:
    """Facts of known sensors with their zone and the UTC end of their local hour."""
    rows = join_context(facts, ctx, "measurands_id", "sensor_nodes_id", "tzid")
    offset = by_zone(ctx, lambda zone: timeops.offset_seconds("datetime", zone))
    return rows.withColumn("hour", timeops.hour_end("datetime", offset))


def within_periods(rows: DataFrame, periods: DataFrame, level: str) -> DataFrame:
    """Rows of facts that can belong to the periods: bounds that reach the scan.

    From the first period to the end of the last one, 26 hours wider either way (a zone is
    at most so far off UTC), as scalar subqueries: they run before the scan and prune its
    row groups, and its month folders where the facts have the column `ym`.
    """
    first, last = F.min("datetime").cast("timestamp"), F.max("datetime").cast("timestamp")
    length = {"hour": 0, "day": 86400, "year": 366 * 86400}[level]
    low = periods.agg(timeops.shift(first, -26 * 3600).alias("t"))
    high = periods.agg(timeops.shift(last, length + 26 * 3600).alias("t"))
    at = F.col("datetime")
    if "ym" in rows.columns:
        month = (F.year("t") * 100 + F.month("t")).alias("ym")
        rows = rows.where((F.col("ym") >= low.select(month).scalar()) & (F.col("ym") <= high.select(month).scalar()))
    return rows.where((at >= low.scalar()) & (at <= high.scalar()))


def hourly_rollup(measurements: DataFrame, ctx: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Per sensor and local hour. `periods(datetime, offset_s)` limits to those hours."""
    rows = with_hour(measurements if periods is None else within_periods(measurements, periods, "hour"), ctx)
    if periods is not None:
        wanted = periods.select(F.col("datetime").alias("hour"), "offset_s").distinct()
        at_hour = by_zone(ctx, lambda zone: timeops.offset_seconds("hour", zone))
        # keys that cannot be null: else the optimizer tests the whole zone arithmetic for null
        # once more, below the join with the context, in code too long to compile
        never = F.timestamp_seconds(F.lit(-(2**40)))
        rows = rows.withColumns({"_hour": F.coalesce("hour", never), "_offset_s": F.coalesce(at_hour, F.lit(0))})
        wanted = wanted.select(F.coalesce("hour", never).alias("_hour"), F.coalesce("offset_s", F.lit(0)).alias("_offset_s"))
        rows = rows.join(wanted, ["_hour", "_offset_s"], "left_semi")
    keys = ["sensors_id", "measurands_id", "sensor_nodes_id", "hour"]
    # hours of a sensor go to different tasks, whatever the join above was clustered by
    rows = rows.select(*keys, "datetime", "value", "added_on").repartition("sensors_id", "hour")
    grouped = _weighted(rows, keys, "value").groupBy(*keys).agg(
        F.max("added_on").alias("updated_on"),
        F.min("datetime").alias("datetime_first"),
        F.max("datetime").alias("datetime_last"),
        *_summary("value"),
        F.count_if(F.col("value").isNull()).alias("error_count"),
    )
    return grouped.withColumnRenamed("hour", "datetime")


def _longer_rollup(rows: DataFrame) -> DataFrame:
    keys = ["sensors_id", "sensor_nodes_id", "_period"]
    wide = rows.select(
        *keys, "updated_on", "datetime_first", "datetime_last", "value_count", "value_avg", "hour_min", "hour_max", "error_count"
    ).withColumnRenamed("value_count", "hour_count").repartition("sensors_id", "_period")
    grouped = _weighted(wide, keys, "value_avg").groupBy(*keys).agg(
        F.max("updated_on").alias("updated_on"),
        F.min("datetime_first").alias("datetime_first"),
        F.max("datetime_last").alias("datetime_last"),
        *_summary("value_avg"),
        F.sum("hour_count").alias("value_raw_count"),
        F.try_divide(F.sum(F.col("value_avg") * F.col("hour_count")), F.sum("hour_count")).alias("value_raw_avg"),
        F.min(F.col("hour_min")).alias("value_raw_min"),
        F.max(F.col("hour_max")).alias("value_raw_max"),
        F.sum("error_count").alias("error_raw_count"),
        F.count_if(F.col("value_avg").isNull()).alias("error_count"),
    )
    return grouped.withColumnRenamed("_period", "datetime")


def _local_hours(hourly: DataFrame, ctx: DataFrame, where: Column | None = None) -> DataFrame:
    facts = hourly.where(F.col("value_count") > 0).select(
        "sensors_id", "datetime", "updated_on", "datetime_first", "datetime_last", "value_count", "value_avg",
        F.col("value_min").alias("hour_min"), F.col("value_max").alias("hour_max"), "error_count",
    )
    return join_context(facts, ctx, "sensor_nodes_id", "tzid", where=where)


def _start_offset(period: Column) -> Column:
    """Offset of the zone at UTC midnight of the period's first day."""
    return timeops.offset_seconds(period.cast("timestamp"), F.col("tzid"))


def period_offsets(period: Column, level: str) -> Column:
    """Offsets a zone uses within a day (its start and end) or a year (winter and summer).

    A period marked under any of them concerns the zone, so rows that arrive on either
    side of a clock change recompute the whole period.
    """
    later = F.date_add(period, 1) if level == "day" else F.add_months(period, 6)
    return F.array_distinct(F.array(_start_offset(period), _start_offset(later)))


def daily_rollup(
    hourly: DataFrame,
    ctx: DataFrame,
    periods: DataFrame | None = None,
    sensors: Sequence[int] | DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    lag: int | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Per sensor and local day, from hourly rows.

    `periods(datetime, offset_s)` limits to stale days, `sensors` to some sensors,
    [start, end) to local days, `lag` to zones whose clock shows that hour at `as_of`.
    """
    if sensors is not None:
        if isinstance(sensors, DataFrame):
            hourly = hourly.join(sensors.select("sensors_id").distinct(), "sensors_id", "left_semi")
        else:
            hourly = hourly.where(F.col("sensors_id").isin(list(sensors)))
    # a zone is at most 26 hours off UTC either way: a bound the scan can use
    if start is not None:
        hourly = hourly.where(F.col("datetime") > timeops.shift(timeops.instant(start), -26 * 3600))
    if end is not None:
        hourly = hourly.where(F.col("datetime") <= timeops.shift(timeops.instant(end), 26 * 3600))
    if periods is not None:
        hourly = within_periods(hourly, periods, "day")
    at_lag = None
    if lag is not None:
        at_lag = timeops.local_hour_int(timeops.instant(as_of), F.col("tzid")) == lag
    rows = _local_hours(hourly, ctx, at_lag).withColumn(
        "_period", by_zone(ctx, lambda zone: timeops.local_date("datetime", zone))
    )
    if start is not None:
        rows = rows.where(F.col("_period") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("_period") < F.lit(end).cast("date"))
    return _longer_rollup(_keep_periods(rows, periods, "day"))


def annual_rollup(hourly: DataFrame, ctx: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Per sensor and local year, from hourly rows (day percentiles cannot be combined)."""
    if periods is not None:
        hourly = within_periods(hourly, periods, "year")
    rows = _local_hours(hourly, ctx).withColumn(
        "_period", by_zone(ctx, lambda zone: timeops.local_year("datetime", zone))
    )
    return _longer_rollup(_keep_periods(rows, periods, "year"))


def _keep_periods(rows: DataFrame, periods: DataFrame | None, level: str) -> DataFrame:
    """Rows whose (period, offset) is wanted; two marks instead of a copy per offset."""
    if periods is None:
        return rows
    wanted = periods.select(F.col("datetime").cast("date").alias("_period"), "offset_s").distinct()
    marked = rows.withColumn("_offsets", period_offsets(F.col("_period"), level))
    for i, mark in enumerate(("_a", "_b")):
        marked = marked.withColumn(f"{mark}_off", F.get("_offsets", F.lit(i))).join(
            wanted.select("_period", F.col("offset_s").alias(f"{mark}_off"), F.lit(True).alias(mark)),
            ["_period", f"{mark}_off"],
            "left",
        )
    return marked.where(F.coalesce("_a", "_b", F.lit(False)))


def daily_check(hourly: DataFrame, ctx: DataFrame, sensors, start: str, end: str) -> DataFrame:
    """Narrow read-only daily summary with the zone's offset at the day start."""
    if isinstance(sensors, DataFrame):
        hourly = hourly.join(sensors.select("sensors_id").distinct(), "sensors_id", "left_semi")
    else:
        hourly = hourly.where(F.col("sensors_id").isin(list(sensors)))
    rows = _local_hours(hourly, ctx).withColumn("_day", timeops.local_date("datetime", F.col("tzid")))
    rows = rows.where((F.col("_day") >= F.lit(start).cast("date")) & (F.col("_day") < F.lit(end).cast("date")))
    return rows.groupBy(
        "sensors_id", "sensor_nodes_id", F.col("_day").alias("datetime"), _start_offset(F.col("_day")).alias("utc_offset")
    ).agg(
        F.min(F.col("datetime")).alias("datetime_min"),
        F.max(F.col("datetime")).alias("datetime_max"),
        F.count("*").alias("value_count"),
        F.sum("value_count").alias("value_raw_count"),
        F.avg("value_avg").alias("value_avg"),
        F.try_divide(F.sum(F.col("value_avg") * F.col("value_count")), F.sum("value_count")).alias("value_raw_avg"),
    )


def rollup_counts(rows: DataFrame) -> DataFrame:
    """Node, sensor and measurement totals of a set of rollup rows.

    A sensor has one node, so rows collapse to sensors first and to nodes next; no
    task ever holds the distinct ids of everything.
    """
    raw = "value_raw_count" in rows.columns
    sums = [F.sum("value_count").alias("measurements_hourly_count" if raw else "measurements_count")]
    if raw:
        sums.append(F.sum("value_raw_count").alias("measurements_count"))
    names = [s for s in ("measurements_hourly_count", "measurements_count") if raw or s == "measurements_count"]
    sensors = rows.groupBy("sensor_nodes_id", "sensors_id").agg(*sums)
    nodes = sensors.groupBy("sensor_nodes_id").agg(
        F.count("*").alias("sensors_count"), *[F.sum(n).alias(n) for n in names]
    )
    return nodes.agg(
        F.count("*").alias("sensor_nodes_count"),
        F.coalesce(F.sum("sensors_count"), F.lit(0)).alias("sensors_count"),
        *[F.sum(n).alias(n) for n in names],
    )


def daily_stats(daily: DataFrame, ctx: DataFrame, days: DataFrame) -> DataFrame:
    """Totals per requested day; a day without data gives zeros."""
    rows = daily.join(days.select("datetime").distinct(), "datetime", "left_semi")
    calculated = [c for c in ("calculated_on", "calculated_count") if c in daily.columns]
    per_sensor = rows.groupBy("datetime", "sensor_nodes_id", "sensors_id").agg(
        F.sum("value_count").alias("m"), F.sum("value_raw_count").alias("r"), F.max("updated_on").alias("u"),
        F.count("*").alias("n"),
        *([F.max("calculated_on").alias("c_on"), F.sum("calculated_count").alias("c_n")] if len(calculated) == 2 else
          [F.lit(None).cast("timestamp").alias("c_on"), F.lit(None).cast("bigint").alias("c_n")]),
    )
    per_node = per_sensor.groupBy("datetime", "sensor_nodes_id").agg(
        F.sum("m").alias("m"), F.sum("r").alias("r"), F.max("u").alias("u"), F.sum("n").alias("n"),
        F.max("c_on").alias("c_on"), F.sum("c_n").alias("c_n"),
    )
    per_day = per_node.groupBy("datetime").agg(
        F.count("*").alias("nodes"), F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("r").alias("r"),
        F.max("u").alias("u"), F.max("c_on").alias("c_on"), F.sum("c_n").alias("c_n"),
    )
    zero = F.lit(0)
    return days.select("datetime").distinct().join(per_day, "datetime", "left").select(
        "datetime",
        F.coalesce("nodes", zero).alias("sensor_nodes_count"),
        F.coalesce("n", zero).alias("sensors_count"),
        F.coalesce("m", zero).alias("measurements_count"),
        F.coalesce("r", zero).alias("measurements_raw_count"),
        F.col("u").alias("updated_on"),
        F.col("c_on").alias("calculated_on"),
        F.coalesce("c_n", F.lit(1)).alias("calculated_count"),
    )


def rollup_reconcile(measurements: DataFrame, hourly: DataFrame, daily: DataFrame, ctx: DataFrame) -> DataFrame:
    """Sensor-days side by side from the daily, hourly and raw level; `matches` if equal."""
    day = by_zone(ctx, lambda zone: timeops.local_date("datetime", zone))
    from_hours = (
        join_context(hourly, ctx, "tzid")
        .groupBy("sensors_id", day.alias("day"))
        .agg(
            F.sum("value_count").alias("hourly_raw_count"),
            F.count("*").alias("hourly_count"),
            F.avg("value_avg").alias("hourly_avg"),
        )
    )
    hour = timeops.hour_end("datetime", by_zone(ctx, lambda zone: timeops.offset_seconds("datetime", zone)))
    raw_hours = (
        join_context(measurements, ctx, "tzid")
        .groupBy("sensors_id", "tzid", hour.alias("datetime"))
        .agg(F.count("*").alias("n"), F.avg("value").alias("avg"))
    )
    from_raw = raw_hours.groupBy("sensors_id", day.alias("day")).agg(
        F.sum("n").alias("raw_count"), F.count("*").alias("raw_hours"), F.avg("avg").alias("raw_avg")
    )
    from_days = daily.select(
        "sensors_id",
        F.col("datetime").alias("day"),
        F.col("value_raw_count").alias("daily_raw_count"),
        F.col("value_count").alias("daily_count"),
        F.col("value_avg").alias("daily_avg"),
    )
    both = from_days.join(from_hours, ["sensors_id", "day"], "full_outer").join(
        from_raw, ["sensors_id", "day"], "full_outer"
    )

    def close(a: str, b: str) -> Column:
        same_null = F.col(a).isNull() & F.col(b).isNull()
        return same_null | F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1e-9 * (1 + F.abs(F.col(b))), F.lit(False))

    matches = (
        F.col("daily_raw_count").eqNullSafe(F.col("hourly_raw_count"))
        & F.col("daily_raw_count").eqNullSafe(F.col("raw_count"))
        & F.col("daily_count").eqNullSafe(F.col("hourly_count"))
        & F.col("daily_count").eqNullSafe(F.col("raw_hours"))
        & close("daily_avg", "hourly_avg")
        & close("daily_avg", "raw_avg")
    )
    return both.withColumn("matches", matches)


def sensors_rollup(measurements: DataFrame, existing: DataFrame | None = None, sensors: DataFrame | None = None) -> DataFrame:
    """Lifetime statistics and latest value per sensor.

    With `existing`, only sensors without a rollup (or without an average) are
    computed, and a latest value already stored is kept.
    """
    rows = measurements
    if existing is not None:
        done = existing.where(F.col("value_avg").isNotNull()).select("sensors_id")
        rows = rows.join(done, "sensors_id", "left_anti")
    if sensors is not None:
        rows = rows.join(sensors.select("sensors_id"), "sensors_id", "left_semi")
    fresh = rows.groupBy("sensors_id").agg(
        F.min("datetime").alias("datetime_first"),
        F.max("datetime").alias("datetime_last"),
        F.count("*").alias("value_count"),
        F.avg("value").alias("value_avg"),
        F.stddev("value").alias("value_sd"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
        F.max_by("value", "datetime").alias("value_latest"),
        F.max("added_on").alias("modified_on"),
    )
    if existing is None:
        return fresh
    from airloom.operators.upsert import upsert

    return upsert(existing, fresh, ["sensors_id"], merge={"value_latest": "keep"})


def sensor_rollups_summary(lifetime: DataFrame, sensors: DataFrame, measurands: DataFrame) -> DataFrame:
    """Per measurand: sensors, average, and the tails of sensor minima and maxima.

    A measurand may cover most sensors, so percentiles use the group-splitting form.
    """
    rows = (
        lifetime.join(never_broadcast(sensors.select("sensors_id", "measurands_id", "added_on")), "sensors_id")
        .join(measurands.select("measurands_id", "measurand", "units"), "measurands_id")
    )
    keys = ["measurand", "units"]
    plain = rows.groupBy(*keys).agg(
        F.count("*").alias("sensors_count"),
        F.round(F.avg("value_avg"), 2).alias("value_avg"),
        F.round(F.min("value_min"), 2).alias("value_min"),
        F.round(F.max("value_max"), 2).alias("value_max"),
        F.max("added_on").alias("last_added"),
        F.max("modified_on").alias("last_modified"),
    )
    low = numeric.exact_percentiles(rows, keys, "value_min", {"value_min_p01": 0.01, "value_min_p05": 0.05})
    high = numeric.exact_percentiles(rows, keys, "value_max", {"value_max_p95": 0.95, "value_max_p99": 0.99})
    tails = [F.round(c, 2).alias(c) for c in ("value_min_p01", "value_min_p05", "value_max_p95", "value_max_p99")]
    out = plain.join(low, keys, "left").join(high, keys, "left")
    others = [c for c in plain.columns]
    return out.select(*others, *tails).orderBy(F.desc("sensors_count"))


def analyses_summary(analyses: DataFrame) -> DataFrame:
    """Per sensor: span, latest value and point, totals and extent.

    The point's coordinates are picked one by one: a struct would turn the hash
    aggregation into a sorting one, and a sensor has one row per instant.
    """
    totals = analyses.groupBy("sensors_id").agg(
        F.min("datetime").alias("datetime_first"),
        F.max("datetime").alias("datetime_last"),
        F.max_by("value", "datetime").alias("last_value"),
        F.count("*").alias("value_count"),
        F.sum("value").alias("value_sum"),
        F.min("lon").alias("minx"),
        F.min("lat").alias("miny"),
        F.max("lon").alias("maxx"),
        F.max("lat").alias("maxy"),
        F.max_by("lon", "datetime").alias("_lon"),
        F.max_by("lat", "datetime").alias("_lat"),
    )
    point = F.struct(F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))
    return totals.withColumn("last_point", point).drop("_lon", "_lat")


def providers_stats(measurements: DataFrame, ctx: DataFrame, day: str | None = None) -> DataFrame:
    """Per provider and day of arrival: sources, rows, and delay (seconds) of arrival.

    One day with `day`, else all days. The reference's window is open at both ends, so
    rows that arrived at midnight sharp belong to no day.
    """
    rows = measurements
    if day is not None:
        start = timeops.instant(day)
        rows = rows.where((F.col("added_on") > start) & (F.col("added_on") < timeops.shift(start, 86400)))
    rows = rows.where(F.col("added_on") != F.date_trunc("day", "added_on"))
    rows = join_context(rows, ctx, "sensor_nodes_id", "providers_id")
    delay = timeops.seconds_between("added_on", "datetime")
    sensors = rows.groupBy(
        "providers_id", F.to_date("added_on").alias("day"), "sensor_nodes_id", "sensors_id"
    ).agg(
        F.count("*").alias("n"), F.min(delay).alias("lo"), F.sum(delay).alias("total"), F.max(delay).alias("hi"),
        F.min("datetime").alias("d0"), F.max("datetime").alias("d1"),
        F.min("added_on").alias("a0"), F.max("added_on").alias("a1"),
    )

    def fold(df: DataFrame, keys: list[str], counts: list[Column]) -> DataFrame:
        return df.groupBy(*keys).agg(
            *counts, F.sum("n").alias("n"), F.min("lo").alias("lo"), F.sum("total").alias("total"), F.max("hi").alias("hi"),
            F.min("d0").alias("d0"), F.max("d1").alias("d1"), F.min("a0").alias("a0"), F.max("a1").alias("a1"),
        )

    nodes = fold(sensors, ["providers_id", "day", "sensor_nodes_id"], [F.count("*").alias("s")])
    days = fold(nodes, ["providers_id", "day"], [F.count("*").alias("nodes"), F.sum("s").alias("s")])
    return days.select(
        "providers_id", "day", F.col("nodes").alias("sensor_nodes_count"), F.col("s").alias("sensors_count"),
        F.col("n").alias("measurements_count"), F.col("lo").alias("offset_min"),
        (F.col("total") / F.col("n")).alias("offset_avg"), F.col("hi").alias("offset_max"),
        F.col("d0").alias("datetime_min"), F.col("d1").alias("datetime_max"),
        F.col("a0").alias("added_on_min"), F.col("a1").alias("added_on_max"),
    )


def daily_exported_stats(hourly: DataFrame, ctx: DataFrame, day: str | None = None) -> DataFrame:
    """Per UTC day, from hourly rows: nodes, sensors, hours, measurements."""
    rows = hourly.select("sensors_id", "datetime", "value_count")
    if day is not None:
        start = timeops.instant(day)
        rows = rows.where((F.col("datetime") > start) & (F.col("datetime") <= timeops.shift(start, 86400)))
    rows = join_context(rows, ctx, "sensor_nodes_id")
    sensors = rows.groupBy(timeops.utc_date("datetime").alias("day"), "sensor_nodes_id", "sensors_id").agg(
        F.count("*").alias("h"), F.sum("value_count").alias("m")
    )
    nodes = sensors.groupBy("day", "sensor_nodes_id").agg(
        F.count("*").alias("s"), F.sum("h").alias("h"), F.sum("m").alias("m")
    )
    return nodes.groupBy("day").agg(
        F.count("*").alias("sensor_nodes_count"), F.sum("s").alias("sensors_count"),
        F.sum("h").alias("hours_count"), F.sum("m").alias("measurements_count"),
    )


def initial_exported_days(measurements: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days with data in the range, marked -1 until their statistics are computed."""
    rows = measurements.select("datetime")
    if start is not None:
        rows = rows.where(F.col("datetime") >= timeops.instant(start))
    if end is not None:
        rows = rows.where(F.col("datetime") <= timeops.instant(end))
    days = rows.select(timeops.utc_date("datetime").alias("day")).distinct()
    # the day list starts at the day of the first stamp, also when that stamp is a midnight
    # and so belongs to the day before
    first = rows.agg(F.to_date(F.min("datetime")))
    mark = F.lit(-1)
    return days.where(F.col("day") >= first.scalar()).select(
        "day", mark.alias("sensor_nodes_count"), mark.alias("sensors_count"),
        mark.alias("measurements_count"), mark.alias("hours_count"),
    )


def sensor_hourly_coverage(hourly: DataFrame, sensors: DataFrame) -> DataFrame:
    """Rows seen against the hourly frequency in the sensor's metadata, at most 100."""
    expected = F.get_json_object("metadata", "$.hourly_frequency").try_cast("int")
    rows = hourly.select("sensors_id", "datetime", "value_count").join(
        sensors.select("sensors_id", expected.alias("expected")), "sensors_id"
    )
    share = F.try_divide(F.col("value_count"), F.col("expected")) * 100
    return rows.withColumn("coverage", F.when(F.col("value_count") >= F.col("expected"), 100.0).otherwise(F.round(share)))


def daily_summary_of_averages(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("datetime").agg(
        F.avg("value_avg").alias("value_avg"),
        F.min("value_avg").alias("value_min"),
        F.max("value_avg").alias("value_max"),
        F.sum("value_count").alias("value_count"),
        F.count("*").alias("sensors_count"),
    )


def latest_added_per_day(measurements: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    rows = measurements
    if start is not None:
        rows = rows.where(F.col("datetime") > timeops.instant(start))
    if end is not None:
        rows = rows.where(F.col("datetime") <= timeops.instant(end))
    return rows.groupBy(F.to_date("datetime").alias("day")).agg(F.max("added_on").alias("added_on"))
