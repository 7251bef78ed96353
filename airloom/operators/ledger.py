"""The period ledger: which (period, UTC offset) pairs are stale, and their recomputation.

A ledger row is keyed (datetime, offset_s). `datetime` is the UTC end of an hour, the
local date of a day, or January 1 of a year. Every clock is the parameter `as_of`.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions import timeops
from airloom.operators import rollups
from airloom.operators.context import by_zone, join_context
from airloom.operators.upsert import absent_rows, upsert

LEVELS = ("hour", "day", "year")
KEYS = ["datetime", "offset_s"]


def ledger_schema(level: str) -> T.StructType:
    moment = T.TimestampType() if level == "hour" else T.DateType()
    return T.StructType(
        [
            T.StructField("datetime", moment),
            T.StructField("offset_s", T.IntegerType()),
            T.StructField("added_on", T.TimestampType()),
            T.StructField("queued_on", T.TimestampType()),
            T.StructField("modified_on", T.TimestampType()),
            T.StructField("modified_count", T.IntegerType()),
            T.StructField("calculated_on", T.TimestampType()),
            T.StructField("calculated_count", T.IntegerType()),
            T.StructField("calculated_seconds", T.DoubleType()),
            T.StructField("sensor_nodes_count", T.LongType()),
            T.StructField("sensors_count", T.LongType()),
            T.StructField("measurements_count", T.LongType()),
        ]
    )


def _between(rows: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        rows = rows.where(F.col("datetime") >= timeops.instant(start))
    if end is not None:
        rows = rows.where(F.col("datetime") <= timeops.instant(end))
    return rows


def zones_in_use(ctx: DataFrame) -> DataFrame:
    return ctx.select("tzid").distinct()


def enumerate_periods(
    facts: DataFrame, ctx: DataFrame, level: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """All periods that should be in the ledger.

    hour: per offset, every hour end from the first to the last measurement.
    day: every day from the first measurement in steps of 24 hours, for each zone in
    use. The zone list is bounded by the time zone database, so dates are exploded per
    zone from a scalar (first, last) pair and nothing is joined.
    """
    rows = _between(facts.select("sensors_id", "datetime"), start, end)
    if level == "hour":
        located = join_context(rows, ctx, "tzid").withColumn(
            "offset_s", by_zone(ctx, lambda zone: timeops.offset_seconds("datetime", zone))
        )
        span = located.groupBy("offset_s").agg(F.min("datetime").alias("a"), F.max("datetime").alias("b"))
        off = F.col("offset_s")
        hours = F.sequence(timeops.hour_end("a", off), timeops.hour_end("b", off), F.expr("INTERVAL 1 HOUR"))
        return span.select(F.explode(hours).alias("datetime"), "offset_s")
    span = rows.agg(F.struct(F.min("datetime").alias("a"), F.max("datetime").alias("b"))).scalar()
    dated = zones_in_use(ctx).select("tzid", span.alias("s")).where(F.col("s.a").isNotNull())
    days = dated.select("tzid", F.explode(F.sequence("s.a", "s.b", F.expr("INTERVAL 1 DAY"))).alias("t"))
    return days.select(
        F.to_date("t").alias("datetime"), timeops.offset_seconds("t", F.col("tzid")).alias("offset_s")
    ).distinct()


def hours_with_data(measurements: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """UTC hours with a measurement stamped exactly on the hour."""
    rows = _between(measurements.select("datetime"), start, end)
    return rows.where(F.col("datetime") == F.date_trunc("hour", "datetime")).distinct()


def add_periods(ledger: DataFrame, periods: DataFrame, as_of: str, refresh: bool = False) -> DataFrame:
    """Insert absent periods; with `refresh` they count as modified at `as_of`, old ones too."""
    now = timeops.instant(as_of)
    fresh = periods.select(
        F.col("datetime").cast(ledger.schema["datetime"].dataType),
        F.col("offset_s").cast("int"),
        now.alias("added_on"),
        (now if refresh else F.lit(None).cast("timestamp")).alias("modified_on"),
        F.lit(0).alias("modified_count"),
        F.lit(0).alias("calculated_count"),
    )
    if not refresh:
        return ledger.unionByName(absent_rows(ledger, fresh, KEYS), allowMissingColumns=True)
    return upsert(
        ledger, fresh, KEYS,
        merge={"modified_on": "greatest", "modified_count": "keep", "calculated_count": "keep", "added_on": "keep"},
    )


def touched_periods(touched: DataFrame, level: str, zones: DataFrame | None = None) -> DataFrame:
    """Ledger keys concerned by instants.

    `touched` holds `datetime` and `offset_s`; without the offset, every offset `zones`
    (tzid) use at the instant is concerned. For level year `datetime` is a local date.
    """
    if "offset_s" not in touched.columns:
        # no zone changes its clock within a quarter of an hour (UTC), so instants reduce to
        # quarters and zones to the few offsets in use there before they meet
        listed = zones.agg(F.collect_set("tzid")).scalar()
        quarter = F.timestamp_seconds(F.floor(F.unix_seconds("datetime") / 900) * 900)
        exact = touched.select("datetime", quarter.alias("_q")) if level == "hour" else touched.select("datetime", quarter.alias("_q")).distinct()
        offsets = F.array_distinct(F.transform("_zones", lambda z: timeops.offset_seconds("_q", z)))
        used = exact.select("_q").distinct().withColumn("_zones", listed).select("_q", offsets.alias("_offsets"))
        touched = exact.join(used, "_q").select("datetime", F.explode("_offsets").alias("offset_s"))
    off = F.col("offset_s")
    period = {
        "hour": lambda: timeops.hour_end("datetime", off),
        "day": lambda: F.to_date(timeops.shift("datetime", off - 1)),
        "year": lambda: F.trunc(F.col("datetime").cast("date"), "year"),
    }[level]()
    return touched.select(period.alias("datetime"), off.cast("int").alias("offset_s")).distinct()


def mark_modified(
    ledger: DataFrame, touched: DataFrame, level: str, as_of: str, zones: DataFrame | None = None
) -> DataFrame:
    """Touch the ledger rows that instants fall in."""
    return mark_periods(ledger, touched_periods(touched, level, zones), as_of)


def mark_periods(ledger: DataFrame, keys: DataFrame, as_of: str) -> DataFrame:
    """Touch ledger rows by key: absent ones enter as never calculated, others count a change."""
    now = timeops.instant(as_of)
    return upsert(
        ledger,
        keys,
        KEYS,
        merge={"modified_on": now, "modified_count": F.col("old.modified_count") + 1},
        insert={"added_on": now, "modified_count": F.lit(0), "calculated_count": F.lit(0)},
    )


def _stale(level: str, now: Column) -> Column:
    modified, queued, calculated = F.col("modified_on"), F.col("queued_on"), F.col("calculated_on")
    again = (queued < modified) | calculated.isNull()
    if level == "hour":
        again = again | (calculated < modified)
    waited = (queued < timeops.shift(now, -3600)) & again
    return (calculated.isNull() | (modified > calculated)) & (queued.isNull() | waited)


def stale_periods(
    ledger: DataFrame, level: str, n: int | None, lower: str | None = None, upper: str | None = None, as_of: str = None
) -> DataFrame:
    """Periods to recompute, oldest first, at most `n` (all of them when None).

    Not calculated or modified since, and not queued, or queued over an hour ago and
    changed since. The default upper bound is this hour, yesterday, or a year ago.
    """
    now = timeops.instant(as_of)
    moment = ledger.schema["datetime"].dataType
    default = {
        "hour": lambda: F.date_trunc("hour", now),
        "day": lambda: F.date_sub(F.to_date(now), 1),
        "year": lambda: F.add_months(F.to_date(now), -12),
    }[level]()
    rows = ledger.where(_stale(level, now))
    rows = rows.where(F.col("datetime") <= (default if upper is None else F.lit(upper).cast(moment)))
    if lower is not None:
        rows = rows.where(F.col("datetime") >= F.lit(lower).cast(moment))
    rows = rows.select("datetime", "offset_s", "queued_on")
    return rows if n is None else rows.orderBy("datetime", "offset_s").limit(n)


def uncalculated_periods(
    ledger: DataFrame, n: int, lower: str | None = None, upper: str | None = None, as_of: str = None
) -> DataFrame:
    """The simple form: hours never calculated, up to one hour before the clock."""
    last = timeops.instant(upper) if upper else timeops.shift(timeops.instant(as_of), -3600)
    rows = ledger.where(F.col("calculated_on").isNull() & (F.col("datetime") <= last))
    if lower is not None:
        rows = rows.where(F.col("datetime") >= timeops.instant(lower))
    return rows.select("datetime", "offset_s").orderBy("datetime", "offset_s").limit(n)


def claim_periods(ledger: DataFrame, periods: DataFrame, as_of: str) -> DataFrame:
    """Mark periods as queued, which also counts an attempt."""
    return upsert(
        ledger, periods.select(*KEYS), KEYS,
        merge={"queued_on": timeops.instant(as_of), "calculated_count": F.col("old.calculated_count") + 1},
    )


def period_counts(rows: DataFrame, ctx: DataFrame, periods: DataFrame, level: str) -> DataFrame:
    """Node, sensor and measurement totals of rollup rows per requested period."""
    zoned = join_context(rows.select("sensors_id", "sensor_nodes_id", "datetime", "value_count"), ctx, "tzid")
    if level == "hour":
        keyed = zoned.withColumn("offset_s", timeops.offset_seconds("datetime", F.col("tzid")))
    else:
        keyed = zoned.withColumn("offset_s", F.explode(rollups.period_offsets(F.col("datetime"), level)))
    keyed = keyed.join(periods.select(*KEYS), KEYS, "left_semi")
    nodes = keyed.groupBy(*KEYS, "sensor_nodes_id").agg(F.count("*").alias("s"), F.sum("value_count").alias("m"))
    return nodes.groupBy(*KEYS).agg(
        F.count("*").alias("sensor_nodes_count"), F.sum("s").alias("sensors_count"), F.sum("m").alias("measurements_count")
    )


def recompute(
    facts: DataFrame,
    ctx: DataFrame,
    target: DataFrame,
    ledger: DataFrame,
    level: str,
    n: int | None,
    as_of: str,
    lower: str | None = None,
    upper: str | None = None,
    seconds: float | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Roll up every stale period in one job.

    Returns the updated target, the updated ledger, and the periods that became
    modified one level up (keys for `mark_periods` of the parent ledger).
    `facts` are measurements for level hour, hourly rows for day and year.
    """
    now = timeops.instant(as_of)
    stale = stale_periods(ledger, level, n, lower, upper, as_of)
    roll = {"hour": rollups.hourly_rollup, "day": rollups.daily_rollup, "year": rollups.annual_rollup}[level]
    rows = roll(facts, ctx, periods=stale).withColumn("calculated_on", now)
    if level != "hour":
        rows = rows.withColumn("calculated_count", F.lit(1))
    counts = stale.select(*KEYS).join(period_counts(rows, ctx, stale, level), KEYS, "left").select(
        *KEYS,
        now.alias("calculated_on"),
        F.coalesce("sensor_nodes_count", F.lit(0)).alias("sensor_nodes_count"),
        F.coalesce("sensors_count", F.lit(0)).alias("sensors_count"),
        "measurements_count",
        F.lit(seconds).cast("double").alias("calculated_seconds"),
    )
    keys = ["sensors_id", "datetime"]
    updated = upsert(
        target, rows.select(*[c for c in rows.columns if c in target.columns]), keys,
        merge={"calculated_count": F.col("old.calculated_count")} if level != "hour" else None,
    )
    # one attempt for the claim, one for the calculation
    written = upsert(claim_periods(ledger, stale, as_of), counts, KEYS,
                     merge={"calculated_count": F.col("old.calculated_count") + 1})
    return updated, written, cascade(stale, level)


def cascade(periods: DataFrame, level: str) -> DataFrame:
    """Parent keys of recomputed periods: hour to local day, day to year, year to none."""
    if level == "hour":
        return touched_periods(periods, "day")
    if level == "day":
        return touched_periods(periods, "year")
    return periods.select(*KEYS).where(F.lit(False))


# ---- summaries --------------------------------------------------------------------------------


def _pending() -> Column:
    return F.col("calculated_on").isNull() | F.coalesce(F.col("modified_on") > F.col("calculated_on"), F.lit(False))


def _done() -> Column:
    return F.col("calculated_on").isNotNull() & (
        F.col("modified_on").isNull() | (F.col("calculated_on") >= F.col("modified_on"))
    )


def _in_progress() -> Column:
    return F.col("queued_on").isNotNull() & F.col("calculated_on").isNull()


def ledger_summary(ledger: DataFrame) -> DataFrame:
    when_pending = F.when(_pending(), F.col("datetime"))
    return ledger.agg(
        F.count("*").alias("total"),
        F.count_if(_pending()).alias("pending"),
        F.count_if(_done()).alias("done"),
        F.count_if(_in_progress()).alias("in_progress"),
        F.min(when_pending).alias("oldest_pending"),
        F.max(when_pending).alias("newest_pending"),
        F.round(F.avg("calculated_seconds"), 2).alias("avg_seconds"),
        F.round(F.max("calculated_seconds"), 2).alias("max_seconds"),
        F.sum("measurements_count").alias("total_measurements"),
        F.sum("sensors_count").alias("total_sensors"),
        F.max("calculated_on").alias("last_calculated"),
    )


def ledger_summary_monthly(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(F.date_trunc("month", F.col("datetime").cast("timestamp")).alias("month")).agg(
        F.count("*").alias("total"),
        F.count_if(_pending()).alias("pending"),
        F.count_if(_done()).alias("done"),
        F.round(F.avg("calculated_seconds"), 2).alias("avg_seconds"),
        F.sum("measurements_count").alias("total_measurements"),
        F.min("calculated_on").alias("first_calculated"),
        F.max("calculated_on").alias("last_calculated"),
        F.max("added_on").alias("last_added_on"),
    ).orderBy("month")


def ledger_summary_recent(ledger: DataFrame, as_of: str) -> DataFrame:
    recent = ledger.where(F.col("calculated_on") > timeops.shift(timeops.instant(as_of), -3600))
    return recent.agg(
        F.count("*").alias("total"),
        F.count_if(_in_progress()).alias("in_progress"),
        F.round(F.avg("calculated_seconds"), 2).alias("avg_seconds"),
        F.round(F.max("calculated_seconds"), 2).alias("max_seconds"),
        F.sum("measurements_count").alias("total_measurements"),
        F.sum("sensors_count").alias("total_sensors"),
        F.max("datetime").alias("last_datetime"),
    )


# ---- day lists --------------------------------------------------------------------------------


def missing_days(hourly: DataFrame, stats: DataFrame, first_only: bool = False) -> DataFrame:
    """Days between the first and last hourly row that have no statistics row."""
    span = hourly.agg(F.to_date(F.min("datetime")).alias("a"), F.to_date(F.max("datetime")).alias("b"))
    days = span.where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("datetime"))
    missing = days.join(stats.select(F.col("datetime").cast("date")), "datetime", "left_anti").orderBy("datetime")
    return missing.limit(1) if first_only else missing


def modified_days(stats: DataFrame, as_of: str, n: int) -> DataFrame:
    """Statistics rows modified after their calculation, before today, first n."""
    today = F.to_date(timeops.instant(as_of))
    stale = (F.col("datetime") < today) & (F.col("modified_on") > F.col("calculated_on"))
    return stats.where(stale).select("datetime").orderBy("datetime").limit(n)


def islands(df: DataFrame, key: str | None = None, date_col: str = "datetime", gap_days: int = 1) -> DataFrame:
    """Runs of days at most `gap_days` apart: first and last day of each, per key.

    Days are made distinct first, so a window holds at most the calendar, however many
    rows a key has.
    """
    keys = [key] if key else []
    day = F.col(date_col).cast("date")
    days = df.select(*keys, day.alias("_day")).where(day.isNotNull()).distinct()
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_day")
    starts = F.when(F.datediff("_day", F.lag("_day").over(order)) <= gap_days, 0).otherwise(1)
    runs = days.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(order))
    return runs.groupBy(*keys, "_run").agg(F.min("_day").alias("day_first"), F.max("_day").alias("day_last")).drop("_run")


def timed(action) -> float:
    """Wall-clock seconds of a Spark action, for the ledger's calculated_seconds."""
    started = time.monotonic()
    action()
    return time.monotonic() - started
