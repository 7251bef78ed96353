"""Arriving measurements as a stream.

The main form never drops late rows: each micro-batch inserts absent rows, marks the
hours they fall in, and recomputes exactly the stale periods of all three levels. The
watermark form serves append-only outputs.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airloom.functions import timeops
from airloom.operators import ledger, rollups
from airloom.operators.context import by_zone, join_context, recount
from airloom.operators.upsert import absent_rows, one_per_key
from airloom.session import configure
from airloom.sources.files import (
    _exists, months_of, publish, read_months, read_snapshot, snapshots, upsert_months, write_measurements,
)


@dataclass(frozen=True)
class Store:
    """Folders of one station store: measurements, hour, day and year data and ledgers."""

    root: str

    def facts(self) -> str:
        return f"{self.root}/measurements"

    def data(self, level: str) -> str:
        return f"{self.root}/{level}_data"

    def ledger(self, level: str) -> str:
        return f"{self.root}/{level}_ledger"


def _ledger(spark: SparkSession, store: Store, level: str) -> DataFrame:
    path = store.ledger(level)
    if snapshots(spark, path):
        return read_snapshot(spark, path)
    return spark.createDataFrame([], ledger.ledger_schema(level))


def _calculated(spark: SparkSession, ctx: DataFrame, store: Store, stale: DataFrame, level: str, as_of: str) -> DataFrame:
    """Ledger entries of recomputed periods, counted from the rows just written."""
    path, now = store.data(level), timeops.instant(as_of)
    rows = read_months(spark, path, months_of(stale)).where(F.col("calculated_on") == now)
    counts = ledger.period_counts(rows, ctx, stale, level)
    return stale.select(*ledger.KEYS).join(counts, ledger.KEYS, "left").select(
        *ledger.KEYS, now.alias("calculated_on"), F.lit(2).alias("calculated_count"),
        F.coalesce("sensor_nodes_count", F.lit(0)).alias("sensor_nodes_count"),
        F.coalesce("sensors_count", F.lit(0)).alias("sensors_count"), "measurements_count",
    )


def _months_around(periods: DataFrame, level: str) -> list[int]:
    """UTC months in which rows of the periods can lie."""
    day = F.col("datetime").cast("date")
    if level == "year":
        begin = F.trunc(day, "year")
        stamps = F.sequence(F.add_months(begin, -1), F.add_months(begin, 12), F.expr("interval 1 month"))
    else:
        stamps = F.array(*[F.date_add(day, k) for k in (-2, 0, 2)])
    return months_of(periods.select(F.explode(stamps).alias("datetime")).distinct())


def recompute_store(spark: SparkSession, ctx: DataFrame, store: Store, as_of: str) -> None:
    """Bring hour, day and year data up to date, each level touching only stale periods."""
    parents = None
    for level in ledger.LEVELS:
        book = _ledger(spark, store, level)
        if parents is not None:
            book = ledger.mark_periods(book, parents, as_of)
        stale = ledger.stale_periods(book, level, None, upper="9999-01-01", as_of=as_of)
        # only months that can hold rows of stale periods are read again
        source = store.facts() if level == "hour" else store.data("hour")
        recent = read_months(spark, source, _months_around(stale, level)).drop("ym")
        roll = {"hour": rollups.hourly_rollup, "day": rollups.daily_rollup, "year": rollups.annual_rollup}[level]
        rows = roll(recent, ctx, periods=stale)
        rows = rows.withColumn("calculated_on", timeops.instant(as_of))
        upsert_months(spark, rows, store.data(level), ["sensors_id", "datetime"])
        done = _calculated(spark, ctx, store, stale, level, as_of)
        marked = ledger.upsert(book, done, ledger.KEYS, merge={"calculated_count": F.col("old.calculated_count") + 2})
        publish(marked, store.ledger(level))
        # stale periods of the published ledger are those calculated just now
        written = read_snapshot(spark, store.ledger(level)).where(F.col("calculated_on") == timeops.instant(as_of))
        parents = ledger.cascade(written.select(*ledger.KEYS), level)


def ingest_batch(spark: SparkSession, batch: DataFrame, ctx: DataFrame, store: Store, as_of: str, recompute: bool = True) -> None:
    """Insert absent measurements, mark their hours as modified, and recompute."""
    configure(spark)
    recount(ctx)
    keys = ["sensors_id", "datetime"]
    first = not _exists(spark, store.facts())
    if first:
        fresh = one_per_key(batch, keys)
    else:
        existing = read_months(spark, store.facts(), months_of(batch))
        fresh = absent_rows(existing, batch, keys)
    # hours come from the whole batch, so a repeated batch after a failure marks them again
    located = join_context(batch.select("sensors_id", "datetime"), ctx, "tzid").select(
        "datetime", by_zone(ctx, lambda zone: timeops.offset_seconds("datetime", zone)).alias("offset_s")
    )
    hours = located.select(timeops.hour_end("datetime", F.col("offset_s")).alias("datetime"), "offset_s").distinct()
    publish(ledger.mark_periods(_ledger(spark, store, "hour"), hours, as_of), store.ledger("hour"))
    write_measurements(fresh, store.facts())
    if recompute:
        recompute_store(spark, ctx, store, as_of)


def stream_hourly(stream: DataFrame, ctx: DataFrame, root: str, checkpoint: str, clock=None) -> StreamingQuery:
    """Run `ingest_batch` on every micro-batch of a measurement stream.

    `clock(batch_id)` gives the batch's time text, rising from batch to batch; the default
    is the wall clock in UTC. A batch replayed after a failure only marks its hours again.
    """
    spark, store = stream.sparkSession, Store(root)
    tell = clock or (lambda _: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))

    def one(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(spark, batch, ctx, store, tell(batch_id))

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_hourly_append(stream: DataFrame, ctx: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly counts and averages for append outputs; hours older than `delay` behind the
    newest are closed, and rows that arrive for them later are dropped."""
    rows = rollups.with_hour(stream, ctx).withWatermark("hour", delay)
    return rows.groupBy("hour", "sensors_id").agg(
        F.count("*").alias("value_count"), F.avg("value").alias("value_avg"), F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    )


def stream_distinct(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeats of (sensors_id, datetime) that arrive within the delay."""
    return stream.withWatermark("datetime", delay).dropDuplicatesWithinWatermark(["sensors_id", "datetime"])


def stream_sessions(stream: DataFrame, gap: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Runs of activity per sensor: rows no further apart than the gap."""
    return (
        stream.withWatermark("datetime", delay)
        .groupBy(F.session_window("datetime", gap).alias("s"), "sensors_id")
        .agg(F.count("*").alias("value_count"))
        .select("sensors_id", F.col("s.start").alias("first"), F.col("s.end").alias("end"), "value_count")
    )


def merge_lifetime(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Lifetime state after a batch: first, last, count, extremes, latest, and the moments
    (sum and sum of squared deviations) from which average and deviation follow.

    Moments of old state and new rows combine exactly, so state never needs old rows.
    Columns: sensors_id, datetime_first, datetime_last, value_count, n, mean, m2,
    value_min, value_max, value_latest.
    """
    fresh = batch.groupBy("sensors_id").agg(
        F.min("datetime").alias("datetime_first"), F.max("datetime").alias("datetime_last"), F.count("*").alias("value_count"),
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("value_min"), F.max("value").alias("value_max"), F.max_by("value", "datetime").alias("value_latest"),
    )
    o, b = existing.alias("o"), fresh.alias("b")
    n1, n2 = F.coalesce("o.n", F.lit(0)), F.coalesce("b.n", F.lit(0))
    mean1, mean2 = F.coalesce("o.mean", F.lit(0.0)), F.coalesce("b.mean", F.lit(0.0))
    m1, m2 = F.coalesce("o.m2", F.lit(0.0)), F.coalesce("b.m2", F.lit(0.0))
    n = n1 + n2
    later = F.col("o.datetime_last").isNull() | (F.col("b.datetime_last") > F.col("o.datetime_last"))
    return o.join(b, F.col("o.sensors_id") == F.col("b.sensors_id"), "full_outer").select(
        F.coalesce("o.sensors_id", "b.sensors_id").alias("sensors_id"),
        F.least("o.datetime_first", "b.datetime_first").alias("datetime_first"),
        F.greatest("o.datetime_last", "b.datetime_last").alias("datetime_last"),
        (F.coalesce("o.value_count", F.lit(0)) + F.coalesce("b.value_count", F.lit(0))).alias("value_count"),
        n.alias("n"),
        F.try_divide(n1 * mean1 + n2 * mean2, n).alias("mean"),
        (m1 + m2 + F.coalesce(F.try_divide(F.pow(mean2 - mean1, 2.0) * n1 * n2, n), F.lit(0.0))).alias("m2"),
        F.least("o.value_min", "b.value_min").alias("value_min"),
        F.greatest("o.value_max", "b.value_max").alias("value_max"),
        F.when(later & F.col("b.sensors_id").isNotNull(), F.col("b.value_latest")).otherwise(F.col("o.value_latest")).alias("value_latest"),
    )


#: Lifetime state as stored, each snapshot with the number of its last batch.
LIFETIME = (
    "sensors_id long, datetime_first timestamp, datetime_last timestamp, value_count long, n long, mean double, m2 double, "
    "value_min double, value_max double, value_latest double, batch_id long"
)


def read_lifetime(spark: SparkSession, path: str) -> DataFrame:
    """The stored lifetime state with average and sample deviation."""
    state = read_snapshot(spark, path) if snapshots(spark, path) else spark.createDataFrame([], LIFETIME)
    deviation = F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1)))
    return state.withColumns({"value_avg": F.when(F.col("n") > 0, F.col("mean")), "value_sd": deviation})


def stream_lifetime(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep lifetime state up to date: every micro-batch merges into a new snapshot.

    The snapshot holds the number of its last batch, so a batch that is replayed after a
    failure finds itself there and changes nothing.
    """
    spark = stream.sparkSession

    def one(batch: DataFrame, batch_id: int) -> None:
        configure(spark)
        known = bool(snapshots(spark, path))
        state = read_snapshot(spark, path) if known else spark.createDataFrame([], LIFETIME)
        if known and state.where(F.col("batch_id") >= batch_id).limit(1).count():
            return
        publish(merge_lifetime(state.drop("batch_id"), batch).withColumn("batch_id", F.lit(batch_id).cast("long")), path)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(batch: DataFrame, seen_until: DataFrame, late_s: int) -> DataFrame:
    """Per sensor, rows stamped more than `late_s` before the last stamp seen so far
    (`seen_until`: sensors_id, datetime_last)."""
    rows = batch.join(seen_until.select("sensors_id", "datetime_last"), "sensors_id")
    return rows.where(F.col("datetime") < timeops.shift("datetime_last", -late_s)).groupBy("sensors_id").agg(
        F.count("*").alias("late_count")
    )
