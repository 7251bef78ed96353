"""Readers, writers, dumps and streams: each writes a given table and reads it back."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from airloom import schemas
from airloom.plans.frames import CHECK
from airloom.plans.registry import query
from airloom.session import shared_folder
from airloom.sources import files
from airloom.streaming import arrivals

_KEYS = ["sensors_id", "datetime"]
_OFFSET = "(epoch_us(timezone(c.tzid, timezone('UTC', {at}))) - epoch_us({at})) // 1000000"
_CHANGED = """SELECT sensors_id, datetime, CASE WHEN sensors_id % 2 = 0 THEN value ELSE value + 1 END AS value, lon, lat, added_on
FROM {measurements_long} WHERE sensors_id % 3 > 0"""


def _stored(f):
    path = shared_folder(f.spark, "facts")
    files.write_measurements(f.measurements_long, path)
    return path


@query(
    "read_measurements_range", "sensors_id:i datetime:t value:f",
    """SELECT sensors_id, datetime, value FROM {measurements_long}
    WHERE datetime > TIMESTAMP '1995-01-05' AND datetime <= TIMESTAMP '1997-02-12'""",
)
def _(f):
    return files.read_measurements(f.spark, _stored(f), "1995-01-05", "1997-02-12")


@query(
    "load_direct", "sensors_id:i datetime:t value:f",
    "SELECT sensors_id, datetime, value FROM {measurements_long} UNION ALL SELECT sensors_id, datetime, value FROM {measurements}",
)
def _(f):
    path = _stored(f)
    files.load_direct(f.measurements, path)
    return files.read_measurements(f.spark, path)


@query(
    "load_indirect", "sensors_id:i datetime:t value:f",
    """SELECT sensors_id, datetime, value FROM {even} UNION ALL
    SELECT sensors_id, datetime, value FROM {changed} c WHERE (sensors_id, datetime) NOT IN (SELECT sensors_id, datetime FROM {even})""",
    {"changed": _CHANGED, "even": "SELECT * FROM {measurements_long} WHERE sensors_id % 2 = 0"},
)
def _(f):
    path = shared_folder(f.spark, "facts")
    files.write_measurements(f.measurements_long.where(F.col("sensors_id") % 2 == 0), path)
    files.load_indirect(f.spark, f.sql(_CHANGED), path)
    return files.read_measurements(f.spark, path)


@query(
    "upsert_months", "sensors_id:i datetime:t value:f",
    """SELECT sensors_id, datetime, CASE WHEN sensors_id % 3 > 0 AND sensors_id % 2 = 1 THEN value + 1 ELSE value END AS value FROM {measurements_long}""",
)
def _(f):
    path = _stored(f)
    files.upsert_months(f.spark, f.sql(_CHANGED), path, _KEYS)
    return files.read_measurements(f.spark, path)


@query(
    "read_delimited", "sensors_id:i datetime:t value:f lat:f lon:f corrupt:b",
    """SELECT sensors_id, datetime, value, lat, lon, false AS corrupt FROM {measurements}
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, true FROM {nation}""",
)
def _(f):
    path = shared_folder(f.spark, "delimited")
    stamp = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    rows = f.measurements.select(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (F.col("sensors_id"), stamp, F.col("value"), F.col("lat"), F.col("lon"))]))
    rows.union(f.nation.select(F.concat(F.lit("bad|"), "n_name", F.lit("|x|y|z")))).write.option("compression", "gzip").text(path)
    read = files.read_delimited(f.spark, path, schemas.PERIOD_FILE)
    return read.withColumn("corrupt", F.col("_corrupt").isNotNull()).select(
        *[F.when(~F.col("corrupt"), F.col(c)).alias(c) for c in ("sensors_id", "datetime", "value", "lat", "lon")], "corrupt"
    )


@query(
    "load_mobile_csv", "ingest_id:s value:f datetime:t lon:f lat:f",
    "SELECT 'net-' || sensors_id || '-pm25' AS ingest_id, value, datetime, lon, lat FROM {measurements}",
)
def _(f):
    path = shared_folder(f.spark, "mobile")
    stamp = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("datetime")
    f.measurements.select(F.concat(F.lit("net-"), "sensors_id", F.lit("-pm25")), "value", stamp, "lon", "lat").write.csv(path)
    return files.load_mobile_csv(f.spark, path)


@query(
    "load_lookup", "providers_id:i licenses_id:i valid_from:d valid_to:d",
    "SELECT providers_id, licenses_id, valid_from, valid_to FROM {providers_licenses}",
)
def _(f):
    path = shared_folder(f.spark, "lookup")
    period = F.concat(F.lit("["), F.col("valid_from").cast("string"), F.lit(","), F.coalesce(F.col("valid_to").cast("string"), F.lit("")), F.lit(")"))
    f.providers_licenses.select("providers_id", "licenses_id", period).write.option("sep", "\t").csv(path)
    schema = schemas._schema("providers_id bigint, licenses_id bigint, valid string")
    return files.load_lookup(f.spark, path, schema, ["valid"])


def _days(f, column: str = "datetime") -> tuple[str, str, str]:
    """Texts of the table's first day, a day within, and the day after its last."""
    first, last = f.measurements.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return str(first), str(first + (last - first) / 3), str(last + timedelta(days=1))


@query(
    "dump_by_period_files", "sensors_id:i datetime:t value:f period:s",
    """SELECT sensors_id, datetime, max(value) AS value, strftime(b, '%Y%m%d%H') || '_' || strftime(b + INTERVAL 1 DAY, '%Y%m%d%H') AS period
    FROM (SELECT *, date_trunc('day', datetime - INTERVAL 1 MICROSECOND) AS b FROM {measurements}) x GROUP BY sensors_id, datetime, lat, lon, b""",
)
def _(f):
    path = shared_folder(f.spark, "periods")
    ids = f.measurements.select("sensors_id", F.col("sensors_id").alias("old_sensors_id")).distinct()
    first, within, after = _days(f)
    before = str(date.fromisoformat(first) - timedelta(days=1))
    files.dump_by_period(f.measurements, ids, path, before, within)
    # periods already there are skipped
    files.dump_by_period(f.measurements, ids, path, before, after)
    rows = f.spark.read.schema("sensors_id bigint, datetime timestamp, value double, lat double, lon double, period string")
    return rows.option("sep", "|").csv(path)


_RESTORED = "SELECT sensors_id, datetime, value, CAST(datetime AS DATE) AS day FROM {measurements}"


@query("dump_by_day_restored", "sensors_id:i datetime:t value:f day:d", _RESTORED)
def _(f):
    path = shared_folder(f.spark, "days")
    files.dump_by_day(f.measurements, path)
    first, _, after = _days(f)
    return files.restore(f.spark, path, first, after)


@query(
    "dump_by_day_restored_range", "sensors_id:i datetime:t value:f day:d",
    _RESTORED + " WHERE datetime >= TIMESTAMP '2024-01-03' AND datetime < TIMESTAMP '2024-01-20'",
)
def _(f):
    path = shared_folder(f.spark, "days")
    files.dump_by_day(f.measurements, path)
    return files.restore(f.spark, path, "2024-01-03", "2024-01-20")


@query(
    "refresh_cached", "countries_id:i name:s nodes:i",
    "SELECT c.countries_id, c.name, count(*) AS nodes FROM {countries} c JOIN {sensor_nodes} n ON n.countries_id = c.countries_id GROUP BY 1, 2",
)
def _(f):
    folder = shared_folder(f.spark, "views")
    files.refresh_cached({"nodes": f.sensor_nodes, "countries": f.countries}, folder)
    copy = lambda name: files.read_cached(f.spark, folder, name)
    counts = copy("nodes").groupBy("countries_id").agg(F.count("*").alias("nodes"))
    files.refresh_cached({"countries": copy("countries").join(counts, "countries_id")}, folder)
    return copy("countries")


@query(
    "data_table_stats", "table_name:s partitions_count:i partition_start:s partition_end:s sizes_in_order:b",
    """SELECT 'measurements' AS table_name, count(DISTINCT strftime(datetime, '%Y%m')) AS partitions_count, strftime(min(datetime), '%Y%m') AS partition_start,
      strftime(max(datetime), '%Y%m') AS partition_end, true AS sizes_in_order FROM {measurements_long}""",
)
def _(f):
    stats = files.data_table_stats(f.spark, {"measurements": (_stored(f), "ym")})
    ordered = (F.col("table_size_min") > 0) & (F.col("table_size_min") <= F.col("table_size_med")) & (
        F.col("table_size_med") <= F.col("table_size_max")
    )
    return stats.withColumn("sizes_in_order", ordered & (F.col("table_size_max") <= F.col("table_size_total")))


# ---- streams --------------------------------------------------------------------------------------------


def _source(f, df, name: str):
    path = shared_folder(f.spark, name)
    df.write.parquet(path)
    return f.spark.readStream.schema(df.schema).parquet(path)


def _drained(f, df, name: str):
    out = shared_folder(f.spark, name)
    stream = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_folder(f.spark, "progress"))
    stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return f.spark.read.schema(df.schema).parquet(out)


@query(
    "stream_hourly", "sensors_id:i sensor_nodes_id:i datetime:t value_count:i value_avg:f value_p50:f error_count:i",
    "SELECT sensors_id, sensor_nodes_id, datetime, value_count, value_avg, value_p50, error_count FROM {hourly}",
)
def _(f):
    root = shared_folder(f.spark, "store")
    stream = _source(f, f.measurements, "arrivals")
    clock = lambda i: f"2024-03-{1 + i:02d} 00:00:00"
    arrivals.stream_hourly(stream, f.ctx, root, shared_folder(f.spark, "progress"), clock).awaitTermination()
    return f.spark.read.parquet(arrivals.Store(root).data("hour"))


@query("stream_distinct", "sensors_id:i datetime:t n:i", "SELECT sensors_id, datetime, 1 AS n FROM {measurements} GROUP BY 1, 2")
def _(f):
    stream = _source(f, f.measurements.unionByName(f.measurements), "repeats")
    found = _drained(f, arrivals.stream_distinct(stream), "distinct")
    return found.groupBy("sensors_id", "datetime").agg(F.count("*").alias("n"))


@query(
    "merge_lifetime", "sensors_id:i datetime_first:t datetime_last:t value_count:i mean:f value_min:f value_max:f",
    "SELECT sensors_id, datetime_first, datetime_last, value_count, value_avg AS mean, value_min, value_max FROM {lifetime}",
)
def _(f):
    early = F.col("datetime") < F.lit("2024-01-15").cast("timestamp")
    columns = "datetime_first timestamp, datetime_last timestamp, value_count long, n long, mean double, m2 double, value_min double, value_max double, value_latest double"
    empty = f.spark.createDataFrame([], "sensors_id long, " + columns)
    state = arrivals.merge_lifetime(arrivals.merge_lifetime(empty, f.measurements.where(early)), f.measurements.where(~early))
    return state.withColumn("mean", F.when(F.col("n") > 0, F.col("mean")))


@query(
    "late_rows", "sensors_id:i late_count:i",
    """SELECT m.sensors_id, count(*) AS late_count FROM {measurements} m JOIN {lifetime} l ON l.sensors_id = m.sensors_id
    WHERE m.datetime < l.datetime_last - INTERVAL 1 DAY GROUP BY 1""",
)
def _(f):
    return arrivals.late_rows(f.measurements, f.lifetime, 86400)


def _arrived(f) -> arrivals.Store:
    """A store that a stream of all measurements has filled."""
    root = shared_folder(f.spark, "store")
    stream = _source(f, f.measurements, "arrivals")
    clock = lambda i: f"2024-03-{1 + i:02d} 00:00:00"
    arrivals.stream_hourly(stream, f.ctx, root, shared_folder(f.spark, "progress"), clock).awaitTermination()
    return arrivals.Store(root)


_ANNUAL = CHECK["annual_long"].replace("{hourly_long}", "{hourly}")


@query(
    "stream_cascade", "level:s sensors_id:i sensor_nodes_id:i period:d value_count:i value_raw_count:i value_avg:f value_p50:f error_count:i",
    """SELECT 'day' AS level, sensors_id, sensor_nodes_id, datetime AS period, value_count, value_raw_count, value_avg + 1e-9 AS value_avg, value_p50 + 1e-9 AS value_p50, error_count FROM {daily}
    UNION ALL SELECT 'year', sensors_id, sensor_nodes_id, datetime, value_count, value_raw_count, value_avg + 1e-9, value_p50 + 1e-9, error_count FROM {annual}""",
    {"annual": _ANNUAL},
)
def _(f):
    store = _arrived(f)
    rows = [f.spark.read.parquet(store.data(level)).withColumn("level", F.lit(level)) for level in ("day", "year")]
    both = rows[0].unionByName(rows[1], allowMissingColumns=True).withColumnRenamed("datetime", "period")
    # averages whose seventh decimal is a five are moved off the edge of rounding, here as in the SQL
    return both.withColumns({c: F.col(c) + 1e-9 for c in ("value_avg", "value_p50")})


@query(
    "stream_ledgers", "level:s period:t offset_s:i sensor_nodes_count:i sensors_count:i measurements_count:i pending:b",
    """SELECT 'hour' AS level, h.datetime AS period, z.off AS offset_s, count(DISTINCT h.sensor_nodes_id) AS sensor_nodes_count,
      count(DISTINCT h.sensors_id) AS sensors_count, sum(h.value_count) AS measurements_count, false AS pending
    FROM {hourly} h JOIN {ctx} c ON c.sensors_id = h.sensors_id, LATERAL (SELECT """ + _OFFSET.format(at="h.datetime") + """ AS off) z GROUP BY 2, 3
    UNION ALL SELECT 'day', CAST(d.datetime AS TIMESTAMP), z.off, count(DISTINCT d.sensor_nodes_id), count(DISTINCT d.sensors_id), sum(d.value_count), false
    FROM {daily} d JOIN {ctx} c ON c.sensors_id = d.sensors_id, LATERAL (SELECT DISTINCT unnest([""" + _OFFSET.format(at="CAST(d.datetime AS TIMESTAMP)")
    + ", " + _OFFSET.format(at="CAST(d.datetime + INTERVAL 1 DAY AS TIMESTAMP)") + "]) AS off) z GROUP BY 2, 3",
)
def _(f):
    store = _arrived(f)
    out = None
    for level in ("hour", "day"):
        book = files.read_snapshot(f.spark, store.ledger(level))
        pending = F.col("calculated_on").isNull() | F.coalesce(F.col("modified_on") > F.col("calculated_on"), F.lit(False))
        stale = book.withColumn("pending", pending)
        rows = stale.select(
            F.lit(level).alias("level"), F.col("datetime").cast("timestamp").alias("period"), "offset_s", "sensor_nodes_count", "sensors_count",
            "measurements_count", "pending",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "stream_lifetime", "sensors_id:i datetime_first:t datetime_last:t value_count:i value_avg:f value_sd:f value_min:f value_max:f",
    "SELECT sensors_id, datetime_first, datetime_last, value_count, value_avg, value_sd, value_min, value_max FROM {lifetime}",
)
def _(f):
    source = shared_folder(f.spark, "arrivals")
    f.measurements.repartition(3, "sensors_id", "datetime").write.parquet(source)
    stream = f.spark.readStream.schema(f.measurements.schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = shared_folder(f.spark, "lifetime")
    arrivals.stream_lifetime(stream, path, shared_folder(f.spark, "progress")).awaitTermination()
    return arrivals.read_lifetime(f.spark, path)


@query(
    "stream_hourly_append", "hour:t sensors_id:i value_count:i value_avg:f value_min:f value_max:f",
    """SELECT datetime AS hour, sensors_id, value_count, value_avg, value_min, value_max FROM {hourly}
    WHERE datetime <= (SELECT max(datetime) FROM {hourly}) - INTERVAL 2 HOUR""",
)
def _(f):
    return _drained(f, arrivals.stream_hourly_append(_source(f, f.measurements, "arrivals"), f.ctx), "hours")


@query(
    "stream_sessions", "sensors_id:i first:t until:t value_count:i",
    """SELECT * FROM (SELECT sensors_id, min(datetime) AS first, max(datetime) + INTERVAL 1 DAY AS until, count(*) AS value_count
      FROM (SELECT *, sum(begins) OVER (PARTITION BY sensors_id ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT sensors_id, datetime, CASE WHEN datetime - INTERVAL 1 DAY <= lag(datetime) OVER (PARTITION BY sensors_id ORDER BY datetime)
          THEN 0 ELSE 1 END AS begins FROM {measurements}) x) y GROUP BY sensors_id, run) z
    WHERE until <= (SELECT date_trunc('milliseconds', max(datetime)) - INTERVAL 1 DAY FROM {measurements})""",
)
def _(f):
    return _drained(f, arrivals.stream_sessions(_source(f, f.measurements, "arrivals")), "sessions").withColumnRenamed("end", "until")
