"""Whole runs: exports with their log, lifetime state from a stream, a day of request logs."""

from pyspark.sql import functions as F

from airloom.operators import exports, monitor
from airloom.plans.frames import AS_OF, Frames
from airloom.plans.queries_exports import _MEASURED_DAYS, _export, _zones
from airloom.session import configure
from airloom.sources import export_run, files
from airloom.streaming import arrivals

SF = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_export_run_claims_writes_and_logs(spark, tmp_path):
    f, path = Frames(configure(spark), SF), str(tmp_path / "out")
    logs = f.sql(_MEASURED_DAYS).cache()
    rows = _export(f)
    wanted = exports.pending_location_days(logs, _zones(f), AS_OF)
    first, done = export_run.run_export(rows, logs, _zones(f), path, AS_OF, limit=5)
    assert done.count() == 5 and {(r.sensor_nodes_id, r.day) for r in done.collect()} <= {(r.sensor_nodes_id, r.day) for r in wanted.collect()}
    first = first.cache()
    assert first.count() == logs.count() and first.where(F.col("exported_on") == F.lit(AS_OF).cast("timestamp")).count() == 5
    second, rest = export_run.run_export(rows, first, _zones(f), path, AS_OF)
    assert rest.count() == wanted.count() - 5
    second = second.cache()
    written = files.read_export(spark, path)
    days = wanted.select("sensor_nodes_id", "day")
    meant = rows.withColumn("day", files.local_day()).join(days, ["sensor_nodes_id", "day"], "left_semi")
    columns = ["sensors_id", "datetime", "value", "sensor_nodes_id", "day", "provider", "country", "datetime_str"]
    assert rows_of(written, *columns) == rows_of(meant, *columns) and meant.count() > 0
    # nothing is pending any more; a day that changes is written again, and only that one
    again, none = export_run.run_export(rows, second, _zones(f), path, AS_OF)
    assert none.count() == 0 and rows_of(again, *again.columns) == rows_of(second, *second.columns)
    day = rest.where("records > 0").orderBy("sensor_nodes_id", "day").limit(1)
    later = "2024-02-03 00:00:00"
    changed = exports.mark_modified_day(second, day, "2024-02-02 00:00:00")
    doubled = rows.withColumn("value", F.col("value") * 2)
    _, redone = export_run.run_export(doubled, changed.where(F.col("day") <= "2024-01-27"), _zones(f), path, later)
    one = redone.join(day.select("sensor_nodes_id", "day"), ["sensor_nodes_id", "day"]).first()
    assert one is not None and one.records == day.first().records
    now = files.read_export(spark, path).join(redone, ["sensor_nodes_id", "day"], "left_semi")
    before = meant.join(redone, ["sensor_nodes_id", "day"], "left_semi")
    assert now.agg(F.sum("value")).first()[0] == 2 * before.agg(F.sum("value")).first()[0]
    assert files.read_export(spark, path).count() == meant.count()


def test_export_folders_do_not_grow_with_nodes(spark, tmp_path):
    f, path = Frames(configure(spark), SF), str(tmp_path / "out")
    rows = _export(f).withColumn("day", files.local_day())
    rows = rows.unionByName(rows.withColumn("sensor_nodes_id", F.col("sensor_nodes_id") + 1)).cache()
    columns = ["sensors_id", "datetime", "value", "sensor_nodes_id", "day", "provider", "country", "lon", "datetime_str"]
    files.write_export(rows.where("sensor_nodes_id % 2 = 1").drop("day"), path)
    # the other nodes come into the same folders; what was there stays, a node-day written again does not double
    late = rows.where("sensor_nodes_id % 2 = 0 OR sensor_nodes_id % 3 = 0")
    files.write_export(late.drop("day"), path)
    assert rows_of(files.read_export(spark, path), *columns) == rows_of(rows, *columns)
    folders = len(list((tmp_path / "out").glob("provider=*/country=*/day=*")))
    assert folders == rows.select("provider", "country", "day").distinct().count() < rows.select("sensor_nodes_id", "day").distinct().count()
    # a run that ended between staging and replacing is finished by the next
    late.withColumn("value", F.lit(-7.0)).write.parquet(path + "__stage")
    files.finish_export(spark, path)
    assert not (tmp_path / "out__stage").exists()
    assert files.read_export(spark, path).where("value = -7").count() == late.count()


def test_lifetime_stream_survives_a_replayed_batch(spark, tmp_path):
    f = Frames(configure(spark), SF)
    source, path = str(tmp_path / "in"), str(tmp_path / "state")
    half = F.col("sensors_id") % 2 == 0
    f.measurements.where(half).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(f.measurements.schema).parquet(source)
    assert arrivals.read_lifetime(spark, path).count() == 0
    assert arrivals.stream_lifetime(stream(), path, str(tmp_path / "progress")).awaitTermination(240)
    # progress is lost, so the same batch comes once more under its old number
    assert arrivals.stream_lifetime(stream(), path, str(tmp_path / "other")).awaitTermination(240)
    assert arrivals.read_lifetime(spark, path).agg(F.sum("value_count")).first()[0] == f.measurements.where(half).count()
    f.measurements.where(~half).coalesce(1).write.mode("append").parquet(source)
    assert arrivals.stream_lifetime(stream(), path, str(tmp_path / "progress")).awaitTermination(240)
    state, want = arrivals.read_lifetime(spark, path), f.lifetime
    both = state.alias("s").join(want.alias("w"), "sensors_id")
    assert both.count() == want.count() == state.count()
    for name in ("datetime_first", "datetime_last", "value_count", "value_min", "value_max"):
        assert both.where(~F.col(f"s.{name}").eqNullSafe(F.col(f"w.{name}"))).count() == 0
    near = F.abs(F.col("s.value_sd") - F.col("w.value_sd")) < 1e-9
    assert both.where(F.col("w.value_sd").isNotNull() & ~F.coalesce(near, F.lit(False))).count() == 0


def test_a_day_of_logs_is_counted_and_taken_out(spark):
    f = Frames(configure(spark), SF)
    counts, rest = monitor.process_daily_logs(f.api_logs, "2024-01-10", f.agents, f.user_keys, f.stations, drop_processed=True)
    kinds = {r.kind: r.n for r in counts.groupBy("kind").agg(F.sum("requests_count").alias("n")).collect()}
    day = f.api_logs.where(F.to_date("added_on") == "2024-01-10").count()
    assert kinds["total"] == kinds["status"] == kinds["resource"] == day > 0
    assert rest.count() == f.api_logs.count() - day
    odd = f.api_logs.limit(1).withColumn("added_on", F.lit(None).cast("timestamp"))
    kept = monitor.process_daily_logs(odd, "2024-01-10", f.agents, f.user_keys, f.stations, drop_processed=True)[1]
    assert kept.count() == 1
