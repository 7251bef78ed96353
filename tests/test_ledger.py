"""Recomputation, streams, schedules, islands, flags."""

import datetime as dt

import pytest
from conftest import stamps
from pyspark.sql import functions as F
from test_time import station

from airloom.functions import timeops
from airloom.operators import flags, ledger, rollups, schedules
from airloom.plans.frames import Frames
from airloom.sources import files
from airloom.streaming import arrivals

SF = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


CORE = ["sensors_id", "datetime", "value_count", "value_avg", "value_p50", "value_min", "value_max"]


def test_recompute_is_idempotent_and_partial(spark):
    f = Frames(spark, SF)
    facts, ctx = f.measurements.cache(), f.ctx
    book = ledger.add_periods(
        spark.createDataFrame([], ledger.ledger_schema("hour")), ledger.enumerate_periods(facts, ctx, "hour"), "2024-03-01"
    )
    empty = f.hourly.where(F.lit(False)).withColumn("calculated_on", F.lit(None).cast("timestamp"))
    target, book, parents = ledger.recompute(facts, ctx, empty, book, "hour", None, "2024-03-02")
    target, book = (spark.createDataFrame(df.collect(), df.schema) for df in (target, book))
    assert rows_of(target, *CORE) == rows_of(f.hourly, *CORE)
    assert ledger.stale_periods(book, "hour", None, as_of="2024-03-03").count() == 0
    again, _, none = ledger.recompute(facts, ctx, target, book, "hour", None, "2024-03-03")
    assert rows_of(again, *CORE) == rows_of(target, *CORE) and none.count() == 0

    # one late row: only its hour is stale, and only its sensor's offset
    sensor = ctx.join(facts, "sensors_id").select("sensors_id", "tzid").orderBy("sensors_id").first()
    late = stamps(spark, [(sensor.sensors_id, "2024-01-10 03:20:00", 5.0)], "sensors_id long, datetime string, value double", "datetime").withColumns(
        {"lon": F.lit(0.0), "lat": F.lit(0.0), "added_on": F.lit("2024-03-04").cast("timestamp")}
    )
    touched = late.select("datetime", timeops.offset_seconds("datetime", sensor.tzid).alias("offset_s"))
    marked = ledger.mark_modified(book, touched, "hour", "2024-03-04")
    stale = ledger.stale_periods(marked, "hour", None, as_of="2024-03-05").collect()
    assert len(stale) == 1
    fresh, _, days = ledger.recompute(facts.unionByName(late), ctx, target, marked, "hour", None, "2024-03-05")
    assert rows_of(fresh, *CORE) == rows_of(rollups.hourly_rollup(facts.unionByName(late), ctx), *CORE)
    assert fresh.where(F.col("calculated_on") == F.lit("2024-03-05").cast("timestamp")).count() >= 1
    assert days.count() == 1


def test_null_states_of_the_ledger(spark):
    def row(modified, queued, calculated):
        text = lambda v: None if v is None else dt.datetime.fromisoformat(v)
        return (dt.datetime(2024, 1, 1), 0, None, text(queued), text(modified), 0, text(calculated), 0, None, None, None, None)

    cases = [
        (row(None, None, None), True),
        (row(None, None, "2024-01-02"), False),
        (row("2024-01-03", None, "2024-01-02"), True),
        (row(None, "2024-01-09T09:30:00", None), False),
        (row(None, "2024-01-09T08:00:00", None), True),
        (row("2024-01-03", "2024-01-04", "2024-01-02"), True),
        (row("2024-01-03", "2024-01-04", "2024-01-05"), False),
    ]
    for case, stale in cases:
        df = spark.createDataFrame([case], ledger.ledger_schema("hour"))
        assert (ledger.stale_periods(df, "hour", 5, as_of="2024-01-09 10:00:00").count() == 1) is stale
    queued = spark.createDataFrame([row("2024-01-03", "2024-01-04", "2024-01-02")], ledger.ledger_schema("hour"))
    assert ledger.stale_periods(queued, "day", 5, upper="2024-02-01", as_of="2024-01-09").count() == 0


def test_clock_change_day_is_recomputed_from_either_side(spark):
    ctx = station(spark, ["America/Los_Angeles"])
    hours = [dt.datetime(2023, 3, 12, 8) + dt.timedelta(hours=h) for h in range(1, 24)]
    facts = spark.createDataFrame([(0, h, 1.0, 0.0, 0.0, h) for h in hours], "sensors_id long, datetime timestamp, value double, lon double, lat double, added_on timestamp")
    hourly = rollups.hourly_rollup(facts, ctx)
    for offset in (-28800, -25200):
        periods = spark.createDataFrame([(dt.date(2023, 3, 12), offset)], "datetime date, offset_s int")
        assert rollups.daily_rollup(hourly, ctx, periods=periods).first().value_count == 23
        year = spark.createDataFrame([(dt.date(2023, 1, 1), offset)], "datetime date, offset_s int")
        assert rollups.annual_rollup(hourly, ctx, periods=year).first().value_count == 23
    other = spark.createDataFrame([(dt.date(2023, 3, 12), 0)], "datetime date, offset_s int")
    assert rollups.daily_rollup(hourly, ctx, periods=other).count() == 0


def test_islands_of_days(spark):
    days = ["2022-01-01", "2022-01-02", "2022-01-03", "2022-01-08", "2022-01-09", "2022-01-10", "2022-02-03", "2022-02-02", "2022-02-03", "2022-04-02", "2022-04-03"]
    df = spark.createDataFrame([(d,) for d in days], "datetime string")
    runs = [(str(r.day_first), str(r.day_last)) for r in ledger.islands(df).orderBy("day_first").collect()]
    assert runs == [("2022-01-01", "2022-01-03"), ("2022-01-08", "2022-01-10"), ("2022-02-02", "2022-02-03"), ("2022-04-02", "2022-04-03")]


@pytest.mark.parametrize(
    "text, start, end, runs",
    [
        ("* * * * *", "2025-01-01 00:00", "2025-01-02 00:00", 1441),
        ("0 * * * *", "2025-01-01 00:00", "2025-01-02 00:00", 25),
        ("0 9 * * *", "2025-01-01 00:00", "2025-01-04 00:00", 3),
        ("*/5 * * * *", "2025-01-01 00:00", "2025-01-01 01:00", 13),
        ("0 0 * * 0", "2025-12-07 00:00", "2025-12-14 02:00", 2),
        ("0 9 1 * *", "2025-01-01 00:00", "2026-01-01 00:00", 12),
        ("0 0 * * 1-5", "2025-12-01 00:00", "2025-12-20 00:00", 15),
        ("0 0 1 * 1", "2025-12-01 00:00", "2025-12-31 00:00", 5),
        ("5/15 * * * *", "2025-01-01 00:00", "2025-01-01 05:59", 6),
        ("10-20/5,40 3 * 1,7 *", "2025-01-01 00:00", "2025-01-01 23:59", 4),
        ("*/61 * * * *", "2025-01-01 00:00", "2025-01-01 23:59", 24),
        ("*,5 * * * *", "2025-01-01 00:00", "2025-01-01 00:59", 1),
        ("1 2 3", "2025-01-01 00:00", "2025-01-02 00:00", 0),
    ],
)
def test_schedule_counts(spark, text, start, end, runs):
    df = spark.createDataFrame([(1, text)], "id int, schedule string")
    assert schedules.schedule_runs(df, start, end).count() == runs


def test_schedule_check(spark):
    good = ["* * * * *", "*/5 * * * *", "0 1,2 * * 2-4,6", "  0   0 * *  1-5 ", "3/4 * * * *", "*,5 * * * *"]
    bad = ["*/61 * * * *", "* */24 * * *", "* * */32 * *", "* * * */13 *", "* * * * */8", "0-30/5 * * * *", "1,*/5 * * * *", "5-1 * * * *", "60 * * * *", "a * * * *", "* * * *", "*/0 * * * *"]
    df = spark.createDataFrame([(t,) for t in good + bad], "schedule string")
    assert {r.schedule for r in schedules.invalid_schedules(df).collect()} == set(bad)


def test_flag_lists(spark):
    ctx = spark.createDataFrame([(3, 2), (4, 2), (5, 6)], "sensors_id long, sensor_nodes_id long")
    kinds = spark.createDataFrame([(1, "INFO"), (2, "ERROR")], "flag_types_id int, flag_level string")
    made = stamps(
        spark,
        [(2, [3, 4], 1, "2024-01-01", "2024-01-02"), (2, [], 2, "2024-02-01", "2024-02-02"), (2, None, 2, "2024-03-01", None), (2, [3], 1, "2024-04-01", "2024-04-02")],
        "sensor_nodes_id long, sensors_ids array<int>, flag_types_id int, valid_from string, valid_to string", "valid_from", "valid_to",
    )
    before = made.withColumn("valid_to", F.when(F.col("valid_from") == F.lit("2024-03-01").cast("timestamp"), F.lit("2024-03-02").cast("timestamp")).otherwise(F.col("valid_to")))
    asks = stamps(
        spark,
        [(f"{m}-{s}", 2, s, f"2024-0{m}-01 12:00:00") for m in (1, 2, 3, 4, 5) for s in (3, 4, None)],
        "id string, sensor_nodes_id long, sensors_id long, datetime string", "datetime",
    )

    def found(scope, match, level=None):
        rows = flags.flags_exist(asks, before, kinds, ctx, scope, level, match=match).collect()
        assert len(rows) == 15
        return {r.id for r in rows if r.flagged}

    every = {f"{m}-{s}" for m in (1, 2, 3, 4) for s in (3, 4, None)}
    assert found("node", "any") == every
    assert found("both", "any") == {"1-3", "1-4", "3-None", "4-3"}
    # an empty list answers every sensor; a list of two never does
    assert found("both", "reference") == {"2-3", "2-4", "2-None", "3-None", "4-3"}
    assert found("sensor", "any") == {"1-3", "1-4", "3-3", "3-4", "4-3"}
    assert found("sensor", "reference") == {"2-3", "2-4", "3-3", "3-4", "4-3"}
    assert found("node", "any", "ERROR") == {f"{m}-{s}" for m in (2, 3) for s in (3, 4, None)}
    # window closed, period half-open: an end at the window's start does not count, a start at its end does
    edge = stamps(spark, [(1, 2, "2024-04-02 01:00:00"), (2, 2, "2024-04-01 00:00:00")], "id int, sensor_nodes_id long, datetime string", "datetime").withColumn("sensors_id", F.lit(None).cast("long"))
    assert {r.id: r.flagged for r in flags.flags_exist(edge, before, kinds, ctx).collect()} == {1: False, 2: True}
    assert flags.flags_exist(edge, made, kinds, ctx).where("flagged").count() == 2


def test_stream_equals_batch(spark, tmp_path):
    f = Frames(spark, SF)
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    half = F.col("sensors_id") % 2 == 0
    f.measurements.where(half).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(f.measurements.schema).option("maxFilesPerTrigger", 1).parquet(source)
    clock = lambda i: f"2024-03-{1 + i:02d} 00:00:00"

    def run():
        query = arrivals.stream_hourly(stream(), f.ctx, root, str(tmp_path / "ckpt"), clock)
        assert query.awaitTermination(240)

    run()
    f.measurements.coalesce(1).write.mode("append").parquet(source)  # the other half, and repeats
    run()
    store = arrivals.Store(root)
    assert rows_of(spark.read.parquet(store.data("hour")), *CORE) == rows_of(f.hourly, *CORE)
    day = spark.read.parquet(store.data("day"))
    assert rows_of(day, *CORE) == rows_of(f.daily, *CORE)
    assert rows_of(spark.read.parquet(store.data("year")), *CORE) == rows_of(rollups.annual_rollup(f.hourly, f.ctx), *CORE)
    assert spark.read.parquet(store.facts()).count() == f.measurements.count()
    book = files.read_snapshot(spark, store.ledger("hour"))
    assert ledger.stale_periods(book, "hour", None, upper="9999-01-01", as_of="2024-04-01").count() == 0
    assert book.agg(F.sum("measurements_count")).first()[0] == f.measurements.join(f.ctx, "sensors_id").count()


def test_append_stream_dedupe_and_state(spark, tmp_path):
    f = Frames(spark, SF)
    source = str(tmp_path / "in")
    f.measurements.unionByName(f.measurements).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(f.measurements.schema).parquet(source)

    def drain(df, name):
        query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert query.awaitTermination(240)
        return spark.table(name)

    assert drain(arrivals.stream_distinct(stream), "distinct_rows").count() == f.measurements.count()
    once = spark.readStream.schema(f.measurements.schema).parquet(source)
    hours = drain(arrivals.stream_hourly_append(once, f.ctx), "hours")
    want = {(r.sensors_id, r.datetime): 2 * r.value_count for r in f.hourly.collect()}
    got = {(r.sensors_id, r.hour): r.value_count for r in hours.collect()}
    assert got and all(want[k] == v for k, v in got.items())
    runs = drain(arrivals.stream_sessions(spark.readStream.schema(f.measurements.schema).parquet(source)), "sessions")
    want = {tuple(r) for r in arrivals.stream_sessions(f.measurements.unionByName(f.measurements)).collect()}
    closed = f.measurements.agg(F.max("datetime") - F.expr("interval 1 day")).first()[0]
    got = {tuple(r) for r in runs.collect()}
    assert got <= want and {w for w in want if w[2] < closed} <= got and got

    cut = F.col("datetime") < F.lit("2024-01-15").cast("timestamp")
    empty = spark.createDataFrame([], "sensors_id long, datetime_first timestamp, datetime_last timestamp, value_count long, n long, mean double, m2 double, value_min double, value_max double, value_latest double")
    state = arrivals.merge_lifetime(arrivals.merge_lifetime(empty, f.measurements.where(cut)), f.measurements.where(~cut))
    for r in state.join(f.lifetime.alias("w"), "sensors_id").select("*", F.col("w.value_avg").alias("avg"), F.col("w.value_sd").alias("sd"), F.col("w.value_count").alias("c")).collect():
        assert r.c == r[3] and (r.avg is None or abs(r.mean - r.avg) < 1e-9)
        assert r.sd is None or abs((r.m2 / (r.n - 1)) ** 0.5 - r.sd) < 1e-9
    late = arrivals.late_rows(f.measurements.where(cut), f.lifetime, 86400)
    assert late.count() > 0


def _scan_filters(df) -> str:
    """Partition and data filters of the file scans of a plan, as it is before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(line for line in plan.splitlines() if "FileScan" in line)


def test_incremental_paths_open_few_months(spark, tmp_path, monkeypatch):
    f, path = Frames(spark, SF), str(tmp_path / "facts")
    files.write_measurements(f.measurements_long, path)
    all_months = files.months_of(f.measurements_long)
    few = f.measurements_long.where(F.col("datetime").between("1996-03-05", "1996-04-20"))
    assert len(all_months) > 50 and files.months_of(few) == [199603, 199604]
    filters = _scan_filters(files.read_months(spark, path, files.months_of(few)))
    assert "PartitionFilters: [ym" in filters and "199603,199604" in filters
    opened = []
    read = files.read_months
    monkeypatch.setattr(files, "read_months", lambda s, p, months: opened.append(list(months)) or read(s, p, months))
    files.load_indirect(spark, few, path)
    files.upsert_months(spark, few.withColumn("value", F.lit(-1.0)), path, ["sensors_id", "datetime"])
    assert opened == [[199603, 199604]] * 2
    back = spark.read.parquet(path)
    assert back.count() == f.measurements_long.count() and back.where("value = -1").count() == few.count()

    periods = spark.createDataFrame([("1996-03-10 05:00:00", 0)], "t string, offset_s int").select(F.col("t").cast("timestamp").alias("datetime"), "offset_s")
    for level, wanted in (("hour", {199603}), ("day", {199603}), ("year", None)):
        pruned = rollups.within_periods(back, periods, level)
        assert "PartitionFilters: [isnotnull(ym" in _scan_filters(pruned) and "subquery" in _scan_filters(pruned)
        months = set(files.months_of(pruned))
        assert months and months < set(all_months) and (wanted is None or months <= wanted)
    days = spark.createDataFrame([("1996-03-31", 0), ("1998-01-01", 0)], "t string, offset_s int").select(F.col("t").cast("date").alias("datetime"), "offset_s")
    assert arrivals._months_around(days, "day") == [199603, 199604, 199712, 199801]
    assert arrivals._months_around(days.limit(1), "year") == [199512, *range(199601, 199613), 199701]


def test_snapshots_are_found_by_their_own_success(spark, tmp_path):
    path = str(tmp_path / "book")
    for i in range(6):
        files.publish(spark.range(i + 1), path, keep=2)
        assert files.read_snapshot(spark, path).count() == i + 1
    assert len(files.snapshots(spark, path)) == 3
    (tmp_path / "book" / "v_999999999999_unfinished").mkdir()
    assert files.read_snapshot(spark, path).count() == 6
