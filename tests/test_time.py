"""Time-ending labels, offsets, and clock changes."""

import datetime as dt

import pytest
from conftest import stamps
from pyspark.sql import functions as F

from airloom.functions import numeric, textops, timeops
from airloom.operators import monitor, rollups
from airloom.operators.context import station_context


def one(spark, column, **literals):
    df = spark.range(1)
    for name, value in literals.items():
        df = df.withColumn(name, F.lit(value).cast("timestamp") if isinstance(value, str) and value[:4].isdigit() else F.lit(value))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "at, zone, label",
    [
        ("2024-01-10 10:00:00", "UTC", "2024-01-10 10:00:00"),
        ("2024-01-10 10:00:01", "UTC", "2024-01-10 11:00:00"),
        ("2024-01-10 10:00:00.5", "UTC", "2024-01-10 10:00:00"),
        ("2024-01-10 00:30:00.5", "Asia/Kolkata", "2024-01-10 00:30:00"),
        ("2024-01-10 00:30:01", "Asia/Kolkata", "2024-01-10 01:30:00"),
        ("2024-01-10 00:15:00", "Asia/Kathmandu", "2024-01-10 00:15:00"),
        ("2024-01-10 00:16:00", "Asia/Kathmandu", "2024-01-10 01:15:00"),
        # both UTC hours of a fall-back keep their own label
        ("2023-11-05 08:30:00", "America/Los_Angeles", "2023-11-05 09:00:00"),
        ("2023-11-05 09:30:00", "America/Los_Angeles", "2023-11-05 10:00:00"),
        ("2023-03-12 10:30:00", "America/Los_Angeles", "2023-03-12 11:00:00"),
    ],
)
def test_hour_label(spark, at, zone, label):
    offset = timeops.offset_seconds("t", zone)
    got = one(spark, timeops.hour_end("t", offset).cast("string"), t=at)
    assert got == label


@pytest.mark.parametrize(
    "at, zone, day",
    [
        ("2024-01-10 00:00:00", "UTC", "2024-01-09"),
        ("2024-01-10 00:00:01", "UTC", "2024-01-10"),
        ("2024-01-09 11:00:00", "Pacific/Auckland", "2024-01-09"),
        ("2024-01-09 11:00:01", "Pacific/Auckland", "2024-01-10"),
        ("2024-01-01 08:00:00", "America/Los_Angeles", "2023-12-31"),
        ("2023-11-06 08:00:00", "America/Los_Angeles", "2023-11-05"),
    ],
)
def test_local_date(spark, at, zone, day):
    assert str(one(spark, timeops.local_date("t", zone), t=at)) == day


def test_offsets_and_formats(spark):
    assert one(spark, timeops.offset_seconds("t", "Asia/Kathmandu"), t="2024-01-01") == 20700
    assert one(spark, timeops.offset_hours("t", "America/St_Johns"), t="2024-01-01") == -3
    assert one(spark, timeops.iso_local("t", "America/St_Johns"), t="2024-01-01 12:00:00") == "2024-01-01T08:30:00-03:30"
    assert one(spark, timeops.iso_local("t", F.lit(None).cast("string")), t="2024-01-01") == "2024-01-01T00:00:00+00:00"
    assert one(spark, timeops.datetime_object(F.lit(None).cast("timestamp"), "UTC")) is None


def test_text_and_numbers(spark):
    text = lambda s: one(spark, textops.slugify(F.lit(s)))
    assert text('Été "à" São--Paulo!') == "ete-a-sao-paulo"
    assert text("-a-") == "a" and text("---a--") == "a"
    assert one(spark, numeric.sig_digits(F.lit(0.0), 3)) == 0
    assert one(spark, numeric.sig_digits(F.lit(-0.0123456), 3)) == pytest.approx(-0.0123)
    assert one(spark, numeric.sig_digits(F.lit(123456.0), 2)) == 120000
    parts = spark.range(1).select(textops.split_ingest_id(F.lit("a-b-c-d")).alias("p")).first().p
    assert tuple(parts) == ("a", "b-c", "d")
    assert tuple(spark.range(1).select(textops.split_ingest_id(F.lit("a-b")).alias("p")).first().p) == ("a", "N/A", "b")
    cells = textops.array_to_json_elements(F.array(F.lit("a"), F.lit('b"c'), F.lit(None).cast("string")))
    assert one(spark, cells) == ['"a"', '"b\\"c"', "null"]
    assert one(spark, textops.json_elements(F.lit('[1, "x", {"k": null}]'))) == ["1", '"x"', '{"k":null}']
    january = numeric.expected_hours(F.col("a"), F.col("b"), F.lit("month"), F.lit("01"))
    assert one(spark, january, a="2022-01-01 00:00:00", b="2024-01-01 00:00:00") == 2 * 31 * 24
    assert one(spark, numeric.expected_hours(F.col("a"), F.col("b"), F.lit("day"), F.lit("1")), a="2024-01-01", b="2024-01-15") == 48


def station(spark, zones):
    """One node, system and sensor per zone."""
    n = len(zones)
    return station_context(
        spark.createDataFrame([(i, i, 1, True) for i in range(n)], "sensors_id long, sensor_systems_id long, measurands_id int, is_public boolean"),
        spark.createDataFrame([(i, i) for i in range(n)], "sensor_systems_id long, sensor_nodes_id long"),
        spark.createDataFrame([(i, i, 1, 1, True) for i in range(n)], "sensor_nodes_id long, timezones_id int, providers_id int, countries_id int, is_public boolean"),
        spark.createDataFrame([(i, z) for i, z in enumerate(zones)], "timezones_id int, tzid string"),
    )


ZONES = ["America/Los_Angeles", "Asia/Kolkata", "Asia/Kathmandu", "UTC", "Pacific/Auckland", "Pacific/Tongatapu", "Europe/London"]


@pytest.mark.parametrize("start, days", [("2023-03-10", 5), ("2023-11-03", 5), ("2023-03-24", 4)])
def test_calendar_series(spark, start, days):
    """A value equal to its local day gives day averages equal to the day number."""
    ctx = station(spark, ZONES)
    first = dt.datetime.fromisoformat(start)
    rows = [
        (i, first + dt.timedelta(minutes=15 * k)) for i in range(len(ZONES)) for k in range(1, days * 96 + 1)
    ]
    facts = spark.createDataFrame(rows, "sensors_id long, datetime timestamp").join(ctx.select("sensors_id", "tzid"), "sensors_id")
    facts = facts.select(
        "sensors_id", "datetime", F.dayofmonth(timeops.local_date("datetime", F.col("tzid"))).cast("double").alias("value"),
        F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"), F.col("datetime").alias("added_on"),
    ).cache()
    hourly = rollups.hourly_rollup(facts, ctx)
    daily = rollups.daily_rollup(hourly, ctx).collect()
    assert daily and all(r.value_avg == r.datetime.day and r.value_p02 == r.value_p98 for r in daily)
    assert sum(r.value_raw_count for r in daily) == len(rows)
    assert all(r.matches for r in rollups.rollup_reconcile(facts, hourly, rollups.daily_rollup(hourly, ctx), ctx).collect())
    sites = ctx.select("sensors_id", "tzid", F.col("tzid").alias("site_name"))
    local = monitor.canary_days(facts, sites, "local").collect()
    assert all(r.value_avg == r.day.day for r in local)


def test_empty_and_null_hours(spark):
    ctx = station(spark, ["UTC"])
    facts = stamps(
        spark,
        [(0, "2024-01-01 00:10:00", None), (0, "2024-01-01 00:20:00", None), (0, "2024-01-01 01:10:00", 4.0), (9, "2024-01-01 01:10:00", 1.0)],
        "sensors_id long, datetime string, value double", "datetime",
    ).withColumns({"lon": F.lit(0.0), "lat": F.lit(0.0), "added_on": F.col("datetime")})
    hourly = rollups.hourly_rollup(facts, ctx).orderBy("datetime").collect()
    assert [(r.value_count, r.value_avg, r.value_sd, r.value_p50, r.error_count) for r in hourly] == [
        (2, None, None, None, 2), (1, 4.0, None, 4.0, 0)
    ]
    day = rollups.daily_rollup(rollups.hourly_rollup(facts, ctx), ctx).collect()
    assert len(day) == 1 and day[0].value_count == 2 and day[0].error_count == 1 and day[0].value_raw_count == 3
    assert day[0].value_raw_avg == pytest.approx(4 / 3)
    assert rollups.daily_rollup(rollups.hourly_rollup(facts.limit(0), ctx), ctx).count() == 0
    assert rollups.rollup_counts(rollups.hourly_rollup(facts.limit(0), ctx)).first().sensors_count == 0
