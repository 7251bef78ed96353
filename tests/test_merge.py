"""Merging sensors without loss, and nodes without a zone."""

import pytest
from conftest import stamps
from pyspark.sql import functions as F

from airloom.functions import textops
from airloom.operators import catalog, flags, ingest, rollups, spatial
from airloom.operators.context import station_chain, station_context

DAY = "2024-01-01 0{}:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    sensors = spark.createDataFrame([(i, i, 1, True) for i in range(1, 41)], "sensors_id long, sensor_systems_id long, measurands_id int, is_public boolean")
    systems = sensors.select("sensor_systems_id", (F.col("sensor_systems_id") % 4 + 1).alias("sensor_nodes_id"))
    nodes = spark.createDataFrame(
        [(1, 1, 7, 9, True), (2, 1, 7, 9, True), (3, None, 7, 9, True), (4, None, 8, 9, True)],
        "sensor_nodes_id long, timezones_id int, providers_id int, countries_id int, is_public boolean",
    )
    return sensors, systems, nodes, spark.createDataFrame([(1, "UTC")], "timezones_id int, tzid string")


def facts(spark, rows):
    made = [(s, DAY.format(h), v, 1.0, 2.0, DAY.format(h)) for s, h, v in rows]
    return stamps(spark, made, "sensors_id long, datetime string, value double, lon double, lat double, added_on string", "datetime", "added_on")


def merged(spark, tables, rows, pairs):
    pairs = spark.createDataFrame(pairs, "bad_sensors_id long, good_sensors_id long")
    return ingest.merge_sensors(facts(spark, rows), pairs, station_context(*tables), "2024-02-01")


def state(df):
    return sorted((r.sensors_id, r.datetime.hour, r.value) for r in df.collect())


CASES = [
    ("same sensor", [(5, 1, 1.0), (5, 2, 2.0)], [(5, 5)], {(5, 5, "same sensor", 0)}),
    ("missing id", [(5, 1, 1.0)], [(5, None), (None, 5)], {(5, None, "missing id", 0), (None, 5, "missing id", 0)}),
    ("several targets", [(5, 1, 1.0), (6, 2, 1.0)], [(5, 6), (5, 7)], {(5, 6, "several targets", 0), (5, 7, "several targets", 0)}),
    ("sources clash", [(10, 1, 7.0), (15, 1, 9.0), (10, 2, 1.0)], [(10, 20), (15, 20)], {(10, 20, "values differ", 1), (15, 20, "values differ", 1)}),
    ("target clashes", [(10, 1, 7.0), (20, 1, 9.0)], [(10, 20)], {(10, 20, "values differ", 1)}),
]


@pytest.mark.parametrize("name,rows,pairs,refused", CASES, ids=[c[0] for c in CASES])
def test_refused_pairs_move_nothing(spark, tables, name, rows, pairs, refused):
    made = merged(spark, tables, rows, pairs)
    assert {tuple(r) for r in made.refused.collect()} == refused
    assert state(made.measurements) == sorted(rows)
    assert made.archive.count() == made.allowed.count() == made.touched.count() == 0


def test_a_chain_is_cut_at_its_end(spark, tables):
    made = merged(spark, tables, [(1, 1, 1.0), (2, 2, 2.0), (3, 3, 3.0)], [(1, 2), (2, 3)])
    assert {tuple(r) for r in made.refused.collect()} == {(1, 2, "target is merged itself", 0)}
    assert state(made.measurements) == [(1, 1, 1.0), (3, 2, 2.0), (3, 3, 3.0)]
    assert {tuple(r) for r in made.allowed.collect()} == {(2, 3)}


def test_sources_that_agree_merge_into_one(spark, tables):
    rows = [(10, 1, 7.0), (15, 1, 7.0), (10, 2, None), (15, 2, 4.0), (10, 3, 5.0), (20, 3, None), (20, 4, 6.0)]
    made = merged(spark, tables, rows, [(10, 20), (10, 20), (15, 20)])
    assert made.refused.count() == 0
    # a value is taken before none; the target's own row stays
    assert state(made.measurements.where("value IS NOT NULL")) == [(20, 1, 7.0), (20, 2, 4.0), (20, 4, 6.0)]
    assert made.measurements.count() == 4 and made.archive.count() == 5
    left, counts = ingest.remove_merged(made, {"sensors": tables[0]})
    assert left["sensors"].where("sensors_id IN (10, 15)").count() == 0 and counts.first().removed == 2


def test_nodes_without_zone_count_where_no_zone_is_needed(spark, tables):
    chain, zoned = station_chain(*tables[:3]), station_context(*tables)
    assert chain.count() == 40 and zoned.count() == 20
    rows = facts(spark, [(i, 1, float(i)) for i in range(1, 9)])
    assert {r.sensor_nodes_id for r in spatial.last_point(rows, chain).collect()} == {1, 2, 3, 4}
    assert {r.sensor_nodes_id for r in spatial.mobile_generalized(rows, rows.limit(0), chain).collect()} == {1, 2, 3, 4}
    assert rollups.providers_stats(rows, chain).agg(F.countDistinct("providers_id")).first()[0] == 2
    assert rollups.hourly_rollup(rows, zoned).count() == 4
    asked = stamps(spark, [(2, "2024-01-01 01:30:00")], "sensors_id long, datetime string", "datetime").withColumn("sensor_nodes_id", F.lit(3).cast("long"))
    flagged = stamps(spark, [(3, 1, "2024-01-01 00:00:00", None)], "sensor_nodes_id long, flag_types_id int, valid_from string, valid_to string", "valid_from", "valid_to")
    flagged = flagged.withColumn("sensors_ids", F.lit(None).cast("array<long>"))
    kinds = spark.createDataFrame([(1, "INFO")], "flag_types_id int, flag_level string")
    assert flags.flags_exist(asked, flagged, kinds, chain, "sensor").first().flagged


def test_json_members_keep_their_types(spark):
    df = spark.createDataFrame([(1, 1, '{"a": 1, "b": "1", "c": [1, {"x": "y"}]}'), (1, 2, '{"a": {"z": 1.5}, "n": null}'), (2, 1, None)], "k int, o int, j string")
    made = {r.k: r.m for r in ingest.merge_json(df, ["k"], "j", F.col("o"), "m").collect()}
    assert made == {1: '{"a":{"z":1.5},"b":"1","c":[1,{"x":"y"}],"n":null}'}
    text = textops.members_text(textops.members_without_null(textops.json_members(F.col("j"))))
    assert df.where("o = 2").select(text).first()[0] == '{"a":{"z":1.5}}'
    source = catalog.source_json(F.lit("s"), F.lit("n"), F.lit(None).cast("string"), F.lit('{"name": "m", "rank": 3}'))
    assert spark.range(1).select(source).first()[0] == '{"id":"s","name":"m","rank":3}'


def test_a_merge_reads_its_measurements_once_a_pass(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.sql("SELECT id AS sensors_id, timestamp_seconds(id) AS datetime, 1.0D AS value FROM range(9)").write.parquet(path)
    pairs = spark.createDataFrame([(1, 2), (3, 4)], "bad_sensors_id long, good_sensors_id long")
    allowed, _ = ingest.check_merges(spark.read.parquet(path), pairs)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(allowed) == 1
