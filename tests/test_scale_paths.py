"""Ways that only large groups take, forced on small ones and compared with the plain way."""

import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airloom.functions import numeric
from airloom.operators import catalog, context, intervals, monitor, ranking, rollups, spatial
from airloom.plans import queries_catalog
from airloom.plans.frames import Frames
from airloom.session import configure


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows under key 0, many equal values."""
    rnd = random.Random(7)
    rows = [(None if i % 17 == 1 else 0 if i % 3 == 0 else rnd.randrange(1, 40), rnd.choice([None, *range(300)]), i) for i in range(6000)]
    return spark.createDataFrame(rows, "k int, v int, id long").cache()


@pytest.mark.parametrize("up", [True, False])
def test_spread_row_number(hot, up):
    order = F.col("v").asc_nulls_first() if up else F.col("v").desc_nulls_last()
    plain = hot.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(order, "id")).cast("bigint"))
    cut = ranking.spread_row_number(hot, ["k"], [("v", up), ("id", True)], "r", chunk_rows=50)
    assert sorted(map(tuple, plain.collect()), key=lambda r: r[2]) == sorted(map(tuple, cut.collect()), key=lambda r: r[2])
    chunks = ranking._chunked(hot, ["k"], [("v", up), ("id", True)], 50).where("k = 0").select("_chunk").distinct().count()
    assert chunks > 1


def test_a_constant_first_column_is_cut_as_well(hot):
    same = hot.withColumn("c", F.lit(1))
    chunks = ranking._chunked(same, ["k"], [("c", True), ("id", False)], 50)
    assert chunks.where("k = 0").select("_chunk").distinct().count() > 10
    made = ranking.spread_row_number(same, ["k"], [("c", True), ("id", False)], "r", chunk_rows=50)
    plain = same.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("c", F.desc("id"))).cast("bigint"))
    assert {(r.id, r.r) for r in made.collect()} == {(r.id, r.r) for r in plain.collect()}


def test_spread_lag(hot):
    plain = hot.withColumn("prev_id", F.lag("id").over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), "id")))
    cut = ranking.spread_lag(hot, ["k"], ["v", "id"], ["id"], chunk_rows=50)
    assert set(map(tuple, plain.select("id", "prev_id").collect())) == set(map(tuple, cut.select("id", "prev_id").collect()))


@pytest.mark.parametrize("keys", [["k"], []])
def test_exact_percentiles(hot, keys):
    probs = {"a": 0.0, "b": 0.02, "c": 0.5, "d": 0.9731, "e": 1.0}
    few = numeric.exact_percentiles(hot, keys, "v", probs, slices=16)
    plain = (hot.groupBy(*keys) if keys else hot.groupBy()).agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    assert {tuple(x if x is None else round(x, 9) for x in r) for r in few.collect()} == {tuple(x if x is None else round(x, 9) for x in r) for r in plain.collect()}


@pytest.mark.parametrize("chunk", [60, 7200, 86400 * 30])
def test_overlap_marks(spark, chunk):
    rnd = random.Random(3)
    base = 1_700_000_000
    periods = [(rnd.randrange(3), base + rnd.randrange(90_000), rnd.randrange(1, 4000), rnd.random() < 0.05, rnd.choice("AB")) for _ in range(60)]
    asked = [(i, rnd.choice([0, 1, 2, None]), base + rnd.randrange(95_000)) for i in range(400)]
    p = spark.createDataFrame(periods, "k int, s long, d long, o boolean, c string").select(
        "k", F.timestamp_seconds("s").alias("start"), F.when(~F.col("o"), F.timestamp_seconds(F.col("s") + F.col("d"))).alias("end"), "c"
    )
    q = spark.createDataFrame(asked, "id int, k int, t long").select(
        "id", "k", F.timestamp_seconds(F.col("t") - 600).alias("low"), F.timestamp_seconds("t").alias("high")
    )
    got = intervals.overlap_marks(q, p, ["k"], "low", "high", "start", "end", {"any": F.lit(True), "a": F.col("c") == "A"}, chunk_s=chunk)
    found = {r.id: (r.any, r.a) for r in got.collect()}

    def brute(k, t, kind):
        return any(pk == k and s <= t and (o or s + d > t - 600) and c in kind for pk, s, d, o, c in periods)

    assert found == {i: (brute(k, t, "AB"), brute(k, t, "A")) for i, k, t in asked}
    assert any(v[0] for v in found.values()) and not all(v[0] for v in found.values())


def test_patterns_in_blocks(spark):
    texts = spark.createDataFrame([(f"agent/{i}",) for i in range(30)], "agent string")
    patterns = spark.createDataFrame([(i, f"/{i % 7}$") for i in range(20)] + [(99, "^agent/2")], "agents_id int, pattern string")
    found = {r.agent: r.agents_id for r in monitor.first_pattern(texts, patterns, "agent", "agents_id", block=3).collect()}
    want = {f"agent/{i}": (i if i < 7 else 99 if str(i).startswith("2") else None) for i in range(30)}
    assert found == want


def test_rollup_above_the_broadcast_bound(spark, monkeypatch):
    f = Frames(spark, "/root/testdata/sf0.001")
    small = rollups.hourly_rollup(f.measurements, f.ctx)
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(context, "BROADCAST_SENSORS", 10)
    g = Frames(spark, "/root/testdata/sf0.001")
    large = rollups.hourly_rollup(g.measurements, g.ctx)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert set(map(tuple, small.collect())) == set(map(tuple, large.collect()))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_generators(plan):
    """Broadcasts of a plan that hold rows which an explode has multiplied."""
    lines, found = plan.splitlines(), 0
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = itertools.takewhile(lambda x: depth(x) > depth(line), lines[i + 1 :])
            found += any("Generate explode" in x for x in below)
    return found


def test_versions_are_not_joined_by_broadcasts_of_sensors(spark):
    f = Frames(spark, "/root/testdata/sf0.001")
    plan = executed(catalog.versions_view(queries_catalog._ranks(f), f.sensors, f.sensor_systems))
    assert "Generate explode" in plan and broadcast_generators(plan) == 0


def test_station_context_is_not_joined_by_broadcasts_of_sensors(spark):
    f = Frames(spark, "/root/testdata/sf0.001")
    plan = executed(f.ctx)
    assert "Generate explode" in plan and broadcast_generators(plan) == 0
    assert context.broadcast_if_few(f.countries, f.countries, 3)._jdf.queryExecution().analyzed().toString().startswith("ResolvedHint (strategy=merge)")


def test_sensors_of_lifetime_rollups_are_not_broadcast(spark):
    f = Frames(spark, "/root/testdata/sf0.001")
    plan = executed(rollups.sensor_rollups_summary(f.lifetime, f.sensors, f.measurands))
    assert "Generate explode" in plan and "SortMergeJoin [sensors_id" in plan and "BroadcastHashJoin [sensors_id" not in plan


def test_group_members_by_class_name_and_box(spark):
    rnd = random.Random(5)
    pick = lambda n: rnd.choice([None, *range(n)])
    places = [(i, pick(4), pick(3), pick(3), rnd.choice([None, rnd.uniform(-180, 180), 30.0]), rnd.uniform(-90, 90)) for i in range(400)]
    rules, box = [], lambda: (x := rnd.uniform(-180, 100), y := rnd.uniform(-90, 20), x + rnd.uniform(-5, 90), y + 70.0)[0:4]
    for g in range(60):
        for kind in rnd.sample(["countries_id", "providers_id", "users_id", "sensor_nodes_id", "geom", "geom", "other"], rnd.randint(1, 3)):
            ids = rnd.sample(range(400), 150) if kind == "sensor_nodes_id" else [0, rnd.randrange(4), rnd.randrange(4)]
            rules.append((g, kind, None if kind == "geom" or rnd.random() < 0.05 else ids, box() if kind == "geom" and rnd.random() > 0.05 else None))
    rules.append((99, "geom", None, (30.0, -90.0, 30.0, 90.0)))
    columns = {"countries_id": 1, "providers_id": 2, "users_id": 3, "sensor_nodes_id": 0}

    def meets(place, kind, ids, b):
        if kind == "geom":
            return b is not None and place[4] is not None and b[0] <= place[4] <= b[2] and b[1] <= place[5] <= b[3]
        return kind in columns and ids is not None and place[columns[kind]] in ids

    want = {(g, p[0]) for g in {r[0] for r in rules} for p in places if all(meets(p, *r[1:]) for r in rules if r[0] == g)}
    asked = spark.createDataFrame(rules, "groups_id int, kind string, ids array<bigint>, box struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    there = spark.createDataFrame(places, "id long, countries_id int, providers_id int, owner_id int, lon double, lat double")
    made = catalog.group_members(asked, there)
    got = list(map(tuple, made.collect()))
    assert len(got) == len(set(got)) and set(got) == want and len({g for g, _ in want}) > 10
    f = Frames(spark, "/root/testdata/sf0.001")
    owned = f.sensor_nodes.withColumnsRenamed({"sensor_nodes_id": "id", "owner_entities_id": "owner_id"})
    assert broadcast_generators(executed(catalog.group_members(queries_catalog._group_rules(f), owned))) == 0


def test_group_members_take_little_space(spark, tmp_path):
    """The result is groups times locations: files must not hold every pair at full length."""
    rows = [(i, 1, 1, None, float(i * 37 % 360 - 180), float(i * 13 % 160 - 80)) for i in range(100)]
    places = spark.createDataFrame(rows, "id long, countries_id int, providers_id int, owner_id int, lon double, lat double")
    asked = spark.range(40_000).selectExpr(
        "cast(id as int) groups_id", "'providers_id' kind", "array(1L, id) ids",
        "cast(null as struct<xmin:double,ymin:double,xmax:double,ymax:double>) box",
    )
    catalog.group_members(asked, places).write.parquet(f"{tmp_path}/members")
    made = spark.read.parquet(f"{tmp_path}/members")
    assert made.count() == 4_000_000 and made.select("sensor_nodes_id").distinct().count() == 100
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 2_000_000


def test_a_box_without_an_edge_is_met_by_nothing(spark):
    places = spark.createDataFrame([(1, 1, 1, 1, 5.0, 5.0)], "id long, countries_id int, providers_id int, owner_id int, lon double, lat double")
    shut, open_ = (0.0, 0.0, 9.0, 9.0), (0.0, 0.0, None, 9.0)
    rules = [(1, "geom", None, shut), (1, "geom", None, open_), (2, "countries_id", [1], None), (2, "geom", None, open_),
             (3, "countries_id", [1], None), (3, "geom", None, shut), (4, "geom", None, shut), (4, "geom", None, (4.0, 4.0, 20.0, 20.0)),
             (5, "sensor_nodes_id", [1], None), (5, "geom", None, (6.0, 6.0, 20.0, 20.0))]
    asked = spark.createDataFrame(rules, "groups_id int, kind string, ids array<bigint>, box struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    assert sorted(map(tuple, catalog.group_members(asked, places).collect())) == [(3, 1), (4, 1)]


def test_task_sizes_are_bounded_unless_named(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert configure(spark).conf.get(key) == "16m" and spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
        spark.conf.set(key, "8m")
        assert configure(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before or "16m")


def test_zone_outside_the_usual_list(spark, monkeypatch):
    f = Frames(spark, "/root/testdata/sf0.001")
    want = set(map(tuple, rollups.hourly_rollup(f.measurements, f.ctx).collect()))
    monkeypatch.setattr(context, "_FEW", 1)
    monkeypatch.setattr(context, "_MANY", 2)
    g = Frames(spark, "/root/testdata/sf0.001")
    assert set(map(tuple, rollups.hourly_rollup(g.measurements, g.ctx).collect())) == want
    assert len(context._usual_zones(g.ctx)) == 2


def test_plans_stay_on_the_engine(spark):
    """No Python evaluation, no nested loop join, pruned columns in the flagship plan."""
    f = Frames(spark, "/root/testdata/sf0.001")
    plan = rollups.daily_rollup(rollups.hourly_rollup(f.measurements, f.ctx), f.ctx)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


# ---- polygons -------------------------------------------------------------------------------------


def inside(ring_list, x, y):
    odd = False
    for ring in ring_list:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


SHAPES = {
    1: [[(0.0, 0.0), (10.0, 0.5), (12.3, 9.1), (4.2, 5.5), (-3.1, 11.7)]],
    2: [[(20.0, 20.0), (20.0, 30.0), (30.0, 30.0), (30.0, 20.0)], [(23.0, 23.0), (27.0, 23.0), (27.0, 27.0), (23.0, 27.0)]],
    3: [[(-20.5, -20.5), (-15.25, -18.0), (-17.0, -10.0)], [(5.0, -30.0), (8.0, -30.0), (8.0, -22.0)]],
    4: [[(2.0, 2.0), (2.0, 8.0), (8.0, 8.0), (8.0, 2.0)]],
}


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(k, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for k, rings in SHAPES.items()]
    return spark.createDataFrame(rows, "pid int, rings array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("cell", [1.0, 0.7, 13.0])
def test_assign_polygon(spark, shapes, cell):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(-25, 35), rnd.uniform(-35, 35)) for i in range(1500)]
    points = spark.createDataFrame(pts, "id int, lon double, lat double")
    got = {r.id: r.pid for r in spatial.assign_polygon(points, shapes, "pid", cell).collect()}
    want = {i: min((k for k, s in SHAPES.items() if inside(s, x, y)), default=None) for i, x, y in pts}
    assert got == want and len(set(got.values())) == 5


def test_polygon_border_counts(spark, shapes):
    points = spark.createDataFrame(
        [(1, 20.0, 25.0), (2, 30.0, 30.0), (3, 25.0, 23.0), (4, 25.0, 25.0), (5, 30.0001, 25.0), (6, None, 1.0)], "id int, lon double, lat double"
    )
    got = {r.id: r.pid for r in spatial.assign_polygon(points, shapes, "pid", 5.0).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: None, 5: None, 6: None}


def test_nearest_polygon(spark, shapes):
    rnd = random.Random(5)
    pts = [(i, rnd.uniform(-25, 35), rnd.uniform(-35, 35)) for i in range(300)] + [(1000, 25.0, 19.995), (1001, 25.0, 19.9)]
    points = spark.createDataFrame(pts, "id int, lon double, lat double")
    got = {r.id: (r.pid, r.distance) for r in spatial.nearest_polygon(points, shapes, "pid", 1000.0, 1.0).collect()}
    assert got[1000][0] == 2 and abs(got[1000][1] - 555.975) < 0.5 and got[1001][0] is None
    for i, x, y in pts[:300]:
        if any(inside(s, x, y) for s in SHAPES.values()):
            assert got[i] == (min(k for k, s in SHAPES.items() if inside(s, x, y)), 0.0)
