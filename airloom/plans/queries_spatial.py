"""Queries: grid cells, extents, and polygon lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.operators import spatial
from airloom.plans.registry import query

_X = "round_even(radians(lon) * 6378137.0 / {s}, 0) * {s}"
_Y = "round_even(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0 / {s}, 0) * {s}"


def _cells_sql(source: str, size: str, where: str = "") -> str:
    return f"""SELECT sensor_nodes_id, {_X.format(s=size)} AS x, {_Y.format(s=size)} AS y, min(datetime) AS start_datetime, max(datetime) AS end_datetime,
      count(DISTINCT datetime) AS measurements_count FROM {{{source}}} m JOIN {{stations}} c ON c.sensors_id = m.sensors_id {where} GROUP BY 1, 2, 3"""


_CELL = "sensor_nodes_id:i x:n y:n start_datetime:t end_datetime:t measurements_count:i"


@query("snap_rollup", _CELL, _cells_sql("measurements", "30.0"))
def _(f):
    return spatial.snap_rollup(f.measurements, f.stations, 30.0)


@query(
    "snap_rollup_by_sensor", _CELL,
    _cells_sql("measurements", "1000000.0", "WHERE m.sensors_id IN (SELECT user_id * 5 FROM {events} WHERE event_type = 'error')"),
)
def _(f):
    chosen = f.sql("SELECT DISTINCT user_id * 5 AS sensors_id FROM {events} WHERE event_type = 'error'")
    return spatial.snap_rollup(f.measurements, f.stations, 1000000.0, sensors=chosen)


@query(
    "snap_rollup_by_node", _CELL,
    _cells_sql("measurements", "1000000.0", "WHERE c.sensor_nodes_id IN (SELECT user_id FROM {events} WHERE event_type = 'signup')"),
)
def _(f):
    chosen = f.sql("SELECT DISTINCT user_id AS sensor_nodes_id FROM {events} WHERE event_type = 'signup'")
    return spatial.snap_rollup(f.measurements, f.stations, 1000000.0, nodes=chosen)


@query(
    "snap_rollup_latest", _CELL, _cells_sql("latest", "1000000.0"),
    {"latest": "SELECT sensors_id, max(datetime) AS datetime, arg_max(lon, datetime) AS lon, arg_max(lat, datetime) AS lat FROM {measurements} GROUP BY 1"},
)
def _(f):
    return spatial.snap_rollup_latest(f.measurements, f.stations, 1000000.0)


@query(
    "snap_rollup_merge", _CELL,
    f"""SELECT coalesce(a.sensor_nodes_id, b.sensor_nodes_id) AS sensor_nodes_id, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y,
      least(a.start_datetime, b.start_datetime) AS start_datetime, greatest(a.end_datetime, b.end_datetime) AS end_datetime,
      coalesce(a.measurements_count, 0) + coalesce(b.measurements_count, 0) AS measurements_count
    FROM {{early}} a FULL JOIN {{late}} b ON a.sensor_nodes_id = b.sensor_nodes_id AND a.x = b.x AND a.y = b.y""",
    {"early": _cells_sql("measurements", "1000000.0", "WHERE datetime < TIMESTAMP '2024-01-16'"),
     "late": _cells_sql("measurements", "1000000.0", "WHERE datetime >= TIMESTAMP '2024-01-16'")},
)
def _(f):
    early = F.col("datetime") < F.lit("2024-01-16").cast("timestamp")
    return spatial.snap_rollup_merge(
        spatial.snap_rollup(f.measurements.where(early), f.stations, 1000000.0), spatial.snap_rollup(f.measurements.where(~early), f.stations, 1000000.0)
    )


def _generalized_sql(source: str) -> str:
    return f"""SELECT sensor_nodes_id, {_X.format(s='30.0')} AS x, {_Y.format(s='30.0')} AS y, count(*) AS count FROM {{{source}}} m
      LEFT JOIN {{stations}} c ON c.sensors_id = m.sensors_id GROUP BY 1, 2, 3"""


_GENERAL = _generalized_sql("measurements") + " UNION ALL " + _generalized_sql("measurements_long")


@query("mobile_generalized", "sensor_nodes_id:i x:n y:n count:i", _GENERAL)
def _(f):
    return spatial.mobile_generalized(f.measurements, f.measurements_long, f.stations)


@query(
    "mobile_boxes", "sensor_nodes_id:i xmin:n ymin:n xmax:n ymax:n",
    "SELECT sensor_nodes_id, min(x) - 20 AS xmin, min(y) - 20 AS ymin, max(x) + 20 AS xmax, max(y) + 20 AS ymax FROM {general} GROUP BY 1", {"general": _GENERAL},
)
def _(f):
    return spatial.mobile_boxes(spatial.mobile_generalized(f.measurements, f.measurements_long, f.stations))


@query(
    "last_point", "sensor_nodes_id:i datetime:t lon:f lat:f",
    """SELECT c.sensor_nodes_id, max(m.datetime) AS datetime, arg_max(m.lon, m.datetime) AS lon, arg_max(m.lat, m.datetime) AS lat
    FROM {measurements} m JOIN {stations} c ON c.sensors_id = m.sensors_id GROUP BY 1""",
)
def _(f):
    return spatial.last_point(f.measurements, f.stations)


@query(
    "step_distance", "sensor_nodes_id:i x:n y:n end_datetime:t dur:f distance:n distance_m:n",
    """SELECT sensor_nodes_id, x, y, end_datetime, (epoch_us(end_datetime) - epoch_us(start_datetime)) / 1e6 AS dur, sqrt(pow(x - px, 2) + pow(y - py, 2)) AS distance,
      2 * 6371008.7714150598 * asin(sqrt(least(1.0, pow(sin(radians(la - pla) / 2), 2) + cos(radians(pla)) * cos(radians(la)) * pow(sin(radians(lo - plo) / 2), 2)))) AS distance_m
    FROM (SELECT *, degrees(x / 6378137.0) AS lo, degrees(px / 6378137.0) AS plo, degrees(2 * atan(exp(y / 6378137.0)) - pi() / 2) AS la,
        degrees(2 * atan(exp(py / 6378137.0)) - pi() / 2) AS pla FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM {cells}
        WINDOW w AS (PARTITION BY sensor_nodes_id ORDER BY end_datetime, x, y)) a) b""", {"cells": _cells_sql("measurements", "50.0")},
)
def _(f):
    return spatial.step_distance(spatial.snap_rollup(f.measurements, f.stations, 50.0))


@query(
    "point_expressions", "c_custkey:i x:n y:n back_lon:f back_lat:f box:s ring_points:i",
    """SELECT c_custkey, radians(lon) * 6378137.0 AS x, ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0 AS y, lon AS back_lon, lat AS back_lat,
      concat_ws(',', CAST(lon AS INT), CAST(lat AS INT), CAST(lon AS INT), CAST(lat AS INT)) AS box, 5 AS ring_points
    FROM (SELECT c_custkey, CAST((c_custkey*37) % 360 - 180 AS DOUBLE) AS lon, CAST((c_custkey*13) % 160 - 80 AS DOUBLE) AS lat FROM {customer}) p""",
)
def _(f):
    rows = f.sql("SELECT c_custkey, CAST((c_custkey*37) % 360 - 180 AS DOUBLE) AS lon, CAST((c_custkey*13) % 160 - 80 AS DOUBLE) AS lat FROM {customer}")
    lon, lat = F.col("lon"), F.col("lat")
    return rows.withColumn("x", spatial.mercator_x("lon")).withColumn("y", spatial.mercator_y("lat")).select(
        "c_custkey", "x", "y", spatial.mercator_lon("x").alias("back_lon"), spatial.mercator_lat("y").alias("back_lat"),
        F.array_join(F.transform(spatial.bbox(lon, lat), lambda v: v.cast("int").cast("string")), ",").alias("box"),
        F.size(spatial.bounds(lon, lat, lon + 1, lat + 1)).alias("ring_points"),
    )


@query(
    "provider_extent", "providers_id:i xmin:f ymin:f xmax:f ymax:f",
    "SELECT providers_id, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM {sensor_nodes} WHERE is_public GROUP BY 1",
)
def _(f):
    return spatial.extent(f.sensor_nodes.where(F.col("is_public")), ["providers_id"])


@query(
    "geometry_audit", "nodes:i missing:i out_of_range:i",
    """SELECT count(*) AS nodes, count(*) FILTER (WHERE lon IS NULL OR lat IS NULL) AS missing, count(*) FILTER (WHERE abs(lon) > 180 OR abs(lat) > 90) AS out_of_range
    FROM {sensor_nodes}""",
)
def _(f):
    return spatial.geometry_audit(f.sensor_nodes)


def _boxes(f):
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("xmin", "ymin"), ("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"))])
    return f.zone_boxes.select("zone_id", F.array(ring).alias("rings"))


_COVER = "SELECT min(b.zone_id) FROM {zone_boxes} b WHERE p.lon BETWEEN b.xmin AND b.xmax AND p.lat BETWEEN b.ymin AND b.ymax"


@query("assign_timezone", "sensors_id:i datetime:t zone_id:i", f"SELECT p.sensors_id, p.datetime, ({_COVER}) AS zone_id FROM {{measurements}} p")
def _(f):
    return spatial.assign_polygon(f.measurements, _boxes(f), "zone_id", cell_deg=10.0)


# one box per nation, from its key: neighbours share borders, some points have no box
_NATION_BOX = """SELECT n_nationkey AS countries_id, substring(n_name, 8, 2) AS iso, CAST(n_nationkey % 5 * 60 - 150 AS DOUBLE) AS xmin, CAST(n_nationkey * 6 - 80 AS DOUBLE) AS ymin,
  CAST(n_nationkey % 5 * 60 - 90 AS DOUBLE) AS xmax, CAST(n_nationkey * 6 - 50 AS DOUBLE) AS ymax FROM {nation}"""


@query(
    "assign_country", "sensor_nodes_id:i countries_id:i iso:s",
    """SELECT sensor_nodes_id, z.countries_id, z.iso FROM (SELECT p.*, (SELECT min(b.countries_id) FROM {boxes} b WHERE p.lon BETWEEN b.xmin AND b.xmax
      AND p.lat BETWEEN b.ymin AND b.ymax) AS cid FROM {sensor_nodes} p) q LEFT JOIN {boxes} z ON z.countries_id = q.cid""", {"boxes": _NATION_BOX},
)
def _(f):
    boxes = f.sql(_NATION_BOX)
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("xmin", "ymin"), ("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"))])
    shapes = boxes.select("countries_id", F.array(ring).alias("rings"))
    points = f.sensor_nodes.select("sensor_nodes_id", "lon", "lat")
    return spatial.assign_polygon(points, shapes, "countries_id", cell_deg=5.0).join(boxes.select("countries_id", "iso"), "countries_id", "left")


# on the plane touching the point, the distance to a box is that to its nearest coordinates
@query(
    "nearest_country", "sensor_nodes_id:i countries_id:i distance:n",
    """SELECT p.sensor_nodes_id, b.countries_id, b.d AS distance FROM {sensor_nodes} p LEFT JOIN
      (SELECT sensor_nodes_id, unnest(arg_min({{'countries_id': countries_id, 'd': d}}, (d, countries_id))) FROM
        (SELECT n.sensor_nodes_id, z.countries_id, sqrt(pow(greatest(xmin - lon, 0, lon - xmax) * m * cos(radians(lat)), 2) + pow(greatest(ymin - lat, 0, lat - ymax) * m, 2)) AS d
        FROM {sensor_nodes} n, {boxes} z, (SELECT pi() * 6371008.7714150598 / 180 AS m) r WHERE lon IS NOT NULL) x WHERE d <= 250000 GROUP BY 1) b ON b.sensor_nodes_id = p.sensor_nodes_id""",
    {"boxes": _NATION_BOX},
)
def _(f):
    boxes = f.sql(_NATION_BOX)
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("xmin", "ymin"), ("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"))])
    points = f.sensor_nodes.select("sensor_nodes_id", "lon", "lat")
    return spatial.nearest_polygon(points, boxes.select("countries_id", F.array(ring).alias("rings")), "countries_id", 250_000.0, cell_deg=5.0)
