"""Points, grid cells, extents and polygons, on lon/lat doubles.

Polygons are rows of a key and `rings` (array of rings, each an array of {x, y}); a
ring's last point may repeat its first. Inside means an odd number of crossings, so
holes and several parts need no marking, and the border counts as inside.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions import timeops
from airloom.operators.context import join_context
from airloom.operators.ranking import spread_lag
from airloom.operators.upsert import upsert

# Radius of the web Mercator sphere and mean radius of the ellipsoid, metres.
MERCATOR_RADIUS = 6378137.0
EARTH_RADIUS = 6371008.7714150598


def mercator_x(lon) -> Column:
    return F.radians(lon) * MERCATOR_RADIUS


def mercator_y(lat) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS


def mercator_lon(x) -> Column:
    return F.degrees(F.col(x) / MERCATOR_RADIUS if isinstance(x, str) else x / MERCATOR_RADIUS)


def mercator_lat(y) -> Column:
    y = F.col(y) if isinstance(y, str) else y
    return F.degrees(2 * F.atan(F.exp(y / MERCATOR_RADIUS)) - F.lit(math.pi / 2))


def snap(c: Column, size: float) -> Column:
    return F.rint(c / size) * size


def bbox(lon, lat) -> Column:
    """The box of a point: [x, y, x, y]."""
    return F.array(lon, lat, lon, lat)


def bounds(x0, y0, x1, y1) -> Column:
    """Closed ring of the box between two corners."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(x0, y0), corner(x0, y1), corner(x1, y1), corner(x1, y0), corner(x0, y0))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2.0
    )
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


# ---- grid cells ----------------------------------------------------------------------------------


def _cells(rows: DataFrame, size: float) -> DataFrame:
    return rows.withColumn("x", snap(mercator_x("lon"), size)).withColumn("y", snap(mercator_y("lat"), size))


def snap_rollup(
    measurements: DataFrame, ctx: DataFrame, size: float = 30.0, sensors: DataFrame | None = None, nodes: DataFrame | None = None
) -> DataFrame:
    """Node and grid cell: first, last, and distinct instants; optionally of some sensors
    or nodes only. Instants are made distinct before they are counted."""
    rows = measurements.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("sensors_id", "datetime", "lon", "lat")
    if sensors is not None:
        rows = rows.join(sensors.select("sensors_id"), "sensors_id", "left_semi")
    placed = join_context(rows, ctx, "sensor_nodes_id")
    if nodes is not None:
        placed = placed.join(nodes.select("sensor_nodes_id"), "sensor_nodes_id", "left_semi")
    instants = _cells(placed, size).select("sensor_nodes_id", "x", "y", "datetime").distinct()
    return instants.groupBy("sensor_nodes_id", "x", "y").agg(
        F.min("datetime").alias("start_datetime"), F.max("datetime").alias("end_datetime"), F.count("*").alias("measurements_count")
    ).withColumn("cell_size", F.lit(size))


def _last_rows(measurements: DataFrame) -> DataFrame:
    """Latest stamp and position per sensor (one row per instant, so columns agree)."""
    return measurements.groupBy("sensors_id").agg(
        F.max("datetime").alias("datetime"), F.max_by("lon", "datetime").alias("lon"), F.max_by("lat", "datetime").alias("lat")
    )


def snap_rollup_latest(measurements: DataFrame, ctx: DataFrame, size: float = 30.0) -> DataFrame:
    """The same over the latest row of each sensor."""
    return snap_rollup(_last_rows(measurements), ctx, size)


def snap_rollup_merge(cells: DataFrame, fresh: DataFrame) -> DataFrame:
    """Add newly arrived instants to existing cells."""
    return upsert(
        cells, fresh, ["sensor_nodes_id", "x", "y"],
        merge={"start_datetime": "least", "end_datetime": "greatest", "measurements_count": "sum"},
    )


def mobile_generalized(measurements: DataFrame, analyses: DataFrame, ctx: DataFrame, size: float = 30.0) -> DataFrame:
    """Row counts per node and cell, of measurements and of analyses side by side."""

    def counted(facts: DataFrame) -> DataFrame:
        rows = join_context(facts.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()), ctx, "sensor_nodes_id", how="left")
        return _cells(rows, size).groupBy("sensor_nodes_id", "x", "y").agg(F.count("*").alias("count"))

    return counted(measurements).unionByName(counted(analyses))


def mobile_boxes(cells: DataFrame, expand: float = 20.0) -> DataFrame:
    return cells.groupBy("sensor_nodes_id").agg(
        (F.min("x") - expand).alias("xmin"), (F.min("y") - expand).alias("ymin"),
        (F.max("x") + expand).alias("xmax"), (F.max("y") + expand).alias("ymax"),
    )


def last_point(measurements: DataFrame, ctx: DataFrame) -> DataFrame:
    """Last known position of each node, over all its sensors."""
    per_sensor = _last_rows(measurements).select("sensors_id", F.struct("datetime", "lon", "lat").alias("_p"))
    nodes = per_sensor.join(ctx.select("sensors_id", "sensor_nodes_id"), "sensors_id").groupBy("sensor_nodes_id").agg(F.max("_p").alias("_p"))
    return nodes.select("sensor_nodes_id", "_p.datetime", "_p.lon", "_p.lat")


def step_distance(cells: DataFrame, key: str = "sensor_nodes_id", order: str = "end_datetime", chunk_rows: int = 200_000) -> DataFrame:
    """Distance of each cell to the previous one of its key in time order: planar in
    projected metres, and great-circle in metres."""
    seen = spread_lag(cells, [key], [order, "x", "y"], ["x", "y"], chunk_rows)
    planar = F.sqrt(F.pow(F.col("x") - F.col("prev_x"), 2.0) + F.pow(F.col("y") - F.col("prev_y"), 2.0))
    sphere = haversine(mercator_lon("prev_x"), mercator_lat("prev_y"), mercator_lon("x"), mercator_lat("y"))
    return seen.select(
        *cells.columns, timeops.seconds_between("end_datetime", "start_datetime").alias("dur"), planar.alias("distance"),
        sphere.alias("distance_m"),
    )


def extent(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("lon").alias("xmin"), F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax")
    )


def geometry_audit(nodes: DataFrame) -> DataFrame:
    out = (F.abs("lon") > 180) | (F.abs("lat") > 90)
    return nodes.agg(
        F.count("*").alias("nodes"),
        F.count_if(F.col("lon").isNull() | F.col("lat").isNull()).alias("missing"),
        F.count_if(out).alias("out_of_range"),
    )


# ---- polygons --------------------------------------------------------------------------------------


def _edges(polygons: DataFrame, key: str) -> DataFrame:
    """One row per edge; a ring that is not closed gets its closing edge."""
    rings = polygons.select(key, F.explode("rings").alias("_ring"))
    closed = F.concat("_ring", F.array(F.element_at("_ring", 1)))
    pairs = F.arrays_zip(F.col("_ring").alias("a"), F.slice(closed, F.lit(2), F.size("_ring")).alias("b"))
    edge = rings.select(key, F.explode(pairs).alias("_e")).select(
        key, F.col("_e.a.x").alias("x1"), F.col("_e.a.y").alias("y1"), F.col("_e.b.x").alias("x2"), F.col("_e.b.y").alias("y2")
    )
    return edge.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


# Fixed value: the polygon grid's origin, odd so that no vertex falls on a grid corner.
_ORIGIN = 0.013714685310297


def _cell(c: Column, cell_deg: float) -> Column:
    return F.floor((c - _ORIGIN) / cell_deg).cast("int")


def _line(index: Column, cell_deg: float) -> Column:
    return index * F.lit(float(cell_deg)) + F.lit(_ORIGIN)


def _cell_from(c: Column, cell_deg: float) -> Column:
    """First cell an edge starting at c touches: on a grid line, also the cell before."""
    return (F.ceil((c - _ORIGIN) / cell_deg) - 1).cast("int")


def polygon_grid(polygons: DataFrame, key: str, cell_deg: float = 1.0) -> DataFrame:
    """Polygons cut to grid cells: key, cell (ci, cj), whether the cell's lower right
    corner is inside, and the edges near the cell. Cells wholly outside are left out.

    A point then needs only its cell: crossings with the cell's few edges on the way from
    the point to that corner tell its side. Large polygons cost no more per point.
    """
    edges = _edges(polygons, key)
    # where edges cross the grid's horizontal lines, by the half-open rule
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = edges.withColumn("cj", F.explode(F.sequence(_cell(low, cell_deg), _cell(high, cell_deg)))).withColumn(
        "_y", _line(F.col("cj"), cell_deg)
    )
    lines = lines.where((F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y")))
    crossing = F.col("x1") + F.try_divide(
        (F.col("_y") - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")
    )
    crossed = lines.groupBy(key, "cj").agg(F.collect_list(crossing).alias("_xs"))

    box = edges.groupBy(key).agg(
        F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("xn"),
        F.min(low).alias("y0"), F.max(high).alias("yn"),
    )
    cells = box.withColumn("ci", F.explode(F.sequence(_cell(F.col("x0"), cell_deg), _cell(F.col("xn"), cell_deg)))).withColumn(
        "cj", F.explode(F.sequence(_cell(F.col("y0"), cell_deg), _cell(F.col("yn"), cell_deg)))
    ).select(key, "ci", "cj")
    near = (
        edges.withColumn("ci", F.explode(F.sequence(_cell_from(F.least("x1", "x2"), cell_deg), _cell(F.greatest("x1", "x2"), cell_deg))))
        .withColumn("cj", F.explode(F.sequence(_cell_from(low, cell_deg), _cell(high, cell_deg))))
        .groupBy(key, "ci", "cj")
        .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    )
    right = _line(F.col("ci") + 1, cell_deg)
    corner = F.coalesce(F.size(F.filter("_xs", lambda x: x > right)), F.lit(0)) % 2 == 1
    grid = cells.join(crossed, [key, "cj"], "left").withColumn("corner_inside", corner).drop("_xs")
    grid = grid.join(near, [key, "ci", "cj"], "left")
    return grid.where(F.col("corner_inside") | F.col("edges").isNotNull())


def _inside(px: Column, py: Column, right: Column, bottom: Column) -> Column:
    """Side of a point from its cell's corner: along the row to the right border, then
    down the border. Half-open rules keep vertices from counting twice."""

    def across(e: Column) -> Column:
        x = e["x1"] + F.try_divide((py - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return ((e["y1"] > py) != (e["y2"] > py)) & (x > px) & (x <= right)

    def down(e: Column) -> Column:
        slope = F.try_divide(e["y2"] - e["y1"], e["x2"] - e["x1"])
        y = e["y1"] + (right - e["x1"]) * slope
        # the border is walked a hair to its right: at either end the slope decides
        below_start = (y < py) | ((y == py) & (slope <= 0))
        above_end = (y > bottom) | ((y == bottom) & (slope > 0))
        return ((e["x1"] > right) != (e["x2"] > right)) & above_end & below_start

    def on(e: Column) -> Column:
        flat = (e["x2"] - e["x1"]) * (py - e["y1"]) == (e["y2"] - e["y1"]) * (px - e["x1"])
        return flat & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(
            F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        )

    edges = F.coalesce("edges", F.expr("array()").cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))
    safe = lambda test: lambda e: F.coalesce(test(e), F.lit(False))
    crossings = F.size(F.filter(edges, safe(across))) + F.size(F.filter(edges, safe(down)))
    return F.exists(edges, safe(on)) | (F.col("corner_inside") != (crossings % 2 == 1))


def assign_polygon(points: DataFrame, polygons: DataFrame, key: str, cell_deg: float = 1.0) -> DataFrame:
    """Points (lon, lat) with the key of the covering polygon, the lowest of several.

    Points meet polygons by grid cell; equal points are looked up once.
    """
    grid = polygon_grid(polygons, key, cell_deg)
    places = points.select("lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()
    located = places.withColumn("ci", _cell(F.col("lon"), cell_deg)).withColumn("cj", _cell(F.col("lat"), cell_deg))
    hit = located.join(grid, ["ci", "cj"]).where(
        _inside(F.col("lon"), F.col("lat"), _line(F.col("ci") + 1, cell_deg), _line(F.col("cj"), cell_deg))
    )
    best = hit.groupBy("lon", "lat").agg(F.min(key).alias(key))
    return points.join(best, ["lon", "lat"], "left").select(*points.columns, key)


def nearest_polygon(points: DataFrame, polygons: DataFrame, key: str, within_m: float = 1000.0, cell_deg: float = 1.0) -> DataFrame:
    """Points with the closest polygon within so many metres, and the distance (0 inside).

    Border distances are taken on the plane touching the point, exact to well under a
    metre at these ranges. Candidates come from the grid cells the circle touches.
    """
    reach = math.degrees(within_m / EARTH_RADIUS) * 1.01
    row = int(round(360 / cell_deg))
    places = points.select("lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()
    wide = F.least(reach / F.greatest(F.cos(F.radians("lat")), F.lit(1e-9)), F.lit(180.0))
    near = (
        places.withColumn("ci", F.explode(F.sequence(_cell(F.col("lon") - wide, cell_deg), _cell(F.col("lon") + wide, cell_deg))))
        .withColumn("cj", F.explode(F.sequence(_cell(F.col("lat") - reach, cell_deg), _cell(F.col("lat") + reach, cell_deg))))
        .withColumn("ci", F.pmod("ci", F.lit(row)))
        .distinct()
    )
    edges = _edges(polygons, key)
    celled = (
        edges.withColumn("ci", F.explode(F.sequence(_cell(F.least("x1", "x2"), cell_deg), _cell(F.greatest("x1", "x2"), cell_deg))))
        .withColumn("cj", F.explode(F.sequence(_cell(F.least("y1", "y2"), cell_deg), _cell(F.greatest("y1", "y2"), cell_deg))))
        .withColumn("ci", F.pmod("ci", F.lit(row)))
    )
    # a polygon's edges in a cell stay together, so a point makes one row per cell and polygon
    celled = celled.groupBy("ci", "cj", key).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    metre = math.pi * EARTH_RADIUS / 180
    wrap = lambda d: F.pmod(d + 180, F.lit(360.0)) - 180

    def far(e: Column) -> Column:
        ax = wrap(e["x1"] - F.col("lon")) * metre * F.cos(F.radians("lat"))
        bx = wrap(e["x2"] - F.col("lon")) * metre * F.cos(F.radians("lat"))
        ay, by = (e["y1"] - F.col("lat")) * metre, (e["y2"] - F.col("lat")) * metre
        dx, dy = bx - ax, by - ay
        t = F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        return F.sqrt(F.pow(ax + t * dx, 2.0) + F.pow(ay + t * dy, 2.0))

    closest = F.array_min(F.transform("edges", far))
    borders = near.join(celled, ["ci", "cj"]).select(
        "lon", "lat", F.struct(closest.alias("distance"), F.col(key).alias("k")).alias("_c")
    ).where(F.col("_c.distance") <= within_m)
    covered = assign_polygon(places, polygons, key, cell_deg).where(F.col(key).isNotNull()).select(
        "lon", "lat", F.struct(F.lit(0.0).alias("distance"), F.col(key).alias("k")).alias("_c")
    )
    best = borders.unionByName(covered).groupBy("lon", "lat").agg(F.min("_c").alias("_c"))
    return points.join(best, ["lon", "lat"], "left").select(
        *points.columns, F.col("_c.k").alias(key), F.col("_c.distance").alias("distance")
    )
