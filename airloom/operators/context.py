"""The station dimension chain sensor -> system -> node -> zone, joined once."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.joins import never_broadcast

# Source tables of the contexts built here and what was learned about them.
_KNOWN: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()
_FEW, _MANY = 16, 128

# A context row takes some 60 bytes in a broadcast; more sensors than this are joined
# by a shuffle instead.
BROADCAST_SENSORS = 500_000


def station_chain(sensors: DataFrame, sensor_systems: DataFrame, sensor_nodes: DataFrame) -> DataFrame:
    """One row per sensor with its measurand, node and visibility.

    Nodes without a zone are kept: what does not ask for local time takes this form.
    """
    nodes = sensor_nodes.select(
        "sensor_nodes_id", "timezones_id", "providers_id", "countries_id", F.col("is_public").alias("node_is_public")
    )
    systems = sensor_systems.select("sensor_systems_id", "sensor_nodes_id").join(never_broadcast(nodes), "sensor_nodes_id")
    chain = never_broadcast(
        sensors.select("sensors_id", "sensor_systems_id", "measurands_id", F.col("is_public").alias("sensor_is_public"))
    ).join(systems, "sensor_systems_id")
    _KNOWN[chain] = {"sensors": sensors}
    return chain


def station_context(
    sensors: DataFrame, sensor_systems: DataFrame, sensor_nodes: DataFrame, timezones: DataFrame
) -> DataFrame:
    """The station chain with the zone of each node.

    Sensors whose node has no zone are left out, as in every rollup.
    """
    chain = station_chain(sensors, sensor_systems, sensor_nodes)
    ctx = chain.join(timezones.select("timezones_id", "tzid"), "timezones_id")
    _KNOWN[ctx] = {"sensors": sensors, "nodes": sensor_nodes, "timezones": timezones}
    return ctx


def recount(ctx: DataFrame) -> None:
    """Forget what was counted for a context, so that one kept over time (a stream's) is
    judged by the tables as they are now."""
    for name in ("few", "zones"):
        _KNOWN.get(ctx, {}).pop(name, None)


def broadcast_if_few(side: DataFrame, counted: DataFrame, rows: int = 100_000) -> DataFrame:
    """`side` as a broadcast when `counted`, which has at least as many rows, stays within
    the bound; else for a sort-merge join."""
    return F.broadcast(side) if counted.limit(rows + 1).count() <= rows else never_broadcast(side)


def _few_sensors(ctx: DataFrame) -> bool:
    """Does the sensor table stay within the broadcast bound? Counted once per context."""
    known = _KNOWN.get(ctx)
    if known is None:
        return False
    if "few" not in known:
        known["few"] = known["sensors"].limit(BROADCAST_SENSORS + 1).count() <= BROADCAST_SENSORS
    return known["few"]


def join_context(
    facts: DataFrame, ctx: DataFrame, *columns: str, where: Column | None = None, how: str = "inner"
) -> DataFrame:
    """Facts of known sensors (with `how` left: of all) with the named context columns.

    Below the counted bound the context is broadcast and the facts are not shuffled;
    above it the join shuffles both sides, and adaptive execution splits hot sensors.
    """
    side = ctx if where is None else ctx.where(where)
    side = side.select("sensors_id", *columns)
    return facts.join(F.broadcast(side) if _few_sensors(ctx) else never_broadcast(side), "sensors_id", how)


def literal_zones(timezones: DataFrame, nodes: DataFrame) -> list[str]:
    """Zone names worth a branch of their own: all of a short zone table, else the ones
    most nodes have, at most `_MANY`."""
    names = timezones.select("tzid").where(F.col("tzid").isNotNull()).distinct().limit(_FEW + 1)
    zones = sorted(r[0] for r in names.collect())
    if len(zones) > _FEW:
        counts = nodes.groupBy("timezones_id").agg(F.count("*").alias("n")).join(timezones, "timezones_id")
        zones = [r[0] for r in counts.orderBy(F.desc("n"), "tzid").limit(_MANY).select("tzid").collect()]
    return zones


def _usual_zones(ctx: DataFrame) -> list[str]:
    known = _KNOWN.get(ctx)
    if known is None or "timezones" not in known:
        return []
    if "zones" not in known:
        known["zones"] = literal_zones(known["timezones"], known["nodes"])
    return known["zones"]


def zone_branches(zones: list[str], convert: Callable[[str | Column], Column], column: str = "tzid") -> Column:
    """`convert(zone)` for the zone in a column, with a literal branch for each listed one.

    A conversion parses its zone name for every row unless the name is a literal, which
    costs more than the rest of a rollup's scan. Zones not listed take the general form,
    so the result is the same for any list.
    """
    branches = None
    for zone in zones:
        test = F.col(column) == zone
        branches = F.when(test, convert(zone)) if branches is None else branches.when(test, convert(zone))
    general = convert(F.col(column))
    return general if branches is None else branches.otherwise(general)


def by_zone(ctx: DataFrame, convert: Callable[[str | Column], Column]) -> Column:
    """`convert(zone)` for the context's zone in column `tzid`."""
    return zone_branches(_usual_zones(ctx), convert)
