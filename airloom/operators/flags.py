"""Quality flags: does a flag period overlap the window of a request?

The window [min(t, t+d), max(t, t+d)] is closed, the flag period half-open with a
NULL end meaning still open. A flag concerns its node, or only the sensors it lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions import timeops
from airloom.operators.intervals import overlap_marks

LEVELS = ("INFO", "WARNING", "ERROR")

# slots a flag is filed under besides the sensors it lists
_EVERY, _NODE_WIDE, _EMPTY_LIST = -1, -2, -3


@dataclass(frozen=True)
class Check:
    """One question: scope node, sensor or both, a level (None = any), a window."""

    name: str
    scope: str = "node"
    level: str | None = None
    window_s: int = -3600


def _filed_flags(flags: DataFrame, flag_types: DataFrame | None, match: str) -> DataFrame:
    """Flags under (node, slot): once for the node, and once per sensor they answer."""
    listed = F.array_distinct("sensors_ids")
    if match == "reference":
        # every listed sensor must be the asked one: only lists of one sensor (or none) can
        sensors = F.when(F.size(listed) == 0, F.array(F.lit(_EMPTY_LIST).cast("bigint"))).when(
            F.size(listed) == 1, listed.cast("array<bigint>")
        )
    else:
        sensors = listed.cast("array<bigint>")
    own = F.when(F.col("sensors_ids").isNull(), F.array(F.lit(_NODE_WIDE).cast("bigint"))).otherwise(sensors)
    slots = F.concat(F.array(F.lit(_EVERY).cast("bigint")), F.coalesce(own, F.array().cast("array<bigint>")))
    rows = flags.withColumn("_slot", F.explode(slots))
    if flag_types is not None:
        rows = rows.join(flag_types.select("flag_types_id", "flag_level"), "flag_types_id", "left")
    else:
        rows = rows.withColumn("flag_level", F.lit(None).cast("string"))
    return rows.select(F.col("sensor_nodes_id").alias("_node"), "_slot", "valid_from", "valid_to", "flag_level")


def _slots(scope: str, match: str) -> Column:
    sensor = F.col("sensors_id").cast("bigint")
    empty = [F.lit(_EMPTY_LIST).cast("bigint")] if match == "reference" else []
    wide = F.lit(_NODE_WIDE).cast("bigint")
    if scope == "node":
        return F.array(F.lit(_EVERY).cast("bigint"))
    if scope == "both":
        # a node-wide flag answers only a request without sensor
        return F.array(F.coalesce(sensor, wide), *empty)
    return F.array_compact(F.array(sensor, wide, *empty))


def flag_checks(
    requests: DataFrame,
    flags: DataFrame,
    flag_types: DataFrame | None,
    ctx: DataFrame | None,
    checks: Sequence[Check],
    match: str = "any",
) -> DataFrame:
    """Requests (sensor_nodes_id, sensors_id, datetime) with one boolean per check.

    Equal requests are answered once; all checks share one pass over the flags.
    `flags` holds sensor_nodes_id, sensors_ids (array or NULL), flag_types_id,
    valid_from, valid_to. Scope sensor asks the node owning the sensor, so `ctx` is
    needed; in scope both only nodes with sensors count, as in the reference.
    """
    columns = requests.columns
    distinct = requests.groupBy(*columns).agg(F.count("*").alias("_copies"))
    scopes = sorted({c.scope for c in checks})
    asked = distinct
    if "sensor" in scopes:
        asked = asked.join(ctx.select("sensors_id", F.col("sensor_nodes_id").alias("_owner")), "sensors_id", "left")
    if "both" in scopes:
        has = ctx.select("sensor_nodes_id").distinct().withColumn("_stationed", F.lit(True))
        asked = asked.join(has, "sensor_nodes_id", "left")
    questions = []
    for scope in scopes:
        for window_s in sorted({c.window_s for c in checks if c.scope == scope}):
            node = {"node": F.col("sensor_nodes_id"), "sensor": F.col("_owner") if "sensor" in scopes else None}.get(
                scope, F.when(F.col("_stationed"), F.col("sensor_nodes_id")) if "both" in scopes else None
            )
            questions.append(
                F.struct(
                    F.lit(f"{scope}{window_s}").alias("tag"),
                    node.cast("bigint").alias("node"),
                    _slots(scope, match).alias("slots"),
                    F.lit(window_s).alias("window_s"),
                )
            )
    lookups = (
        asked.withColumn("_q", F.explode(F.array(*questions)))
        .withColumn("_slot", F.explode("_q.slots"))
        .select(
            *columns, "_copies", F.col("_q.tag").alias("_tag"), F.col("_q.node").alias("_node"), "_slot",
            F.least("datetime", timeops.shift("datetime", F.col("_q.window_s"))).alias("_from"),
            F.greatest("datetime", timeops.shift("datetime", F.col("_q.window_s"))).alias("_to"),
        )
    )
    wanted = sorted({c.level or "" for c in checks})
    classes = {
        f"hit_{level or 'any'}": (F.col("flag_level") == level if level else F.lit(True)) for level in wanted
    }
    filed = _filed_flags(flags, flag_types, match).withColumn("_node", F.col("_node").cast("bigint"))
    marked = overlap_marks(
        lookups, filed, ["_node", "_slot"], low="_from", high="_to", start="valid_from", end="valid_to", classes=classes
    )
    answers = [
        F.bool_or((F.col("_tag") == f"{c.scope}{c.window_s}") & F.col(f"hit_{c.level or 'any'}")).alias(c.name)
        for c in checks
    ]
    found = marked.groupBy(*columns, "_copies").agg(*answers)
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select(
        *columns, *[c.name for c in checks]
    )


def flags_exist(
    requests: DataFrame,
    flags: DataFrame,
    flag_types: DataFrame | None = None,
    ctx: DataFrame | None = None,
    scope: str = "node",
    level: str | None = None,
    window_s: int = -3600,
    match: str = "any",
    name: str = "flagged",
) -> DataFrame:
    """Requests with one boolean column.

    node: any flag of `sensor_nodes_id`. sensor: flags of the node owning `sensors_id`
    that are node-wide or meant for the sensor. both: flags of `sensor_nodes_id` meant
    for `sensors_id`. `match` any: the sensor is in the list; reference: each listed
    sensor is the asked one.
    """
    return flag_checks(requests, flags, flag_types, ctx, [Check(name, scope, level, window_s)], match)


def flag_matrix(
    requests: DataFrame, flags: DataFrame, flag_types: DataFrame, ctx: DataFrame, match: str = "any"
) -> DataFrame:
    """All checks of a request side by side, and the any-level check over the next day."""
    checks = [
        Check(f"{scope}_{(level or 'any').lower()}", scope, level)
        for level in (None, *LEVELS)
        for scope in ("both", "node", "sensor")
    ]
    checks.append(Check("both_any_day", "both", None, 86400))
    return flag_checks(requests, flags, flag_types, ctx, checks, match)
