"""Ingest resolution, dimension upkeep, and merging or removing sensors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions import textops, timeops
from airloom.operators.context import broadcast_if_few, join_context
from airloom.operators.ranking import spread_row_number
from airloom.operators.upsert import changed, insert_absent, one_per_key
from airloom.session import cut_lineage

# ---- ingest ids --------------------------------------------------------------------------------


def split_ingest_id(df: DataFrame, col: str = "ingest_id") -> DataFrame:
    return df.select("*", textops.split_ingest_id(F.col(col)).alias("_p")).select(*df.columns, "_p.*")


def measurands_map_view(measurands_map: DataFrame, measurands: DataFrame) -> DataFrame:
    """Explicit keys, and measurand with units run together."""
    own = measurands.select("measurands_id", F.concat("measurand", F.coalesce("units", F.lit(""))).alias("key"))
    return measurands_map.select("measurands_id", "key").union(own.distinct())


def check_ingest_id(df: DataFrame, measurands_map: DataFrame, measurands: DataFrame, col: str = "ingest_id") -> DataFrame:
    """Ids split, with the measurand their parameter stands for."""
    keys = measurands_map_view(measurands_map, measurands).withColumnRenamed("key", "parameter")
    told = keys.join(measurands.select("measurands_id", "measurand", "units"), "measurands_id")
    return split_ingest_id(df, col).join(told, "parameter", "left")


def ingest_format(facts: DataFrame, sensors: DataFrame, sensor_systems: DataFrame, sensor_nodes: DataFrame, measurands: DataFrame) -> DataFrame:
    """Facts back to ingest ids: source name, sensor's source id, measurand; ISO time."""
    stations = (
        sensors.select("sensors_id", "sensor_systems_id", "measurands_id", "source_id")
        .join(measurands.select("measurands_id", "measurand"), "measurands_id")
        .join(sensor_systems.select("sensor_systems_id", "sensor_nodes_id"), "sensor_systems_id")
        .join(sensor_nodes.select("sensor_nodes_id", "source_name"), "sensor_nodes_id")
        .select(
            "sensors_id", F.col("sensor_nodes_id").alias("id"),
            F.concat("source_name", F.lit("-"), "source_id", F.lit("-"), "measurand").alias("ingest_id"),
        )
    )
    micros = F.date_format("datetime", "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), F.regexp_replace(micros, "0+$", "")))
    stamp = F.concat(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))
    return facts.join(broadcast_if_few(stations, sensors), "sensors_id").select("id", "ingest_id", "value", stamp.alias("datetime"), "lon", "lat")


def assign_ids(rows: DataFrame, existing: DataFrame, id_col: str, order: str) -> DataFrame:
    """New ids after the largest existing one, in the order of a unique text key.

    The new rows are checkpointed first: ids stay the same however often they are read
    again, and the rank (spread over tasks when there are many) does not repeat their
    lineage.
    """
    rows = cut_lineage(rows)
    top = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0))
    ranked = spread_row_number(rows.withColumn("_all", F.lit(1)), ["_all"], [(order, True)], "_rn")
    return ranked.withColumn(id_col, (top + F.col("_rn")).cast(existing.schema[id_col].dataType)).drop("_all", "_rn")


def resolve_mobile_ingest(
    staged: DataFrame,
    sensor_nodes: DataFrame,
    sensor_systems: DataFrame,
    sensors: DataFrame,
    measurands: DataFrame,
    measurements: DataFrame,
) -> dict[str, DataFrame]:
    """Staged rows (ingest_id, value, datetime, lon, lat) to stations and facts.

    Nodes match on source name and id, systems on node and source id, sensors on system
    and measurand; missing ones are added. Returns the complete tables
    sensor_nodes, sensor_systems, sensors, measurements, and `stations`.
    """
    # a station list is far smaller than its facts: kept once instead of rescanning them
    stations = cut_lineage(split_ingest_id(staged.select("ingest_id").distinct()))

    # nodes
    node_key = ["source_name", "source_id"]
    known = sensor_nodes.select("sensor_nodes_id", *node_key)
    lacking = stations.select(*node_key).distinct().join(known, node_key, "left_anti")
    fresh = assign_ids(lacking.withColumn("_key", F.to_json(F.struct(*node_key))), sensor_nodes, "sensor_nodes_id", "_key")
    fresh = fresh.drop("_key").withColumn("site_name", F.col("source_id"))
    nodes = sensor_nodes.unionByName(fresh, allowMissingColumns=True)
    stations = stations.join(nodes.select("sensor_nodes_id", *node_key), node_key, "left")

    # systems
    system_key = ["sensor_nodes_id", "source_id"]
    lacking = stations.select(*system_key).distinct().join(sensor_systems.select(*system_key), system_key, "left_anti")
    fresh = assign_ids(lacking.withColumn("_key", F.to_json(F.struct(*system_key))), sensor_systems, "sensor_systems_id", "_key").drop("_key")
    systems = sensor_systems.unionByName(fresh, allowMissingColumns=True)
    stations = stations.join(systems.select("sensor_systems_id", *system_key), system_key, "left")

    # measurands and sensors
    named = measurands.groupBy(F.col("measurand").alias("parameter")).agg(F.min("measurands_id").alias("measurands_id"))
    stations = stations.join(named, "parameter", "left")
    sensor_key = ["sensor_systems_id", "measurands_id"]
    lacking = (
        stations.where(F.col("measurands_id").isNotNull())
        .groupBy(*sensor_key).agg(F.min(F.concat("source_id", F.lit("-"), "parameter")).alias("source_id"))
        .join(sensors.select(*sensor_key), sensor_key, "left_anti")
    )
    fresh = assign_ids(lacking.withColumn("_key", F.to_json(F.struct(*sensor_key))), sensors, "sensors_id", "_key").drop("_key")
    fresh = fresh.withColumn("data_averaging_period_seconds", F.lit(1)).withColumn("data_logging_period_seconds", F.lit(1))
    all_sensors = sensors.unionByName(fresh, allowMissingColumns=True)
    ids = all_sensors.groupBy(*sensor_key).agg(F.min("sensors_id").alias("sensors_id"))
    stations = stations.join(ids, sensor_key, "left")

    facts = staged.join(stations.select("ingest_id", "sensors_id"), "ingest_id").where(F.col("sensors_id").isNotNull())
    facts = facts.select("sensors_id", "datetime", "value", "lon", "lat")
    return {
        "sensor_nodes": nodes,
        "sensor_systems": systems,
        "sensors": all_sensors,
        "measurements": insert_absent(measurements, facts, ["sensors_id", "datetime"]),
        "stations": stations,
    }


def load_dimension(rows: DataFrame, parents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose parent exists, orphans)."""
    known = parents.select(key).distinct()
    return rows.join(known, key, "left_semi"), rows.join(known, key, "left_anti")


# ---- history -----------------------------------------------------------------------------------


def history_log(before: DataFrame, after: DataFrame, key: str, as_of: str, image: str = "new") -> DataFrame:
    """History rows of inserts and updates between two snapshots.

    Systems and sensors log the NEW image; nodes the OLD one, which on insert is a row
    of NULLs.
    """
    moves = changed(before, after, [key]).where(F.col("op") != "delete")
    row = F.col(f"{image}_row")
    rest = [c for c in before.columns if c != key]
    own = F.col(key) if image == "new" else F.when(F.col("op") == "update", F.col(key))
    return moves.select(
        own.alias(key), *[row[c].alias(c) for c in rest], timeops.instant(as_of).alias("created"),
    )


def accumulate_names(existing: DataFrame, after: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """Past names per id: stored arrays united with the current values.

    `columns` maps array column to value column. A stored row loses NULLs and repeats;
    a first row holds its value as it is, NULL included.
    """
    now = after.select(key, *[F.col(v).alias(f"_{a}") for a, v in columns.items()])
    both = existing.withColumn("_old", F.lit(True)).join(now.withColumn("_new", F.lit(True)), key, "full_outer")
    out = []
    for a in columns:
        joined = F.array_compact(F.array_distinct(F.concat(F.coalesce(a, F.array().cast("array<string>")), F.array(f"_{a}"))))
        out.append(
            F.when(F.col("_new").isNull(), F.col(a)).when(F.col("_old").isNull(), F.array(f"_{a}")).otherwise(joined).alias(a)
        )
    return both.select(key, *out)


def tracking_summary(history: DataFrame, key: str, created: str = "created") -> DataFrame:
    return history.groupBy(key).agg(
        F.count("*").alias("n"), F.min(created).alias("added_on"), F.max(created).alias("modified_on")
    )


# ---- backfills ---------------------------------------------------------------------------------


# Source id pattern, averaging seconds, logging seconds; the first match counts.
PERIOD_PATTERNS = [
    ("senstate", 60, 60),
    ("purple", 120, 120),
    ("clarity", 90, 300),
    ("airgradient", 3600, 3600),
    ("^smartsense", 3600, 3600),
    ("^iqair", 3600, 3600),
    ("habitatmap", 1, 1),
]


def backfill_metadata(
    nodes: DataFrame, sensors: DataFrame, providers: DataFrame, patterns: Sequence[tuple[str, int, int]] = PERIOD_PATTERNS
) -> tuple[DataFrame, DataFrame]:
    """Missing providers by source name in any case; missing periods from metadata, then
    by the first matching source id pattern (which also sets the logging period)."""
    named = providers.groupBy(F.lower("source_name").alias("_k")).agg(F.min("providers_id").alias("_p"))
    filled = nodes.join(named, F.lower(F.col("source_name")) == F.col("_k"), "left").withColumn(
        "providers_id", F.coalesce("providers_id", "_p")
    ).drop("_k", "_p")
    own = F.round(F.get_json_object("metadata", "$.data_averaging_period_seconds").try_cast("double")).cast("int")
    averaging, logging = None, None
    for pattern, a, b in patterns:
        hit = textops.imatch(F.col("source_id"), pattern)
        averaging = F.when(hit, a) if averaging is None else averaging.when(hit, a)
        logging = F.when(hit, b) if logging is None else logging.when(hit, b)
    lacking = F.col("data_averaging_period_seconds").isNull()
    a, b = F.coalesce(own, averaging), F.coalesce(own, logging)
    periods = sensors.withColumns(
        {
            "data_averaging_period_seconds": F.coalesce("data_averaging_period_seconds", a),
            "data_logging_period_seconds": F.when(lacking & a.isNotNull(), b).otherwise(F.col("data_logging_period_seconds")),
        }
    )
    return filled, periods


def backfill_from_metadata(
    nodes: DataFrame, sensors: DataFrame, timezones: DataFrame, providers: DataFrame, countries: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Zone id named in metadata (over any stored one), provider by exact source name when
    missing or 1, country by code when missing; averaging and logging seconds."""
    zone = F.get_json_object("metadata", "$.timezone")
    tz = timezones.select(F.col("timezones_id").alias("_tz"), F.col("tzid").alias("_tzid"))
    pr = providers.groupBy("source_name").agg(F.min("providers_id").alias("_pr"))
    co = countries.groupBy(F.col("iso").alias("country")).agg(F.min("countries_id").alias("_co"))
    unset = F.col("providers_id").isNull() | (F.col("providers_id") == 1)
    filled = (
        nodes.join(tz, zone == F.col("_tzid"), "left").join(pr, "source_name", "left").join(co, "country", "left")
        .withColumns(
            {
                "timezones_id": F.coalesce("_tz", "timezones_id"),
                "providers_id": F.when(unset, F.coalesce("_pr", "providers_id")).otherwise(F.col("providers_id")),
                "countries_id": F.coalesce("countries_id", "_co"),
            }
        )
        .select(*nodes.columns)
    )
    said = F.get_json_object("metadata", "$.data_averaging_period_seconds").try_cast("int")
    hourly = textops.imatch(F.get_json_object("metadata", "$.data_avg_dur"), "^hourly")
    logged = F.get_json_object("metadata", "$.logging_interval_seconds")
    periods = sensors.withColumns(
        {
            "data_averaging_period_seconds": F.when(hourly, 3600).otherwise(F.coalesce(said, "data_averaging_period_seconds")),
            "data_logging_period_seconds": F.coalesce(
                F.when(logged != "true", F.round(logged.try_cast("double")).cast("int")), "data_logging_period_seconds"
            ),
        }
    )
    return filled, periods


def collect_manufacturers(
    sensors: DataFrame, sensor_systems: DataFrame, known: DataFrame, fields: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Names in metadata not yet known. `fields`: frame name to JSON fields."""
    frames = {"sensors": sensors, "sensor_systems": sensor_systems}
    names = None
    for frame, columns in fields.items():
        for field in columns:
            found = frames[frame].select(F.get_json_object("metadata", f"$.{field}").alias("full_name"))
            names = found if names is None else names.union(found)
    return names.where(F.col("full_name").isNotNull()).distinct().join(known.select("full_name"), "full_name", "left_anti")


def collect_instruments(rows: DataFrame, entities: DataFrame, label: str = "model_name", maker: str = "manufacturer_name") -> DataFrame:
    """Models in metadata with the smallest entity id of their maker."""
    models = rows.select(
        F.get_json_object("metadata", f"$.{label}").alias("label"), F.get_json_object("metadata", f"$.{maker}").alias("full_name")
    ).where(F.col("label").isNotNull()).distinct()
    told = models.join(entities.select("full_name", "entities_id"), "full_name", "left")
    return told.groupBy("label").agg(F.min("entities_id").alias("manufacturer_entities_id"))


def update_instruments(nodes: DataFrame, systems: DataFrame, rules: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Owner and instrument by origin or source name. `rules`: name, entities_id, instruments_id.

    Only unset ones (id 1) change unless forced; an instrument changes only where the
    node's owner then is the rule's. Returns nodes, systems, and systems changed per rule.
    The reference runs its rules one after another: for a node that several name, the
    first in name order that may act does.
    """
    by_name = rules.groupBy(F.lower("name").alias("_k")).agg(F.min(F.struct("name", "entities_id", "instruments_id")).alias("_r"))
    a = by_name.select(F.col("_k").alias("_ko"), F.col("_r").alias("_ro"))
    b = by_name.select(F.col("_k").alias("_ks"), F.col("_r").alias("_rs"))
    matched = nodes.join(a, F.lower(F.col("origin")) == F.col("_ko"), "left").join(
        b, F.lower(F.col("source_name")) == F.col("_ks"), "left"
    ).withColumn("_rule", F.coalesce(F.least("_ro", "_rs"), "_ro", "_rs"))
    free = F.lit(True) if force else F.col("owner_entities_id") == 1
    owner = F.when(F.col("_rule").isNotNull() & free, F.col("_rule.entities_id")).otherwise(F.col("owner_entities_id"))
    owned = matched.withColumn("owner_entities_id", owner)
    acting = owned.where(F.col("_rule.entities_id") == F.col("owner_entities_id")).select("sensor_nodes_id", "_rule")
    open_ = F.lit(True) if force else F.col("instruments_id") == 1
    marked = systems.join(acting, "sensor_nodes_id", "left").withColumn("_acts", F.col("_rule").isNotNull() & open_)
    new_systems = marked.withColumn(
        "instruments_id", F.when(F.col("_acts"), F.col("_rule.instruments_id")).otherwise(F.col("instruments_id"))
    ).select(*systems.columns)
    counts = marked.where(F.col("_acts")).groupBy(F.col("_rule.name").alias("name")).agg(F.count("*").alias("n"))
    return owned.select(*nodes.columns), new_systems, rules.select("name").join(counts, "name", "left").fillna(0, ["n"])


def set_visibility(
    nodes: DataFrame, systems: DataFrame, sensors: DataFrame, providers: DataFrame, pattern: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, sensors and providers whose source or label matches become not public."""
    hidden = textops.imatch(F.col("source_name"), pattern)
    gone = systems.join(nodes.where(hidden).select("sensor_nodes_id"), "sensor_nodes_id", "left_semi").select(
        "sensor_systems_id", F.lit(True).alias("_gone")
    )
    off = lambda test: F.when(F.coalesce(test, F.lit(False)), False).otherwise(F.col("is_public"))
    return (
        nodes.withColumn("is_public", off(hidden)),
        sensors.join(gone, "sensor_systems_id", "left").withColumn("is_public", off(F.col("_gone"))).select(*sensors.columns),
        providers.withColumn("is_public", off(textops.imatch(F.col("label"), pattern))),
    )


# Fixed value: pattern of meteorological measurands.
METEOROLOGICAL = "temp|rh|relative|pressure|humid|wind"


def classify_parameter(measurands: DataFrame, default: Column | None = None, pattern: str = METEOROLOGICAL) -> DataFrame:
    other = F.lit(None).cast("string") if default is None else default
    return measurands.withColumn(
        "parameter_type", F.when(textops.imatch(F.col("measurand"), pattern), "meteorological").otherwise(other)
    )


def build_measurand_map(existing: DataFrame, keys: DataFrame, measurands: DataFrame) -> DataFrame:
    """`keys`: source_name, key, measurand, units; inserted where (key, units) is absent."""
    rows = keys.join(measurands.select("measurands_id", "measurand", "units"), ["measurand", "units"])
    return insert_absent(existing, rows.select("key", "measurands_id", "units", "source_name"), ["key", "units"])


def reject_summary(rejects: DataFrame, kind: str, fields: Sequence[str]) -> DataFrame:
    """Counts of rejected rows of one kind by fields of their JSON."""
    rows = rejects.where(F.col("tbl") == kind).select(*[F.get_json_object("r", f"$.{f}").alias(f) for f in fields])
    return rows.groupBy(*fields).agg(F.count("*").alias("n"))


# ---- sources -------------------------------------------------------------------------------------


def merge_json(df: DataFrame, keys: Sequence[str], json_col: str, order: Column, name: str) -> DataFrame:
    """One JSON object (text) per key: each member as the last row by `order` has it.

    Values keep their JSON types. Members are reduced before they are gathered, so a
    group's copies never pile up.
    """
    entries = df.select(*keys, F.explode(textops.json_members(F.col(json_col))).alias("_f", "_v"), order.alias("_o"))
    entries = entries.select(*keys, "_f", F.to_json("_v").alias("_v"), "_o")
    last = entries.groupBy(*keys, "_f").agg(F.max_by("_v", F.struct("_o", "_v")).alias("_v"))
    gathered = F.map_from_entries(F.sort_array(F.collect_list(F.struct("_f", "_v"))))
    merged = last.groupBy(*keys).agg(gathered.alias(name))
    return merged.withColumn(name, F.to_json(F.transform_values(name, lambda k, v: F.parse_json(v))))


def update_sources(
    nodes: DataFrame,
    origins: DataFrame,
    sources: DataFrame,
    links: DataFrame,
    direct_origin: str,
    attributed_origin: str,
    readmes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Origins, sources and node-source links from node metadata (JSON text).

    An origin is filled from metadata or source name, upper case, and origin metadata
    goes over that of nodes without `entity`. Nodes of the direct origin link by slug =
    source name; those of the attributed origin by the names in their attribution list;
    all others without attribution by source name in any case. `sources`: sources_id,
    slug, name, metadata (JSON text) and with `readmes` (slug, readme) the readme, filled
    where it is missing in sources there were or that the direct origin adds. Values of
    metadata keep their JSON types. Returns nodes, sources, links.
    """
    text = textops.member_string
    named = nodes.withColumn("_m", textops.json_members(F.col("metadata"))).withColumn(
        "origin", F.coalesce("origin", F.upper(F.coalesce(text(F.col("_m"), "origin"), F.col("source_name"))))
    )
    told = origins.select("origin", textops.json_members(F.col("metadata")).alias("_o"))
    merged = named.join(told, "origin", "left")
    over = textops.members_over(F.col("_m"), F.col("_o"))
    clean = F.map_filter(textops.members_without_null(over), lambda k, v: ~k.isin("source_type", "origin"))
    with_entity = F.map_contains_key("_m", F.lit("entity")) & F.col("metadata").isNotNull()
    # the reference skips nodes without any metadata: the test for the field is NULL there
    take = F.col("_o").isNotNull() & F.col("metadata").isNotNull() & ~with_entity
    merged = merged.withColumn("_m", F.when(take, clean).otherwise(F.col("_m")))
    out_nodes = merged.withColumn(
        "metadata", F.when(take, textops.members_text(F.col("_m"))).otherwise(F.col("metadata"))
    ).select(*nodes.columns)

    origin = F.col("origin")
    has_list = F.map_contains_key("_m", F.lit("attribution"))
    direct = merged.where(origin == direct_origin)
    listed = F.from_json(F.to_json(F.col("_m")["attribution"]), f"array<{textops.JSON_MEMBERS}>")
    attributed = merged.where((origin == attributed_origin) & has_list).select("sensor_nodes_id", F.explode(listed).alias("_a"))
    attributed = attributed.select(
        "sensor_nodes_id", text(F.col("_a"), "name").alias("name"),
        textops.members_text(F.map_filter("_a", lambda k, v: k != "name")).alias("_fields"),
    )
    other = merged.where((origin != direct_origin) & F.col("metadata").isNotNull() & ~has_list)

    empty = F.lit(None).cast("string")
    from_direct = direct.select(
        F.col("source_name").alias("slug"), text(F.col("_m"), "sensor_node_source_fullname").alias("name"), empty.alias("metadata")
    ).where(F.col("name").isNotNull())
    from_list = merge_json(attributed, ["name"], "_fields", F.col("_fields"), "metadata")
    from_list = attributed.select("name").distinct().join(from_list, "name", "left").select(
        F.lit(None).cast("string").alias("slug"), "name", "metadata"
    )
    from_other = other.select(
        textops.slugify(F.col("source_name")).alias("slug"), F.col("source_name").alias("name"), empty.alias("metadata")
    )
    # earlier kinds win a name, as earlier inserts do
    offered = from_direct.withColumn("_k", F.lit(0)).unionByName(from_list.withColumn("_k", F.lit(1))).unionByName(
        from_other.withColumn("_k", F.lit(2))
    )
    first = offered.groupBy("name").agg(
        F.min_by(F.struct("slug", "metadata", "_k"), F.struct("_k", "slug", "metadata")).alias("_s")
    )
    fresh = first.join(sources.select("name"), "name", "left_anti").select(
        F.col("_s.slug").alias("slug"), "name", F.col("_s.metadata").alias("metadata"), (F.col("_s._k") == 0).alias("_direct")
    )
    added = fresh.select("slug", "name", "metadata")
    all_sources = sources.unionByName(assign_ids(added, sources, "sources_id", "name"), allowMissingColumns=True)
    if readmes is not None:
        late = fresh.where(~F.col("_direct")).select("name").withColumn("_late", F.lit(True))
        texts = readmes.groupBy("slug").agg(F.min("readme").alias("_readme"))
        all_sources = all_sources.join(texts, "slug", "left").join(late, "name", "left").withColumn(
            "readme", F.when(F.col("_late"), F.col("readme")).otherwise(F.coalesce("readme", "_readme"))
        ).select(*all_sources.columns)

    by_slug = direct.join(all_sources.select(F.col("slug").alias("source_name"), "sources_id"), "source_name")
    by_name = attributed.join(all_sources.select("name", "sources_id"), "name")
    by_any_case = other.withColumn("_u", F.upper("source_name")).join(
        all_sources.select(F.upper("name").alias("_u"), "sources_id"), "_u"
    )
    pairs = [df.select("sensor_nodes_id", "sources_id") for df in (by_slug, by_name, by_any_case)]
    found = pairs[0].unionByName(pairs[1]).unionByName(pairs[2])
    return out_nodes, all_sources, insert_absent(links, found, ["sensor_nodes_id", "sources_id"])


# ---- migration of grouped stations -----------------------------------------------------------------


def sensors_import(
    sensors: DataFrame, sensor_systems: DataFrame, sensor_nodes: DataFrame, measurands: DataFrame, tracking: DataFrame | None = None
) -> DataFrame:
    """Cleaned station rows: periods by origin pattern, source id falling back to the
    site name and then the position."""
    # Origin pattern, averaging seconds, logging seconds.
    periods = [("SENSTATE", 60, 60), ("CLARITY", 90, 180), ("PURPLE", 120, 120), ("HABITAT", 1, 1), ("CMU", 3600, 3600)]
    stated = F.round(F.get_json_object(F.col("s.metadata"), "$.data_averaging_period_seconds").try_cast("double")).cast("int")
    averaging, logging = F.when(stated.isNotNull(), stated), None
    for pattern, a, b in periods:
        hit = F.coalesce(textops.imatch(F.col("n.origin"), pattern), F.lit(False))
        averaging = averaging.when(hit, a)
        logging = F.when(hit, b) if logging is None else logging.when(hit, b)
    site = F.regexp_replace(F.col("n.site_name"), "[|\\n\\r\\u2028]+", "")
    position = F.concat(F.col("n.lat").cast("string"), F.lit("/"), F.col("n.lon").cast("string"))
    rows = (
        sensors.alias("s")
        .join(measurands.alias("m"), F.col("s.measurands_id") == F.col("m.measurands_id"))
        .join(sensor_systems.alias("y"), F.col("s.sensor_systems_id") == F.col("y.sensor_systems_id"))
        .join(sensor_nodes.alias("n"), F.col("y.sensor_nodes_id") == F.col("n.sensor_nodes_id"))
    )
    out = rows.select(
        F.col("s.sensors_id"), F.col("n.sensor_nodes_id"), F.col("y.sensor_systems_id"), F.col("m.measurands_id"),
        F.col("s.source_id").alias("sensors_source_id"), F.col("m.measurand"), F.col("m.units"),
        averaging.otherwise(3600).alias("data_averaging_period_seconds"),
        logging.otherwise(3600).alias("data_logging_period_seconds"),
        F.coalesce(F.col("n.source_id"), site, position).alias("source_id"), F.col("n.source_name"), site.alias("site_name"),
        F.col("n.lon"), F.col("n.lat"), F.col("n.origin"), F.col("n.ismobile"),
    )
    if tracking is None:
        return out
    seen = tracking.select("sensors_id", "added_on", "modified_on", F.col("n").alias("modified_times"))
    return out.join(seen, "sensors_id", "left")


def group_import_nodes(rows: DataFrame, apart: Column | None = None, dropped: Column | None = None) -> DataFrame:
    """Stations of one (source id, source name): lowest id, count, spread, member ids.

    Rows meeting `apart` are not grouped but told from each other by their latitude;
    rows meeting `dropped` are left out.
    """
    if dropped is not None:
        rows = rows.where(~F.coalesce(dropped, F.lit(False)))
    special = F.coalesce(apart, F.lit(False)) if apart is not None else F.lit(False)
    keyed = rows.withColumn("_special", special).withColumn(
        "source_id", F.when(special, F.concat("source_id", F.lit("@"), F.col("lat").cast("string"))).otherwise(F.col("source_id"))
    ).withColumn("_lat", F.when(special, F.col("lat"))).withColumn("_lon", F.when(special, F.col("lon")))
    groups = keyed.groupBy("source_id", "source_name", "_special", "_lat", "_lon").agg(
        F.min("sensor_nodes_id").alias("sensor_nodes_id"),
        F.sort_array(F.collect_set("sensor_nodes_id")).alias("nodes"),
        F.round(F.stddev("lon") + F.stddev("lat"), 3).alias("geom_var"),
    )
    flat = groups.select("source_id", "source_name", "sensor_nodes_id", F.size("nodes").alias("n"), "geom_var", "nodes")
    return one_per_key(flat, ["source_id", "source_name"])


def node_map(groups: DataFrame, sensor_systems: DataFrame) -> DataFrame:
    """Old node to canonical node and its first system."""
    first = sensor_systems.groupBy("sensor_nodes_id").agg(F.min("sensor_systems_id").alias("sensor_systems_id"))
    rows = groups.join(first, "sensor_nodes_id").select(
        "sensor_nodes_id", "sensor_systems_id", F.explode("nodes").alias("old_sensor_nodes_id")
    )
    return rows.groupBy("old_sensor_nodes_id").agg(
        F.min(F.struct("sensor_nodes_id", "sensor_systems_id")).alias("_m")
    ).select("_m.*", "old_sensor_nodes_id")


def sensor_map(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Old sensor to canonical sensor: the highest id of the canonical node's measurand."""
    canonical = rows.join(nodes.select("sensor_nodes_id").distinct(), "sensor_nodes_id", "left_semi").groupBy(
        "sensor_nodes_id", "measurand", "units"
    ).agg(F.max("sensors_id").alias("sensors_id"))
    old = rows.select(
        F.col("sensors_id").alias("old_sensors_id"), F.col("sensor_nodes_id").alias("old_sensor_nodes_id"), "measurand", "units"
    )
    return old.join(nodes.select("sensor_nodes_id", "old_sensor_nodes_id"), "old_sensor_nodes_id").join(
        canonical, ["sensor_nodes_id", "measurand", "units"]
    ).select("sensors_id", "old_sensors_id", "sensor_nodes_id", "old_sensor_nodes_id")


def map_audit(rows: DataFrame, nodes: DataFrame, sensors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stations that no map covers, counts of the sensor map)."""
    unmapped = rows.join(
        nodes.select(F.col("old_sensor_nodes_id").alias("sensor_nodes_id")), "sensor_nodes_id", "left_anti"
    ).select("sensor_nodes_id", "source_name", "source_id")
    imported = sensors.groupBy("sensors_id").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("imported_sensors"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )
    mapped = sensors.select("old_sensors_id").distinct().agg(F.count("*")).scalar()
    counts = imported.select("*", mapped.alias("mapped_sensors"))
    return unmapped, counts.withColumn("diff", F.col("mapped_sensors") - F.col("imported_sensors"))


# ---- merging and removing sensors ------------------------------------------------------------------


class Merged(NamedTuple):
    """What a merge gives: see `merge_sensors`."""

    measurements: DataFrame
    archive: DataFrame
    touched: DataFrame
    refused: DataFrame
    allowed: DataFrame


def _parts(pairs: DataFrame) -> DataFrame:
    """The sensors of open pairs: sources with their target, targets with no source."""
    good = F.col("good_sensors_id")
    none = F.lit(None).cast(pairs.schema["bad_sensors_id"].dataType).alias("bad_sensors_id")
    sources = pairs.select(F.col("bad_sensors_id").alias("sensors_id"), "bad_sensors_id", good)
    return sources.unionByName(pairs.select(good.alias("sensors_id"), none, good).distinct())


def check_merges(measurements: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(allowed pairs, refused pairs with reason and number of clashing measurements).

    Refused are pairs with a missing id, of one sensor with itself, of a bad sensor with
    several good ones, and into a sensor that is merged away itself; and pairs of whose
    measurements one differs in value from the target's, or from that of another source of
    the same target, at one instant. Repeated pairs count once.
    """
    names = ["bad_sensors_id", "good_sensors_id"]
    bad, good = map(F.col, names)
    given = pairs.select(*names).distinct()
    plain = F.when(bad.isNull() | good.isNull(), "missing id").when(bad == good, "same sensor")
    given = given.withColumn("reason", plain)
    sound = given.where(F.col("reason").isNull()).select(*names)
    targets = sound.groupBy(bad).agg(F.count("*").alias("_targets"))
    leaving = sound.select(bad.alias("good_sensors_id")).distinct().withColumn("_leaves", F.lit(True))
    judged = sound.join(targets, "bad_sensors_id").join(leaving, "good_sensors_id", "left").select(
        *names, F.when(F.col("_targets") > 1, "several targets").when(F.col("_leaves"), "target is merged itself").alias("reason")
    )
    open_pairs = judged.where(F.col("reason").isNull()).select(*names)

    few = lambda side: broadcast_if_few(side, pairs)
    # each sensor has one part in the open pairs, so the measurements are read and shuffled once
    rows = measurements.join(few(_parts(open_pairs)), "sensors_id").select(*names, "datetime", "value")
    rows = rows.where(F.col("datetime").isNotNull())
    from_source, value = bad.isNotNull(), F.col("value")
    at = Window.partitionBy("good_sensors_id", "datetime")
    seen = rows.withColumns({
        "_low": F.min(F.when(from_source, value)).over(at), "_high": F.max(F.when(from_source, value)).over(at),
        "_held": F.max(F.when(~from_source, value)).over(at),
    })
    clash = seen.where(from_source & value.isNotNull() & ((F.col("_low") != F.col("_high")) | (value != F.col("_held"))))
    clash = clash.groupBy(*names).agg(F.count("*").alias("conflicts"))
    refused = (
        given.where(F.col("reason").isNotNull())
        .unionByName(judged.where(F.col("reason").isNotNull()))
        .withColumn("conflicts", F.lit(0).cast("bigint"))
        .unionByName(clash.withColumn("reason", F.lit("values differ")).select(*names, "reason", "conflicts"))
    )
    return open_pairs.join(clash, names, "left_anti"), refused


def merge_sensors(measurements: DataFrame, pairs: DataFrame, ctx: DataFrame, as_of: str) -> Merged:
    """Merge sensors in bulk; `pairs`: bad_sensors_id, good_sensors_id.

    Nothing of a refused pair moves (see `check_merges`). Of several sources' rows at one
    instant the first with a value is taken; the target's own rows stay. Touched periods are
    hour keys for `mark_modified`. The bad sensors of the allowed pairs are still in the
    other tables: `remove_merged` takes them out.
    """
    allowed, refused = check_merges(measurements, pairs)
    allowed = cut_lineage(allowed)
    side = broadcast_if_few(allowed, allowed)
    moving = measurements.join(side.withColumnRenamed("bad_sensors_id", "sensors_id"), "sensors_id")
    # rows that move and rows that are there in one pass: of a target's instant without a row, one that moves
    parts = measurements.join(broadcast_if_few(_parts(allowed), allowed), "sensors_id")
    moves, rest = F.col("bad_sensors_id").isNotNull(), [c for c in measurements.columns if c not in ("sensors_id", "datetime")]
    row = F.struct(F.col("value").isNull().alias("_empty"), *rest)
    met = parts.groupBy(F.col("good_sensors_id").alias("sensors_id"), "datetime").agg(
        F.min(F.when(moves, row)).alias("_row"), F.max(~moves).alias("_there")
    )
    met = met.where(F.col("_row").isNotNull() & (~F.col("_there") | F.col("datetime").isNull()))
    fresh = met.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in measurements.columns])
    kept = measurements.join(side.select(F.col("bad_sensors_id").alias("sensors_id")), "sensors_id", "left_anti")
    archive = moving.select(
        *measurements.columns, timeops.instant(as_of).alias("archived_on"),
        F.concat(F.lit("merged into sensor "), F.col("good_sensors_id").cast("string")).alias("archive_reason"),
    )
    offset = timeops.offset_seconds("datetime", F.col("tzid"))
    touched = join_context(fresh, ctx, "tzid").select(
        timeops.hour_end("datetime", offset).alias("datetime"), offset.alias("offset_s")
    ).distinct()
    return Merged(kept.unionByName(fresh), archive, touched, refused, allowed)


def remove_merged(merged: Merged, tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The other tables (`sensors` among them) without the sensors that were merged away."""
    return remove_sensor_data(tables, merged.allowed.select(F.col("bad_sensors_id").alias("sensors_id")))


def remove_sensor_data(
    tables: Mapping[str, DataFrame], sensor_ids: DataFrame, delete_sensor: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Drop sensors from every table (by sensors_id), and from `sensors` and
    `sensors_history` too with `delete_sensor`. Returns tables and removed rows per table."""
    ids = sensor_ids.select("sensors_id").distinct()
    kept, counts = {}, None
    for name, table in tables.items():
        if name in ("sensors", "sensors_history") and not delete_sensor:
            kept[name] = table
            continue
        kept[name] = table.join(ids, "sensors_id", "left_anti")
        gone = table.join(ids, "sensors_id", "left_semi").agg(F.count("*").alias("removed")).select(
            F.lit(name).alias("table_name"), "removed"
        )
        counts = gone if counts is None else counts.unionByName(gone)
    return kept, counts


def clean_sensor_nodes(
    nodes: DataFrame, systems: DataFrame, sensors: DataFrame, links: DataFrame, lifetime: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Remove sensors without data, then systems, links and nodes left empty."""
    active = lifetime.where(F.col("datetime_first").isNotNull()).select("sensors_id")
    live = sensors.join(active, "sensors_id", "left_semi")
    used = systems.join(live.select("sensor_systems_id").distinct(), "sensor_systems_id", "left_semi")
    placed = used.select("sensor_nodes_id").distinct()
    return (
        nodes.join(placed, "sensor_nodes_id", "left_semi"), used, live, links.join(placed, "sensor_nodes_id", "left_semi")
    )


