"""Catalog views with nested results.

Arrays hold the members of one station, country or provider: they are the result
itself. Each list is built from rows already reduced to one per member and sorted,
so output does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions import textops, timeops
from airloom.functions.joins import join_null_safe, never_broadcast
from airloom.operators.ranking import spread_row_number


def _list(*columns) -> Column:
    return F.sort_array(F.collect_list(F.struct(*columns)))


def _set(column) -> Column:
    return F.sort_array(F.collect_set(column))


# ---- licences and locations --------------------------------------------------------------------


def provider_licenses(providers_licenses: DataFrame, licenses: DataFrame) -> DataFrame:
    rows = providers_licenses.join(licenses.select("licenses_id", "name"), "licenses_id")
    item = (F.col("licenses_id").alias("id"), "name", F.col("valid_from").alias("date_from"), F.col("valid_to").alias("date_to"))
    return rows.groupBy("providers_id").agg(_list(*item).alias("licenses"))


def location_licenses(
    providers_licenses: DataFrame, licenses: DataFrame, sensor_nodes: DataFrame, entities: DataFrame
) -> DataFrame:
    """Licences per node with the attribution of its owner; built per (provider, owner)
    and then given to the nodes, so the lists are made once, not once per node."""
    owners = entities.select(F.col("entities_id").alias("owner_entities_id"), F.col("full_name").alias("owner_name"), "url")
    pairs = sensor_nodes.select("providers_id", "owner_entities_id").distinct().join(owners, "owner_entities_id")
    rows = pairs.join(providers_licenses, "providers_id").join(licenses.select("licenses_id", "name"), "licenses_id")
    lists = rows.groupBy("providers_id", "owner_entities_id").agg(
        _list(
            F.col("licenses_id").alias("id"), "name", F.col("valid_from").alias("date_from"),
            F.col("valid_to").alias("date_to"),
            F.struct(F.col("owner_name").alias("name"), "url").alias("attribution"),
        ).alias("licenses"),
        _set("licenses_id").alias("license_ids"),
    )
    return sensor_nodes.select("sensor_nodes_id", "providers_id", "owner_entities_id").join(
        lists, ["providers_id", "owner_entities_id"]
    ).select("sensor_nodes_id", "licenses", "license_ids")


def _makers(instruments: DataFrame, entities: DataFrame) -> DataFrame:
    makers = entities.select(F.col("entities_id").alias("manufacturer_entities_id"), F.col("full_name").alias("maker"))
    return instruments.join(makers, "manufacturer_entities_id")


def locations_view(
    sensor_nodes: DataFrame,
    sensor_systems: DataFrame,
    sensors: DataFrame,
    measurands: DataFrame,
    lifetime: DataFrame,
    timezones: DataFrame,
    countries: DataFrame,
    entities: DataFrame,
    providers: DataFrame,
    instruments: DataFrame,
    providers_licenses: DataFrame,
    licenses: DataFrame,
) -> DataFrame:
    """One row per public node, with owner, provider, instruments, sensors and licences."""
    public = sensor_nodes.where(F.col("is_public"))
    systems = sensor_systems.join(public.select("sensor_nodes_id"), "sensor_nodes_id", "left_semi")
    node_instruments = systems.join(_makers(instruments, entities), "instruments_id").groupBy("sensor_nodes_id").agg(
        F.bool_or("is_monitor").alias("ismonitor"),
        _list(
            F.col("instruments_id").alias("id"), F.col("label").alias("name"),
            F.struct(F.col("manufacturer_entities_id").alias("id"), F.col("maker").alias("name")).alias("manufacturer"),
        ).alias("instruments"),
        _set("instruments_id").alias("instrument_ids"),
        _set("maker").alias("manufacturers"),
        _set("manufacturer_entities_id").alias("manufacturer_ids"),
    )
    last = lifetime.select("sensors_id", "datetime_first", "datetime_last", "value_latest")
    node_sensors = (
        systems.select("sensor_systems_id", "sensor_nodes_id")
        .join(sensors.select("sensors_id", "sensor_systems_id", "measurands_id"), "sensor_systems_id")
        .join(measurands, "measurands_id")
        .join(last, "sensors_id", "left")
        .groupBy("sensor_nodes_id")
        .agg(
            F.min("datetime_first").alias("first"),
            F.max("datetime_last").alias("last"),
            _list(
                F.col("sensors_id").alias("id"),
                F.concat("measurand", F.lit(" "), "units").alias("name"),
                F.struct(
                    F.col("measurands_id").alias("id"), F.col("measurand").alias("name"), "units",
                    F.col("value_latest").alias("value_last"), "datetime_last", F.col("display").alias("display_name"),
                ).alias("parameter"),
            ).alias("sensors"),
            _set("measurand").alias("parameters"),
            _set("measurands_id").alias("parameter_ids"),
        )
    )
    node_licenses = location_licenses(providers_licenses, licenses, public, entities)
    owners = entities.select(
        F.col("entities_id").alias("owner_entities_id"),
        F.struct(F.col("entities_id").alias("id"), F.col("full_name").alias("name"), F.col("entity_type").alias("type")).alias("owner"),
    )
    return (
        public.join(timezones.select("timezones_id", "tzid"), "timezones_id")
        .join(
            countries.select(
                "countries_id",
                F.struct(F.col("countries_id").alias("id"), F.col("iso").alias("code"), "name").alias("country_object"),
            ),
            "countries_id",
        )
        .join(owners, "owner_entities_id")
        .join(
            providers.select(
                "providers_id", F.struct(F.col("providers_id").alias("id"), F.col("label").alias("name")).alias("provider")
            ),
            "providers_id",
        )
        .join(node_instruments, "sensor_nodes_id")
        .join(node_sensors, "sensor_nodes_id")
        .join(node_licenses, "sensor_nodes_id", "left")
        .select(
            F.col("sensor_nodes_id").alias("id"),
            F.col("site_name").alias("name"),
            "ismobile",
            F.col("tzid").alias("timezone"),
            "ismonitor",
            "city",
            F.col("country_object").alias("country"),
            "owner",
            "provider",
            F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("coordinates"),
            "instruments",
            "sensors",
            timeops.datetime_object("first", F.col("tzid")).alias("datetime_first"),
            timeops.datetime_object("last", F.col("tzid")).alias("datetime_last"),
            "countries_id",
            "parameters",
            "parameter_ids",
            textops.imatch(F.col("owner.type"), "research").alias("is_analysis"),
            "manufacturers",
            "manufacturer_ids",
            "instrument_ids",
            "licenses",
            "license_ids",
            "providers_id",
        )
    )


def locations_manufacturers(
    sensor_nodes: DataFrame, sensor_systems: DataFrame, instruments: DataFrame, entities: DataFrame
) -> DataFrame:
    public = sensor_nodes.where(F.col("is_public")).select("sensor_nodes_id")
    pairs = (
        sensor_systems.join(public, "sensor_nodes_id")
        .join(_makers(instruments, entities), "instruments_id")
        .select(F.col("sensor_nodes_id").alias("id"), F.col("label").alias("modelName"), F.col("maker").alias("manufacturerName"))
        .distinct()
    )
    return pairs.groupBy("id").agg(_list("modelName", "manufacturerName").alias("manufacturers"))


def locations_latest_measurements(
    sensor_nodes: DataFrame, sensor_systems: DataFrame, sensors: DataFrame, measurands: DataFrame, lifetime: DataFrame
) -> DataFrame:
    rows = (
        sensor_nodes.where(F.col("is_public")).select("sensor_nodes_id", "source_name")
        .join(sensor_systems.select("sensor_nodes_id", "sensor_systems_id"), "sensor_nodes_id")
        .join(sensors.select("sensors_id", "sensor_systems_id", "measurands_id", "data_averaging_period_seconds"), "sensor_systems_id")
        .join(lifetime, "sensors_id")
        .join(measurands, "measurands_id")
    )
    units = F.coalesce("units", F.lit("n/a"))
    return rows.groupBy(F.col("sensor_nodes_id").alias("id")).agg(
        _list(
            F.col("measurand").alias("parameter"), F.col("measurands_id").alias("id"),
            F.col("measurands_id").alias("parameterId"), F.col("units").alias("unit"),
            F.col("value_latest").alias("value"), F.col("datetime_last").alias("lastUpdated"),
            F.col("source_name").alias("sourceName"), F.concat("measurand", F.lit(" "), units).alias("displayName"),
            F.col("value_count").alias("count"), F.col("value_avg").alias("average"),
            F.col("value_latest").alias("lastValue"), F.col("datetime_first").alias("firstUpdated"),
            F.struct(F.col("data_averaging_period_seconds").alias("value"), F.lit("seconds").alias("unit")).alias("averagingPeriod"),
        ).alias("measurements"),
        _list(
            F.col("measurands_id").alias("id"), F.concat("measurand", F.lit(" "), "units").alias("parameter"),
            F.col("value_count").alias("count"),
        ).alias("counts"),
        F.sort_array(F.collect_list("measurand")).alias("parameters"),
        F.sum("value_count").alias("total_count"),
    )


def source_stats(
    sensor_nodes: DataFrame, providers: DataFrame, ctx: DataFrame, lifetime: DataFrame, as_of: str
) -> DataFrame:
    """Nodes in total, added and active within a day, per provider source name."""
    since = timeops.shift(timeops.instant(as_of), -86400)
    names = providers.select("providers_id", "source_name")
    nodes = sensor_nodes.select("sensor_nodes_id", "providers_id", "added_on").join(names, "providers_id")
    active = (
        lifetime.select("sensors_id", "modified_on")
        .join(ctx.select("sensors_id", "sensor_nodes_id"), "sensors_id")
        .groupBy("sensor_nodes_id")
        .agg(F.max("modified_on").alias("last_modified"))
    )
    rows = nodes.join(active, "sensor_nodes_id", "left")
    return rows.groupBy("source_name").agg(
        F.count("*").alias("nodes_total"),
        F.count_if(F.col("added_on") > since).alias("nodes_added"),
        F.count_if(F.col("last_modified") > since).alias("nodes_active"),
        F.max("last_modified").alias("last_modified"),
    )


# ---- countries, providers, parameters ----------------------------------------------------------


def _public_parameters(ctx: DataFrame, lifetime: DataFrame, owner: str) -> DataFrame:
    """Per owner and measurand, over public sensors of public nodes."""
    rows = ctx.where(F.col("node_is_public") & F.col("sensor_is_public")).select("sensors_id", "measurands_id", owner)
    return rows.join(lifetime.select("sensors_id", "datetime_first", "datetime_last", "value_count"), "sensors_id").groupBy(
        owner, "measurands_id"
    ).agg(
        F.min("datetime_first").alias("first"), F.max("datetime_last").alias("last"), F.sum("value_count").alias("n")
    )


def _parameter_rollup(parameters: DataFrame, measurands: DataFrame, owner: str) -> DataFrame:
    return parameters.join(measurands.select("measurands_id", "measurand", "units"), "measurands_id").groupBy(owner).agg(
        F.min("first").alias("datetime_first"),
        F.max("last").alias("datetime_last"),
        F.sum("n").alias("measurements_count"),
        _list(F.col("measurands_id").alias("id"), F.col("measurand").alias("name"), "units").alias("parameters"),
        _set("measurands_id").alias("parameter_ids"),
    )


def countries_view(
    countries: DataFrame, sensor_nodes: DataFrame, ctx: DataFrame, lifetime: DataFrame, measurands: DataFrame
) -> DataFrame:
    """Locations count all nodes, measurements only public ones, as in the reference."""
    pairs = sensor_nodes.groupBy("countries_id", "providers_id").agg(F.count("*").alias("n"))
    located = pairs.groupBy("countries_id").agg(
        F.sum("n").alias("locations_count"), F.count("providers_id").alias("providers_count"),
        _set("providers_id").alias("providers_ids"),
    )
    rolled = _parameter_rollup(_public_parameters(ctx, lifetime, "countries_id"), measurands, "countries_id")
    return countries.join(located, "countries_id").join(rolled, "countries_id", "left").select(
        F.col("countries_id").alias("id"), "name", F.col("iso").alias("code"), "datetime_first", "datetime_last",
        "measurements_count", "locations_count", "providers_count", "parameters", "parameter_ids", "providers_ids",
    )


def providers_view(
    providers: DataFrame, sensor_nodes: DataFrame, ctx: DataFrame, lifetime: DataFrame, measurands: DataFrame, entities: DataFrame
) -> DataFrame:
    """Public providers with data, their extent and owner, by label."""
    pairs = sensor_nodes.where(F.col("is_public")).groupBy("providers_id", "countries_id").agg(
        F.count("*").alias("n"), *[f(c).alias(f"{p}_{c}") for c in ("lon", "lat") for f, p in ((F.min, "lo"), (F.max, "hi"))]
    )
    located = pairs.groupBy("providers_id").agg(
        F.sum("n").alias("locations_count"), F.count("countries_id").alias("countries_count"),
        F.struct(
            F.min("lo_lon").alias("xmin"), F.min("lo_lat").alias("ymin"), F.max("hi_lon").alias("xmax"), F.max("hi_lat").alias("ymax")
        ).alias("extent"),
    )
    rolled = _parameter_rollup(_public_parameters(ctx, lifetime, "providers_id"), measurands, "providers_id")
    owners = entities.select(
        F.col("entities_id").alias("owner_entities_id"),
        F.struct(F.col("entities_id").alias("id"), F.col("full_name").alias("name")).alias("owner_entity"),
    )
    return (
        providers.where(F.col("is_public")).join(rolled, "providers_id").join(located, "providers_id")
        .join(owners, "owner_entities_id")
        .select(
            F.col("providers_id").alias("id"), F.col("label").alias("name"), "source_name", "export_prefix", "datetime_first",
            "datetime_last", F.col("added_on").alias("datetime_added"), "measurements_count", "locations_count",
            "countries_count", "parameters", "parameter_ids", "owner_entity", "extent",
        )
        .orderBy(F.lower("name"))
    )


def parameters_view(measurands: DataFrame, sensors: DataFrame, ctx: DataFrame, lifetime: DataFrame) -> DataFrame:
    """Per measurand. `locations_count` counts sensors, as in the reference."""
    placed = ctx.select("sensors_id", "measurands_id")
    located = placed.groupBy("measurands_id").agg(F.count("*").alias("locations_count"))
    measured = placed.join(lifetime.select("sensors_id", "datetime_first", "datetime_last", "value_count"), "sensors_id").groupBy(
        "measurands_id"
    ).agg(
        F.sum("value_count").alias("measurements_count"), F.min("datetime_first").alias("datetime_first"),
        F.max("datetime_last").alias("datetime_last"),
    )
    return measurands.join(located, "measurands_id").join(measured, "measurands_id", "left").select(
        F.col("measurands_id").alias("id"), F.col("measurand").alias("name"), F.col("display").alias("display_name"), "units",
        "locations_count", "measurements_count", "datetime_first", "datetime_last",
    )


def manufacturers(instruments: DataFrame, entities: DataFrame) -> DataFrame:
    counts = instruments.groupBy(F.col("manufacturer_entities_id").alias("entities_id")).agg(F.count("*").alias("instruments_count"))
    return entities.select("entities_id", "full_name").join(counts, "entities_id")


# ---- sources -------------------------------------------------------------------------------------


def source_json(slug: Column, name: Column, readme: Column, metadata: Column | None = None) -> Column:
    """Source as JSON text without NULLs; the members of `metadata` (JSON text) go over its own."""
    link = F.when(readme.isNotNull(), F.concat(F.lit("/v2/sources/readme/"), slug))
    fields = textops.json_members(F.to_json(F.struct(slug.alias("id"), name.alias("name"), link.alias("readme"))))
    if metadata is not None:
        fields = textops.members_over(fields, textops.json_members(metadata))
    return textops.members_text(textops.members_without_null(fields))


def node_sources(sensor_nodes_sources: DataFrame, sources: DataFrame) -> DataFrame:
    """Per node, the list of its sources as JSON texts, their own metadata (JSON text) included."""
    metadata = F.col("metadata") if "metadata" in sources.columns else None
    told = sources.select("sources_id", source_json(F.col("slug"), F.col("name"), F.col("readme"), metadata).alias("source"))
    return sensor_nodes_sources.join(told, "sources_id", "left").groupBy("sensor_nodes_id").agg(
        F.sort_array(F.collect_list("source")).alias("sources")
    )


def sources_of_nodes(nodes: DataFrame, sensor_nodes_sources: DataFrame, sources: DataFrame, group: str) -> DataFrame:
    """Distinct sources per group of nodes (`nodes`: group, sensor_nodes_id)."""
    pairs = nodes.join(sensor_nodes_sources, "sensor_nodes_id").select(group, "sources_id").distinct()
    told = sources.select("sources_id", source_json(F.col("slug"), F.col("name"), F.col("readme")).alias("source"))
    return pairs.join(told, "sources_id").groupBy(group).agg(_set("source").alias("sources"))


def source_in_nodes(requests: DataFrame, sensor_nodes_sources: DataFrame, sources: DataFrame) -> DataFrame:
    """Requests (request_id, sensor_nodes_id, slug): per request, does any listed node
    have any listed source? One row per listed pair."""
    known = sensor_nodes_sources.join(sources.select("sources_id", "slug"), "sources_id").select("sensor_nodes_id", "slug").distinct()
    hit = requests.join(known.withColumn("_hit", F.lit(True)), ["sensor_nodes_id", "slug"], "left")
    return hit.groupBy("request_id").agg(F.coalesce(F.bool_or("_hit"), F.lit(False)).alias("found"))


def sources_per(sensor_nodes: DataFrame, sensor_nodes_sources: DataFrame, column: str) -> DataFrame:
    """Distinct sources per country or city."""
    pairs = sensor_nodes.select("sensor_nodes_id", column).join(sensor_nodes_sources, "sensor_nodes_id", "left")
    return pairs.groupBy(column, "sources_id").agg(F.lit(1).alias("_one")).groupBy(column).agg(
        F.count("sources_id").alias("sources_count")
    )


def sensor_nodes_ext(
    sensor_nodes: DataFrame, name_history: DataFrame, origins: DataFrame, sources: DataFrame
) -> DataFrame:
    """Nodes with merged metadata, all of it JSON text: own members without the attribution,
    the origin's over them, then past names and sources. Later ones win, nulls go."""
    own = F.map_filter(textops.json_members(F.col("_own")), lambda k, v: k != "attribution")
    past = F.to_json(F.struct("cities", "source_names", "site_names"))
    told = F.concat(F.lit("["), F.array_join("sources", ","), F.lit("]"))
    added = F.map_concat(
        F.create_map(F.lit("pvals"), F.parse_json(past)), F.create_map(F.lit("sources"), F.try_parse_json(told))
    )
    merged = textops.members_over(
        textops.members_over(own, textops.json_members(F.col("origin_metadata"))), added
    )
    merged = textops.members_text(textops.members_without_null(merged))
    return (
        sensor_nodes.withColumnRenamed("metadata", "_own").join(name_history, "sensor_nodes_id", "left")
        .join(origins.select("origin", F.col("metadata").alias("origin_metadata")), "origin", "left")
        .join(sources, "sensor_nodes_id", "left")
        .select(
            "sensor_nodes_id", "country", "city", "lon", "lat", "ismobile",
            (F.col("lon").isNotNull() | F.col("ismobile")).alias("has_geo"), "source_name", "origin",
            merged.alias("metadata"),
        )
    )


# ---- audits --------------------------------------------------------------------------------------


def sensor_nodes_check(
    sensor_nodes: DataFrame,
    timezones: DataFrame,
    providers: DataFrame,
    sensor_systems: DataFrame,
    sensors: DataFrame,
    measurands: DataFrame,
    lifetime: DataFrame,
    as_of: str,
) -> DataFrame:
    """Every node and sensor with how complete its data is; offsets are those at `as_of`."""
    span = timeops.seconds_between("datetime_last", "datetime_first")
    expected = F.try_divide(span, F.col("data_logging_period_seconds"))
    complete = F.round(F.try_divide(F.col("value_count"), expected) * 100)
    rows = (
        sensor_nodes.withColumnRenamed("added_on", "node_added_on").withColumnRenamed("source_id", "node_source_id")
        .join(timezones.select("timezones_id", "tzid"), "timezones_id", "left")
        .join(providers.select("providers_id", "label"), "providers_id", "left")
        .join(sensor_systems.select("sensor_nodes_id", "sensor_systems_id"), "sensor_nodes_id", "left")
        .join(
            sensors.select("sensors_id", "sensor_systems_id", "measurands_id", "data_logging_period_seconds",
                           F.col("added_on").alias("sensor_added_on")),
            "sensor_systems_id", "left",
        )
        .join(measurands.select("measurands_id", "measurand", "units"), "measurands_id", "left")
        .join(lifetime.select("sensors_id", "datetime_first", "datetime_last", "value_count"), "sensors_id", "left")
    )
    return rows.select(
        "sensor_nodes_id", "site_name", "source_name", F.col("node_source_id").alias("source_id"), "origin",
        F.coalesce("label", F.lit("Not found")).alias("provider"), "lon", "lat", F.col("tzid").alias("timezone"),
        timeops.offset_seconds(timeops.instant(as_of), F.col("tzid")).alias("utc_offset"), "sensors_id",
        F.coalesce(F.concat("measurand", F.lit(" "), "units"), F.lit("Not found")).alias("parameter"),
        "datetime_first", "datetime_last",
        F.when(F.col("datetime_first") < F.col("datetime_last"), complete).alias("percent_complete"),
        "sensor_added_on", "node_added_on", "data_logging_period_seconds",
    )


def sensor_nodes_summary(
    sensor_nodes: DataFrame, sensor_systems: DataFrame, sensors: DataFrame, measurands: DataFrame
) -> DataFrame:
    """Counts and sensor list per node. `systems_count` counts join rows as the reference
    does (one per sensor); `distinct_systems_count` counts systems."""
    rows = (
        sensor_systems.select("sensor_nodes_id", "sensor_systems_id")
        .join(sensors.select("sensors_id", "sensor_systems_id", "measurands_id"), "sensor_systems_id", "left")
        .join(measurands.select("measurands_id", "measurand"), "measurands_id", "left")
    )
    counts = rows.groupBy("sensor_nodes_id").agg(
        F.count("sensor_systems_id").alias("systems_count"),
        F.count("sensors_id").alias("sensors_count"),
        F.size(F.collect_set("measurands_id")).alias("parameters_count"),
        F.size(F.collect_set("sensor_systems_id")).alias("distinct_systems_count"),
        _list("sensors_id", "measurand").alias("sensors_list"),
    )
    zero = F.lit(0)
    lone = F.array(F.struct(F.lit(None).cast("bigint").alias("sensors_id"), F.lit(None).cast("string").alias("measurand")))
    return sensor_nodes.join(counts, "sensor_nodes_id", "left").select(
        "sensor_nodes_id", "site_name", "source_name", "source_id", "origin", "ismobile",
        F.col("lon").isNotNull().alias("has_coordinates"),
        *[F.coalesce(c, zero).alias(c) for c in ("systems_count", "sensors_count", "parameters_count", "distinct_systems_count")],
        F.coalesce("sensors_list", lone).alias("sensors_list"),
    )


def providers_check(lifetime: DataFrame, ctx: DataFrame, providers: DataFrame) -> DataFrame:
    """Per provider: data span, nodes, average sensors per node."""
    nodes = lifetime.select("sensors_id", "datetime_first", "datetime_last").join(
        ctx.select("sensors_id", "sensor_nodes_id", "providers_id"), "sensors_id"
    ).groupBy("sensor_nodes_id", "providers_id").agg(
        F.min("datetime_first").alias("a"), F.max("datetime_last").alias("b"), F.count("*").alias("n")
    )
    return nodes.join(providers.select("providers_id", "label"), "providers_id").groupBy("label").agg(
        F.min("a").alias("datetime_first"), F.max("b").alias("datetime_last"), F.count("*").alias("sensor_nodes_count"),
        F.round(F.avg("n"), 1).alias("sensors_avg"), F.sum("n").alias("sensors_count"),
    )


# ---- lists, versions, groups ---------------------------------------------------------------------


def user_lists_view(lists: DataFrame, users_lists: DataFrame, sensor_nodes_list: DataFrame, sensor_nodes: DataFrame) -> DataFrame:
    """List and member (owners and shared users as a set), node ids and extent.

    `bbox` is a closed ring; without positions it is the whole world. An extent that is
    a line gets the world ring too, as in the reference.
    """
    owners = lists.select("lists_id", "users_id", F.lit("owner").alias("role"))
    members = users_lists.select("lists_id", "users_id", "role").union(owners).distinct()
    counts = members.groupBy("lists_id").agg(F.count("*").alias("user_count"))
    nodes = sensor_nodes_list.join(sensor_nodes.select("sensor_nodes_id", "lon", "lat"), "sensor_nodes_id", "left")
    grouped = nodes.groupBy("lists_id").agg(
        F.count("*").alias("locations_count"),
        F.sort_array(F.collect_list("sensor_nodes_id")).alias("sensor_nodes_ids"),
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1"),
    )

    def ring(*points) -> Column:
        return F.array(*[F.array(F.lit(x).cast("double") if isinstance(x, int) else x, F.lit(y).cast("double") if isinstance(y, int) else y) for x, y in points])

    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    world = ring((-180, -90), (-180, 90), (180, 90), (180, -90), (-180, -90))
    box = ring((x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0))
    is_area, is_point = (x0 < x1) & (y0 < y1), (x0 == x1) & (y0 == y1)
    return (
        lists.withColumnRenamed("users_id", "owner_id").join(members, "lists_id").join(counts, "lists_id")
        .join(grouped, "lists_id", "left")
        .select(
            "lists_id", "owner_id", "users_id", "role", "label", "visibility", "user_count",
            F.coalesce("locations_count", F.lit(0)).alias("locations_count"), "sensor_nodes_ids",
            F.struct("x0", "y0", "x1", "y1").alias("bounds"),
            F.when(is_area | is_point, box).otherwise(world).alias("bbox"),
        )
    )


def version_ranks(versions: DataFrame, sensor_statuses: DataFrame) -> DataFrame:
    """Versions ranked per parent, newest date first, then highest status."""
    rows = versions.join(sensor_statuses, "sensor_statuses_id")
    ranked = spread_row_number(
        rows, ["parent_sensors_id"], [("version_date", False), ("sort_order", False), ("versions_id", True)], "version_rank"
    )
    return ranked.select(
        "versions_id", "parent_sensors_id", "sensors_id", "sensor_statuses_id", "version_date", "sort_order", "label",
        "version_rank",
    )


def versions_view(ranks: DataFrame, sensors: DataFrame, sensor_systems: DataFrame) -> DataFrame:
    own = sensors.select("sensors_id", F.col("source_id").alias("sensor"), "sensor_systems_id")
    parents = sensors.select(F.col("sensors_id").alias("parent_sensors_id"), F.col("source_id").alias("parent_sensor"))
    systems = sensor_systems.select("sensor_systems_id", "sensor_nodes_id")
    return (
        ranks.join(never_broadcast(own), "sensors_id").join(never_broadcast(parents), "parent_sensors_id")
        .join(never_broadcast(systems), "sensor_systems_id")
        .select(
            "versions_id", "sensors_id", "parent_sensors_id", "sensor_statuses_id", "sensor", "parent_sensor", "version_date",
            F.col("label").alias("life_cycle"), "version_rank", "sensor_nodes_id",
        )
    )


def stale_versions(ranks: DataFrame, versions: DataFrame) -> DataFrame:
    """All but the newest version, and every parent once per version."""
    return ranks.where(F.col("version_rank") > 1).select("sensors_id").union(versions.select("parent_sensors_id"))


def rank_duplicates(
    sensor_nodes: DataFrame, sensor_systems: DataFrame, sensors: DataFrame, source: str | None = None, by: str = "geom"
) -> DataFrame:
    """Nodes that are one place: same point (`geom`), or same source id without a pattern.

    The first node by source id becomes the canonical one, and the first sensor by its
    time of entry per canonical node and measurand. Without `source` every source is
    ranked on its own.
    """
    nodes = sensor_nodes if source is None else sensor_nodes.where(F.col("source_name") == source)
    if by == "geom":
        nodes = nodes.where(F.col("lon").isNotNull()).withColumn(
            "grouper", F.concat(F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"))
        )
    else:
        nodes = nodes.withColumn("grouper", F.regexp_replace("source_id", by, ""))
    place = ["source_name", "grouper"]
    nodes = nodes.select("sensor_nodes_id", "lon", "lat", "site_name", "source_id", *place)
    canonical = nodes.groupBy(*place).agg(
        F.min(F.struct("source_id", "sensor_nodes_id", "lon", "lat")).alias("_c")
    ).select(
        *place, F.col("_c.sensor_nodes_id").alias("new_sensor_nodes_id"), F.col("_c.lon").alias("new_lon"), F.col("_c.lat").alias("new_lat")
    )
    ranked = spread_row_number(nodes, place, [("source_id", True), ("sensor_nodes_id", True)], "sensor_nodes_rw")
    same = ranked.join(canonical, place)
    systems = sensor_systems.select("sensor_systems_id", "sensor_nodes_id")
    if by != "geom":
        first_system = systems.groupBy(F.col("sensor_nodes_id").alias("new_sensor_nodes_id")).agg(
            F.min("sensor_systems_id").alias("new_sensor_systems_id")
        )
        same = same.join(first_system, "new_sensor_nodes_id")
    rows = sensors.select(
        "sensors_id", "sensor_systems_id", "measurands_id", F.col("source_id").alias("sensors_source_id"), "added_on"
    ).join(systems, "sensor_systems_id").join(same, "sensor_nodes_id")
    slot = ["new_sensor_nodes_id", "measurands_id"]
    chosen = rows.groupBy(*slot).agg(F.min(F.struct("added_on", "sensors_id")).alias("_c")).select(
        *slot, F.col("_c.sensors_id").alias("new_sensors_id")
    )
    rows = spread_row_number(rows, slot, [("added_on", True), ("sensors_id", True)], "rw")
    return rows.join(chosen, slot)


# The kinds of group rule and the location column each one tests.
RULE_COLUMNS = {"countries_id": "countries_id", "providers_id": "providers_id", "users_id": "owner_id", "sensor_nodes_id": "id"}


# Locations of a class that one row holds when groups meet them.
_BLOCK = 256


def _blocks(locations: DataFrame, sizes: DataFrame, columns: list[str]) -> DataFrame:
    """Lists of about `_BLOCK` locations alike in the columns, by longitude: a box takes few runs of one.

    `sizes` has the number `_n` of locations for each class. Classes are cut by a hash, so one
    class may hold most of the locations.
    """
    dealt = join_null_safe(never_broadcast(locations), sizes, columns)
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / _BLOCK))
    places = F.sort_array(F.collect_list(F.struct("lon", "lat", "id")))
    return dealt.groupBy(*columns, part.alias("_part")).agg(places.alias("_places")).drop("_part")


def group_members(group_rules: DataFrame, locations: DataFrame) -> DataFrame:
    """Members of each group: locations meeting all its rules.

    `group_rules`: groups_id, kind, ids (array, for the four id kinds) or box (struct
    xmin, ymin, xmax, ymax, kind `geom`: the point lies inside). `locations`: id,
    countries_id, providers_id, owner_id, lon, lat.

    Locations alike in country, provider and owner are one class. Rules on these become rows
    joined on the id, and a class belongs to a group when it meets as many as the group has;
    its locations are then tested against the group's boxes (against what these have in common,
    which is a box as well). Groups that name locations find them by id, and groups of boxes
    alone by ten-degree cells. Nothing is broadcast: one box is many cells, and one class many
    locations.

    The members number groups times locations, so the result outgrows all else. Groups meet the
    locations of a class in blocks, each of which unfolds in one order for group after group:
    files hold such repeats in a fraction of the space.
    """
    shared, columns = ["countries_id", "providers_id", "users_id"], ["countries_id", "providers_id", "owner_id"]
    of_class, named, boxed = F.col("kind").isin(shared), F.col("kind") == "sensor_nodes_id", F.col("kind") == "geom"
    edge = {c: F.when(boxed, F.col(f"box.{c}")) for c in ("xmin", "ymin", "xmax", "ymax")}
    whole = edge["xmin"].isNotNull() & edge["ymin"].isNotNull() & edge["xmax"].isNotNull() & edge["ymax"].isNotNull()
    groups = group_rules.groupBy("groups_id").agg(
        F.count_if(of_class).alias("_of_class"), F.count_if(named).alias("_named"), F.count_if(whole).alias("_boxed"),
        F.count("*").alias("_rules"), F.collect_list(F.when(of_class | named, F.struct("kind", "ids"))).alias("_lists"),
        F.max(edge["xmin"]).alias("_xmin"), F.max(edge["ymin"]).alias("_ymin"),
        F.min(edge["xmax"]).alias("_xmax"), F.min(edge["ymax"]).alias("_ymax"),
    )
    # a rule of another kind, or a box that is missing or lacks an edge, is met by nothing
    groups = groups.where((F.col("_of_class") + F.col("_named") + F.col("_boxed")) == F.col("_rules"))
    lon, lat = F.col("lon"), F.col("lat")
    box = ["_boxed", "_xmin", "_ymin", "_xmax", "_ymax"]
    in_boxes = (F.col("_boxed") == 0) | (
        lon.between(F.col("_xmin"), F.col("_xmax")) & lat.between(F.col("_ymin"), F.col("_ymax"))
    )

    sizes = locations.groupBy(*columns).agg(F.count("*").alias("_n"))
    classes = sizes.select(*columns)
    hits = None
    for kind, column in zip(shared, columns):
        asked = group_rules.where(F.col("kind") == kind).select("groups_id", F.explode(F.array_distinct("ids")).alias(column))
        matched = classes.join(never_broadcast(asked), column).select("groups_id", *columns)
        hits = matched if hits is None else hits.unionByName(matched)
    met = hits.groupBy("groups_id", *columns).agg(F.count("*").alias("_met"))
    plain = groups.where((F.col("_named") == 0) & (F.col("_of_class") > 0)).select("groups_id", "_of_class", *box)
    met = met.join(never_broadcast(plain), "groups_id").where(F.col("_met") == F.col("_of_class"))
    blocks = _blocks(locations.select("id", "lon", "lat", *columns), sizes, columns)
    by_class = join_null_safe(never_broadcast(blocks), met, columns)
    by_class = by_class.select("groups_id", *box, F.explode("_places").alias("_place"))
    by_class = by_class.select("groups_id", *box, "_place.*").where(in_boxes)

    lists = group_rules.where(named).select("groups_id", F.explode(F.array_distinct("ids")).alias("id")).distinct()
    told = lists.join(never_broadcast(groups), "groups_id")
    value = lambda kind: F.coalesce(*[F.when(kind == k, F.col(c).cast("bigint")) for k, c in RULE_COLUMNS.items()])
    by_name = never_broadcast(locations).join(told, "id").where(
        in_boxes & F.forall("_lists", lambda r: F.array_contains(r.ids.cast("array<bigint>"), value(r.kind)))
    )

    cells = lambda a, b: F.sequence(F.floor(a / 10).cast("int"), F.floor(b / 10).cast("int"))
    free = groups.where((F.col("_named") == 0) & (F.col("_of_class") == 0))
    free = free.where((F.col("_xmin") <= F.col("_xmax")) & (F.col("_ymin") <= F.col("_ymax")))
    free = free.withColumn("_cx", F.explode(cells(F.col("_xmin"), F.col("_xmax"))))
    free = free.withColumn("_cy", F.explode(cells(F.col("_ymin"), F.col("_ymax"))))
    points = locations.where(lon.isNotNull()).withColumns({"_cx": F.floor(lon / 10).cast("int"), "_cy": F.floor(lat / 10).cast("int")})
    by_box = points.join(never_broadcast(free), ["_cx", "_cy"]).where(in_boxes)

    out = ["groups_id", F.col("id").alias("sensor_nodes_id")]
    return by_class.select(*out).unionByName(by_name.select(*out)).unionByName(by_box.select(*out))


def node_paths(df: DataFrame, path: str, id_col: str) -> DataFrame:
    """Paths that always hold the own id: appended when missing, alone when there is none."""
    own = F.col(id_col).cast("int")
    fixed = (
        F.when(F.col(path).isNull(), F.array(own))
        .when(F.array_contains(path, own), F.col(path))
        .otherwise(F.concat(F.col(path), F.array(own)))
    )
    return df.withColumn(path, fixed)


# ---- small lookups, in bulk form -----------------------------------------------------------------


def node_from_sensor(requests: DataFrame, ctx: DataFrame) -> DataFrame:
    """Requested sensors with their node, NULL when unknown."""
    return requests.join(ctx.select("sensors_id", "sensor_nodes_id"), "sensors_id", "left")


def nodes_from_sensors(requests: DataFrame, ctx: DataFrame, group: str) -> DataFrame:
    """Distinct nodes of each group of sensors, ascending; unknown sensors add none."""
    pairs = requests.join(ctx.select("sensors_id", "sensor_nodes_id"), "sensors_id", "left").select(group, "sensor_nodes_id").distinct()
    return pairs.groupBy(group).agg(_set("sensor_nodes_id").alias("sensor_nodes_ids"))


def countries_of_nodes(requests: DataFrame, sensor_nodes: DataFrame, group: str) -> DataFrame:
    """Distinct countries per group of nodes."""
    pairs = requests.join(sensor_nodes.select("sensor_nodes_id", "country"), "sensor_nodes_id").select(group, "country").distinct()
    return pairs.groupBy(group).agg(_set("country").alias("countries"))


def parameter_object(measurands: DataFrame) -> DataFrame:
    return measurands.select(
        "measurands_id",
        F.struct(
            F.col("measurands_id").alias("parameterId"), F.col("measurand").alias("parameter"), F.col("units").alias("unit"),
            F.col("display").alias("displayName"),
        ).alias("parameter"),
    )


def mfr(manufacturer_name: Column, model_name: Column) -> Column:
    """{manufacturerName, modelName}, only when both are present."""
    both = manufacturer_name.isNotNull() & model_name.isNotNull()
    return F.when(both, F.struct(manufacturer_name.alias("manufacturerName"), model_name.alias("modelName")))


def deployment_adapters_view(
    deployments: DataFrame, handlers: DataFrame, deployment_adapters: DataFrame, adapters: DataFrame, providers: DataFrame
) -> DataFrame:
    """Deployments with their adapter configurations, an empty list when none."""
    told = adapters.join(providers.select("providers_id", F.col("source_name").alias("provider_name")), "providers_id")
    lists = deployment_adapters.join(told, "adapters_id").groupBy("deployments_id").agg(
        _list("adapters_id", "providers_id", "provider_name", F.col("client_name").alias("adapter_client"),
              F.col("config").alias("adapter_config")).alias("adapters")
    )
    empty = F.array().cast(lists.schema["adapters"].dataType)
    return deployments.join(lists, "deployments_id", "left").join(handlers, "handlers_id").select(
        "deployments_id", "label", "queue_name", "temporal_offset", F.coalesce("adapters", empty).alias("adapters"),
        "filename_prefix", "output_format",
    )


