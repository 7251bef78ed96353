"""Schemas of the tables read from files, and validation in place of constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
}


def _schema(text: str) -> T.StructType:
    """Struct of `name type, ...`, readable before any session exists."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MEASUREMENTS = _schema(
    "sensors_id bigint, datetime timestamp, value double, value_original double, lon double, lat double, added_on timestamp"
)
MEASUREMENTS_ARCHIVE = T.StructType(
    [*MEASUREMENTS.fields, T.StructField("archived_on", T.TimestampType()), T.StructField("archive_reason", T.StringType())]
)
PERIOD_FILE = _schema("sensors_id bigint, datetime timestamp, value double, lat double, lon double")
MOBILE_FILE = _schema("ingest_id string, value double, datetime timestamp, lon double, lat double")
EXPORT_FILE = _schema(
    "sensors_id bigint, location string, measurands_id bigint, ismobile boolean, sensor string, datetime timestamp, tz string, "
    "datetime_str string, measurand string, units string, value double, lon double, lat double, "
    "provider string, country string, sensor_nodes_id bigint, day date"
)
NODES_FILE = _schema(
    "sensor_nodes_id bigint, source_name string, source_id string, site_name string, lon double, lat double, "
    "timezones_id int, origin string, ismobile boolean, added_on timestamp"
)
SYSTEMS_FILE = _schema("sensor_systems_id bigint, sensor_nodes_id bigint, source_id string")
SENSORS_FILE = _schema(
    "sensors_id bigint, sensor_systems_id bigint, measurands_id int, source_id string, "
    "data_averaging_period_seconds int, data_logging_period_seconds int, added_on timestamp"
)

# Allowed texts of the enumerated columns.
ALLOWED = {
    "flag_level": ("INFO", "WARNING", "ERROR"),
    "visibility": ("private", "public"),
}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; empty when the table meets its unique key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def not_allowed(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*ALLOWED[column]))


def upside_down_limits(measurands: DataFrame) -> DataFrame:
    """Measurands whose upper limit is not above the lower one."""
    return measurands.where(F.col("upper_limit") <= F.col("lower_limit"))
