"""Threshold exceedances from hourly rows, on UTC days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions import timeops
from airloom.operators.context import join_context


def daily_exceedances(hourly: DataFrame, ctx: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Node, measurand, UTC day, threshold: hours at or over it, and totals."""
    limits = thresholds.select("measurands_id", F.col("value").alias("threshold_value"))
    rows = join_context(
        hourly.select("sensors_id", "measurands_id", "datetime", "value_avg", "value_count"), ctx, "sensor_nodes_id"
    ).join(limits, "measurands_id")
    return rows.groupBy(
        "sensor_nodes_id", "measurands_id", timeops.utc_date("datetime").alias("day"), "threshold_value"
    ).agg(
        F.sum((F.col("value_avg") >= F.col("threshold_value")).cast("int")).alias("exceedance_count"),
        F.sum("value_count").alias("total_count"),
        F.count("*").alias("hourly_count"),
    )


def range_exceedances(daily: DataFrame, days: Sequence[int] = (1, 14, 30, 90), as_of: str = None) -> DataFrame:
    """Totals over the last so many days; each day row goes only to the ranges holding it."""
    today = F.to_date(timeops.instant(as_of))
    ranges = F.filter(F.array(*[F.lit(d) for d in days]), lambda d: F.col("day") > F.date_sub(today, d))
    recent = daily.where(F.col("day") > F.date_sub(today, max(days)))
    return (
        recent.withColumn("days", F.explode(ranges))
        .groupBy("sensor_nodes_id", "days", "measurands_id", "threshold_value")
        .agg(F.sum("exceedance_count").alias("exceedance_count"), F.sum("total_count").alias("total_count"))
    )


def latest_exceedance(hourly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Last hour at or over each threshold, per sensor."""
    limits = thresholds.select("thresholds_id", "measurands_id", F.col("value").alias("threshold_value"))
    rows = hourly.select("sensors_id", "measurands_id", "datetime", "value_avg").join(limits, "measurands_id")
    return (
        rows.where(F.col("value_avg") >= F.col("threshold_value"))
        .groupBy("sensors_id", "thresholds_id", "threshold_value")
        .agg(F.max("datetime").alias("datetime_latest"))
    )
