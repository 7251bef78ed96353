"""Numeric expressions, coverage, and percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.joins import join_null_safe


def sig_digits(n: Column, digits: int) -> Column:
    """Round to a number of significant digits; zero stays zero."""
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(n)))
    scale = F.pow(F.lit(10.0), F.abs(places).cast("double"))
    rounded = F.when(places >= 0, F.round(n * scale) / scale).otherwise(F.round(n / scale) * scale)
    return F.when(n == 0, F.lit(0.0)).otherwise(rounded)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def coverage(obs: Column, averaging: Column, logging: Column, duration: Column) -> Column:
    """Observed against expected counts and intervals (seconds), and two percentages."""
    steps = F.try_divide(duration, logging)
    return F.struct(
        obs.alias("observed_count"),
        (averaging * obs).alias("observed_interval"),
        F.round(steps).alias("expected_count"),
        (steps * averaging).alias("expected_interval"),
        F.round(F.try_divide(obs, steps) * 100.0).alias("percent_complete"),
        F.round(F.try_divide(obs, F.try_divide(duration, averaging)) * 100.0).alias("percent_coverage"),
    )


def expected_hours(start: Column, end: Column, kind: Column, factor: Column) -> Column:
    """Hours of a period whose hour, ISO weekday or month equals the factor text.

    Counted from the day or month list of the period: each matching day holds 24
    such hours (one, when the factor is an hour), so no hour list is built.
    """
    last = F.timestamp_micros(F.unix_micros(end) - 1_000_000)
    days = F.sequence(F.to_date(start), F.to_date(last))
    months = F.sequence(
        F.trunc(F.to_date(start), "month"), F.trunc(F.to_date(last), "month"), F.expr("INTERVAL 1 MONTH")
    )
    by_hour = F.when(factor.rlike("^([01][0-9]|2[0-3])$"), F.size(days)).otherwise(0)
    by_weekday = 24 * F.size(F.filter(days, lambda d: (F.weekday(d) + 1).cast("string") == factor))
    by_month = F.aggregate(
        F.filter(months, lambda m: F.lpad(F.month(m).cast("string"), 2, "0") == factor),
        F.lit(0),
        lambda total, m: total + 24 * F.dayofmonth(F.last_day(m)),
    )
    return (
        F.when(kind == "hour", by_hour).when(kind == "day", by_weekday).when(kind == "month", by_month)
    ).cast("int")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    slices: int = 256,
) -> DataFrame:
    """Interpolated percentiles per key, exact, for keys that may hold most of the data.

    `percentile` keeps every distinct value of a group in one task. Here equal values
    are first counted in parallel; approximate cut points split each key into slices,
    slice totals locate the wanted ranks, and only the slices holding them are sorted.
    The counts are shuffled once and serve all steps, so the input runs once. Use
    `percentile` itself for groups with a natural bound, such as one sensor and hour.
    """
    keys = list(keys)
    group = keys or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(1))
    counted = (
        source.where(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    steps = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = counted.groupBy(*group).agg(
        F.array_distinct(F.percentile_approx("_v", steps, 10_000)).alias("_cuts")
    )
    sliced = join_null_safe(counted, cuts, group).withColumn(
        "_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    ).drop("_cuts")

    by_key = Window.partitionBy(*group)
    totals = (
        sliced.groupBy(*group, "_slice")
        .agg(F.sum("_n").alias("_m"))
        .withColumn("_total", F.sum("_m").over(by_key))
        .withColumn(
            "_before", F.sum("_m").over(by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
        )
        .withColumn("_before", F.coalesce("_before", F.lit(0)))
    )

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def holds(index: Column, first: Column, count: Column) -> Column:
        return (index >= first) & (index < first + count)

    wanted = F.lit(False)
    for p in probs.values():
        for index in (F.floor(rank(p)), F.ceil(rank(p))):
            wanted = wanted | holds(index, F.col("_before"), F.col("_m"))
    targets = totals.where(wanted).select(*group, "_slice", "_before", "_total")

    ordered = Window.partitionBy(*group, "_slice").orderBy("_v")
    placed = join_null_safe(sliced, targets, [*group, "_slice"]).withColumn(
        "_first",
        F.col("_before") + F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"),
    )
    picks = []
    for name, p in probs.items():
        for side, index in (("lo", F.floor(rank(p))), ("hi", F.ceil(rank(p)))):
            picks.append(
                F.max(F.when(holds(index, F.col("_first"), F.col("_n")), F.col("_v"))).alias(f"_{side}_{name}")
            )
    picked = placed.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)
    out = [
        (
            F.col(f"_lo_{name}")
            + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (rank(p) - F.floor(rank(p)))
        ).alias(name)
        for name, p in probs.items()
    ]
    return picked.select(*keys, *out)
