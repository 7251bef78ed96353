"""Interval overlap and range lookup without pairing rows of a group.

Asking whether any period overlaps a window needs only the latest end among periods
that start by the window's end: a running maximum in time order. Keys are cut into
time chunks, a chunk starts from the maximum carried over from earlier chunks, so a
key holding most of the rows still spreads over tasks and the result stays exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OPEN = (1 << 62)


def overlap_marks(
    lookups: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    low: str,
    high: str,
    start: str,
    end: str,
    classes: Mapping[str, Column] | None = None,
    chunk_s: int = 86400,
) -> DataFrame:
    """Lookups with one boolean per class: does a period [start, end) overlap [low, high]?

    `classes` maps a name to a predicate over the periods (default: one named
    `overlaps`, all periods). A NULL end is open, a NULL key matches nothing. Lookup
    columns are kept.
    """
    classes = dict(classes or {"overlaps": F.lit(True)})
    keys = list(keys)
    begins, ends = F.unix_micros(start), F.coalesce(F.unix_micros(end), F.lit(_OPEN))
    usable = ends > begins
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    events = periods.where(usable).select(
        *keys, begins.alias("_at"), F.lit(0).alias("_kind"),
        *[F.when(test, ends).alias(f"_end_{name}") for name, test in classes.items()],
    )
    # many periods may share key and start; only their latest ends matter
    events = events.groupBy(*keys, "_at", "_kind").agg(*[F.max(f"_end_{n}").alias(f"_end_{n}") for n in classes])
    row = F.struct(*lookups.columns)
    asked = lookups.select(*keys, F.unix_micros(high).alias("_at"), F.lit(1).alias("_kind"), row.alias("_row"))
    points = events.unionByName(asked, allowMissingColumns=True).withColumn(
        "_chunk", F.floor(F.col("_at") / (chunk_s * 1_000_000))
    )

    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = by_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy(*keys, "_chunk").agg(
        *[F.max(f"_end_{n}").alias(f"_top_{n}") for n in classes]
    ).select(*keys, "_chunk", *[F.max(f"_top_{n}").over(earlier).alias(f"_carry_{n}") for n in classes])

    running = Window.partitionBy(*keys, "_chunk").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = points.join(carried, [*keys, "_chunk"], "left").select(
        "_kind", "_row",
        *[F.greatest(f"_carry_{n}", F.max(f"_end_{n}").over(running)).alias(f"_latest_{n}") for n in classes],
    )
    answers = seen.where(F.col("_kind") == 1)
    since = F.unix_micros(F.col(f"_row.{low}"))
    return answers.select(
        "_row.*",
        *[F.coalesce(F.col(f"_latest_{n}") > since, F.lit(False)).alias(n) for n in classes],
    )


def max_in_ranges(
    facts: DataFrame, ranges: DataFrame, at: str, value: str, low: str, high: str, name: str
) -> DataFrame:
    """Ranges (low, high] with the largest `value` of facts stamped inside.

    Facts collapse to one row per stamp first. Whole days within a range take the day's
    maximum; only its first and last day look at stamps, through a running maximum of the
    day from either end, so no stamp is paired with a range.
    """
    at_day = F.to_date(at)
    per_stamp = facts.where(F.col(at).isNotNull()).groupBy(at).agg(F.max(value).alias("_v")).withColumn("_day", at_day)
    per_day = per_stamp.groupBy("_day").agg(F.max("_v").alias("_v"))
    asked = ranges.select(low, high).distinct().where(F.col(low) < F.col(high)).select(
        low, high, F.to_date(low).alias("_d1"), F.to_date(high).alias("_d2")
    )
    inner = asked.where(F.datediff("_d2", "_d1") > 1).withColumn(
        "_day", F.explode(F.sequence(F.date_add("_d1", 1), F.date_sub("_d2", 1)))
    ).join(per_day, "_day").select(low, high, "_v")

    def edge(asked: DataFrame, day: str, limit: str, after: bool) -> DataFrame:
        """Maximum of the day's stamps after (or up to) a limit: the stamps and the limits of a
        day in one order, and a running maximum up to each limit."""
        stamps = per_stamp.select("_day", F.col(at).alias("_t"), "_v")
        marks = asked.select(F.col(day).alias("_day"), F.col(limit).alias("_t")).distinct().withColumn("_v", F.lit(None).cast(per_stamp.schema["_v"].dataType))
        both = stamps.withColumn("_mark", F.lit(0)).unionByName(marks.withColumn("_mark", F.lit(1)))
        # a stamp equal to the limit is inside (.., high] and outside (low, ..]
        order = [F.desc("_t"), F.desc("_mark")] if after else [F.asc("_t"), F.asc("_mark")]
        run = Window.partitionBy("_day").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        seen = both.withColumn("_best", F.max("_v").over(run)).where("_mark = 1").select("_day", "_t", F.col("_best").alias("_v"))
        return asked.join(seen, (F.col(day) == seen["_day"]) & (F.col(limit) == seen["_t"])).select(low, high, "_v")

    long = asked.where(F.col("_d1") < F.col("_d2"))
    short = asked.where(F.col("_d1") == F.col("_d2"))
    # ranges within one day are as short as the day's stamps between them are few
    hits = short.join(per_stamp, F.col("_d1") == F.col("_day")).where((F.col(at) > F.col(low)) & (F.col(at) <= F.col(high))).select(low, high, "_v")
    parts = inner.unionByName(edge(long, "_d1", low, True)).unionByName(edge(long, "_d2", high, False)).unionByName(hits)
    best = parts.groupBy(low, high).agg(F.max("_v").alias(name))
    return ranges.join(best, [low, high], "left")
