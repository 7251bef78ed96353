"""Row numbers and previous rows within groups of any size.

A window sorts a whole group in one task. Here groups are cut at rows picked by a hash of
the order columns (the same on every run, about one cut per `chunk_rows` rows of a key that
has more), each chunk is ranked on its own, and totals of the earlier chunks are added.
The input is shuffled by key and order once, and that shuffle serves all steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.joins import join_null_safe


def _ordered(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]


def _chunked(df: DataFrame, keys: list[str], order: Sequence[tuple[str, bool]], chunk_rows: int) -> DataFrame:
    """df with `_chunk`, rising along the order columns; equal rows share one."""
    names = [c for c, _ in order]
    base = df.repartition(*keys, *names)
    big = base.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > chunk_rows).select(*keys)
    picked = base.select(*keys, *names).where(F.pmod(F.xxhash64(*names), F.lit(chunk_rows)) == 0)
    cuts = join_null_safe(picked, big, keys, "left_semi").groupBy(*keys).agg(F.collect_set(F.struct(*names)).alias("_cuts"))

    def reached(cut: Column) -> Column:
        """Does the row stand at or after the cut in the order?"""
        after = F.lit(True)
        for name, up in reversed(order):
            row, at = F.col(name), cut[name]
            # NULL is the smallest value
            over = (row > at) if up else (row < at)
            over = F.coalesce(over, (row.isNotNull() & at.isNull()) if up else (row.isNull() & at.isNotNull()))
            after = over | (row.eqNullSafe(at) & after)
        return after

    chunk = F.coalesce(F.size(F.filter("_cuts", reached)), F.lit(0))
    return join_null_safe(base, cuts, keys, "left").withColumn("_chunk", chunk).drop("_cuts")


def spread_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    name: str = "rank",
    chunk_rows: int = 200_000,
) -> DataFrame:
    """row_number per key in the order of (column, ascending) pairs, which make rows unique."""
    keys = list(keys)
    cut = _chunked(df, keys, order, chunk_rows)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n")).select(
        *keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*_ordered(order))
    return join_null_safe(cut, totals, [*keys, "_chunk"]).withColumn(
        name, (F.row_number().over(inside) + F.col("_before")).cast("bigint")
    ).drop("_chunk", "_before")


def spread_lag(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], chunk_rows: int = 200_000
) -> DataFrame:
    """df with `prev_<column>`: the value of the previous row per key in ascending order."""
    keys, row = list(keys), F.struct(*columns)
    cut = _chunked(df, keys, [(c, True) for c in order], chunk_rows)
    last = cut.groupBy(*keys, "_chunk").agg(F.max_by(row, F.struct(*order)).alias("_last"))
    chunks = Window.partitionBy(*keys).orderBy("_chunk")
    carried = last.select(*keys, "_chunk", F.lag("_last").over(chunks).alias("_carried"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    seen = join_null_safe(cut, carried, [*keys, "_chunk"]).withColumn(
        "_prev", F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(F.lag(row).over(inside))
    )
    return seen.select(*df.columns, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in columns])
