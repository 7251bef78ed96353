"""Keyed inserts and upserts as joins of old and new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Column | None = None, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by `order`, else the smallest row.

    An aggregate, not a window: copies collapse on the map side, so a key with very
    many copies never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    if order is None:
        pick = F.max(row) if last else F.min(row)
    else:
        pick = F.max_by(row, F.struct(order, row)) if last else F.min_by(row, F.struct(order, row))
    picked = df.groupBy(*keys).agg(pick.alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def absent_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """Incoming rows, one per key, whose key is not in the existing table."""
    return one_per_key(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti").select(
        *incoming.columns
    )


def insert_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """The table after inserting incoming rows, existing keys untouched."""
    return existing.unionByName(absent_rows(existing, incoming, keys, order), allowMissingColumns=True)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    merge: Mapping[str, str | Column] | None = None,
    insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The table after inserting or updating by key.

    Columns of `incoming` replace the old ones; `merge` gives a rule per column:
    greatest, least, sum, keep (old unless NULL), or a Column over `old.x`, `new.x`.
    `insert` gives values of columns absent from `incoming` for new rows. Columns
    named in neither stay. `incoming` must hold one row per key.
    """
    merge, insert = dict(merge or {}), dict(insert or {})
    new = incoming.withColumn("_new", F.lit(True)).alias("new")
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    is_new, is_old = F.col("new._new").isNotNull(), F.col("old._old").isNotNull()
    match = None
    for k in keys:
        same = F.col(f"old.{k}") == F.col(f"new.{k}")
        match = same if match is None else match & same

    out = []
    for c in existing.columns:
        o, n = F.col(f"old.{c}"), (F.col(f"new.{c}") if c in incoming.columns else None)
        if c in keys:
            value = F.coalesce(o, n)
        else:
            rule = merge.get(c)
            if rule is None:
                updated = o if n is None else n
            elif isinstance(rule, Column):
                updated = rule
            else:
                updated = {
                    "greatest": lambda: F.greatest(o, n),
                    "least": lambda: F.least(o, n),
                    "sum": lambda: F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0)),
                    "keep": lambda: F.coalesce(o, n),
                }[rule]()
            fresh = n if n is not None else insert.get(c, F.lit(None))
            value = F.when(is_new & is_old, updated).when(is_new, fresh).otherwise(o)
        out.append(value.cast(existing.schema[c].dataType).alias(c))
    return old.join(new, match, "full_outer").select(*out)


def changed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with their old and new row images; `op` is insert, update or delete."""
    cols = [c for c in before.columns if c not in keys]
    left = before.select(*keys, F.struct(*cols).alias("old_row"))
    right = after.select(*keys, F.struct(*cols).alias("new_row"))
    both = left.join(right, list(keys), "full_outer")
    op = (
        F.when(F.col("old_row").isNull(), "insert")
        .when(F.col("new_row").isNull(), "delete")
        .when(~F.col("old_row").eqNullSafe(F.col("new_row")), "update")
    )
    return both.withColumn("op", op).where(F.col("op").isNotNull())
