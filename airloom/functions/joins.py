"""Joins by key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL keys being equal; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(renamed[f"_right_{k}"])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])


def never_broadcast(side: DataFrame) -> DataFrame:
    """`side` for a sort-merge join, whatever size the optimizer takes it for.

    It guesses by file sizes and does not see that an explode multiplies rows, so a table of
    millions of rows can be taken for one of ten megabytes and sent through the driver.
    """
    return side.hint("merge")
