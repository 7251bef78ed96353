"""Query registry: a Spark query, its output columns, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.plans.frames import Frames, check_sql


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Frames], DataFrame]
    out: str
    sql: str | None
    frames: dict[str, str] | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shape(self.build(Frames(spark, sf_dir)), self.out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(_check_column(*_split(c)) for c in self.out.split())
        return check_sql(f"SELECT {columns} FROM (\n{self.sql.strip()}\n) AS result", self.frames)


REGISTRY: dict[str, Query] = {}


def query(name: str, out: str, sql: str | None = None, frames: dict[str, str] | None = None):
    """Register a query. `out` lists `column:type`, the type being i (integer), f (six
    decimals), n (whole number), t (microseconds since 1970), d (date text), s (text) or b (boolean)."""

    def register(build: Callable[[Frames], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, out, sql, frames)
        return build

    return register


def _split(column: str) -> tuple[str, str]:
    name, _, kind = column.partition(":")
    return name, kind


def _shape(df: DataFrame, out: str) -> DataFrame:
    kinds = {
        "i": lambda c: c.cast("bigint"),
        "f": lambda c: F.round(c.cast("double"), 6),
        "n": lambda c: F.round(c.cast("double"), 0),
        "t": lambda c: F.unix_micros(c),
        "d": lambda c: c.cast("date").cast("string"),
        "s": lambda c: c.cast("string"),
        "b": lambda c: c.cast("boolean"),
    }
    return df.select(*[kinds[kind](F.col(name)).alias(name) for name, kind in map(_split, out.split())])


def _check_column(name: str, kind: str) -> str:
    forms = {
        "i": "CAST({0} AS BIGINT)",
        "f": "round(CAST({0} AS DOUBLE), 6)",
        "n": "round(CAST({0} AS DOUBLE), 0)",
        "t": "epoch_us({0})",
        "d": "CAST(CAST({0} AS DATE) AS VARCHAR)",
        "s": "CAST({0} AS VARCHAR)",
        "b": "CAST({0} AS BOOLEAN)",
    }
    return forms[kind].format(name) + f" AS {name}"
