"""Helpers of the training-data operators: tables, stored stages, text cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A plain space before a visible character. No token of the byte-level split pattern
#: crosses such a place, so a text may be cut there and its pieces handled one by one.
SAFE_CUT = re.compile(r" (?=\S)")
UNSAFE_SPACE = re.compile(r" (?:\s|$)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_identity(key: str, text: str) -> Column:
    """16 bytes that rows share only if their id and their text are the same, nulls included."""
    owner = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(F.coalesce(F.md5(F.col(text)), F.lit("")), F.lit(":"), owner)))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    Only a local session (one machine, as in tests) may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='airloom-')}"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder: cuts lineage, runs its plan once."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(text: str) -> list[str]:
    """The text cut at its safe places; all pieces but the first have lost their space."""
    return SAFE_CUT.split(text) if UNSAFE_SPACE.search(text) else text.split(" ")


def portions(texts: pa.Array, size: int = 4_000_000):
    """Slices of a column of texts that hold about `size` bytes (one text at least)."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(length.tolist()):
        held += n
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
