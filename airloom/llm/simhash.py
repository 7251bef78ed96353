"""Near-duplicate groups by SimHash fingerprints and deletion-variant signatures.

Fingerprints: A-Z lower-cased, words separated by ASCII white space, shingles of four words
with repeats; a bit is set if it is set in more than half of the shingles' XXH64 (seed 42).

Linking at `distance` 4 or less: the 64 bits are cut into three segments. Four differences
leave one segment with one difference at most, so every fingerprint is indexed under each
segment with each of its bits taken out in turn (64 signatures), and two fingerprints that
share a signature are compared. A pair shares many signatures; only the one that its own
differences single out returns it, so each link is made once. Equal fingerprints count as
one node throughout, so copies are never paired. Components are found by star rounds.

A signature that very many distinct fingerprints share costs comparisons in proportion to
their square; adaptive execution splits such a key over tasks, and the join returns only
links. With n distinct fingerprints spread at random, about 64 n^2 / 2^21 pairs are compared.
Signatures are never broadcast: the optimizer does not see that a fingerprint has 64 of them.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any
other; fewer words than a shingle are hashed as a whole; repeated rows and ids give a row
each, and so do null ids (never a component's id unless it has no other); further columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.joins import never_broadcast
from airloom.llm.graph import components
from airloom.llm.shared import row_identity, stored

SHINGLE, DISTANCE = 4, 4
#: Segments as (first bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = (ends - length)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), 65536):
        part = [digest(joined[a:b], 42) for a, b in zip(starts[i : i + 65536], ends[i : i + 65536])]
        bits = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) for every row."""
    schema = docs.select(key).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def _signatures(fp: Column) -> Column:
    """The code of a taken-out bit above the rest of its segment, for each of the 64 bits."""
    made = []
    for first, bits in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))
        for k in range(bits):
            rest = segment.bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << k)))
            made.append((rest + F.lit((first + k) << 22)).cast("int"))
    return F.array(*made)


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct column `fp` that differ in `distance` bits or fewer."""
    if distance >= 2 * len(SEGMENTS):
        raise ValueError("three segments serve distances up to five")
    left = nodes.select(F.col("fp").alias("a"), F.explode(_signatures(F.col("fp"))).alias("signature"))
    right = left.toDF("b", "signature")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    parts = []
    for first, bits in SEGMENTS:
        mask = ((1 << bits) - 1) << first
        parts.append((apart.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)), first))
    near = F.coalesce(*[F.when(F.bit_count(x) <= 1, F.struct(x.alias("x"), F.lit(k).alias("first"))) for x, k in parts])
    code = F.shiftright(F.col("s"), 22)
    own = F.when(near["x"] == 0, code == near["first"]).otherwise(
        near["x"] == F.expr("shiftleft(1L, shiftright(s, 22))")
    )
    left, right = left.withColumnRenamed("signature", "s"), right.withColumnRenamed("signature", "t")
    same = (F.col("s") == F.col("t")) & (F.col("a") < F.col("b"))
    return left.join(never_broadcast(right), same & (F.bit_count(apart) <= distance) & own).select("a", "b")


def _named(rows: DataFrame, key: Column, distance: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint; the id is the smallest key of its component."""
    nodes = stored(rows.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(stored(links(nodes, distance)))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(named, "root").select("fp", "root", "component_id")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """Per row: key, fingerprint (16 hexadecimal digits), component_id (smallest key reachable)."""
    rows = stored(fingerprints(docs, key, text))
    named = _named(rows, F.col(key), distance).drop("root")
    hexa = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(named, "fp").select(key, hexa, "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row of `docs` for each group: the one with the smallest key, and of several rows of
    that key in the group the one with the smallest text.

    Rows without key are grouped like any other and stay only where no row of the group has one.
    """
    one = F.struct(F.col(key).alias("id"), row_identity(key, text).alias("row"))
    rows = stored(fingerprints(docs.select(one.alias("key"), F.col(text).alias("text")), "key", "text"))
    named = rows.join(_named(rows, F.col("key.id"), distance), "fp")
    named = named.filter(F.col("key.id").eqNullSafe(F.col("component_id")))
    first = named.select(F.col("key.row").alias("first_row"), F.col("root").alias("first_root")).distinct()
    met = docs.join(first, row_identity(key, text) == F.col("first_row"))
    kept = met.groupBy("first_root").agg(F.min_by(F.struct(*docs.columns), F.coalesce(text, F.lit(""))).alias("row"))
    return kept.select("row.*").select(docs.columns)
