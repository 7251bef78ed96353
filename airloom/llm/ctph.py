"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever it meets the block size; each
chunk gives one letter of its hash. An insertion or deletion changes the letters of the
chunks it touches and no others, so signatures are compared by edit distance.

A fingerprint is `size:first:second`: the signatures at a block size and at twice that size.
The size is the smallest 3 * 2^k that makes 64 chunks or fewer on average, halved while the
first signature stays under 32 letters. The last letter of a full signature covers the rest
of the text, so every byte counts. Fingerprints are comparable where they share a block size.

Defined results: null is the empty text, with fingerprint `3::`; a text is its own next
document if it is the only one; equal keys are ordered by text; null keys come first; further
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.shared import stored

WINDOW, LEAST_BLOCK, LETTERS = 7, 3, 64
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Odd multiplier of the rolling polynomial, and the one that mixes its bits.
ROLL, MIX = 0x01000193, 0x9E3779B1


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW bytes at every place (fewer at the beginning)."""
    out = data.astype(np.uint32)
    power = 1
    for k in range(1, min(WINDOW, len(data))):
        power = power * ROLL & 0xFFFFFFFF
        out[k:] += data[:-k].astype(np.uint32) * np.uint32(power)
    out ^= out >> np.uint32(15)
    out *= np.uint32(MIX)
    out ^= out >> np.uint32(13)
    return out


def signature(data: bytes, hashes: np.ndarray, block: int, limit: int) -> str:
    ends = (np.flatnonzero(hashes % np.uint32(block) == block - 1)[: limit - 1] + 1).tolist()
    if data and (not ends or ends[-1] < len(data)):
        ends.append(len(data))
    digest = xxhash.xxh32_intdigest
    return "".join([ALPHABET[digest(data[a:b]) & 63] for a, b in zip([0, *ends], ends)])


def fingerprint(text: str | None) -> str:
    data = (text or "").encode()
    hashes = rolling(np.frombuffer(data, np.uint8))
    block = LEAST_BLOCK
    while block * LETTERS < len(data):
        block *= 2
    first = signature(data, hashes, block, LETTERS)
    while block > LEAST_BLOCK and len(first) < LETTERS // 2:
        block //= 2
        first = signature(data, hashes, block, LETTERS)
    return f"{block}:{first}:{signature(data, hashes, 2 * block, LETTERS // 2)}"


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of letters that edits leave, over the block sizes in common.

    Runs of a letter count three at most, so repetitive stretches do not decide.
    """

    def part(x: Column, k: int) -> Column:
        return F.split(x, ":")[k]

    def short(x: Column) -> Column:
        return F.regexp_replace(x, r"(.)\1{3,}", "$1$1$1")

    def kept(x: Column, y: Column) -> tuple[Column, Column]:
        x, y = short(x), short(y)
        return F.levenshtein(x, y), F.greatest(F.length(x), F.length(y))

    size_a, size_b = part(a, 0).cast("long"), part(b, 0).cast("long")
    first, second = kept(part(a, 1), part(b, 1)), kept(part(a, 2), part(b, 2))
    up, down = kept(part(a, 2), part(b, 1)), kept(part(a, 1), part(b, 2))

    def share(edits: Column, letters: Column) -> Column:
        return 1.0 - edits / F.greatest(letters, F.lit(1))

    return (
        F.when(a == b, 1.0)
        .when(size_a == size_b, share(first[0] + second[0], first[1] + second[1]))
        .when(size_b == 2 * size_a, share(*up))
        .when(size_a == 2 * size_b, share(*down))
        .otherwise(0.0)
    )


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first ones of the next document."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_ROW = ("key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
_SCHEMA = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"


def _finish(key, text: str, own: str, following: str, next_own: str) -> tuple:
    changed = edited(text, following)
    sha = hashlib.sha256(changed.encode()).hexdigest()
    return key, len(text), sha, own, fingerprint(changed), next_own


def _batch(rows: list[tuple], extra: dict[str, pa.Array]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)] if rows else [pa.array([], t) for t in _TYPES]
    return pa.RecordBatch.from_arrays([*columns, *extra.values()], names=[*_ROW, *extra])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range. All but the last are finished; it and the first text go on."""
    part, first, before = TaskContext.get().partitionId(), None, None

    def out(rows, first_text=None, last_text=None):
        n = len(rows)
        return _batch(rows, {
            "part": pa.array([part] * n, pa.int32()),
            "first_text": pa.array([None] * (n - 1) + [first_text], pa.string()),
            "last_text": pa.array([None] * (n - 1) + [last_text], pa.string()),
        })

    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            own = before[2] if before and before[1] == text else fingerprint(text)
            if before:
                rows.append(_finish(*before, text, own))
            else:
                first = text
            before = (key, text, own)
        if rows:
            yield out(rows)
    if before:
        key, text, own = before
        yield out([(key, len(text), None, own, None, None)], first, text)


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            _finish(r["key"], r["last_text"], r["fingerprint"], r["first_text"], fingerprint(r["first_text"]))
            for r in batch.to_pylist()
        ]
        yield _batch(rows, {})


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and its edited form, and their likeness to it and the next.

    One shuffle places the texts by ranges of their key; each task sees its documents in
    order. Only the pairs across two ranges, one for each range, are left for a second step.
    """
    placed = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    placed = placed.repartitionByRange("key", "text").sortWithinPartitions("key", "text")
    found = stored(placed.mapInArrow(_within, _SCHEMA + ", part int, first_text string, last_text string"))
    last = found.filter(F.col("last_text").isNotNull())
    # a row for each range: numbers only
    order = Window.orderBy("part")
    parts = last.select("part").withColumn("following", F.lead("part").over(order))
    least = F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.withColumn("following", F.coalesce("following", least))
    firsts = last.select(F.col("part").alias("following"), "first_text")
    pairs = last.drop("first_text").join(parts, "part").join(firsts, "following")
    edges = pairs.select("key", "fingerprint", "last_text", "first_text").mapInArrow(_over_edges, _SCHEMA)
    rows = found.filter(F.col("last_text").isNull()).select(*_ROW).union(edges)
    return rows.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
