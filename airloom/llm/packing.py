"""Packing of token ids into sequences of a fixed length: first-fit decreasing in random groups.

1. Documents are dealt at random to groups of about `GROUP` and groups to tasks, evenly; that
   is the only shuffle. A task goes through its groups one by one, sorted.
2. A document is encoded; its full sequences leave at once, and what remains (shorter than
   a sequence) waits for the end of its group, so a task never holds more than a group's rests.
3. The rests are packed longest first, each into the first sequence with room. A tournament
   tree over the free room of all sequences finds that one in logarithmic time.
4. Sequences that then lack more than `SLACK` tokens, and are no power of two, are joined and
   cut anew at the full length; the last cut follows the binary digits of what is left, since
   sequences of a power of two need no padding. So a group wastes at most `SLACK` tokens for a
   sequence, whatever the lengths, and few documents are cut there.

Sequence ids are group number times 2^32 plus place in the group, so no task waits for others.
A lost task deals and packs the same rows in the same way: the dice are seeded by partition.

Defined results: null and empty texts are one piece with the end id alone; rows with one id or
none are documents of their own; an empty table gives an empty table; further columns are
ignored; pieces of one sequence follow each other without gaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.huffman import PORTION, encoder
from airloom.llm.shared import portions

LENGTH, GROUP, SLACK, SEED = 1024, 1024, 8, 42
#: Bytes of ids in an output batch, about.
BATCH = 8_000_000


class Tournament:
    """Free room of sequences, as a tree whose nodes hold the larger of two: first fit in log n."""

    def __init__(self, n: int, room: int):
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first sequence with that much room; takes it."""
        best, at = self.best, 1
        if best[1] < size:
            raise ValueError("no sequence has room")
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        found = at - self.leaves
        best[at] -= size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Items of each sequence, in the order in which they were placed."""
    tree, found = Tournament(len(sizes), room), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = tree.first(sizes[item])
        if at == len(found):
            found.append([])
        found[at].append(item)
    return found


def binary_cuts(total: int, length: int) -> list[int]:
    """Full lengths, then the powers of two that make up the rest, falling."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack_rests(sizes: list[int], length: int = LENGTH, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start in the item, length)."""
    out, loose = [], []
    for items in first_fit_decreasing(sizes, length):
        used = sum(sizes[i] for i in items)
        if length - used <= slack or used & (used - 1) == 0:
            out.append([(i, 0, sizes[i]) for i in items])
        else:
            loose += items
    cuts = iter(binary_cuts(sum(sizes[i] for i in loose), length))
    free = 0
    for item in loose:
        at = 0
        while at < sizes[item]:
            if not free:
                free = next(cuts)
                out.append([])
            n = min(free, sizes[item] - at)
            out[-1].append((item, at, n))
            at, free = at + n, free - n
    return out


def pack(
    docs: DataFrame,
    path: str,
    pattern: str,
    length: int = LENGTH,
    end_id: int = 0,
    group: int = GROUP,
    slack: int = SLACK,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces: key, start, length, ids (little-endian 32 bit), doc_tokens, sequence_id, offset.

    `length` is a power of two. The ids of a document end with `end_id`.
    """
    if length & (length - 1):
        raise ValueError("the length of a sequence must be a power of two")
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema[key].dataType
    types = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(path, pattern), end_id.to_bytes(4, "little")
        rows: list[tuple] = []
        rests: list[tuple] = []
        held = sequence = 0
        current = key_type = None

        def close() -> Iterator[tuple]:
            """The sequences made of the group's rests."""
            for i, items in enumerate(pack_rests([len(r[2]) // 4 for r in rests], length, slack)):
                offset = 0
                for item, at, n in items:
                    owner, start, ids, total = rests[item]
                    yield owner, start + at, n, ids[4 * at : 4 * (at + n)], total, sequence + i, offset
                    offset += n

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, key_type if t is None else t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            key_type = batch.schema.field(1).type
            for a, b in portions(batch.column(2), PORTION):
                part = batch.slice(a, b - a)
                flat, sizes = own.encode(part.column(2))
                flat, ends = flat.tobytes(), np.cumsum(sizes).tolist()
                groups, owners = part.column(0).to_pylist(), part.column(1).to_pylist()
                for number, owner, begin, stop in zip(groups, owners, [0, *ends], ends):
                    if number != current:
                        rows += close()
                        rests.clear()
                        current, sequence = number, number << 32
                    ids = flat[4 * begin : 4 * stop] + end
                    total = stop - begin + 1
                    whole = total // length * length
                    for at in range(0, whole, length):
                        rows.append((owner, at, length, ids[4 * at : 4 * (at + length)], total, sequence, 0))
                        sequence += 1
                    if whole < total:
                        rests.append((owner, whole, ids[4 * whole :], total))
                    held += 4 * total
                    if held > BATCH:
                        if rows:
                            yield batch_of()
                        rows, held = [], 0
        rows += close()
        if rows:
            yield batch_of()

    spark = docs.sparkSession
    groups = max(1, -(-docs.count() // group))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.floor(F.rand(seed) * groups).alias("g"), F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    dealt = rows.repartitionById(tasks, F.pmod("g", F.lit(tasks)).cast("int")).sortWithinPartitions("g", "k")
    schema = f"{key} {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return dealt.mapInArrow(run, schema)
