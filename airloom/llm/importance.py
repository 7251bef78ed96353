"""Resampling of documents towards a target distribution (importance weights on hashed n-grams).

Features are runs of 1 to 3 words, hashed to `BUCKETS` by CRC-32. All documents and all target
texts are counted by bucket; a bucket's gain is its scaled log ratio, and a document's weight
the sum over its features. Gumbel noise from a hash of its id makes taking the highest scores
a draw without replacement.

1. Tasks find words and hash features with NumPy over whole batches: CRC-32 is linear, so the
   hash of a run follows from those of its words. What leaves a task are counts by bucket.
2. The gains are one array of `BUCKETS` numbers; each document's bucket array is scored by it.
   The narrow result (id, counts, weight, score, row number) is written once.
3. Distributed quickselect: random pivot keys are drawn among the rows still in question, one
   pass counts the rows below and at each pivot, and the pivots around the wanted place become
   the new bounds. Keys (score, id, row number) are unique, so the last key is exact.
4. Only the winners are sorted, by ranges, and ranked: place in the range plus earlier ranges.

Defined results: null and empty texts have no words, features or weight; a null id hashes as
the empty text and follows all ids of the same score; rows of one id are documents of their
own, in order of their row number; long texts are whole; no target text, or no document, is
counted as zero; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.shared import portions, stored

BUCKETS, LONGEST_RUN, SEED, LEAST_WORDS = 10_000, 3, 42, 20
#: Pivots counted in one pass.
PIVOTS = 16
#: Words of up to so many bytes are hashed side by side, longer ones one by one.
SHORT = 64


class Crc:
    """CRC-32 of many byte strings at once, and of their concatenations."""

    def __init__(self) -> None:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
        self.table = table
        # by[n]: what n zero bytes make of each value of each of the four bytes
        step = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        by = [step]
        for _ in range(SHORT + 1):
            step = table[step & 255] ^ (step >> 8)
            by.append(step)
        self.by = np.ascontiguousarray(by).reshape(-1)
        # twice[b]: the same for 2^b zero bytes
        self.twice = [by[1]]
        for _ in range(40):
            self.twice.append(self._apply(self.twice[-1].reshape(-1), np.zeros(1, np.int64), self.twice[-1]))

    @staticmethod
    def _apply(tables: np.ndarray, base: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = tables[base + (crc & 255)] ^ tables[base + 256 + ((crc >> 8) & 255)]
        return out ^ tables[base + 512 + ((crc >> 16) & 255)] ^ tables[base + 768 + (crc >> 24)]

    def shifted(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The CRCs after n further zero bytes each; crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)."""
        out = self._apply(self.by, np.minimum(n, SHORT) * 1024, crc)
        far = np.flatnonzero(n > SHORT)
        if len(far):
            value, left = crc[far], n[far]
            for b in range(int(left.max()).bit_length()):
                moved = self._apply(self.twice[b].reshape(-1), np.zeros(1, np.int64), value)
                value = np.where((left >> b) & 1 == 1, moved, value)
            out[far] = value
        return out

    def words(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        order = np.argsort(-size, kind="stable")
        at, n = start[order], size[order]
        crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
        for k in range(min(SHORT, int(n.max(initial=0)))):
            m = int(np.searchsorted(-n, -k))  # words longer than k
            crc[:m] = self.table[(crc[:m] ^ data[at[:m] + k]) & 255] ^ (crc[:m] >> 8)
        out = np.empty_like(crc)
        out[order] = ~crc
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = zlib.crc32(data[start[i] : start[i] + size[i]])
        return out


_CRC = Crc()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; then, for all features, the text's place and the bucket."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = _LOWER[np.frombuffer(body, np.uint8)[ends[0] : ends[-1]]] if body is not None else np.zeros(0, np.uint8)
    begin = (ends - ends[0]).astype(np.int64)
    inside = _IN_WORD[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return np.zeros(len(texts), np.int64), none, none
    edge = np.zeros(len(data) + 1, bool)
    edge[begin] = True
    first = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    last = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    owner = np.searchsorted(begin, start, "right") - 1
    word = _CRC.words(data, start, size)
    # a space and the word
    spaced = _CRC.shifted(np.full(len(word), zlib.crc32(b" "), np.uint32), size) ^ word
    run, owners, found = word, [owner], [word]
    for n in range(2, LONGEST_RUN + 1):
        if len(word) < n:
            break
        run = _CRC.shifted(run[: len(word) - n + 1], size[n - 1 :] + 1) ^ spaced[n - 1 :]
        whole = owner[: len(run)] == owner[n - 1 :]
        owners.append(owner[: len(run)][whole])
        found.append(run[whole])
    return (
        np.bincount(owner, minlength=len(texts)),
        np.concatenate(owners),
        (np.concatenate(found) % np.uint32(buckets)).astype(np.int64),
    )


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts: one number a bucket, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in portions(batch.column(0)):
                seen += np.bincount(features(batch.column(0).slice(a, b - a), buckets)[2], minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    parts = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) for each bucket."""
    n, s, t = float(len(raw)), float(raw.sum()), float(target.sum())
    pairs = zip(raw.astype(float).tolist(), target.astype(float).tolist())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in pairs], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_features, weight, row_no (unique, and fixed once this is written)."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in portions(batch.column(1)):
                words, owner, bucket = features(batch.column(1).slice(a, b - a), len(gain))
                n = b - a
                # exact: the sums are integers far below 2^53
                weight = np.bincount(owner, weights=gain[bucket], minlength=n).astype(np.int64)
                numbers = [words, np.bincount(owner, minlength=n), weight, np.arange(row_no, row_no + n)]
                row_no += n
                columns = [batch.column(0).slice(a, n), *(pa.array(x, pa.int64()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_features", "weight", "row_no"])

    schema = f"key {kind.simpleString()}, n_words long, n_features long, weight long, row_no long"
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def noise(key: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def kth_key(rows: DataFrame, key: Column, k: int, pivots: int = PIVOTS) -> Column | None:
    """Literal of the k-th smallest (from 1) of the unique struct `key` among the rows.

    Each round reads the rows twice: for the pivots, the rows with the smallest hashes among
    those within the bounds, and for the exact counts below and at each of them.
    """
    if k < 1:
        return None
    fields = rows.select(key.alias("key")).schema["key"].dataType
    literal = lambda row: F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])
    open_rows, done, round_no = rows.select(key.alias("key")), 0, 0
    low = high = None
    while True:
        within = open_rows
        if low is not None:
            within = within.filter(F.col("key") > low)
        if high is not None:
            within = within.filter(F.col("key") < high)
        drawn = within.orderBy(F.xxhash64("key", F.lit(round_no)), "key").limit(pivots).collect()
        if not drawn:
            return None
        at = [literal(r.key) for r in sorted(drawn, key=lambda r: tuple(r.key))]
        parts = [F.count_if(F.col("key") < p).alias(f"below{i}") for i, p in enumerate(at)]
        parts += [F.count_if(F.col("key") == p).alias(f"equal{i}") for i, p in enumerate(at)]
        seen = within.agg(*parts).first()
        for i, pivot in enumerate(at):
            if k - done <= seen[f"below{i}"]:
                high = pivot
                break
            if k - done <= seen[f"below{i}"] + seen[f"equal{i}"]:
                return pivot
            low = pivot
        below = [i for i in range(len(at)) if at[i] is low]
        done += seen[f"below{below[0]}"] + seen[f"equal{below[0]}"] if below else 0
        round_no += 1


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """rows with their place from 1 in the order: sorted by ranges, without a task for all."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.withColumn(name, place.cast("long")).drop("_part", "_at", "_before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = SEED, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document: key, n_features, weight, score, and its rank where it is drawn."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    made = stored(weighted(docs, gain, key, text).withColumn("score", F.col("weight") + noise("key", seed)))
    able, kind = made.filter(F.col("n_words") >= LEAST_WORDS), made.schema["key"].dataType
    order = F.struct(
        (-F.col("score")).alias("a"), F.col("key").isNull().alias("b"), F.coalesce("key", F.lit(0).cast(kind)).alias("c"), F.col("row_no").alias("d")
    )
    last = kth_key(able, order, able.count() * percent // 100)
    drawn = F.lit(False) if last is None else (F.col("n_words") >= LEAST_WORDS) & (order <= last)
    names = [F.col("key").alias(key), "n_features", "weight", "score"]
    by = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("row_no")]
    winners = ranked(made.filter(drawn), by).select(*names, "rank")
    return winners.unionByName(made.filter(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))


#: CRC-32 byte by byte over distinct features; its table is made by the rule of eight shifts.
ORACLE = r"""
WITH RECURSIVE tab(i, v, k) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8
), t AS (SELECT list(v ORDER BY i) AS t FROM tab WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, TRUE AS raw FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, coalesce(text, ''), FALSE FROM benchmark
), split AS (
  SELECT r, doc_id, raw, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT r, raw, array_to_string(w[i:i + n], ' ') AS g
  FROM split, range(0, 3) s(n), unnest(range(1, len(w) - n + 1)) u(i)
), used AS (SELECT DISTINCT g FROM grams),
hashed AS (
  SELECT g, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(g))), lambda j:
      ('0x' || substr(hex(encode(g)), (2 * j + 1)::BIGINT, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) % 10000 AS bucket
  FROM used, t
), hits AS (SELECT r, raw, bucket FROM grams JOIN hashed USING (g)),
totals AS (SELECT count(*) FILTER (raw)::DOUBLE AS s, count(*) FILTER (NOT raw)::DOUBLE AS t FROM hits),
gain AS (
  SELECT bucket, floor(1000 * ln(
    (count(*) FILTER (NOT raw) + 1)::DOUBLE * (any_value(totals.s) + 10000)
    / ((count(*) FILTER (raw) + 1)::DOUBLE * (any_value(totals.t) + 10000))))::BIGINT AS gain
  FROM hits, totals GROUP BY bucket
), sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM hits JOIN gain USING (bucket) WHERE raw GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN sums USING (r) WHERE raw
), placed AS (
  SELECT *, CASE WHEN able THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) END AS place,
    5 * count(*) FILTER (able) OVER () // 100 AS k FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank FROM placed
"""
