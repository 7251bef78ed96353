"""Byte-level BPE encoding and decoding by recursive queries.

Each task opens an in-memory DuckDB with the tokenizer's tables and asks it set-wise
questions about a bounded portion of texts:

* a recursive query holds one row per token position of every distinct word, joins
  neighbouring rows with the merge table and contracts, in each word, the leftmost pair
  of the lowest rank until no pair is left;
* an ordered aggregation over (document, position, id) joined with the vocabulary gives
  the bytes back.

Words come from the tokenizer's split pattern, each match on its own. A word's ids are
kept for later portions of the same task up to a fixed number of words.

Defined results: null text is the empty text; the empty text has no ids and decodes to
nothing; rows are independent, so repeated rows and ids (also null ids) give a row each;
further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.shared import cut, portions

#: Memory bounds of one worker: words and pieces remembered, words and tokens per query,
#: rows decoded and bytes of text encoded at a time.
KEPT_WORDS, KEPT_PIECES, WORDS_AT_ONCE, TOKENS_AT_ONCE = 200_000, 250_000, 20_000, 300_000
ROWS_AT_ONCE, PORTION = 1000, 2_000_000

#: pos, nxt: where a token begins and where its right neighbour does (a gap ends a word).
#: A pair that may not wait (`alone`: some token made with it ranks lower) is contracted
#: once, at its leftmost place; any other pair at all its places in the word, which gives
#: the same as one by one. Of a run of equal tokens (`twin`), every second pair counts.
MERGES = """
WITH RECURSIVE t(word, pos, nxt, id, round) AS (
    SELECT word, pos, nxt, id, 0 FROM start
  UNION ALL (
    WITH hit AS MATERIALIZED (
        SELECT a.word, a.pos, a.nxt AS mid, b.nxt AS nxt, p.merged, p.alone, p.l = p.r AS twin
        FROM t a JOIN t b ON b.pos = a.nxt JOIN merges p ON p.l = a.id AND p.r = b.id
    ), best AS MATERIALIZED (
        SELECT word, min((merged::BIGINT << 40) + pos) AS k FROM hit GROUP BY word
    ), low AS MATERIALIZED (
        SELECT h.*, h.pos = (k & ((1::BIGINT << 40) - 1)) AS leftmost
        FROM hit h JOIN best ON h.word = best.word AND h.merged = (k >> 40)
    ), runs AS (
        SELECT *, pos - (mid - pos) * row_number() OVER (PARTITION BY word ORDER BY pos) AS run
        FROM low WHERE twin AND NOT alone
    ), chosen AS (
        SELECT pos, mid, nxt, merged FROM low WHERE leftmost OR NOT (alone OR twin)
      UNION
        SELECT pos, mid, nxt, merged FROM runs
        QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1
    ), change AS (
        SELECT unnest([pos, mid]) AS pos, nxt, unnest([merged, NULL]) AS merged FROM chosen
    )
    SELECT t.word, t.pos, coalesce(c.nxt, t.nxt), coalesce(c.merged, t.id), t.round + 1
    FROM t JOIN best ON t.word = best.word LEFT JOIN change c ON c.pos = t.pos
    WHERE c.pos IS NULL OR c.merged IS NOT NULL
  )
)
SELECT t.word, t.id
FROM t JOIN (SELECT word, max(round) AS round FROM t GROUP BY word) USING (word, round)
ORDER BY t.word, t.pos
"""

#: One thread and a sorted input: the aggregate takes the pieces in their order.
DECODE = """
SELECT doc, string_agg(piece, '') AS pieces
FROM (SELECT doc, piece FROM tokens JOIN vocabulary USING (id) ORDER BY doc, pos)
GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file with their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Engine:
    """A worker's tokenizer tables, and the words a task has encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.room = 1
        self.findall = regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        alone = {part for left, right, rank in splits for part in (left, right) if part > rank}
        left, right, merged = (np.array(x, np.int32) for x in zip(*splits)) if splits else [np.zeros(0, np.int32)] * 3
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        given = pa.table({"l": left, "r": right, "merged": merged, "alone": np.isin(merged, list(alone))})
        self.db.register("given", given)
        self.db.execute("CREATE TABLE merges AS FROM given")
        # a byte b stands as the character 256 + b, so that any bytes are valid text
        pieces = ["".join(chr(256 + b) for b in token) for token in ranks]
        self.db.register("given", pa.table({"id": np.array(list(ranks.values()), np.int32), "piece": pieces}))
        self.db.execute("CREATE TABLE vocabulary AS FROM given")
        self.db.unregister("given")

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        raw = [w.encode() for w in words]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        word = np.repeat(np.arange(len(raw), dtype=np.int32), length)
        at = np.arange(len(word), dtype=np.int64) + word  # one free place after each word
        ids = self.single[np.frombuffer(b"".join(raw), np.uint8)]
        self.db.register("start", pa.table({"word": word, "pos": at, "nxt": at + 1, "id": ids}))
        out = self.db.execute(MERGES).fetchnumpy()
        self.db.unregister("start")
        data = np.ascontiguousarray(out["id"], "<u4").tobytes()
        ends = np.searchsorted(out["word"], np.arange(len(raw)), "right") * 4
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def learn(self, pieces: list[str]) -> None:
        """Add the ids of pieces (safe cuts of texts) to those kept."""
        split = [self.findall(piece) for piece in pieces]
        fresh = list({w for words in split for w in words if w not in self.words})
        for i in range(0, len(fresh), self.room * WORDS_AT_ONCE):
            group = fresh[i : i + self.room * WORDS_AT_ONCE]
            self.words.update(zip(group, self.merge(group)))
        get = self.words.__getitem__
        self.pieces.update((p, b"".join(map(get, words))) for p, words in zip(pieces, split))
        if len(self.words) > self.room * KEPT_WORDS:
            self.words.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > self.room * KEPT_PIECES:
            self.pieces.clear()
        cuts = [cut(text) for text in texts]
        wanted = {" " + piece for pieces in cuts for piece in pieces[1:]}
        wanted.update(pieces[0] for pieces in cuts)
        self.learn([p for p in wanted if p not in self.pieces])
        get = self.pieces.__getitem__
        return [b"".join([get(c[0]), *[get(" " + p) for p in c[1:]]]) for c in cuts]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), length)
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
        out = [b""] * len(ids)
        for i in range(0, len(flat), TOKENS_AT_ONCE):
            part = slice(i, i + TOKENS_AT_ONCE)
            pos = np.arange(len(flat[part]), dtype=np.int32)
            self.db.register("tokens", pa.table({"doc": doc[part], "pos": pos, "id": flat[part]}))
            for k, pieces in self.db.execute(DECODE).fetchall():
                out[k] += (np.frombuffer(pieces.encode("utf-16-le"), "<u2") - 256).astype(np.uint8).tobytes()
            self.db.unregister("tokens")
        return out


_engines: dict[tuple[str, str], Engine] = {}


def engine(path: str, pattern: str) -> Engine:
    if (path, pattern) not in _engines:
        _engines[path, pattern] = Engine(read_ranks(path), pattern)
    return _engines[path, pattern]


def release() -> None:
    """At the end of a task: its worker may serve another operator next."""
    for own in _engines.values():
        own.db.close()
    _engines.clear()


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds the column `ids` (array of integers) to `docs`; with `decoded` also what the ids
    stand for (bytes), in the same pass."""
    added = {ids: F.array().cast("array<int>")} | ({decoded: F.lit(b"")} if decoded else {})
    docs = docs.drop(*added)
    schema = docs.withColumns(added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b in portions(column, PORTION):
                made = own.encode([t or "" for t in column.slice(a, b - a).to_pylist()])
                part = batch.slice(a, b - a)
                flat = np.frombuffer(b"".join(made), "<u4").astype(np.int32)
                ends = np.cumsum([0, *(len(m) // 4 for m in made)]).astype(np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    new.append(pa.array(own.decode([np.frombuffer(m, "<u4") for m in made]), pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)
        release()

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the column `out` (the bytes that the ids stand for) to `docs`."""
    docs = docs.drop(out)
    schema = docs.withColumn(out, F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            for i in range(0, len(lists), ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                some = lists.slice(i, ROWS_AT_ONCE)
                flat, ends = some.flatten().to_numpy(zero_copy_only=False), np.cumsum(some.value_lengths().fill_null(0))
                made = own.decode(np.split(flat, ends[:-1]) if len(some) else [])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], names=schema.names)
        release()

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: key, n_tokens, ids_sha256, decoded_sha256, intact.

    `intact` tells whether the decoded bytes are those of the text.
    """
    schema = docs.select(key).schema.add("n_tokens", "long").add("ids_sha256", "string")
    schema = schema.add("decoded_sha256", "string").add("intact", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        own.room = 2  # only digests leave this pass, and the worker keeps its words for the next task
        for batch in batches:
            for a, b in portions(batch.column(1), PORTION):
                part = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                made = own.encode(part)
                back = own.decode([np.frombuffer(m, "<u4") for m in made])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(m) // 4 for m in made], pa.int64()),
                        pa.array([hashlib.sha256(m).hexdigest() for m in made]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                        pa.array([x == t.encode() for x, t in zip(back, part)]),
                    ],
                    names=schema.names,
                )

    return docs.select(key, text).mapInArrow(run, schema)
