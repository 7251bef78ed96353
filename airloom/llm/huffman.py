"""Token ids as files of canonical, length-limited Huffman codes.

1. Texts are placed by ranges of their key and sorted; each task encodes its range, keeps
   the ids in one staging file and returns how often it saw each id.
2. The counts of all tasks, summed per id (as many rows as the vocabulary has at most),
   give one code for the whole corpus: package-merge lengths, canonical order.
3. Each staging file becomes one code file. Blocks of a fixed number of ids follow each
   other without padding; the footer holds every block's bit offset, so that any block
   can be decoded alone, and the key and length of each document.
4. Reading goes file by file: a table of all code words of the longest length decodes many
   blocks in step, and a running checksum is carried over block limits.

File: b"HUF1", code bits, footer (an Arrow stream), footer length (8 bytes). Files are in
key order; a document's ids end with the end id. Names hold a random part and only files
that a finished task has listed are read, so a task may run twice or be lost. A staging file
is removed once its code file is whole and has its final name.

Defined results: null text is the empty text (its only id is the end id); equal keys are
ordered by text, null keys come first; further columns are ignored; an empty table gives
no files and an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from struct import pack
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airloom.llm.shared import cut, portions, shared_folder, stored

MAGIC = b"HUF1"
#: Ids in a block, blocks decoded in step, longest code word (more for larger vocabularies).
BLOCK, BLOCKS_AT_ONCE, MAX_BITS = 1024, 2048, 16
#: Ids whose counts share a row.
PAGE = 64
#: Memory bound of one worker: words remembered, and pieces in each of two generations.
KEPT_WORDS, KEPT_PIECES = 100_000, 200_000

#: Bytes of text encoded at a time.
PORTION = 4_000_000
#: Texts that go to a worker at a time.
BATCH_ROWS = 2_000
#: A space or line break that may not be cut: white space (or, for a space, the text's end) is behind it.
UNSAFE = r"[ \n][\s\x0b\x1c-\x1f\x85\p{Z}]| $"
#: Latin letters, and a sign of ASCII after them.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]?)")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the other
    bytes for the characters from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    Texts are cut where no token can cross. The pieces of a whole batch are made distinct in
    Arrow, the library's model sees each distinct word of the split pattern once (as long as it
    is remembered), and the ids of all pieces are put in a row by NumPy.
    """

    def __init__(self, path: str, pattern: str):
        library = Tokenizer.from_file(path)
        self.tokenize, self.largest = library.model.tokenize, max(library.get_vocab().values())
        self.findall = regex.compile(pattern).findall
        self.letters = byte_letters()
        #: does the pattern take a space and letters as one word, and a sign after them as another?
        self.simple = self.findall(" azÀɏ, azAZ'") == [" azÀɏ", ",", " azAZ", "'"]
        self.words: dict[str, bytes] = {}
        # pieces met lately, and those met before: what is met again moves over, the rest goes
        self.pieces: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of a word of the split pattern, as little-endian 32-bit integers."""
        known = self.words.get(word)
        if known is None:
            found = [t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.letters))]
            known = self.words[word] = pack(f"<{len(found)}I", *found)
        return known

    def piece(self, piece: str) -> bytes:
        return b"".join(map(self.word, self.findall(piece)))

    def learn(self, new: list[str]) -> None:
        """Remember pieces; a space stood before those that begin with no line break. Most are
        letters, or those and one sign."""
        pieces, plain, word, tokenize, space = self.pieces, PLAIN.fullmatch, self.word, self.tokenize, self.letters[32]
        earlier = self.earlier.get
        for p in new:
            known = earlier(p)
            if known is not None:
                pieces[p] = known
                continue
            found = plain(p) if self.simple else None
            if found is None:
                pieces[p] = self.piece(p if p.startswith("\n") else " " + p)
                continue
            letters, sign = found.groups()
            known = pieces.get(letters) or earlier(letters)
            if known is None:
                seen = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in tokenize(space + seen)]
                known = pieces[letters] = pack(f"<{len(ids)}I", *ids)
            if sign:
                pieces[p] = known + word(sign)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) in a row, and how many each text has."""
        if len(self.pieces) > KEPT_PIECES:
            self.earlier, self.pieces = self.pieces, {}
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        pieces, begin = split(texts)
        # the first piece of a text has no space before it
        firsts = [self.piece(p) for p in pieces.take(pa.array(begin)).to_pylist()]
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.pieces
        found = list(map(known.get, distinct))
        self.learn([p for p, f in zip(distinct, found) if f is None])
        found = [known[p] if f is None else f for p, f in zip(distinct, found)] + firsts
        at = coded.indices.to_numpy().astype(np.int64)
        at[begin] = len(distinct) + np.arange(len(begin))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        source = np.cumsum(size) - size
        sizes = size[at]
        ends = np.cumsum(sizes)
        row = np.repeat(source[at] - (ends - sizes), sizes) + np.arange(ends[-1])
        return np.frombuffer(b"".join(found), "<u4")[row], np.add.reduceat(sizes, begin)


def split(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of all texts in order, and the place of each text's first piece.

    Texts are cut at spaces, which go, and before line breaks: the split pattern takes a single
    line break, and a space and what follows it, as words of their own.
    """
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)).tolist()
    if odd:
        # these hold longer runs of white space and are cut one by one, at spaces only
        own = pa.array([cut(t) for t in texts.take(pa.array(odd)).to_pylist()], lists.type)
        order = np.arange(len(texts))
        order[odd] = len(texts) + np.arange(len(odd))
        lists = pa.concat_arrays([lists, own]).take(pa.array(order))
    count = pc.list_value_length(lists).to_numpy()
    return lists.flatten(), np.cumsum(count) - count


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code length of each id, 0 for ids that never occur; optimal under the limit.

    Package-merge: level by level, leaves and packages of two are merged by weight; of the
    last level the cheapest 2n - 2 count, and packages among them pass the rest down.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = np.asarray(counts, np.int64)[order]
    levels, row = [], leaves
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        levels.append(by < n)
        row = both[by]
    take = 2 * n - 2
    for is_leaf in [*reversed(levels), np.ones(n, bool)]:
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code words: shorter first, then by id, each the successor of the one before."""
    codes = np.zeros(len(lengths), np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        top = int(lengths[order[-1]])
        step = np.int64(1) << (top - lengths[order])
        codes[order] = (np.cumsum(step) - step) >> (top - lengths[order])
    return codes


class BitWriter:
    """Appends code words to a file, most significant bit first."""

    def __init__(self, sink, lengths: np.ndarray):
        self.sink, self.lengths, self.codes = sink, lengths, canonical(lengths).astype(np.uint64)
        self.bits, self.rest = 0, 0  # bits so far; the value of the last, unfinished 32 bits

    def write(self, ids: np.ndarray) -> np.ndarray:
        """Returns the bit offset of every BLOCK-th id."""
        size = self.lengths[ids]
        used = self.bits % 32
        at = np.cumsum(size)
        total = int(at[-1]) + used
        at += used - size
        # a code word lies in the 32 bits where it begins and at most the next 32
        window = self.codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        word = at >> 5
        begins = np.flatnonzero(np.diff(word, prepend=-1))  # no code word is as long as 32 bits: each begins somewhere
        held = np.bitwise_or.reduceat(window, begins)
        out = np.zeros(len(held) + 1, np.uint64)
        out[:-1] = held >> np.uint64(32)
        out[1:] |= held & np.uint64(0xFFFFFFFF)
        out[0] |= np.uint64(self.rest)
        offsets = at[::BLOCK] + (self.bits - used)
        self.bits += total - used
        self.sink.write(out[: total // 32].astype(">u4").tobytes())
        self.rest = int(out[total // 32]) if total % 32 else 0
        return offsets

    def close(self) -> None:
        self.sink.write(self.rest.to_bytes(4, "big")[: -(-(self.bits % 32) // 8)])


class Table:
    """Decoding table: every value of the longest length, its id and true length."""

    def __init__(self, lengths: np.ndarray):
        self.top = int(lengths.max(initial=1))
        codes, used = canonical(lengths), np.flatnonzero(lengths)
        # the id above bit 5, the length below
        self.found = np.ones(1 << self.top, np.uint32)
        order = used[np.argsort(codes[used] << (self.top - lengths[used]))]
        spans = np.int64(1) << (self.top - lengths[order])
        self.found[: spans.sum()] = np.repeat((order << 5) | lengths[order], spans)

    def decode(self, data: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """`n` ids from blocks that begin at the bit offsets (the last may be short)."""
        b = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        blocks = len(offsets)
        out = np.zeros((BLOCK, blocks), np.uint32)
        at = offsets.astype(np.int64)
        last = n - (blocks - 1) * BLOCK
        right = np.uint32(32 - self.top)
        for i in range(BLOCK if blocks > 1 else last):
            if i == last:
                at = at[:-1]
            found = self.found[(window[at >> 3] << (at & 7).astype(np.uint32)) >> right]
            out[i, : len(at)] = found
            at = at + (found & 31)
        return (out.T >> 5).reshape(-1)[:n]


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder)


def stage_ids(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int, key: str, text: str) -> DataFrame:
    """One row for each key range: part, file, n_ids, and the counts of ids by pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        fs, base = _open(folder)
        name, total, counts = f"{base}/ids-{uuid4().hex}", 0, np.zeros(0, np.int64)
        # two bytes for an id where they hold all: as small as compressed ones, and far cheaper
        kind = np.uint16 if max(own.largest, end_id) < 1 << 16 else np.uint32
        staged = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.from_numpy_dtype(kind)))])
        sink = writer = None
        for batch in batches:
            for a, b in portions(batch.column(1), PORTION):
                ids, size = own.encode(batch.column(1).slice(a, b - a))
                ends = np.cumsum(size + 1)
                flat = np.full(int(ends[-1]), end_id, kind)
                inner = np.ones(len(flat), bool)
                inner[ends - 1] = False
                flat[inner] = ids
                seen = np.bincount(flat, minlength=len(counts))
                counts = seen + np.pad(counts, (0, len(seen) - len(counts)))
                ends = pa.array(np.append(0, ends).astype(np.int32))
                if writer is None:
                    sink = fs.open_output_stream(name)
                    writer = pa.ipc.new_stream(sink, staged)
                lists = pa.ListArray.from_arrays(ends, pa.array(flat))
                writer.write(pa.record_batch([batch.column(0).slice(a, b - a), lists], schema=staged))
                total += len(flat)
        if writer is not None:
            writer.close()
            sink.close()
            paged = np.pad(counts, (0, -len(counts) % PAGE)).reshape(-1, PAGE)
            pages = np.flatnonzero(paged.any(1))
            held = paged[pages].tolist()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "n_ids": [total]}
                | {"pages": pa.array([pages], pa.list_(pa.int32())), "counts": pa.array([held], pa.list_(pa.list_(pa.int64())))}
            )

    placed = docs.select(F.col(key).cast("long"), F.col(text)).repartitionByRange(key, text)
    schema = "part int, file string, n_ids long, pages array<int>, counts array<array<long>>"
    return placed.sortWithinPartitions(key, text).mapInArrow(run, schema)


def write_files(staged: DataFrame, folder: str, lengths: np.ndarray) -> DataFrame:
    """A code file for each staging file: part, file, n_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                one = {"part": pa.array([row["part"]], pa.int32()), "n_ids": [row["n_ids"]]}
                # a staging file goes once its code file is whole; a task that runs again finds that one
                done = f"{base}/codes-{row['part']:06d}-{row['file'].rpartition('-')[2]}"
                if fs.get_file_info(done).type == pafs.FileType.File:
                    yield pa.RecordBatch.from_pydict(one | {"file": [done]}).select(["part", "file", "n_ids"])
                    continue
                name = f"{done}-{uuid4().hex}"
                keys, sizes, offsets, rest = [], [], [], np.zeros(0, np.uint32)
                with fs.open_output_stream(name) as sink, fs.open_input_stream(row["file"]) as source:
                    sink.write(MAGIC)
                    bits = BitWriter(sink, lengths)
                    for part in pa.ipc.open_stream(source):
                        keys.append(part.column(0))
                        sizes.append(part.column(1).value_lengths())
                        rest = np.concatenate([rest, part.column(1).values.to_numpy()])
                        whole = len(rest) // BLOCK * BLOCK
                        if whole:
                            offsets.append(bits.write(rest[:whole]))
                            rest = rest[whole:]
                    if len(rest):
                        offsets.append(bits.write(rest))
                    bits.close()
                    foot = pa.BufferOutputStream()
                    for columns in (
                        {"key": pa.chunked_array(keys), "size": pa.chunked_array(sizes)},
                        {"offset": np.concatenate(offsets)},
                    ):
                        made = pa.table(columns)
                        with pa.ipc.new_stream(foot, made.schema) as stream:
                            stream.write_table(made)
                    footer = foot.getvalue().to_pybytes()
                    sink.write(footer + len(footer).to_bytes(8, "little"))
                fs.move(name, done)
                fs.delete_file(row["file"])
                yield pa.RecordBatch.from_pydict(one | {"file": [done]}).select(["part", "file", "n_ids"])

    return staged.select("part", "file", "n_ids").mapInArrow(run, "part int, file string, n_ids long")


def read_file(fs, name: str, table: Table, blocks: int = BLOCKS_AT_ONCE) -> tuple[pa.Table, Iterator[np.ndarray]]:
    """Documents (key, size) of a code file, and its ids, some blocks at a time."""
    source = fs.open_input_file(name)
    size = source.size()
    source.seek(size - 8)
    length = int.from_bytes(source.read(8), "little")
    source.seek(0)
    if source.read(4) != MAGIC:
        raise ValueError(f"{name} is no code file")
    source.seek(size - 8 - length)
    foot = pa.BufferReader(source.read(length))
    docs = pa.ipc.open_stream(foot).read_all()
    offsets = pa.ipc.open_stream(foot).read_all().column(0).to_numpy()
    n = int(np.sum(docs.column("size").to_numpy(), dtype=np.int64))

    def ids() -> Iterator[np.ndarray]:
        with source:
            for i in range(0, len(offsets), blocks):
                own = offsets[i : i + blocks]
                begin = int(own[0]) // 8
                end = int(offsets[i + blocks]) // 8 + 1 if i + blocks < len(offsets) else size - 12 - length
                source.seek(len(MAGIC) + begin)
                data = source.read(end - begin)
                yield table.decode(data, own - begin * 8, min(n - i * BLOCK, len(own) * BLOCK))

    return docs, ids()


def read_documents(files: DataFrame, lengths: np.ndarray, key: str = "doc_id") -> DataFrame:
    """Per document: key, start, n_tokens, ids_crc32. `files` has part, file, n_ids, start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                fs, _ = _open(row["folder"])
                docs, parts = read_file(fs, row["file"], table)
                size = docs.column("size").to_numpy().astype(np.int64)
                begin = np.cumsum(size) - size
                sums, at, k = np.zeros(len(size), np.int64), 0, 0
                for ids in parts:
                    data = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                    while k < len(size) and begin[k] < at + len(ids):
                        a, b = max(0, int(begin[k]) - at), min(len(ids), int(begin[k] + size[k]) - at)
                        sums[k] = zlib.crc32(data[4 * a : 4 * b], int(sums[k]))
                        if begin[k] + size[k] > at + len(ids):
                            break
                        k += 1
                    at += len(ids)
                keys = docs.column("key").combine_chunks()
                values = [keys, pa.array(begin + row["start"]), pa.array(size), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(values, names=[key, "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, f"{key} long, start long, n_tokens long, ids_crc32 long")


def write_and_read(
    docs: DataFrame, path: str, pattern: str, end_id: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes all texts, writes code files in key order, and returns what they hold."""
    spark: SparkSession = docs.sparkSession
    folder = shared_folder(spark)
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, BATCH_ROWS)
    try:
        staged = stored(stage_ids(docs, folder, path, pattern, end_id, key, text))
    finally:
        spark.conf.set(rows, before)
    seen = staged.select(F.explode(F.arrays_zip("pages", "counts")).alias("x")).select("x.*").groupBy("pages")
    counts = seen.agg(*[F.sum(F.col("counts")[k]).alias(f"n{k}") for k in range(PAGE)]).collect()  # as many as the vocabulary
    total = np.zeros(PAGE * (1 + max((r.pages for r in counts), default=0)), np.int64)
    for row in counts:
        total[row.pages * PAGE : (row.pages + 1) * PAGE] = row[1:]
    lengths = code_lengths(total)
    # one row for each file from here on
    n = max(1, staged.count())
    files = stored(write_files(staged.select("part", "file", "n_ids").repartition(n), folder, lengths))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    placed = placed.withColumn("folder", F.lit(folder))
    return read_documents(placed.repartition(n), lengths, key)

