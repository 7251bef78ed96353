"""Language identification by cross-parsing against suffix automata.

A suffix automaton of sample text per language recognises exactly the substrings of that
text. A document is parsed greedily: each phrase is the longest match that the automaton
allows from there, or one unknown character. Text of the same language falls into few, long
phrases. Longer samples hold longer matches by chance, so phrases are normalised by what it
takes to name one: the logarithm of the places of the language's sample and the single
characters together. The language with the fewest normalised phrases wins; with samples of
equal length that is the one with the fewest phrases.

Texts are lower-cased, every run of characters that are no letters counts as one space, and
they are parsed in blocks of `BLOCK` characters (a block's end ends a phrase in every
language alike), so that a whole batch moves through a transition table in step. Whole
texts are parsed, whatever their length.

Learning takes a bounded sample: `sample_docs` rows of each language, those with the
smallest hash of their key, and `sample_chars` characters of each. That sample, a few
tens of thousands of characters per language, is all that goes through the driver.

Defined results: `und` with score 0 for null text, text without a letter, or if nothing was
learned; equal costs go to the first language by name; the score is 1 - best / second
cost, 1 with one language; rows without key or label are never learned from; repeated
rows give a row each; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.shared import portions

SAMPLE_DOCS, SAMPLE_CHARS = 60, 600
BLOCK = 512
#: Bytes of text parsed at a time; the arrays of a portion take about forty times as much.
PORTION = 1_500_000
#: Letters with a class of their own; further letters share classes, which bounds the table.
OWN_LETTERS, SHARED_LETTERS = 96, 24
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the row is kept back from learning; false without key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
           sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Labelled sample texts of each language."""
    usable = docs.filter(F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    order = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")
    ranked = usable.select(F.col(key).alias("k"), F.col(lang).alias("l")).withColumn("n", F.row_number().over(order))
    chosen = ranked.filter(F.col("n") <= sample_docs).select("k", "l").distinct()
    texts = usable.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.substring(text, 1, sample_chars).alias("t"))
    found: dict[str, list[str]] = {}
    for row in texts.join(chosen, ["k", "l"]).dropDuplicates(["k", "l"]).orderBy("l", "k").collect():
        found.setdefault(row.l, []).append(row.t)
    return found


class Classes:
    """Character classes: 0 anything but a letter, then letters; the last one is padding."""

    def __init__(self, texts: list[str]):
        seen = Counter(c for t in texts for c in t.lower() if c.isalpha())
        ranked = sorted(seen, key=lambda c: (-seen[c], c))
        self.own = ranked[:OWN_LETTERS]
        shared = SHARED_LETTERS
        points = np.arange(0x110000)
        letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        self.of = np.where(letters, 1 + len(self.own) + points % shared, 0).astype(np.uint8)
        self.of[[ord(c) for c in self.own]] = np.arange(1, 1 + len(self.own))
        self.count = 2 + len(self.own) + shared
        self.padding = self.count - 1

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all texts in a row, runs of 0 as one, and the length of each text."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        classes = self.of[points]
        owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lowered), np.int64, len(texts)))
        again = np.zeros(len(classes), bool)
        again[1:] = (classes[1:] == 0) & (classes[:-1] == 0) & (owner[1:] == owner[:-1])
        return classes[~again], np.bincount(owner[~again], minlength=len(texts))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state != -1 and symbol not in step[state]:
            step[state][symbol] = new
            state = link[state]
        if state != -1:
            target = step[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(step)
                step.append(dict(step[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state != -1 and step[state].get(symbol) == target:
                    step[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    return step


def parse_table(symbols: list[int], classes: int) -> np.ndarray:
    """Next state of each (state, class), with the phrases ended by that step above bit 24."""
    steps = suffix_automaton(symbols)
    table = np.full((len(steps), classes), -1, np.int32)
    for state, row in enumerate(steps):
        if row:
            table[state, list(row)] = list(row.values())
    restart = np.where(table[0] >= 0, table[0] | (1 << 24), 2 << 24).astype(np.int32)
    ended = np.where(table >= 0, table, restart)
    ended[0] = np.where(table[0] >= 0, table[0], 1 << 24)  # nothing was open at the start
    ended[:, classes - 1] = np.arange(len(steps))  # padding changes nothing
    return ended.reshape(-1)


class Model:
    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        self.classes = Classes([t for lang in self.langs for t in samples[lang]])
        self.tables, sizes = [], []
        for lang in self.langs:
            symbols, _ = self.classes.read([" " + t + " " for t in samples[lang]])
            self.tables.append(parse_table(symbols.tolist(), self.classes.count))
            sizes.append(len(symbols))
        #: what a phrase costs in each language
        self.bits = np.log2(np.array(sizes) + self.classes.count)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text by each language."""
        symbols, length = self.classes.read(texts)
        blocks = -(-length // BLOCK)
        of_block = np.repeat(np.arange(len(texts)), blocks)
        grid = np.full(int(blocks.sum()) * BLOCK, self.classes.padding, np.uint8)
        begin = (np.cumsum(blocks) - blocks) * BLOCK - (np.cumsum(length) - length)
        grid[np.arange(len(symbols)) + np.repeat(begin, length)] = symbols
        grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for k, table in enumerate(self.tables):
            state = np.zeros(grid.shape[1], np.int32)
            ended = np.zeros(grid.shape[1], np.int32)
            for row in grid:
                value = table.take(state * np.int32(self.classes.count) + row)
                ended += value >> 24
                state = value & 0xFFFFFF
            out[:, k] = np.bincount(of_block, ended + (state > 0), len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        readable = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.langs else []
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if readable:
            costs = self.phrases([texts[i] for i in readable]) * self.bits
            best = costs.argmin(1)
            lowest = np.sort(costs, 1)
            score = 1 - lowest[:, 0] / lowest[:, 1] if len(self.langs) > 1 else np.ones(len(readable))
            for i, b, s in zip(readable, best.tolist(), score.tolist()):
                langs[i], scores[i] = self.langs[b], s
        return langs, scores


_models: dict[tuple, Model] = {}


def model(samples: dict[str, list[str]]) -> Model:
    """The model of a sample, built once for a task."""
    key = tuple((lang, tuple(texts)) for lang, texts in sorted(samples.items()))
    if key not in _models:
        _models.clear()
        _models[key] = Model(samples)
    return _models[key]


def predict(docs: DataFrame, samples: dict[str, list[str]], text: str = "text") -> DataFrame:
    """Adds `lang_pred` and `score` to `docs`."""
    docs = docs.drop("lang_pred", "score")
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(samples)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for a, b in portions(texts, PORTION):
                langs, scores = own.predict(texts.slice(a, b - a).to_pylist())
                part = batch.slice(a, b - a)
                made = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(made, names=schema.names)
        _models.clear()  # the worker may serve another operator next

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learns from the rows not held out and predicts all: key, held_out, lang_pred, score."""
    samples = sample(docs.filter(~held_out(F.col(key))), key, text, lang)
    made = predict(docs.select(key, text), samples, text)
    return made.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")
