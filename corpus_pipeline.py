"""The corpus pipeline: five stages, each over all rows that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import bpe, decontaminate, langid, simhash, surrogates
from airloom.llm.shared import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without text or letters go."""
    samples = langid.sample(docs.filter(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, samples)
    return judged.filter(F.col("lang_pred") != langid.UNDETERMINED).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced and `n_chars` counted anew."""
    made = surrogates.replace(docs, surrogates.KEY)
    return made.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, lang, source, n_tokens, ids; decoding gave its text."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    made = bpe.encode(docs.select("doc_id", "text", "lang", "source"), path, pattern, decoded="decoded")
    intact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    ids = F.when(intact, F.col("ids")).otherwise(F.raise_error(F.lit("a text was not decoded as it was")))
    return made.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Suffix automata, XXH64 and BPE merges have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
