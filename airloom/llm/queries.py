"""Registered queries of the training-data operators, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import (
    bpe,
    chat,
    ctph,
    decontaminate,
    huffman,
    importance,
    langid,
    packing,
    secret_scan,
    simhash,
    structure,
    surrogates,
    warc,
)
from airloom.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op2_chat_format", chat.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op3_simhash_groups")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


@query("op4_piecewise_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_next(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = ~langid.held_out(F.col("key"))
    return secret_scan.scan(table(spark, sf_dir, "documents"), learn=learn)


@query("op6_warc_archives", warc.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages"))


@query("op7_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = surrogates.replace(table(spark, sf_dir, "documents"), surrogates.KEY, count="n_replaced")
    return made.select("doc_id", "text", "n_replaced")


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return huffman.write_and_read(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op10_decontamination", decontaminate.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_structure_repair", structure.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.report(structure.damaged(structure.typed(table(spark, sf_dir, "conversations"))))


@query("op12_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op13_importance_resampling", importance.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
