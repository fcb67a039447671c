"""The registered queries of the corpus operators: each applies its operator
to its whole table; ``ORACLE_SQL`` has DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize, work_path
from . import (byte_bpe, class_lm, exact_dedup, html_text, merkle, mixing, quality, sequence_files, simhash, substrings, token_counts,
               toxicity, turns)
from .common import table
from .oracles import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@query
def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(table(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train_on_labels(docs, table(spark, sf_dir, "labels")))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations")), table(spark, sf_dir, "conversations"))


@query
def op12_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sequence_files.write_sequences(table(spark, sf_dir, "documents"), work_path(spark, "sequences", unique=True),
                                          tokenizer_path("byte_bpe_50k.json"))
    found = sequence_files.with_starts(materialize(sequence_files.read_documents(spark, path)))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), changed_text=merkle.without_line_feeds("doc_id", "text"))
