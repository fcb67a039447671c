"""A corpus pipeline of the operators in ``sparkprep.llm``.

Each stage takes the documents its predecessor kept and returns documents with
the columns it got; the last returns the encoded texts. ``run`` writes every
stage as Parquet in the shared folder and reads it again for the next, so a
stage never recomputes an earlier one.

Nulls, empty and very long texts, ties and repeated rows are treated as the
stages' operators say; further columns of the documents, also such as differ from
others in case only, go through all stages but the last; empty documents give
no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkprep.llm import byte_bpe, exact_dedup, mixing, simhash, toxicity
from sparkprep.llm.common import table
from sparkprep.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.drop_toxic(docs, toxicity.train_on_labels(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs, words=4, bits=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target proportions; a document may come several times."""
    return mixing.mix(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    import public_tokenizers

    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("simhash", simhash_stage),
          ("mixing", mixing_stage), ("byte_bpe", byte_bpe_stage)]

#: No SQL: the stages train a classifier, link fingerprints and encode by byte pairs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
