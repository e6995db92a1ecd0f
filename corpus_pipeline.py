"""A corpus pipeline over ``documents``: quality rules, near-dedup, masking of
personal data, mixing of sources and BPE encoding, each by one operator of
``martlet.llm``. Every stage is written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm import bpe, mixing, pii, quality, simhash
from martlet.llm.common import discard, materialize, table
from martlet.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null, empty and very short texts are not among them."""
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; ties by the text."""
    return simhash.keep_one(docs, words=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; a null text stays null."""
    return pii.mask_pii(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a null source is a source."""
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them; a null text has none."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("personal data", personal_data),
          ("mixing sources", mixing_sources), ("bpe encoding", bpe_encoding)]

#: SQL expresses neither the tokenisers nor the groups of near duplicates; the
#: stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next reads it.

    Null and empty texts fail the quality rules, so none comes further; rows that share a
    doc_id, or have none, are rows of their own in every stage but the near duplicates,
    which keep one row of each group; very long texts go through whole; an empty table
    gives an empty result. What a stage leaves beside its result is deleted once that is
    written, and a stage's result once the next one has read it.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = docs
        with scratch(spark) as kept:
            docs = materialize(stage(spark, before, sf_dir), "stage-" + name.replace(" ", "-"))
            kept.append(docs)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
