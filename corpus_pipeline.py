"""The corpus pipeline: five stages, each one training-data operator over all documents its predecessor kept.

Every stage takes (spark, docs, sf_dir); ``run`` writes each stage's result to the shared folder and reads it again,
so a lost executor costs one stage at most. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import decontaminate, mixing, nearcopies, quality, simhash, tokenfile
from caseloom.llm.common import discard, materialize, table, unused


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    into = unused(docs, "quality")
    return quality.quality(docs, into=into).where(F.col(into).kept).drop(into)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: similarity 0.8 or more on word shingles of five. SimHash's index
    names the pairs within its radius; fingerprints differ in about ten bits at that similarity, so bands of MinHash name
    further ones. All are checked on the shingle sets."""
    return simhash.one_of_each(docs, near=nearcopies.similar_roots)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    into = unused(docs, "hits")
    return decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), into=into).where(F.col(into).n_hit == 0).drop(into)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix asks for: what is short of its target is repeated, what is over it thinned."""
    return mixing.mixed_documents(docs, mixing.label_domains(table(spark, sf_dir, "labels")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's address of every document; the store stays in the shared folder."""
    return tokenfile.encode_and_read(docs).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "seq", "place")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token ids", token_stage),
]

#: Fitted models, fingerprints and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            lazy, docs = docs, materialize(docs, f"stage-{k}")
            discard(lazy)  # what the stage read of the shared folder
    return docs
