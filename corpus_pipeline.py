"""A corpus pipeline: documents that may be learned from, once each, without personal data, mixed and tokenised.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns what the next one gets as docs.
All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm import bpe, mixing, near_copies, pii, toxicity
from inkwell.llm.common import keep_table, read

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a classifier, trained on the labelled ones, rejects."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard similarity of five-word shingles from 0.8) the document with the smallest id;
    candidates by SimHash, and by min-hash bands where fingerprints are too far apart."""
    return near_copies.without_near_copies(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with placeholders for personal data, n_chars counted anew."""
    masked = pii.mask_pii(docs)
    if "n_chars" not in docs.columns:
        return masked
    count = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"])
    return masked.withColumn("n_chars", count).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files in name order, rows in file order."""
    rows = docs.select("doc_id", "source", F.struct(*docs.columns).alias("document"))
    return mixing.in_mix_order(mixing.mix(rows, by_halves=True)).select("document.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the bytes that they decode to."""
    tokens = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded=True)
    return bpe.digests(tokens, "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mix sources", mix_sources),
    ("bpe", tokenize),
]

# Trained models and fingerprints are beyond SQL; tests/llm compares the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written to the shared folder before the next one."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
