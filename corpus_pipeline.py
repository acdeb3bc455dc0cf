"""A corpus from raw documents to packed training sequences, as Spark stages.

Each stage takes what the one before kept, whole; ``run`` writes it as Parquet
below the shared folder and reads it again, so a lost executor costs one stage
at most.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import documents
from tidewater.llm.line_dedup import drop_repeated_lines
from tidewater.llm.ngram_join import drop_near_copies
from tidewater.llm.packing import pack, token_pieces
from tidewater.llm.secrets import redact_secrets
from tidewater.llm.toxicity import drop_toxic
from tidewater.llm.vocab import Vocabulary
from tidewater.session import stage_table

#: Tokens of a packed sequence.
SEQUENCE_TOKENS = 1024


def _recounted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go; a document that was nothing else goes with them."""
    return _recounted(drop_repeated_lines(docs))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return drop_near_copies(docs, n=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _recounted(redact_secrets(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    vocab = Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pack(token_pieces(docs, vocab, SEQUENCE_TOKENS), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the learned score or the tokeniser; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
