"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import mixing, ngram_join, packing, pii, quality
from contrail.llm.common import stage_table, table
from contrail.llm.queries import RANKS, TOKENIZER


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the quality rules reject go."""
    return quality.filtered(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each near-duplicate group stays."""
    return ngram_join.deduplicate(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: personal data become pseudonyms; n_chars follows the text."""
    return pii.pseudonymise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often, and in the order, as the mix uses them."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token sequences of at most 1024 ids, with the pieces they hold."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS),
                        public_tokenizers.PATTERN, sequences=True)


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_jaccard", drop_near_duplicates),
    ("pii", pseudonymise),
    ("mixing", mix),
    ("packing", pack),
]

#: Feistel pseudonyms, MinHash bands and the tokenizer have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), "pipeline", name)
    return STAGES[-1][1](spark, docs, sf_dir)
