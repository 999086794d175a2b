"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (
    alignment,
    embedding_join,
    language_model,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    piece_codec,
    pii,
    quality,
    secrets,
    substring_dedup,
    token_counts,
)
from contrail.llm.common import table
from contrail.llm.oracle import ORACLE
from contrail.session import work_path

__all__ = ["ORACLE", "QUERIES", "RANKS", "TOKENIZER"]

TOKENIZER, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op2_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                        public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.links(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.links(table(spark, sf_dir, "documents"))


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, counts=True)


def op6_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.train_and_score(table(spark, sf_dir, "documents"))


def op7_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words", "n_same_neighbours", "n_upper")


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same documents: the second meets the ledger of the first and has nothing to scan."""
    docs, ledger = table(spark, sf_dir, "documents"), work_path(spark, "llm", "ledger")
    secrets.scan_unseen(docs, ledger)
    return secrets.digest(secrets.scan(docs, ledger))


def op11_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(PIECES)
    return piece_codec.digest(piece_codec.decode(piece_codec.encode(table(spark, sf_dir, "documents"), model), model))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES),
                           public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix_sources, op2_pack_sum_of_squares, op3_embedding_near_dups,
                            op4_ngram_jaccard_join, op5_pii_pseudonyms, op6_kneser_ney_scores,
                            op7_trie_token_counts, op8_repeated_passages, op9_quality_rules,
                            op10_secret_ledger, op11_sentencepiece_codec, op12_periodic_runs,
                            op13_tokenizer_alignment)}
