"""The queries of this subpackage, each a thin call of its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, importance, lm_scoring, near_duplicates, quality
from .alignment import align_documents
from .common import table
from .decontamination import leaking_pairs
from .html_text import extract_pages
from .language_id import predict_languages
from .mixing import mix
from .sentence_pieces import decode_pieces, encode_pieces
from .sharding import shard_documents
from .token_counts import count_tokens

#: File of the public tokenizers; the vocabulary is a parameter and is not part of this repository.
TOKENIZER = "piece_bpe_32k.model"
OTHER_TOKENIZER = "byte_bpe_50k.json"


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_perspectives(table(spark, sf_dir, "conversations"))


def op2_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaking_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_bitmask_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("faults", ",").alias("faults"))


def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_block_rule_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op9_karmarkar_karp_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(OTHER_TOKENIZER), public_tokenizers.path(TOKENIZER))


def op13_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(TOKENIZER)
    ids = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode_pieces(ids, model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_perspective_rotation": op1_perspective_rotation,
    "op2_pigeonhole_decontamination": op2_pigeonhole_decontamination,
    "op3_pretoken_counts": op3_pretoken_counts,
    "op4_bitmask_language_id": op4_bitmask_language_id,
    "op5_adaptive_quality": op5_adaptive_quality,
    "op6_pivotal_mixing": op6_pivotal_mixing,
    "op7_block_rule_extraction": op7_block_rule_extraction,
    "op8_backoff_automaton": op8_backoff_automaton,
    "op9_karmarkar_karp_sharding": op9_karmarkar_karp_sharding,
    "op10_chosen_path_join": op10_chosen_path_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_piece_rounds": op13_piece_rounds,
}
ORACLE_SQL: dict[str, str] = {"op1_perspective_rotation": chat.SQL, "op5_adaptive_quality": quality.SQL, "op8_backoff_automaton": lm_scoring.SQL, "op10_chosen_path_join": near_duplicates.SQL, "op11_importance_resampling": importance.SQL}
