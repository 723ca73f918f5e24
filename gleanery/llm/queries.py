"""The registered queries of this subpackage: thin digests of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annsearch, bitplane, fingerprints, jaccard, langid, negatives, packing, pieces, quality, repair, sharding, substring, toxicity
from .common import fold, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify_folds(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 2048, 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annsearch.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.where(toxicity.teaching_rows(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.segment(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), 3)
    return found.select("doc_id", "round_trip", F.col("nbest")[0]["n_pieces"].alias("n_pieces"), F.col("nbest")[0]["ids_crc32"].alias("ids_crc32"), F.col("nbest")["score"].alias("scores"), F.col("nbest")["ids_crc32"].alias("nbest_crc32"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op10_bitplane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane.token_file_digest(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 2)


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = negatives.mine(negatives.shifted_labels(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_streamed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), present="present")


QUERIES = {f.__name__: f for f in (op1_kneser_ney_language, op2_pattern_packing, op3_quality_rules, op4_projected_neighbours, op5_noisy_or_toxicity, op6_jaccard_join, op7_minimax_sharding, op8_nbest_pieces, op9_substring_dedup, op10_bitplane_files, op11_threshold_negatives, op12_imatch_fingerprints, op13_streamed_repair)}

ORACLE_SQL = {
    "op11_threshold_negatives": negatives.oracle_sql(),
    "op12_imatch_fingerprints": fingerprints.oracle_sql(),
    "op13_streamed_repair": repair.oracle_sql(),
    "op3_quality_rules": quality.oracle_sql(),
}
