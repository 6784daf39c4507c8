"""The queries of this package and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, language, minhash, packing, personal, phrases, quality_rules, secrets, sql, suffix_dedup, token_counts, toxicity, whitening
from .common import table, tokenizer_file


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    counts = [F.col(f"stats.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The source stands for the repository; whoever holds one text, in any number of copies, is one owner.
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, F.col("source"), F.xxhash64("text")))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), 2048)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"), 4, 85)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find(table(spark, sf_dir, "documents"), ["doc_id"]))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read here, so that the other queries don't need the pipeline's file.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_language": op5_language,
    "op6_secret_scan": op6_secret_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_personal_data": op9_personal_data,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_collocations": op12_collocations,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": pipeline,
}
# The pipeline learns rules and hashes, so it has no SQL (corpus_pipeline.ORACLE_SQL is None).
SQL: dict[str, str] = {"op12_collocations": sql.COLLOCATIONS}
