"""The query of each operator and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hmm_scores, license_model, merge_dropout, minhash_tensor, quality_crf, quality_rules, sorted_passes, source_schedule, token_counts, warc_zip

from .common import Workspace

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents")).drop("longest_repeat")


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_passes.near_duplicates(table(spark, sf_dir, "embeddings"))


def quality_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    out = quality_crf.score(docs, model)
    held = F.coalesce(quality_crf.sample_fold() == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"))


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows arrive in two deliveries, by the parity of their id's hash: the counts of the
    first are stored, and the whole table then meets them."""
    docs = table(spark, sf_dir, "documents")
    cache = f"{Workspace(spark, 'token-cache').path}/counts"
    token_counts.count_tokens(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), tokenizer(BYTE_BPE), cache)
    return token_counts.count_tokens(docs, tokenizer(BYTE_BPE), cache)


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_tensor.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = source_schedule.schedule(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores.score(table(spark, sf_dir, "documents"))


def license_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _, out = license_model.scan(docs, license_model.train())
    return out.select("doc_id", "license", "probability", "similarity", "n_paragraphs")


def merge_dropout_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode(table(spark, sf_dir, "documents"), tokenizer(PIECE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_repetition": quality_rule_verdicts,
    "op2_zip_warc": warc_round_trip,
    "op3_sorted_projections": embedding_neighbours,
    "op4_line_crf": quality_classes,
    "op5_digest_cache": token_totals,
    "op6_tensored_minhash": near_duplicate_documents,
    "op7_source_schedule": source_mix,
    "op8_hidden_markov": language_scores,
    "op9_license_classes": license_families,
    "op10_merge_dropout": merge_dropout_pieces,
}
