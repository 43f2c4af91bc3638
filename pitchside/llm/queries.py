"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, ppm, vector_codes
from .common import held_out, table
from .decontam import find_leaks
from .embed_dedup import embedding_components
from .langid import identify_documents
from .line_dedup import line_report
from .packing import pack_documents
from .runs import find_runs, repeat_tails
from .sharding import shard_documents
from .simhash import simhash_components
from .suffix_dedup import removed_bytes
from .toxicity import score_documents


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"), least=0.8)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_bytes(table(spark, sf_dir, "documents"), length=400)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), shards=16, keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify_documents(table(spark, sf_dir, "documents"), ~held_out("doc_id", 4, 2))
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ppm.score_documents(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"), least=0.98)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_to_weights(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeat_tails("doc_id", "text").alias("text"))
    out = find_runs(docs, keep=["doc_id"], least=4, shortest=6)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                      F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                      F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"],
                          end_id=2, capacity=1024)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compression_report(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_decontamination, op2_line_dedup, op3_toxicity, op4_suffix_array_dedup, op5_sharding, op6_language_id,
        op7_lm_scoring, op8_embedding_near_dedup, op9_mixing, op10_simhash_near_dedup,
        op11_periodic_runs, op12_best_fit_packing, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": mixing.ORACLE_SQL, "op13_vector_codes": vector_codes.ORACLE_SQL}
