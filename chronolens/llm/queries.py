"""Registered queries of the subpackage: one ``opN_<name>`` for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, audit, chat, decontam, langid, lm, sharding, simhash, spm, suffix, token_output, topk, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), 40)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_output.new_folder(spark)
    token_output.write_blocks(_read(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_output.digest(spark, folder)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents")).drop("text_key")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    # lang, source and doc_id stay out of the prediction; held_out follows from the id afterwards
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return spm.digest(spm.encode(_read(spark, sf_dir, "documents"), path), path)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[f"dedup.{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_read(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    records = chat.records_from_rows(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe))
    return chat.digests(chat.format_chats(records))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(_read(spark, sf_dir, "embeddings"), most=16)
    return out.withColumn("deviation", F.col("deviation").cast("long"))  # an error where it does not fit


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_token_output": op2_token_output,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_nearest": op7_nearest,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_chat": op10_chat,
    "op11_topk": op11_topk,
    "op12_whitening": op12_whitening,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op8_decontamination": decontam.ORACLE,
    "op11_topk": topk.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
