"""A corpus pipeline: STAGES, each over all its predecessor kept, written and read again.

``run`` applies them to ``documents``. Every stage but the last returns the columns it was
given; ``n_chars`` follows the text. SQL cannot express the pipeline, so ORACLE_SQL is None
and tests hold it against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolens.llm import decontam, langid, simhash, spm, suffix
from chronolens.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; null texts and those without a letter go, no others."""
    model = langid.train(docs)
    return langid.annotate(docs, model, "__langid").where("__langid.has_letter").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.deduplicated(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that documents with smaller doc_ids hold; whole characters
    alone go, and a text of which nothing is left stays as an empty one."""
    found = suffix.dedup(docs)
    text = F.col("dedup.text")
    changed = {"text": text, "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select([changed[c].alias(c) if changed.get(c) is not None else F.col(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to 0.8 of its shingles."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its pieces' ids, their number and digest, and the decoded text's digest."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return spm.digest(spm.encode(docs, path), path, ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
