"""A training-data pipeline over ``documents``: language, near copies, benchmark items, secrets, packing.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before has kept, and returns a frame; all but the
last return the columns of docs. Between stages the frame is written to the shared scratch folder and read again, so a
lost executor repeats a part of one stage only.

* language: documents without a letter, or in no learned language, go; the languages are learned from docs.
* near_dedup: one document of each group of near copies stays (five-word shingles, 80 % in common).
* decontamination: documents that hold a benchmark item within its edit budget go.
* secrets: findings are replaced by a mark; all documents stay, and ``n_chars`` follows the text.
* packing: every remaining document is tokenized and packed; a row per piece.

Null texts have no letter and go in the first stage; extra columns pass through all filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontam, langid, neardup, packing, secrets
from stratalake.llm.common import Scratch, shared_within, table

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted_documents(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.learn(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("packing", pack),
]

#: No stage can be put in SQL as a whole; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of the table ``documents``."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with shared_within():
            docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}-{name}")
        if k:
            scratch.drop(f"stage-{k - 1}-{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
