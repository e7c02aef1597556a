"""The corpus pipeline: documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscout.llm.common import documents, drop_stage, stage, table, unique_texts, work_folder
from gridscout.llm.decontamination import decontaminate
from gridscout.llm.language_id import UNKNOWN, identify
from gridscout.llm.near_dedup import near_duplicates
from gridscout.llm.packing import pack
from gridscout.llm.queries import tokenizer
from gridscout.llm.substring_dedup import substring_dedup
from gridscout.sources.tables import staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (no text, no letter); lang becomes the predicted one."""
    found = identify(docs, carry=("source", "n_chars")).where(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    kept = near_duplicates(docs).where("kept").select("doc_id")
    return unique_texts(docs, "doc_id", "text", *COLUMNS).join(kept, "doc_id", "left_semi").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand earlier; a text without any stays as it is. No document goes."""
    cut = substring_dedup(docs, carry=("lang", "source", "n_chars"), whole=True)
    cut = cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents contaminated by benchmark items."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=("text", "lang", "source", "n_chars"))
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their sequences and places there."""
    return pack(docs, tokenizer())


STAGES = [
    ("language id", languages),
    ("near dedup", near_copies),
    ("substring dedup", substrings),
    ("decontamination", benchmark),
    ("packing", packing),
]
#: The language model and the packing are not SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents, written below the shared folder; all that was staged on the way is removed."""
    out = work_folder(spark, "pipeline")
    with staging(spark):
        docs = documents(spark, sf_dir)
        for i, (_, step) in enumerate(STAGES[:-1]):
            before, docs = docs, stage(step(spark, docs, sf_dir))
            if i:
                drop_stage(before)
        STAGES[-1][1](spark, docs, sf_dir).write.parquet(out)
    return spark.read.parquet(out)
