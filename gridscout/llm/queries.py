"""The registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscout.llm.common import documents, table, work_folder
from gridscout.llm.decontamination import decontaminate
from gridscout.llm.fill_in_middle import fill_in_middle, restored
from gridscout.llm.fingerprints import fingerprints
from gridscout.llm.language_id import identify
from gridscout.llm.licenses import scan_licenses
from gridscout.llm.lm_scoring import lm_scores
from gridscout.llm.near_dedup import near_duplicates
from gridscout.llm.packing import pack
from gridscout.llm.quality import quality_scores
from gridscout.llm.substring_dedup import substring_dedup
from gridscout.llm.toxicity import toxicity
from gridscout.llm.warc import read_warc, write_warc
from gridscout.llm.whitening import whiten


def tokenizer() -> str:
    """The vocabulary file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.array_join("langs", ",").alias("langs"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir)).withColumnRenamed("edited", "edited_sha256")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer())


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_warc(write_warc(table(spark, sf_dir, "pages"), work_folder(spark, "warc")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(documents(spark, sf_dir))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("segments").cast("long").alias("n_segments"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_language_id,
        op3_fingerprints,
        op4_license_scan,
        op5_near_dedup,
        op6_best_fit_packing,
        op7_decontamination,
        op8_quality_classifier,
        op9_warc,
        op10_lm_scoring,
        op11_fill_in_middle,
        op12_toxicity,
        op13_embedding_whitening,
    )
}
