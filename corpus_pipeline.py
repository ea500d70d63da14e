"""From raw documents to token ids: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``.  ``run`` writes each stage's rows as Parquet in the
shared folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import decontaminate, quality_classifier, secret_scan, sentencepiece_codec, simhash_dedup
from framewright.storage import intermediates, materialize, ship_package, table

#: Near duplicates resemble by 0.8 in their shingles of this many words.
SHINGLE_WORDS = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose learned quality reaches the threshold.  Null and empty texts are scored like any
    other; repeated rows stay or go together; without labels all stay; a column ``score`` stays the user's."""
    ship_package(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id, nulls last.  Different
    texts of one id (null too) are judged apart; texts without a word form one group; of repeated rows one stays."""
    ship_package(spark)
    return simhash_dedup.drop_near(docs, SHINGLE_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other values.  Null and empty texts stay; other
    texts of a leaking document's id (null too) stay; an empty benchmark drops nothing."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and n_chars counted anew (null for null texts)."""
    ship_package(spark)
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, digest of the decoded text, checksum of the spans, a row
    for each row; null texts count as empty."""
    ship_package(spark)
    return sentencepiece_codec.code_digests(docs, sentencepiece_codec.model_file())


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]

#: No SQL gives the rows of learned scores, fingerprints and merged pieces; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with intermediates(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            made.keep(docs)
    return docs
