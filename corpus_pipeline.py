"""A corpus pipeline over the operators of ``tabula.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and rereads as the next
stage's ``docs``. All but the last return the columns of documents.

Stages decide row by row: rows that share an id, null too, are judged by their own text each.
They drop none but those their operator rejects, and accept empty tables and further columns
(the last stage returns its own columns only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import byte_bpe, decontaminate, near_dedup, quality_cotrain, secret_scan
from tabula.llm.common import bounded_batches, read, without, workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_cotrain.accepted(docs, quality_cotrain.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    bounded_batches(spark)
    return without(docs, near_dedup.copies(docs), {"doc_id": F.col("doc_id").cast("long"), "text_md5": F.md5("text")})


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    texts = docs.select(F.md5("text").alias("doc_id"), "text")  # equal texts are judged once
    found = decontaminate.decontaminate(texts, read(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"), {"doc_id": F.md5("text")})


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and the length counted anew."""
    bounded_batches(spark)
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its token ids, their number, and whether decoding them gives the text back."""
    bounded_batches(spark)
    back = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    whole = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("byte_bpe", tokens),
]

#: A learned classifier has no SQL; the rows are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents and return the rows of the last."""
    docs, path = read(spark, sf_dir, "documents"), workspace(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}-{name}")
        docs = spark.read.parquet(f"{path}/{k}-{name}")
    return docs
