"""Query of the quality classifier over ``documents``, learning from ``labels``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.llm.common import read_table
from playstats.llm.quality_classifier import document_features, fit_classifier, quality_scores

FOLDS = 5


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = document_features(read_table(spark, sf_dir, "documents"))
    labels = read_table(spark, sf_dir, "labels").where(~held_out()).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    scored = quality_scores(measured, fit_classifier(measured, labels)).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
