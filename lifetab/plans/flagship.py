"""The flagship query: labels x documents -> z-scored features -> class
weights -> stratified split -> logistic regression -> metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pipeline
    ensure_checkpoint_dir(spark)
    return pipeline.labels_documents_run(spark, sf_dir)
