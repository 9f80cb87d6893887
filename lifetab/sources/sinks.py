"""Sinks: processed tables, metrics, fitted models."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MODEL_PREFERENCE = ("best_model", "stacking_model", "model")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Processed table: Parquet by default, or CSV with a header."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_expression(expr: DataFrame, meta: DataFrame, path: str, name: str, fmt: str = "parquet") -> None:
    """Expression matrix and its sample metadata side by side."""
    write_table(expr, os.path.join(path, name), fmt)
    write_table(meta, os.path.join(path, f"{name}.metadata"), fmt)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long metrics table (split, metric, value) as JSON lines."""
    metrics.coalesce(1).write.mode(mode).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def save_model(model, path: str) -> None:
    """A Spark ML model, or a survival model, written anew."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str):
    """The model that ``save_model`` wrote."""
    from pyspark.ml import PipelineModel

    from ..operators.survival import load_survival
    if path_exists(SparkSession.getActiveSession(), f"{path}/survival"):
        return load_survival(path)
    return PipelineModel.load(path)


def load_preferred_model(results_dir: str, names: Sequence[str] = MODEL_PREFERENCE):
    """First existing model of ``best_model``, ``stacking_model``, ``model``."""
    spark = SparkSession.getActiveSession()
    for n in names:
        p = os.path.join(results_dir, n)
        if path_exists(spark, p):
            return load_model(p), n
    raise FileNotFoundError(f"no trained model under {results_dir} (looked for {list(names)})")
