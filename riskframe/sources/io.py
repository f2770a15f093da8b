"""Staged sinks and model persistence.

Stages live under one root folder (``interim``, ``processed``, ``models``, ``tables``); on a
cluster the root is a shared file system path.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def stage_path(root: str, stage: str, name: str, ext: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{stage}/{name}.{ext}"


def save_parquet(df: DataFrame, root: str, name: str, stage: str = "interim") -> str:
    path = stage_path(root, stage, name)
    df.write.mode("overwrite").parquet(path)
    return path


def load_processed(spark: SparkSession, root: str, name: str, stage: str = "processed") -> DataFrame:
    """Parquet first, then a headed CSV, else FileNotFoundError."""
    for ext, reader in (("parquet", lambda p: spark.read.parquet(p)),
                        ("csv", lambda p: spark.read.option("header", True)
                                               .option("inferSchema", True).csv(p))):
        path = stage_path(root, stage, name, ext)
        try:
            df = reader(path)
            df.schema
            return df
        except AnalysisException:
            continue
    raise FileNotFoundError(stage_path(root, stage, name, "parquet|csv"))


def save_table(df: DataFrame, root: str, name: str, subdir: str | None = None) -> str:
    """Write a report table as one headed CSV file.

    Report tables are small by construction (one row per column, model, bin, cluster ...);
    ``coalesce(1)`` is only used for those, never for row-level data.
    """
    stage = f"tables/{subdir}" if subdir else "tables"
    path = stage_path(root, stage, name, "csv")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def save_model(model, root: str, name: str) -> str:
    path = stage_path(root, "models", name, "model")
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, cls=PipelineModel):
    return cls.load(stage_path(root, "models", name, "model"))


def artifacts_exist(spark: SparkSession, root: str,
                    models: tuple[str, ...] = ("best_model", "clustering")) -> tuple[bool, list[str]]:
    """Check the scoring artifacts; returns (all present, list of missing parts)."""
    missing = []
    for m in models:
        base = stage_path(root, "models", m, "model")
        found = False
        # a single Spark model has metadata/; a cluster bundle keeps it under kmeans/
        for meta in (f"{base}/metadata", f"{base}/kmeans/metadata"):
            try:
                spark.read.json(meta).schema
                found = True
                break
            except AnalysisException:
                continue
        if not found:
            missing.append(f"model {m}")
    try:
        load_processed(spark, root, "feature_matrix")
    except FileNotFoundError:
        missing.append("feature matrix")
    return not missing, missing
