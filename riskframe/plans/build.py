"""End-to-end build: clean -> feature matrix -> written table -> split -> tuned model ->
segments -> artifacts.  The written matrix is the lineage cut: every later step reads it
back from the shared folder instead of recomputing the joins."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features, models, prep, segments
from ..sources import io


def build_feature_matrix(tables: dict[str, DataFrame], check: bool = True) -> DataFrame:
    """Cleaned main table + features + history aggregates (checks are optional jobs)."""
    t = dict(tables)
    t["application_train"] = clean.clean_application(t["application_train"], check_unique=check)
    matrix = features.build_feature_matrix(t)
    if check:
        features.assert_no_row_explosion(t["application_train"], matrix)
    return matrix


def save_feature_matrix(tables: dict[str, DataFrame], root: str) -> str:
    """Write the matrix, computed once: its rows are counted while they are written, and a
    count other than that of the main table's keys raises."""
    clean.clean_application(tables["application_train"], check_unique=True)
    n_keys = tables["application_train"].select(features.ID).distinct().count()
    matrix, seen = features.watch_rows(build_feature_matrix(tables, check=False))
    path = io.save_parquet(matrix, root, "feature_matrix", stage="processed")
    features.check_row_count(n_keys, seen.get["rows"])
    return path


def build_all(spark: SparkSession, tables: dict[str, DataFrame], root: str, k: int | None = 4,
              tune: bool = True, n_init: int = 10, grid: dict | None = None) -> dict:
    """Run the whole build and write matrix, best model and segment bundle under ``root``."""
    save_feature_matrix(tables, root)
    matrix = io.load_processed(spark, root, "feature_matrix")
    train, _ = prep.train_test_split(matrix)
    if tune:
        best, params, score = models.tune_boosting(train, grid=grid)
    else:
        best = models.fit_all_models(train)["hist_gbdt"]
        params, score = {}, None
    io.save_model(best, root, "best_model")
    _, bundle, explained = segments.run_clustering(matrix, k=k, n_init=n_init)
    bundle.save(root)
    return {"best_params": params, "cv_average_precision": score,
            "clusters": bundle.kmeans.getK(), "pca_explained": explained}
