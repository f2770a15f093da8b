"""End-to-end build on the smallest driver tables: artifacts written and reloadable."""
import pytest
from pyspark.ml import PipelineModel

from riskframe.operators import features, score
from riskframe.operators.segments import ClusterBundle
from riskframe.plans import build
from riskframe.sources import fixtures, io

from .conftest import SF_SMALL


def test_build_all_writes_reloadable_artifacts(spark, tmp_root):
    tables = fixtures.credit_tables(fixtures.TableSet(spark, SF_SMALL))
    summary = build.build_all(spark, tables, tmp_root, k=3, tune=True, n_init=2,
                              grid={"max_iter": [3], "max_leaf_nodes": [4, 8]})
    assert summary["clusters"] == 3 and summary["best_params"]["max_iter"] == 3
    ok, missing = io.artifacts_exist(spark, tmp_root)
    assert ok, missing
    model = io.load_model(tmp_root, "best_model", PipelineModel)
    bundle = ClusterBundle.load(spark, tmp_root)
    matrix = io.load_processed(spark, tmp_root, "feature_matrix")
    report = score.scored_report(model, bundle, matrix).collect()
    assert len(report) == matrix.count()
    assert {r.risk_class for r in report} <= {"low", "medium", "high"}
    assert all(0 <= r.cluster < 3 for r in report)


def test_matrix_is_written_once_and_planted_duplicate_raises(spark, tmp_root, monkeypatch):
    tables = fixtures.credit_tables(fixtures.TableSet(spark, SF_SMALL))
    build.save_feature_matrix(tables, tmp_root)
    matrix = io.load_processed(spark, tmp_root, "feature_matrix")
    assert matrix.count() == tables["application_train"].count()
    with pytest.raises(AssertionError, match="row explosion"):
        features.assert_no_row_explosion(matrix, matrix.union(matrix.limit(1)))
    whole = build.build_feature_matrix
    monkeypatch.setattr(build, "build_feature_matrix", lambda t, check: whole(t, check).union(whole(t, check).limit(1)))
    with pytest.raises(AssertionError, match="row explosion"):
        build.save_feature_matrix(tables, tmp_root)
