"""Queries: models, segmentation, interpretation and scoring.

Model-dependent results have no SQL oracle (rows-only check); the data-only parts
(silhouette and profiles on given labels, standardised cluster inputs, what-if
overrides) do.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain, features, models, prep, score, segments
from ..session import keep
from ..sources.fixtures import TableSet
from .q_features import MATRIX_SCHEMA, feature_matrix_df, matrix_sql
from .registry import register, rsql

_FITTED: dict = {}


def _matrix(spark, sf_dir):
    """The feature matrix, computed once for all that reads it several times."""
    key = ("matrix", id(spark), sf_dir)
    if key not in _FITTED:
        _FITTED[key] = keep(feature_matrix_df(spark, sf_dir))
    return _FITTED[key]


def _split(spark, sf_dir):
    key = ("split", id(spark), sf_dir)
    if key not in _FITTED:
        train, test = prep.train_test_split(_matrix(spark, sf_dir), "TARGET", "SK_ID_CURR", 0.2, 42)
        _FITTED[key] = (train.persist(), test.persist())
    return _FITTED[key]


def _models(spark, sf_dir):
    key = ("models", id(spark), sf_dir)
    if key not in _FITTED:
        train, _ = _split(spark, sf_dir)
        _FITTED[key] = models.fit_all_models(train)
    return _FITTED[key]


def _segments(spark, sf_dir):
    key = ("segments", id(spark), sf_dir)
    if key not in _FITTED:
        m = _matrix(spark, sf_dir)
        _FITTED[key] = segments.run_clustering(m, "SK_ID_CURR", k=4, n_init=10)
    return _FITTED[key]


# ------------------------------------------------------------------ data-only (oracle)
_EMB = [("e_", "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"),
        ("d_", "SELECT a.vec_id, a.label AS la, b.label AS lb, list_distance(a.x, b.x) AS dist "
               "FROM e_ a JOIN e_ b ON a.vec_id <> b.vec_id"),
        ("m_", "SELECT vec_id, la, lb, avg(dist) AS md FROM d_ GROUP BY ALL"),
        ("s_", "SELECT e.vec_id, "
               "CASE WHEN count(CASE WHEN m.la = m.lb THEN 1 END) = 0 THEN 0.0 ELSE "
               "(min(CASE WHEN m.la <> m.lb THEN m.md END) - max(CASE WHEN m.la = m.lb THEN m.md END)) / "
               "greatest(min(CASE WHEN m.la <> m.lb THEN m.md END), max(CASE WHEN m.la = m.lb THEN m.md END)) END AS s "
               "FROM e_ e LEFT JOIN m_ m ON e.vec_id = m.vec_id GROUP BY e.vec_id")]


@register("silhouette_given_labels", rsql("SELECT avg(s) AS silhouette FROM s_", ["silhouette"],
                                          ctes=_EMB))
def q_silhouette(spark, sf_dir):
    """Exact Euclidean silhouette of the embedding table under its given labels, all pairs of rows."""
    return segments.silhouette_euclidean(TableSet(spark, sf_dir)["embeddings"], "embedding", "label", "vec_id")


_DIMS = 64


@register("label_profile", rsql(
    "SELECT label AS cluster, " + ", ".join(f"avg(embedding[{i + 1}]::DOUBLE) AS e{i}" for i in range(_DIMS))
    + ", count(*) AS cluster_size FROM embeddings GROUP BY label", [f"e{i}" for i in range(_DIMS)]))
def q_label_profile(spark, sf_dir):
    """Profile (mean of every dimension, and size) per given label of the embedding table."""
    emb = TableSet(spark, sf_dir)["embeddings"]
    flat = emb.select(F.col("label").alias("cluster"),
                      *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_DIMS)])
    return segments.profile_clusters(flat, [f"e{i}" for i in range(_DIMS)], "cluster")


_CF = segments.DEFAULT_CLUSTER_FEATURES


@register("cluster_inputs", matrix_sql(
    "SELECT SK_ID_CURR, " + ", ".join(
        f"(i_.{c} - avg(i_.{c}) OVER ()) / coalesce(nullif(stddev_pop(i_.{c}) OVER (), 0), 1) AS num__{c}"
        for c in _CF) + " FROM i_", [f"num__{c}" for c in _CF], extra=[
    ("med_", "SELECT " + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS {c}" for c in _CF)
     + " FROM feature_matrix"),
    ("i_", "SELECT f.SK_ID_CURR, " + ", ".join(f"coalesce(f.{c}::DOUBLE, med_.{c}) AS {c}" for c in _CF)
     + " FROM feature_matrix f, med_")]))
def q_cluster_inputs(spark, sf_dir):
    """Segmentation inputs after exact median imputation and population standardisation."""
    m = feature_matrix_df(spark, sf_dir)
    pre = segments.fit_cluster_preprocessor(m, segments.select_cluster_features(m))
    return pre.transform(m).select("SK_ID_CURR", *[f"num__{c}" for c in _CF])


_BOUNDS = score.EDITABLE_FEATURES


def _what_if_overrides(m):
    return m.where(F.col("NAME_INCOME_TYPE") == "BUILDING").select(
        "SK_ID_CURR", (F.col("AMT_CREDIT") * 2.0).alias("AMT_CREDIT"),
        (F.col("age_years") + 5.0).alias("age_years"))


def _clamp_sql(c, expr):
    lo, hi = _BOUNDS[c]
    return f"least(greatest(coalesce({expr}, {c}::DOUBLE, {lo}::DOUBLE), {lo}::DOUBLE), {hi}::DOUBLE)"


_GIVEN = {"AMT_CREDIT": "o.o_credit", "age_years": "o.o_age"}
_CLAMPED = {c: _clamp_sql(c, _GIVEN.get(c, "NULL")) for c in _BOUNDS}
_WHAT_IF_SQL = matrix_sql(
    "SELECT * EXCLUDE (o_id, o_credit, o_age) REPLACE ("
    + "".join(f"{sql} AS {c}, " for c, sql in _CLAMPED.items())
    + f"{_CLAMPED['AMT_CREDIT']} / greatest({_CLAMPED['AMT_INCOME_TOTAL']}, 1.0::DOUBLE) AS credit_income_ratio, "
    + f"{_CLAMPED['AMT_ANNUITY']} / greatest({_CLAMPED['AMT_INCOME_TOTAL']}, 1.0::DOUBLE) AS annuity_income_ratio) "
    + "FROM feature_matrix f JOIN (SELECT SK_ID_CURR AS o_id, AMT_CREDIT * 2.0 AS o_credit, "
    + "age_years + 5.0 AS o_age FROM feature_matrix WHERE NAME_INCOME_TYPE = 'BUILDING') o ON f.SK_ID_CURR = o.o_id",
    [c for c, t in MATRIX_SCHEMA if t == "double"])


@register("what_if", _WHAT_IF_SQL)
def q_what_if(spark, sf_dir):
    """Scenario: credit doubled and age +5 years for one segment, clamped to the form
    bounds, with the income ratios recomputed."""
    m = feature_matrix_df(spark, sf_dir)
    return score.apply_overrides(m, _what_if_overrides(m), "SK_ID_CURR", _BOUNDS, ratio_rule="app")


# ------------------------------------------------------------- model-dependent (rows)
@register("fitted_model_comparison")
def q_fitted_models(spark, sf_dir):
    """Baseline, logistic regression, forest and boosting fitted on the 80 % split and
    compared on the 20 % test split."""
    from ..operators.metrics import compare_models
    _, test = _split(spark, sf_dir)
    fitted = _models(spark, sf_dir)
    return compare_models(models.score_long(fitted, test), "model", "TARGET", "p", 0.5)


@register("cv_model_scores")
def q_cv(spark, sf_dir):
    """5-fold stratified CV (average precision) of the four models on the training split."""
    train, _ = _split(spark, sf_dir)
    return models.cross_validate_models(train, k=5)


@register("tuned_boosting")
def q_tuned(spark, sf_dir):
    """2 x 2 x 2 grid search of gradient boosting with 3-fold CV on the training split; best parameters."""
    train, _ = _split(spark, sf_dir)
    _, params, best = models.tune_boosting(train, k=3)
    return spark.createDataFrame([(params["max_iter"], params["learning_rate"], params["max_leaf_nodes"], best)],
                                 "max_iter int, learning_rate double, max_leaf_nodes int, cv_average_precision double")


@register("permutation_importance")
def q_permutation(spark, sf_dir):
    """Raw-column permutation importance (10 repeats) of the forest on the test split."""
    _, test = _split(spark, sf_dir)
    return explain.permutation_importance(_models(spark, sf_dir)["random_forest"], test, n_repeats=10)


@register("tree_importance")
def q_tree_importance(spark, sf_dir):
    """Impurity importance of the forest per encoded feature."""
    _, test = _split(spark, sf_dir)
    rf = _models(spark, sf_dir)["random_forest"]
    return explain.tree_feature_importance(rf, rf.transform(test))


@register("importance_plausibility")
def q_plausibility(spark, sf_dir):
    """Top-5 forest features by impurity importance, flagged when sensitive."""
    _, test = _split(spark, sf_dir)
    rf = _models(spark, sf_dir)["random_forest"]
    imp = explain.tree_feature_importance(rf, rf.transform(test))
    raw_cols = [c for c in test.columns if c not in ("SK_ID_CURR", "TARGET")]
    return explain.plausibility_check(explain.importance_by_raw_column(imp, raw_cols),
                                      score_col="importance")


@register("linear_contributions")
def q_linear_contrib(spark, sf_dir):
    """Additive log-odds contributions of the logistic model for every test row."""
    train, test = _split(spark, sf_dir)
    lr = _models(spark, sf_dir)["logreg"]
    return explain.linear_contributions(lr, train, test).select(
        "SK_ID_CURR", "base_value", "contributions")


@register("shapley_contributions")
def q_shapley(spark, sf_dir):
    """Monte-Carlo Shapley values of the forest on raw columns for every test row."""
    train, test = _split(spark, sf_dir)
    rf = _models(spark, sf_dir)["random_forest"]
    feats = [c for c in test.columns if c not in ("SK_ID_CURR", "TARGET")]
    return explain.shapley_sampling(rf, train, test, feats, n_permutations=4)


@register("kmeans_k_scan")
def q_k_scan(spark, sf_dir):
    """Inertia and silhouette of all rows for k = 2..8, best of 10 starts."""
    m = _matrix(spark, sf_dir)
    pre = segments.fit_cluster_preprocessor(m, segments.select_cluster_features(m))
    return segments.find_optimal_k(pre.transform(m).persist(), "SK_ID_CURR", range(2, 9), n_init=10)


@register("segment_profiles")
def q_segment_profiles(spark, sf_dir):
    """k = 4 segments: feature means, size and label rate per cluster."""
    _, bundle, _ = _segments(spark, sf_dir)
    return bundle.profiles


@register("pca_projection")
def q_pca(spark, sf_dir):
    """2-D PCA coordinates of every entity with its segment and explained variance."""
    labelled, _, explained = _segments(spark, sf_dir)
    coords, var = segments.pca_2d(labelled)
    return coords.select("SK_ID_CURR", "cluster", "pc1", "pc2",
                         F.lit(float(sum(var))).alias("explained_variance"))


@register("scored_report")
def q_scored_report(spark, sf_dir):
    """Every entity: probability (forest), decision, risk class, segment and its profile."""
    m = _matrix(spark, sf_dir)
    _, bundle, _ = _segments(spark, sf_dir)
    return score.scored_report(_models(spark, sf_dir)["random_forest"], bundle, m)


@register("leakage_review")
def q_leakage(spark, sf_dir):
    """Sensitive/proxy columns and label-named columns of the matrix."""
    return features.leakage_and_ethics_review(feature_matrix_df(spark, sf_dir))
