"""Splits, folds, preprocessing, models, segmentation and interpretation (properties)."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import explain, metrics, models, prep, segments
from riskframe.plans import checks


def signal_frame(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    cat = rng.choice(["a", "b", "c"], size=n)
    y = (x1 + 0.5 * (cat == "a") + rng.normal(scale=0.5, size=n) > 1.0).astype(int)
    rows = [(i, int(y[i]), float(x1[i]) if i % 17 else None, float(x2[i]), str(cat[i]))
            for i in range(n)]
    return spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x1 double, x2 double, cat string")


def test_split_counts_and_folds(spark):
    df = signal_frame(spark, 403)
    counts = dict(prep.class_counts(df, "TARGET"))
    s = prep.stratified_split(df, "TARGET", "SK_ID_CURR", 0.2, 42)
    got = {(r.TARGET, r.is_test): r["count"] for r in s.groupBy("TARGET", "is_test").count().collect()}
    alloc = prep.split_allocation([counts[0], counts[1]], 0.2)
    assert got[(0, True)] == alloc[0] and got[(1, True)] == alloc[1]
    assert sum(alloc) == int(np.ceil(0.2 * 403))
    f = prep.stratified_folds(df, 5, "TARGET", "SK_ID_CURR", 42)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sum(sizes) == 403 and max(sizes) - min(sizes) <= 1
    assert f.select("SK_ID_CURR").distinct().count() == 403


def test_preprocessor_median_mode_unknown(spark):
    df = signal_frame(spark)
    pre = prep.build_preprocessor(["x1", "x2"], ["cat"], scale_numeric=True).fit(df)
    out = pre.transform(df)
    med = float(np.median([r.x1 for r in df.collect() if r.x1 is not None]))
    sql_stmt = pre.stages[0].getStatement()
    assert repr(med) in sql_stmt                                   # exact median imputed
    z = np.array([r.num__x2 for r in out.collect()])
    assert z.mean() == pytest.approx(0, abs=1e-9) and z.std() == pytest.approx(1, abs=1e-9)
    unseen = spark.createDataFrame([(9999, 0, 0.0, 0.0, "zzz")], df.schema)
    vec = pre.transform(unseen).first()["features"].toArray()
    assert vec[2:].sum() == 0                                      # unknown -> zero one-hot
    assert len(prep.feature_names(out)) == 2 + 3


def test_models_beat_baseline_and_cv(spark):
    df = signal_frame(spark, 500)
    train, test = prep.train_test_split(df, "TARGET", "SK_ID_CURR", 0.3, 1)
    specs = [s for s in models.model_specs(350) if s.name in ("dummy", "logreg", "random_forest")]
    specs[2].classifier.setNumTrees(20)
    fitted = models.fit_all_models(train, specs)
    cmp = {r.model: r for r in metrics.compare_models(
        models.score_long(fitted, test), "model", "TARGET", "p").collect()}
    assert cmp["logreg"].pr_auc > cmp["dummy"].pr_auc + 0.2
    assert cmp["random_forest"].pr_auc > cmp["dummy"].pr_auc
    cv = {r.model: r for r in models.cross_validate_models(train, specs[:2], k=3, parallelism=1).collect()}
    assert 0 <= cv["logreg"].cv_std < 0.2 and cv["logreg"].cv_mean > 0.5


def test_permutation_of_unused_column_is_zero(spark):
    df = signal_frame(spark, 300).withColumn("noise", F.lit(1.0))
    train, test = prep.train_test_split(df, "TARGET", "SK_ID_CURR", 0.3, 2)
    lr = models.fit_all_models(train, [s for s in models.model_specs(210) if s.name == "logreg"])["logreg"]
    imp = {r.feature: r for r in explain.permutation_importance(lr, test, ["x1", "noise"], n_repeats=3).collect()}
    assert imp["noise"].importance_mean == 0.0 and imp["noise"].importance_std == 0.0
    assert imp["x1"].importance_mean > 0.05
    contrib = explain.linear_contributions(lr, train, test).collect()
    clf = lr.stages[-1]
    x = lr.stages[0].transform(test).collect()
    for row, xr in zip(sorted(contrib, key=lambda r: r.SK_ID_CURR), sorted(x, key=lambda r: r.SK_ID_CURR)):
        margin = float(clf.intercept + clf.coefficients.dot(xr.features))
        assert sum(row.contributions) + row.base_value == pytest.approx(margin, abs=1e-9)


def test_silhouette_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.normal(0, 1, (30, 3)), rng.normal(4, 1, (25, 3)), rng.normal([0, 5, 0], 1, (1, 3))])
    lab = np.array([0] * 30 + [1] * 25 + [2])
    df = spark.createDataFrame([(i, int(lab[i]), [float(v) for v in pts[i]]) for i in range(len(lab))],
                               "k long, label int, x array<double>")
    got = segments.silhouette_euclidean_sample(df, "x", "label", "k", max_sample=1000)
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    s = []
    for i in range(len(lab)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(float(np.mean(s)), abs=1e-12)


def test_pairwise_silhouette_matches_brute_force(spark, monkeypatch):
    """Several groups and cells, near copies, a repeated key, a cluster of one row, rows without label or features."""
    monkeypatch.setattr(segments, "GROUP_ROWS", 20)
    rng = np.random.default_rng(6)
    pts = np.vstack([rng.normal(100, 1, (40, 3)), rng.normal(103, 1, (30, 3)), [[100, 105, 100]]])
    pts[1] = pts[0]
    lab, ids = np.array([5] * 40 + [2] * 30 + [9]), list(range(71))
    rows = [(i, int(c), p.tolist()) for i, c, p in zip(ids, lab, pts)]
    s = []
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    for i in ids:
        own = lab == lab[i]
        a, b = d[i, own].sum() / max(own.sum() - 1, 1), min(d[i, lab == c].mean() for c in {2, 5, 9} - {lab[i]})
        s.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
    df = spark.createDataFrame([*rows, (900, None, [0.0, 0.0, 0.0]), (901, 2, None)], "k long, label int, x array<double>")
    got = segments.silhouette_euclidean(df, "x", "label", "k").first()[0]
    assert got == pytest.approx(float(sum(s)) / 72, abs=1e-12)          # a row without a label scores 0
    two = spark.createDataFrame([*rows, rows[0]], df.schema)            # a key's rows are not compared
    alone = spark.createDataFrame(rows[:1] * 2 + rows[40:41], df.schema)
    assert segments.silhouette_euclidean(alone, "x", "label", "k").first()[0] == 0.0
    assert segments.silhouette_euclidean(two, "x", "label", "k").first()[0] != pytest.approx(got, abs=1e-12)
    assert segments.silhouette_euclidean(df.where("label = 5"), "x", "label", "k").first()[0] is None


def test_silhouette_of_all_rows_matches_brute_force(spark):
    """More rows than any sample, a cluster of one row, rows without label or features."""
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(1000, 1, (5000, 2)), rng.normal(1004, 1, (4000, 2)), rng.normal([1000, 1009], 1, (1, 2))])
    lab = np.array([3] * 5000 + [1] * 4000 + [7])
    rows = [(int(c), p.tolist()) for c, p in zip(lab, pts)] + [(None, [0.0, 0.0]), (1, None), (1, [0.0, None])]
    df = spark.createDataFrame(rows, "label int, x array<double>").repartition(3)
    s = np.zeros(len(pts))
    for i in range(0, len(pts), 500):
        d = ((pts[i:i + 500, None] - pts[None]) ** 2).sum(2)
        sums = np.stack([d[:, lab == c].sum(1) for c in (1, 3, 7)], 1)
        n = np.array([4000, 5000, 1])
        own = np.searchsorted([1, 3, 7], lab[i:i + 500])
        at = np.arange(len(own))
        a = sums[at, own] / np.maximum(n[own] - 1, 1)
        mean = sums / n
        mean[at, own] = np.inf
        b = mean.min(1)
        s[i:i + 500] = np.where(n[own] > 1, (b - a) / np.maximum(a, b), 0)
    assert segments.silhouette(df, "x", "label") == pytest.approx(float(s.mean()), abs=1e-9)
    assert segments.silhouette(df.limit(0), "x", "label") is None
    assert segments.silhouette(df.where("label = 7"), "x", "label") == 0.0
    flat = df.select("label", *[F.col("x")[i].alias(f"x{i}") for i in range(2)])
    assert segments.silhouette(flat, ["x0", "x1"], "label") == pytest.approx(float(s.mean()), abs=1e-9)


def test_kmeans_starts_in_one_run(spark):
    df = signal_frame(spark, 300)
    x = segments.fit_cluster_preprocessor(df, ["x1", "x2"]).transform(df).repartition(3).persist()
    from riskframe.operators.design import blocks
    of = blocks(x.select(segments.vector_to_array("features").alias("x")), segments._points)
    starts = segments._starts(of, 3, [2, 3], 3, 42)
    first = [f.centres.copy() for f in starts]
    together = segments.lloyd(of, 3, starts)
    pts = np.array([r.features.toArray() for r in x.collect()])
    for c, f in zip(first, together):                                   # each fit alone, from the same start
        for _ in range(300):
            own = ((pts[:, None] - c[None]) ** 2).sum(2).argmin(1)
            new = np.stack([pts[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
            if (((new - c) ** 2).sum(1) <= 1e-8).all():
                break
            c = new
        assert f.done and f.cost == pytest.approx(((pts[:, None] - c[None]) ** 2).sum(2).min(1).sum()) and len(c) == f.k
    from pyspark.ml.clustering import KMeans
    sparks = min(KMeans(k=3, seed=s, maxIter=300, featuresCol="features").fit(x).summary.trainingCost for s in range(3))
    model = segments.fit_kmeans(x, 3, n_init=5)
    assert segments.fit_centres(x, [3], 5)[0].cost <= sparks * 1.02
    prof = segments.profile_clusters(model.transform(x), ["x1", "x2"])
    assert sum(r.cluster_size for r in prof.collect()) == 300
    same = spark.createDataFrame([(i, 0, 1.0, 1.0, "a") for i in range(5)], df.schema)
    y = segments.fit_cluster_preprocessor(same, ["x1", "x2"]).transform(same)
    assert segments.fit_centres(y, [3], 2)[0].cost == 0.0               # fewer different rows than k
    scan = segments.find_optimal_k(x, "SK_ID_CURR", [2, 3], n_init=2, euclidean_sample=100).collect()
    assert [r.k for r in scan] == [2, 3] and scan[0].inertia > scan[1].inertia and all(0 < r.silhouette < 1 for r in scan)
    with pytest.raises(ValueError):
        segments.select_cluster_features(df, ["x1", "TARGET"])


def test_kmeans_passes_follow_the_rows(spark, monkeypatch):
    """A pass has as many tasks as the rows need or two a core, not as there are partitions."""
    x = segments.fit_cluster_preprocessor(signal_frame(spark, 300), ["x1", "x2"]).transform(signal_frame(spark, 300)).repartition(40)
    seen, blocks = [], segments.blocks
    monkeypatch.setattr(segments, "blocks", lambda rows, read: seen.append(blocks(rows, read)) or seen[-1])
    segments.find_optimal_k(x, "SK_ID_CURR", [2], n_init=2)
    assert len(seen) == 2 and all(of.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism for of in seen)


def test_plan_checks(spark):
    a = spark.range(10)
    assert any("pair join" in p for p in checks.plan_problems(a.crossJoin(spark.range(3))))
    assert checks.plan_problems(a.groupBy((F.col("id") % 2).alias("g")).count()) == []


def test_permutation_importance_against_brute_force(spark):
    """The same numbers as permuting collected rows by hand, for numbers, texts and missing values."""
    df = signal_frame(spark, 120)
    spec = next(x for x in models.model_specs(100) if x.name == "logreg")
    model = models.fit_all_models(df, [spec])["logreg"]
    feats, repeats, seed = ["x1", "cat", "x2"], 3, 4
    got = {r.feature: r for r in explain.permutation_importance(model, df, feats, repeats, seed, chunk=2).collect()}
    rows = [r.asDict() for r in explain.hash_rank(df, ["SK_ID_CURR"], seed).orderBy("_rank").select(*df.columns).collect()]
    n = len(rows)
    params = explain._affine_params(n, len(feats) * repeats, seed)
    frames = []
    for j, f in enumerate(feats):
        for r in range(repeats):
            a, b = params[j * repeats + r]
            frames += [tuple({**row, f: rows[(a * i + b) % n][f]}[c] for c in df.columns) + (j, r) for i, row in enumerate(rows)]
    variants = spark.createDataFrame(frames, "SK_ID_CURR long, TARGET int, x1 double, x2 double, cat string, j int, r int")
    base = explain._ap(model.transform(df)).first()["pr_auc"]
    drops = {}
    for x in explain._ap(model.transform(variants), ["j", "r"]).collect():
        drops.setdefault(feats[x.j], []).append(base - x.pr_auc)
    assert set(got) == set(feats)
    for f, d in drops.items():
        assert got[f].importance_mean == pytest.approx(np.mean(d), abs=1e-12)
        assert got[f].importance_std == pytest.approx(np.std(d), abs=1e-12)


def test_variants_are_scored_on_all_cores(spark):
    """Rows unfold into many variants: tasks are counted by these, not by the bytes of the rows."""
    from riskframe.operators import explain
    df = spark.range(60).selectExpr("id SK_ID_CURR", "cast(id % 3 = 0 as int) TARGET", "id % 7 / 7d a", "cast(id % 5 as string) b").coalesce(1).persist()
    tasks = []

    class Model:
        def transform(self, rows):
            tasks.append(rows.rdd.getNumPartitions())
            return rows.withColumn("p", F.col("a") / 2 + F.when(F.col("b") == "1", 0.25).otherwise(0.0))
    explain.permutation_importance(Model(), df, ["a", "b"], n_repeats=2).collect()
    got = explain.shapley_sampling(Model(), df, df, ["a", "b"], n_permutations=3).groupBy("SK_ID_CURR").count().collect()
    assert tasks[0] == 1 and min(tasks[1:]) >= spark.sparkContext.defaultParallelism and len(tasks) == 3
    assert len(got) == 60 and {r["count"] for r in got} == {2}
