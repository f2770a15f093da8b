"""Prefix sums, exact quantiles and ranking metrics against brute force."""
import numpy as np
import pytest

from riskframe.functions.ordered import exact_quantiles, hash_rank, running_totals
from riskframe.operators import metrics


def brute_ap_auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    thresholds = np.unique(ps)[::-1]
    P = ys.sum()
    ap, prev_r = 0.0, 0.0
    for t in thresholds:
        sel = ps >= t
        tp = ys[sel].sum()
        r, prec = tp / P, tp / sel.sum()
        ap += (r - prev_r) * prec
        prev_r = r
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return ap, wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [0, 1])
def test_ranking_metrics_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 180
    p = np.round(rng.random(n), 1)          # heavy ties
    y = (rng.random(n) < 0.2 + 0.5 * p).astype(int)
    df = spark.createDataFrame([(int(a), float(b), "m") for a, b in zip(y, p)], "label int, p double, model string")
    r = metrics.ranking_metrics(df, "label", "p", by=["model"]).first()
    ap, auc = brute_ap_auc(y, p)
    assert r.pr_auc == pytest.approx(ap, abs=1e-12)
    assert r.roc_auc == pytest.approx(auc, abs=1e-12)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4)], "label int, p double")
    r = metrics.ranking_metrics(df).first()
    assert r.pr_auc is None and r.roc_auc is None


def test_running_totals_with_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v), 1) for g, v in zip(rng.integers(0, 3, 300), rng.normal(size=300))]
    df = spark.createDataFrame(rows, "g int, v double, one int")
    out = running_totals(df, ["v"], ["one"], by=["g"], n_buckets=5).collect()
    for g in range(3):
        vals = sorted(r[1] for r in rows if r[0] == g)
        got = sorted((r.v, r.cum_one) for r in out if r.g == g)
        assert [c for _, c in got] == list(range(1, len(vals) + 1))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=257) * 10, 0)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    q = exact_quantiles(df, "x", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0], n_buckets=6).first()
    expect = np.percentile(x, [0, 10, 25, 50, 75, 100])
    assert [q[f"q{i}"] for i in range(6)] == pytest.approx(list(expect), abs=1e-9)


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    ranks = sorted(r._rank for r in hash_rank(df, ["k"], 42).collect())
    assert ranks == list(range(1, 501))


def test_calibration_and_report(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.random(400), 2)
    y = (rng.random(400) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, p double")
    cal = sorted(metrics.calibration_table(df, n_bins=10).collect(), key=lambda r: r.bin)
    edges = np.percentile(p, np.linspace(0, 100, 11))
    ids = np.searchsorted(edges[1:-1], p)
    for r in cal:
        m = ids == r.bin
        assert r.n == m.sum()
        assert r.mean_predicted == pytest.approx(p[m].mean())
        assert r.fraction_positive == pytest.approx(y[m].mean())
    rep = {r.row_label: r for r in metrics.classification_report(df).collect()}
    yhat = (p >= 0.5).astype(int)
    tp = int(((y == 1) & (yhat == 1)).sum())
    assert rep["1"].precision == pytest.approx(tp / yhat.sum())
    assert rep["accuracy"].f1_score == pytest.approx((y == yhat).mean())
    sweep = {r.threshold: r for r in metrics.threshold_sweep(df).collect()}
    assert sweep[0.3].predicted_positive == int((p >= 0.3).sum())


def test_running_totals_join_path_matches_inline(spark, monkeypatch):
    import riskframe.functions.ordered as ordered
    rng = np.random.default_rng(11)
    rows = [(int(g), float(v), int(c)) for g, v, c in
            zip(rng.integers(0, 4, 200), np.round(rng.normal(size=200), 1), rng.integers(1, 5, 200))]
    df = spark.createDataFrame(rows, "g int, v double, c int")
    inline = {(r.g, r.v, r.c, r.cum_c) for r in
              ordered.running_totals(df, ["v", "c"], ["c"], by=["g"], n_buckets=4).collect()}
    monkeypatch.setattr(ordered, "_INLINE_GROUPS", 1)
    joined = {(r.g, r.v, r.c, r.cum_c) for r in
              ordered.running_totals(df, ["v", "c"], ["c"], by=["g"], n_buckets=4).collect()}
    assert inline == joined and len(inline) > 0


def test_chance_levels(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (0, "a"), (1, "b")], "label int, model string")
    got = {r.model: r.positive_rate for r in metrics.chance_levels(df, by=["model"]).collect()}
    assert got == {"a": pytest.approx(1 / 3), "b": 1.0}


def test_running_totals_keep_null_groups(spark):
    from pyspark.sql import functions as F
    from riskframe.functions.ordered import running_totals
    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("g"), F.lit(1).alias("v"))
    for buckets in (1, 4):
        got = running_totals(df, ["id"], ["v"], by=["g"], n_buckets=buckets)
        rows = {(r.g, r.id): (r.cum_v, r.total_v) for r in got.collect()}
        assert len(rows) == 100 and rows[(None, 90)] == (10, 10)


def test_pearson_keeps_no_rows(spark, monkeypatch):
    """Pair-complete correlations against numpy, from sums of one pass: no frame of products is kept."""
    from riskframe.operators import profile
    monkeypatch.setattr(profile, "reuse", lambda df: pytest.fail("rows kept"))
    rng = np.random.default_rng(8)
    x = rng.normal(1e6, 1, (300, 3))
    x[:, 1] += x[:, 0]
    x[::7, 1], x[::5, 2] = np.nan, np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (4, float("nan") if i == 9 else 1.0 * i) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same int, odd double").repartition(3)
    got = profile.pairwise_pearson(df, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"), ("a", "same"), ("a", "odd")])
    for (p, q), v in got.items():
        if {p, q} & {"same", "odd"}:
            assert v is None
            continue
        u, w = x[:, "abc".index(p)], x[:, "abc".index(q)]
        both = ~np.isnan(u) & ~np.isnan(w)
        assert v == pytest.approx(np.corrcoef(u[both], w[both])[0, 1], abs=1e-9)
