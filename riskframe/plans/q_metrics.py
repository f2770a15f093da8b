"""Queries: evaluation of the two score columns of the event table (model-free)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from ..sources.fixtures import TableSet, scores_long
from .registry import register, rsql

V = ["scores_long"]


def _scores(spark, sf_dir):
    return scores_long(TableSet(spark, sf_dir))


_CONF = """
  CAST(sum(CASE WHEN label = 1 AND p >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN label = 0 AND p >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN label = 0 AND p < {t} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN label = 1 AND p < {t} THEN 1 ELSE 0 END) AS BIGINT) AS fn"""


def _r0(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_SCORES = (f"{_r0('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_r0('tp', 'tp + fp')} AS precision, "
           f"{_r0('tp', 'tp + fn')} AS recall, {_r0('2 * tp', '2 * tp + fp + fn')} AS f1")
THRESH_SQL = rsql(f"""
SELECT model, 0.5::DOUBLE AS threshold, tp, fp, tn, fn, {_SCORES}
FROM (SELECT model, {_CONF.format(t='0.5')} FROM scores_long GROUP BY model)""",
                  ["threshold", "accuracy", "precision", "recall", "f1"], views=V)


@register("threshold_metrics", THRESH_SQL)
def q_threshold_metrics(spark, sf_dir):
    """Confusion counts, accuracy, precision, recall, F1 at 0.5 per model."""
    return metrics.threshold_metrics(_scores(spark, sf_dir), "label", "p", 0.5, by=["model"])


@register("risk_classes", rsql("""
SELECT model, row_id, p, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS decision,
  CASE WHEN p < 0.10 THEN 'low' WHEN p < 0.25 THEN 'medium' ELSE 'high' END AS risk_class,
  CASE WHEN p < 0.10 THEN 'green' WHEN p < 0.25 THEN 'orange' ELSE 'red' END AS risk_color
FROM scores_long""", ["p"], views=V))
def q_risk_classes(spark, sf_dir):
    """Decision at 0.5 and risk class/colour for every scored row."""
    s = _scores(spark, sf_dir)
    cls, col = metrics.risk_class(F.col("p"))
    return s.select("model", "row_id", "p", metrics.decision(F.col("p"), 0.5).alias("decision"),
                    cls.alias("risk_class"), col.alias("risk_color"))


_CUM = [("agg_", "SELECT model, p AS score, sum(label) AS tp, count(*) AS n FROM scores_long "
                 "WHERE p IS NOT NULL GROUP BY model, p"),
        ("cum_", "SELECT *, sum(tp) OVER (PARTITION BY model ORDER BY score DESC) AS cum_tp, "
                 "sum(n) OVER (PARTITION BY model ORDER BY score DESC) AS cum_n, "
                 "sum(tp) OVER (PARTITION BY model) AS total_tp, sum(n) OVER (PARTITION BY model) AS total_n "
                 "FROM agg_")]
_RANK = """
SELECT model,
  CASE WHEN max(total_tp) > 0 THEN sum((tp::DOUBLE / total_tp::DOUBLE) * (cum_tp::DOUBLE / cum_n::DOUBLE)) END AS pr_auc,
  CASE WHEN max(total_tp) > 0 AND max(total_n) > max(total_tp)
       THEN sum((n - tp)::DOUBLE * (2.0 * cum_tp::DOUBLE - tp::DOUBLE))
            / (2.0 * max(total_tp)::DOUBLE * (max(total_n) - max(total_tp))::DOUBLE) END AS roc_auc
FROM cum_ GROUP BY model"""


@register("ranking_metrics", rsql(_RANK, ["pr_auc", "roc_auc"], views=V, ctes=_CUM))
def q_ranking_metrics(spark, sf_dir):
    """Exact average precision and ROC area per model (ties handled)."""
    return metrics.ranking_metrics(_scores(spark, sf_dir), "label", "p", by=["model"])


@register("roc_curve", rsql("""
SELECT model, score AS threshold, (cum_n - cum_tp)::DOUBLE / nullif((total_n - total_tp)::DOUBLE, 0) AS fpr,
  cum_tp::DOUBLE / nullif(total_tp::DOUBLE, 0) AS tpr FROM cum_
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cum_""",
                            ["threshold", "fpr", "tpr"], views=V, ctes=_CUM))
def q_roc_curve(spark, sf_dir):
    """ROC points per distinct score per model."""
    return metrics.roc_points(_scores(spark, sf_dir), "label", "p", by=["model"])


@register("pr_curve", rsql("""
SELECT model, score AS threshold, cum_tp::DOUBLE / cum_n::DOUBLE AS precision,
  cum_tp::DOUBLE / nullif(total_tp::DOUBLE, 0) AS recall FROM cum_
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM cum_""",
                           ["threshold", "precision", "recall"], views=V, ctes=_CUM))
def q_pr_curve(spark, sf_dir):
    """Precision-recall points per distinct score per model."""
    return metrics.pr_points(_scores(spark, sf_dir), "label", "p", by=["model"])


_PROBS = ", ".join(f"{i / 10}" for i in range(1, 10))
_BIN = " + ".join(f"CAST(s.p > e.q[{i}] AS INTEGER)" for i in range(1, 10))


@register("calibration", rsql(f"""
SELECT s.model, CAST({_BIN} AS INTEGER) AS bin, avg(s.p) AS mean_predicted,
  avg(s.label::DOUBLE) AS fraction_positive, count(*) AS n
FROM scores_long s JOIN edges_ e ON s.model = e.model WHERE s.p IS NOT NULL GROUP BY 1, 2""",
                              ["mean_predicted", "fraction_positive"], views=V,
                              ctes=[("edges_", f"SELECT model, quantile_cont(p, [{_PROBS}]) AS q "
                                               f"FROM scores_long GROUP BY model")]))
def q_calibration(spark, sf_dir):
    """10 quantile bins: mean predicted probability and observed positive rate per model."""
    return metrics.calibration_table(_scores(spark, sf_dir), "label", "p", 10, by=["model"])


def _sweep_sql():
    parts = []
    for t in metrics.SWEEP_THRESHOLDS:
        tp = f"sum(CASE WHEN p >= {t} AND label = 1 THEN 1 ELSE 0 END)"
        pp = f"sum(CASE WHEN p >= {t} THEN 1 ELSE 0 END)"
        pos = "sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)"
        parts.append(f"SELECT model, {t}::DOUBLE AS threshold, {_r0(tp, pp)} AS precision, "
                     f"{_r0(tp, pos)} AS recall, {_r0('2 * ' + tp, pp + ' + ' + pos)} AS f1, "
                     f"CAST({pp} AS BIGINT) AS predicted_positive FROM scores_long GROUP BY model")
    return " UNION ALL ".join(parts)


@register("threshold_sweep", rsql(_sweep_sql(), ["threshold", "precision", "recall", "f1"], views=V))
def q_threshold_sweep(spark, sf_dir):
    """Precision, recall, F1 and predicted positives at 0.5/0.3/0.2/0.15/0.1 per model."""
    return metrics.threshold_sweep(_scores(spark, sf_dir), "label", "p", by=["model"])


@register("model_comparison", rsql(f"""
SELECT t.model, t.threshold, t.accuracy, t.precision, t.recall, t.f1, r.pr_auc, r.roc_auc
FROM (SELECT model, 0.5::DOUBLE AS threshold, {_SCORES}
      FROM (SELECT model, {_CONF.format(t='0.5')} FROM scores_long GROUP BY model)) t
JOIN ({_RANK}) r ON t.model = r.model""",
                                   ["threshold", "accuracy", "precision", "recall", "f1", "pr_auc",
                                    "roc_auc"], views=V, ctes=_CUM))
def q_model_comparison(spark, sf_dir):
    """Per-model metrics table sorted by pr_auc."""
    return metrics.compare_models(_scores(spark, sf_dir), "model", "label", "p", 0.5)


def _report_sql():
    p1, r1, f1 = _r0("tp", "tp + fp"), _r0("tp", "tp + fn"), _r0("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = _r0("tn", "tn + fn"), _r0("tn", "tn + fp"), _r0("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fp + tn + fn)"
    w = lambda a, b: _r0(f"({a}) * (tn + fp) + ({b}) * (tp + fn)", n)
    return f"""
SELECT model, '0' AS row_label, {p0} AS precision, {r0} AS recall, {f0} AS f1_score, CAST(tn + fp AS BIGINT) AS support FROM c_
UNION ALL SELECT model, '1', {p1}, {r1}, {f1}, CAST(tp + fn AS BIGINT) FROM c_
UNION ALL SELECT model, 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {_r0('tp + tn', n)}, CAST({n} AS BIGINT) FROM c_
UNION ALL SELECT model, 'macro avg', ({p0} + {p1}) / 2, ({r0} + {r1}) / 2, ({f0} + {f1}) / 2, CAST({n} AS BIGINT) FROM c_
UNION ALL SELECT model, 'weighted avg', {w(p0, p1)}, {w(r0, r1)}, {w(f0, f1)}, CAST({n} AS BIGINT) FROM c_"""


@register("classification_report", rsql(
    _report_sql(), ["precision", "recall", "f1_score"], views=V,
    ctes=[("c_", f"SELECT model, {_CONF.format(t='0.5')} FROM scores_long GROUP BY model")]))
def q_classification_report(spark, sf_dir):
    """Per-class precision/recall/F1/support with accuracy and averages, per model."""
    return metrics.classification_report(_scores(spark, sf_dir), "label", "p", 0.5, by=["model"])
