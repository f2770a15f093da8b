"""Preparation for models: splits, folds, class weights, and the column preprocessor.

Split, subsample and fold assignment are exact per class and deterministic: a class's rows
are taken in the order of a seeded hash of the key, up to a hash that ``functions.hash_cut``
finds by counting (wide rows are compared with it where they are, no sort and no exchange),
and the per-class counts follow the reference's rounding rule on the small class-count
table.  Row membership is a different draw than the reference's random generator; the counts
agree.  A key is expected once: rows of one key lie on one side.

The preprocessor is an Estimator whose fitted form is a ``PipelineModel`` of built-in
stages only (a generated ``SQLTransformer`` with the learned medians/means/scales/modes,
``StringIndexer``, ``OneHotEncoder``, ``VectorAssembler``), so it saves and loads like any
Spark model and runs fully on the JVM.
"""
from __future__ import annotations

import math
from itertools import accumulate

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hash_cut import hash_cuts, hash_order
from ..functions.nulls import flag
from ..functions.ordered import exact_quantiles

ID, TARGET = "SK_ID_CURR", "TARGET"
NON_FEATURE_COLUMNS = [ID, TARGET]
TEST_SIZE, RANDOM_STATE = 0.2, 42
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)
CATEGORICAL_TYPES = (T.StringType, T.BooleanType)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def split_features_target(df: DataFrame, target: str = TARGET, id_col: str = ID):
    """(features without id and label, label as int with the id)."""
    drop = [c for c in (id_col, target) if c in df.columns]
    x = df.drop(*drop)
    y = df.select(*([id_col] if id_col in df.columns else []), F.col(target).cast("int").alias(target))
    return x, y


def identify_feature_types(df: DataFrame, exclude=(ID, TARGET)) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names from the schema; other types are dropped."""
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]
    cat = [f.name for f in df.schema.fields
           if isinstance(f.dataType, CATEGORICAL_TYPES) and f.name not in exclude]
    return num, cat


# ------------------------------------------------------------------------ class counts
def _approximate_mode(counts: list[int], n_draws: int) -> list[int]:
    """Allocate ``n_draws`` over classes proportionally: floor, then the largest
    remainders get one more (ties go to the earlier class)."""
    total = sum(counts)
    cont = [n_draws * c / total for c in counts]
    alloc = [math.floor(x) for x in cont]
    need = n_draws - sum(alloc)
    order = sorted(range(len(counts)), key=lambda i: (-(cont[i] - alloc[i]), i))
    for i in order[:need]:
        alloc[i] += 1
    return alloc


def class_counts(df: DataFrame, label: str) -> list[tuple]:
    """[(class, n)] sorted by class; bounded by the number of classes."""
    rows = df.groupBy(label).count().collect()
    return sorted(((r[label], r["count"]) for r in rows), key=lambda t: (t[0] is None, t[0]))


def split_allocation(counts: list[int], test_size: float | int) -> list[int]:
    """Per-class test counts: train part allocated first, test from the remainder."""
    n = sum(counts)
    n_test = test_size if isinstance(test_size, int) else math.ceil(test_size * n)
    n_train = n - n_test
    train = _approximate_mode(counts, n_train)
    rest = [c - t for c, t in zip(counts, train)]
    return _approximate_mode(rest, n_test)


def _by_class(label: str, values: dict) -> Column:
    expr = None if values else F.lit(None)
    for k, v in values.items():
        cond = _q(label).eqNullSafe(F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def stratified_split(df: DataFrame, label: str = TARGET, key: str = ID,
                     test_size: float | int = TEST_SIZE, seed: int = RANDOM_STATE) -> DataFrame:
    """Add boolean ``is_test``: exact per-class test counts, hash-ordered within class."""
    def ranks(cc):
        return {c: [t] for (c, _), t in zip(cc, split_allocation([n for _, n in cc], test_size))}
    cuts = hash_cuts(df, key, seed, label, ranks)
    bound = _by_class(label, {c: b for c, (b,) in cuts.items()})
    return df.withColumn("is_test", hash_order(key, seed) < bound)


def train_test_split(df: DataFrame, label: str = TARGET, key: str = ID,
                     test_size: float | int = TEST_SIZE, seed: int = RANDOM_STATE):
    s = stratified_split(df, label, key, test_size, seed)
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")


def stratified_subsample(df: DataFrame, max_rows: int, label: str = TARGET, key: str = ID,
                         seed: int = RANDOM_STATE) -> DataFrame:
    """At most ``max_rows`` rows with the class shares kept (no-op when smaller)."""
    n = df.count()
    if n <= max_rows:
        return df
    return stratified_split(df, label, key, int(max_rows), seed).where("is_test").drop("is_test")


def fold_allocation(counts: list[int], k: int) -> list[list[int]]:
    """Per fold and class: occurrences of the class among positions i, i+k, ... of the
    label-sorted order (the reference's stratified k-fold rule)."""
    out, start = [], 0
    bounds = []
    for c in counts:
        bounds.append((start, start + c))
        start += c
    for i in range(k):
        row = []
        for lo, hi in bounds:
            first = lo + ((i - lo) % k)
            row.append(0 if first >= hi else (hi - 1 - first) // k + 1)
        out.append(row)
    return out


def stratified_folds(df: DataFrame, k: int = 5, label: str = TARGET, key: str = ID,
                     seed: int = RANDOM_STATE, fold_col: str = "fold") -> DataFrame:
    """Integer fold column 0..k-1 with the stratified per-class fold sizes."""
    def ranks(cc):
        sizes = zip(*fold_allocation([n for _, n in cc], k))
        return {c: list(accumulate(per_fold))[:-1] for (c, _), per_fold in zip(cc, sizes)}
    cuts = hash_cuts(df, key, seed + 1, label, ranks)
    h, fold = hash_order(key, seed + 1), F.lit(0)
    for i in range(k - 1):                                    # folds behind the row's hash
        fold = fold + flag(h >= _by_class(label, {c: b[i] for c, b in cuts.items()}))
    return df.withColumn(fold_col, fold.cast("int"))


def with_class_weights(df: DataFrame, label: str = TARGET, weight_col: str = "weight") -> DataFrame:
    """Balanced weights w_c = n / (classes * n_c) from the small class-count table."""
    cc = class_counts(df, label)
    n, kk = sum(c for _, c in cc), len(cc)
    return df.withColumn(weight_col, _by_class(label, {cls: n / (kk * c) for cls, c in cc}).cast("double"))


def class_weight_table(df: DataFrame, label: str = TARGET) -> DataFrame:
    """(label, n, weight) with weight = n_total / (classes * n_c); one aggregation."""
    from pyspark.sql import Window
    c = df.groupBy(_q(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return c.withColumn("weight", F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))


# ------------------------------------------------------------------ column statistics
def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact (interpolated) median per column; None for an all-missing column."""
    long = df.select(*[_q(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "value")
    rows = exact_quantiles(long, "value", [0.5], by=["column_name"], names=["median"]).collect()
    got = {r["column_name"]: r["median"] for r in rows}
    return {c: got.get(c) for c in cols}


def column_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, mode): most frequent non-null value, the smallest one on ties.

    Value counts are one map-side-combined aggregation; the pick is a ``min`` over
    (-count, value), also combinable, so no column's values are gathered in one place.
    """
    long = df.select(*[_q(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column_name").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("b"))
    return best.select("column_name", F.col("b.value").alias("mode"))


def population_scales(df: DataFrame, exprs: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population std (0 -> 1) of each expression; one aggregation job."""
    row = df.agg(*[F.avg(e).alias(f"m_{i}") for i, e in enumerate(exprs.values())],
                 *[F.stddev_pop(e).alias(f"s_{i}") for i, e in enumerate(exprs.values())]).first()
    out = {}
    for i, name in enumerate(exprs):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        out[name] = (float(m or 0.0), float(s) if s else 1.0)
    return out


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std, std 0 -> 1; statistics from one aggregation."""
    sc = population_scales(df, {c: _q(c).cast("double") for c in cols})
    return df.select(*[_q(c) for c in df.columns if c not in cols or suffix],
                     *[((_q(c).cast("double") - F.lit(sc[c][0])) / F.lit(sc[c][1])).alias(c + suffix)
                       for c in cols])


def one_hot_columns(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """0/1 column per category of ``col`` (sorted); unknown/missing -> all zeros."""
    cats = sorted(r[0] for r in df.select(col).where(_q(col).isNotNull()).distinct().collect())
    p = prefix or col
    return df.select(*[_q(c) for c in df.columns],
                     *[flag(_q(col) == F.lit(v)).alias(f"{p}_{v}") for v in cats])


# ------------------------------------------------------------------------ preprocessor
def _lit_sql(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _str_sql(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class TabularPreprocessor(Estimator):
    """Numeric: exact median imputation (+ population standardisation); categorical:
    most-frequent imputation + sorted one-hot with unknown -> zero vector; everything
    else dropped.  ``fit`` returns a ``PipelineModel`` of built-in stages.

    ``fit_statistics`` and ``model_from_statistics`` split the work, so that the scaled
    and the unscaled variant of one training set share a single statistics pass.
    """

    def __init__(self, numeric: list[str], categorical: list[str], scale_numeric: bool = True,
                 output_col: str = "features"):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.scale_numeric, self.output_col = scale_numeric, output_col

    def fit_statistics(self, dataset: DataFrame, with_scales: bool = True) -> dict:
        medians = exact_medians(dataset, self.numeric) if self.numeric else {}
        kept = [c for c in self.numeric if medians.get(c) is not None]  # all-missing dropped
        scales = {}
        if kept and with_scales:
            scales = population_scales(dataset, {c: F.coalesce(_q(c).cast("double"), F.lit(medians[c]))
                                                 for c in kept})
        stats = {"medians": medians, "kept": kept, "scales": scales, "cats": [], "modes": {},
                 "indexer": None, "encoder": None}
        if self.categorical:
            modes = {r["column_name"]: r["mode"] for r in column_modes(dataset, self.categorical).collect()}
            cats = [c for c in self.categorical if modes.get(c) is not None]
            stats.update(cats=cats, modes=modes)
            if cats:
                filled = SQLTransformer(statement=self._fill_sql(stats, False)).transform(dataset)
                idx = StringIndexer(inputCols=[f"cat__{c}" for c in cats],
                                    outputCols=[f"idx__{c}" for c in cats],
                                    handleInvalid="keep", stringOrderType="alphabetAsc").fit(filled)
                # the indexer's "unknown" bucket is its last label; dropLast removes it, so an
                # unseen category becomes the all-zero vector and every known one keeps a slot
                ohe = OneHotEncoder(inputCols=[f"idx__{c}" for c in cats],
                                    outputCols=[f"ohe__{c}" for c in cats],
                                    dropLast=True).fit(idx.transform(filled))
                stats.update(indexer=idx, encoder=ohe)
        return stats

    @staticmethod
    def _fill_sql(stats: dict, scale: bool) -> str:
        selects = []
        for c in stats["kept"]:
            e = f"coalesce(CAST(`{c}` AS DOUBLE), {_lit_sql(stats['medians'][c])})"
            if scale:
                m, s = stats["scales"][c]
                e = f"(({e}) - {_lit_sql(m)}) / {_lit_sql(s)}"
            selects.append(f"{e} AS `num__{c}`")
        for c in stats["cats"]:
            selects.append(f"coalesce(CAST(`{c}` AS STRING), {_str_sql(stats['modes'][c])}) AS `cat__{c}`")
        return f"SELECT *{', ' if selects else ''}{', '.join(selects)} FROM __THIS__"

    def model_from_statistics(self, stats: dict, scale: bool | None = None) -> PipelineModel:
        scale = self.scale_numeric if scale is None else scale
        stages = [SQLTransformer(statement=self._fill_sql(stats, scale))]
        if stats["indexer"] is not None:
            stages += [stats["indexer"], stats["encoder"]]
        cols = [f"num__{c}" for c in stats["kept"]] + \
            ([f"ohe__{c}" for c in stats["cats"]] if stats["indexer"] is not None else [])
        stages.append(VectorAssembler(inputCols=cols, outputCol=self.output_col))
        return PipelineModel(stages)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self.model_from_statistics(self.fit_statistics(dataset, self.scale_numeric))


def build_preprocessor(numeric: list[str], categorical: list[str],
                       scale_numeric: bool = True) -> TabularPreprocessor:
    return TabularPreprocessor(numeric, categorical, scale_numeric)


def feature_names(transformed: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the assembled vector's slots, from the column's ML attribute metadata."""
    meta = transformed.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = []
    for group in attrs.values():
        slots.extend((a["idx"], a["name"]) for a in group)
    if slots:
        return [n for _, n in sorted(slots)]
    return [f"f{i}" for i in range(meta.get("num_attrs", 0))]
