"""Hierarchical language identification: the family first, then linear support vector
machines, one against one, among the languages of that family.

Features: counts of byte 1- to 3-grams of the text (A-Z lowered, anything else in ASCII a
blank), hashed into ``DIM`` cells, square roots, unit length.  Families are found from the
mean features of each language by joining the most alike until about the square root of
the number of languages are left; families are told apart one against one, too.

Learning takes at most ``per_language`` different labelled texts of each language, those of
least hash (the bound is a parameter), so a language with labelled rows is always learned,
and copies of a text count once.  The machines are Spark ML's ``LinearSVC``.  Prediction is one map over all rows with
the weights broadcast (DIM x machines numbers).

Cases: null text or text without a letter is ``und`` with score 0; without any labelled
document all others are ``und`` too; with one language every text with letters gets it, with
score 1; equal texts get equal results; ties of votes go to the greater margin, then to the
first name; empty tables give empty results; input columns named like a result column are
replaced by it; other columns pass through.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged, utf8_column, without

DIM = 2048
PER_LANGUAGE = 600
MAX_ITER = 25
#: Parts of a language's hashes that are ranked apart before they meet.
PARTS = 64
RESULTS = ("lang_pred", "score")


def _fold() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


_FOLD = _fold()


def features(raw: np.ndarray, off: np.ndarray, dim: int = DIM) -> np.ndarray:
    """One row of features per text."""
    s = _FOLD[raw].astype(np.int64)
    rows = len(off) - 1
    row = np.repeat(np.arange(rows), np.diff(off))
    out = np.zeros(rows * dim)
    gram = s
    for n in (1, 2, 3):
        if n > 1:
            gram = gram[:len(s) - n + 1] * 263 + s[n - 1:]
        if not len(gram):
            break
        use = gram != {1: 32, 2: 32 * 264, 3: 32 * (263 * 264 + 1)}[n]
        use &= row[:len(gram)] == row[n - 1:]
        cell = ((gram * 2654435761) >> 7) % dim
        out += np.bincount(row[:len(gram)][use] * dim + cell[use], minlength=rows * dim)
    out = np.sqrt(out.reshape(rows, dim))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def has_letter(raw: np.ndarray) -> bool:
    return bool((_FOLD[raw[raw < 128]] != 32).any()) or any(c.isalpha() for c in raw.tobytes().decode())


def families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """The most alike groups of languages (mean cosine) are joined until few are left."""
    groups = [[x] for x in sorted(means)]
    while len(groups) > max(1, math.isqrt(max(len(means) - 1, 0)) + 1):
        def alike(pair):
            a, b = pair
            return np.mean([means[x] @ means[y] for x in groups[a] for y in groups[b]])
        a, b = max(combinations(range(len(groups)), 2), key=alike)
        groups[a] = sorted(groups[a] + groups[b])
        del groups[b]
    return groups


def drawn(known: DataFrame, per_language: int) -> DataFrame:
    """Of rows (t, lang), the ``per_language`` different texts of least hash of each language."""
    hashed = known.withColumn("_h", F.xxhash64("t"))
    keys = hashed.select("lang", "_h").distinct().withColumn("_part", F.pmod("_h", F.lit(PARTS)))
    for by in (["lang", "_part"], ["lang"]):                  # the last sees PARTS * per_language rows of a language
        keys = keys.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_h"))).where(F.col("_rank") <= per_language)
    # per_language rows for each language at most
    return hashed.join(F.broadcast(keys.select("lang", "_h")), ["lang", "_h"], "left_semi").dropDuplicates(["lang", "_h"]).select("t", "lang")


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict:
    """Families and machines from labelled rows (null lang: not used)."""
    spark = docs.sparkSession
    known = docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and t is not null")
    sample = drawn(known, per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8_column(b, "t")
            for lo, hi in slices(off):
                x = features(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=["lang", "x"])
    rows = staged(sample.mapInArrow(run, "lang string, x array<double>"), "language-sample")
    model = {"families": [], "machines": []}
    # at most per_language rows of DIM numbers for each language
    sums: dict[str, np.ndarray] = {}
    for r in rows.select("lang", F.posexplode("x").alias("i", "v")).groupBy("lang", "i").agg(F.avg("v").alias("v")).toLocalIterator():
        sums.setdefault(r["lang"], np.zeros(DIM))[r["i"]] = r["v"]
    if not sums:
        return model
    model["families"] = families({k: v / max(np.linalg.norm(v), 1e-12) for k, v in sums.items()})
    sets = [(a, b) for a, b in combinations(model["families"], 2)]
    sets += [([a], [b]) for f in model["families"] for a, b in combinations(f, 2)]
    vectors = rows.select("lang", array_to_vector("x").alias("features")).repartition(max(2, spark.sparkContext.defaultParallelism)).persist()
    for a, b in sets:
        part = vectors.where(F.col("lang").isin(a + b)).withColumn("label", F.col("lang").isin(a).cast("double"))
        svm = LinearSVC(maxIter=MAX_ITER, regParam=1e-4, standardization=False).fit(part)
        model["machines"].append((a, b, svm.coefficients.toArray(), float(svm.intercept)))
    vectors.unpersist()
    return model


def _vote(groups: list[list[str]], machines: list[tuple], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winner among ``groups`` for every row, and its least margin."""
    n = len(margins)
    wins, least = np.zeros((n, len(groups))), np.full((n, len(groups)), np.inf)
    for k, (a, b, *_) in enumerate(machines):
        if a in groups and b in groups:
            i, j, m = groups.index(a), groups.index(b), margins[:, k]
            wins[:, i] += m >= 0
            wins[:, j] += m < 0
            least[:, i] = np.minimum(least[:, i], m)
            least[:, j] = np.minimum(least[:, j], -m)
    best = np.argmax(wins + np.tanh(np.where(np.isinf(least), 0, least)) * 0.4, axis=1)
    return best, least[np.arange(n), best]


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1)."""
    base = without(docs, *RESULTS)
    shared = base.sparkSession.sparkContext.broadcast(model)
    schema = base.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        fams, machines = m["families"], m["machines"]
        weights = np.stack([w for *_, w, _ in machines], 1) if machines else np.zeros((DIM, 0))
        bias = np.array([c for *_, c in machines])
        names = [x for f in fams for x in f]
        for b in batches:
            raw, off = utf8_column(b, text_col)
            langs, scores = [], []
            for lo, hi in slices(off):
                part, o = raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                margins = features(part, o) @ weights + bias
                family, sure = _vote(fams, machines, margins) if fams else (np.zeros(hi - lo, int), None)
                within = [_vote([[x] for x in f], machines, margins) for f in fams]
                for r in range(hi - lo):
                    if not names or not has_letter(part[o[r]:o[r + 1]]):
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    pick, margin = within[family[r]]
                    langs.append(fams[family[r]][pick[r]])
                    scores.append(float(1 / (1 + np.exp(-2 * min(sure[r], margin[r], 30)))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, *RESULTS])
    return base.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
