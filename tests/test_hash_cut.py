"""Cuts in the seeded hash order against a sort of all hashes."""
import hashlib

import numpy as np
import pytest

from riskframe.functions import hash_cut
from riskframe.operators import prep
from riskframe.plans import checks

from .test_prep_models import signal_frame


def order(key, seed):
    return hashlib.md5(f"{'' if key is None else key}:{seed}".encode()).hexdigest()


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_cuts_against_sorting(spark, monkeypatch, digits):
    monkeypatch.setattr(hash_cut, "DIGITS", digits)
    rng = np.random.default_rng(1)
    rows = [(i, [None, "a", "b"][c]) for i, c in enumerate(rng.choice(3, size=3000, p=[0.1, 0.6, 0.3]).tolist())]
    df = spark.createDataFrame(rows, "id long, c string")
    cuts = hash_cut.hash_cuts(df, "id", 5, "c", lambda cc: {c: [0, 1, n // 3, n - 1, n, n + 7] for c, n in cc})
    assert set(cuts) == {None, "a", "b"}
    for c, bounds in cuts.items():
        h = [order(i, 5) for i, x in rows if x == c]
        n = len(h)
        assert [sum(x < b for x in h) for b in bounds] == [0, 1, n // 3, n - 1, n, n]


def test_repeated_and_null_keys_stay_together(spark):
    df = spark.createDataFrame([(1, "a")] * 40 + [(None, "a")] * 30 + [(i, "a") for i in range(2, 32)], "id long, c string")
    (bound,) = hash_cut.hash_cuts(df, "id", 5, "c", lambda cc: {c: [n // 2] for c, n in cc})["a"]
    taken = [r.id for r in df.where(hash_cut.hash_order("id", 5) < bound).collect()]
    assert taken.count(1) in (0, 40) and taken.count(None) in (0, 30) and len(taken) >= 50
    assert hash_cut.hash_cuts(df.limit(0), "id", 5, "c", lambda cc: {c: [n] for c, n in cc}) == {}


def test_split_and_folds_move_no_row(spark):
    df = signal_frame(spark, 403)
    split, folds = prep.stratified_split(df, test_size=0.2), prep.stratified_folds(df, 5)
    for got in (split, folds):
        assert "Exchange" not in checks.physical_plan(got) and "Window" not in checks.physical_plan(got)
        assert got.count() == 403
    classes = {r.SK_ID_CURR: r.TARGET for r in df.collect()}
    for c in (0, 1):
        ranked = sorted((i for i in classes if classes[i] == c), key=lambda i: order(i, 42))
        test = {r.SK_ID_CURR for r in split.where(f"is_test and TARGET = {c}").collect()}
        assert test == set(ranked[:len(test)])
    sub = prep.stratified_subsample(df, 101)
    assert sub.count() == 101 and prep.stratified_subsample(df, 403) is df
    assert prep.stratified_split(df.limit(0)).count() == 0 and prep.stratified_folds(df.limit(0), 3).count() == 0
