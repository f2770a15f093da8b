"""Null rules, cleaning and history aggregates on tiny hand-made credit tables."""
import math

import pytest
from pyspark.sql import Row

from riskframe.operators import clean, features


def app_rows(spark):
    schema = ("SK_ID_CURR long, TARGET int, CODE_GENDER string, AMT_INCOME_TOTAL double, "
              "AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, DAYS_BIRTH int, "
              "DAYS_EMPLOYED double, DAYS_REGISTRATION double, EXT_SOURCE_1 double, "
              "EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    rows = [
        (1, 0, "M", 1000.0, 2000.0, 100.0, 1800.0, -10000, -500.0, -100.0, 0.2, 0.4, None),
        (2, 1, "XNA", 0.0, 3000.0, None, 2500.0, -20000, 365243.0, -200.0, None, None, None),
        (3, 0, "F", 500.0, -5.0, 50.0, 400.0, -15000, -1000.0, 0.0, 0.5, None, None),
        (4, 1, "F", 800.0, 1600.0, 80.0, 1600.0, -9131, float("nan"), -10.0, 0.1, 0.2, 0.3),
    ]
    from riskframe.functions.nulls import nan_to_null
    return nan_to_null(spark.createDataFrame(rows, schema))


def test_cleaning_rules(spark):
    out = {r.SK_ID_CURR: r for r in clean.clean_application(app_rows(spark)).collect()}
    assert out[2].DAYS_EMPLOYED is None and out[2].DAYS_EMPLOYED_ANOMALY == 1
    assert out[1].DAYS_EMPLOYED_ANOMALY == 0
    assert out[4].DAYS_EMPLOYED is None and out[4].DAYS_EMPLOYED_ANOMALY == 0   # NaN -> null, not sentinel
    assert out[2].AMT_INCOME_TOTAL is None        # <= 0 -> null
    assert out[3].AMT_CREDIT is None
    assert out[2].CODE_GENDER is None             # placeholder -> null


def test_unique_id_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "SK_ID_CURR long, x string")
    with pytest.raises(ValueError, match="2 duplicates"):
        clean.assert_unique_id(df)
    kept = clean.remove_exact_duplicates(df, subset=["SK_ID_CURR"]).collect()
    assert sorted((r.SK_ID_CURR, r.x) for r in kept if r.SK_ID_CURR is not None) == [(1, "a")]


def test_application_features(spark):
    app = clean.clean_application(app_rows(spark))
    out = {r.SK_ID_CURR: r for r in features.add_application_features(app).collect()}
    r1 = out[1]
    assert r1.credit_income_ratio == pytest.approx(2000.0 / (1000.0 + 1e-5))
    assert r1.age_years == 27.4                  # round(10000 / 365.25, 1), half-even
    assert out[4].age_years == 25.0              # 9131 / 365.25 = 24.9993...
    assert r1.external_score_mean == pytest.approx(0.3)
    assert r1.external_score_std == pytest.approx(math.sqrt(0.02))
    assert out[3].external_score_std is None      # one present score
    assert out[2].external_score_mean is None     # none present
    assert out[4].external_score_min == 0.1 and out[4].external_score_max == 0.3
    # missing counter counts derived columns too: income null -> both income ratios null
    r2 = out[2]
    n_null = sum(v is None for k, v in r2.asDict().items() if k != "missing_values_count")
    assert r2.missing_values_count == n_null


def test_history_aggregates_null_rules(spark):
    bureau = spark.createDataFrame([
        Row(SK_ID_CURR=1, SK_ID_BUREAU=10, CREDIT_ACTIVE="Active", CREDIT_TYPE="car",
            DAYS_CREDIT=-100, AMT_CREDIT_SUM=None, AMT_CREDIT_SUM_OVERDUE=None),
        Row(SK_ID_CURR=1, SK_ID_BUREAU=11, CREDIT_ACTIVE="Closed", CREDIT_TYPE=None,
            DAYS_CREDIT=-300, AMT_CREDIT_SUM=None, AMT_CREDIT_SUM_OVERDUE=5.0),
        Row(SK_ID_CURR=None, SK_ID_BUREAU=12, CREDIT_ACTIVE="Active", CREDIT_TYPE="car",
            DAYS_CREDIT=-1, AMT_CREDIT_SUM=7.0, AMT_CREDIT_SUM_OVERDUE=0.0),
    ], "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, "
       "DAYS_CREDIT int, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_OVERDUE double")
    bb = spark.createDataFrame([(10, -1, "1"), (10, -2, "C"), (10, None, "5")],
                               "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    agg = features.aggregate_bureau(bureau, bb).collect()
    assert len(agg) == 1                                   # null key dropped
    r = agg[0]
    assert r.BUREAU_COUNT == 2 and r.BUREAU_ACTIVE_COUNT == 1 and r.BUREAU_CLOSED_COUNT == 1
    assert r.BUREAU_OVERDUE_COUNT == 1                     # null overdue counts as 0
    assert r.BUREAU_SUM_AMT_CREDIT_SUM == 0.0              # all-missing sum is 0
    assert r.BUREAU_MEAN_AMT_CREDIT_SUM is None            # all-missing mean stays missing
    assert r.BUREAU_CREDIT_TYPE_NUNIQUE == 1
    assert r.BUREAU_BB_MONTHS_COUNT_SUM == 2               # non-null months only
    assert r.BUREAU_BB_OVERDUE_MONTHS_SUM == 2             # statuses 1 and 5; credit 11 has none -> 0


def test_installments_and_previous(spark):
    inst = spark.createDataFrame([
        (1, 100, 1, -50, -40.0, 10.0, 8.0), (1, 100, 2, -20, None, 10.0, 10.0),
        (1, 101, 1, -10, -15.0, 5.0, 6.0)],
        "SK_ID_CURR long, SK_ID_PREV long, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, "
        "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
    r = features.aggregate_installments(inst).first()
    assert r.INST_COUNT == 3 and r.INST_LATE_PAYMENT_COUNT == 1
    assert r.INST_PAYMENT_DELAY_MEAN == pytest.approx((10 - 5) / 2)
    assert r.INST_LATE_PAYMENT_RATIO == pytest.approx(1 / 3)
    assert r.INST_PAYMENT_DIFF_SUM == pytest.approx(1.0)
    prev = spark.createDataFrame([(1, 5, "Approved", "a", 10.0, None), (1, 6, "Refused", "b", 20.0, None)],
                                 "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, "
                                 "NAME_CONTRACT_TYPE string, AMT_CREDIT double, AMT_ANNUITY double")
    p = features.aggregate_previous(prev).first()
    assert p.PREV_APPROVAL_RATE == 0.5 and p.PREV_MEAN_AMT_ANNUITY is None


def test_matrix_fills_only_count_columns(spark):
    app = clean.clean_application(app_rows(spark))
    prev = spark.createDataFrame([(1, 5, "Approved", "a", 10.0, 1.0)],
                                 "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, "
                                 "NAME_CONTRACT_TYPE string, AMT_CREDIT double, AMT_ANNUITY double")
    m = {r.SK_ID_CURR: r for r in features.build_feature_matrix(
        {"application_train": app, "previous_application": prev}).collect()}
    assert len(m) == 4
    assert m[2].PREV_COUNT == 0 and m[2].PREV_APPROVED_COUNT == 0
    assert m[2].PREV_APPROVAL_RATE is None and m[2].PREV_CONTRACT_TYPE_NUNIQUE is None


def test_rowwise_stats_with_one_column(spark):
    from pyspark.sql import functions as F
    from riskframe.operators.features import rowwise_stats
    row = spark.sql("select 2.0D as x").select(*rowwise_stats([F.col("x")], "s")).first()
    assert (row.s_mean, row.s_std, row.s_min, row.s_max) == (2.0, None, 2.0, 2.0)


def test_distinct_counts_are_exchanged_without_the_other_sums(spark):
    """Pairs for a distinct count carry no sums, and the join by credit carries its keys alone."""
    bureau = spark.createDataFrame(
        [(1, 10, "Active", "car", -5, 4.0, 0.0), (1, 10, "Closed", "car", -9, None, 1.0), (1, 11, "Active", None, -1, 2.0, 0.0),
         (2, None, "Sold", None, -3, None, 0.0), (None, 12, "Active", "home", -2, 9.0, 0.0)], features.HISTORY_SCHEMAS["bureau"])
    months = spark.createDataFrame([(10, -1, "1"), (10, None, "0"), (12, -1, "5")], features.HISTORY_SCHEMAS["bureau_balance"])
    out = features.aggregate_bureau(bureau, months)
    got = {r.SK_ID_CURR: r for r in out.collect()}
    assert sorted(got) == [1, 2]
    assert (got[1].BUREAU_COUNT, got[1].BUREAU_CREDIT_TYPE_NUNIQUE, got[1].BUREAU_MEAN_AMT_CREDIT_SUM) == (3, 1, 3.0)
    assert (got[1].BUREAU_BB_MONTHS_COUNT_SUM, got[1].BUREAU_BB_OVERDUE_MONTHS_SUM) == (2, 2)    # a repeated credit counts again
    assert (got[2].BUREAU_CREDIT_TYPE_NUNIQUE, got[2].BUREAU_MEAN_AMT_CREDIT_SUM, got[2].BUREAU_SUM_AMT_CREDIT_SUM) == (0, None, 0.0)
    assert (got[2].BUREAU_BB_MONTHS_COUNT_SUM, got[2].BUREAU_BB_OVERDUE_MONTHS_SUM) == (0, 0)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    pairs = [line for line in plan.splitlines() if "Aggregate(keys=[SK_ID_CURR" in line and ", CREDIT_TYPE#" in line.split("]")[0]]
    assert pairs and all("functions=[]" in line for line in pairs)
