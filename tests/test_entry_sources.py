"""Driver contract, sources/sinks, and scalability of the flagship plan."""
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskframe.operators import clean, features, score
from riskframe.plans import checks, q_features
from riskframe.sources import catalog, io

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "BUREAU_COUNT" in df.columns and "INST_LATE_PAYMENT_RATIO" in df.columns


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 45


def test_flagship_plan_is_scalable(spark):
    m = q_features.feature_matrix_df(spark, SF_SMALL)
    assert checks.plan_problems(m) == []
    plan = checks.physical_plan(m)
    assert "PushedFilters" in plan or "ReadSchema" in plan


def test_csv_missing_tokens_and_errors(spark, tmp_root):
    path = os.path.join(tmp_root, "application_train.csv")
    with open(path, "w") as fh:
        fh.write("SK_ID_CURR,OCCUPATION_TYPE,AMT_CREDIT\n1,nan,10.5\n2,Laborers,NA\n3,#N/A,\n4,None,x\n")
    df = catalog.load_table(spark, "application_train", tmp_root, fmt="csv")
    rows = {r.SK_ID_CURR: r for r in df.collect()}
    assert rows[1].OCCUPATION_TYPE is None and rows[2].OCCUPATION_TYPE == "Laborers"
    assert rows[2].AMT_CREDIT is None and rows[3].OCCUPATION_TYPE is None
    assert dict(df.dtypes) == {"SK_ID_CURR": "bigint", "OCCUPATION_TYPE": "string", "AMT_CREDIT": "string"}
    with pytest.raises(KeyError):
        catalog.load_table(spark, "nope", tmp_root)
    with pytest.raises(FileNotFoundError):
        catalog.load_table(spark, "bureau", tmp_root, fmt="csv")
    rep = {r.table: r for r in catalog.verify_raw_data(spark, tmp_root, fmt="csv").collect()}
    assert rep["application_train"].present and not rep["bureau"].present
    assert not catalog.all_required_present(catalog.verify_raw_data(spark, tmp_root, fmt="csv"))
    assert catalog.catalog_frame(spark).count() == len(catalog.CATALOG)
    got = catalog.load_table(spark, "application_train", tmp_root, fmt="csv", nrows=2).collect()
    assert [r.SK_ID_CURR for r in got] == [1, 2]


def test_csv_types_and_matrix(spark, tmp_root):
    """Types follow all values; the matrix of CSV files is that of the tables they came from."""
    path = os.path.join(tmp_root, "bureau.csv")
    with open(path, "w") as fh:
        fh.write("a,b,c,d,e,f,g\n1,1,1.5,true,x,,10\n-2,NA, 2e3,false,7,,9\n")
    df = catalog.load_table(spark, "bureau", tmp_root, fmt="csv", order_by=["g"], nrows=1)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "double", "boolean", "string", "double", "bigint"]
    assert tuple(df.first()) == (-2, None, 2000.0, False, "7", None, 9)
    schema = spark.createDataFrame([], "a string, c long").schema
    forced = catalog.read_csv_with_missing_tokens(spark, path, schema)
    assert dict(forced.dtypes)["a"] == "string" and dict(forced.dtypes)["b"] == "double"

    tables = fixtures_tables(spark)
    for name, t in tables.items():
        t.coalesce(1).write.option("header", True).csv(os.path.join(tmp_root, "csv", name + ".csv"))
    scanned = {name: catalog.load_table(spark, name, os.path.join(tmp_root, "csv"), fmt="csv") for name in tables}
    want, got = features.build_feature_matrix(tables), features.build_feature_matrix(scanned)
    assert got.columns == want.columns
    got = got.select(*[F.col(c).cast(t).alias(c) for c, t in want.dtypes])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def fixtures_tables(spark):
    d = [(i, i % 2, 1000.5 + i, 2000.25, None if i % 3 else 90.5, 1800.0, -9000 - i, -100.0) for i in range(1, 9)]
    b = [(i % 5 + 1, i, "Active" if i % 2 else "Closed", "t%d" % (i % 3), -i, i * 10.5, 0.0) for i in range(1, 13)]
    return {
        "application_train": spark.createDataFrame(
            d, "SK_ID_CURR long, TARGET long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, "
               "AMT_GOODS_PRICE double, DAYS_BIRTH long, DAYS_EMPLOYED double"),
        "bureau": spark.createDataFrame(
            b, "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, DAYS_CREDIT long, "
               "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_OVERDUE double")}


def test_absent_history_has_static_columns(spark):
    tables = fixtures_tables(spark)
    assert not [c for c in features.build_feature_matrix(tables).columns if c.startswith(("PREV_", "INST_"))]
    full = features.build_feature_matrix(tables, static_columns=True)
    more = features.with_empty_history(tables)
    assert full.columns == features.build_feature_matrix(more).columns
    rows = full.collect()
    assert len(rows) == 8 and all(r.PREV_COUNT == 0 and r.INST_COUNT == 0 and r.INST_PAYMENT_DELAY_MEAN is None for r in rows)
    assert {r.SK_ID_CURR: r.BUREAU_COUNT for r in rows}[8] == 0 and all(
        r.BUREAU_BB_MONTHS_COUNT_SUM == (0 if r.BUREAU_COUNT else None) for r in rows)
    only = features.build_feature_matrix({"application_train": tables["application_train"]}, static_columns=True)
    assert only.columns == full.columns and only.count() == 8


def test_staged_io_roundtrip(spark, tmp_root):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    io.save_parquet(df, tmp_root, "feature_matrix", stage="processed")
    assert io.load_processed(spark, tmp_root, "feature_matrix").count() == 5
    io.save_table(df, tmp_root, "report", subdir="eda")
    with pytest.raises(FileNotFoundError):
        io.load_processed(spark, tmp_root, "missing")
    ok, missing = io.artifacts_exist(spark, tmp_root)
    assert not ok and "model best_model" in missing


def test_what_if_clamps_and_recomputes(spark):
    m = spark.createDataFrame([(1, 100.0, 5_000_000.0, None, 10.0, None, None)],
                              "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, "
                              "AMT_ANNUITY double, age_years double, credit_income_ratio double, "
                              "annuity_income_ratio double")
    ov = spark.createDataFrame([(1, None, 12.0)], "SK_ID_CURR long, AMT_CREDIT double, age_years double")
    r = score.apply_overrides(m, ov).first()
    assert r.AMT_CREDIT == 2_000_000.0            # clamped to the upper bound
    assert r.age_years == 18.0                     # clamped to the lower bound
    assert r.credit_income_ratio == pytest.approx(2_000_000.0 / 100.0)
    m = m.withColumns({"AMT_INCOME_TOTAL": F.lit(3e6), "external_score_mean": F.lit(None).cast("double")})
    r = score.apply_overrides(m, ov).first()       # features without an override are clamped too
    assert (r.AMT_INCOME_TOTAL, r.AMT_ANNUITY, r.external_score_mean) == (1_000_000.0, 0.0, 0.0)
    assert (r.credit_income_ratio, r.annuity_income_ratio) == (2.0, 0.0)


def test_class_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "TARGET int")
    r = clean.class_balance_summary(df).first()
    assert (r.n_total, r.n_negative, r.n_positive) == (4, 3, 1)
    assert r.imbalance_ratio == 3.0 and r.positive_rate == 0.25
