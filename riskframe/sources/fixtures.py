"""Credit-schema views over the driver tables.

The driver tables (customers, orders, line items, events, embeddings) stand in for the
credit dataset.  Each view below maps one driver table onto one credit table with the
credit column names, over the *whole* table; modulo expressions only inject nulls,
sentinels and invalid values, they never drop rows.  Every view exists twice, as a Spark
plan and as DuckDB SQL (used by the oracle), and both must stay in step.

=========================  =======================  ==========================
view                       stands for               source
=========================  =======================  ==========================
application                application_train        customer
bureau                     bureau                   orders
bureau_balance             bureau_balance           lineitem
previous_application       previous_application     orders
installments_payments      installments_payments    lineitem join orders
scores                     model output (2 models)  events
=========================  =======================  ==========================
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import dtype_histogram  # noqa: F401  (re-export for callers)

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]

REF_DAY = "2002-01-01"
# History amounts are scaled by pi/3 so that their means are arbitrary doubles: means of
# 2-decimal money often sit exactly on a rounding tie at the 4th decimal, where two engines
# summing in different orders round to different sides.
MONEY_SCALE = 1.0471975511965976


class TableSet:
    """Lazy access to the driver parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _days_since_ref(ts: str) -> Column:
    return F.datediff(F.col(ts).cast("date"), F.lit(REF_DAY).cast("date"))


def _dbl(x) -> Column:
    return F.lit(float(x))


# ----------------------------------------------------------------------------- Spark side
def application(t: TableSet) -> DataFrame:
    k, bal = F.col("c_custkey"), F.abs(F.col("c_acctbal"))
    nat = F.col("c_nationkey")
    return t["customer"].select(
        k.alias("SK_ID_CURR"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).cast("int").alias("TARGET"),
        F.when(k % 10 < 7, "Cash loans").otherwise("Revolving loans").alias("NAME_CONTRACT_TYPE"),
        F.when(k % 97 == 0, "XNA").when(k % 2 == 0, "F").otherwise("M").alias("CODE_GENDER"),
        F.col("c_mktsegment").alias("NAME_INCOME_TYPE"),
        F.when(nat == 24, None).otherwise(F.concat(F.lit("occ_"), (nat % 7).cast("string")))
         .alias("OCCUPATION_TYPE"),
        (k % 4).cast("int").alias("CNT_CHILDREN"),
        (nat % 3 + 1).cast("int").alias("REGION_RATING_CLIENT"),
        F.lit(1).alias("FLAG_MOBIL"),
        (bal * _dbl(10) + _dbl(1000)).alias("AMT_INCOME_TOTAL"),
        (bal * _dbl(3) - _dbl(150)).alias("AMT_CREDIT"),
        F.when(k % 11 == 0, None).otherwise(bal / _dbl(12) + (k % 50)).alias("AMT_ANNUITY"),
        (bal * _dbl(2.5) + (k % 200) - _dbl(50)).alias("AMT_GOODS_PRICE"),
        (-(F.lit(7000) + (k * 37) % 18000)).cast("int").alias("DAYS_BIRTH"),
        F.when(k % 6 == 0, F.lit(365243)).otherwise(-((k * 13) % 14000) - 1).cast("double")
         .alias("DAYS_EMPLOYED"),
        (-((k * 7) % 9000)).cast("double").alias("DAYS_REGISTRATION"),
        F.when(k % 7 == 0, None).otherwise(((k * 17) % 1000) / _dbl(1000)).alias("EXT_SOURCE_1"),
        F.when(k % 5 == 0, None).otherwise(nat / _dbl(25)).alias("EXT_SOURCE_2"),
        F.when(k % 3 == 0, None).otherwise((k % 100) / _dbl(100)).alias("EXT_SOURCE_3"),
    )


def bureau(t: TableSet) -> DataFrame:
    k = F.col("o_orderkey")
    return t["orders"].select(
        F.when(k % 101 == 0, None).otherwise(F.col("o_custkey")).alias("SK_ID_CURR"),
        k.alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderstatus") == "O", "Active").when(F.col("o_orderstatus") == "F", "Closed")
         .otherwise("Sold").alias("CREDIT_ACTIVE"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("CREDIT_TYPE"),
        _days_since_ref("o_orderdate").alias("DAYS_CREDIT"),
        F.when(k % 20 == 0, None).otherwise(F.col("o_totalprice") * _dbl(MONEY_SCALE)).alias("AMT_CREDIT_SUM"),
        F.when(k % 4 == 0, F.col("o_totalprice") * _dbl(0.01)).otherwise(_dbl(0))
         .alias("AMT_CREDIT_SUM_OVERDUE"),
    )


def bureau_balance(t: TableSet) -> DataFrame:
    ln = F.col("l_linenumber")
    return t["lineitem"].select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.when(ln == 7, None).otherwise(-ln).alias("MONTHS_BALANCE"),
        F.when(F.col("l_returnflag") == "R", (ln % 6).cast("string"))
         .when(F.col("l_returnflag") == "A", "C").otherwise("X").alias("STATUS"),
    )


def previous_application(t: TableSet) -> DataFrame:
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return t["orders"].select(
        k.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(st == "F", "Approved").when(st == "P", "Refused").otherwise("Canceled")
         .alias("NAME_CONTRACT_STATUS"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        (F.col("o_totalprice") * _dbl(MONEY_SCALE)).alias("AMT_CREDIT"),
        F.when(k % 9 == 0, None).otherwise(F.col("o_totalprice") / _dbl(12)).alias("AMT_ANNUITY"),
    )


def installments_payments(t: TableSet) -> DataFrame:
    # dates are joined as small numbers of days, which take a fraction of a time stamp's bytes
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                              _days_since_ref("l_shipdate").alias("shipped"))
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                           _days_since_ref("o_orderdate").alias("ordered"))
    j = li.join(o, "l_orderkey")
    ln = F.col("l_linenumber")
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        ln.alias("NUM_INSTALMENT_NUMBER"),
        (F.col("ordered") + 30).alias("DAYS_INSTALMENT"),
        F.when(ln == 7, None).otherwise(F.col("shipped")).cast("double")
         .alias("DAYS_ENTRY_PAYMENT"),
        (F.col("l_extendedprice") * _dbl(MONEY_SCALE)).alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * _dbl(MONEY_SCALE) * (_dbl(1) - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


def scores_wide(t: TableSet) -> DataFrame:
    """One row per event: label and the scores of two 'models' a and b."""
    v = F.col("value")
    return t["events"].select(
        F.col("event_id").alias("row_id"),
        F.when((F.col("event_type") == "error") & (v > 20), 1).otherwise(0).cast("int").alias("label"),
        F.least(_dbl(1), F.floor(v) / _dbl(400)).alias("p_a"),
        ((F.col("user_id") % 97) / _dbl(97)).alias("p_b"),
    )


def scores_long(t: TableSet) -> DataFrame:
    """(model, row_id, label, p): the long form used by model comparison."""
    w = scores_wide(t)
    return (w.select(F.lit("a").alias("model"), "row_id", "label", F.col("p_a").alias("p"))
             .unionByName(w.select(F.lit("b").alias("model"), "row_id", "label",
                                   F.col("p_b").alias("p"))))


def credit_tables(t: TableSet) -> dict[str, DataFrame]:
    return {
        "application_train": application(t),
        "bureau": bureau(t),
        "bureau_balance": bureau_balance(t),
        "previous_application": previous_application(t),
        "installments_payments": installments_payments(t),
    }


# ---------------------------------------------------------------------------- DuckDB side
_DAYS = "date_diff('day', DATE '2002-01-01', CAST({c} AS DATE))"

SQL_VIEWS = {
    "application_train": """
SELECT c_custkey AS SK_ID_CURR,
  CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS TARGET,
  CASE WHEN c_custkey % 10 < 7 THEN 'Cash loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN c_custkey % 97 = 0 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
  c_mktsegment AS NAME_INCOME_TYPE,
  CASE WHEN c_nationkey = 24 THEN NULL ELSE 'occ_' || CAST(c_nationkey % 7 AS VARCHAR) END AS OCCUPATION_TYPE,
  CAST(c_custkey % 4 AS INTEGER) AS CNT_CHILDREN,
  CAST(c_nationkey % 3 + 1 AS INTEGER) AS REGION_RATING_CLIENT,
  CAST(1 AS INTEGER) AS FLAG_MOBIL,
  abs(c_acctbal) * 10.0::DOUBLE + 1000.0::DOUBLE AS AMT_INCOME_TOTAL,
  abs(c_acctbal) * 3.0::DOUBLE - 150.0::DOUBLE AS AMT_CREDIT,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE abs(c_acctbal) / 12.0::DOUBLE + (c_custkey % 50) END AS AMT_ANNUITY,
  abs(c_acctbal) * 2.5::DOUBLE + (c_custkey % 200) - 50.0::DOUBLE AS AMT_GOODS_PRICE,
  CAST(-(7000 + (c_custkey * 37) % 18000) AS INTEGER) AS DAYS_BIRTH,
  CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -((c_custkey * 13) % 14000) - 1 END AS DOUBLE) AS DAYS_EMPLOYED,
  CAST(-((c_custkey * 7) % 9000) AS DOUBLE) AS DAYS_REGISTRATION,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE ((c_custkey * 17) % 1000) / 1000.0::DOUBLE END AS EXT_SOURCE_1,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey / 25.0::DOUBLE END AS EXT_SOURCE_2,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey % 100) / 100.0::DOUBLE END AS EXT_SOURCE_3
FROM customer""",
    "bureau": f"""
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS SK_ID_CURR,
  o_orderkey AS SK_ID_BUREAU,
  CASE WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
  nullif(o_orderpriority, '5-LOW') AS CREDIT_TYPE,
  CAST({_DAYS.format(c='o_orderdate')} AS INTEGER) AS DAYS_CREDIT,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_totalprice * 1.0471975511965976::DOUBLE END AS AMT_CREDIT_SUM,
  CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice * 0.01::DOUBLE ELSE 0.0::DOUBLE END AS AMT_CREDIT_SUM_OVERDUE
FROM orders""",
    "bureau_balance": """
SELECT l_orderkey AS SK_ID_BUREAU,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE -l_linenumber END AS MONTHS_BALANCE,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber % 6 AS VARCHAR)
       WHEN l_returnflag = 'A' THEN 'C' ELSE 'X' END AS STATUS
FROM lineitem""",
    "previous_application": """
SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
  CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'P' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  o_orderpriority AS NAME_CONTRACT_TYPE, o_totalprice * 1.0471975511965976::DOUBLE AS AMT_CREDIT,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice / 12.0::DOUBLE END AS AMT_ANNUITY
FROM orders""",
    "installments_payments": f"""
SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, l_linenumber AS NUM_INSTALMENT_NUMBER,
  CAST({_DAYS.format(c='o_orderdate')} + 30 AS INTEGER) AS DAYS_INSTALMENT,
  CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE {_DAYS.format(c='l_shipdate')} END AS DOUBLE) AS DAYS_ENTRY_PAYMENT,
  l_extendedprice * 1.0471975511965976::DOUBLE AS AMT_INSTALMENT,
  l_extendedprice * 1.0471975511965976::DOUBLE * (1.0::DOUBLE - l_discount) AS AMT_PAYMENT
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scores_wide": """
SELECT event_id AS row_id,
  CAST(CASE WHEN event_type = 'error' AND value > 20 THEN 1 ELSE 0 END AS INTEGER) AS label,
  least(1.0::DOUBLE, floor(value) / 400.0::DOUBLE) AS p_a,
  (user_id % 97) / 97.0::DOUBLE AS p_b
FROM events""",
}
SQL_VIEWS["scores_long"] = """
SELECT 'a' AS model, row_id, label, p_a AS p FROM scores_wide
UNION ALL SELECT 'b' AS model, row_id, label, p_b AS p FROM scores_wide"""

SQL_DEPENDS = {"scores_long": ["scores_wide"]}


def sql_with(views: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs of the named views (and their dependencies)."""
    order: list[str] = []

    def add(v):
        for d in SQL_DEPENDS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)
    for v in views:
        add(v)
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in order)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
