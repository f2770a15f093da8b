"""Table catalog and scans (logical name -> lazy DataFrame).

The catalog describes each table of the credit dataset: file, grain, keys, and whether
it is required.  Scans are lazy; the only jobs here are the explicit existence probes.
"""
from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import nan_to_null

# Grain tags of the catalog.
CURRENT, ONE_TO_MANY, NESTED, METADATA = "current_application", "one_to_many", "nested", "metadata"

# The missing-value tokens a CSV reader must treat as empty (pandas defaults).
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                  "n/a", "nan", "null"]


@dataclass(frozen=True)
class TableSpec:
    name: str
    filename: str
    granularity: str
    primary_key: tuple[str, ...]
    join_key_to_main: str | None
    priority: str
    description: str = ""
    schema: T.StructType | None = field(default=None, compare=False)


# The tables of the credit dataset, their files, grain and keys.
CATALOG: dict[str, TableSpec] = {s.name: s for s in [
    TableSpec("application_train", "application_train.csv", CURRENT, ("SK_ID_CURR",), "SK_ID_CURR",
              "required", "main table, one application per row, with the label"),
    TableSpec("application_test", "application_test.csv", CURRENT, ("SK_ID_CURR",), "SK_ID_CURR",
              "optional", "main table without the label, for scoring only"),
    TableSpec("bureau", "bureau.csv", ONE_TO_MANY, ("SK_ID_BUREAU",), "SK_ID_CURR",
              "required", "credits at other institutions, n per applicant"),
    TableSpec("bureau_balance", "bureau_balance.csv", NESTED, ("SK_ID_BUREAU", "MONTHS_BALANCE"),
              "SK_ID_BUREAU", "optional", "monthly status per bureau credit"),
    TableSpec("previous_application", "previous_application.csv", ONE_TO_MANY, ("SK_ID_PREV",),
              "SK_ID_CURR", "required", "earlier applications at the lender"),
    TableSpec("installments_payments", "installments_payments.csv", NESTED,
              ("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"), "SK_ID_PREV", "required",
              "planned vs. paid instalments of earlier credits"),
    TableSpec("POS_CASH_balance", "POS_CASH_balance.csv", NESTED, ("SK_ID_PREV", "MONTHS_BALANCE"),
              "SK_ID_PREV", "optional", "monthly balances of point-of-sale and cash loans"),
    TableSpec("credit_card_balance", "credit_card_balance.csv", NESTED,
              ("SK_ID_PREV", "MONTHS_BALANCE"), "SK_ID_PREV", "optional",
              "monthly credit card balances"),
]}

REQUIRED_TABLES = [k for k, v in CATALOG.items() if v.priority == "required"]
OPTIONAL_TABLES = [k for k, v in CATALOG.items() if v.priority == "optional"]


def _path(root: str, spec: TableSpec, fmt: str) -> str:
    stem = spec.filename.rsplit(".", 1)[0]
    return f"{root.rstrip('/')}/{stem}.{fmt}"


def read_csv_with_missing_tokens(spark: SparkSession, path: str,
                                 schema: T.StructType | None = None) -> DataFrame:
    """Read a headed CSV as strings, turn the missing tokens into null, then type it.

    Spark's ``nullValue`` takes one token; the reference's reader knows a set of them.
    Columns of ``schema`` are converted with ``try_cast`` (bad values -> null); the types of
    all others are inferred from all rows (``inferred_types``).
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    raw = raw.select(*[F.when(~F.array_contains(tokens, F.trim(F.col(f"`{c}`"))), F.col(f"`{c}`")).alias(c)
                       for c in raw.columns])
    known = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    types = inferred_types(raw, [c for c in raw.columns if c not in known]) | known
    return nan_to_null(raw.select(*[F.trim(F.col(f"`{c}`")).try_cast(types[c]).alias(c) if types[c] != T.StringType()
                                    else F.col(f"`{c}`") for c in raw.columns]))


def inferred_types(raw: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """The type of each string column by all of its values, in one aggregate: whole numbers
    (double where some are missing, as is a column without any value), numbers, booleans,
    else strings."""
    if not columns:
        return {}
    whole, number = r"^\s*[+-]?[0-9]{1,18}\s*$", r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    aggs = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        aggs += [F.count(c).alias(f"n{i}"), F.bool_and(c.rlike(whole)).alias(f"w{i}"), F.bool_and(c.rlike(number)).alias(f"d{i}"),
                 F.bool_and(F.lower(F.trim(c)).isin("true", "false")).alias(f"b{i}")]
    row = raw.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    out: dict[str, T.DataType] = {}
    for i, name in enumerate(columns):
        if row[f"n{i}"] == 0 or row[f"d{i}"]:
            out[name] = T.LongType() if row[f"w{i}"] and row[f"n{i}"] == row["rows"] else T.DoubleType()
        else:
            out[name] = T.BooleanType() if row[f"b{i}"] and row[f"n{i}"] == row["rows"] else T.StringType()
    return out


def load_table(spark: SparkSession, name: str, root: str, fmt: str = "parquet",
               nrows: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Scan one catalogued table.  Unknown name -> KeyError, absent file -> FileNotFoundError.

    ``nrows`` is the prototype mode of the reference (first rows of the file).  Spark has no
    file order, so the first rows are defined by ``order_by`` (default: the primary key).
    """
    if name not in CATALOG:
        raise KeyError(f"unknown table '{name}'; known: {sorted(CATALOG)}")
    spec = CATALOG[name]
    path = _path(root, spec, fmt)
    try:
        if fmt == "csv":
            df = read_csv_with_missing_tokens(spark, path, spec.schema)
        else:
            df = nan_to_null(spark.read.parquet(path))
        df.schema  # resolves the path
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise
    if nrows is not None:
        keys = order_by or list(spec.primary_key) or df.columns[:1]
        df = df.orderBy(*keys).limit(nrows)
    return df


def load_all_available(spark: SparkSession, root: str, fmt: str = "parquet",
                       required_only: bool = False) -> dict[str, DataFrame]:
    """All catalogued tables that exist, skipping the metadata table; lazy frames."""
    names = REQUIRED_TABLES if required_only else list(CATALOG)
    out = {}
    for name in names:
        if CATALOG[name].granularity == METADATA:
            continue
        try:
            out[name] = load_table(spark, name, root, fmt)
        except FileNotFoundError:
            continue
    return out


def verify_raw_data(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Presence report ``(table, required, present)`` for every catalogued table."""
    rows = []
    for name, spec in CATALOG.items():
        try:
            load_table(spark, name, root, fmt)
            present = True
        except FileNotFoundError:
            present = False
        rows.append((name, spec.priority == "required", present))
    return spark.createDataFrame(rows, "table string, required boolean, present boolean")


def all_required_present(report: DataFrame) -> bool:
    return report.where(F.col("required") & ~F.col("present")).limit(1).count() == 0


def catalog_frame(spark: SparkSession) -> DataFrame:
    """The catalog as a table (name, file, grain, keys, join key, priority, description)."""
    rows = []
    for s in CATALOG.values():
        d = asdict(s)
        d.pop("schema")
        d["primary_key"] = list(s.primary_key)
        rows.append(d)
    return spark.createDataFrame(
        rows, "name string, filename string, granularity string, primary_key array<string>, "
              "join_key_to_main string, priority string, description string")


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table: one count per table, unioned into one small frame."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(name).alias("table_name"), "n_rows",
                        F.lit(len(df.columns)).cast("bigint").alias("n_cols"))
              for name, df in tables.items()]
    return reduce_union(frames)


def reduce_union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Number of columns per Spark type of one table (schema only, no job)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, n_columns int")
