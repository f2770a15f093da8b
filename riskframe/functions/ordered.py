"""Ordered computations without a single-partition window.

Exact average precision, ROC area, calibration edges, medians, quartiles and the
stratified split all need a *global* running total over sorted keys.  A plain
``Window.orderBy(...)`` moves every row into one task.  ``running_totals`` instead

1. takes approximate quantiles of the sort key per group (one pass, bounded sketch) and
   turns them into range buckets -- a deterministic function of the key, so tied keys
   share a bucket;
2. sums each bucket (a tiny table of groups x buckets rows) and forms exclusive prefix
   offsets on it;
3. runs the running sum inside ``partitionBy(group, bucket)`` windows and adds the offset.

The result is exact; only the bucket balance depends on the sketch.  Inputs with heavy
ties should be pre-aggregated to one row per distinct key first (``exact_quantiles`` and
the ranking metrics do this), so a hot value is a single row, not a hot bucket.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reuse

# Above this many (group x bucket) split values the buckets are attached by a join instead
# of an inline expression.
_INLINE_SPLIT_LIMIT = 20_000
# Above this many groups the per-group split points are not collected at all.
_INLINE_GROUPS = 4_096
# Target rows per bucket when the bucket count is derived from the data.
_ROWS_PER_BUCKET = 200_000


def default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition, bounded so the bucket expression stays small."""
    sp = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, min(1024, sp))


def sql_literal(v) -> str:
    """SQL text of a Python scalar (typed, so no decimal literals sneak in)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def bucket_sql(key: str, splits: list) -> str:
    """SQL of the number of ``splits`` strictly below ``key``, as a balanced binary search
    (log depth).  Built as text and parsed once: building a large expression node by node
    from Python costs one gateway call per node."""
    lits = [sql_literal(x) for x in splits]

    def build(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {key} <= {lits[mid]} THEN {build(lo, mid)} ELSE {build(mid + 1, hi)} END"
    return build(0, len(splits))


def bucket_expr(key: Column, splits: list) -> Column:
    """Column form of ``bucket_sql`` for a named key column."""
    return F.expr(bucket_sql(key._jc.toString(), splits))


def _group_sql(by: list[str], values) -> str:
    return " AND ".join(f"`{b}` <=> {sql_literal(v)}" for b, v in zip(by, values)) or "true"


def _join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str) -> DataFrame:
    """Join on group columns where null equals null."""
    names = {c: f"_r_{c}" for c in by}
    other = right.withColumnsRenamed(names)
    cond = [left[c].eqNullSafe(other[names[c]]) for c in by]
    return left.join(other, cond, how).drop(*names.values())


def running_totals(df: DataFrame, order_cols: list[str], value_cols: list[str],
                   by: list[str] | tuple = (), descending: bool = False,
                   n_buckets: int | None = None) -> DataFrame:
    """Append ``cum_<v>`` (inclusive running sum in sort order) and ``total_<v>`` per group.

    Rows are ordered by ``order_cols`` (the first one defines the buckets), ascending or
    descending, within each ``by`` group; null is a group of its own.
    """
    by = list(by)
    df = reuse(df)   # read twice: bucket boundaries, then the running sums
    if n_buckets is None:
        # buckets grow with the data (about _ROWS_PER_BUCKET rows each); the count also
        # materialises the persisted input
        n_rows = df.count()
        nb = max(1, min(default_buckets(df), math.ceil(n_rows / _ROWS_PER_BUCKET)))
    else:
        nb = n_buckets
    key = F.col(order_cols[0])
    if nb == 1:
        inline, groups = True, []
        b = df.withColumn("_b", F.lit(0))
    else:
        probs = [i / nb for i in range(1, nb)]
        accuracy = max(10_000, 20 * nb)
        splits = (df.where(key.isNotNull()).groupBy(*by)
                    .agg(F.percentile_approx(key, probs, accuracy).alias("_s")))
        # At most _INLINE_GROUPS rows come to the driver; more groups take the join path
        # below, where nothing is collected or broadcast.
        rows = splits.limit(_INLINE_GROUPS + 1).collect()
        inline = len(rows) <= _INLINE_GROUPS
        if inline:
            groups = [([r[b] for b in by], sorted(set(r["_s"] or []))) for r in rows]
            inline = sum(len(s) for _, s in groups) <= _INLINE_SPLIT_LIMIT

    if nb == 1:
        pass
    elif inline:
        kq = f"`{order_cols[0]}`"
        if not by:
            sql = bucket_sql(kq, groups[0][1] if groups else [])
        elif not groups:
            sql = "0"
        else:
            sql = "CASE " + " ".join(f"WHEN {_group_sql(by, vals)} THEN {bucket_sql(kq, s)}"
                                     for vals, s in groups) + " ELSE 0 END"
        b = df.withColumn("_b", F.expr(sql))
    else:
        sorted_splits = splits.select(*by, F.array_sort(F.array_distinct("_s")).alias("_s"))
        b = (_join_groups(df, sorted_splits, by, "left")
               .withColumn("_b", F.size(F.filter("_s", lambda s: s < key)))
               .drop("_s"))

    sums = b.groupBy(*by, "_b").agg(*[F.sum(v).alias(v) for v in value_cols])
    border = F.col("_b").desc() if descending else F.col("_b").asc()
    wg = (Window.partitionBy(*by) if by else Window).orderBy(border) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*by) if by else Window.partitionBy()
    offsets = sums.select(
        *by, "_b",
        *[(F.sum(v).over(wg) - F.col(v)).alias(f"_o_{v}") for v in value_cols],
        *[F.sum(v).over(wall).alias(f"total_{v}") for v in value_cols])
    # inline path: offsets has at most _INLINE_GROUPS x buckets rows -> bounded broadcast;
    # otherwise an ordinary (shuffle) join
    joined = _join_groups(b, F.broadcast(offsets) if inline else offsets, by + ["_b"], "inner")
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    w = Window.partitionBy(*by, "_b").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(v).over(w) + F.col(f"_o_{v}")).alias(f"cum_{v}") for v in value_cols],
        *[F.col(f"total_{v}") for v in value_cols])


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    by: list[str] | tuple = (), names: list[str] | None = None,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (the pandas / numpy default) per group.

    Missing values are skipped.  Output: ``by`` columns plus one double column per prob.
    """
    by = list(by)
    names = names or [f"q{i}" for i in range(len(probs))]
    v = F.col(value_col).cast("double")
    counts = (df.where(F.col(value_col).isNotNull())
                .groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    cum = running_totals(counts, ["_v"], ["_n"], by=by, n_buckets=n_buckets)
    n_tot, c, n = F.col("total__n"), F.col("cum__n"), F.col("_n")
    aggs = []
    for i, p in enumerate(probs):
        pos = (n_tot - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [
            F.max(F.when((c - n <= lo) & (lo < c), F.col("_v"))).alias(f"_lo{i}"),
            F.max(F.when((c - n <= hi) & (hi < c), F.col("_v"))).alias(f"_hi{i}"),
            F.max(pos - lo).alias(f"_f{i}"),
        ]
    agg = cum.groupBy(*by).agg(*aggs)
    return agg.select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(nm)
        for i, nm in enumerate(names)])


def hash_rank(df: DataFrame, key_cols: list[str], seed: int, by: list[str] | tuple = (),
              n_buckets: int | None = None) -> DataFrame:
    """Seeded pseudo-random order: 1-based ``_rank`` and group size ``_size`` per ``by`` group.

    The order is ``xxhash64(keys, seed)`` with the keys as tie-break, so it is
    deterministic and independent of partitioning.
    """
    h = F.xxhash64(*[F.col(k) for k in key_cols], F.lit(seed))
    with_h = df.withColumn("_h", h).withColumn("_one", F.lit(1))
    ranked = running_totals(with_h, ["_h", *key_cols], ["_one"], by=by, n_buckets=n_buckets)
    return ranked.withColumnRenamed("cum__one", "_rank").withColumnRenamed("total__one", "_size") \
        .drop("_one")
