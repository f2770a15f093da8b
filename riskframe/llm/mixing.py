"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the
whole size; a target stops at ``max_repeat`` times its source's size and the excess is
shared again by weight.  That fixed point is ``min(cap, level * weight)`` with one level,
found by running sums over the sources in order of cap / weight.

Sampling: within a source every document expects target / source size copies.  Documents
are ordered by size class (eighths of an octave), then by a hash of their id, so that the
words taken come near the target; a document is emitted once for every whole number that
the running sum of expected copies, shifted by one offset of the source, crosses.  Running
sums go by (source, class, salt) buckets of about ``bucket_rows`` rows: bucket counts are
summed first, so a source with a third of all rows is many windows.  The order, and with it
the result, doesn't depend on the number of salts.

Cases: null text has size 0; a source without words has target 0 and its documents no
copies; a null source is a source of its own; a null id is allowed; rows with equal id and
text are interchangeable; an empty table gives an empty result; input columns named like
a result column are replaced by it; other columns pass through.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, without

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEAT = 3
BUCKET_ROWS = 50_000
RESULTS = ("size", "source_size", "target", "copies", "taken")


def n_words(text: Column) -> Column:
    """Runs of anything but space and \\t to \\r; 0 for null."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def size_class(size: Column) -> Column:
    """Eighths of an octave: bit length, then the three bits below the highest."""
    bits = F.bin(size)
    return F.length(bits) * 8 + F.conv(F.rpad(F.substring(bits, 2, 3), 3, "0"), 2, 10).cast("int")


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source of (source, source_size): target and offset.  A few columns of
    one row per source, so its windows hold no documents."""
    w = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    t = sizes.withColumn("weight", (w % 3 + 1).cast("double"))
    t = t.withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    done = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    t = t.withColumn("level", (F.sum("source_size").over(every) - done) / left)
    # the level holds from the first source that its cap does not stop
    t = t.withColumn("open", F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"),
                                          F.col("cap") / F.col("weight"))).over(every))
    t = t.withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") == F.col("open"), F.col("level"))).over(every))
    target = F.when(F.col("open").isNull() | (F.col("cap") / F.col("weight") < F.col("open")), F.col("cap")) \
        .otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    seed = F.concat(F.lit("offset:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    shift = F.conv(F.substring(F.md5(seed), 1, 4), 16, 10).cast("double") / 65536
    return t.select("source", "source_size", target.alias("target"), shift.alias("shift"))


def allocate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             max_repeat: int = MAX_REPEAT, bucket_rows: int = BUCKET_ROWS, size: Column | None = None) -> DataFrame:
    """``docs`` with size, source_size, target (of the source), copies and taken (words)."""
    base = without(docs, *RESULTS)
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("long")
    rows = base.withColumns({"size": n_words(F.col(text_col)) if size is None else size, "_h": hashed,
                             "_key": F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))})
    rows = rows.withColumn("_class", size_class(F.col("size")))
    salts = max(1, math.ceil(base.count() / bucket_rows))
    rows = rows.withColumn("_salt", F.shiftright(F.col("_h") * salts, 32).cast("int"))

    buckets = staged(rows.groupBy("_key", F.col(source_col).cast("string").alias("source"), "_class", "_salt").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("size").alias("source_size")), max_repeat)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    classes = buckets.groupBy("_key", "_class").agg(F.sum("n").alias("n"))
    classes = classes.select("_key", "_class", before(Window.partitionBy("_key").orderBy("_class")).alias("c0"))
    offsets = buckets.select("_key", "_class", "_salt", before(Window.partitionBy("_key", "_class").orderBy("_salt")).alias("s0"))
    offsets = offsets.join(classes, ["_key", "_class"])
    t = targets.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_key"),
                       "source_size", "target", "shift")
    offsets = offsets.join(t, "_key").select("_key", "_class", "_salt", (F.col("c0") + F.col("s0")).alias("_before"),
                                             "source_size", "target", F.col("shift").alias("_shift"))

    place = Window.partitionBy("_key", "_class", "_salt").orderBy(
        "_h", F.col(id_col), F.xxhash64(F.col(text_col)))
    ranked = rows.withColumn("_rank", F.row_number().over(place)).join(offsets, ["_key", "_class", "_salt"])
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    k = F.col("_rank") + F.col("_before")
    copies = F.floor(k * each + F.col("_shift")) - F.floor((k - 1) * each + F.col("_shift"))
    out = ranked.withColumn("copies", F.least(copies, F.lit(max_repeat)).cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*base.columns, *RESULTS)


def emit(allocated: DataFrame) -> DataFrame:
    """Each document as many times as it has copies."""
    return allocated.where("copies > 0").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("_copy")
