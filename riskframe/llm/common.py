"""Helpers shared by the training-data operators (Arrow slices, hashing, shared folders)."""
from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy step works on; a longer document is a step of its own.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent (local tests) a temporary folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_BYTES`` at most for the jobs within: rows that carry texts or
    sets are wide, and a batch is held by the JVM and by the worker."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage
    with a copy that survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``staged`` frame that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without input columns that clash with an operator's own result columns."""
    own = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in own])


def utf8_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and row offsets of a string or binary column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64 if big else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least and at most ``rows``."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n, a + (rows or n))
        yield a, b
        a = b


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
_R = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**k and r**-k modulo 2**64 for k < n."""
    inv = pow(_R, -1, 1 << 64)
    out = []
    for base in (_R, inv):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run values[start:end], whatever its place."""
    size = 1 << max(20, int(len(values)).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[np.minimum(starts, size - 1)]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of ``member`` bytes; runs end with their row."""
    n = len(member)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = member[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    cut = np.zeros(n, bool)
    cut[first] = True
    starts = np.flatnonzero(member & (~prev | cut))
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = member[1:] & ~cut[1:]
    ends = np.flatnonzero(member & ~nxt) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h += words[j:j + m]
    return mix(h)


def local_threads() -> None:
    """One thread a task: Spark already runs a task for every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
