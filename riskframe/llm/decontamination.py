"""Benchmark decontamination: a broadcast set of normalised test n-grams.

Words are runs of ASCII digits and letters (A-Z lowered) and non-ASCII characters.  An
item's windows are its ``n`` consecutive words; a shorter item with words is one window.
The distinct windows are gathered in chunks of at most ``max_windows`` (the size is counted
first); every chunk is broadcast and scanned in a map-only pass that adds to the hits of
the pass before, so a benchmark of any size works with bounded memory and no shuffle of
the documents.  Hash hits are verified against the window's words.

Cases: null or wordless text has no words and no hits; an item without words has no
windows; repeated documents, items and ids are judged row by row; empty tables give empty
results; input columns named like a result column are replaced by it; other columns pass
through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, slices, span_hashes, staged, utf8_column, window_hashes, without, word_bounds

N_WORDS = 13
#: Windows in one broadcast chunk (about 100 bytes each).
MAX_WINDOWS = 200_000
RESULTS = ("n_words", "n_hit", "hit_items", "hit_spans", "contaminated")


def _is_word() -> np.ndarray:
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = True
    t[128:] = True
    return t


_WORD = _is_word()


def _words(raw: np.ndarray, off: np.ndarray):
    low = LOWER[raw]
    s, e, row = word_bounds(_WORD[low], off)
    return low, s, e, row


def benchmark_windows(benchmark: DataFrame, n: int = N_WORDS, item_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """Distinct (window, item): the words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8_column(b, "t")
            items = b.column(0).to_pylist()
            out_w, out_i = [], []
            low, s, e, row = _words(raw, off)
            data = low.tobytes()
            for i, item in enumerate(items):
                k = np.flatnonzero(row == i)
                w = [data[s[j]:e[j]] for j in k]
                for a in range(max(1, len(w) - n + 1) if w else 0):
                    out_w.append(b" ".join(w[a:a + n]))
                    out_i.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(out_w, pa.binary()), pa.array(out_i, pa.string())],
                                             names=["w", "item"])
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "w binary, item string").where("item is not null").distinct()


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted strings), hit_spans (word runs
    [first, last] that windows cover, with byte offsets) and contaminated (``n_hit > 0``
    and at least 5 % of the words)."""
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, n, item_col, item_text_col).groupBy("w").agg(
        F.array_sort(F.collect_set("item")).alias("items")).persist()
    total = windows.count()
    chunks = max(1, -(-total // max_windows))
    base = without(docs, *RESULTS, "_hit", "_bytes")
    out = base.withColumns({"n_words": F.lit(0).cast("long"), "_hit": F.lit(b""), "_bytes": F.lit(b""),
                            "hit_items": F.array().cast("array<string>")})
    spans = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("word", "words", "byte", "bytes")]))
    fin = T.StructType([*[f for f in out.schema.fields if f.name not in ("_hit", "_bytes")],
                        T.StructField("n_hit", T.LongType()), T.StructField("hit_spans", spans)])
    for c in range(chunks):
        part = windows.where(F.pmod(F.xxhash64("w"), F.lit(chunks)) == c) if chunks > 1 else windows
        index = {bytes(r["w"]): list(r["items"]) for r in part.toLocalIterator()}
        shared = spark.sparkContext.broadcast(index)
        step = _scanner(shared, text_col)
        if c < chunks - 1:                                               # one chunk's dictionary at a time
            out = staged(out.mapInArrow(step, out.schema), "decontamination")
            shared.unpersist()
        else:
            out = out.mapInArrow(lambda batches: _finish(step(batches)), fin)
    windows.unpersist()
    return out.withColumn("hit_items", F.array_sort("hit_items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def _index_arrays(index: dict[bytes, list[str]]):
    """By window length in words: a bit table and the sorted hashes."""
    by: dict[int, list[bytes]] = {}
    for w in index:
        by.setdefault(w.count(b" ") + 1, []).append(w)
    out = {}
    for length, ws in by.items():
        raw = np.frombuffer(b"\n".join(ws), np.uint8)
        s, e, _ = word_bounds(_WORD[raw], np.array([0, len(raw)]))
        h = np.sort(window_hashes(span_hashes(raw, s, e), length)[::length])
        table = np.zeros(1 << 20, bool)
        table[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        out[length] = (table, h)
    return out


def _scanner(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        arrays = _index_arrays(index)
        for b in batches:
            raw, off = utf8_column(b, text_col)
            words, hits, places, items = [], [], [], []
            old = {k: b.column(b.schema.get_field_index(k)).to_pylist() for k in ("_hit", "_bytes", "hit_items")}
            for lo, hi in slices(off):
                base = off[lo]
                o = off[lo:hi + 1] - base
                low, s, e, row = _words(raw[base:off[hi]], o)
                counts = np.bincount(row, minlength=hi - lo)
                first = np.concatenate([[0], np.cumsum(counts)])
                words += counts.tolist()
                wh = span_hashes(low, s, e)
                found: dict[int, set] = {}
                cover: dict[int, list] = {}
                data = None
                for length, (table, known) in arrays.items():
                    h = window_hashes(wh, length)
                    at = np.flatnonzero(table[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                    at = at[row[at] == row[at + length - 1]]
                    k = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
                    for p in at[known[k] == h[at]].tolist():
                        data = data if data is not None else low.tobytes()
                        got = index.get(b" ".join(data[s[q]:e[q]] for q in range(p, p + length)))
                        if got is not None:
                            r = int(row[p])
                            found.setdefault(r, set()).update(got)
                            cover.setdefault(r, []).append((p, p + length))
                for r in range(hi - lo):
                    hit, place, had = old["_hit"][lo + r], old["_bytes"][lo + r], old["hit_items"][lo + r]
                    if r in found:
                        at = np.unique(np.concatenate([np.arange(*x) for x in cover[r]]))
                        prior = np.frombuffer(hit, np.int64)
                        mine = at - first[r]
                        merged, pick = np.unique(np.concatenate([prior, mine]), return_index=True)
                        ends = np.concatenate([np.frombuffer(place, np.int64).reshape(-1, 2),
                                               np.stack([s[at] - o[r], e[at] - o[r]], 1)])[pick]
                        hit, place = merged.tobytes(), ends.astype(np.int64).tobytes()
                        had = sorted(found[r] | set(had))
                    hits.append(hit)
                    places.append(place)
                    items.append(had)
            new = {"n_words": pa.array(words, pa.int64()), "_hit": pa.array(hits, pa.binary()),
                   "_bytes": pa.array(places, pa.binary()), "hit_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(n, b.column(i)) for i, n in enumerate(b.schema.names)],
                                             names=b.schema.names)
    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hit counts and maximal hit runs from the packed word numbers."""
    for b in batches:
        n_hit, spans = [], []
        col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        for hit, place in zip(col["_hit"].to_pylist(), col["_bytes"].to_pylist()):
            at = np.frombuffer(hit, np.int64)
            n_hit.append(len(at))
            if not len(at):
                spans.append([])
                continue
            ends = np.frombuffer(place, np.int64).reshape(-1, 2)
            cut = np.flatnonzero(np.diff(at) != 1) + 1
            a, z = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
            spans.append([{"word": int(at[i]), "words": int(at[j] - at[i] + 1), "byte": int(ends[i, 0]),
                           "bytes": int(ends[j, 1] - ends[i, 0])} for i, j in zip(a, z)])
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("word", "words", "byte", "bytes")]))
        keep = [n for n in b.schema.names if n not in ("_hit", "_bytes")]
        yield pa.RecordBatch.from_arrays([col[n] for n in keep] + [pa.array(n_hit, pa.int64()), pa.array(spans, kind)],
                                         names=[*keep, "n_hit", "hit_spans"])


def remove_documents(scanned: DataFrame) -> DataFrame:
    """Rows that are not contaminated."""
    return scanned.where(~F.col("contaminated"))


def remove_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """The text without its hit runs (all other characters stay); null stays null."""
    raw = F.col(text_col).cast("binary")
    size = F.octet_length(F.col(text_col))
    parts = F.aggregate(
        "hit_spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("kept")),
        lambda acc, s: F.struct((s["byte"] + s["bytes"]).alias("at"), F.concat(
            acc["kept"], F.substring(raw, (acc["at"] + 1).cast("int"), (s["byte"] - acc["at"]).cast("int"))).alias("kept")),
        lambda acc: F.concat(acc["kept"], F.substring(raw, (acc["at"] + 1).cast("int"), size)))
    return scanned.withColumn(text_col, F.when(F.size("hit_spans") > 0, parts.cast("string")).otherwise(F.col(text_col)))
