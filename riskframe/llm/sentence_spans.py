"""Substring dedup by sliding sentence spans.

A sentence ends at a line feed, or after ``. ! ?`` before white space or the text's end; of
its words (runs of ASCII letters and digits, A-Z lowered, and non-ASCII characters) those
in order count, so case, spaces and punctuation do not.  A sentence of ``CUT_WINDOW +
CUT_WORDS - 1`` words or more is also cut before the word run of least hash in every
``CUT_WINDOW`` (the last of equal ones): what is cut depends on the words beside it only, so
a passage is cut alike wherever it stands, but for its first 11 and last 12 words, and a
piece has 12 words at most.  A span is a run of pieces that just reaches ``min_words`` words,
counted on from the start of a piece or back from the end of one.  So a repeat of 46 words
holds a whole span, and a repeat of whole sentences that has ``min_words`` is covered whole.
Every span is hashed by its words (128 bits).  A first count exchanges 64 bits of each span
alone.  Those seen twice or more mark a bitmap, and only spans that it holds are exchanged
with their places: a second count by all 128 bits finds the first place of each span that
occurs twice (least id, then position), and the pieces of every other occurrence are removed.

The bitmap has ``BITS_EACH`` bits a repeated hash and ``MAX_BITS`` at most (16 MB, built by
Spark in pages of 4 KB), which bounds what is broadcast.  A full one lets more spans through
to the second count and changes no result.  Counts are combined before the shuffle, so a span
that a third of all documents share is one row per task; the join back to the occurrences is
by hash and may be split by Spark.

Cases: null or wordless text has no sentences and stays as it is, as do texts of fewer than
``min_words``; of an overlap with a first occurrence in the same text only what lies behind
it is removed; equal rows: the first occurrence is in the least (id, hash of the text), and
further equal rows lose their spans as copies only if their ids differ; an empty table gives
an empty result; input columns named like a result column are replaced by it; other columns
pass through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, discard, mix, slices, span_hashes, staged, utf8_column, window_hashes, without, word_bounds

MIN_WORDS = 12
#: Word runs of so many words are compared, so many beside each other, for cuts in long sentences.
CUT_WORDS = 3
CUT_WINDOW = 10
#: Bits of the bitmap for a repeated hash, and in all.
BITS_EACH = 4
MAX_BITS = 1 << 27
RESULTS = ("n_sentences", "n_removed", "clean_text")


def _word_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = True
    t[128:] = True
    return t


_WORD = _word_bytes()
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STOP = np.isin(np.arange(256), [33, 46, 63])


def _cuts(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Words that a long sentence is cut before, after the end of the one before; ``part`` is the sentence of each word."""
    run = window_hashes(words, CUT_WORDS)
    if len(run) < CUT_WINDOW:
        return np.zeros(0, np.int64)
    near = np.lib.stride_tricks.sliding_window_view(run, CUT_WINDOW)[:, ::-1]
    inside = np.flatnonzero(part[:len(near)] == part[CUT_WINDOW + CUT_WORDS - 2:])
    at = np.unique(inside + CUT_WINDOW - 1 - np.argmin(near[inside], axis=1))
    return at[np.append(-1, part)[at] == part[at]]            # a sentence's first word is cut before as it is


def sentences(raw: np.ndarray, off: np.ndarray):
    """Of texts side by side: row, start and end byte and word count of each piece (sentence
    or part of a long one), and the hash of each word.  A piece reaches from its first byte
    after the one before to its end."""
    low = LOWER[raw]
    n = len(low)
    ws, we, wrow = word_bounds(_WORD[low], off)
    words = span_hashes(low, ws, we)
    last = np.zeros(n + 1, bool)                              # a piece ends before this byte
    blank = np.append(_BLANK[low], True)
    stop = np.flatnonzero(_STOP[low])
    last[stop[blank[stop + 1]] + 1] = True
    last[np.flatnonzero(low == 10) + 1] = True
    last[off] = True
    cut = np.flatnonzero(last)
    last[we[_cuts(words, np.searchsorted(cut, ws, "right")) - 1]] = True
    cut = np.flatnonzero(last)
    part = np.searchsorted(cut, ws, "right") - 1              # of each word
    used, first, size = np.unique(part, return_index=True, return_counts=True)
    return wrow[first], cut[used], np.append(cut[1:], n)[used], size, words


def _spans(row: np.ndarray, size: np.ndarray, words: np.ndarray, min_words: int):
    """First piece, piece after the last, and two hashes of each span."""
    m = len(row)
    at = np.append(0, np.cumsum(size))                        # first word of each piece
    i = np.arange(m)
    on = np.searchsorted(at, at[:-1] + min_words)             # from each start, the piece after the last
    back = np.searchsorted(at, at[1:] - min_words, "right") - 1   # to each end, the first piece
    a, b = np.append(i, back), np.append(on, i + 1)
    ok = (a >= 0) & (b <= m)
    a, b = a[ok], b[ok]
    ok = row[a] == row[b - 1]
    a, b = np.divmod(np.unique(a[ok] * (m + 1) + b[ok]), m + 1)
    other = mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return a, b, *[span_hashes(x, at[a], at[b]).view(np.int64) for x in (words, other)]


def _repeats(hashes: DataFrame) -> np.ndarray:
    """Bitmap of a power of two of bits, with the low bits of each ``h1`` seen twice or more."""
    again = staged(hashes.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"), "span-repeats")
    bits = 1 << 15
    while bits < min(BITS_EACH * again.count(), MAX_BITS):
        bits *= 2
    bit = F.col("h1").bitwiseAND(F.lit(bits - 1)) + 1
    pages = again.groupBy(F.bitmap_bucket_number(bit).alias("page")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in pages.toLocalIterator():                         # at most MAX_BITS / 2**15 rows of 4 KB
        out[r.page - 1] = np.frombuffer(r.bits, np.uint8)
    discard(again)
    return out.ravel()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with n_sentences, n_removed and clean_text (the text without removed sentences)."""
    base = without(docs, *RESULTS, "_hash", "_gone")
    base = base.withColumn("_hash", F.xxhash64(F.col(text_col)))

    def found(b: pa.RecordBatch):
        """First and last row, row of each piece, and the spans, of each slice of a batch."""
        raw, off = utf8_column(b, "t")
        for lo, hi in slices(off):
            row, _, _, size, words = sentences(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            yield lo, hi, row, _spans(row, size, words, min_words)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for *_, (_, _, one, _) in found(b):
                yield pa.RecordBatch.from_arrays([pa.array(one)], names=["h1"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        low = np.int64(8 * len(marks) - 1)
        for b in batches:
            for lo, hi, row, spans in found(b):
                bit = spans[2] & low
                at, to, one, two = [x[marks[bit >> 3] >> (bit & 7) & 1 == 1] for x in spans]
                first = np.searchsorted(row, np.arange(hi - lo))
                k = pa.array(row[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(k), b.column(1).take(k), *[pa.array(x - first[row[at]], pa.int32()) for x in (at, to)], pa.array(one), pa.array(two)],
                    names=["id", "hash", "at", "to", "h1", "h2"])

    narrow = base.select(F.col(id_col).alias("id"), F.col("_hash").alias("hash"), F.col(text_col).alias("t"))
    kind = narrow.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_repeats(narrow.select("t").mapInArrow(hashes, "h1 long")))
    rows = narrow.mapInArrow(emit, f"id {kind}, hash long, at int, to int, h1 long, h2 long")
    seen = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "at", "to")).alias("first"))
    again = staged(seen.where("n > 1").drop("n"), "span-again")
    here = F.struct("id", "hash").eqNullSafe(F.struct("first.id", "first.hash"))
    gone = rows.join(again, ["h1", "h2"]).withColumn("at", F.when(here, F.greatest("at", "first.to")).otherwise(F.col("at")))
    gone = gone.where("at < to").groupBy("id", "hash").agg(F.collect_set(F.struct("at", "to")).alias("_gone")).withColumnsRenamed({"id": "_id", "hash": "_h"})
    out = base.join(gone, F.col(id_col).eqNullSafe(F.col("_id")) & F.col("_hash").eqNullSafe(F.col("_h")), "left").drop("_id", "_h", "_hash")
    keep = [c for c in out.columns if c != "_gone"]
    schema = out.select(*keep, F.lit(0).cast("long").alias("n_sentences"), F.lit(0).cast("long").alias("n_removed"),
                        F.col(text_col).alias("clean_text")).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8_column(b, text_col)
            text = b.column(b.schema.get_field_index(text_col))
            hits = b.column(b.schema.get_field_index("_gone")).to_pylist()
            n_all, n_gone, clean = [], [], []
            for lo, hi in slices(off):
                part = raw[off[lo]:off[hi]]
                row, start, end, _, _ = sentences(part, off[lo:hi + 1] - off[lo])
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                data = part.tobytes()
                for r in range(hi - lo):
                    n_all.append(int(first[r + 1] - first[r]))
                    if not hits[lo + r]:
                        n_gone.append(0)
                        clean.append(text[lo + r].as_py())
                        continue
                    drop = np.zeros(n_all[-1] + 1, np.int64)
                    np.add.at(drop, [x["at"] for x in hits[lo + r]], 1)
                    np.add.at(drop, [x["to"] for x in hits[lo + r]], -1)
                    drop = np.flatnonzero(np.cumsum(drop))
                    n_gone.append(len(drop))
                    at, kept = int(off[lo + r] - off[lo]), []
                    for i in (drop + first[r]).tolist():
                        kept.append(data[at:start[i]])
                        at = int(end[i])
                    kept.append(data[at:int(off[lo + r + 1] - off[lo])])
                    clean.append(b"".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in keep]
                + [pa.array(n_all, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(clean, pa.string())], names=[*keep, *RESULTS])
    return out.mapInArrow(apply, schema)
