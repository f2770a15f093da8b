"""Exact removal of repeated byte strings by suffix arrays.

A byte goes if a ``length``-byte string that covers it starts anywhere else, in the same
text or another; strings are judged on the input, and matches never cross texts.

1. Every window of ``length`` bytes has an anchor: the 64-byte gram in it of least hash
   (the rightmost of equals).  Equal windows have equal anchors at equal offsets, so windows
   are cut into pieces, one for each run of windows with the same anchor place, and only
   pieces whose anchor occurs at two places or more can hold a repeat.  Nothing is lost.
2. Equal pieces are one; all windows of a piece that occurs twice or more are repeats.
3. Different pieces of one anchor are compared by suffix arrays.  A shard holds the pieces
   of many anchors; an anchor with more pieces than a shard takes is dealt to several.
   A shard's array is built by Larsson-Sadakane refinement (groups that share a prefix are
   refined by the rank of what follows, doubling its length; finished suffixes drop out),
   common prefixes by Kasai's rule (the common prefix of the next suffix is shorter by one
   at most), advanced for all pieces in step.
4. Shards of one anchor are merged by binary search: each gives its sorted distinct windows
   by offset from the anchor, as 128-bit digests, and windows found in another shard's
   list are repeats.

Cases: null is the empty text; texts shorter than ``length`` keep everything; equal rows
count as copies of each other; repeated ids with different texts are different texts; an
empty table gives an empty result; input columns named like a result column are replaced by
it; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, staged, utf8_column, without

LENGTH = 400
GRAM = 64
#: Bytes of a long text that one numpy step works on; steps overlap by a window.
STEP = 1 << 20
#: Bytes of pieces in one suffix array, about, and pieces of one anchor in it at most.
SHARD_BYTES = 1 << 20
SHARD_PIECES = 1500
RESULTS = ("n_bytes", "n_removed", "n_spans", "removed", "kept")
_LOW = np.uint64((1 << 24) - 1)


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of one text (or step of it): anchor hash, anchor place, first and last window."""
    n = len(raw)
    pad = np.zeros(n + 8, np.uint8)
    pad[:n] = raw
    h = np.ascontiguousarray(np.lib.stride_tricks.as_strided(pad, (n, 8), (1, 1))).view(np.uint64)[:, 0]
    size = 8
    h = mix(h)
    while size < GRAM:                                       # the hash of twice the bytes from two hashes
        m = n - 2 * size + 1
        h = mix(h[:m] * np.uint64(0x9E3779B97F4A7C15) + h[size:size + m])
        size *= 2
    m = n - GRAM + 1
    h = h[:m]
    # least hash, then rightmost place, in the low bits
    key = (h & ~_LOW) | (_LOW - np.arange(m, dtype=np.uint64))
    w = length - GRAM + 1
    blocks = -(-m // w)
    full = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    full[:m] = key
    grid = full.reshape(blocks, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(right[:windows], left[w - 1:w - 1 + windows])
    start = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    place = (_LOW - (least[start] & _LOW)).astype(np.int64)
    return h[place], place, start, np.append(start[1:], windows) - 1


def text_pieces(raw: np.ndarray, length: int) -> Iterator[tuple]:
    """The pieces of a text, by steps that share no window."""
    windows = len(raw) - length + 1
    for lo in range(0, max(windows, 0), STEP):
        part = raw[lo:min(len(raw), lo + STEP + length - 1)]
        v, place, a, b = anchors(part, length)
        yield v, place + lo, a + lo, b + lo


def _pieces(docs: DataFrame, length: int) -> DataFrame:
    """(v, place, p1, p2, id, text, a, b): one row per piece; p1, p2 digest its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8_column(batch, "t")
            out = [[] for _ in range(6)]
            rows, held = [], 0
            for r in range(batch.num_rows + 1):
                if held >= 20_000 or r == batch.num_rows and held:
                    k = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(np.int64, copy=False)) for c in out]
                        + [batch.column(0).take(k), batch.column(1).take(k)], names=["v", "p1", "p2", "at", "a", "b", "id", "text"])
                    out, rows, held = [[] for _ in range(6)], [], 0
                if r == batch.num_rows:
                    break
                one = raw[off[r]:off[r + 1]]
                data = one.tobytes() if len(one) >= length else b""
                for v, place, a, b in text_pieces(one, length):
                    d = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[x:y + length]) for x, y in zip(a.tolist(), b.tolist())]), np.int64)
                    for c, x in zip(out, (v.view(np.int64), d[::2], d[1::2], place - a, a, b)):
                        c.append(x)
                    rows.append(np.full(len(v), r))
                    held += len(v)
    return docs.mapInArrow(run, "v long, p1 long, p2 long, at long, a long, b long, id string, text long")


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``s`` sorted, and their ranks."""
    n = len(s)
    pad = np.zeros(n + 8, np.uint8)
    pad[:n] = s
    key = np.ascontiguousarray(np.lib.stride_tricks.as_strided(pad, (n, 8), (1, 1))).view(">u8")[:, 0].astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    new = np.append(True, key[sa[1:]] != key[sa[:-1]])
    rank = np.empty(n, np.int64)
    # the rank of a group is its first place, so a finished suffix never changes
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    at = np.arange(n)                                       # places of the array whose suffix shares its group
    while len(at := at[~(new & np.append(new[1:], True))]):
        own = sa[at]
        tail = np.where(own + h < n, rank[np.minimum(own + h, n - 1)] + 1, 0)
        group = rank[own]
        order = np.argsort(group * (n + 1) + tail, kind="stable")
        own, group, tail = own[order], group[order], tail[order]
        new = np.append(True, (group[1:] != group[:-1]) | (tail[1:] != tail[:-1]))
        sa[at] = own
        rank[own] = np.maximum.accumulate(np.where(new, at, 0))
        h *= 2
    return sa, rank


def kasai(s: np.ndarray, sa: np.ndarray, rank: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix, up to ``limit``, of the suffixes from ``starts`` to ``ends`` of each
    piece with the one before in ``sa``; all pieces advance by one byte in step, and bytes
    are compared by eights."""
    n = len(s)
    pad = np.zeros(n + limit + 16, np.uint8)
    pad[:n] = s
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(pad, (n + limit + 8, 8), (1, 1))).view("<u8")[:, 0]
    lcp = np.zeros(n, np.int32)
    h = np.zeros(len(starts), np.int64)
    for p in range(int((ends - starts).max()) if len(starts) else 0):
        lane = np.flatnonzero(starts + p < ends)
        i = starts[lane] + p
        r = rank[i]
        j = sa[np.maximum(r - 1, 0)]
        k = np.maximum(h[lane] - 1, 0)
        go = np.arange(len(lane))
        while len(go):
            differ = eight[i[go] + k[go]] ^ eight[j[go] + k[go]]
            low = differ & (~differ + np.uint64(1))           # its lowest bit tells the first byte that differs
            equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 3)
            k[go] += equal
            go = go[(equal == 8) & (k[go] < limit)]
        # the end of the array is no byte to agree on
        k = np.where(r > 0, np.minimum(np.minimum(k, limit), n - np.maximum(i, j)), 0)
        h[lane] = k
        lcp[r] = k
    return lcp


def shard_repeats(pieces: list[bytes], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Which windows of each piece occur elsewhere in the shard; and, of the windows that
    occur, one place each (piece, window)."""
    sizes = np.array([len(p) for p in pieces])
    starts = np.append(0, np.cumsum(sizes + 1))[:-1]
    s = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)     # no UTF-8 text has this byte
    sa, rank = suffix_array(s)
    lcp = kasai(s, sa, rank, starts, starts + sizes - length + 1, length)   # of windows only
    like = lcp >= length
    twice = np.zeros(len(s), bool)
    twice[sa] = like | np.append(like[1:], False)
    inside = np.zeros(len(s), bool)
    for a, z in zip(starts.tolist(), sizes.tolist()):
        inside[a:a + z - length + 1] = True
    first = sa[~like]
    first = first[inside[first]]
    piece = np.searchsorted(starts, first, "right") - 1
    return [twice[a:a + z - length + 1] for a, z in zip(starts.tolist(), sizes.tolist())], piece, first - starts[piece]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _shard(length: int):
    names = ["v", "p1", "p2", "a", "b", "offset", "part", "digests", "owners"]

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[], [], [], [], [], []]
        for t in batches:
            for c, name in zip(cols, ("v", "p1", "p2", "at", "parts", "bytes")):
                c += t.column(t.schema.get_field_index(name)).to_pylist()
        v, p1, p2, at, parts, data = cols
        flags, piece, window = shard_repeats(data, length)
        rows = [(v[i], p1[i], p2[i], int(a), int(b)) for i, f in enumerate(flags) for a, b in zip(*runs(f))]
        blank = [None] * len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            + [pa.array(blank, pa.int64()), pa.array(blank, pa.int64()), pa.array(blank, pa.binary()), pa.array(blank, pa.binary())],
            names=names)
        if max(parts) == 1:
            return
        # an anchor of several shards: its distinct windows, sorted, by offset from the anchor
        offset = np.array(at)[piece] - window
        order = np.argsort(offset, kind="stable")
        piece, window, offset = piece[order], window[order], offset[order]
        cut = np.append(np.flatnonzero(np.append(True, offset[1:] != offset[:-1])), len(offset))
        for lo, hi in zip(cut[:-1], cut[1:]):
            d = [(xxhash.xxh3_128_digest(data[i][w:w + length]), i) for i, w in zip(piece[lo:hi].tolist(), window[lo:hi].tolist())]
            d.sort()
            own = np.array([(p1[i], p2[i], at[i], f) for (_, i), f in zip(d, [flags[i][at[i] - offset[lo]] for _, i in d])], np.int64)
            none = pa.array([None], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0]], pa.int64()), none, none, none, none, pa.array([int(offset[lo])], pa.int64()),
                 pa.array([key[1].as_py()], pa.int64()), pa.array([b"".join(x for x, _ in d)], pa.binary()),
                 pa.array([own.tobytes()], pa.binary())], names=names)
    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of one anchor and offset that several shards have, by binary search of each
    shard's sorted list in the others'."""
    lists, owners = [], []
    for t in batches:
        for d, o in zip(t.column(t.schema.get_field_index("digests")), t.column(t.schema.get_field_index("owners"))):
            lists.append(np.frombuffer(d.as_buffer(), "S16"))
            owners.append(np.frombuffer(o.as_buffer(), np.int64).reshape(-1, 4))
    every = np.sort(np.concatenate(lists))
    found = [o[(np.searchsorted(every, d, "right") - np.searchsorted(every, d, "left")) > 1] for d, o in zip(lists, owners)]
    got = np.concatenate(found)
    w = got[:, 2] - key[1].as_py()
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), key[0].as_py())), pa.array(got[:, 0]), pa.array(got[:, 1]),
                                      pa.array(w), pa.array(w + 1)], names=["v", "p1", "p2", "a", "b"])


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(id, text, a, b): runs [a, b) of windows that occur elsewhere; ``docs`` is (id
    string, text: hash of the text, t)."""
    pieces = _pieces(docs, length)
    shared = pieces.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("p1").alias("low"), F.max("p1").alias("high")).where("n > 1")
    pieces = staged(pieces.join(shared.select("v", (F.col("low") != F.col("high")).alias("differ")), "v"), "suffix-pieces")
    kinds = pieces.groupBy("v", "p1", "p2", "differ").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "text", "a", "b", "at")).alias("one"))
    kinds = staged(kinds, "suffix-kinds")
    whole = kinds.where("n > 1").select("v", "p1", "p2", F.lit(0).cast("long").alias("a"),
                                        (F.col("one.b") - F.col("one.a") + 1).alias("b"))

    # the bytes of the pieces to compare
    open_kinds = kinds.where("differ")
    many = open_kinds.groupBy("v").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("one.b") - F.col("one.a") + length).alias("bytes"))
    size = many.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    cut = open_kinds.join(many.select("v", F.ceil(F.col("kinds") / SHARD_PIECES).alias("parts")), "v")
    cut = cut.groupBy(F.col("one.id").alias("id"), F.col("one.text").alias("text")).agg(
        F.collect_list(F.struct("v", "p1", "p2", "parts", F.col("one.at").alias("at"), F.col("one.a").alias("a"),
                                F.col("one.b").alias("b"))).alias("cuts"))
    texts = docs.join(cut, docs["id"].eqNullSafe(cut["id"]) & (docs["text"] == cut["text"])).select("cuts", F.col("t").cast("binary").alias("t"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, cuts = batch.column(1)[i].as_py() or b"", batch.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[k] for c in cuts], pa.int64()) for k in ("v", "p1", "p2", "parts", "at")]
                    + [pa.array([data[c["a"]:c["b"] + length] for c in cuts], pa.binary())],
                    names=["v", "p1", "p2", "parts", "at", "bytes"])

    cuts = texts.mapInArrow(extract, "v long, p1 long, p2 long, parts long, at long, bytes binary")
    cuts = cuts.dropDuplicates(["v", "p1", "p2"])               # rows may have been equal
    shard = F.when(F.col("parts") > 1, F.col("v")).otherwise(F.pmod(F.xxhash64("v"), F.lit(shards)))
    cuts = cuts.withColumns({"shard": shard, "part": F.when(F.col("parts") > 1, F.pmod(F.col("p2"), F.col("parts")) + 1).otherwise(0)})
    told = staged(cuts.groupBy("shard", "part").applyInArrow(
        _shard(length), "v long, p1 long, p2 long, a long, b long, offset long, part long, digests binary, owners binary"), "suffix-shards")
    merged = told.where("digests is not null").groupBy("v", "offset").applyInArrow(_merge, "v long, p1 long, p2 long, a long, b long")
    found = whole.union(told.where("p1 is not null").select("v", "p1", "p2", "a", "b")).union(merged)
    found = found.groupBy("v", "p1", "p2").agg(F.collect_set(F.struct("a", "b")).alias("found"))
    rows = pieces.join(found, ["v", "p1", "p2"])
    rows = rows.select("id", "text", "a", F.explode("found").alias("f"))
    return rows.select("id", "text", (F.col("a") + F.col("f.a")).alias("a"), (F.col("a") + F.col("f.b")).alias("b"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_removed, n_spans, removed (array of
    start, end in bytes) and kept (the remaining bytes)."""
    base = without(docs, *RESULTS, "_id", "_hash")
    base = base.withColumns({"_id": F.col(id_col).cast("string"), "_hash": F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0).cast("long"))})
    narrow = base.select(F.col("_id").alias("id"), F.col("_hash").alias("text"), F.col(text_col).alias("t"))
    found = repeated_windows(narrow, length).groupBy("id", "text").agg(F.collect_list(F.struct("a", "b")).alias("_found"))
    found = found.withColumnsRenamed({"id": "_i", "text": "_h"})
    rows = base.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left").drop("_id", "_hash", "_i", "_h")
    keep = [c for c in rows.columns if c not in (text_col, "_found")]
    schema = rows.select(*keep, F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                         F.lit(0).cast("long").alias("n_spans"),
                         F.expr("array(struct(0L as start, 0L as end))").alias("removed"), F.lit(b"").alias("kept")).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8_column(batch, text_col)
            hits = batch.column(batch.schema.get_field_index("_found"))
            sizes, gone, spans, lists, kept = [], [], [], [], []
            for r in range(batch.num_rows):
                one = raw[off[r]:off[r + 1]]
                a, b = [], []
                if hits[r].is_valid:
                    s = hits[r].values
                    x, y = s.field("a").to_numpy(), s.field("b").to_numpy() + length - 1
                    d = np.zeros(len(one) + 1, np.int64)
                    np.add.at(d, x, 1)
                    np.add.at(d, y, -1)
                    cover = np.cumsum(d[:-1]) > 0
                    a, b = runs(cover)
                    kept.append(one[~cover].tobytes())
                else:
                    kept.append(one.tobytes())
                sizes.append(len(one))
                gone.append(len(one) - len(kept[-1]))
                spans.append(len(a))
                lists.append([{"start": int(p), "end": int(q)} for p, q in zip(a, b)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(lists, kind),
                   pa.array(kept, pa.binary())], names=[*keep, *RESULTS])
    return rows.mapInArrow(apply, schema)
