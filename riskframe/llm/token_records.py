"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

A record is ``length u64 | masked crc32(length) u32 | payload | masked crc32(payload) u32``
and one line feed (Spark's line writer puts it there); numbers are little-endian.  The
payload is ``count u32 | width u8 | doc_id i64 | ids``, ids of ``width`` 2 or 4 bytes.  The
mask is ``rotate_right(crc, 15) + 0xA282EAD8``, so that a checksum of data that holds
checksums stays meaningful.  Files go through Spark's committed writers into the shared
folder, in ascending id order; ``build_index`` reads them back, verifies every checksum and
gives path, offset and length of each record for shuffled reads.

Encoding: byte-level BPE never merges across pre-tokens, so each slice of documents is cut
into pre-tokens at once in numpy (the tokenizer's own pattern; classes of characters are
asked of its pre-tokenizer) and every distinct piece is encoded once by the ``tokenizers``
library.  Vocabularies whose pre-tokenizer is another one go through the library whole.

Cases: null text is empty and gives the end id alone; repeated ids are separate records,
ordered by id, then text; a null id sorts first and is written as the least long; an empty
table gives empty results; extra columns are ignored.
"""
from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import local_threads, mix, shared_dir, slices, small_batches, utf8_column

#: UTF-8 bytes of text in one file, about.
FILE_BYTES = 8 << 20
#: Distinct pieces that a worker keeps encoded; beyond it starts anew.
CACHE_PIECES = 750_000
_NULL_ID = -(1 << 63)
_HEAD = "<IBq"


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


# Unicode White_Space beyond ASCII is learned from the pre-tokenizer, as all classes are.
_LETTER, _DIGIT, _SPACE, _OTHER = 1, 2, 3, 4


class PieceEncoder:
    """Encodes many texts at once, each distinct pre-token once.

    ``encode(raw, offsets)`` takes UTF-8 bytes and row offsets; it returns all ids and the
    number of ids of each row.
    """

    def __init__(self, path: str):
        local_threads()
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.split = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                      and spec.get("normalizer") is None and spec["model"]["type"] == "BPE")
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.kinds = np.zeros(0x110000, np.uint8)
        self._learn(np.arange(128))
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)     # sorted first hash
        self.check = np.zeros(0, np.uint64)     # second hash
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, points: np.ndarray) -> None:
        """Asks the pre-tokenizer for the class of characters."""
        cut = self.tok.pre_tokenizer.pre_tokenize_str if self.split else None
        for p in points.tolist():
            c = chr(p)
            kind = _SPACE
            if cut and not 0xD800 <= p < 0xE000:
                for probe, k in (("a", _LETTER), ("1", _DIGIT), ("!", _OTHER)):
                    if len(cut(probe + c)) == 1:
                        kind = k
                        break
            self.kinds[p] = kind

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        if not self.split or any(a in data for a in self.added):
            out = self.tok.encode_batch_fast([data[a:b].decode() for a, b in zip(off[:-1], off[1:])], add_special_tokens=False)
            ids = [np.asarray(x.ids, np.uint32) for x in out]
            return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), np.array([len(x) for x in ids], np.int64)
        n = len(raw)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        begin = self._pieces(raw, off, data)
        end = np.append(begin[1:], n)
        h1, h2 = self._hashes(raw, begin, end)
        k = self._find(h1, h2)
        if (k < 0).any():
            new = np.flatnonzero(k < 0)
            _, pick = np.unique(h1[new], return_index=True)
            self._add(data, begin[new[pick]], end[new[pick]], h1[new[pick]], h2[new[pick]])
            k = self._find(h1, h2)
        size = self.size[k]
        total = np.cumsum(size)
        where = np.repeat(self.at[k] - (total - size), size) + np.arange(total[-1])
        row = np.searchsorted(begin, off)       # a document starts at a piece
        upto = np.append(0, total)
        return self.ids[where], np.diff(upto[row])

    def _pieces(self, raw: np.ndarray, off: np.ndarray, data: bytes) -> np.ndarray:
        """Byte starts of the pre-tokens."""
        lead = np.flatnonzero((raw & 0xC0) != 0x80)             # bytes that start a character
        if len(lead) == len(raw):
            kind, char = self.kinds[raw], raw
        else:
            char = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
            kind = self.kinds[char]
            if (unknown := kind == 0).any():
                self._learn(np.unique(char[unknown]))
                kind = self.kinds[char]
        m = len(char)
        first = np.zeros(m + 1, bool)                           # starts of documents
        starts = np.searchsorted(lead, off[:-1])
        first[starts[starts < m]] = True
        first[m] = True
        run = first.copy()
        run[1:m] |= kind[1:] != kind[:-1]
        space = kind == _SPACE
        blank = char == 32
        begin = run[:m].copy()
        # of white space before something else, the last character stands alone or, if a blank, joins what follows
        tail = space & run[1:] & ~first[1:]
        begin |= tail
        joins = np.flatnonzero(tail & blank) + 1
        begin[joins] = False
        # contractions: an apostrophe that starts a token, then its letters
        mark = np.flatnonzero((char == 39) & begin)
        mark = mark[mark + 1 < m]
        mark = mark[(kind[mark + 1] == _LETTER) & ~first[mark + 1]]
        if len(mark):
            one = np.isin(char[mark + 1], np.frombuffer(b"stmd", np.uint8))
            second = np.minimum(mark + 2, m - 1)
            inside = (mark + 2 < m) & ~first[second]
            a, b = char[mark + 1], char[second]
            two = inside & ((a == 114) & (b == 101) | (a == 118) & (b == 101) | (a == 108) & (b == 108))
            for at, width in ((mark[one], 2), (mark[two], 3)):
                begin[at + 1] = False
                rest = at + width
                rest = rest[rest < m]
                begin[rest] = True
        return lead[np.flatnonzero(begin)]

    @staticmethod
    def _hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each piece, eight bytes at a time."""
        pad = np.zeros(len(raw) + 8, np.uint8)
        pad[:len(raw)] = raw
        eight = np.lib.stride_tricks.as_strided(pad.view(np.uint8), (len(raw), 8), (1, 1))
        size = (end - begin).astype(np.uint64)
        h1 = mix(size * np.uint64(0x9E3779B97F4A7C15))
        h2 = size + np.uint64(77)
        at, live = begin.copy(), np.arange(len(begin))
        left = end - begin
        while len(live):
            w = np.ascontiguousarray(eight[at]).view(np.uint64)[:, 0]
            short = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
            w = np.where(short > 0, (w << short) >> short, w)   # little-endian: drop what follows the piece
            h1[live] = mix(h1[live] ^ w)
            h2[live] = (h2[live] ^ w) * np.uint64(0xD1342543DE82EF95) + (h2[live] >> np.uint64(29))
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        return h1, h2

    def _find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h1), -1, np.int64)
        u, back = np.unique(h1, return_inverse=True)            # sorted probes walk the table in order
        k = np.minimum(np.searchsorted(self.known, u), len(self.known) - 1)
        k = np.where(self.known[k] == u, k, -1)[back]
        if (k >= 0).any() and not (self.check[k[k >= 0]] == h2[k >= 0]).all():
            raise ValueError("two pieces share a hash")
        return k

    def _add(self, data: bytes, begin: np.ndarray, end: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
        if len(self.known) and len(self.known) + len(h1) > CACHE_PIECES:
            self._clear()
            raise _CacheFull
        got_ids, got_size = [], []
        words = [data[a:b].decode() for a, b in zip(begin.tolist(), end.tolist())]
        for lo in range(0, len(words), 4096):
            part = words[lo:lo + 4096]
            enc = self.tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            got_ids.append(np.asarray(enc.ids, np.uint32))
            got_size.append(np.bincount(np.asarray(enc.word_ids, np.int64), minlength=len(part)))
        size = np.concatenate(got_size)
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *got_ids])
        place = np.searchsorted(self.known, h1)                 # h1 is sorted
        self.known, self.check = np.insert(self.known, place, h1), np.insert(self.check, place, h2)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)


class _CacheFull(Exception):
    pass


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_rows(enc: PieceEncoder, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    try:
        return enc.encode(raw, off)
    except _CacheFull:
        return enc.encode(raw, off)


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                  text_col: str = "text", path: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Writes every document's ids plus ``end_id``; returns the folder."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "records")
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width = 2 if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        kind = np.dtype("<u2" if width == 2 else "<u4")
        for b in batches:
            raw, off = utf8_column(b, "text")
            ids = b.column(0).to_pylist()
            for lo, hi in slices(off):
                got, size = encode_rows(enc, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                got = got.astype(kind).tobytes()
                tail = np.array([end_id], kind).tobytes()
                cut = np.append(0, np.cumsum(size)) * width
                out = []
                for i in range(hi - lo):
                    doc = ids[lo + i]
                    load = struct.pack(_HEAD, int(size[i]) + 1, width, _NULL_ID if doc is None else doc) + got[cut[i]:cut[i + 1]] + tail
                    head = struct.pack("<Q", len(load))
                    out.append(b"".join((head, struct.pack("<I", masked(zlib.crc32(head))), load,
                                         struct.pack("<I", masked(zlib.crc32(load))))))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    ordered = base.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
    with small_batches(spark):
        ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.text(path)
    return path


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every file: path, offset, length, id, ids (array of long).  A wrong
    checksum or a cut record raises."""
    return _read(spark, path, True)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """path, offset, length, id, n_tokens, ids_crc32 (of the ids as u32) of every record."""
    return _read(spark, path, False)


def parse(content: bytes) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(offset, length, id, ids) of the records of one file."""
    at = 0
    while at < len(content):
        head = content[at:at + 8]
        size = int.from_bytes(head, "little")
        if masked(zlib.crc32(head)) != int.from_bytes(content[at + 8:at + 12], "little"):
            raise ValueError(f"the length at {at} is damaged")
        load = content[at + 12:at + 12 + size]
        if len(load) < size or masked(zlib.crc32(load)) != int.from_bytes(content[at + 12 + size:at + 16 + size], "little"):
            raise ValueError(f"the record at {at} is damaged")
        n, width, doc = struct.unpack_from(_HEAD, load)
        yield at, size + 16, doc, np.frombuffer(load, f"<u{width}", n, struct.calcsize(_HEAD))
        at += size + 17


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = [(at, size, None if doc == _NULL_ID else doc, len(ids), zlib.crc32(u := ids.astype("<u4").tobytes()),
                         np.frombuffer(u, "<u4").astype(np.int64) if with_ids else None)
                        for at, size, doc, ids in parse(b.column(1)[i].as_py())]
                cols = list(zip(*rows)) if rows else [[]] * 6
                arrays = [pa.array([b.column(0)[i].as_py()] * len(rows), pa.string()),
                          *[pa.array(cols[k], pa.int64()) for k in range(5)]]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["path", "offset", "length", "id", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "path string, offset long, length long, id long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def with_starts(index: DataFrame) -> DataFrame:
    """``start``: the ids of all records before, in the order of files and offsets.

    Totals by file, then by block of 1,000 files: no window holds more than 1,000 rows of
    a block, a file's records, or the blocks.
    """
    files = index.groupBy("path").agg(F.sum("n_tokens").alias("n"))
    files = files.withColumn("file", F.regexp_extract("path", r"part-(\d+)", 1).cast("long")) \
        .withColumn("block", F.floor(F.col("file") / 1000))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", before("n", Window.orderBy("block")).alias("b0"))
    files = files.select("path", "block", before("n", Window.partitionBy("block").orderBy("file", "path")).alias("f0"))
    starts = files.join(blocks, "block").select("path", (F.col("b0") + F.col("f0")).alias("f0"))
    inside = before("n_tokens", Window.partitionBy("path").orderBy("offset"))
    return index.withColumn("start", inside).join(starts, "path").withColumn("start", F.col("start") + F.col("f0")).drop("f0")


def write_index(index: DataFrame, path: str) -> str:
    """The offset index, apart from the records."""
    index.write.parquet(path)
    return path
