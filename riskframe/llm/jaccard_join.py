"""N-gram Jaccard join: rare-first prefix filtering, then each candidate pair verified once.

A document's set is its distinct ``n``-word shingles (words: runs of anything but space and
\\t to \\r, A-Z lowered; a shorter text is one shingle).  Two sets link when
``100 * intersection >= percent * union``.

1. Shingle occurrences of all documents are counted in a table of cells, about one for four
   text bytes and ``2**SKETCH_BITS`` at most (8 MB to broadcast).  Cell count, by eighths of
   an octave, then hash, is the order of shingles, rare ones first; any order gives right
   results, this one keeps common passages out of the prefixes.
2. Equal sets are one node, named by a 96-bit digest.  Linked sets share a shingle among
   their first ``size - ceil(size * percent / 100) + 1``.  Prefix entries travel packed, one
   row per task and hash bucket, and buckets keep the shingles of two nodes or more, and of
   these the entries whose length, or place in a group of two, allows a link in the group.
   Near copies share many shingles and would meet once for each: groups of the same nodes are
   one, that of the first of their shingles, which any pair that links has in common too.
3. In every group of a shingle one node, that with the most entries in common with others,
   is paired with the others that pass the filters of step 4; the pairs are verified and
   joined up to components.  Edited copies link with their original more than with each
   other, and the original shares the most, so a group of m near copies costs about m
   pairs.
4. What remains are pairs in a group whose nodes are in different components: a self-join
   by shingle with length, positional and suffix filters.  Sets are split into four hash
   ranges; the common part is at most the sum of the lesser counts.  And a set has a parity
   for each of ``64 * SIG_LONGS`` hash classes: the parities that differ are at most the
   members that differ.  A set of more members has parities of as many more classes, which
   are compared once for every pair left.  Of these pairs, each node's most promising one (fewest differing
   parities for its size) is verified first; pairs whose nodes are in one component by then
   need no verification, all others are verified.  Each pair is verified once at most, and
   no link between different components is lost.

Cases: null, empty or wordless text has an empty set, size 0, and is its own component;
repeated rows and equal texts are in one component; a null id counts as no id (a component
of such rows only has a null id); empty tables give empty results; input columns named
like a result column are replaced by it; other columns pass through.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, discard, mix, slices, span_hashes, staged, utf8_column, window_hashes, without, word_bounds
from .components import components

N_WORDS = 5
PERCENT = 75
#: The count table has at most 2 to this power cells, of a byte each where it is broadcast.
SKETCH_BITS = 23
#: Text bytes whose prefix entries make up one bucket, about.
BUCKET_BYTES = 8 << 20
FLUSH_ENTRIES = 1 << 18
#: Digests of the sets that a task has seen, so that copies within a task have entries once.
SEEN_SETS = 200_000
#: Bytes of a node's name: 1e-11 chances of two equal ones among 1e9 sets, and four bytes less an entry than 16.
NODE_BYTES = 12
#: Longs of a set's parities.
SIG_LONGS = 8
#: Hash classes of a set's long parities at most.
WIDE_CLASSES = 1 << 24
_QUARTERS = ("q0", "q1", "q2", "q3")
_PARITIES = tuple(f"g{i}" for i in range(SIG_LONGS))
RESULTS = ("n_shingles", "component_id")
_ENTRY = (("h", np.uint64), ("s1", np.uint64), ("s2", np.uint32), ("n", np.uint32), ("pos", np.uint32))


def _spaces() -> np.ndarray:
    t = np.ones(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = False
    return t


_WORD = _spaces()


def shingle_rows(raw: np.ndarray, off: np.ndarray, n: int = N_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each row, in order, and the rows' bounds among them."""
    low = LOWER[raw]
    s, e, row = word_bounds(_WORD[low], off)
    words = span_hashes(low, s, e)
    count = np.bincount(row, minlength=len(off) - 1)
    first = np.append(0, np.cumsum(count))
    h = window_hashes(words, n)
    at = np.flatnonzero(row[:len(h)] == row[n - 1:]) if len(h) else np.zeros(0, np.int64)
    out_h, out_row = h[at], row[at]
    for r in np.flatnonzero((count > 0) & (count < n)).tolist():    # one short shingle
        one = window_hashes(words[first[r]:first[r + 1]], int(count[r]))
        out_h, out_row = np.append(out_h, one ^ np.uint64(count[r])), np.append(out_row, r)
    order = np.argsort(out_row, kind="stable")
    return out_h[order], np.append(0, np.cumsum(np.bincount(out_row, minlength=len(off) - 1)))


def _sets(batch: pa.RecordBatch, name: str, n: int) -> Iterator[np.ndarray]:
    """The sorted set of every row of a batch."""
    raw, off = utf8_column(batch, name)
    for lo, hi in slices(off):
        h, cut = shingle_rows(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], n)
        for r in range(hi - lo):
            yield np.unique(h[cut[r]:cut[r + 1]])


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signature(s: np.ndarray) -> np.ndarray:
    """For the suffix filters: members of the set in each quarter of the hashes, and the
    parity of its members in each hash class, packed into longs."""
    quarter = np.diff(np.searchsorted(s, np.arange(1, 4, dtype=np.uint64) << np.uint64(62)), prepend=0, append=len(s))
    classes = 64 * SIG_LONGS
    count = np.bincount(((s >> np.uint64(40)) % np.uint64(classes)).astype(np.int64), minlength=classes)
    return np.append(quarter.astype(np.int64), np.packbits(count & 1).view(np.int64))


def wide_parities(s: np.ndarray) -> bytes | None:
    """Parities of a set too large for the signature: two classes for every member, or more, a
    power of two, so that the longer of two can be folded to the shorter; else nothing."""
    classes = min(WIDE_CLASSES, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 0
    if classes <= 64 * SIG_LONGS:
        return None
    count = np.bincount(((s >> np.uint64(40)) % np.uint64(classes)).astype(np.int64), minlength=classes)
    return np.packbits(count & 1).tobytes()


def wide_differ(x: np.ndarray, y: np.ndarray) -> int:
    """Classes of different parity: at most the members that differ."""
    few, many = sorted((x, y), key=len)
    return int(np.bitwise_count(few ^ np.bitwise_xor.reduce(many.reshape(-1, len(few)), axis=0)).sum())


def sketch(docs: DataFrame, text_col: str, n: int = N_WORDS, size: int = 0) -> np.ndarray:
    """Occurrences of shingles of all documents (``size`` bytes) by the low bits of their hash,
    in eighths of an octave."""
    part = 1 << 14
    cells = 1 << min(SKETCH_BITS, max(16, (size // 4).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for b in batches:
            raw, off = utf8_column(b, text_col)
            for lo, hi in slices(off):
                h, _ = shingle_rows(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], n)
                at, many = np.unique(h & np.uint64(cells - 1), return_counts=True)
                total[at.astype(np.int64)] += many.astype(np.uint32)
        for lo in range(0, cells, 64 * part):
            rows = []
            for i in range(lo, min(cells, lo + 64 * part), part):
                at = np.flatnonzero(total[i:i + part])
                if len(at):
                    many = total[i + at]
                    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if many.max() <= np.iinfo(k).max)
                    # cells in use: their places or, where that is shorter, a bit for each cell
                    used = at.astype(np.uint16) if len(at) < part // 16 else np.packbits(total[i:i + part] > 0)
                    rows.append((i // part, np.dtype(kind).str, used.tobytes(), zlib.compress(many.astype(kind).tobytes(), 1)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                    names=["part", "kind", "at", "many"])

    def add(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.int64)
        for t in tables:
            for kind, used, many in zip(t.column(1).to_pylist(), t.column(2).to_pylist(), t.column(3).to_pylist()):
                bits = len(used) == part // 8                       # places are fewer bytes
                at = np.flatnonzero(np.unpackbits(np.frombuffer(used, np.uint8))) if bits else np.frombuffer(used, np.uint16)
                total[at] += np.frombuffer(zlib.decompress(many), kind)
        level = np.minimum(8 * np.log2(1 + total), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                         names=["part", "cells"])

    parts = docs.select(text_col).mapInArrow(count, "part int, kind string, at binary, many binary")
    summed = parts.groupBy("part").applyInArrow(add, "part int, cells binary")
    levels = np.zeros(cells, np.uint8)
    for r in summed.toLocalIterator():
        levels[r["part"] * part:(r["part"] + 1) * part] = np.frombuffer(r["cells"], np.uint8)
    return levels


def prefix_length(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def _packed(entries: list[tuple], buckets: int) -> pa.RecordBatch:
    cols = {name: np.concatenate([e[i] for e in entries]) for i, (name, _) in enumerate(_ENTRY)}
    where = (cols["h"] >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(where, kind="stable")
    found, start = np.unique(where[order], return_index=True)
    stop = np.append(start[1:], len(order))
    arrays = [pa.array(found.astype(np.int64), pa.int64())]
    for name, kind in _ENTRY:
        c = cols[name][order].astype(kind)
        arrays.append(pa.array([c[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *[x for x, _ in _ENTRY]])


def nodes_of(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """``docs`` with _node (digest of the set, null if empty), n_shingles, _sig (its signature),
    _wide (its long parities, null for small sets) and _text (a hash of the text, by which the text is found again)."""
    base = docs.withColumn("_text", F.xxhash64(F.col(text_col)))
    schema = base.withColumns({"_node": F.lit(None).cast("binary"), "n_shingles": F.lit(0).cast("long"),
                               "_sig": F.array(F.lit(0).cast("long")), "_wide": F.lit(None).cast("binary")}).drop(text_col).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [(digest(s)[:NODE_BYTES] if len(s) else None, len(s), signature(s), wide_parities(s)) for s in _sets(b, text_col, n)]
            keep = [x for x in b.schema.names if x != text_col]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(x)) for x in keep]
                + [pa.array([s[i] for s in sets], kind) for i, kind in enumerate(
                    (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                names=[*keep, "_node", "n_shingles", "_sig", "_wide"])
    return base.mapInArrow(run, schema)


def has_partner(lead: np.ndarray, many: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Of the entries of the groups that start at ``lead`` and have ``many`` entries each: whether
    the length filter, and in a group of two the positional filter, allow a link with another."""
    group = np.repeat(np.arange(len(many)), many)
    order = np.lexsort((n, group))                                  # if any partner's length will do, that of a neighbour will
    size, mine = n[order].astype(np.int64), group[order]
    near = (mine[1:] == mine[:-1]) & (100 * size[:-1] >= percent * size[1:])
    out = np.zeros(len(n), bool)
    out[order[1:]] = near
    out[order[:-1]] |= near
    a = lead[many == 2]
    na, nb, pa_, pb = (x.astype(np.int64) for x in (n[a], n[a + 1], pos[a], pos[a + 1]))
    ends = np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb)
    far = (100 + percent) * ends < percent * (na + nb)
    out[a[far]] = out[a[far] + 1] = False
    return out


def same_members(h: np.ndarray, s1: np.ndarray, s2: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of entries by group (``h``), then node: groups of the same nodes become one, named by a hash
    of its nodes.  Places in a set follow one order of all shingles, so the group with the least
    place in one node is the least in all.  Returns the entries of that group, the names, and
    the nodes in all groups that are one with it."""
    lead = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    many = np.diff(np.append(lead, len(h)))
    name = mix(np.add.reduceat(mix(mix(s1) ^ s2), lead) + many.astype(np.uint64))
    order = np.lexsort((pos[lead], name))
    first = np.flatnonzero(np.append(True, name[order][1:] != name[order][:-1]))
    times = np.diff(np.append(first, len(order)))
    told = np.sort(order[first])
    weight = np.zeros(len(lead), np.int64)
    weight[order[first]] = times * many[order[first]]
    chosen = np.zeros(len(lead), bool)
    chosen[told] = True
    size = many[told]
    return np.flatnonzero(np.repeat(chosen, many)), np.repeat(name[told], size), np.repeat(weight[told], size)


def prefix_groups(docs: DataFrame, text_col: str, cells: np.ndarray, buckets: int, n: int, percent: int) -> DataFrame:
    """Prefix entries (h, node, n, pos) of the shingles that two nodes or more have, without those
    that their lengths and places allow no link in the group.  Groups of the same nodes are one
    (``h``: its name); ``many``: the entries of all of them."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        mask = np.uint64(len(count) - 1)
        held, size, seen = [], 0, set()
        for b in batches:
            for s in _sets(b, text_col, n):
                name = digest(s)[:NODE_BYTES]
                if not len(s) or name in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(name)
                p = prefix_length(len(s), percent)
                h = s[np.argsort(count[(s & mask).astype(np.int64)], kind="stable")[:p]]
                s1, s2 = (int.from_bytes(x, "big") for x in (name[:8], name[8:]))
                held.append((h, np.full(p, s1, np.uint64), np.full(p, s2, np.uint32), np.full(p, len(s), np.uint32),
                             np.arange(p, dtype=np.uint32)))
                size += p
                if size >= FLUSH_ENTRIES:
                    yield _packed(held, buckets)
                    held, size = [], 0
        if held:
            yield _packed(held, buckets)

    def group(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[] for _ in _ENTRY]
        for t in tables:
            for i, (_, kind) in enumerate(_ENTRY):
                parts[i] += [np.frombuffer(x.as_buffer(), kind) for x in t.column(i + 1)]
        c = dict(zip([x for x, _ in _ENTRY], [np.concatenate(p) for p in parts]))
        order = np.argsort(c["h"], kind="stable")
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = c["h"][order[1:]] == c["h"][order[:-1]]
        order = order[same[:-1] | same[1:]]                        # shingles of one entry are most
        order = order[np.lexsort((c["s2"][order], c["s1"][order], c["h"][order]))]
        h, s1, s2 = c["h"][order], c["s1"][order], c["s2"][order]
        if not len(h):
            return
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
        order, h, s1, s2 = order[new], h[new], s1[new], s2[new]    # copies of a set
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        lead = np.flatnonzero(first)
        many = np.diff(np.append(lead, len(h)))
        keep = has_partner(lead, many, c["n"][order], c["pos"][order], percent)
        order, h, s1, s2 = order[keep], h[keep], s1[keep], s2[keep]
        if not len(h):
            return
        at, h, many = same_members(h, s1, s2, c["pos"][order])
        order = order[at]
        name = np.concatenate([x[at].astype(kind)[:, None].view(np.uint8) for x, kind in ((s1, ">u8"), (s2, ">u4"))], axis=1)
        fixed = lambda x: pa.FixedSizeBinaryArray.from_buffers(pa.binary(NODE_BYTES), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
        for lo in range(0, len(h), 100_000):
            at = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[at].view(np.int64)), fixed(name[at]),
                 *[pa.array(c[x][order[at]].astype(np.int64)) for x in ("n", "pos")], pa.array(many[at].astype(np.int64))],
                names=["h", "node", "n", "pos", "many"])

    rows = docs.select(text_col).mapInArrow(emit, "bucket long, " + ", ".join(f"{x} binary" for x, _ in _ENTRY))
    found = rows.groupBy("bucket").applyInArrow(group, "h long, node binary, n long, pos long, many long")
    return found.groupBy("h", "node").agg(F.first("n").alias("n"), F.min("pos").alias("pos"), F.sum("many").alias("many"))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length and positional filters of two entries of one shingle."""
    ends = f"(least({a}.pos, {b}.pos) + 1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1)"
    return F.expr(f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) "
                  f"AND {100 + percent} * {ends} >= {percent} * ({a}.n + {b}.n)")


def _differ(a: str, b: str) -> str:
    """Classes of different parity: at most the members that differ."""
    return "(" + " + ".join(f"bit_count({a}.{g} ^ {b}.{g})" for g in _PARITIES) + ")"


def _suffixes_allow(a: str, b: str, percent: int) -> Column:
    """Suffix filters: the common part that the quarters leave, the difference that the parities show."""
    common = " + ".join(f"least({a}.{q}, {b}.{q})" for q in _QUARTERS)
    return F.expr(f"{100 + percent} * ({common}) >= {percent} * ({a}.n + {b}.n) "
                  f"AND {100 + percent} * {_differ(a, b)} <= {100 - percent} * ({a}.n + {b}.n)")


def parities_allow(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) whose long parities, where both have them, allow a link."""
    names = pairs.columns
    for end in ("a", "b"):
        pairs = pairs.join(sigs.select(F.col("node").alias(end), F.col("n").alias(f"_n{end}"), F.col("wide").alias(f"_w{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = dict(zip(b.schema.names, b.columns))
            keep = [not (x.is_valid and y.is_valid) or (100 + percent) * wide_differ(
                np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) <= (100 - percent) * both
                for x, y, both in zip(col["_wa"], col["_wb"], pc.add(col["_na"], col["_nb"]).to_pylist())]
            yield b.select(names).filter(pa.array(keep, pa.bool_()))
    return pairs.select(*names, "_na", "_nb", "_wa", "_wb").mapInArrow(run, pairs.select(*names).schema)


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link.  Only the texts of nodes in pairs are read."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = wanted.join(nodes.groupBy(F.col("_node").alias("node")).agg(F.min("_text").alias("_text")), "node").select("_text")
    some = docs.select(F.xxhash64(F.col(text_col)).alias("_text"), F.col(text_col).alias("text")).join(
        staged(texts.distinct(), "jaccard-texts"), "_text", "left_semi").dropDuplicates(["_text"])     # both by the hash of the text: one exchange

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(_sets(b, "text", n))
            yield pa.RecordBatch.from_arrays([pa.array([digest(s)[:NODE_BYTES] for s in got], pa.binary()),
                                              pa.array([s.tobytes() for s in got], pa.binary())], names=["node", "s"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                k = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[k] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = staged(some.select("text").mapInArrow(sets, "node binary, s binary"), "jaccard-sets")
    rows = pairs.select("a", "b").join(found.select(F.col("node").alias("b"), F.col("s").alias("_sb")), "b")
    rows = rows.join(found.select(F.col("node").alias("a"), F.col("s").alias("_sa")), "a")
    links = staged(rows.select("a", "b", "_sa", "_sb").mapInArrow(check, "a binary, b binary"), "jaccard-verified")
    discard(found)
    return links


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                    percent: int = PERCENT, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): every row of ``docs`` without its text, with n_shingles and _node;
    and (node, root) of the nodes that link with another."""
    base = without(docs, *RESULTS, "_node", "_text", "_sig", "_wide")
    nodes = staged(nodes_of(base, text_col, n), "jaccard-nodes")
    size = base.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cells = sketch(base, text_col, n, size)
    groups = staged(prefix_groups(base, text_col, cells, max(1, -(-size // bucket_bytes)), n, percent), "jaccard-groups")

    sigs = nodes.where("_node is not null").select(F.col("_node").alias("node"), F.col("n_shingles").alias("n"), "_sig", F.col("_wide").alias("wide")).join(
        groups.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    sigs = staged(sigs.select("node", "n", "wide", *[F.col("_sig")[i].alias(c) for i, c in enumerate(_QUARTERS + _PARITIES)]),
                  "jaccard-signatures")
    # the node that shares the most entries leads: an original more than its edited copies
    weight = groups.groupBy("node").agg(F.sum("many").alias("weight"))
    groups = groups.drop("many")
    heavy = staged(groups.join(weight, "node"), "jaccard-weights")
    best = heavy.groupBy("h").agg(F.max(F.struct("weight", "node", "n", "pos")).alias("b")).select("h", "b.*")
    stars = heavy.alias("a").join(best.alias("b"), (F.col("a.h") == F.col("b.h")) & (F.col("a.node") != F.col("b.node"))
                                  & _may_link("a", "b", percent))
    stars = stars.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
    stars = stars.alias("p").join(sigs.alias("x"), F.col("p.a") == F.col("x.node")).join(
        sigs.alias("y"), F.col("p.b") == F.col("y.node")).where(_suffixes_allow("x", "y", percent)).select("p.a", "p.b")
    stars = staged(parities_allow(stars, sigs, percent), "jaccard-stars")
    discard(heavy)
    links = verified(stars, base, nodes, text_col, n, percent)
    roots = components(links)

    # a node without links is its own root, which travels as null
    named = groups.join(roots, "node", "left")
    own = F.coalesce("root", "node")
    open_groups = named.groupBy("h").agg(F.min(own).alias("r0"), F.max(own).alias("r1")).where("r0 <> r1").select("h")
    signed = named.join(sigs.drop("n", "wide"), "node").join(open_groups, "h", "left_semi")    # by h, as the self-join
    a, b = signed.alias("a"), signed.alias("b")
    rest = a.join(b, (F.col("a.h") == F.col("b.h")) & F.expr("coalesce(a.root, a.node) <> coalesce(b.root, b.node)") & (F.col("a.node") < F.col("b.node"))
                  & _may_link("a", "b", percent) & _suffixes_allow("a", "b", percent)).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b"),
        F.expr(f"1000000 * {_differ('a', 'b')} div (a.n + b.n)").alias("far")).distinct()
    rest = staged(parities_allow(rest.join(stars, ["a", "b"], "left_anti"), sigs, percent), "jaccard-rest")
    discard(groups)
    discard(sigs)
    ends = rest.select(F.col("a").alias("node"), "far", "a", "b").union(rest.select("b", "far", "a", "b"))
    near = ends.groupBy("node").agg(F.min(F.struct("far", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    near = staged(near, "jaccard-near")
    if near.limit(1).count():
        links = links.union(verified(near, base, nodes, text_col, n, percent))
        roots = components(links, "components-near")
        left = rest.select("a", "b").join(near, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            left = left.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}")), end, "left")
        left = staged(left.where("coalesce(_a <> _b, true)").select("a", "b"), "jaccard-left")
        if left.limit(1).count():
            roots = components(links.union(verified(left, base, nodes, text_col, n, percent)), "components-all")
    return nodes, roots


def _rooted(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """The rows of ``docs`` (without its text) with _text, n_shingles and root, the node that
    names the component (null: an empty set)."""
    nodes, roots = link_components(docs, id_col, text_col, n, percent)
    return nodes.join(roots.select(F.col("node").alias("_node"), "root"), "_node", "left") \
        .withColumn("root", F.coalesce("root", "_node")).drop("_node", "_sig", "_wide")


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                   percent: int = PERCENT) -> DataFrame:
    """``docs`` (without its text) with n_shingles and component_id, the least id reachable by links."""
    rows = _rooted(docs, id_col, text_col, n, percent)
    keep = [c for c in rows.columns if c not in ("_text", "n_shingles", "root")]
    least = rows.where("root is not null").groupBy("root").agg(F.min(id_col).alias("component_id"))
    rows = rows.join(least, "root", "left")
    return rows.select(*keep, "n_shingles", F.when(F.col("root").isNull(), F.col(id_col)).otherwise(
        F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """One document of each component: of the rows with an id, if there are any, that of least
    id, then of least hash of the text.  Rows without words are components of their own: all
    without an id stay, and one of each id and text."""
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    full, empty = docs.where(words).withColumn("_hash", F.xxhash64(text_col)), docs.where(~words)
    told = _rooted(full.select(id_col, text_col), id_col, text_col, n, percent)
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("_id"), F.col("_text"))
    first = told.groupBy("root").agg(F.min(place).alias("k")).select("k._id", "k._text").distinct()
    out = full.join(first, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text")), "left_semi")
    out = out.dropDuplicates([id_col, "_hash"]).drop("_hash")
    return out.union(empty.where(F.col(id_col).isNull())).union(
        empty.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col]))
