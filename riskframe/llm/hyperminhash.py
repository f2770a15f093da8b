"""MinHash near-dedup with HyperMinHash sketches: compressed registers, banding, estimate, verification.

A document's set is its distinct ``n``-word shingles (words: runs of anything but space and
\\t to \\r, A-Z lowered; a shorter text is one shingle).  Two sets link when
``100 * intersection >= percent * union``.

1. **Sketch.**  Each of ``HASHES`` hash functions deals a set's shingles to ``BUCKETS`` buckets; of
   the least value in a bucket a register keeps the number of leading zeros (6 bits) and the
   ``MANTISSA`` bits behind the first one: two bytes instead of eight.  Equal sets are one node,
   named by a 128-bit digest; nodes carry a number from here on.
2. **Bands.**  ``BAND`` registers of one hash are a band; nodes with an equal band, not all of
   it empty, meet in a group.  At the threshold of 85 % a pair misses all ``BANDS`` bands with
   a probability of 7e-9; what stays apart then is as rare as that.
3. **Estimate.**  Registers are equal by shared minima or by chance; with rates of a and b
   shingles a bucket chance makes a share of ``2**-MANTISSA * a*b / ((a+b)**2 * 2 ln 2)``
   equal, which is taken out of the share of equal registers.  A pair is dropped where that estimate is
   ``SIGMAS`` standard deviations of a pair at the threshold below it, or where more registers
   differ than the differing shingles of a pair at the threshold could change.  Beside the
   registers a node has the parity of its shingles in each of ``CLASSES`` hash classes: as many
   shingles differ as parities at least, which keeps sets of up to some thousand shingles apart
   that are alike but do not link.
4. **Verification.**  What is left is compared on the full sets, in three steps.  (a) In every
   group one node, that which meets the most others, is paired with the rest; each node keeps
   its best pair.  (b) Of the groups that still hold several components, each node's best
   partner in another one.  (c) Then all remaining pairs of different components.  After each
   step links are joined up to components; pairs within one need no verification.  Edited
   copies link with their original more than with each other, so m of them cost about m pairs.
   Steps (b) and (c) compare sketches in blocks of bounded size, so a group of any size is
   many small tasks and its pairs are rows only if the estimate lets them through, once each.

Cases: null, empty or wordless text has an empty set, size 0, links with nothing and is kept;
repeated rows and equal texts are in one component; a null id counts as no id (a component of
such rows only has a null id); rows with the component's id are kept; empty tables give empty
results; a very long text is one numpy step of its own; input columns named like a result
column are replaced by it; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mix, slices, staged, utf8_column, without
from .components import components
from .jaccard_join import digest, shingle_rows

N_WORDS, PERCENT = 5, 85
HASHES, BUCKETS, BAND, MANTISSA = 16, 10, 5, 10
REGISTERS, BANDS = HASHES * BUCKETS, HASHES * BUCKETS // BAND
SIGMAS = 4.5
#: Hash classes whose parities are kept, and the 16-bit words of a whole sketch.
CLASSES = 1024
WORDS = REGISTERS + CLASSES // 16
#: Rows of a numpy step at most: short texts have sketches of full size.
STEP_ROWS = 2048
#: Nodes of a block; two blocks are compared by one numpy step.
BLOCK = 512
RESULTS = ("n_shingles", "component_id", "kept")
_EMPTY = np.iinfo(np.uint64).max
_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


# ----------------------------------------------------------------------------- sketch
def registers(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The sketch of every row from its shingles' hashes (repeated ones change nothing)."""
    least = np.full(rows * REGISTERS, _EMPTY, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    for i, odd in enumerate(_ODD):
        v = h * odd
        v ^= v >> np.uint64(29)
        high = (v >> np.uint64(32)) * np.uint64(BUCKETS)
        bucket = (high >> np.uint64(32)).astype(np.int64)
        np.minimum.at(least, row * REGISTERS + i * BUCKETS + bucket, ((high & low) << np.uint64(32)) | (v & low))
    top = least >> np.uint64(11)                                       # 53 bits: exact as a float
    zeros = 53 - np.frexp(top.astype(np.float64))[1]
    zeros[top == 0] = 53
    behind = ((top << (zeros + 1).astype(np.uint64)) >> np.uint64(53 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    reg = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | behind
    reg[least == _EMPTY] = 0
    return reg.astype(np.uint16).reshape(rows, REGISTERS)


def band_keys(reg: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys; 0 where all registers of the band are empty."""
    parts = reg.reshape(len(reg), BANDS, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(reg), BANDS)).copy()
    for j in range(BAND):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + parts[:, :, j] + np.uint64(1))
    key[(parts == 0).all(2)] = 0
    return key


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """The parities of every set's hash classes, in 16-bit words."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    count = np.bincount(row * CLASSES + ((flat >> np.uint64(40)) % np.uint64(CLASSES)).astype(np.int64), minlength=len(sets) * CLASSES)
    return np.packbits((count & 1).astype(np.uint8)).view(np.uint16).reshape(len(sets), -1)


def alike(one: np.ndarray, other: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, whether the pair may link) of pairs of whole sketches."""
    a, b = one[..., :REGISTERS], other[..., :REGISTERS]
    filled = (a | b) > 0
    differ = np.bitwise_count(one[..., REGISTERS:] ^ other[..., REGISTERS:]).sum(-1, dtype=np.int64)
    estimate, may = allowed(((a == b) & filled).sum(-1), filled.sum(-1), na, nb, percent)
    most = (100 - percent) * (na + nb) / (100 + percent)               # shingles that differ at the threshold
    share = 0.5 * (1 - (1 - 2 / CLASSES) ** most)
    usual = CLASSES * share + SIGMAS * np.sqrt(CLASSES * share * (1 - share)) + 1
    return estimate, may & (differ <= most) & (differ <= usual)


def allowed(equal: np.ndarray, filled: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimates of the Jaccard similarity, whether the pair may link) from the equal and the
    filled registers of pairs of sets of ``na`` and ``nb`` shingles."""
    goal, many = percent / 100, np.maximum(filled, 1)
    by_chance = na * nb / ((na + nb) ** 2.0 * 2 * np.log(2) * (1 << MANTISSA))
    estimate = np.maximum(equal / many - by_chance, 0) / (1 - by_chance)
    close = estimate >= goal - SIGMAS * np.sqrt(goal * (1 - goal) / many)
    few = (filled - equal) * (100 + percent) <= HASHES * (100 - percent) * (na + nb)
    sizes = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    return estimate, close & few & sizes


def sketched(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """``docs`` without the text, with _node (digest, null for an empty set), n_shingles, _reg and _text."""
    base = docs.withColumn("_text", F.xxhash64(F.col(text_col)))
    schema = base.withColumns({"_node": F.lit(None).cast("binary"), "n_shingles": F.lit(0).cast("long"),
                               "_reg": F.lit(None).cast("binary")}).drop(text_col).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8_column(b, text_col)
            rest = [x for x in b.schema.names if x != text_col]
            for lo, hi in slices(off, rows=STEP_ROWS):
                h, cut = shingle_rows(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], n)
                reg = registers(h, np.repeat(np.arange(hi - lo), np.diff(cut)), hi - lo)
                sets = [np.unique(h[cut[r]:cut[r + 1]]) for r in range(hi - lo)]
                reg = np.concatenate([reg, parities(sets)], 1)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(x)) for x in rest]
                    + [pa.array([digest(s) if len(s) else None for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([r.tobytes() if len(s) else None for r, s in zip(reg, sets)], pa.binary())],
                    names=[*rest, "_node", "n_shingles", "_reg"])
    return base.mapInArrow(run, schema)


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, WORDS)


def band_entries(nodes: DataFrame) -> DataFrame:
    """(key, band, nid, n) of every filled band of nodes (nid, n, reg)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                key = band_keys(_matrix(part.column(2))[:, :REGISTERS])
                row, band = np.nonzero(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[row, band].view(np.int64)), pa.array(band.astype(np.int32)),
                     part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))], names=["key", "band", "nid", "n"])
    return nodes.select("nid", "n", "reg").mapInArrow(emit, "key long, band int, nid long, n long")


# ----------------------------------------------------------------------------- pairs
def estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, estimate) of the pairs (a, b) that may link."""
    side = lambda c: nodes.select(F.col("nid").alias(c), F.col("n").alias(f"n{c}"), F.col("reg").alias(f"r{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                na, nb = (part.column(i).to_numpy() for i in (2, 4))
                est, may = alike(_matrix(part.column(3)), _matrix(part.column(5)), na, nb, percent)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(est)],
                                                 names=["a", "b", "estimate"]).filter(pa.array(may))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "ra", "nb", "rb")
    return both.mapInArrow(run, "a long, b long, estimate double")


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their full sets.  Only texts of nodes in pairs are read."""
    wanted = pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct()
    wanted = wanted.join(nodes.select("nid", "_text"), "nid")
    texts = docs.select(F.xxhash64(F.col(text_col)).alias("_text"), F.col(text_col).alias("t")).join(wanted, "_text")
    texts = staged(texts.dropDuplicates(["_text", "nid"]).select("nid", "t"), "hyperminhash-texts")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for b in batches:
            sets = {}
            for name in ("ta", "tb"):
                raw, off = utf8_column(b, name)
                sets[name] = (raw, off)
            keep = []
            for i, a in enumerate(b.column(0).to_pylist()):
                if a != last:
                    last, known = a, _set_of(*sets["ta"], i, n)
                other = _set_of(*sets["tb"], i, n)
                both = int(np.isin(other, known, assume_unique=True).sum())
                keep.append(100 * both >= percent * (len(known) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: texts.select(F.col("nid").alias(c), F.col("t").alias(f"t{c}"))
    rows = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb")
    links = staged(rows.mapInArrow(check, "a long, b long"), "hyperminhash-links")
    discard(texts)
    return links


def _set_of(raw: np.ndarray, off: np.ndarray, i: int, n: int) -> np.ndarray:
    return np.unique(shingle_rows(raw[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]), n)[0])


def _compared(root: np.ndarray, nid: np.ndarray, size: np.ndarray, reg: np.ndarray, block: np.ndarray, cell: tuple[int, int],
              band: int, percent: int, nearest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, estimate) of a cell: pairs of its two blocks, or within its one, of different components."""
    first, second = np.flatnonzero(block == cell[0]), np.flatnonzero(block == cell[1])
    out = []
    for k, i in enumerate(first.tolist()):
        j = second if cell[0] != cell[1] else second[k + 1:]
        j = j[root[j] != root[i]]
        if not len(j):
            continue
        est, may = alike(reg[j], reg[i], size[j], size[i], percent)
        j, est = j[may], est[may]
        if not nearest and len(j):                                   # each pair in its first common band only
            mine, others = (reg[x][..., :REGISTERS].reshape(-1, BANDS, BAND) for x in (i, j))
            first_band = ((others == mine).all(2) & (mine > 0).any(2)).argmax(1) == band
            j, est = j[first_band], est[first_band]
        out.append((np.full(len(j), nid[i]), nid[j], est))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, est = (np.concatenate(x) for x in zip(*out))
    if nearest:                                                      # the best partner of each node
        ends = np.concatenate([a, b])
        order = np.lexsort((-np.concatenate([est, est]), ends))
        lead = order[np.append(True, ends[order][1:] != ends[order][:-1])] if len(order) else order
        pick = np.unique(lead % len(a)) if len(a) else lead
        a, b, est = a[pick], b[pick], est[pick]
    return a, b, est


def open_pairs(groups: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(a, b, estimate), a < b: pairs of different components in the groups (key, band, nid) that may
    link; with ``nearest`` at most one for each node and cell, its best."""
    named = groups.join(roots.select(F.col("node").alias("nid"), "root"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    several = named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("many")).where(
        "r0 <> r1").select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"))
    rows = named.join(several, "key").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("blocks")).cast("int"))
    rows = rows.join(nodes.select("nid", "reg"), "nid")
    # a row goes to the cells of its block with every block: (block, x) and (x, block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("c0"), F.greatest("block", "other").alias("c1"), "band", "block", "nid", "root", "n", "reg")
    rows = rows.repartition("key", "c0", "c1").sortWithinPartitions("key", "c0", "c1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                                    # the last cell of a batch may go on
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            cut = _cells(t)
            yield from _cell_pairs(t, cut[:-1], percent, nearest)
            held = t.slice(int(cut[-2])) if len(cut) > 1 else None
        if held is not None:
            yield from _cell_pairs(held, _cells(held), percent, nearest)
    return rows.mapInArrow(run, "a long, b long, estimate double")


def _cells(t: pa.Table) -> np.ndarray:
    """Where the cells of sorted rows start, and the end."""
    new = np.ones(t.num_rows, bool)
    cols = [t.column(c).to_numpy() for c in ("key", "c0", "c1")]
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return np.append(np.flatnonzero(new), t.num_rows)


def _cell_pairs(t: pa.Table, cut: np.ndarray, percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    t = t.combine_chunks()
    c = {x: t.column(x).to_numpy() for x in ("c0", "c1", "band", "block", "nid", "root", "n")}
    found = []
    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if y - x > 1:
            at = slice(x, y)
            found.append(_compared(c["root"][at], c["nid"][at], c["n"][at], _matrix(t.column("reg").slice(x, y - x)), c["block"][at],
                                   (c["c0"][x], c["c1"][x]), int(c["band"][x]), percent, nearest))
    if found:
        a, b, est = (np.concatenate(z) for z in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(est)], names=["a", "b", "estimate"])


def link_nodes(docs: DataFrame, nodes: DataFrame, text_col: str, n: int, percent: int) -> DataFrame:
    """(node, root): the numbers of linked nodes and of their components."""
    entries = band_entries(nodes)
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    groups = staged(entries.join(shared, "key"), "hyperminhash-groups")
    weight = groups.groupBy("nid").agg(F.sum("many").alias("weight"))
    lead = groups.join(weight, "nid").groupBy("key").agg(F.max(F.struct("weight", "nid", "n")).alias("l")).select("key", "l.nid", "l.n")
    stars = groups.alias("g").join(lead.alias("l"), (F.col("g.key") == F.col("l.key")) & (F.col("g.nid") != F.col("l.nid")) & F.expr(
        f"100 * least(g.n, l.n) >= {percent} * greatest(g.n, l.n)")).select(F.col("g.nid").alias("a"), F.col("l.nid").alias("b")).distinct()
    stars = estimated(stars, nodes, percent).groupBy("a").agg(F.max(F.struct("estimate", "b")).alias("s"))
    done = staged(stars.select(F.least("a", "s.b").alias("a"), F.greatest("a", "s.b").alias("b")).distinct(), "hyperminhash-stars")
    links = confirmed(done, docs, nodes, text_col, n, percent)
    roots = components(links, "hyperminhash-stars")

    near = open_pairs(groups, nodes, roots, percent, True)
    ends = near.select(F.col("a").alias("node"), "estimate", "a", "b").union(near.select("b", "estimate", "a", "b"))
    near = ends.groupBy("node").agg(F.max(F.struct("estimate", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    near = staged(near.join(done, ["a", "b"], "left_anti"), "hyperminhash-near")
    if near.limit(1).count():
        links = links.union(confirmed(near, docs, nodes, text_col, n, percent))
        roots = components(links, "hyperminhash-near")
        done = done.union(near)
    left = open_pairs(groups, nodes, roots, percent, False).select("a", "b").distinct()
    left = staged(left.join(done, ["a", "b"], "left_anti"), "hyperminhash-left")
    if left.limit(1).count():
        roots = components(links.union(confirmed(left, docs, nodes, text_col, n, percent)), "hyperminhash-left")
    discard(groups)
    return roots


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (without its text) with n_shingles, component_id (the least id reachable by links)
    and kept (whether the row has that id)."""
    rest = [F.col(f"`{c}`") for c in without(docs, *RESULTS).columns if c != text_col]
    base = docs.select(F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = staged(sketched(base, "text", n), "hyperminhash-rows")
    nodes = rows.where("_node is not null").select("_node", F.col("n_shingles").alias("n"), F.col("_reg").alias("reg"), "_text").dropDuplicates(["_node"])
    nodes = staged(nodes.withColumn("nid", F.monotonically_increasing_id()), "hyperminhash-nodes")
    roots = link_nodes(base, nodes, "text", n, percent)
    named = nodes.select("_node", F.col("nid").alias("node")).join(roots, "node").select("_node", "root")
    rows = rows.drop("_reg", "_text").join(named, "_node", "left")
    # a component is named by its root, a node without links by itself
    rows = rows.withColumn("_group", F.when(F.col("root").isNotNull(), F.struct("root", F.lit(None).cast("binary").alias("own"))).when(
        F.col("_node").isNotNull(), F.struct(F.lit(None).cast("long").alias("root"), F.col("_node").alias("own"))))
    least = rows.where("_group is not null").groupBy("_group").agg(F.min("id").alias("component_id"))
    out = rows.join(least, "_group", "left").withColumn("component_id", F.when(F.col("_group").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select("row.*", "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
