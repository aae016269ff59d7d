"""Exact Jaccard join of shingle sets by signature trees.

A document is the set of its runs of ``SHINGLE`` words; equal sets are one
node from the start.  All shingles get one order, rare ones first (counts of
the whole corpus, kept in hashed slots; any order gives the same links, this
one keeps trees small).  Two sets that link share one of the first
``size - ceil(0.85 size) + 1`` shingles of each, so each such shingle is the
root of a signature tree over the sets that begin with it, and no link lies
outside the trees.  Trees with the same members (a shared passage gives one
for each of its shingles) are one tree.

Every set has a bitmap of two to four bits a shingle.  A tree's inner nodes
hold the OR of the bitmaps below, the range of sizes and the label if there is
only one.  A dual traversal takes pairs of nodes from the root down and leaves
those whose sizes are too far apart, whose largest possible overlap (shared
bits, and what bits can hide) is too small, or which are one component
already; pairs of sets that remain are compared exactly.  A set also carries
its first place in the order at which it meets the tree: what lies before
cannot be shared at the pair's first common shingle, which bounds the overlap too.

So that thousands of near copies do not meet pairwise, the members of a tree
in one band of sizes are first compared with the one whose shingles are most
common; what that joins has one label when the traversal comes.  Trees beyond
``BLOCK`` rows are dealt: members outside the main label meet blocks of the rest.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.llm import common as C
from connscore.llm import words as W
from connscore.llm.components import components, thinned

#: Words of a shingle; two sets link when 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 4, 85

#: Bits of a bitmap for each shingle, most bits, children of a tree node.
BITS, MOST_BITS, FANOUT = 2, 1 << 16, 8

#: Rows of a tree that one task takes; pairs of tree nodes bounded at once.
BLOCK, PAIRS = 2048, 512

#: Slots of the shingle counts: 2 ** (bits of the number of rows + 4), within these powers.  One byte a slot
#: goes to the driver and back to the tasks, so 16 MB at most.
LEAST_SLOTS, MOST_SLOTS, SLICES = 16, 24, 32

#: Pairs of one set that are compared in one task.
CHUNK = 500

_PLACE = [C.FILE, C.ROW]


# ---- sets -----------------------------------------------------------------------------

def _shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, documents, shingle hashes with repeats, their documents) chunk by chunk."""
    for w in W.chunks(pc.ascii_lower(column)):
        lengths = np.diff(w.offsets)
        counts = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
        first = np.concatenate(([0], np.cumsum(counts)))
        start = np.arange(first[-1]) + np.repeat(w.offsets[:-1] - first[:-1], counts)
        end = np.minimum(start + SHINGLE, np.repeat(w.offsets[1:], counts))
        yield (w.first, len(counts), W._ranges_hash(w.hash, start, end, W._WORD_BASE),
               np.repeat(np.arange(len(counts)), counts))


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, sorted distinct shingles of each document one after another, starts) chunk by chunk."""
    for first, n, shingles, owner in _shingles(column):
        order = np.lexsort((shingles, owner))
        shingles, owner = shingles[order], owner[order]
        new = np.ones(len(shingles), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        yield first, shingles[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=n))))


def prefix_length(size: np.ndarray | int) -> np.ndarray | int:
    """Shingles of a set of which a linked set must share one."""
    return size - (PERCENT * size + 99) // 100 + 1


def _count_slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.uint32)
        for batch in batches:
            for _, _, shingles, _ in _shingles(batch.column(0)):
                np.add.at(counts, (W.mix(shingles) % np.uint64(slots)).astype(np.int64), np.uint32(1))
        if counts.any():
            parts = np.minimum(counts, 255).astype(np.uint8).reshape(SLICES, -1)
            for k in range(SLICES):
                yield pa.record_batch({"slice": pa.array([k], pa.int32()),
                                       "counts": pa.array([zlib.compress(parts[k].tobytes(), 1)], pa.binary())})
    return run


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed slices; 8 log2 of the counts, a byte each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(zlib.decompress(part), np.uint8)
            if k in sums:
                sums[k] += part
            else:
                sums[k] = part.astype(np.uint32)
    for k, v in sums.items():
        yield pa.record_batch({"slice": pa.array([k], pa.int32()), "counts": pa.array(
            [np.minimum(8 * np.log2(v + 1.0), 255).astype(np.uint8).tobytes()], pa.binary())})


def shingle_ranks(texts: DataFrame, rows: int) -> np.ndarray:
    """How common the shingles of each slot are in the whole corpus (8 log2, a byte a slot)."""
    slots = 1 << min(max(rows.bit_length() + 4, LEAST_SLOTS), MOST_SLOTS)
    schema = "slice int, counts binary"
    with C.settings(texts.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        parts = texts.select("text").mapInArrow(_count_slots(slots), schema)
        got = parts.repartition(SLICES, "slice").mapInArrow(_add_slices, schema).collect()
    out = np.zeros((SLICES, slots // SLICES), np.uint8)
    for row in got:
        out[row.slice] = np.frombuffer(row.counts, np.uint8)
    return out.ravel()


def _sketch(ranks):
    """(doc_id, file, row, text) to the row's set: digest, size, rarity, first shingles, bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        slots = np.uint64(len(table))
        for batch in batches:
            for first, shingles, starts in _sets(batch.column(3)):
                size = np.diff(starts)
                n = len(size)
                owner = np.repeat(np.arange(n), size)
                mixed = W.mix(shingles)
                rank = table[(mixed % slots).astype(np.int64)]
                in_order = np.lexsort((shingles, rank, owner))
                taken = np.where(size > 0, prefix_length(size), 0)
                place = np.arange(len(shingles)) - np.repeat(starts[:-1], size)
                prefix = shingles[in_order][place < np.repeat(taken, size)]
                common = np.bincount(owner, rank, minlength=n) / np.maximum(size, 1)
                bits, packed = _bitmaps(W.mix(mixed), owner, size)
                edge = np.concatenate(([0], np.cumsum(bits // 8)))
                digests = [hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest() if b > a else None
                           for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                part = batch.slice(first, n)
                yield pa.record_batch({
                    "doc_id": part.column(0), C.FILE: part.column(1), C.ROW: part.column(2),
                    "node": pa.array(digests, pa.binary()), "size": pa.array(size, pa.int64()),
                    "rarity": pa.array(-common.astype(np.float32)),
                    "prefix": pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(taken))), pa.int32()),
                        pa.array(prefix.view(np.int64), pa.int64())),
                    "bitmap": pa.array([packed[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)],
                                       pa.binary())})
    return run


def _bitmaps(hashes: np.ndarray, owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each set's bitmap (a power of two, 64 at least) and all bitmaps one after another."""
    wanted = np.clip(BITS * np.maximum(size, 1), 64, MOST_BITS)
    bits = (1 << np.ceil(np.log2(wanted)).astype(np.int64))
    start = np.concatenate(([0], np.cumsum(bits)))
    on = np.zeros(start[-1], bool)
    on[start[:-1][owner] + (hashes & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)] = True
    return bits, np.packbits(on, bitorder="little")


# ---- signature trees --------------------------------------------------------------------

class Tree:
    """Levels of nodes over sets of one bitmap width, leaves first; a node's children lie side by side.

    A node is (OR of the bitmaps, least and greatest size, label, most hidden
    shingles, most shingles from the place on where a set meets the tree).
    """

    def __init__(self, bitmap: np.ndarray, size: np.ndarray, label: np.ndarray, reach: np.ndarray, row: np.ndarray):
        order = np.argsort(size, kind="stable")
        self.row = row[order]
        hidden = size[order] - np.bitwise_count(bitmap[order]).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmap[order], size[order], size[order], label[order], hidden, reach[order])]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, label, hidden, reach = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            least, most = np.minimum.reduceat(label, at), np.maximum.reduceat(label, at)
            self.levels.append((np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at),
                                np.where((least == most) & (least >= 0), least, -1),   # -1: several labels
                                np.maximum.reduceat(hidden, at), np.maximum.reduceat(reach, at)))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes of ``level``, and which of ``nodes`` each belongs to."""
        first = nodes * FANOUT
        count = np.minimum(first + FANOUT, len(self.levels[level - 1][1])) - first
        which = np.repeat(np.arange(len(nodes)), count)
        return first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count), which


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps brought down to fewer words; a shingle's bit is its hash modulo the width."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _may_link(left: tuple, a: np.ndarray, right: tuple, b: np.ndarray) -> np.ndarray:
    """Whether some sets under the nodes a and b can link and are not one component."""
    bits_a, low_a, high_a, label_a, hidden_a, reach_a = (x[a] for x in left)
    bits_b, low_b, high_b, label_b, hidden_b, reach_b = (x[b] for x in right)
    near = (100 * high_a >= PERCENT * low_b) & (100 * high_b >= PERCENT * low_a)
    near &= (label_a != label_b) | (label_a < 0)
    near &= (100 + PERCENT) * np.minimum(reach_a, reach_b) >= PERCENT * (low_a + low_b)
    at = np.flatnonzero(near)
    words = min(bits_a.shape[1], bits_b.shape[1])
    narrow_a, narrow_b = _folded(bits_a[at], words), _folded(bits_b[at], words)
    shared = np.bitwise_count(narrow_a & narrow_b).sum(axis=1, dtype=np.int64)
    # a set's shingles beyond its bits may all be shared too; folding hides more
    fold_a = high_a[at] if bits_a.shape[1] > words else hidden_a[at]
    fold_b = high_b[at] if bits_b.shape[1] > words else hidden_b[at]
    most = np.minimum(np.minimum(high_a[at], high_b[at]), shared + np.minimum(fold_a, fold_b))
    near[at] = (100 + PERCENT) * most >= PERCENT * (low_a[at] + low_b[at])
    return near


def dual_traversal(left: Tree, right: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of pairs of sets that the bounds leave; a tree with itself gives each pair once."""
    same = left is right
    top = len(left.levels) - 1, len(right.levels) - 1
    work = [(*top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        i, j, a, b = work.pop()
        if len(a) > PAIRS:
            work.extend((i, j, a[k:k + PAIRS], b[k:k + PAIRS]) for k in range(0, len(a), PAIRS))
            continue
        near = _may_link(left.levels[i], a, right.levels[j], b)
        if same and not i and not j:
            near &= a < b
        a, b = a[near], b[near]
        if not len(a):
            continue
        if not i and not j:
            yield left.row[a], right.row[b]
            continue
        if i >= j:
            a, which = left.children(i, a)
            b, i = b[which], i - 1
            if j > i:
                b, which = right.children(j, b)
                a, j = a[which], j - 1
        else:
            b, which = right.children(j, b)
            a, j = a[which], j - 1
        if same and i == j:
            keep = a <= b
            a, b = a[keep], b[keep]
        if len(a):
            work.append((i, j, a, b))


def _trees(bitmaps: list[bytes], size: np.ndarray, label: np.ndarray, reach: np.ndarray,
           rows: np.ndarray) -> dict[int, Tree]:
    """A tree for each width of bitmap among ``rows``."""
    width = np.array([len(bitmaps[r]) for r in rows])
    out = {}
    for w in np.unique(width):
        at = rows[width == w]
        bits = np.frombuffer(b"".join(bitmaps[r] for r in at), np.uint64).reshape(len(at), w // 8)
        out[int(w)] = Tree(bits, size[at], label[at], reach[at], at)
    return out


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, part, block, role, node, size, label, reach, bitmap), sorted by the first three, to pairs (a, b)."""
    held: list[tuple] = []

    def pairs() -> Iterator[pa.RecordBatch]:
        roles = np.array([r[0] for r in held])
        nodes, bitmaps = np.array([r[1] for r in held], np.int64), [r[5] for r in held]
        size, reach = (np.array([r[k] for r in held], np.int64) for k in (2, 4))
        label = np.unique([r[3] for r in held], return_inverse=True)[1].astype(np.int64)
        if (roles == 0).all():          # a whole tree
            trees = _trees(bitmaps, size, label, reach, np.arange(len(held)))
            meets = [(trees[v], trees[w]) for v in trees for w in trees if v == w or 2 * v == w]
        else:                           # members outside the main label (1) and a block of all (2)
            left = _trees(bitmaps, size, label, reach, np.flatnonzero(roles == 1))
            right = _trees(bitmaps, size, label, reach, np.flatnonzero(roles == 2))
            meets = [(left[v], right[w]) for v in left for w in right if v == w or 2 * v == w or v == 2 * w]
        for one, other in meets:
            for a, b in dual_traversal(one, other):
                x, y = nodes[a], nodes[b]
                yield pa.record_batch({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    now = None
    for batch in batches:
        for tree, part, block, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (tree, part, block) != now:
                if len(held) > 1:
                    yield from pairs()
                held, now = [], (tree, part, block)
            held.append(tuple(row))
    if len(held) > 1:
        yield from pairs()


def tree_members(nodes: DataFrame) -> DataFrame:
    """(tree, node, reach) with size and rarity: the sets of each tree of two members at least.

    ``nodes``: node, size, rarity, prefix.  A shingle's rows meet once; trees
    whose members have the same hashes are joined (should two others agree by chance,
    theirs are one larger tree, and nothing is lost).  ``reach`` is the number of
    shingles from the first place on at which the set meets the tree.
    """
    same = Window.partitionBy("token")
    met = (nodes.select("node", F.posexplode("prefix").alias("place", "token"))
           .select("*", F.count("*").over(same).alias("n"), F.bit_xor(F.xxhash64("node")).over(same).alias("h"),
                   F.bit_xor(F.xxhash64("node", F.lit(1))).over(same).alias("g")).filter("n > 1"))
    trees = met.groupBy(F.xxhash64("h", "g", "n").alias("tree"), "node").agg(F.min("place").alias("place"))
    return trees.join(nodes.select("node", "size", "rarity"), "node").select(
        "tree", "node", "size", "rarity", (F.col("size") - F.col("place")).alias("reach"))


def _band(size: str):
    """Sets that link are at most one band apart."""
    return F.floor(F.log(F.col(size).cast("double")) / F.lit(-math.log(PERCENT / 100))).cast("int")


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of trees that may still link to one of another label: (tree, node, size, label, reach).

    A row stays if some cell (tree, band of sizes) beside it has another label,
    a size that the row's reach allows, and a reach that allows the row's size.
    """
    most = F.floor(F.col("reach") * (100 + PERCENT) / PERCENT) - F.col("size")   # greatest size that it can link to
    named = (members.join(labels, "node", "left")
             .select("tree", "node", "size", "band", "reach", F.coalesce("label", "node").alias("label"), most.alias("most")))
    cells = named.groupBy("tree", "band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("least"), F.max("most").alias("widest"))
    around = (cells.select("tree", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band"),
                           F.struct("low", "high", "least", "widest").alias("cell"))
              .groupBy("tree", "band").agg(F.collect_list("cell").alias("cells")))     # three at most
    meets = F.exists("cells", lambda c: ((c["low"] != F.col("label")) | (c["high"] != F.col("label")))
                     & (c["least"] <= F.col("most")) & (c["widest"] >= F.col("size")))
    return named.join(around, ["tree", "band"]).filter(meets).select("tree", "node", "size", "label", "reach")


def tree_pairs(members: DataFrame, bitmaps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b) of nodes of different labels that the signature trees cannot rule out.

    ``members``: tree, node, size, label, reach; ``bitmaps``: node, bitmap.
    """
    by_label = members.groupBy("tree", "label").agg(F.count("*").alias("n"))
    trees = by_label.groupBy("tree").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main"))
    trees = trees.select("tree", F.ceil(F.col("n") / block).cast("int").alias("blocks"),
                         F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("parts"),
                         F.col("main.label").alias("main"))
    dealt = members.join(trees, "tree")
    hashed = F.xxhash64("node")
    block_of = F.pmod(hashed, F.col("blocks")).cast("int")
    part_of = F.pmod(hashed, F.greatest("parts", F.lit(1))).cast("int")
    place = lambda part, to, role: F.struct(part.alias("part"), to.alias("block"), F.lit(role).alias("role"))
    zero = F.lit(0)
    as_block = F.transform(F.sequence(zero, F.col("parts") - 1), lambda p: place(p, block_of, 2))
    as_part = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda b: place(part_of, b, 1))
    places = (F.when((F.col("blocks") == 1) | (F.col("parts") == 0), F.array(place(zero, zero, 0)))
              .when(F.col("label") == F.col("main"), as_block).otherwise(F.concat(as_block, as_part)))
    rows = (dealt.filter("parts > 0").select("tree", "node", "size", "label", "reach", F.inline(places))
            .join(bitmaps, "node")
            .select("tree", "part", "block", "role", "node", "size", "label", "reach", "bitmap")
            .repartition("tree", "part", "block").sortWithinPartitions("tree", "part", "block"))
    return rows.mapInArrow(_tree_pairs, "a long, b long").distinct()


# ---- links -----------------------------------------------------------------------------

def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold, in whole numbers."""
    shared = int((np.searchsorted(y, x, "right") > np.searchsorted(y, x, "left")).sum())
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared) and shared > 0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, chunk, node, text), each chunk's a first, to the pairs that link."""
    head, head_set = None, None
    for batch in batches:
        keys, nodes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        chunks = batch.column(1).to_pylist()
        found = []
        for first, shingles, starts in _sets(batch.column(3)):
            for k in range(len(starts) - 1):
                i = first + k
                own = shingles[starts[k]:starts[k + 1]]
                if (keys[i], chunks[i]) != head:
                    head, head_set = (keys[i], chunks[i]), own
                elif linked(own, head_set):
                    found.append((keys[i], nodes[i]))
        yield pa.record_batch({"a": pa.array([a for a, _ in found], pa.int64()),
                               "b": pa.array([b for _, b in found], pa.int64())})


def verified(pairs: DataFrame, places: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) whose texts link, written.  ``places``: node and its place; ``texts``: place and text."""
    pairs = C.written(pairs, f"{name}-pairs")
    heads = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    members = pairs.join(heads, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), F.col("b").alias("node"))
    firsts = heads.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                          F.col("a").alias("node"))
    rows = members.union(firsts)
    # each text goes from where it lies straight to the chunks that want it
    wanted = C.written(rows.join(places, "node"), f"{name}-places")
    dealt = (texts.join(C.sized_broadcast(wanted), _PLACE).select("a", "chunk", "node", "text")
             .repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("node") != F.col("a")))
    with C.settings(texts.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        return C.written(dealt.mapInArrow(_compare, "a long, b long"), f"{name}-links")


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, size, bitmap, b, size, bitmap) whose bitmaps do not rule out a link."""
    for batch in batches:
        kept = []
        for size_a, map_a, size_b, map_b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4, 5)), strict=True):
            one, other = (Tree(np.frombuffer(m, np.uint64)[None, :], np.array([s]), np.array([k]), np.array([s]), np.zeros(1, int))
                          for k, (s, m) in enumerate(((size_a, map_a), (size_b, map_b))))
            at = np.zeros(1, int)
            kept.append(bool(_may_link(one.levels[0], at, other.levels[0], at)[0]))
        keep = pa.array(kept, pa.bool_())
        yield pa.record_batch({"a": batch.column(0).filter(keep), "b": batch.column(3).filter(keep)})


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bitmaps of ``nodes`` (node, size, bitmap) leave."""
    def beside(rows: DataFrame, end: str) -> DataFrame:
        known = nodes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("bitmap").alias(f"map_{end}"))
        return known.join(C.sized_broadcast(C.written(rows, "candidates")), end)

    both = beside(beside(pairs, "a"), "b").select("a", "size_a", "map_a", "b", "size_b", "map_b")
    return both.mapInArrow(_bounded, "a long, b long")


def _first_pairs(rows: DataFrame) -> DataFrame:
    """Each member of a tree and band beside its most common one, and these beside those of the next band."""
    leads = rows.groupBy("tree", "band").agg(F.min(F.struct("rarity", "node")).alias("lead"),
                                             F.count("*").alias("n"))
    leads = leads.select("tree", "band", F.col("lead.node").alias("lead"), "n")
    own = (rows.join(leads.filter("n > 1"), ["tree", "band"]).filter("node <> lead")
           .select(F.col("lead").alias("a"), F.col("node").alias("b")))
    above = leads.select("tree", (F.col("band") - 1).alias("band"), F.col("lead").alias("b"))
    across = leads.join(above, ["tree", "band"]).filter("lead <> b").select(F.col("lead").alias("a"), "b")
    return own.union(across).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    A text (A-Z lower-cased) is the set of its runs of four words, one run of
    all its words if there are fewer; a null, empty or blank text has the empty set
    and links with nothing.  Sets link at 100 * intersection >= 85 * union,
    equal sets always.  component_id is the smallest doc_id that links reach,
    the row's own included; null ids count only where there is no other.
    Repeated rows stay as often as they are there.  An empty table gives an empty table.
    Other columns are not read.
    """
    spark = docs.sparkSession
    rows = C.located(docs.select("doc_id", "text"), "join-docs")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_PLACE)
    ranks = spark.sparkContext.broadcast(shingle_ranks(rows, rows.count()))
    with C.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}):
        sets = C.written(
            rows.select("doc_id", *_PLACE, "text").mapInArrow(
                _sketch(ranks), f"doc_id long, {C.FILE} long, {C.ROW} long, node binary, size long, rarity float, "
                                "prefix array<long>, bitmap binary"), "sets")
    # one row for each distinct set; its other columns follow from the set
    first = F.struct(*_PLACE)
    places = C.written(
        sets.filter("size > 0").groupBy("node").agg(
            F.min(first).alias("first"), F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
        .select("node", "doc_id", "copies", *[F.col(f"first.{c}").alias(c) for c in _PLACE]), "nodes")
    # a number for each set instead of its digest: a hash that is seen to be one to one
    for seed in range(64):
        number = F.xxhash64("node", F.lit(seed))
        if places.groupBy(number.alias("number")).count().filter("count > 1").isEmpty():
            break
    sets, places = (t.withColumn("node", F.when(F.col("node").isNotNull(), number)) for t in (sets, places))
    nodes = sets.join(C.sized_broadcast(places.select(*_PLACE)), _PLACE, "left_semi")
    members = C.written(tree_members(nodes).withColumn("band", _band("size")), "trees")

    texts = rows.select("text", *_PLACE)
    node_places = places.select("node", *_PLACE)
    near = verified(plausible(_first_pairs(members), nodes), node_places, texts, "first")
    left = C.written(_unresolved(members, components(thinned(near))), "unresolved")
    far = verified(tree_pairs(left, nodes.select("node", "bitmap")), node_places, texts, "tree")
    labels = components(thinned(near).union(far))

    named = (places.select("node", "doc_id", "copies").join(labels, "node", "left")
             .filter("label is not null or copies > 1").withColumn("label", F.coalesce("label", "node")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_node = C.written(named.join(least, "label").select("node", "component_id"), "components")
    return (sets.select("doc_id", "node", F.col("size").alias("n_shingles"))
            .join(C.sized_broadcast(of_node), "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
