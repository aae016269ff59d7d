"""Near-duplicate detection by Order MinHash.

A document is the sequence of its runs of ``SHINGLE`` words, each labelled with
its occurrence number.  A sketch entry takes the ``ELL`` smallest of them under
one hash order and keeps them in text order, so entries agree for texts with
the same shingles in the same order, which is what edit similarity asks for.
``ROWS`` entries and the length class make the key of a band; texts that share
a key are candidates.  Equal texts are one node from the start.

Buckets only say who might belong together: each member is tied to the
smallest one of its bucket, and the components of these ties are groups, so a
text travels once however many buckets hold it.  A group's members are first
aligned with its head, a text each.  What that links is one class; members
left over are compared with the whole group, in blocks of ``BLOCK``: a task
takes two blocks, gets the set similarity of all their pairs from one matrix
product over shared shingles, and aligns the pairs that reach the threshold,
unless links found before already join them.  G members of which R are left
over send G texts and another G + R * G / BLOCK, and no pair is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C
from connscore.llm import words as W
from connscore.llm.components import components, thinned

#: Words of a shingle, and the least similarity of near-duplicates.
SHINGLE, SIMILARITY = 5, 0.8

#: Shingles of a sketch entry, entries of a band, bands.  At similarity 0.8 an
#: entry agrees with probability 0.64, a band 0.41, one of 16 bands 0.9998.
ELL, ROWS, BANDS = 2, 2, 16

#: Members of a group that one task compares with each other or with as many others.
BLOCK = 500

_PLACE = [C.FILE, C.ROW]
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_rng = np.random.default_rng(20240607)
_SEEDS = _rng.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)
_ODDS = _rng.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk, and the first of each document; fewer words make one shingle."""
    lengths = np.diff(w.offsets)
    counts = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    first = np.concatenate(([0], np.cumsum(counts)))
    start = np.arange(first[-1]) + np.repeat(w.offsets[:-1] - first[:-1], counts)
    end = np.minimum(start + SHINGLE, np.repeat(w.offsets[1:], counts))
    return W._ranges_hash(w.hash, start, end, W._WORD_BASE), first


def _labelled(shingles: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hash of each shingle with its occurrence number in its document."""
    key = shingles ^ W.mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    starts = np.flatnonzero(new)
    times = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    occurrence = np.empty(len(key), np.uint64)
    occurrence[order] = times
    return W.mix(shingles + occurrence * np.uint64(0x9E3779B97F4A7C15))


def band_keys(w: W.Words) -> np.ndarray:
    """Keys of each document of a chunk, (documents, BANDS); rows of documents without words are 0."""
    shingles, first = _shingles(w)
    out = np.zeros((len(first) - 1, BANDS), np.uint64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    starts, counts = first[:-1][full], np.diff(first)[full]
    labels = _labelled(shingles, np.repeat(full, counts))
    entries = []
    for seed, odd in zip(_SEEDS, _ODDS, strict=True):
        order = (labels ^ seed) * odd
        picked = []
        for k in range(ELL):
            least = np.minimum.reduceat(order, starts)
            hit = np.flatnonzero(order == np.repeat(least, counts))
            place = hit[np.searchsorted(hit, starts)]
            picked.append(np.where(counts > k, place, picked[0] if picked else place))
            order[place] = _MAX
        in_order = np.sort(np.stack(picked), axis=0)
        entry = np.zeros(len(full), np.uint64)
        for places in in_order:
            entry = W.mix(entry * np.uint64(0xD6E8FEB86659FD93) + labels[places])
        entries.append(entry)
    for band in range(BANDS):
        key = np.full(len(full), band + 1, np.uint64)
        for entry in entries[band * ROWS:(band + 1) * ROWS]:
            key = W.mix(key * np.uint64(0xA24BAED4963EE407) + entry)
        out[full, band] = key
    return out


def _length_class(n: np.ndarray) -> np.ndarray:
    """Similar texts are at most one class apart."""
    return np.floor(np.log(np.maximum(n, 1)) / -math.log(SIMILARITY)).astype(np.uint64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, file, row, text) to (doc_id, file, row, digest of the words, keys)."""
    for batch in batches:
        for w in W.chunks(batch.column(3)):
            part = batch.slice(w.first, len(w.offsets) - 1)
            lengths = np.diff(w.offsets)
            shingles = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
            bands, size = band_keys(w), _length_class(shingles)[:, None]
            keys = np.concatenate([W.mix(bands ^ W.mix(size + np.uint64(k + 1))) for k in (0, 1)], axis=1)
            digests = []
            for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
                body = w.data[w.start[a]:w.end[b - 1]] if b > a else b""
                digests.append(hashlib.blake2b(body, digest_size=16).digest())
            used = lengths > 0
            offsets = np.concatenate(([0], np.cumsum(used * keys.shape[1])))
            yield pa.record_batch({
                "doc_id": part.column(0), C.FILE: part.column(1), C.ROW: part.column(2),
                "digest": pa.array(digests, pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                 pa.array(keys[used].view(np.int64).ravel(), pa.int64()))})


def aligned(a: list[int], b: list[int], least: float = SIMILARITY) -> float:
    """Similarity of two shingle sequences: matches of the best alignment over the union, 0 if under ``least``.

    The alignment is a longest common subsequence, one big-integer row per
    shingle, within the band of diagonals that a pair of at least that
    similarity cannot leave.
    """
    na, nb = len(a), len(b)
    if not na or not nb:
        return 1.0 if na == nb else 0.0
    if min(na, nb) < least * max(na, nb):
        return 0.0
    head = 0
    while head < min(na, nb) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(na, nb) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    band = int((na + nb) * (1 - least) / (1 + least) + 1e-9)
    a, b = a[head:na - tail], b[head:nb - tail]
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    full = (1 << len(b)) - 1
    free = full
    for i, x in enumerate(a):
        hit = 0
        for j in places.get(x, ()):
            if -band <= i - j <= band:
                hit |= 1 << j
        if hit:
            taken = free & hit
            free = ((free + taken) | (free - taken)) & full
    matches = head + tail + len(b) - free.bit_count()
    score = matches / (na + nb - matches)
    return score if score >= least - 1e-12 else 0.0


def _sequence(text: str | None) -> tuple[list[int], np.ndarray]:
    """Shingles of a text in order, and the sorted labelled ones."""
    for w in W.chunks(pa.array([text], pa.string())):
        shingles = _shingles(w)[0]
        if len(shingles):
            return shingles.tolist(), np.sort(_labelled(shingles, np.zeros(len(shingles), np.int64)))
    return [], np.empty(0, np.uint64)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Number of labelled shingles that each two of the sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = times > 1
    column = (np.cumsum(many) - 1)[which]
    held = many[which]
    owner, column = owner[held], column[held]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(many.sum()), 1024):
        at = slice(*np.searchsorted(column, [low, low + 1024]))
        part = np.zeros((len(sets), 1024), np.float32)
        part[owner[at], column[at] - low] = 1
        out += part @ part.T
    return out


def _alignment(a: tuple, b: tuple) -> float:
    """Similarity of two texts' shingles, 0 if under the threshold; sets decide first."""
    shared = len(np.intersect1d(a[1], b[1], assume_unique=True))
    return aligned(a[0], b[0]) if shared >= SIMILARITY * (len(a[1]) + len(b[1]) - shared) - 1e-3 else 0.0


def _head_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, chunk, node, text), each chunk's head first, to the members that link to their head."""
    now, head = None, None
    for batch in batches:
        found = []
        for label, chunk, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = _sequence(text)
            if (label, chunk) != now:
                now, head = (label, chunk), own
            elif score := _alignment(head, own):
                found.append((label, node, score))
        yield pa.record_batch({"a": pa.array([x[0] for x in found], pa.binary()),
                               "b": pa.array([x[1] for x in found], pa.binary()),
                               "similarity": pa.array([x[2] for x in found], pa.float64())})


def _group_links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between members left over (role 1) and a block of their group (role 2), or in a whole group (role 0).

    Members that are linked to the group's head (``main``) are one class from the start.
    """
    rows = rows.sort_values(["role", "node"], ignore_index=True)
    nodes, role = rows["node"].tolist(), rows["role"].to_numpy()
    texts = [_sequence(t) for t in rows["text"]]
    sizes = np.array([len(x[1]) for x in texts])
    shared = _shared([x[1] for x in texts])
    union = sizes[:, None] + sizes[None, :] - shared
    near = np.triu(shared >= SIMILARITY * union - 1e-3, 1)
    if role.any():
        near &= role[:, None] != role[None, :]
    seen: dict = {}
    root = [seen.setdefault("main" if main else node, i) for i, (node, main) in
            enumerate(zip(nodes, rows["main"], strict=True))]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for a, b in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        top_a, top_b = find(a), find(b)
        if top_a != top_b and (score := aligned(texts[a][0], texts[b][0])):
            root[max(top_a, top_b)] = min(top_a, top_b)
            links.append((nodes[a], nodes[b], score))
    return pd.DataFrame(links, columns=["a", "b", "similarity"])


def candidate_ties(nodes: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket beside the smallest one."""
    buckets = nodes.select(F.explode("keys").alias("key"), "node")
    lead = (buckets.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
            .filter("n > 1").select("key", "lead"))
    return (buckets.join(lead, "key").filter("node <> lead")
            .select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())


def group_places(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(label, part, block, role, node, main): the tasks that compare what the heads left over, and who goes there.

    ``members`` has label, node and main (linked to the group's head).  Groups without
    anything left over are done.
    """
    groups = members.groupBy("label").agg(F.count("*").alias("n"), F.count_if(~F.col("main")).alias("rest"))
    dealt = members.join(groups.filter("rest > 0").select(
        "label", F.ceil(F.col("n") / block).cast("int").alias("blocks"),
        F.ceil(F.col("rest") / block).cast("int").alias("parts")), "label")
    hashed, zero = F.xxhash64("node"), F.lit(0)
    block_of, part_of = (F.pmod(hashed, F.col(c)).cast("int") for c in ("blocks", "parts"))

    def place(part, to, role):
        return F.struct(part.alias("part"), to.alias("block"), F.lit(role).alias("role"))

    as_block = F.transform(F.sequence(zero, F.col("parts") - 1), lambda p: place(p, block_of, 2))
    as_part = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda b: place(part_of, b, 1))
    places = (F.when(F.col("blocks") == 1, F.array(place(zero, zero, 0)))
              .when(F.col("main"), as_block).otherwise(F.concat(as_block, as_part)))
    return dealt.select("label", "node", "main", F.inline(places))


def verified_links(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """Links (a, b, similarity) that join all near-duplicates among the candidates.

    ``nodes`` has node and keys, ``texts`` gives node and text for a table of
    wanted nodes.
    """
    member = components(C.written(thinned(candidate_ties(nodes)), "ties"))
    groups = member.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    dealt = member.join(groups, "label").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    heads = groups.select("label", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                          F.col("label").alias("node"))
    rows = dealt.filter("node <> label").select("label", "chunk", "node").union(heads)
    found = (rows.join(texts(member.select("node")), "node").select("label", "chunk", "node", "text")
             .repartition("label", "chunk").sortWithinPartitions("label", "chunk", F.col("node") != F.col("label")))
    to_head = C.written(found.mapInArrow(_head_links, "a binary, b binary, similarity double"), "head-links")
    done = to_head.select(F.col("b").alias("node"), F.lit(True).alias("main"))
    left = C.written(group_places(member.join(done, "node", "left").withColumn(
        "main", F.coalesce("main", F.col("node") == F.col("label"))), block), "left-over")
    rest = (left.join(texts(left.select("node").distinct()), "node").groupBy("label", "part", "block")
            .applyInPandas(_group_links, "a binary, b binary, similarity double"))
    return to_head.union(rest)


def near_dedup(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, class_id, class_size, kept.

    class_id is the smallest doc_id among the rows whose texts are linked
    (similarity of the aligned five-word shingles at least 0.8), directly or
    through others.  Texts with the same words are one class; null, empty and blank
    texts are one such class.  Texts under five words are one shingle.  kept
    is true for one row per class: smallest doc_id (null last), then place.  An
    empty table gives an empty result.
    """
    return located_dedup(C.located(docs.select("doc_id", "text"), "near-docs"))


def located_dedup(located: DataFrame) -> DataFrame:
    """``near_dedup`` of rows that have the place columns of ``common.located``; the result has them too."""
    rows = located.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_PLACE)
    with C.settings(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}):
        sketches = C.written(
            rows.select("doc_id", *_PLACE, "text").mapInArrow(
                _sketch, f"doc_id long, {C.FILE} long, {C.ROW} long, digest binary, keys array<long>"),
            "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *_PLACE)
    nodes = C.written(
        sketches.groupBy(F.col("digest").alias("node"))
        .agg(F.min(first).alias("first"), F.count("*").alias("copies"),
             F.first("keys").alias("keys")),
        "nodes")

    def texts(wanted: DataFrame) -> DataFrame:
        places = wanted.join(nodes, "node").select("node", *[f"first.{c}" for c in _PLACE])
        return rows.join(C.sized_broadcast(C.written(places, "places")), _PLACE).select("node", "text")

    links = C.written(verified_links(nodes, texts), "links")
    labels = components(links)
    named = (nodes.select("node", "first", "copies").join(labels, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    classes = named.groupBy("label").agg(F.min("first").alias("head"),
                                         F.sum("copies").cast("long").alias("class_size"))
    of_node = named.join(classes, "label").select(F.col("node").alias("digest"), "head", "class_size")
    own = ((F.col(C.FILE) == F.col(f"head.{C.FILE}")) & (F.col(C.ROW) == F.col(f"head.{C.ROW}")))
    return (sketches.drop("keys").join(of_node, "digest")
            .select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size",
                    own.alias("kept"), *_PLACE))


def kept_rows(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, with all its columns, whatever those are called.

    It is the one with the smallest doc_id (null last), then the first in
    place; null, empty and blank texts are one class.  An empty table stays empty.
    """
    plain, named = C.plain_names(docs, ["doc_id", "text"])
    rows = C.located(plain, "near-docs")
    kept = located_dedup(rows).filter("kept").select(*_PLACE)
    return named(rows.join(kept, _PLACE, "left_semi"))
