"""Substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the
smallest hash among its runs of ``MINIMISER`` words.  Consecutive windows with
one minimiser travel as one packed string (their words, once) to the bucket of
that minimiser, so equal windows always meet, and there a sort by window hash
with a comparison of the whole words counts them exactly.

Two shuffles keep what travels small.  First only the minimisers go to their
buckets and are counted: a window whose minimiser occurs once in the table
cannot start elsewhere, and its words never travel.  Then the packed strings
of the other super-k-mers are cut from the texts and sent.

In both shuffles each block of documents sends an item once: what occurs more
than once in the block is known to be repeated there, is reported at once, and
travels alone, marked as held twice.  A passage that a third of the documents
share so reaches its bucket once per block.  The number of buckets follows the
bytes of the table.

Strings that hold the edge of such a passage, or a shared line, differ by what
each document has around it, and would all go to the bucket of one minimiser.
So the windows of minimisers with more than ``HOT_WINDOWS`` of them in the
table travel one by one to buckets of their own hashes, where equal ones meet.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C
from connscore.llm import words as W

#: Words of a window, and of the runs whose smallest hash is its minimiser.
WINDOW, MINIMISER = 35, 10

#: Windows of the longest packed string; longer runs are cut (same bucket).
LONGEST_RUN = 64

#: Text bytes whose windows share a bucket, and packed bytes a task holds before it sends them.
BUCKET_BYTES, HELD_BYTES = 8 << 20, 16 << 20

#: Windows of a minimiser above which they are dealt by their own hashes, bytes that count for one of them.
HOT_WINDOWS, WINDOW_BYTES = 1 << 15, 256

#: Minimisers a task holds before it sends them.
HELD_RUNS = 1 << 20

_PLACE = [C.FILE, C.ROW]
_SENT = "bucket long, n int, payload binary"
_SPANS = f"{C.FILE} long, {C.ROW} long, first int, last int"
_RUNS = f"{C.FILE} long, {C.ROW} long, first int, windows int, minimiser long"


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _super_runs(w: W.Words, window: int, minimiser: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, minimiser of each super-k-mer; whether it holds the minimiser twice."""
    none = np.empty(0, np.int64)
    lengths = np.diff(w.offsets)
    if not len(lengths) or lengths.max() < window:
        return none, none, none, none
    reach = window - minimiser + 1
    grams = W.grams(w.hash, minimiser)
    least = _sliding_minimum(grams, reach)
    counts = np.maximum(lengths - window + 1, 0)
    total = int(counts.sum())
    at = np.arange(total) + np.repeat(w.offsets[:-1] - (np.cumsum(counts) - counts), counts)
    value = least[at]
    new = np.empty(total, dtype=bool)
    new[0] = True
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(new)
    run = np.arange(total) - np.repeat(starts, np.diff(np.append(starts, total)))
    starts = np.flatnonzero(run % LONGEST_RUN == 0)
    first, n, value = at[starts], np.diff(np.append(starts, total)), value[starts]
    spans = n + reach - 1
    before = np.cumsum(spans) - spans
    inside = np.arange(int(spans.sum())) + np.repeat(first - before, spans)
    times = np.add.reduceat((grams[inside] == np.repeat(value, spans)).astype(np.int32), before)
    return first, n, value, times > 1


def _pack(strings: list[bytes], numbers: list[np.ndarray]) -> bytes:
    body = b"\n".join(strings)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in numbers) + body)


def _unpack(payload: bytes, n: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    file = np.frombuffer(raw, np.int64, n)
    row = np.frombuffer(raw, np.int64, n, 8 * n)
    first = np.frombuffer(raw, np.int32, n, 16 * n)
    twice = np.frombuffer(raw, np.int8, n, 20 * n)
    return raw[21 * n:].split(b"\n"), file, row, first, twice


class _Sender:
    """Packed strings of a block, each once, until they are sent to their buckets."""

    def __init__(self, n_buckets: int, window: int):
        self.n_buckets, self.window = n_buckets, window
        self.clear()

    def clear(self) -> None:
        self.held: dict[bytes, list] = {}   # string: bucket, file, row, first word, held twice
        self.spans: list[tuple[int, int, int, int]] = []
        self.bytes = 0

    def add(self, text: bytes, bucket: int, file: int, row: int, first: int, n_windows: int) -> None:
        seen = self.held.get(text)
        if seen is None:
            self.held[text] = [bucket, file, row, first, 0]
            self.bytes += len(text) + 200
            return
        last = n_windows + self.window - 1
        if not seen[4]:
            seen[4] = 1
            self.spans.append((seen[1], seen[2], seen[3], seen[3] + last))
        self.spans.append((file, row, first, first + last))
        self.bytes += 64

    def rows(self) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[bytes]] = {}
        for text, entry in self.held.items():
            by_bucket.setdefault(entry[0], []).append(text)
        buckets, ns, payloads = [], [], []
        for bucket, texts in by_bucket.items():
            entries = [self.held[t] for t in texts]
            buckets.append(bucket)
            ns.append(len(texts))
            payloads.append(_pack(texts, [
                np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64),
                np.array([e[3] for e in entries], np.int32), np.array([e[4] for e in entries], np.int8)]))
        for low in range(0, len(self.spans), 4096):   # known spans share the shuffle; any bucket will do
            part = self.spans[low:low + 4096]
            buckets.append(abs(hash(part[0])) % self.n_buckets)
            ns.append(-len(part))
            payloads.append(zstandard.ZstdCompressor(level=1).compress(np.array(part, np.int64).tobytes()))
        self.clear()
        if buckets:
            yield pa.record_batch({"bucket": pa.array(buckets, pa.int64()), "n": pa.array(ns, pa.int32()),
                                   "payload": pa.array(payloads, pa.binary())})


def _compressed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in arrays))


def _minimisers(n_buckets: int, window: int, minimiser: int):
    """Map side of the first shuffle: texts to (bucket, n, payload of runs)."""
    def send(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        least, file, row, first, n, self_ = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(least, kind="stable")
        ordered = least[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        sizes = np.diff(np.append(starts, len(order)))
        many = (sizes > 1) | np.logical_or.reduceat(self_[order], starts)
        once, more = order[starts[~many]], order[starts[many]]
        sent = np.concatenate((once, more))
        twice = np.concatenate((np.zeros(len(once), np.int8), np.ones(len(more), np.int8)))
        bucket = (W.mix(least[sent]) % np.uint64(n_buckets)).astype(np.int64)
        deal = np.argsort(bucket, kind="stable")
        sent, twice, bucket = sent[deal], twice[deal], bucket[deal]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        buckets, ns, payloads = [], [], []
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
            at = sent[low:high]
            buckets.append(int(bucket[low]))
            ns.append(high - low)
            payloads.append(_compressed(least[at], file[at], row[at], first[at], n[at], twice[low:high]))
        known = order[np.repeat(many, sizes)]
        for low in range(0, len(known), 8192):   # already known to be repeated: any bucket will do
            at = known[low:low + 8192]
            buckets.append(int(row[at[0]] % n_buckets))
            ns.append(-len(at))
            payloads.append(_compressed(least[at], file[at], row[at], first[at], n[at]))
        yield pa.record_batch({"bucket": pa.array(buckets, pa.int64()), "n": pa.array(ns, pa.int32()),
                               "payload": pa.array(payloads, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            file, row = (columns[c].to_numpy(zero_copy_only=False) for c in _PLACE)
            for w in W.chunks(columns["text"]):
                at, n, least, self_ = _super_runs(w, window, minimiser)
                if not len(at):
                    continue
                doc = np.searchsorted(w.offsets, at, side="right") - 1
                parts.append((least, file[doc + w.first], row[doc + w.first],
                              (at - w.offsets[doc]).astype(np.int32), n.astype(np.int32), self_))
                held += len(at)
                if held > HELD_RUNS:
                    yield from send(parts)
                    held = 0
        yield from send(parts)
    return run


def _repeated_minimisers(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Bucket side of the first shuffle: the runs whose minimiser occurs elsewhere too."""
    known, open_ = [], []
    for n, payload in zip(rows["n"], rows["payload"], strict=True):
        raw, m = zstandard.ZstdDecompressor().decompress(payload), abs(n)
        columns = [np.frombuffer(raw, np.int64, m, 8 * m * i) for i in range(3)]
        columns += [np.frombuffer(raw, np.int32, m, 24 * m + 4 * m * i) for i in range(2)]
        if n < 0:
            known.append(columns)
        else:
            open_.append([*columns, np.frombuffer(raw, np.int8, m, 32 * m)])
    out = [np.concatenate([k[i] for k in known]) if known else np.empty(0, np.int64) for i in range(5)]
    if open_:
        least, file, row, first, windows, twice = (np.concatenate(x) for x in zip(*open_, strict=True))
        _, which, times = np.unique(least, return_inverse=True, return_counts=True)
        at = np.flatnonzero((times[which] > 1) & (twice == 0))
        out = [np.concatenate((a, b[at])) for a, b in zip(out, (least, file, row, first, windows), strict=True)]
    return pd.DataFrame({C.FILE: out[1], C.ROW: out[2], "first": out[3].astype(np.int32),
                         "windows": out[4].astype(np.int32), "minimiser": out[0]})


def _strings(n_buckets: int, n_hot: int, window: int):
    """Map side of the second shuffle: texts with their runs to packed strings for their buckets.

    Windows of hot minimisers are strings of their own, in ``n_hot`` buckets after the others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sender(n_buckets, window)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            file, row = (columns[c].to_numpy(zero_copy_only=False) for c in _PLACE)
            runs = columns["__runs"]
            offsets = runs.offsets.to_numpy()
            fields = [runs.values.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
            for w in W.chunks(columns["text"]):
                low, high = offsets[w.first], offsets[w.first + len(w.offsets) - 1]
                doc = np.repeat(np.arange(len(w.offsets) - 1),
                                np.diff(offsets[w.first:w.first + len(w.offsets)]))
                first, n, least, hot = (f[low:high] for f in fields)
                at = first + w.offsets[doc]
                bucket = (W.mix(least.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
                if hot.any():
                    each = np.where(hot, n, 1)   # a string for each window of a hot run
                    nth = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                    first, at, n = (np.repeat(x, each) for x in (first, at, np.where(hot, 1, n)))
                    first, at, doc, hot = first + nth, at + nth, np.repeat(doc, each), np.repeat(hot, each)
                    own = W.mix(W.grams(w.hash, window)[at]) % np.uint64(max(1, n_hot))
                    bucket = np.where(hot, n_buckets + own.astype(np.int64), np.repeat(bucket, each))
                begin, end = w.start[at].tolist(), w.end[at + n + window - 2].tolist()
                bucket = bucket.tolist()
                files, rows = file[doc + w.first].tolist(), row[doc + w.first].tolist()
                firsts, ns, data = first.tolist(), n.tolist(), w.data
                for i, b in enumerate(begin):
                    out.add(data[b:end[i]], bucket[i], files[i], rows[i], firsts[i], ns[i])
                    if out.bytes > HELD_BYTES:
                        yield from out.rows()
        yield from out.rows()
    return run


def _count(window: int):
    """Bucket side: which windows of the packed strings start more than once."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        spans: list[np.ndarray] = []
        index: dict[bytes, int] = {}
        weight: list[int] = []
        places: list[tuple[int, int, int, int]] = []   # string, file, row, first
        for n, payload in zip(rows["n"], rows["payload"], strict=True):
            if n < 0:
                raw = zstandard.ZstdDecompressor().decompress(payload)
                spans.append(np.frombuffer(raw, np.int64).reshape(-1, 4))
                continue
            for text, file, row, first, twice in zip(*_unpack(payload, n), strict=True):
                i = index.setdefault(text, len(weight))
                if i == len(weight):
                    weight.append(0)
                weight[i] += 1 + int(twice)
                if not twice:
                    places.append((i, int(file), int(row), int(first)))
        if places:
            spans.append(_bucket_spans(list(index), np.array(weight), places, window))
        out = np.concatenate(spans) if spans else np.empty((0, 4), np.int64)
        return pd.DataFrame({C.FILE: out[:, 0], C.ROW: out[:, 1], "first": out[:, 2].astype(np.int32),
                             "last": out[:, 3].astype(np.int32)})
    return run


def _bucket_spans(texts: list[bytes], weight: np.ndarray, places: list[tuple[int, int, int, int]],
                  window: int) -> np.ndarray:
    """Spans of words (file, row, first, past the last) under repeated windows."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    w = W.words_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    counts = np.diff(w.offsets) - window + 1
    base = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(owner)) - base[owner] + w.offsets[owner]
    hashes = W.grams(w.hash, window)[at]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, len(order)))
    repeated = np.repeat(weight > 1, counts)
    for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        same = order[s:s + n]
        words = [w.data[w.start[a]:w.end[a + window - 1]] for a in at[same].tolist()]
        if all(x == words[0] for x in words):
            repeated[same] = True
        else:   # equal hashes of different words: count each by its words
            times: dict[bytes, int] = {}
            for x, i in zip(words, same.tolist(), strict=True):
                times[x] = times.get(x, 0) + int(weight[owner[i]])
            repeated[same] = [times[x] > 1 or r for x, r in zip(words, repeated[same], strict=True)]
    out = []
    cache: dict[int, list[tuple[int, int]]] = {}
    for i, file, row, first in places:
        if i not in cache:
            mask = repeated[base[i]:base[i] + counts[i]]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
            cache[i] = [(int(a), int(b) + window - 1) for a, b in edge.reshape(-1, 2)]
        out += [(file, row, first + a, first + b) for a, b in cache[i]]
    return np.array(out, np.int64).reshape(-1, 4)


def sent_strings(rows: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER,
                 bucket_bytes: int = BUCKET_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """(bucket, n, payload): the packed strings of the windows whose minimiser is repeated."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, math.ceil(size / bucket_bytes))
    runs = C.written(
        rows.select(*_PLACE, "text").mapInArrow(_minimisers(n_buckets, window, minimiser), _SENT)
        .groupBy("bucket").applyInPandas(_repeated_minimisers, _RUNS), "runs")
    hot = C.written(runs.groupBy("minimiser").agg(F.sum("windows").alias("n")).filter(F.col("n") > hot_windows),
                    "hot-minimisers")
    n_hot = math.ceil((hot.agg(F.sum("n")).first()[0] or 0) * WINDOW_BYTES / bucket_bytes)
    marked = runs.join(C.sized_broadcast(hot.select("minimiser", F.lit(True).alias("found"))), "minimiser", "left")
    by_row = (marked.withColumn("hot", F.coalesce("found", F.lit(False))).groupBy(*_PLACE)
              .agg(F.collect_list(F.struct("first", "windows", "minimiser", "hot")).alias("__runs")))
    # all columns of rows go along, so this join and the caller's share one exchange of the texts
    return rows.join(by_row, _PLACE).mapInArrow(_strings(n_buckets, n_hot, window), _SENT)


def repeated_spans(rows: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER,
                   bucket_bytes: int = BUCKET_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Spans of words under windows that start elsewhere too.

    ``rows`` has text and the place columns of ``common.located``; the result
    has the place, the first word and the word past the last (they may overlap).
    """
    sent = sent_strings(rows, window, minimiser, bucket_bytes, hot_windows)
    return sent.groupBy("bucket").applyInPandas(_count(window), _SPANS)


def _cut(extra: list[str], text_out: bool):
    """Map side: rows with their spans to what is left of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            totals, removed, result = [], [], []
            for text, spans in zip(columns["text"], columns["__spans"], strict=True):
                value = text.as_py()
                found = (value or "").encode().split()
                totals.append(len(found))
                kept = found
                if spans.is_valid:
                    keep = np.ones(len(found), dtype=bool)
                    for s in spans.as_py():
                        keep[s["first"]:s["last"]] = False
                    kept = [x for x, k in zip(found, keep.tolist(), strict=True) if k]
                removed.append(len(found) - len(kept))
                if text_out:
                    result.append(b" ".join(kept).decode() if removed[-1] else value)
                else:
                    result.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out = {name: columns[name] for name in extra}
            out |= {"n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                    "result": pa.array(result, pa.string())}
            yield pa.record_batch(out)
    return run


def _with_spans(rows: DataFrame, window: int, minimiser: int, bucket_bytes: int,
                hot_windows: int = HOT_WINDOWS) -> DataFrame:
    spans = (repeated_spans(rows, window, minimiser, bucket_bytes, hot_windows)
             .groupBy(*_PLACE).agg(F.collect_list(F.struct("first", "last")).alias("__spans")))
    return rows.join(spans, _PLACE, "left")


def substring_dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER,
                    bucket_bytes: int = BUCKET_BYTES, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of bytes other than ASCII white space.  Each word under a
    window whose words also start anywhere else (same document included) is
    removed, judged on the input.  Null and empty texts have no words and the
    digest of no bytes; texts shorter than a window keep everything; an empty
    table gives an empty result.
    """
    rows = C.located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "substring-docs")
    return (_with_spans(rows, window, minimiser, bucket_bytes, hot_windows).select("doc_id", "text", "__spans")
            .mapInArrow(_cut(["doc_id"], False),
                        "doc_id long, n_words long, n_removed long, result string")
            .withColumnRenamed("result", "kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """``docs`` with the columns as before, whatever they are called, repeated passages cut out of text.

    A text that loses words has its others joined by one space and n_chars
    counted anew; any other text, null and empty ones too, stays as it is, and
    so do all rows.  An empty table stays empty.
    """
    plain, named = C.plain_names(docs, ["text", "n_chars"])
    rows = C.located(plain, "substring-docs")
    others = [c for c in plain.columns if c != "text"]
    fields = [f for f in plain.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["n_words long", "n_removed long", "result string"])
    joined = _with_spans(rows, window, minimiser, BUCKET_BYTES).select(*others, "text", "__spans")
    cut = joined.mapInArrow(_cut(others, True), schema).withColumn("text", F.col("result"))
    if "n_chars" in others:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("result")).otherwise(F.col("n_chars"))
                             .cast(plain.schema["n_chars"].dataType))
    return named(cut)
