"""Byte-level BPE by corpus-level merge replay.

The distinct pieces of a block of documents lie one after another as byte
tokens.  An inverted index leads from each mergeable token pair to the
positions where it stands.  Merges are applied in rank order to all their
positions at once; a merge touches only its two neighbours, whose new pairs
join the index.  Pieces met before are not replayed again (bounded cache).
Each task replays the corpus part it reads, so no vocabulary of the whole
corpus is gathered anywhere.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct pieces whose ids a worker keeps between blocks; rows of a block.
CACHED_PIECES, BLOCK_ROWS = 600_000, 2048

_NONE = np.int64(1 << 40)


class Merges:
    """A rank file: token bytes by id, and the rank of each pair that may merge."""

    def __init__(self, path: str, size: int | None = None):
        """The first ``size`` tokens of the file, or all."""
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)
                          if size is None or int(b) < size}
        self.size = max(self.ranks.values()) + 1
        self.token = {i: t for t, i in self.ranks.items()}
        self.decimal = {i: str(i) for i in self.token}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for t, r in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = r
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64(1) << 62)
        self.values = np.array([pairs[k] for k in keys.tolist()] + [0], np.int64)
        self.known: dict[str, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def replay(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        if not n:
            return [np.empty(0, np.int64) for _ in pieces]
        token = np.append(self.byte[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        last = np.zeros(n + 1, bool)      # last token of its piece
        last[ends[sizes > 0] - 1] = True
        first = np.zeros(n + 1, bool)
        first[(ends - sizes)[sizes > 0]] = True
        pair = np.full(n + 1, _NONE)      # rank of the pair that begins here
        open_ = np.flatnonzero(~last[:n])
        pair[open_] = self.rank(token[open_], token[open_ + 1])
        held = np.flatnonzero(pair < _NONE)
        held = held[np.argsort(pair[held], kind="stable")]
        ranks, starts = np.unique(pair[held], return_index=True)
        index = {r: [p] for r, p in zip(ranks.tolist(), np.split(held, starts[1:]), strict=False)}
        queue = list(index)
        heapq.heapify(queue)
        odd: set[int] = set()
        while queue:
            r = heapq.heappop(queue)
            at = np.concatenate(index.pop(r))
            at = at[pair[at] == r]
            if len(at) > 1:
                at = np.unique(at)
                follows = after[at[:-1]] == at[1:]
                if follows.any():         # a a a: from the left, every other one of a chain
                    chain = np.arange(len(at))
                    head = np.append(True, ~follows)
                    at = at[(chain - np.maximum.accumulate(np.where(head, chain, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            next_ = after[gone]
            token[at] = r
            pair[gone] = _NONE
            ended = last[gone]
            last[at] = ended
            after[at] = next_
            before[next_] = at
            pair[at] = _NONE
            right = at[~ended]
            left = before[at[~first[at]]]
            touched = np.unique(np.concatenate((right, left)))
            new = self.rank(token[touched], token[after[touched]])
            pair[touched] = new
            joins = new < _NONE
            touched, new = touched[joins], new[joins]
            if len(new):
                if new.min() < r:         # an earlier merge came up: those pieces one by one
                    odd.update(owner[touched[new < r]].tolist())
                order = np.argsort(new, kind="stable")
                touched, new = touched[order], new[order]
                cuts = np.flatnonzero(np.append(True, new[1:] != new[:-1]))
                for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(new)], strict=True):
                    k = int(new[low])
                    if k in index:
                        index[k].append(touched[low:high])
                    else:
                        index[k] = [touched[low:high]]
                        heapq.heappush(queue, k)
        alive = np.ones(n, bool)
        alive[:] = False
        chain = np.flatnonzero(first[:n])
        while len(chain):
            alive[chain] = True
            chain = after[chain[~last[chain]]]
        ids, who = token[:n][alive], owner[alive]
        out = np.split(ids, np.searchsorted(who, np.arange(1, len(pieces))))
        for i in odd:
            out[i] = np.array(self.one_by_one(pieces[i]), np.int64)
        return out

    def one_by_one(self, piece: bytes) -> list[int]:
        """Ids of one piece: the smallest rank first, the leftmost of equal ones."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces as little-endian 32-bit numbers, replaying those not known."""
        if len(self.known) + len(pieces) > CACHED_PIECES:
            self.known = {}
        new = [p for p in pieces if p not in self.known]
        raw = [p.encode() for p in new]
        merged = [i for i, p in enumerate(raw) if p not in self.ranks]
        for i, p in enumerate(raw):
            if p in self.ranks:
                self.known[new[i]] = np.array([self.ranks[p]], "<u4").tobytes()
        for i, ids in zip(merged, self.replay([raw[i] for i in merged]), strict=True):
            self.known[new[i]] = ids.astype("<u4").tobytes()
        return self.known


@cache
def merges(path: str, size: int | None = None) -> Merges:
    return Merges(path, size)


def encode(path: str, pattern: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of each whole text."""
    table, cut = merges(path), regex.compile(pattern)
    split = [cut.findall(t) for t in texts]
    wanted: set[str] = set()
    for s in split:
        wanted.update(s)
    known = table.learn(wanted)
    return [np.frombuffer(b"".join(map(known.__getitem__, s)), "<u4") for s in split]


def decode(path: str, ids: list[int]) -> bytes:
    return b"".join(map(merges(path).token.__getitem__, ids))


def _round_trip(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = merges(path).decimal
        for whole in batches:
            for low in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(low, BLOCK_ROWS)
                n, ids_sha, decoded_sha = [], [], []
                for ids in encode(path, pattern, [t or "" for t in batch.column(1).to_pylist()]):
                    ids = ids.tolist()
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(decode(path, ids)).hexdigest())
                yield pa.record_batch({"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()),
                                       "ids_sha256": pa.array(ids_sha), "decoded_sha256": pa.array(decoded_sha)})
    return run


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``path`` is a rank file (base64 token, rank), ``pattern`` cuts a text into
    the pieces that are merged by themselves.  Null and empty texts have no
    token and the digests of no bytes; an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _round_trip(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
