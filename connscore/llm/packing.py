"""Best-fit packing of token sequences by a configuration linear program.

Documents become token ids and are cut into pieces of at most ``LENGTH``
tokens.  What the packing needs to know is the histogram of piece lengths: at
most ``LENGTH`` numbers, whatever the size of the corpus.  A configuration is a
multiset of lengths that fits one sequence; the linear program covers the
histogram with the fewest configurations.  Multiplicative weights solve it:
the weight of a length falls as it gets covered, and a knapsack dynamic program
over the weights prices the next configurations.  The solution is rounded down
and what is left is filled by patterns, longest length first, each as often as
the counts allow, so the plan stays a bounded table too.

Every piece then gets its number among the pieces of its length (numbered in
buckets, without one task holding a length), and the plan says where that
number lies.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C

#: Tokens of a sequence; the id that ends a document.
LENGTH, END = 2048, 0

#: Pricing rounds, configurations taken from a round, share of a length that a step covers.
ROUNDS, PER_ROUND, STEP = 120, 64, 0.25

#: Distinct words, and as many stems, whose ids a worker keeps between batches.
CACHED_WORDS = 900_000

_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
_stems: dict[str, _Stems] = {}
_words: dict[str, dict[str, bytes]] = {}
_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
        _tokenizers[path].encode_special_tokens = True
    return _tokenizers[path]


class _Stems(dict):
    """Ids of word parts as 32-bit numbers, each worked out when it is first asked for."""

    def __init__(self, path: str):
        super().__init__()
        tokenizer = _tokenizer(path)
        self._normal = tokenizer.normalizer.normalize_str
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self._merge = tokenizer.model.tokenize

    def __missing__(self, part: str) -> bytes:
        if part.isascii() and part.isalpha() and part.islower():   # as it is after normalising and splitting
            ids = [t.id for t in self._merge(part)]
        else:
            ids = [t.id for piece, _ in self._split(self._normal(part)) for t in self._merge(piece)]
        self[part] = out = array("I", ids).tobytes()
        return out


def _word_ids(word: str, stems: _Stems) -> bytes:
    """Ids of a word without blanks in it."""
    if word.isascii():   # the tokenizer lowers case
        word = word.lower()
    if word.isalnum():
        return stems[word]
    stem = word.strip(_PUNCTUATION)
    if not stem:
        return stems[word]
    at = word.find(stem)
    head, tail = word[:at], word[at + len(stem):]
    if not (stem[0].isalnum() and stem[-1].lower()[-1].isalnum()):   # marks and symbols join punctuation
        return stems[word]
    if tail.startswith("'") or head.endswith("'"):       # contractions join a quote to letters
        return stems[word]
    out = stems[stem]
    if head:
        out = stems[head] + out
    return out + stems[tail] if tail else out


def token_bytes(path: str, texts: list[str], cached: int = CACHED_WORDS) -> Iterator[bytes]:
    """Ids of each text, as the tokenizer gives for the whole text.

    The tokenizer drops white space and cuts before and after a run of
    punctuation next to letters, so blanks split a text, and a word's leading
    and trailing ASCII punctuation is encoded apart from a stem that begins
    and ends in a letter or digit.  A part goes through the tokenizer's own
    normaliser, splitter and merges, without the offsets that a whole encoding
    keeps.
    """
    split = [t.replace("\n", " ").split(" ") for t in texts]
    words = _words.setdefault(path, {})
    if len(words) > cached:
        words.clear()
    if path not in _stems:
        _stems[path] = _Stems(path)
    stems = _stems[path]
    if len(stems) > cached:
        stems.clear()
    for w in set(itertools.chain.from_iterable(split)).difference(words):
        words[w] = _word_ids(w, stems)
    for s in split:
        yield b"".join(map(words.__getitem__, s))


def _pieces(path: str, length: int, cached: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END], "<u4").tobytes()
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                texts = [t or "" for t in batch.column(3).to_pylist()]
                owner, piece, start, size, crc = [], [], [], [], []
                for i, ids in enumerate(token_bytes(path, texts, cached)):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    for k, at in enumerate(range(0, n, length)):
                        part = ids[4 * at:4 * (at + length)]
                        owner.append(i)
                        piece.append(k)
                        start.append(at)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                at = pa.array(owner, pa.int64())
                yield pa.record_batch({
                    "doc_id": batch.column(0).take(at), C.FILE: batch.column(1).take(at),
                    C.ROW: batch.column(2).take(at), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})
    return run


def _knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of lengths (value[L], each as often as wanted) within each capacity, and the last choice."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        total = value[1:c + 1] + best[c - 1::-1] if c > 1 else value[1:2] + best[:1]
        at = int(np.argmax(total))
        if total[at] > best[c - 1]:
            best[c], choice[c] = total[at], at + 1
        else:
            best[c] = best[c - 1]
    return best, choice


def _fill(choice: np.ndarray, capacity: int) -> list[int]:
    out = []
    while capacity > 0:
        if choice[capacity]:
            out.append(int(choice[capacity]))
            capacity -= int(choice[capacity])
        else:
            capacity -= 1
    return out


def solve(histogram: dict[int, int], capacity: int = LENGTH, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Fractional use of configurations that covers the histogram, by multiplicative weights."""
    count = np.zeros(capacity + 1)
    for length, n in histogram.items():
        count[length] = n
    present = np.flatnonzero(count)
    used: dict[tuple[int, ...], float] = {}
    covered = np.zeros(capacity + 1)
    if not len(present):
        return used
    for _ in range(rounds):
        share = covered[present] / count[present]
        value = np.full(capacity + 1, -1.0)
        # the price of a token of a length that is behind the others is higher
        value[present] = present * np.exp(-2.0 * (share - share.min()))
        best, choice = _knapsack(value, capacity)
        gain = value[present] + best[capacity - present]
        for length in present[np.argsort(-gain, kind="stable")[:PER_ROUND]].tolist():
            config = tuple(sorted([length, *_fill(choice, capacity - length)], reverse=True))
            times = {x: config.count(x) for x in set(config)}
            step = STEP * min(count[x] / t for x, t in times.items())
            used[config] = used.get(config, 0.0) + step
            for x, t in times.items():
                covered[x] += step * t
    scale = float((covered[present] * present).sum() / (count[present] * present).sum())
    return {c: x / scale for c, x in used.items()}


def plan(histogram: dict[int, int], capacity: int = LENGTH) -> tuple[np.ndarray, int]:
    """Rows (length, first number, sequence of it, pieces per sequence, offset), sorted, and the sequences."""
    left = {length: n for length, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    rows, sequences = [], 0

    def use(config: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length, each in config:
            rows.append((length, taken[length], sequences, each, offset))
            taken[length] += each * times
            left[length] -= each * times
            offset += each * length
        sequences += times

    if left.get(capacity):
        use([(capacity, 1)], left[capacity])
    solved = solve({x: n for x, n in left.items() if n and x < capacity}, capacity)
    for config, x in sorted(solved.items(), key=lambda item: (-item[1], item[0])):
        counted = [(length, len(list(g))) for length, g in itertools.groupby(config)]
        times = min([int(x), *(left[length] // each for length, each in counted)])
        if times > 0:
            use(counted, times)
    lengths = sorted((x for x, n in left.items() if n), reverse=True)
    while lengths:   # what rounding left: a pattern uses up at least one length
        free, config = capacity, []
        for length in lengths:
            each = min(left[length], free // length)
            if each:
                config.append((length, each))
                free -= each * length
        use(config, min(left[length] // each for length, each in config))
        lengths = [x for x in lengths if left[x]]
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return table, sequences


def _placed(table: np.ndarray):
    starts = (table[:, 0] << 44) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            length, number = columns["length"].to_numpy(), columns["number"].to_numpy()
            row = table[np.searchsorted(starts, (length << 44) + number, side="right") - 1]
            within = number - row[:, 1]
            out = {k: v for k, v in columns.items() if k != "number"}
            out["sequence_id"] = pa.array(row[:, 2] + within // row[:, 3])
            out["offset"] = pa.array(row[:, 4] + within % row[:, 3] * length)
            yield pa.record_batch(out)
    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH,
         cached: int = CACHED_WORDS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The names of the tokenizer's special tokens are ordinary text in a document
    (its ``encode_special_tokens``), so no text can end a sequence by itself.
    A null text is empty: one piece that holds the end id alone.  Repeated
    rows and ids are packed each for itself.  An empty table gives no piece.
    Workers keep the ids of ``cached`` words and stems, which costs about 300
    bytes each; with fewer, more words are encoded again.
    The histogram and the plan have at most ``length`` and a few thousand rows.
    """
    rows = C.located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "packing-docs")
    kept = f"doc_id long, {C.FILE} long, {C.ROW} long, piece int, start long, length long, ids_crc32 long"
    pieces = C.written(rows.select("doc_id", C.FILE, C.ROW, "text")
                       .mapInArrow(_pieces(tokenizer_path, length, cached), kept), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}   # at most `length` rows
    table, _ = plan(histogram, length)
    numbered = C.numbered(pieces, ["length"], ["doc_id", C.FILE, C.ROW, "piece"], "number",
                          sum(histogram.values()))
    return (numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number")
            .mapInArrow(_placed(table), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                        "sequence_id long, offset long"))
