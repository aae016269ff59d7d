"""Language-model scores by a causal self-attention model over subword codes.

Words are spelled in the first ``TOKENS`` byte-level BPE tokens of a public
vocabulary; a code is a token and whether it ends its word, so the codes of a
word are never the beginning of another word's.  One block of causal
self-attention, trained in numpy, predicts a code from those before it; the
output is factored, first the class of the code and then the code in it.  It
learns from every code of every training text; tasks train on their own and are
averaged in rounds.  A text runs through windows of ``WINDOW`` codes that overlap by ``OVERLAP``, in
batches under one causal mask, and each code is scored once.  With one block a
shared code only needs its key and value again, so the overlap costs little.

The word's probability under attention is mixed in equal parts with its share
of all training tokens, which is counted over the whole corpus: a task sends
each distinct word of a block of rows once, counts are summed by word, and
every block gets back the counts of its own words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.llm import common as C
from connscore.llm import words as W
from connscore.llm.bpe import merges

#: Tokens of the spelling; codes are 2 * (TOKENS + 1) = CLASSES * MEMBERS.
TOKENS, CLASSES, MEMBERS = 2047, 64, 64
END = 2 * TOKENS + 1

#: Codes of a window, codes a window shares with the one before, width of the model.
WINDOW, OVERLAP, WIDTH = 64, 32, 16

#: Bytes of a training passage, passages that are coded at once, bytes of windows that a task takes in a round.
PASSAGE, RUN_PASSAGES, LEAST_BYTES = 1024, 2048, 4 << 20

#: Least steps of training over all tasks, windows of a step, averages of the tasks' models, pieces of a sent model.
STEPS, BATCH, ROUNDS, PIECES = 3000, 64, 12, 16

#: Windows scored at once, windows whose gradients are found at once: their arrays stay in a core's cache.
RUN, PART = 64, 32

#: Weight of the attention model in the mixture, rows of a counting block, cached words.
MIX, BLOCK_ROWS, CACHED_WORDS = 0.5, 2048, 800_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
_codes: dict[str, dict[int, bytes]] = {}
_room: dict[tuple[str, np.dtype], np.ndarray] = {}


# --- the model ---------------------------------------------------------------

def _initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
    d = WIDTH
    return {"embed": draw(2 * (TOKENS + 1), d) * 40, "place": draw(WINDOW, d) * 0.5,
            "qkv": draw(d, 3 * d), "out": draw(d, d) * 0.5, "up": draw(d, 2 * d),
            "bias": np.zeros(2 * d, np.float32), "down": draw(2 * d, d) * 0.5,
            "head": draw(d, CLASSES), "head_bias": np.zeros(CLASSES, np.float32),
            "gate": draw(d, d), "of_class": draw(CLASSES, d),
            "member": draw(d, MEMBERS), "member_bias": np.zeros((CLASSES, MEMBERS), np.float32)}


def _kept(name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
    """Room that the next windows use again: getting fresh memory costs more than filling it."""
    size, room = math.prod(shape), _room.get((name, dtype))
    if room is None or len(room) < size:
        room = _room[name, dtype] = np.empty(size, dtype)
    return room[:size].reshape(shape)


def _scaled(qkv: np.ndarray) -> np.ndarray:
    """The weights of queries (or their gradient) divided by the root of the width, those of keys and values as they are."""
    out = qkv.copy()
    out[:, :WIDTH] /= qkv.dtype.type(math.sqrt(WIDTH))
    return out


def _body(p: dict[str, np.ndarray], inputs: np.ndarray, first: int = 0) -> tuple[np.ndarray, tuple]:
    """Hidden state of each position from ``first`` on of (windows, up to WINDOW) input codes.

    Attention is kept as exponentials and the inverse of their sums.
    """
    many, size = inputs.shape
    d, kind = WIDTH, p["embed"].dtype
    x = _kept("x", (many, size, d), kind)
    np.take(p["embed"], inputs, axis=0, out=x, mode="clip")
    x += p["place"][:size]
    qkv = np.matmul(x.reshape(-1, d), _scaled(p["qkv"]), out=_kept("qkv", (many * size, 3 * d), kind)).reshape(many, size, 3 * d)
    q, k, v = qkv[:, first:, :d], qkv[..., d:2 * d], qkv[..., 2 * d:]
    a = np.matmul(q, k.transpose(0, 2, 1), out=_kept("scores", (many, size - first, size), kind))
    a += _MASK[first:size, :size]
    a, sums, _ = _exponentials(a, "attention")
    inverse = 1 / sums[..., None]
    y = np.matmul(a, v, out=_kept("y", (many, size - first, d), kind))
    y *= inverse
    z = y.reshape(-1, d) @ p["out"]
    z += x[:, first:].reshape(-1, d)
    up = np.matmul(z, p["up"], out=_kept("up", (len(z), 2 * d), kind))
    up += p["bias"]
    np.maximum(up, 0, out=up)
    h = up @ p["down"]
    h += z
    return h, (x, q, k, v, a, inverse, y, z, up)


def _exponentials(x: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of ``x`` (which may be overwritten) under a shift, their sums over the last axis, and the shift.

    One shift for all rows, none if it is small, is much faster; rows far below it get their own.
    """
    shift = x.max()
    if abs(shift) < 40:
        shift = x.dtype.type(0)
    else:
        x -= shift
    raised = np.exp(x, out=_kept(name, x.shape, x.dtype))
    sums = raised @ np.ones(x.shape[-1], x.dtype)
    if sums.min() < 1e-20:
        own = x.max(axis=-1)
        x -= own[..., None]
        np.exp(x, out=raised)
        return raised, raised.sum(axis=-1), shift + own
    return raised, sums, shift


def _head(p: dict[str, np.ndarray], h: np.ndarray) -> np.ndarray:
    x = np.matmul(h, p["head"], out=_kept("scores", (len(h), CLASSES), h.dtype))
    x += p["head_bias"]
    return x


def _member(p: dict[str, np.ndarray], h: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What members of the classes ``high`` are told apart by, and their scores."""
    gate = h @ p["gate"]
    gate += p["of_class"][high]
    np.maximum(gate, 0, out=gate)
    x = np.take(p["member_bias"], high, axis=0, out=_kept("biases", (len(h), MEMBERS), h.dtype), mode="clip")
    x += np.matmul(gate, p["member"], out=_kept("scores", (len(h), MEMBERS), h.dtype))
    return gate, x


def _softmax_less(x: np.ndarray, at: np.ndarray, name: str) -> np.ndarray:
    """Softmax of each row of ``x``, less one at one place."""
    raised, sums, _ = _exponentials(x, name)
    raised *= (1 / sums)[:, None]
    raised[np.arange(len(at)), at] -= 1
    return raised


def _picked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of each row of ``x`` at one place."""
    own = x[np.arange(len(x)), at]
    _, sums, shift = _exponentials(x, "raised")
    return own - shift - np.log(sums)


def log_probabilities(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray,
                      keep: np.ndarray, first: int = 0) -> np.ndarray:
    """Natural log probability of the targets at the kept ones of the positions from ``first`` on."""
    if not keep.any():
        return np.empty(0, p["embed"].dtype)
    h = _body(p, inputs, first)[0]
    if not keep.all():
        h = h[keep.reshape(-1)]
    high, low = np.divmod(targets[keep], MEMBERS)
    of_class = _picked(_head(p, h), high)
    return of_class + _picked(_member(p, h, high)[1], low)


def _gradients(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean loss of all positions."""
    total: dict[str, np.ndarray] = {}
    dx = np.empty((*inputs.shape, WIDTH), p["embed"].dtype)
    for low in range(0, len(inputs), PART):
        part = slice(low, low + PART)
        for name, grad in _gradients_of_part(p, inputs[part], targets[part], dx[part]).items():
            if name in total:
                total[name] += grad
            else:
                total[name] = grad
    total["place"] = dx.sum(axis=0)
    total["embed"] = np.zeros_like(p["embed"])
    flat = inputs.reshape(-1)
    order = np.argsort(flat)
    code = flat[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    total["embed"][code[first]] = np.add.reduceat(dx.reshape(-1, WIDTH)[order], first, axis=0)
    for grad in total.values():
        grad /= targets.size
    return total


def _gradients_of_part(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray,
                       dx: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the summed loss of some windows; that of their inputs goes to ``dx``."""
    h, (x, q, k, v, a, inverse, y, z, up) = _body(p, inputs)
    n, d, kind, g = targets.size, WIDTH, p["embed"].dtype, {}
    ones = np.ones(n, kind)
    order = np.argsort(targets.reshape(n) // MEMBERS)          # class by class
    high, low = np.divmod(targets.reshape(n)[order], MEMBERS)
    first = np.flatnonzero(np.append(True, high[1:] != high[:-1]))
    h = h[order]
    dl = _softmax_less(_head(p, h), high, "raised")
    g["head"], g["head_bias"] = h.T @ dl, ones @ dl
    dh = dl @ p["head"].T
    gate, scores = _member(p, h, high)
    dm = _softmax_less(scores, low, "raised")
    g["member"] = gate.T @ dm
    g["member_bias"] = np.zeros_like(p["member_bias"])
    g["member_bias"][high[first]] = np.add.reduceat(dm, first)
    dg = dm @ p["member"].T
    dg *= gate > 0
    g["of_class"] = np.zeros_like(p["of_class"])
    g["of_class"][high[first]] = np.add.reduceat(dg, first)
    g["gate"] = h.T @ dg
    dh += dg @ p["gate"].T
    back = np.empty_like(order)
    back[order] = np.arange(n)
    dh = dh[back]                                              # in the order of the windows again
    dup = dh @ p["down"].T
    dup *= up > 0
    g["down"] = up.T @ dh
    g["up"], g["bias"] = z.T @ dup, ones @ dup
    dh += dup @ p["up"].T                                      # of z from here on
    g["out"] = y.reshape(n, d).T @ dh
    dy = (dh @ p["out"].T).reshape(y.shape)
    dy *= inverse
    ds = np.matmul(dy, v.transpose(0, 2, 1), out=_kept("scores", a.shape, kind))
    ds -= np.einsum("wid,wid->wi", dy, y)[..., None]
    ds *= a                                                    # q is scaled already
    dqkv = _kept("dqkv", (*inputs.shape, 3 * d), kind)
    np.matmul(ds, k, out=dqkv[..., :d])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[..., d:2 * d])
    np.matmul(a.transpose(0, 2, 1), dy, out=dqkv[..., 2 * d:])
    flat = dqkv.reshape(n, 3 * d)
    g["qkv"] = _scaled(x.reshape(n, d).T @ flat)
    np.add(dh, flat @ _scaled(p["qkv"]).T, out=dx.reshape(n, d))
    return g


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[name].reshape(-1) for name in sorted(p)])


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ends = np.cumsum([like[name].size for name in sorted(like)])[:-1]
    return {name: part.reshape(like[name].shape)
            for name, part in zip(sorted(like), np.split(flat, ends), strict=True)}


def _windows(held: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(held), "<u2").reshape(len(held), -1)


def _steps_of_task(state: tuple[dict[str, np.ndarray], ...], passes: int, done: int, steps: int):
    """Steps of Adam over the windows of a task; its values in pieces, with the number of its windows.

    The windows are taken as they come, a batch of rows at a time; only few of
    them, which are gone through more than once, are held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, m, s = (_flat(x) for x in state)
        p = _views(w, state[0])
        rng, t, n = np.random.default_rng(done), done, 0
        read = (_windows(batch.column(0).to_pylist()) for batch in batches if batch.num_rows)
        if passes > 1:
            held = list(read)
            read = [np.concatenate(held)] * passes if held else []
        for windows in read:
            n += len(windows)
            order = rng.permutation(len(windows))
            for low in range(0, len(order), BATCH):
                t += 1
                window = windows[order[low:low + BATCH]].astype(np.int64)
                rate = 4e-3 * min(1.0, t / 50) * (1 - 0.9 * min(1.0, t / steps))
                grad = _flat(_gradients(p, window[:, :-1], window[:, 1:]))
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        if n:
            values = np.array_split(np.concatenate((w, m, s)).astype("<f4"), PIECES)
            yield pa.record_batch({"piece": pa.array(range(PIECES), pa.int32()), "w": pa.array([n] * PIECES, pa.int64()),
                                   "part": pa.array([v.tobytes() for v in values], pa.binary())})
    return run


def _averaged(tasks: pa.Table) -> pa.Table:
    """One piece of the tasks' models, (piece, w, part), to their average weighted by windows."""
    weight = tasks.column("w").to_numpy()
    total = sum(w * np.frombuffer(part.as_py(), "<f4").astype(np.float64)
                for w, part in zip(weight.tolist(), tasks.column("part"), strict=True))
    return pa.table({"piece": tasks.column("piece").slice(0, 1),
                     "part": pa.array([(total / weight.sum()).astype("<f4").tobytes()], pa.binary())})


def _code_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(CLASSES * MEMBERS, np.int64)
    for batch in batches:
        n += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=len(n))
    yield pa.record_batch({"code": pa.array(np.arange(len(n))), "n": pa.array(n)})


def fit(windows: DataFrame, steps: int = STEPS, seed: int = 5) -> dict[str, np.ndarray]:
    """The model trained by Adam on windows (a written table of ``window``, WINDOW + 1 codes each).

    Every window is learned from, more than once if ``steps`` asks for more
    steps than there are.  In a round each task goes on from the same values
    over its own windows; then the values of all tasks are averaged.  Windows stay
    where they were written: a task reads files, and there are no more tasks, each
    of which sends a model, than LEAST_BYTES gives.
    """
    p = _initial(np.random.default_rng(seed))
    n = windows.count()
    if not n:
        return p
    often = np.full(CLASSES * MEMBERS, 0.05)
    for r in (windows.select("window").mapInArrow(_code_counts, "code long, n long")
              .groupBy("code").agg(F.sum("n").alias("n")).collect()):   # a row a code
        often[r["code"]] += r["n"]
    often = often.reshape(CLASSES, MEMBERS)
    p["head_bias"] = np.log(often.sum(axis=1) / often.sum()).astype(np.float32)
    p["member_bias"] = np.log(often / often.sum(axis=1, keepdims=True)).astype(np.float32)
    state = (p, *({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2)))
    visits = max(1, math.ceil(steps * BATCH / n))             # of each window
    slots = min(ROUNDS, visits)                                # twelfths of the windows that a round takes
    passes = math.ceil(visits / ROUNDS)
    taken = math.ceil(n * slots / ROUNDS)
    tasks = math.ceil(taken * 2 * (WINDOW + 1) / LEAST_BYTES)
    each = math.ceil(taken / tasks / BATCH) * passes
    slot = F.pmod(F.xxhash64("window", F.lit(1)), F.lit(ROUNDS))
    for turn in range(ROUNDS):
        now = [(turn * slots + i) % ROUNDS for i in range(slots)]
        values = (windows.filter(slot.isin(now)).select("window").coalesce(tasks)
                  .mapInArrow(_steps_of_task(state, passes, turn * each, ROUNDS * each),
                              "piece int, w long, part binary")
                  .groupBy("piece").applyInArrow(_averaged, "piece int, part binary").orderBy("piece").collect())
        if values:                                             # the values of one model
            whole = np.split(np.frombuffer(b"".join(r["part"] for r in values), "<f4"), 3)
            state = tuple(_views(x.astype(np.float32), p) for x in whole)
    return state[0]


def sequence_scores(p: dict[str, np.ndarray], codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural log probability of every code of the texts that begin at ``offsets``."""
    n = np.diff(offsets)
    step = WINDOW - OVERLAP
    out = np.zeros(len(codes), np.float32)
    before = np.concatenate(([END], codes[:-1]))
    before[offsets[:-1][n > 0]] = END
    # the beginnings of the texts, then what each window has after the codes it shares
    per = np.maximum(0, -(-(n - OVERLAP) // step))
    text = np.repeat(np.arange(len(n)), per)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * step
    head = np.flatnonzero(n > 0)
    for text, start, first, size in ((head, np.zeros_like(head), 0, OVERLAP), (text, start, OVERLAP, WINDOW)):
        for low in range(0, len(text), RUN):
            t, s = text[low:low + RUN], start[low:low + RUN]
            place = s[:, None] + np.arange(size)
            inside = place < n[t][:, None]
            at = np.where(inside, offsets[t][:, None] + place, 0)
            keep, own = inside[:, first:], at[:, first:]
            out[own[keep]] = log_probabilities(p, before[at], codes[own], keep, first)
    return out


# --- words and codes ---------------------------------------------------------

def _lowered(column: pa.Array) -> Iterator[W.Words]:
    """Words of texts with A-Z in lower case, a bounded number of bytes at a time."""
    data, offsets = W._plain(column)
    data, low = _LOWER[data], 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + W.CHUNK_BYTES, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield W.words_of(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], low)
        low = high


def spelled(path: str, w: W.Words, hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Codes (little-endian 16 bits) of the words with these hashes, which first stand at ``first``."""
    known = _codes.setdefault(path, {})
    if len(known) > CACHED_WORDS:
        known.clear()
    new = [(h, i) for h, i in zip(hashes.tolist(), first.tolist(), strict=True) if h not in known]
    for (h, _), ids in zip(new, merges(path, TOKENS).replay([w.data[w.start[i]:w.end[i]] for _, i in new]),
                           strict=True):
        ids = 2 * ids
        ids[-1] += 1
        known[h] = ids.astype("<u2").tobytes()
    return list(map(known.__getitem__, hashes.tolist()))


def coded(path: str, w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a chunk with END after each text, first code of each token, first token of each text, hashes."""
    hashes, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    spelling = spelled(path, w, hashes, first)
    flat = np.frombuffer(b"".join(spelling), "<u2").astype(np.int64)
    sizes = np.array([len(x) // 2 for x in spelling], np.int64)
    begin = np.cumsum(sizes) - sizes
    texts = len(w.offsets) - 1
    # one more token, the end, after the words of each text
    tokens = np.diff(w.offsets) + 1
    first_token = np.concatenate(([0], np.cumsum(tokens)))
    is_end = np.zeros(first_token[-1], bool)
    is_end[first_token[1:] - 1] = True
    length = np.ones(first_token[-1], np.int64)
    length[~is_end] = sizes[which]
    first_code = np.concatenate(([0], np.cumsum(length)))
    codes = np.full(first_code[-1], END, np.int64)
    word_codes = length[~is_end]
    inside = np.arange(int(word_codes.sum())) - np.repeat(np.cumsum(word_codes) - word_codes, word_codes)
    codes[np.repeat(first_code[:-1][~is_end], word_codes) + inside] = flat[
        np.repeat(begin[which], word_codes) + inside]
    return codes, first_code, first_token[:texts + 1], is_end


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, row, train, text) to (file, block, word, n): distinct words of blocks, times in training rows."""
    for batch in batches:
        file, row = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        train = np.asarray(batch.column(2).to_pylist(), dtype=np.int64)
        block = row // BLOCK_ROWS
        cuts = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (file[1:] != file[:-1])))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)], strict=True):
            hashes, times = [], []
            for w in _lowered(batch.column(3).slice(low, high - low)):
                found, which = np.unique(w.hash, return_inverse=True)
                weight = np.repeat(train[low + w.first:low + w.first + len(w.offsets) - 1], np.diff(w.offsets))
                hashes.append(found)
                times.append(np.bincount(which, weights=weight, minlength=len(found)).astype(np.int64))
            if not hashes:
                continue
            found, which = np.unique(np.concatenate(hashes), return_inverse=True)
            n = np.bincount(which, weights=np.concatenate(times), minlength=len(found)).astype(np.int64)
            yield pa.record_batch({
                "file": pa.array(np.full(len(found), file[low])), "block": pa.array(np.full(len(found), block[low])),
                "word": pa.array(found.view(np.int64)), "n": pa.array(n)})


_OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")


def _block_scores(path: str, p: dict[str, np.ndarray], n_all: int, n_distinct: int, n_ends: int):
    total = n_all + n_distinct + 1

    def run(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.drop_duplicates("word").sort_values("word", ignore_index=True)
        held = known["word"].to_numpy(np.int64)
        times = known["c"].to_numpy(np.int64)
        out = []
        for w in _lowered(pa.array(rows["text"], pa.string())):
            codes, first_code, first_token, is_end = coded(path, w)
            at = np.searchsorted(held, w.hash.view(np.int64))
            hit = at < len(held)
            hit[hit] = held[at[hit]] == w.hash.view(np.int64)[hit]
            c = np.full(len(is_end), n_ends, np.int64)
            mine = np.zeros(len(at), np.int64)
            mine[hit] = times[at[hit]]
            c[~is_end] = mine
            logs = sequence_scores(p, codes, first_code[first_token])
            attention = np.add.reduceat(logs.astype(np.float64), first_code[:-1])
            share = (c + 1.0) / total
            with np.errstate(divide="ignore"):
                mixed = np.logaddexp(attention + math.log(MIX), np.log(np.where(c > 0, share, 0.0) * (1 - MIX)))
            starts = first_token[:-1]
            part = rows.iloc[w.first:w.first + len(starts)]
            out.append(pd.DataFrame({
                "doc_id": part["doc_id"].to_numpy(), "held_out": part["held_out"].to_numpy(),
                "n_tokens": np.diff(first_token), "n_known": np.add.reduceat((c > 0).astype(np.int64), starts),
                "train_tokens": n_all, "base_score": np.add.reduceat(np.log10(share), starts),
                "score": np.add.reduceat(mixed, starts) / math.log(10)}))
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _OUT.split(", ")])
    return run


def _training_windows(path: str, share: float = 1.0):
    """(file, row, text) to windows of codes of whole texts, passage by passage.

    A passage has the words that begin in one PASSAGE of bytes of a text.  A
    ``share`` under 1 draws passages by hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W._plain(batch.column(2))
            size = np.diff(offsets)
            per = np.maximum(1, -(-size // PASSAGE))
            every = np.repeat(np.arange(len(size)), per)
            place = np.arange(len(every)) - np.repeat(np.cumsum(per) - per, per)
            file, row = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.uint64)[every] for i in (0, 1))
            drawn = W.mix(W.mix(W.mix(file) + row) + place.astype(np.uint64))
            at = np.flatnonzero((drawn >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < share)
            space = np.flatnonzero(W._SPACE[data])
            space = np.append(space, len(data))
            before = np.empty(0, np.int64)                     # what the first code of a run follows
            for first in range(0, len(at), RUN_PASSAGES):
                some = at[first:first + RUN_PASSAGES]
                doc, nth, last = every[some], place[some], place[some] == per[every[some]] - 1

                def begin(n: np.ndarray, doc: np.ndarray = doc) -> np.ndarray:
                    """First byte from which words begin in the nth passage."""
                    low = offsets[doc] + n * PASSAGE
                    # a word that begins before goes with the passage before
                    after = space[np.searchsorted(space, np.minimum(low - 1, len(data)))]
                    return np.where(n == 0, low, np.minimum(after, offsets[doc + 1]))

                low, high = begin(nth), np.where(last, offsets[doc + 1], begin(nth + 1))
                texts = [data[a:b].tobytes().decode() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                stream = [before]
                for w in _lowered(pa.array(texts, pa.string())):
                    codes, first_code, first_token, _ = coded(path, w)
                    edges = first_code[first_token].tolist()
                    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True), w.first):
                        if nth[i] == 0:
                            stream.append(np.array([END]))
                        stream.append(codes[a:b] if last[i] else codes[a:b - 1])   # END after whole texts alone
                codes = np.concatenate(stream)
                before = codes[-1:]
                codes = np.concatenate((np.full(max(0, WINDOW + 1 - len(codes)), END), codes))
                start = np.arange(0, len(codes) - 1, WINDOW)
                start = np.minimum(start, len(codes) - WINDOW - 1)
                found = codes[start[:, None] + np.arange(WINDOW + 1)].astype("<u2")
                yield pa.record_batch({"window": pa.array([x.tobytes() for x in found], pa.binary())})
    return run


def score(docs: DataFrame, path: str, steps: int = STEPS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all rows whose crc32(doc_id) mod 7 is not 2 (a null doc_id counts
    as an empty one), counts and attention model alike.  Null and empty texts have one token, the end.  Words are
    told apart by a 64-bit hash.  Without training rows every count is 0 and
    the attention model is untrained.
    """
    rows = C.located(docs.select("doc_id", "text"), "lm-docs").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (C.crc_remainder("doc_id", 7) == 2).alias("held_out"),
        F.col(C.FILE).alias("file"), C.ROW)
    train = rows.filter(~F.col("held_out"))
    coded_rows = train.filter(F.octet_length("text") > 0).select("file", C.ROW, "text").mapInArrow(
        _training_windows(path), "window binary")
    model = fit(C.written(coded_rows, "lm-windows"), steps)
    found = rows.select("file", C.ROW, (~F.col("held_out")).alias("train"), "text").mapInArrow(
        _block_words, "file long, block long, word long, n long")
    by_word = Window.partitionBy("word")
    counted = C.written(found.select(
        "file", "block", "word", "n", F.sum("n").over(by_word).alias("c"),
        F.row_number().over(by_word.orderBy("file", "block")).alias("nth")).filter("c > 0"), "word-counts")
    sums = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
                       F.count_if(F.col("nth") == 1).alias("distinct")).first()
    n_ends = train.count()
    scored = _block_scores(path, model, sums["tokens"] + n_ends, sums["distinct"] + (n_ends > 0), n_ends)
    blocked = rows.select("doc_id", "text", "held_out", "file",
                          F.floor(F.col(C.ROW) / BLOCK_ROWS).cast("long").alias("block"))
    return (blocked.groupBy("file", "block")
            .cogroup(counted.select("file", "block", "word", "c").groupBy("file", "block"))
            .applyInPandas(scored, _OUT))
