"""Quality classifier: interpolated modified Kneser-Ney n-grams of trusted text.

A text is a sequence of symbols, its characters (digits are one symbol, white
space is one, rare scripts share some), so an n-gram of ``ORDER`` symbols is a whole number of 60 bits.
Counts of trusted documents, continuation counts, discounts and back-off
weights are tables keyed by n-gram, sharded by it, and grow with the corpus.

Documents get at them by joins.  They are dealt into blocks of files; a block
asks once for each distinct n-gram that occurs in it, the distinct n-grams of all
blocks are joined, order by order, to counts and weights, and each block gets
the probabilities that it asked for.  A task reads a block's probabilities,
then streams its documents past them and sums each document.

A document is rejected if its perplexity is above the quantile that the trusted
documents of its language have.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.llm import common as C

#: Symbols of an n-gram, bits of a symbol.
ORDER, BITS = 5, 12

#: Share of trusted documents of a language that a threshold keeps.
QUANTILE = 0.995

#: Steps of log10 perplexity per unit in the threshold's histogram.
STEPS = 5000

#: Rows of a file that make a block; n-grams that a task holds before it sorts them.
BLOCK_ROWS, HELD = 32_768, 1 << 21

#: Characters up to here are symbols of their own; those beyond share the rest by hash.
OWN = 0x600

_PLACE = [C.FILE, C.ROW]
_OWN = np.maximum(np.arange(OWN + 1), 1).astype(np.int16)
_OWN[48:58], _OWN[9:14] = 48, 32


def _symbols(text: str | None) -> np.ndarray:
    """Symbols of a text; 0 is kept for its edges."""
    s = np.frombuffer((text or "").encode("utf-32-le", "replace"), "<u4")
    own = _OWN[np.minimum(s, OWN)].astype(np.int64)
    far = np.flatnonzero(s >= OWN)
    if len(far):
        own[far] = OWN + (s[far].astype(np.int64) * 2654435761 >> 8) % ((1 << BITS) - OWN)
    return own


def codes_of(text: str | None, order: int = ORDER) -> np.ndarray:
    """The n-grams of a text as numbers, one for each symbol and one for the end."""
    s = np.concatenate((np.zeros(order - 1, np.int64), _symbols(text), np.zeros(1, np.int64)))
    n = len(s) - order + 1
    code = np.zeros(n, np.int64)
    for i in range(order):
        code = (code << BITS) | s[i:i + n]
    return code


class Places:
    """Places of distinct codes in an array, found by hash (open addressing, all codes of a query at once)."""

    def __init__(self, codes: np.ndarray):
        bits = max(4, int(2 * len(codes)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.code = np.full(1 << bits, -1, np.int64)
        self.place = np.full(1 << bits, -1, np.int64)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.code[slot] < 0
            self.code[slot[free]] = codes[left[free]]         # of several that want a slot one gets it
            won = self.code[slot] == codes[left]
            self.place[slot[won]] = left[won]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code, -1 if it is not there."""
        slot = self._slot(codes)
        found = self.code[slot]
        out = self.place[slot]
        left = np.flatnonzero((found != codes) & (found >= 0))
        out[found != codes] = -1
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            found = self.code[slot]
            hit = found == codes[left]
            out[left[hit]] = self.place[slot[hit]]
            going = ~hit & (found >= 0)
            left, slot = left[going], slot[going]
        return out


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"code": pa.array(found, pa.int64()), "n": pa.array(times, pa.int64())})

        for batch in batches:
            for text in batch.column(0):
                held.append(codes_of(text.as_py(), order))
                size += len(held[-1])
                if size >= HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()
    return run


class _Distinct:
    """Distinct codes of what is added; codes that are there already cost one look."""

    def __init__(self):
        self.codes, self.more, self.size = np.empty(0, np.int64), [], 0
        self.places = Places(self.codes)

    def add(self, codes: np.ndarray) -> None:
        new = codes[self.places.of(codes) < 0]
        self.more.append(new)
        self.size += len(new)
        if self.size >= max(HELD, len(self.codes)):
            self.all()

    def all(self) -> np.ndarray:
        if self.more:
            self.codes, self.more, self.size = np.unique(np.concatenate([self.codes, *self.more])), [], 0
            self.places = Places(self.codes)
        return self.codes


def _asked(order: int):
    """(block, text) to the distinct n-grams of each block that a task meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, _Distinct()
        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block != now:      # rows come file by file; a block that comes again asks again
                    if now is not None:
                        yield _requests(now, held.all())
                    now, held = block, _Distinct()
                held.add(codes_of(text.as_py(), order))
        if now is not None:
            yield _requests(now, held.all())
    return run


def _requests(block: int, codes: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"block": pa.array(np.full(len(codes), block), pa.int64()), "code": pa.array(codes, pa.int64())})


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts 0, 1, 2 and 3 or more; half where counts of counts do not give them."""
    row = counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    out = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = k - (k + 1) * y * b / a if a and n1 else 0.5
        out.append(min(max(d, 0.05), k - 0.05))
    return out


def probabilities(counts: DataFrame, order: int = ORDER, needed: DataFrame | None = None,
                  bits: int = BITS) -> DataFrame:
    """(code, p) of the n-grams ``needed`` (distinct; all there are if None): interpolated modified Kneser-Ney.

    ``counts`` has code and n of the highest order.  Lower orders count in how
    many ways an n-gram continues to the left.  What is needed of a lower order
    are the endings of what is needed of the next.
    """
    spark = counts.sparkSession
    by_order, wanted = {order: counts}, {order: needed if needed is not None
                                         else spark.range(1 << (bits * order)).withColumnRenamed("id", "code")}
    for k in range(order - 1, 0, -1):
        suffix = F.col("code").bitwiseAND((1 << (bits * k)) - 1).alias("code")
        by_order[k] = C.written(by_order[k + 1].groupBy(suffix).agg(F.count("*").alias("n")), f"continuations-{k}")
        wanted[k] = wanted[k + 1].select(suffix).distinct()
        if k > 1:
            wanted[k] = C.written(wanted[k], f"wanted-{k}")
    lower = spark.range(1).select(F.lit(0).cast("long").alias("code"), F.lit(1.0 / (1 << bits)).alias("p"))
    for k in range(1, order + 1):
        d = _discounts(by_order[k])
        discount = F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3])
        context = by_order[k].groupBy(F.shiftright("code", bits).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(discount).alias("saved"))
        parts = wanted[k].select("code", F.shiftright("code", bits).alias("context"),
                                 F.col("code").bitwiseAND((1 << (bits * (k - 1))) - 1).alias("suffix"))
        own = F.coalesce(F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total"), F.lit(0.0))
        back = F.coalesce(F.col("saved") / F.col("total"), F.lit(1.0))
        lower = C.written(
            parts.join(by_order[k], "code", "left").join(context, "context", "left")
            .join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
            .select("code", (own + back * F.col("below")).alias("p")), f"kneser-ney-{k}")
    return lower


def train(trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, n): the n-grams of the texts of ``trusted``."""
    partial = trusted.select("text").mapInArrow(_count(order), "code long, n long")
    return C.written(partial.groupBy("code").agg(F.sum("n").alias("n")), "ngrams")


def _score(order: int):
    """Rows (block, kind, code, logp, text, ...) by block, a block's probabilities (kind 0) first, to scored texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, logs, places, values = None, [], [], Places(np.empty(0, np.int64)), np.empty(0)
        for batch in batches:
            blocks, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            n, total = [], []
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)], strict=True):
                if low == high:
                    continue
                if blocks[low] != now:
                    now, codes, logs = blocks[low], [], []
                if kinds[low] == 0:
                    codes.append(batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False).astype(np.int64))
                    logs.append(batch.column(3).slice(low, high - low).to_numpy(zero_copy_only=False))
                    continue
                if codes:
                    places, values, codes = Places(np.concatenate(codes)), np.concatenate(logs), []
                for text in batch.column(4).slice(low, high - low):
                    own = codes_of(text.as_py(), order)
                    n.append(len(own))
                    total.append(float(values[places.of(own)].sum(dtype=np.float64)))
            texts = pa.array(np.flatnonzero(kinds == 1))
            out = {name: batch.column(i).take(texts) for i, name in enumerate(batch.schema.names) if i > 4}
            yield pa.record_batch(out | {"n_symbols": pa.array(n, pa.int64()), "logp": pa.array(total, pa.float64())})
    return run


def scored(rows: DataFrame, counts: DataFrame, order: int = ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, lang, place, n_symbols, logp) of ``rows``: symbols with the end, log10 probability of the text.

    ``rows`` has doc_id, text, lang and the place columns of ``common.located``.
    """
    block = F.xxhash64(C.FILE, F.floor(F.col(C.ROW) / block_rows)).alias("block")
    # asked twice: the requests of all blocks would take more disk than it takes time to find them again
    asked = rows.select(block, "text").mapInArrow(_asked(order), "block long, code long")
    needed = C.written(asked.select("code").distinct(), "needed")
    # a block that several tasks asked for gets an answer once; equal requests are where the join put them
    answers = (asked.join(probabilities(counts, order, needed), "code").groupBy("code", "block")
               .agg(F.log10(F.first("p")).alias("logp")).select("block", F.lit(0).alias("kind"), "code", "logp"))
    kept = {"doc_id": "long", "lang": "string", C.FILE: "long", C.ROW: "long"}
    texts = rows.select(block, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("code"),
                        F.lit(None).cast("double").alias("logp"), "text", *[F.col(c).cast(t).alias(c) for c, t in kept.items()])
    answers = answers.select("*", F.lit(None).cast("string").alias("text"),
                             *[F.lit(None).cast(t).alias(c) for c, t in kept.items()])
    dealt = answers.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")
    schema = ", ".join(f"{c} {t}" for c, t in kept.items()) + ", n_symbols long, logp double"
    return dealt.mapInArrow(_score(order), schema)


def _language(column: str = "lang") -> Column:
    return F.coalesce(F.col(column), F.lit("und"))


def thresholds(trusted: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, float]:
    """(language, most) of log10 perplexity, and the one over all languages (infinite without rows)."""
    cells = C.written(
        trusted.groupBy(_language().alias("language"),
                        F.floor(-F.col("logp") / F.col("n_symbols") * STEPS).alias("cell"))
        .agg(F.count("*").alias("n")), "perplexities")

    def edge(df: DataFrame, by: list[str]) -> DataFrame:
        upto = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        all_ = Window.partitionBy(*by)
        return (df.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(all_))
                .filter(F.col("upto") >= F.col("all") * quantile)
                .groupBy(*by).agg(((F.min("cell") + 1) / STEPS).alias("most")))

    every = cells.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))
    overall = edge(every, ["one"]).first()
    return edge(cells, ["language"]), overall["most"] if overall else math.inf


def judged(rows: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, place, n_symbols, logp, most (log10), keep) of located ``rows``.

    Trusted are the documents that ``labels`` (doc_id, quality, toxic) gives
    quality 1 and not toxic.  A language without trusted documents, and a null
    one, has the threshold of all.  Null and empty texts count their end alone
    and are judged by it.  Without trusted documents everything is kept.  An empty
    table gives an empty result; repeated rows are judged each for itself.
    """
    good = (labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
            .select(F.col("doc_id").cast("long").alias("__good")).distinct())
    few = C.sized_broadcast(good)

    def trusted(table: DataFrame) -> DataFrame:
        return table.join(few, F.col("doc_id") == F.col("__good"), "left_semi")

    # short batches: workers that later stages find still hold what a batch took
    with C.settings(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
                                        "spark.sql.parquet.compression.codec": "zstd"}):   # tables of n-grams are most of the disk
        own = C.written(scored(rows, train(trusted(rows.select("doc_id", "text")), order), order), "scores")
    by_language, overall = thresholds(trusted(own), quantile)
    limits = C.sized_broadcast(C.written(by_language.select(F.col("language").alias("__language"),
                                                            F.col("most").alias("__own")), "thresholds"))
    return (own.join(limits, _language() == F.col("__language"), "left")
            .withColumn("most", F.when(F.col("lang").isNotNull(), F.coalesce("__own", F.lit(overall)))
                        .otherwise(F.lit(overall)))
            .withColumn("keep", -F.col("logp") / F.col("n_symbols") <= F.col("most"))
            .drop("__language", "__own"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, n_symbols, log10_prob, perplexity, threshold, kept (see ``judged``)."""
    located = C.located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), "quality-docs")
    rows = judged(located, labels)
    return rows.select(
        "doc_id", "lang", "n_symbols", F.col("logp").alias("log10_prob"),
        F.pow(F.lit(10.0), -F.col("logp") / F.col("n_symbols")).alias("perplexity"),
        F.pow(F.lit(10.0), F.col("most")).alias("threshold"), F.col("keep").alias("kept"))


def kept_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, whatever those are called.

    Nulls, empty texts and missing labels as in ``judged``; an empty table stays empty.
    """
    plain, named = C.plain_names(docs, ["doc_id", "text", "lang"])
    rows = C.located(plain, "quality-docs")
    kept = judged(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", *_PLACE), labels)
    return named(rows.join(C.sized_broadcast(kept.filter("keep").select(*_PLACE)), _PLACE, "left_semi"))
