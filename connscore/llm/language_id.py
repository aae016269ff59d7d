"""Language identification by compression with raw-content dictionaries.

Each language has a dictionary of plain training text, in lower case.  A text is cut into
blocks, each block is compressed with each language's dictionary, and the
language with the smallest total wins.  Labels may be wrong, and a wrong text in
a dictionary draws texts of its true language, so each half of the sample is
first judged by dictionaries of the other half and texts that go elsewhere are
left out.  The score is the share by which the
second smallest total is larger; a narrow margin marks the row as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C

#: A dictionary is made of passages of so many training texts, of so many characters each.
SAMPLE_TEXTS, SAMPLE_CHARS = 256, 500

#: Bytes compressed at once, zstandard level, and the score under which a row is rejected.
BLOCK_BYTES, LEVEL, LEAST_SCORE = 8192, 5, 0.01

UNKNOWN = "und"


def train(rows: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary of each language from ``rows`` (doc_id, text, lang).

    The sample is bounded: rows are dealt by the hash of their text into
    ``texts`` classes and each (language, class) gives its smallest hash.  Of
    such a text a passage of ``chars`` characters is taken whose place follows from the
    hash too, anywhere in the whole text.
    """
    usable = rows.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", "text", F.xxhash64("text").alias("h"))
    places = F.greatest(F.length("text") - chars + 1, F.lit(1))
    start = F.pmod(F.xxhash64("h"), places.cast("long")).cast("int") + 1
    picked = (usable.groupBy("lang", F.pmod("h", F.lit(texts)).alias("class"))
              .agg(F.min(F.struct("h", F.substring(F.col("text"), start, F.lit(chars)).alias("sample"))).alias("least")))
    samples: dict[str, list[tuple[int, str]]] = {}
    for r in picked.select("lang", "least").collect():   # at most `texts` rows a language
        samples.setdefault(r["lang"], []).append((r["least"]["h"], r["least"]["sample"].lower()))
    sorted_ = {lang: [s for _, s in sorted(x)] for lang, x in sorted(samples.items())}
    kept: dict[str, list[str]] = {lang: [] for lang in sorted_}
    for half in (0, 1):
        judges = _coders({lang: _content(x[half::2]) for lang, x in sorted_.items()})
        for lang, x in sorted_.items():
            kept[lang] += [t for t in x[1 - half::2] if _sizes(judges, t.encode())[0][1] == lang]
    return {lang: _content(kept[lang] or x) for lang, x in sorted_.items()}


def _content(texts: list[str]) -> bytes:
    return "\n".join(texts).encode()


def _coders(model: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model.items():
        # eight bytes at least, as the library asks for
        held = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_checksum=False,
                                                   write_content_size=False, write_dict_id=False)))
    return out


def _sizes(coders: list[tuple[str, zstandard.ZstdCompressor]], raw: bytes) -> list[tuple[int, str]]:
    """Compressed size by language, smallest first."""
    blocks = [raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    return sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in coders)


def _predict(model: dict[str, bytes], least_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = regex.compile(r"\p{L}")
        coders = _coders(model)
        for batch in batches:
            preds, scores, rejected = [], [], []
            for text in batch.column(2):
                value = text.as_py()
                if value is None or not coders or not letter.search(value):
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                sizes = _sizes(coders, value.lower().encode())
                preds.append(sizes[0][1])
                scores.append(1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0)
                rejected.append(scores[-1] < least_score)
            yield pa.record_batch({"doc_id": batch.column(0), "held_out": batch.column(1),
                                   "lang_pred": pa.array(preds, pa.string()),
                                   "score": pa.array(scores, pa.float64()),
                                   "rejected": pa.array(rejected, pa.bool_())})
    return run


def identify(docs: DataFrame, model: dict[str, bytes], least_score: float = LEAST_SCORE) -> DataFrame:
    """Per row of ``docs`` (doc_id, held_out, text): doc_id, held_out, lang_pred, score, rejected.

    Null texts and texts without a letter get ``und`` and score 0, as does
    every text under an empty model.  Ties go to the smaller language name.
    """
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model, least_score),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 4 is not 2, predicts all (a null doc_id is held in).

    An empty table gives an empty result, a table without labelled training rows ``und`` throughout.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       (C.crc_remainder("doc_id", 4) == 2).alias("held_out"))
    return identify(rows, train(rows.filter(~F.col("held_out"))))
