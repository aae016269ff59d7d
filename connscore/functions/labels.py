"""Label expressions: binary label, label cleanup, vocabulary index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_label(label: str | Column, normal_token: str = "normal") -> Column:
    """0.0 when the label contains the normal token anywhere, else 1.0.

    Substring match on purpose: ``abnormal`` counts as normal, as in the
    source format's rule.  A NULL label stays NULL.
    """
    c = _col(label)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c.contains(normal_token), F.lit(0.0))
            .otherwise(F.lit(1.0)))


def clean_label(label: str | Column, strip_chars: str = ".") -> Column:
    """Remove every occurrence of each character in ``strip_chars``."""
    return F.translate(_col(label), strip_chars, "")


def vocabulary_index(value: str | Column, vocabulary: Sequence[str]) -> Column:
    """0-based position of ``value`` in a fixed vocabulary, as double.

    Values outside the vocabulary get ``len(vocabulary)`` (the "unknown"
    code); NULL stays NULL.  The vocabulary is a driver-side list, so its
    size is known when the plan is built; the lookup is a constant-folded
    array literal evaluated inside whole-stage codegen, with no join.
    """
    c = _col(value)
    vocab = F.array(*[F.lit(v) for v in vocabulary])
    pos = F.array_position(vocab, c)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(pos == 0, F.lit(float(len(vocabulary))))
            .otherwise((pos - 1).cast("double")))
