"""Parameter sweeps: one fit per parameter value over one persisted input.

Each fit is a distributed job; the driver only loops over the (short) list
of parameter values and keeps one small metrics row per value.  The input
is spread over the cluster if the caller says how and persisted (memory and
disk, so a lost executor recomputes its blocks from the scan) for the duration
of the sweep, then released.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.operators.prepare import Spread, persisted, spread_input


def k_values(min_k: int, max_k: int, step: int = 10) -> list[int]:
    """k from min_k to max_k inclusive in steps (the sweep grid)."""
    return list(range(min_k, max_k + 1, step))


def select_min(sweep_df: DataFrame, metric: str = "cost",
               param: str = "k") -> DataFrame:
    """Row with the lowest metric; ties go to the first (smallest) parameter."""
    return sweep_df.orderBy(F.col(metric).asc(), F.col(param).asc()).limit(1)


def select_best(sweep_df: DataFrame, metric: str, param: str = "k") -> DataFrame:
    """Row with the lowest ``cost``, or the highest of any other metric; ties go to the smallest parameter."""
    if metric == "cost":
        return select_min(sweep_df, metric, param)
    return sweep_df.orderBy(F.col(metric).desc_nulls_last(), F.col(param).asc()).limit(1)


def sweep_fits(spark: SparkSession, prefix, data: DataFrame, values: Iterable[Any],
               make_estimator: Callable[[Any], Any],
               evaluate: Callable[[Any, Any, DataFrame], dict], schema: str,
               extra_cols: Sequence[str] = (), spread: Spread | None = None) -> tuple[DataFrame, dict]:
    """One fit per parameter value, sharing the feature stages and one cache.

    The feature stages (``prefix``, a Pipeline) are fitted once.  The frame
    the estimators read (features, label, plus ``extra_cols`` needed by
    ``evaluate``) is cached once; every fit and evaluation reads that cache,
    and the estimators see a cached input, so they keep no copy of their own.
    ``evaluate(v, model, cached)`` returns the metrics row for value ``v``.
    Returns the metrics table and ``{value: PipelineModel}``.
    """
    from pyspark.ml import PipelineModel

    from connscore.operators.models import estimator_columns

    values = list(values)
    cols = estimator_columns(make_estimator(values[0]), extra_cols)
    models = {}
    rows = []
    with spread_input(data, spread) as src:
        prefix_model = prefix.fit(src.df)
        feats = prefix_model.transform(src.df).select(*cols)
        with persisted(feats) as cached:
            for v in values:
                m = make_estimator(v).fit(cached)
                models[v] = PipelineModel(stages=[*prefix_model.stages, m])
                rows.append(evaluate(v, m, cached))
    names = [f.strip().split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema), models
