"""Model sink and source: one directory per fitted pipeline.

``save_model`` replaces an existing directory through the ML writer's
overwrite, which works on any Hadoop filesystem (HDFS, object stores), not
only on a local disk.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
