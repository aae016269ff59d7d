"""Streaming scoring: apply a saved pipeline to record files as they arrive.

This is the test phase of the batch jobs run continuously:

* ``record_stream``    -- text files landing in a folder -> parsed records
  (the same expression parser as the batch ingest, so the ``malformed``
  flag is identical);
* ``scored_stream``    -- well-formed records -> saved ``PipelineModel``
  transform (row-wise, so it runs unchanged on a stream);
* ``running_metrics``  -- confusion counts, precision, recall, F1 and
  error over everything seen so far: one global streaming aggregate whose
  state is a single row of counters;
* ``start_scored_sink`` / ``start_quarantine`` / ``start_metrics`` -- sinks
  (scored rows, rejected lines, running metrics).  The caller names the
  checkpoint folder (in shared storage, one per query) and passes the same
  one after a restart: file offsets and aggregate state are recovered from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from connscore.operators import metrics as M
from connscore.schema import Layout
from connscore.sources.records import parse_lines, quarantined, well_formed


def record_stream(spark: SparkSession, path: str, layout: Layout,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(reader.load(path), layout, keep_line=True)


def scored_stream(records: DataFrame, model_path: str,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Well-formed records scored by the saved pipeline."""
    rows = well_formed(records)
    if prepare is not None:
        rows = prepare(rows)
    return PipelineModel.load(model_path).transform(rows)


def running_metrics(scored: DataFrame, mode: str = "binary",
                    label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return M.prf1(M.confusion_counts(scored, label_col, prediction_col, mode))


def start_quarantine(records: DataFrame, out_path: str, checkpoint: str,
                     trigger_once: bool = False) -> StreamingQuery:
    w = (quarantined(records).select("value", "n_fields", "reason")
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(out_path)


def start_scored_sink(scored: DataFrame, out_path: str, columns: list[str], checkpoint: str,
                      trigger_once: bool = False) -> StreamingQuery:
    """Append the scored rows (chosen columns) to parquet, exactly once per checkpoint."""
    w = (scored.select(*columns).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(out_path)


def start_metrics(metrics: DataFrame, query_name: str, checkpoint: str,
                  sink: str = "memory", trigger_once: bool = False) -> StreamingQuery:
    """Running metrics to a sink in complete mode (the state is one row)."""
    w = (metrics.writeStream.format(sink).outputMode("complete").queryName(query_name)
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
