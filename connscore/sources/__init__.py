"""Scans and sinks: connection records, parquet tables, models, dictionaries."""

from connscore.sources.records import (
    MALFORMED, parse_lines, quarantined, read_lines, read_records, to_lines,
    well_formed, write_with_quarantine,
)
from connscore.sources.tables import table
from connscore.sources.model_store import load_pipeline, save_model
from connscore.sources.cluster_dict import read_cluster_dict, write_cluster_dict

__all__ = [
    "MALFORMED", "parse_lines", "quarantined", "read_lines", "read_records",
    "to_lines", "well_formed", "write_with_quarantine", "table", "load_pipeline",
    "save_model", "read_cluster_dict", "write_cluster_dict",
]
