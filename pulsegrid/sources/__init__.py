"""Readers (parquet tables, signal CSV, logs) and sinks (logs, reports, models)."""

from pulsegrid.sources.tables import read_table, table_path, table_version
from pulsegrid.sources.csv import (
    read_log_csv,
    read_signal_csv,
    read_signal_csv_inferred,
    signal_schema,
)

__all__ = [
    "read_table", "table_path", "table_version", "read_log_csv", "read_signal_csv",
    "read_signal_csv_inferred", "signal_schema",
]
