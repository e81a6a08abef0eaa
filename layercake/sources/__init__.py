"""Sources: CSV, newest file, dated layers, JDBC, catalog tables."""

from .csv import quarantine_counts, read_csv, read_csv_checked
from .files import list_files, newest_file, read_newest, read_report
from .jdbc import jdbc_read_options, read_jdbc
from .layers import (MANIFEST, commit_run, committed, committed_runs, layer_path, layer_root,
                     legacy_prefix, newest_run, newest_runs, read_days, read_layer, register_runs)
from .tables import read_table

__all__ = [
    "MANIFEST", "commit_run", "committed", "committed_runs", "jdbc_read_options", "layer_path",
    "layer_root", "legacy_prefix", "list_files", "newest_file", "newest_run", "newest_runs",
    "quarantine_counts", "read_csv", "read_csv_checked", "read_days", "read_jdbc", "read_layer", "read_newest", "read_report", "read_table",
    "register_runs",
]
