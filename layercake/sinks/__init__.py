"""Sinks: dated layers, reports, per-key exports, versioned datasets, catalog tables, JDBC."""

from .files import (export_by_key, publish_run, stage_run, write_csv, write_layer,
                    write_quarantine, write_report)
from .jdbc import write_jdbc
from .snapshots import (CommitConflict, drop_versions, export_generation, merge_snapshot, read_snapshot,
                        snapshot, versions, write_snapshot)
from .tables import (add_column, append_by_name, ensure_database, ensure_table, evolve_in_steps,
                     evolve_partitioning, merge_insert_only, overwrite_table, partition_columns,
                     qualified, rows_to_insert, table_info)

__all__ = [
    "CommitConflict", "add_column", "append_by_name", "drop_versions", "ensure_database",
    "ensure_table", "evolve_in_steps", "evolve_partitioning", "export_by_key", "export_generation",
    "merge_insert_only", "merge_snapshot", "overwrite_table", "partition_columns", "publish_run",
    "qualified", "read_snapshot", "rows_to_insert", "snapshot", "stage_run", "table_info",
    "versions", "write_csv", "write_jdbc", "write_layer", "write_quarantine", "write_report",
    "write_snapshot",
]
