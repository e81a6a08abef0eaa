"""Table maintenance flows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..names import quote
from ..sinks.files import export_by_key
from ..sinks.snapshots import export_generation
from ..sinks.tables import add_column, evolve_in_steps, evolve_partitioning


def export_departments(spark: SparkSession, table: str, path: str, *,
                       key: str = "department", **kwargs) -> int:
    """One CSV dataset per department, in one job (not one job per key);
    ``keep_key=True`` keeps the department in the files too."""
    return export_by_key(spark.table(table), key, path, **kwargs)


def export_department_generation(spark: SparkSession, table: str, root: str, *,
                                 key: str = "department", **kwargs) -> int:
    """W10 as a whole: every department's dataset in a new generation that replaces the old one
    at its commit; read with ``sinks.read_snapshot``."""
    return export_generation(spark.table(table), key, root, **kwargs)


def evolve_visit_month(spark: SparkSession, table: str, *, field: str = "visit_month",
                       timestamp: str = "Visit Timestamp") -> tuple[bool, bool]:
    """Add ``visit_month`` (idempotent), then partition by it, derived as
    the month name of the visit timestamp."""
    added = add_column(spark, table, field, "string")
    evolved = evolve_partitioning(spark, table, field,
                                  f"date_format({quote(timestamp)}, 'MMMM')")
    return added, evolved


def evolve_visit_month_in_steps(spark: SparkSession, table: str, *, field: str = "visit_month",
                                timestamp: str = "Visit Timestamp", **kwargs) -> bool:
    """W11 for a large table: the same result, resumable after a lost driver."""
    if spark.catalog.tableExists(table):
        add_column(spark, table, field, "string")
    return evolve_in_steps(spark, table, field, f"date_format({quote(timestamp)}, 'MMMM')", **kwargs)
