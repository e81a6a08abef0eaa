"""Composed flows W1-W11 (plain functions over the operators and sinks)."""

from .enrichment import (enrich_employees, enrich_user_service, load_employee_csv,
                         load_employee_table, load_user_service_csv, load_user_service_table)
from .geo import build_geo_dimension, country_keys, publish_geo_dimension
from .landing import clients_view, export_clients, land_mapped_csv, map_columns
from .medallion import (bronze_from_jdbc, bronze_from_tables, gold_report, latest_report,
                        silver_drop, silver_hash)
from .tables import (evolve_visit_month, evolve_visit_month_in_steps, export_department_generation,
                     export_departments)

__all__ = [
    "bronze_from_jdbc", "bronze_from_tables", "build_geo_dimension", "country_keys", "clients_view",
    "enrich_employees",
    "enrich_user_service", "evolve_visit_month", "evolve_visit_month_in_steps",
    "export_department_generation", "export_clients", "export_departments",
    "gold_report", "land_mapped_csv", "latest_report", "load_employee_csv",
    "load_employee_table", "load_user_service_csv", "load_user_service_table", "map_columns", "publish_geo_dimension", "silver_drop", "silver_hash",
]
