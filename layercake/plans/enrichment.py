"""Enriched table flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.dates import month_name, year_of
from ..functions.hashing import hash_columns
from ..functions.runinfo import new_run
from ..functions.values import recode
from ..names import col
from ..operators.joins import lookup, lookup_fill
from ..operators.projection import conform
from ..schemas import (COUNTRY_GEO, EMPLOYEE, EMPLOYEE_PARTITIONS, EMPLOYEE_TABLE, NATIONALITY_RECODE,
                       REVERSE_GEOCODE, USER_SERVICE, USER_SERVICE_PARTITIONS, USER_SERVICE_PII,
                       USER_SERVICE_TABLE)
from ..sinks.files import write_quarantine
from ..sinks.tables import ensure_database, ensure_table, overwrite_table
from ..sources.csv import read_csv, read_csv_checked


def enrich_employees(
    employees: DataFrame, geo: DataFrame, *, mapping: Mapping[str, str] = NATIONALITY_RECODE,
    nationality: str = "nationality", hire_date: str | None = "hire_date",
    country: str = "Country",
) -> DataFrame:
    """W6 transform: recode nationality, add ``hire_year``, left-join the geo
    dimension on the recoded value and drop its key."""
    changes = {nationality: recode(col(nationality), mapping)}
    if hire_date:
        changes["hire_year"] = year_of(col(hire_date))
    return lookup(employees.withColumns(changes), geo, nationality, country)


def load_employee_table(spark: SparkSession, employees: DataFrame, geo: DataFrame,
                        database: str, table: str = "employee", *, fmt: str = "parquet",
                        mapping: Mapping[str, str] = NATIONALITY_RECODE) -> str:
    """Enrich, ensure database + partitioned table, overwrite all rows (by name)."""
    name = f"{database}.{table}"
    ensure_database(spark, database)
    ensure_table(spark, name, EMPLOYEE_TABLE, EMPLOYEE_PARTITIONS, fmt=fmt)
    overwrite_table(enrich_employees(employees, geo, mapping=mapping), name)
    return name


def _dated(visits: DataFrame, visit_ts: str) -> DataFrame:
    return visits.withColumns({"visit_year": year_of(col(visit_ts)),
                               "visit_month": month_name(col(visit_ts))})


def enrich_user_service(
    users: DataFrame, zips: DataFrame, *, pii: Sequence[str] = USER_SERVICE_PII,
    visit_ts: str = "Visit Timestamp", zip_key: str = "Zipcode", dim_zip_key: str = "Zipcode",
    fill: Mapping[str, str] | None = None,
    output: T.StructType | Sequence[str] = USER_SERVICE_TABLE,
    dedupe_by: Sequence[str] | None = None,
) -> DataFrame:
    """W7 transform: hash PII (NULL stays NULL, ``''`` is hashed), visit year and
    month name, zip lookup on the trimmed zip with blank City/State filled from
    the dimension, then the table's column order.  A zip listed twice in the
    dimension fans the visit out, as in the original job, unless ``dedupe_by``
    picks one dimension row per zip."""
    fill = {"City": "Geo_City", "State": "Geo_State"} if fill is None else fill
    dated = _dated(hash_columns(users, pii, blank="hash"), visit_ts)
    return conform(lookup_fill(dated, zips, zip_key, dim_zip_key, fill, dedupe_by=dedupe_by),
                   output)


def load_user_service_table(spark: SparkSession, users: DataFrame, zips: DataFrame,
                            database: str, table: str = "user_service_data", *,
                            fmt: str = "parquet") -> str:
    """Enrich, ensure database + table partitioned by visit year/month, overwrite.

    The raw visits are shuffled by year and month; hashes, zip columns and the rows of zips
    listed twice come after that.  A zip dimension too big to broadcast costs one more shuffle,
    as it did before the rebalance, and then more files per month."""
    name = f"{database}.{table}"
    ensure_database(spark, database)
    ensure_table(spark, name, USER_SERVICE_TABLE, USER_SERVICE_PARTITIONS, fmt=fmt)
    dated = _dated(users, "Visit Timestamp")
    overwrite_table(dated, name, finish=lambda visits: enrich_user_service(visits, zips))
    return name


def _read_drop(spark: SparkSession, path: str, schema: T.StructType, topic: str,
               quarantine: str | None, most: int | None, options: Mapping[str, str]) -> DataFrame:
    """A typed CSV drop; with ``quarantine`` its malformed records go to that root's quarantine
    layer of the topic first, and more than ``most`` of them stop the load."""
    if quarantine is None:
        return read_csv(spark, path, schema, **options)
    rows, bad = read_csv_checked(spark, path, schema, **options)
    write_quarantine(bad, quarantine, topic, new_run(), most=most)
    return rows


def load_employee_csv(spark: SparkSession, employees_path: str, geo_path: str, database: str,
                      table: str = "employee", *, quarantine: str | None = None,
                      most_malformed: int | None = None, **options: str) -> str:
    """W6 from its files: typed employee CSV and geo dimension CSV -> :func:`load_employee_table`.

    Without ``quarantine`` a malformed cell loads as NULL, as in the original job."""
    employees = _read_drop(spark, employees_path, EMPLOYEE, table, quarantine, most_malformed, options)
    return load_employee_table(spark, employees, read_csv(spark, geo_path, COUNTRY_GEO), database, table)


def load_user_service_csv(spark: SparkSession, users_path: str, zips_path: str, database: str,
                          table: str = "user_service_data", *, quarantine: str | None = None,
                          most_malformed: int | None = None, **options: str) -> str:
    """W7 from its files: typed 66-column CSV and reverse-geocode CSV ->
    :func:`load_user_service_table`."""
    users = _read_drop(spark, users_path, USER_SERVICE, table, quarantine, most_malformed, options)
    return load_user_service_table(spark, users, read_csv(spark, zips_path, REVERSE_GEOCODE), database, table)
