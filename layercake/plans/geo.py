"""Geo dimension build and publish (J5 + K11).

The original job resolved each country through a web geocoder and kept the
first result.  Here the candidates are a table (for example a geocoder
export or a gazetteer), and the first candidate per key is a distributed
``min_by`` aggregate; every key of the list is kept, unresolved ones with
NULL coordinates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..countries import COUNTRIES
from ..operators.joins import first_match
from ..sinks.files import write_csv


def country_keys(spark: SparkSession, countries: Sequence[str] = COUNTRIES) -> DataFrame:
    """The default key list as a one-column DataFrame (``Country``)."""
    return spark.createDataFrame([(c,) for c in countries], "Country string")


def build_geo_dimension(keys: DataFrame, candidates: DataFrame, *, key: str = "Country",
                        order_by: Sequence[str] = ("rank",),
                        values: Sequence[str] = ("Latitude", "Longitude"),
                        candidate_key: str | None = None) -> DataFrame:
    """``key, *values``: the first candidate per key by ``order_by``."""
    dim = first_match(keys.select(key), candidates, key, order_by, values,
                      candidate_key=candidate_key)
    return dim


def publish_geo_dimension(dim: DataFrame, path: str) -> str:
    """The dimension as a CSV dataset with a header (read back with
    ``schemas.COUNTRY_GEO``)."""
    return write_csv(dim, path)
