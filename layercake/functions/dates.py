"""Date parts used for partitioning and layer paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(c: Column) -> Column:
    """Calendar year of a date/timestamp as INT."""
    return F.year(c)


def month_name(c: Column) -> Column:
    """English full month name (``September``)."""
    return F.date_format(c, "MMMM")


def date_path(c: Column) -> Column:
    """Legacy folder path ``yyyy/MMMM/dd`` (``2024/September/05``)."""
    return F.date_format(c, "yyyy/MMMM/dd")
