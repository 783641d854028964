"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(c: Column, digits: int) -> Column:
    """Half-even rounding on the decimal text of a double."""
    return F.bround(c, digits)


def success_flag(status: Column) -> Column:
    """1 for a successful request, 0 for any other status or none."""
    return F.coalesce((status == "success").cast("int"), F.lit(0))
