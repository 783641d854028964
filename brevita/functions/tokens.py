"""Tokens of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(c: Column) -> Column:
    """Lowercase letters and digits, everything else a single space, no space at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def token_count(normal: Column) -> Column:
    """Number of tokens of a normalised text."""
    return F.when(normal == "", 0).otherwise(F.length(normal) - F.length(F.replace(normal, F.lit(" "))) + 1)
