"""Expressions whose value is used more than once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with value computed once, as the bound variable of a one-element array; keeps long expressions from multiplying."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
