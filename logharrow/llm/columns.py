"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once a row: an expression that a lambda refers to is evaluated at each call."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
