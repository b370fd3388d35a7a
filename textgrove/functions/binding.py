"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Without it a chain of conditional steps would double in size with each
    step wherever Spark does not share equal expressions, such as in filters
    and in branches.
    """
    return F.transform(F.array(value), use)[0]
