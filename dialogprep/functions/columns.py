"""Small Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A Column used twice is computed twice once the optimizer merges
    projections. Binding it as a lambda variable keeps it single.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_long(c: Column) -> Column:
    return c.cast("bigint")
