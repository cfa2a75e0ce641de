"""Bind a value once inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated exactly once per row.

    An expression used inside a lambda is otherwise evaluated again for every element, also when
    it was a column of its own: the optimizer merges projections that use a column only once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
