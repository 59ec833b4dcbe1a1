"""Evaluate an expression once and reuse it (a ``let`` for Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Chained projections that reference an expensive column several times are
    collapsed by the optimizer into one expression that repeats it, and filters
    pushed below a projection repeat it too; binding through a one-element
    ``transform`` keeps a single evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
