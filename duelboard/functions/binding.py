"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Writing an expression into a column several times lets the optimizer inline
    and repeat it; a one-element array and its lambda variable keep the costly
    part (a regular expression over a long text) to a single evaluation.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
