"""Row expansion by user-written code, as a table function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import DataType


def row_expansion(make: Callable, schema: str, partition_by: list[str] | None = None, order_by: list[str] | None = None):
    """Table function that turns each row of its table argument into any number of rows of ``schema``.

    ``make()`` gives the expansion: a function ``row -> iterable of tuples``, or an object
    with ``row(row)`` and ``end()``, both giving tuples. With ``partition_by`` an
    expansion sees all rows of one key, in the order of ``order_by``, and may carry state
    from row to row; ``end()`` is called after the last. Without it rows are expanded
    where they lie, one expansion per task. The required partitioning and order are part
    of the function (its ``analyze``), so callers only pass a table.
    """
    returned = DataType.fromDDL(schema)
    keys, order = list(partition_by or []), list(order_by or [])

    class Expansion:
        def __init__(self):
            self.made = make()
            self.row = getattr(self.made, "row", self.made)

        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError("a row expansion takes a table")
            held = {field.name for field in rows.dataType.fields}
            absent = [name for name in [*keys, *order] if name not in held]
            if absent:
                raise ValueError(f"the table lacks the columns {', '.join(absent)}")
            return AnalyzeResult(
                schema=returned,
                partitionBy=[PartitioningColumn(name) for name in keys],
                orderBy=[OrderingColumn(name) for name in order],
            )

        def eval(self, rows):
            yield from self.row(rows)

        def terminate(self):
            if hasattr(self.made, "end"):
                yield from self.made.end()

    return udtf(Expansion)


def expand_rows(df: DataFrame, make: Callable, schema: str, partition_by: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """The rows that an expansion makes of ``df``."""
    return row_expansion(make, schema, partition_by, order_by)(df.asTable())
