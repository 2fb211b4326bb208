"""Ranges of a number, for ordered work that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Ranges:
    """Ranges of ``column`` that hold about equally many rows, four for each shuffle partition.

    Their bounds are quantiles of the column (one pass over it alone); each is a value that occurs, so
    the first row of every range is known.  Nulls belong to the last range.
    """

    def __init__(self, rows: DataFrame, column: str):
        n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shares = ", ".join(str(i / n) for i in range(1, n))
        cuts = F.expr(f"percentile_approx({column}, array({shares}), {20 * n})")
        found = rows.agg(F.min(column).alias("first"), cuts.alias("cuts")).first()
        self.first = found.first
        self.cuts = sorted({c for c in found.cuts or [] if c > found.first})
        self.last = len(self.cuts)
        self.bounds = f"array({', '.join(f'{c}L' for c in self.cuts)})" if self.cuts else "CAST(array() AS array<long>)"
        self.number = F.expr(
            f"CASE WHEN {column} IS NULL THEN {self.last} ELSE size(filter({self.bounds}, c -> c <= {column})) END"
        )
