"""Text that is cut in the byte ranges of a file, and the pieces at their borders.

A task has one or more *blocks* (byte ranges) of a file in order.  What lies between two marks inside a block is complete; text
up to the first mark, behind the last one, or of a block without marks belongs to something that may lie over several
blocks.  These fragments are chained by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Kinds of rows.  The fragments: up to the first mark, without a mark, behind the last mark (or from the file's beginning).
COMPLETE, UP_TO, WITHOUT, BEHIND, BLOCK = range(5)


def chains(parts: DataFrame, order: list[str], begin: list[str], end: list[str]) -> DataFrame:
    """Closed chains of fragments: ``(file, *order, kind, chain)`` with columns of the fragment that begins each and that ends it.

    ``parts`` has ``file``, ``kind`` and the columns named; their texts are not needed, so text that is never closed,
    however long, is not brought together.
    """
    parts = parts.select("file", "kind", *dict.fromkeys([*order, *begin, *end]))
    opened = F.count_if(F.col("kind") == BEHIND).over(W.partitionBy("file").orderBy(*order, "kind"))
    placed = parts.withColumn("chain", opened)

    def of(kind: int, column: str, name: str):
        return F.max(F.when(F.col("kind") == kind, F.col(column))).alias(name)

    both = placed.groupBy("file", "chain").agg(
        F.count_if(F.col("kind") == BEHIND).alias("begun"),
        F.count_if(F.col("kind") == UP_TO).alias("ended"),
        *[of(BEHIND, c, f"begin_{c}") for c in begin],
        *[of(UP_TO, c, f"end_{c}") for c in end],
    )
    closed = both.filter("begun = 1 AND ended = 1").drop("begun", "ended")
    return placed.select("file", *order, "kind", "chain").join(closed, ["file", "chain"])


def joined_texts(parts: DataFrame, chained: DataFrame, order: list[str]) -> DataFrame:
    """``text`` of each closed chain: its fragments' ``record`` in order."""
    keys = ["file", *order, "kind"]
    about = [c for c in chained.columns if c not in keys]
    texts = parts.select(*keys, "record").join(chained, keys)
    listed = F.sort_array(F.collect_list(F.struct(*order, "kind", "record")))
    text = F.array_join(F.transform(listed, lambda p: p["record"].cast("string")), "")
    return texts.groupBy("file", *about).agg(text.alias("text"))
