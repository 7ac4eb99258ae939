"""Row numbers and dense ranks over a whole table, without gathering it in one task.

Rows are range-partitioned by the order and sorted inside each partition; a row's number is
its place in its partition plus the rows of all partitions before.  The ranges are sampled,
so partitions stay even whatever the values, and only one count a partition leaves the
executors.  The order must be total for numbers that do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACE = 33  # monotonically_increasing_id() holds the partition above this bit, the row's place below it


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` with ``name`` = 1..n by ``order``.  ``store`` writes a table and reads it back: the
    numbered rows are laid out once, and read for the counts and for the result."""
    placed = store(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", _PLACE), F.col("_at").bitwiseAND(F.lit((1 << _PLACE) - 1))
    before, rows = 0, []
    for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # a row a partition
        rows.append((r["part"], before))
        before += r["n"]
    starts = df.sparkSession.createDataFrame(rows, "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_before") + place + 1).alias(name))


def dense_rank(df: DataFrame, cols: Sequence[str], name: str, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The distinct values of ``cols`` with ``name`` = 1..n by their order, NULLs last."""
    return global_row_number(df.select(*cols).distinct(), [F.col(c).asc_nulls_last() for c in cols], name, store)
