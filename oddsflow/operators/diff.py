"""Snapshot change logs and incremental reads over an ingest-batch column.

The reference asks its table format for "the latest snapshot" and for the net
change log up to it.  Here the same questions are asked of plain tables: a load
log with one row per batch, and two snapshots compared as multisets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"
INSERT, DELETE = "INSERT", "DELETE"
COPIES = 1 << 16  # copies of one row made from one array


def latest_batch(load_log: DataFrame, batch_col: str = "batch_id", committed_col: str = "committed_at") -> DataFrame:
    """One row, one column: the batch id with the newest commit time (ties: highest id)."""
    return load_log.agg(F.max_by(F.col(batch_col), F.struct(committed_col, batch_col)).alias(batch_col))


def read_increment(df: DataFrame, lo, hi, batch_col: str = "batch_id") -> DataFrame:
    """Rows added after batch ``lo`` up to and including batch ``hi``."""
    return df.where((F.col(batch_col) > F.lit(lo)) & (F.col(batch_col) <= F.lit(hi)))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Net changes from ``old`` to ``new`` as multisets.

    A row present k times more in ``new`` gives k INSERT rows, k times fewer
    gives k DELETE rows; rows in both cancel (net changes).  Columns are
    matched by name.
    """
    cols = old.columns
    # One aggregation instead of two EXCEPT ALLs: +1 per row of new, -1 per row
    # of old, summed per distinct row (NULLs group together, as in EXCEPT ALL);
    # partial aggregation collapses a row repeated many times before the shuffle.
    tagged = (new.select(*cols).withColumn("_d", F.lit(1))
              .unionByName(old.withColumn("_d", F.lit(-1))))
    net = tagged.groupBy(*cols).agg(F.sum("_d").alias("_n")).where(F.col("_n") != 0)
    return net.select(
        *cols,
        F.when(F.col("_n") > 0, F.lit(INSERT)).otherwise(F.lit(DELETE)).alias(CHANGE_TYPE),
        # copies in two steps, so a row repeated very often never becomes one huge array
        F.col("_n"), F.explode(F.sequence(F.lit(0), F.floor((F.abs("_n") - 1) / COPIES))).alias("_run"),
    ).select(
        *cols, CHANGE_TYPE,
        F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.abs("_n") - F.col("_run") * COPIES))).alias("_k"),
    ).drop("_k")


def apply_diff(old: DataFrame, diff: DataFrame) -> DataFrame:
    """Inverse of :func:`snapshot_diff`: ``apply_diff(old, snapshot_diff(old, new)) == new``."""
    cols = old.columns
    deletes = diff.where(F.col(CHANGE_TYPE) == DELETE).select(*cols)
    inserts = diff.where(F.col(CHANGE_TYPE) == INSERT).select(*cols)
    return old.exceptAll(deletes).unionByName(inserts)
