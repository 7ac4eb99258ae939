"""Writing tables: create/append/replace, sorted rewrites, namespaces."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, conf_set


class WriteMode(str, Enum):
    """How :func:`save_table` treats an existing table."""

    APPEND = "append"
    REPLACE = "replace"


# Files of as many partitions a task keeps open while it writes a partitioned table; only with
# more of them are its rows sorted by partition.
OPEN_FILES, PARTITION_FILES = "spark.sql.maxConcurrentOutputFileWriters", "20"


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    """Create the namespace if missing and make it current."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    spark.catalog.setCurrentDatabase(namespace)


def save_table(spark: SparkSession, df: DataFrame, name: str, mode: WriteMode | str = WriteMode.APPEND,
               fmt: str = "parquet", partition_by: Sequence[str] = (),
               bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Create the table on first use; afterwards append (columns matched by name) or replace.

    Appending a column that the table lacks is an error, never dropped silently.
    Replacing writes new files beside the old ones and then points the table at
    them (see switch_in), so a failed write leaves the old table as it was, and
    ``df`` may read the table itself.
    ``bucket_by=(n, cols)`` writes ``n`` hash buckets on ``cols``, sorted by
    them: two tables bucketed alike are later joined on ``cols`` without a
    shuffle of either side.
    """
    mode = WriteMode(mode)

    def writer_for(frame: DataFrame):
        w = frame.write.format(fmt)
        if fmt == "parquet":
            w = w.option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            n, cols = bucket_by
            w = w.bucketBy(n, *cols).sortBy(*cols)
        return w

    recover_table(spark, name)
    if not spark.catalog.tableExists(name):
        with conf_set(spark, {OPEN_FILES: PARTITION_FILES} if partition_by else {}):
            writer_for(df).mode("errorifexists").saveAsTable(name)
    elif mode is WriteMode.APPEND:
        existing = spark.table(name).columns
        if unknown := [c for c in df.columns if c not in existing]:
            raise ValueError(f"{name} has no column {', '.join(unknown)}; replace the table or drop the column first")
        with conf_set(spark, {OPEN_FILES: PARTITION_FILES} if partition_by else {}):
            writer_for(df.select(*existing)).mode("append").saveAsTable(name)
    else:
        write_beside(spark, writer_for(df), name)
        switch_in(spark, name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns a table is partitioned by."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_partitions(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Write ``df`` over the partitions it has rows in, and over no others; a job that is run
    again replaces what it wrote.  Creates the table on first use."""
    if not spark.catalog.tableExists(name):
        save_table(spark, df, name, partition_by=partition_by)
        return
    columns = spark.table(name).columns
    df.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)


STAGED, REPLACED = "__staged", "__replaced"
PREVIOUS = "previous_location"  # table property: the files that running readers may still be in


def table_details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: Location, Num Buckets, Bucket Columns ..., and its columns under ``columns``."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    at = next(i for i, (k, _) in enumerate(rows) if k == "# Detailed Table Information")
    return {"columns": str([r for r in rows[:at] if r[0]]), **dict(rows[at + 1:])}


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(key)


def remove_files(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_beside(spark: SparkSession, writer: DataFrameWriter, name: str) -> None:
    """Write the next version of table ``name``, as table ``name__staged``, in a folder of its own beside it."""
    parent = table_details(spark, name)["Location"].rstrip("/").rsplit("/", 1)[0]
    path = f"{parent}/{name.split('.')[-1]}-{uuid.uuid4().hex}"
    writer.option("path", path).mode("errorifexists").saveAsTable(name + STAGED)


def switch_in(spark: SparkSession, name: str) -> None:
    """Make the complete table ``name__staged`` the content of ``name``.

    The table's location is set to the new files, one change of one catalog entry: a reader
    that starts before it gets all of the old version, one that starts after it all of the new
    one, and no file is written twice.  Old files stay until the next replacement, for readers
    that are in them.  Where columns, partitioning or buckets change, which a location cannot
    say, the two tables change names instead.
    """
    old, new = table_details(spark, name), table_details(spark, name + STAGED)
    same = all(old.get(k) == new.get(k) for k in ("columns", "Provider", "Num Buckets", "Bucket Columns", "Sort Columns"))
    if not same:
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{REPLACED}")
        spark.sql(f"ALTER TABLE {name}{STAGED} RENAME TO {name}")
        drop_table(spark, name + REPLACED)
        return
    before = table_property(spark, name, PREVIOUS)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new['Location']}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{old['Location']}')")
    spark.sql(f"DROP TABLE {name}{STAGED}")  # the entry only: its files have a location of their own
    if before:
        remove_files(spark, before)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table with its files, those of its last replaced version too."""
    if not spark.catalog.tableExists(name):
        return
    places = [table_details(spark, name)["Location"], table_property(spark, name, PREVIOUS)]
    spark.sql(f"DROP TABLE {name}")
    for place in filter(None, places):
        remove_files(spark, place)


def recover_table(spark: SparkSession, name: str) -> None:
    """Undo or finish a replacement that was cut off between any two steps.

    The only complete copy is never dropped: while ``name`` exists the staged copy may be half
    written and goes, unless the switch to its files was made; if ``name`` is missing the
    replaced table takes its name back.
    """
    there = spark.catalog.tableExists
    if not there(name) and there(name + REPLACED):
        if before := table_property(spark, name + REPLACED, PREVIOUS):  # may lie where the table's own folder would
            remove_files(spark, before)
            spark.sql(f"ALTER TABLE {name}{REPLACED} UNSET TBLPROPERTIES ('{PREVIOUS}')")
        spark.sql(f"ALTER TABLE {name}{REPLACED} RENAME TO {name}")
    if there(name):
        if there(name + STAGED):
            place = table_details(spark, name + STAGED)["Location"]
            spark.sql(f"DROP TABLE {name}{STAGED}")
            if place != table_details(spark, name)["Location"]:
                remove_files(spark, place)
        drop_table(spark, name + REPLACED)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written as parquet in the cluster's shared checkpoint folder and read back:
    computed once, with column pruning and pushdown for every later reader."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def sort_key(name: str, descending: bool = False) -> Column:
    """A layout sort key with NULLS LAST in either direction."""
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def sorted_layout(df: DataFrame, keys: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and sort inside each partition.

    Written out, every file covers a narrow, non-overlapping key range, so
    parquet min/max statistics prune row groups on the sort keys.  Ranges are
    sampled, so a hot key is cut across several partitions.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def rewrite_sorted(df: DataFrame, path: str, keys: Sequence[Column], partitions: int | None = None,
                   fmt: str = "parquet") -> str:
    """Write ``df`` in sorted layout to a new ``path`` (the caller swaps it in)."""
    sorted_layout(df, keys, partitions).write.format(fmt).mode("errorifexists").save(path)
    return path


def read_or_create(spark: SparkSession, name: str, build, mode: WriteMode | str = WriteMode.REPLACE) -> DataFrame:
    """The table ``name``; built with ``build()`` and saved first if it is missing
    (SRC-10, e.g. the flattened market definitions)."""
    recover_table(spark, name)
    if not spark.catalog.tableExists(name):
        save_table(spark, build(), name, mode)
    return spark.read.table(name)
