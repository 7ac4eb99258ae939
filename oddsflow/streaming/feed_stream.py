"""Incremental ingest of the feed with Structured Streaming.

New event files are picked up by the file source (its own checkpoint records
which files were read); every micro-batch runs the batch ingest
(:func:`oddsflow.sources.feed.split_lineage`), drops changes already stored, and is
written as partition ``batch_id=<n>`` of the raw table.  Overwriting only that
partition makes a retried batch idempotent.  A load log row per batch
(batch_id, committed_at, rows) is what :func:`oddsflow.operators.diff.latest_batch`
and :func:`oddsflow.operators.diff.read_increment` read.

Lineage goes to a table of (change_key, file) rows: a copy of a change that
arrives in a later micro-batch adds no raw row, but its file.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..jobs import not_stored
from ..sinks.tables import stored
from ..sources.feed import FEED_SCHEMA, PER_MARKET_FILE, seen_changes, split_lineage


def feed_stream(spark: SparkSession, path: str, exclude: str | None = PER_MARKET_FILE,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of feed messages with their source file."""
    reader = spark.readStream.schema(FEED_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.json(path).select("*", F.col("_metadata.file_path").alias("source_file_name"))
    if exclude:
        df = df.where(~F.col("source_file_name").rlike(exclude))
    return df


def _stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ingest_batch(batch: DataFrame, batch_id: int, raw_path: str, log_path: str,
                 lineage_path: str | None = None) -> None:
    """foreachBatch body: dedupe the batch, keep only new changes, write it.

    The batch's distinct (change, file) rows are stored first, so its files are
    parsed once.  With ``lineage_path`` all of them are written there as
    (change_key, file) rows (partition ``batch_id``), also those of changes that
    an earlier batch already brought; a reader counts distinct files.
    """
    spark = batch.sparkSession
    new, lineage = split_lineage(stored(seen_changes(batch), f"feed-batch-{batch_id}"))
    if lineage_path:
        (lineage.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(lineage_path))
    old = _stored_rows(spark, raw_path)
    if old is not None:
        new = not_stored(new, old.where(F.col("batch_id") != batch_id))
    seen = Observation(f"batch-{batch_id}")
    out = new.withColumn("batch_id", F.lit(batch_id).cast("long")).observe(seen, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(raw_path))
    log = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.current_timestamp().alias("committed_at"),
                                F.lit(seen.get["rows"]).cast("long").alias("rows"))
    # one log partition per batch, overwritten on a retry: idempotent like the data
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(log_path))


def start_ingest(stream: DataFrame, raw_path: str, log_path: str, checkpoint_location: str | None = None,
                 available_now: bool = True, lineage_path: str | None = None) -> StreamingQuery:
    """Run :func:`ingest_batch` for every micro-batch of ``stream``.

    The checkpoint goes under the cluster's ``spark.checkpoint.dir`` unless a
    location is given.
    """
    if checkpoint_location is None:
        from ..session import checkpoint_dir

        checkpoint_location = os.path.join(checkpoint_dir(stream.sparkSession), "feed-ingest")
    writer = (stream.writeStream.option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda df, bid: ingest_batch(df, bid, raw_path, log_path, lineage_path)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
