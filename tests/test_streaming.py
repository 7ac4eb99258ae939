"""Incremental feed ingest with Structured Streaming equals the batch ingest."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from oddsflow.operators.diff import latest_batch, read_increment
from oddsflow.sources.feed import ingest, read_feed
from oddsflow.streaming.feed_stream import feed_stream, start_ingest


def test_stream_ingest_matches_batch_and_is_incremental(spark, feed_dir):
    work = tempfile.mkdtemp(prefix="oddsflow-stream-")
    landing = os.path.join(work, "landing")
    raw_path, log_path, ckpt = (os.path.join(work, n) for n in ("raw", "log", "ckpt"))
    shutil.copytree(os.path.join(feed_dir, "2025"), os.path.join(landing, "2025"))

    q = start_ingest(feed_stream(spark, landing), raw_path, log_path, ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(raw_path)
    batch = ingest(read_feed(spark, os.path.join(feed_dir, "2025")))
    assert first.count() == batch.count() == 20
    assert sorted(map(str, first.select("pt", "mc").collect())) == sorted(map(str, batch.select("pt", "mc").collect()))

    # a later file holding only an already stored change adds nothing new
    shutil.copytree(os.path.join(feed_dir, "copies"), os.path.join(landing, "copies"))
    q = start_ingest(feed_stream(spark, landing), raw_path, log_path, ckpt)
    q.awaitTermination(120)
    log = spark.read.parquet(log_path)
    assert log.count() == 2
    last = latest_batch(log).collect()[0][0]
    raw = spark.read.parquet(raw_path)
    assert raw.count() == 20
    assert read_increment(raw, last - 1, last).count() == 0
    assert raw.select("change_key").distinct().count() == 20


def test_stream_ingest_with_lineage_table(spark, feed_dir):
    work = tempfile.mkdtemp(prefix="oddsflow-stream-lin-")
    raw_path, log_path, lin_path, ckpt = (os.path.join(work, n) for n in ("raw", "log", "lineage", "ckpt"))
    q = start_ingest(feed_stream(spark, feed_dir), raw_path, log_path, ckpt, lineage_path=lin_path)
    q.awaitTermination(120)
    raw = spark.read.parquet(raw_path)
    lin = spark.read.parquet(lin_path)
    assert raw.count() == 20
    assert lin.count() == 21
    assert raw.join(lin, "change_key").count() == 21


def test_retried_batch_is_idempotent(spark, feed_dir):
    from oddsflow.sources.feed import read_feed
    from oddsflow.streaming.feed_stream import ingest_batch

    work = tempfile.mkdtemp(prefix="oddsflow-retry-")
    raw_path, log_path = os.path.join(work, "raw"), os.path.join(work, "log")
    batch = read_feed(spark, feed_dir)
    for _ in range(2):                       # the same batch id written twice (a retry)
        ingest_batch(batch, 0, raw_path, log_path)
    assert spark.read.parquet(raw_path).count() == 20
    assert spark.read.parquet(log_path).count() == 1
