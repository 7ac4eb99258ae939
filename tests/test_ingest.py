"""Ingest: changes told apart by hash and by value, known keys, bad lines put aside and counted."""

import bz2
import json

from pyspark.sql import functions as F

from oddsflow import jobs
from oddsflow import queries as Q
from oddsflow import standins as S
from oddsflow.sinks.tables import stored
from oddsflow.sources.feed import bad_lines, change_hash, dedupe_by_hash, dedupe_changes, explode_changes, good_changes, read_feed, seen_lines, store_by_hash


def rows(df):
    return sorted(map(str, df.collect()))


def changes_of(spark, feed_dir):
    return explode_changes(read_feed(spark, feed_dir))


def test_hash_dedupe_equals_grouping_by_value(spark, feed_dir):
    changes = changes_of(spark, feed_dir)
    assert rows(dedupe_by_hash(changes, stored)) == rows(dedupe_changes(changes))
    twice = changes.unionByName(changes.withColumn("_file", F.lit("another")))
    assert rows(dedupe_by_hash(twice, stored)) == rows(dedupe_changes(twice))
    assert dedupe_by_hash(changes.limit(0), stored).collect() == []


def test_a_planted_collision_is_resolved(spark, feed_dir):
    changes = changes_of(spark, feed_dir)
    for weak in (lambda: [F.lit(1).cast("long"), F.lit(2).cast("long")], lambda: [F.col("pt") % 2, F.lit(0).cast("long")]):
        assert rows(dedupe_by_hash(changes, stored, weak)) == rows(dedupe_changes(changes))
    fields = changes.limit(1).select(F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b")).alias("x"), F.struct(F.lit(None).cast("int").alias("a"), F.lit(1).alias("b")).alias("y"))
    one, two = (fields.select(*change_hash(F.lit(5), F.col(c))).first() for c in "xy")
    assert one[0] != two[0] and one[1] != two[1] and one[0] != one[1]


def test_single_changes_are_not_shuffled(spark, feed_dir):
    """Grouping by value shuffles every change; by hash, 16 bytes each, and the copies."""
    out = dedupe_by_hash(changes_of(spark, feed_dir), stored)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1  # of the copies; the hashes were grouped before
    big = spark.range(20000).select(F.col("id").alias("pt"), F.struct(F.concat(F.lit("m"), F.col("id")).alias("id"), F.repeat(F.lit("x"), 400).alias("body")).alias("mc"), F.lit("f").alias("_file"))
    held = stored(big)
    keys = held.select(*[h.alias(f"h{k}") for k, h in enumerate(change_hash())])
    size = lambda df: df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert len(keys.columns) == 2 and keys.distinct().count() == 20000
    assert rows(dedupe_by_hash(held, stored).select("pt")) == rows(held.select("pt")) and size(keys) < size(held)


def message(pt, market, ltp):
    return json.dumps({"op": "mcm", "clk": "c", "pt": pt, "mc": [{"id": market, "rc": [{"id": 1, "ltp": ltp}]}]})


def test_bad_lines_are_kept_and_counted(spark, tmp_path):
    good = [message(1, "1.1", 2.0), message(2, "1.1", 2.5), message(2, "1.1", 2.5)]
    bad = ['{"op": "mcm", "pt": 3, "mc": [{"id"', "not json", "not json", '{"pt": "text", "mc": 5}']
    (tmp_path / "a.bz2").write_bytes(bz2.compress("\n".join([*good, *bad, '{"op": "mcm", "pt": 9}', "{}"]).encode()))
    (tmp_path / "1.55.bz2").write_bytes(bz2.compress(b"skipped, not json"))
    seen = stored(seen_lines(read_feed(spark, str(tmp_path))))
    assert good_changes(seen).count() == 2
    assert {r.bad_line: r.lines for r in bad_lines(seen).collect()} == {bad[0]: 1, "not json": 2, bad[3]: 1}
    ns = "oddsflow_jobs_bad"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    assert jobs.load_raw(spark, str(tmp_path), ns).count() == 2
    (tmp_path / "b.bz2").write_bytes(bz2.compress("\n".join([good[0], message(7, "1.2", 1.5), "new bad line"]).encode()))
    assert jobs.load_raw(spark, str(tmp_path), ns).count() == 3
    loads = [(r.batch_id, r.changes, r.bad_lines) for r in spark.table(f"{ns}.raw_loads").orderBy("batch_id").collect()]
    assert loads == [(1, 2, 4), (2, 1, 1)] and spark.table(f"{ns}.raw_quarantine").count() == 4
    spark.catalog.setCurrentDatabase("default")


def test_known_keys_that_collide_are_compared_whole(spark, feed_dir):
    changes = stored(dedupe_changes(changes_of(spark, feed_dir)).select("pt", "mc").withColumn("change_key", F.lit(4).cast("long")))
    old = changes.orderBy("pt").limit(7)
    assert rows(jobs.not_stored(changes, old)) == rows(changes.join(old.select("pt", "mc").withColumn("o", F.lit(1)), ["pt", "mc"], "left").where("o is null").select(*changes.columns))
    assert jobs.not_stored(changes, changes).count() == 0


def test_changes_seen_once_are_written_once(spark, feed_dir, monkeypatch):
    from oddsflow.sources import feed

    changes = changes_of(spark, feed_dir)
    twice = changes.unionByName(changes.limit(3).withColumn("_file", F.lit("another")))
    written = []

    def store(df):
        written.append(stored(df))
        return written[-1]

    assert rows(store_by_hash(twice, store)) == rows(dedupe_changes(twice))
    held, shared, copies = written
    assert held.count() == twice.count() and "_h2" not in held.columns and shared.count() == copies.count() < held.count() / 4
    monkeypatch.setattr(feed, "BROADCAST_HASHES", 0)  # many copies: the whole result is written
    written.clear()
    assert rows(store_by_hash(twice, store)) == rows(dedupe_changes(twice)) and written[-1].count() == dedupe_changes(twice).count()


def test_stored_parts_are_the_whole_raw_table(spark):
    d = "/root/testdata/sf0.001"
    assert rows(Q._raw(spark, d).select("pt", "mc", "source_file_names")) == rows(dedupe_changes(S.feed_changes(spark, d)).select("pt", "mc", "source_file_names"))
    assert rows(Q._raw_definitions(spark, d)) == rows(Q._raw(spark, d).where("mc.marketDefinition is not null"))


def test_a_small_table_is_worked_on_by_several_tasks(spark):
    tasks = S.write_tasks(spark)
    assert tasks >= 4 * spark.sparkContext.defaultParallelism
    assert S.feed_changes(spark, "/root/testdata/sf0.001", tasks=tasks).rdd.getNumPartitions() >= 2 * tasks
    plan = S.feed_changes(spark, "/root/testdata/sf0.001").where("mc.marketDefinition is not null")
    assert plan.rdd.getNumPartitions() >= tasks


def test_kept_frames_are_written_densely(spark):
    names = stored(spark.range(10)).inputFiles()
    assert names and all(name.endswith(".zstd.parquet") for name in names)
