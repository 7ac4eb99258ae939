"""SNK-1..7: table writes and sorted layout."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from oddsflow.sinks.tables import PREVIOUS, STAGED, WriteMode, drop_table, recover_table, table_details, table_property, ensure_namespace, rewrite_sorted, save_table, sort_key, sorted_layout


def test_save_table_create_append_replace(spark):
    ensure_namespace(spark, "oddsflow_test")
    name = "oddsflow_test.t_save"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    save_table(spark, a, name)                                   # create
    save_table(spark, a.select("v", "id"), name)                 # append matches by name
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 1]
    save_table(spark, a.withColumn("id", F.lit(5)), name, mode="replace")
    assert [r["id"] for r in spark.table(name).collect()] == [5]
    assert WriteMode("append") is WriteMode.APPEND
    with pytest.raises(ValueError):
        WriteMode("upsert")
    spark.catalog.setCurrentDatabase("default")


def test_sorted_layout_and_rewrite(spark):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("m"), (F.col("id") * 7 % 101).alias("epoch"))
    out = sorted_layout(df, [sort_key("m", descending=True), sort_key("epoch")], partitions=4)
    assert out.rdd.getNumPartitions() == 4
    parts = out.rdd.glom().map(lambda rs: [(r["m"], r["epoch"]) for r in rs]).collect()
    for p in parts:
        assert p == sorted(p, key=lambda t: (-t[0], t[1]))
    ms = [set(m for m, _ in p) for p in parts if p]
    for a, b in zip(ms, ms[1:]):
        assert min(a) >= max(b)          # descending, non-overlapping ranges
    path = os.path.join(tempfile.mkdtemp(prefix="oddsflow-sorted-"), "t")
    rewrite_sorted(df, path, [sort_key("m"), sort_key("epoch")], partitions=3)
    assert spark.read.parquet(path).count() == 1000


def test_read_or_create_builds_once(spark):
    from oddsflow.sinks.tables import read_or_create

    ensure_namespace(spark, "oddsflow_test")
    name = "oddsflow_test.t_flat"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1,)], "id long")

    assert read_or_create(spark, name, build).count() == 1
    assert read_or_create(spark, name, build).count() == 1
    assert len(calls) == 1
    spark.catalog.setCurrentDatabase("default")


def test_observed_count(spark):
    from oddsflow.plans.clean import observed_count

    df, obs = observed_count(spark.range(0, 123), "rows_seen")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 123


@pytest.mark.parametrize("partitioned", [False, True])
def test_readers_never_fail_while_a_table_is_replaced(spark, partitioned):
    name, by = f"default.t_replaced_{int(partitioned)}", ("p",) if partitioned else ()
    drop_table(spark, name)
    version = lambda v: spark.range(200).select("id", F.lit(v).alias("v"), (F.col("id") % 3).alias("p"))
    save_table(spark, version(0), name, partition_by=by)
    seen, stop, errors = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(tuple(r) for r in spark.table(name).groupBy("v").count().collect()))
            except Exception as e:  # noqa: BLE001 - any failure of a reader is what this looks for
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    places = [table_details(spark, name)["Location"]]
    for v in range(1, 6):
        save_table(spark, version(v), name, "replace", partition_by=by)
        places.append(table_details(spark, name)["Location"])
    stop.set()
    reader.join()
    assert not errors and len(seen) > 1 and {s for s in seen} <= {((v, 200),) for v in range(6)}
    assert len(set(places)) == 6 and table_property(spark, name, PREVIOUS) == places[-2]
    files = spark.table(name).inputFiles()
    assert files and all(places[-1].removeprefix("file:") in f for f in files)
    kept = [os.path.isdir(p.removeprefix("file:")) for p in places]
    assert kept == [False] * 4 + [True, True]  # the last version stays for readers that are in it
    save_table(spark, spark.table(name).where("id < 100"), name, partition_by=by, mode="replace")  # from itself
    assert spark.table(name).count() == 100
    drop_table(spark, name)
    assert not any(os.path.isdir(p.removeprefix("file:")) for p in places)


def test_a_cut_off_replacement_is_undone_or_finished(spark):
    name = "default.t_cut"
    drop_table(spark, name)
    save_table(spark, spark.range(3), name)
    from oddsflow.sinks import tables

    tables.write_beside(spark, spark.range(9).write, name)            # cut off before the switch
    staged = table_details(spark, name + STAGED)["Location"]
    recover_table(spark, name)
    assert spark.table(name).count() == 3 and not os.path.isdir(staged.removeprefix("file:"))
    tables.write_beside(spark, spark.range(9).write, name)            # cut off right after it
    staged = table_details(spark, name + STAGED)["Location"]
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{staged}'")
    recover_table(spark, name)
    assert spark.table(name).count() == 9 and not spark.catalog.tableExists(name + STAGED)
    save_table(spark, spark.range(4).toDF("other"), name, "replace")  # other columns
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 4
    drop_table(spark, name)
