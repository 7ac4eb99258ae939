"""Prefix scan, distributed ranks, interval join and pruned facts: results, and what a task or a scan reads."""

import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from oddsflow.operators.joins import interval_join
from oddsflow.operators.keys import with_rank_key
from oddsflow.operators.ladder import carry_forward
from oddsflow.operators.ranks import global_row_number
from oddsflow.operators.scan import PART, fill_partitions, scan_forward
from oddsflow.plans import clean, present
from oddsflow.sinks.tables import drop_table, save_table, stored


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def wide_ranges(spark, n):
    """Keep range partitions apart however few rows they hold."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))


@pytest.fixture
def many_parts(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    wide_ranges(spark, 12)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


row = st.tuples(st.sampled_from([None, "a", "b", "c"]), st.integers(0, 6), st.integers(0, 10**6), st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text("xyz", max_size=2)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=60))
def test_scan_equals_window(spark, many_parts, rows):
    df = spark.createDataFrame(rows, "k string, t int, seq int, v int, w string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert same(scan_forward(df, ["k"], ["t", "seq", "v", "w"], ["v", "w"], stored), carry_forward(df, ["k"], "t", ["v", "w"], tiebreak=["seq", "v", "w"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_one_runner_with_all_changes_in_one_minute(spark, many_parts):
    n = 60_000
    df = spark.range(n).select(F.lit("m").alias("market_id"), F.lit(1).alias("runner_id"), (F.col("id") % 60_000).alias("epoch"),
                               F.when(F.col("id") % 9973 == 5, F.col("id")).alias("odds"), F.when(F.col("id") == 3, F.lit(1.5)).alias("amount"))
    parts = fill_partitions(df, ["market_id", "runner_id"], ["epoch"], ["odds", "amount"])
    sizes = [r["count"] for r in parts.groupBy(PART).count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * statistics.median(sizes) and sum(sizes) == n
    got = scan_forward(df, ["market_id", "runner_id"], ["epoch"], ["odds", "amount"], stored)
    assert same(got, carry_forward(df, ["market_id", "runner_id"], "epoch", ["odds", "amount"]))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_ranks_without_one_task(spark, many_parts):
    df = spark.range(5000).select((F.col("id") * 7919 % 1009).alias("v")).unionByName(spark.createDataFrame([(None,), (None,)], "v long"))
    ranked = with_rank_key(df, "v", "id")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    want = df.distinct().select("v", F.dense_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).cast("long").alias("id"))
    assert same(ranked, want) and ranked.count() == 1010
    numbered = global_row_number(df.limit(0), [F.col("v")], "n", stored)
    assert numbered.columns == ["v", "n"] and numbered.collect() == []


def test_interval_join_makes_no_pair_in_vain(spark):
    points = spark.range(300).select((F.col("id") % 3).alias("ev"), (F.col("id") % 20).cast("int").alias("minute"), "id")
    goals = spark.createDataFrame([(0, 4), (1, 17), (1, 3), (2, None), (9, 1)], "ev long, goal int")
    got = interval_join(points, goals, ["ev"], "minute", F.col("goal") + 2, F.col("goal") + 5)
    want = points.alias("p").join(goals.alias("g"), F.expr("p.ev = g.ev and p.minute between g.goal + 2 and g.goal + 5"))
    assert same(got.select("id", "goal"), want.select("p.id", "g.goal"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Join.*(<=|>=)", plan), plan


def test_first_goal_fact_reads_its_market_types_only(spark, raw):
    m, r, changes = clean.market_state(raw), clean.runners(raw, with_epoch=True), clean.runner_changes(raw)
    dr = stored(present.dim_runner(r, clean.market_runners(raw, with_epoch=True), m, clean.market_types(raw), clean.event_dim(raw), changes))
    fact, fg, name = present.fact_runner_odds(changes, m, dr, store=stored), stored(present.dim_first_goal(m, r)), "default.t_pruned_fact"
    others = fact.withColumn("market_type_id", F.lit(-5).cast("long")).unionByName(fact.withColumn("market_type_id", F.lit(-6).cast("long")))
    drop_table(spark, name)
    save_table(spark, fact.unionByName(others), name, partition_by=present.FACT_PARTITION)
    try:
        pruned = present.first_goal_fact(dr, spark.table(name), fg, present.MATCH_ODDS_TYPES)
        assert same(pruned, present.first_goal_fact(dr, fact, fg, present.MATCH_ODDS_TYPES)) and pruned.count() == 1
        execution = pruned._jdf.queryExecution()
        pruned.collect()
        plan = execution.executedPlan().toString()
        assert "dynamicpruning" in plan, plan
        types = [x[0] for x in dr.where(F.col("market_name").isin(*present.MATCH_ODDS_TYPES)).select("market_type_id").distinct().collect()]
        wanted = spark.table(name).where(F.col("market_type_id").isin(types)).select(F.input_file_name()).distinct().count()
        every = spark.table(name).select(F.input_file_name()).distinct().count()
        read = files_read(execution.executedPlan(), "t_pruned_fact")
        assert read == wanted < every, (read, wanted, every)
        fact_table = [(f"default.{n}", d) for n, d in (("t_p_dim", dr), ("t_p_goal", fg))]
        for n, d in fact_table:
            drop_table(spark, n)
            save_table(spark, d, n)
        text = present.first_goal_fact_sql(spark, "default.t_p_dim", name, "default.t_p_goal", present.MATCH_ODDS_TYPES)
        assert same(text, pruned) and "dynamicpruning" in text._jdf.queryExecution().executedPlan().toString()
        for n, _ in fact_table:
            drop_table(spark, n)
    finally:
        drop_table(spark, name)


def files_read(plan, table):
    """Files that the scans of a table have read, by the plan's own metrics."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return files_read(plan.executedPlan(), table)
    if plan.nodeName().startswith("Scan") and table in plan.nodeName():
        return plan.metrics().apply("numFiles").value()
    below = plan.children() if "QueryStage" not in plan.getClass().getSimpleName() else None
    if below is None:
        return files_read(plan.plan(), table)
    return sum(files_read(below.apply(k), table) for k in range(below.size()))
