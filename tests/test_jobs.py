"""The table-to-table jobs on the bz2 feed fixture."""

import os

from pyspark.sql import functions as F

from oddsflow import jobs
from oddsflow.sources.feed import lineage_counts


def test_jobs_end_to_end(spark, feed_dir):
    ns = "oddsflow_jobs"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    raw = jobs.load_raw(spark, feed_dir, ns)
    assert raw.count() == 20
    # a second load of the same files adds nothing (no silent duplicates)
    assert jobs.load_raw(spark, os.path.join(feed_dir, "2025"), ns).count() == 20

    jobs.rewrite_sorted_table(spark, f"{ns}.raw")
    assert spark.read.table(f"{ns}.raw").count() == 20

    written = jobs.build_clean(spark, ns)
    t = lambda n: spark.read.table(f"{ns}.{n}")
    assert all(t(n).count() == rows for n, rows in written.items()) and t("market_definition").count() > 0
    assert t("market").count() == 5 and t("runner").count() == 11 and t("market_type").count() == 5
    stats = t("match_statistics").collect()
    assert len(stats) == 1 and stats[0]["total_goals"] == 3 and stats[0]["first_goal_minute"] == 25

    jobs.build_clean(spark, ns)          # re-run replaces, never duplicates
    assert t("market").count() == 5

    jobs.build_presentation(spark, ns)
    assert t("dim_date").count() == 1 and t("dim_time").count() == 1440
    assert t("dim_runner").count() == 3
    home = t("fact_first_goal_match_odds").where(F.col("runner_id") == 11).collect()
    assert len(home) == 1 and abs(home[0]["first_odds"] - 1.475) < 1e-12
    jobs.rewrite_sorted_table(spark, f"{ns}.fact_runner_odds")
    assert t("fact_runner_odds").count() > 0
    spark.catalog.setCurrentDatabase("default")


def test_load_raw_lineage(spark, feed_dir):
    ns = "oddsflow_jobs_lin"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    raw = jobs.load_raw(spark, os.path.join(feed_dir, "2025"), ns)
    assert raw.count() == 20 and spark.read.table(f"{ns}.raw_lineage").count() == 20
    jobs.load_raw(spark, feed_dir, ns)   # a copy that arrives later adds no change, but its file
    assert spark.read.table(f"{ns}.raw").count() == 20
    lin = spark.read.table(f"{ns}.raw_lineage")
    assert lin.count() == 21
    jobs.load_raw(spark, feed_dir, ns)
    assert spark.read.table(f"{ns}.raw").count() == 20 and spark.read.table(f"{ns}.raw_lineage").count() == 21
    jobs.build_clean(spark, ns)
    market = spark.read.table(f"{ns}.market")
    assert market.count() == 5 and "change_key" in market.columns
    linked = market.join(lin.withColumnRenamed("file", "f"), "change_key")
    assert linked.count() >= 5
    assert lineage_counts(lin).where("n_files = 2").count() == 1
    spark.catalog.setCurrentDatabase("default")


def test_legacy_views(spark, feed_dir):
    from oddsflow.plans.legacy import legacy_market, legacy_runner

    ns = "oddsflow_jobs_legacy"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    jobs.load_raw(spark, feed_dir, ns)
    jobs.build_clean(spark, ns)
    mv = spark.read.table(f"{ns}.market_v1")
    assert mv.columns == ["id", "type_id", "event_id", "kick_off", "settled_time", "scheduled_time"]
    assert mv.count() == 5 and mv.where("type_id IS NULL").count() == 0
    rv = spark.read.table(f"{ns}.runner_v1")
    assert rv.columns == ["id", "name"] and rv.count() == 11
    t = lambda n: spark.read.table(f"{ns}.{n}")
    assert sorted(legacy_market(t("market"), t("market_type")).collect()) == sorted(mv.collect())
    assert sorted(legacy_runner(t("runner")).collect()) == sorted(rv.collect())
    spark.catalog.setCurrentDatabase("default")


def test_first_goal_fact_sql_equals_dataframe_form(spark, feed_dir):
    from oddsflow.plans import present

    ns = "oddsflow_jobs_sql"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    jobs.load_raw(spark, feed_dir, ns)
    jobs.build_clean(spark, ns)
    jobs.build_presentation(spark, ns)
    t = lambda n: spark.read.table(f"{ns}.{n}")
    for types, stat in ((present.MATCH_ODDS_TYPES, "avg"), (("MATCH_ODDS",), "median")):
        via_sql = present.first_goal_fact_sql(spark, f"{ns}.dim_runner", f"{ns}.fact_runner_odds",
                                              f"{ns}.dim_first_goal", types, stat)
        via_df = present.first_goal_fact(t("dim_runner"), t("fact_runner_odds"), t("dim_first_goal"), types, stat)
        assert via_sql.columns == via_df.columns
        assert sorted(via_sql.collect()) == sorted(via_df.collect()) and via_df.count() == 1
    spark.catalog.setCurrentDatabase("default")


def test_bucketed_tables_join_without_shuffle(spark, feed_dir):
    ns = "oddsflow_jobs_bucket"
    spark.sql(f"DROP DATABASE IF EXISTS {ns} CASCADE")
    jobs.load_raw(spark, feed_dir, ns)
    jobs.build_clean(spark, ns, buckets=4)
    jobs.build_presentation(spark, ns, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rc, dr = spark.read.table(f"{ns}.runner_change"), spark.read.table(f"{ns}.dim_runner")
        j = rc.join(dr.select("market_id", "runner_id", "id"), ["market_id", "runner_id"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert j.count() == rc.where(F.col("runner_id").isin(11, 12, 13) & (F.col("market_id") == "1.1")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.setCurrentDatabase("default")
