"""A market holding a third of all changes: AQE splits the hot join partition."""

from pyspark.sql import functions as F

from oddsflow.operators.latest import asof_before


def test_hot_market_join_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",      # force a shuffle join
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300_000
        changes = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("market_id"),
            (F.col("id") % 7).alias("runner_id"),
            F.col("id").alias("t"),
            (F.col("id") * 1.5).alias("odds"))
        markets = spark.range(5001).select(F.col("id").alias("market_id"), F.lit(n // 2).alias("ko"))
        out = asof_before(changes, markets, ["market_id"], "t", "ko", ["market_id", "runner_id"], ["odds"])
        rows = {(r["market_id"], r["runner_id"]): r["odds"] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "SortMergeJoin(skew=true)" in plan, plan[:3000]
        # the hot market's answer is the last change before the cut-off
        hot_last = max(i for i in range(0, n // 2, 3) if i % 7 == 1)
        assert rows[(0, 1)] == hot_last * 1.5
        salted = asof_before(changes, markets, ["market_id"], "t", "ko", ["market_id", "runner_id"], ["odds"], salt=4)
        assert {(r["market_id"], r["runner_id"]): r["odds"] for r in salted.collect()} == rows
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _fact_input(spark, n, hot):
    """Changes of which every `hot`-th is of market 0, their markets and runners."""
    changes = spark.range(n).select(
        F.when(F.col("id") % hot == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("market_id"), (F.col("id") % 7).alias("runner_id"),
        F.col("id").alias("epoch"), F.timestamp_millis("id").cast("timestamp_ntz").alias("timestamp"), F.lit(0.0).alias("hc"),
        F.lit(None).cast("double").alias("ltp"), (F.col("id") * 2.0).alias("tv"), F.lit("b").alias("type"),
        (F.col("id") % 3).cast("int").alias("position"), (F.col("id") % 11 + 1.5).alias("odds"), F.lit(2.0).alias("amount"))
    markets = spark.range(51).select(F.col("id").alias("market_id"), F.timestamp_millis(F.lit(n // 2)).cast("timestamp_ntz").alias("kick_off"))
    runners = spark.range(51 * 6).select(F.col("id"), (F.col("id") % 51).alias("market_id"), F.expr("id div 51").alias("runner_id"), (F.col("id") % 51 % 5).alias("market_type_id"))
    return changes, markets, runners


def test_changes_that_lie_by_market_are_not_dealt_again(spark):
    """q_runner_odds_fact, q_first_goal_pruned: the fact takes the changes as the join to their market left them."""
    from oddsflow.plans import present
    from oddsflow.session import conf_set
    from oddsflow.sinks.tables import stored

    changes, markets, runners = _fact_input(spark, 3000, 3)
    plans, key = [], "spark.sql.requireAllClusterKeysForCoPartition"

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        before = spark.conf.get(key)
        fact = present.fact_runner_odds(changes, markets, stored(runners), store=store)
        assert spark.conf.get(key) == before
        dealt = [line for line in plans[0].splitlines() if "Exchange hashpartitioning(" in line]
        assert len(dealt) == 3 and not any("runner_id" in line.split("ENSURE")[0] for line in dealt), dealt
        want = present.fact_runner_odds(changes, markets, runners)
        assert fact.exceptAll(want).isEmpty() and want.exceptAll(fact).isEmpty() and fact.count() == len([i for i in range(3000) if i % 7 < 6])


def test_hot_market_of_the_fact_is_split(spark):
    from oddsflow.plans import present
    from oddsflow.session import conf_set
    from oddsflow.sinks.tables import stored

    changes, markets, runners = _fact_input(spark, 200_000, 2)
    plans = []

    def store(df):
        out = df.where("runner_id >= 0")
        out.collect()
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    with conf_set(spark, {
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        fact = present.fact_runner_odds(stored(changes), markets, stored(runners), store=store)
        assert "skew=true" in plans[0], plans[0][:3000]
        assert fact.count() == len([i for i in range(200_000) if i % 7 < 6])


def test_market_types_are_not_dealt_by_type(spark, raw):
    """q_range_median: joined by their type, all markets would lie in as many tasks as there are types."""
    from oddsflow.plans import clean, present
    from oddsflow.session import conf_set

    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        market = clean.market_state(raw)
        dr = present.dim_runner(clean.runners(raw), clean.market_runners(raw), market, clean.market_types(raw), clean.event_dim(raw), clean.runner_changes(raw))
        plan = dr._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [market_type#" not in plan and "BroadcastHashJoin [market_type#" in plan, plan
        assert dr.count() > 0


def _counted(spark, changes, runners):
    """The runners with the number of their changes, as dim_runner(with_count=True) has it."""
    from oddsflow.plans import present

    return runners.join(changes.groupBy("market_id", "runner_id").agg(F.count(F.lit(1)).alias(present.N_CHANGES)), ["market_id", "runner_id"])


def test_short_series_are_filled_where_the_joins_left_them(spark):
    """q_first_goal_pruned: the fact's rows are neither dealt by range nor stored before the table is written."""
    from oddsflow.plans import present
    from oddsflow.session import conf_set
    from oddsflow.sinks.tables import stored

    changes, markets, runners = _fact_input(spark, 3000, 3)
    plans = []

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        fact = present.fact_runner_odds(changes, markets, stored(_counted(spark, changes, runners)), store=store)
        dealt = [line for line in plans[0].splitlines() if "Exchange " in line]
        assert len(plans) == 1 and len(dealt) == 3 and all("hashpartitioning(market_id" in x for x in dealt), dealt
        assert not any("runner_id" in line.split("ENSURE")[0] for line in dealt), dealt
        want = present.fact_runner_odds(changes, markets, runners)
        assert fact.columns == want.columns and fact.exceptAll(want).isEmpty() and want.exceptAll(fact).isEmpty() and not want.isEmpty()


def test_long_series_are_still_scanned_by_ranges(spark):
    from oddsflow.plans import present
    from oddsflow.sinks.tables import stored

    changes, markets, runners = _fact_input(spark, 3000, 3)  # market 0: over 100 changes a runner; others: 10 at most
    changes = changes.withColumn("odds", F.when(F.col("epoch") % 5 == 0, F.col("odds")))
    dim, plans = stored(_counted(spark, changes, runners)), []

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    short, long = present.fact_runner_odds_parts(changes, markets, dim, (), store, long_series=50)
    assert len(plans) == 1 and "rangepartitioning(" in plans[0]
    assert {r[0] for r in long.select("market_id").distinct().collect()} == {0} and short.where("market_id = 0").isEmpty()
    both = present.fact_runner_odds(changes, markets, dim, store=stored, long_series=50)
    want = present.fact_runner_odds(changes, markets, runners)
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty() and short.count() + long.count() == want.count()
    none, every = present.fact_runner_odds_parts(changes, markets, stored(runners), (), store)  # nothing is known of their length
    assert none is None and every.exceptAll(want).isEmpty() and every.count() == want.count()


def test_dimension_counts_the_changes_and_its_figures_lie_by_market(spark, raw):
    from oddsflow.plans import clean, present
    from oddsflow.session import conf_set

    market, changes = clean.market_state(raw), clean.runner_changes(raw)
    with conf_set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", **present.PARTITIONED_BY_MARKET}):
        args = clean.runners(raw), clean.market_runners(raw), market, clean.market_types(raw), clean.event_dim(raw), changes
        dr = present.dim_runner(*args, with_count=True)
        want = changes.groupBy("market_id", "runner_id").count()
        got = dr.join(want, ["market_id", "runner_id"]).select(present.N_CHANGES, "count").collect()
        assert got and len(got) == dr.count() and all(a == b for a, b in got)
        assert present.dim_runner(*args).columns == dr.columns[:-1] and dr.columns[-1] == present.N_CHANGES
        plan = dr._jdf.queryExecution().executedPlan().toString()
        figures = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "pre_ko_traded_volume" in x]
        assert not figures, figures


def test_partitioned_table_is_written_without_sorting_its_rows(spark):
    """q_first_goal_pruned: a task writes the few market types side by side."""
    from oddsflow.sinks.tables import OPEN_FILES, drop_table, save_table

    name, before = "default.t_open_files", spark.conf.get(OPEN_FILES, None)
    drop_table(spark, name)
    try:
        for start in (0, 900):  # made, then appended to
            save_table(spark, spark.range(start, start + 900, 1, 2).select("id", (F.col("id") % 30).alias("kind")), name, partition_by=["kind"])
        assert spark.conf.get(OPEN_FILES, None) == before
        assert [(r[0], r[1]) for r in spark.table(name).groupBy("kind").count().orderBy("kind").collect()] == [(k, 60) for k in range(30)]
        seen = []
        from oddsflow.sinks import tables
        real, tables.conf_set = tables.conf_set, lambda s, values: (seen.append(values), real(s, values))[1]
        try:
            save_table(spark, spark.range(3).withColumn("kind", F.lit(1).cast("long")), name, partition_by=["kind"])
        finally:
            tables.conf_set = real
        assert seen == [{OPEN_FILES: tables.PARTITION_FILES}]
    finally:
        drop_table(spark, name)
