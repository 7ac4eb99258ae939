"""Cases that an earlier version got wrong: each states the rule and the smallest input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oddsflow.functions.time import minutes_between, minutes_for
from oddsflow.operators.diff import snapshot_diff
from oddsflow.operators.keys import hash_key
from oddsflow.operators.ladder import carry_forward, pivot_levels
from oddsflow.plans import clean, present
from oddsflow.sinks.tables import REPLACED, STAGED, recover_table, save_table
from oddsflow.sources.feed import FEED_SCHEMA, change_key, explode_changes, split_lineage, seen_changes


def test_minutes_are_cut_from_the_difference(spark):
    t = lambda s: dt.datetime.fromisoformat("2025-01-01 " + s)
    df = spark.createDataFrame([(t("10:01:30.000"), t("10:00:00.900")), (t("10:01:30.900"), t("10:00:00.900")), (t("10:00:00.900"), t("10:01:30.000"))], "b timestamp, a timestamp")
    assert [r[0] for r in df.select(minutes_between("b", "a")).collect()] == [1, 2, -1]


def test_pivot_keeps_pairs_on_ties_and_null_odds(spark):
    rows = [("k", 0, 2.0, 9.0), ("k", 0, 2.0, 5.0), ("k", 1, None, 4.0), ("k", 2, None, 1.0), ("k", 2, 3.0, 7.0)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, position int, odds double, amount double")
        r = pivot_levels(df, ["k"], "position", ["odds", "amount"], tiebreak=["odds", "amount"]).first()
        assert (r.first_odds, r.first_amount, r.second_odds, r.second_amount, r.third_odds, r.third_amount) == (2.0, 5.0, None, 4.0, 3.0, 7.0)


def test_keys_tell_nulls_and_fields_apart(spark):
    df = spark.createDataFrame([(None, 7), (7, None), (7, 7)], "a int, b int")
    assert df.select(hash_key(["a", "b"])).distinct().count() == 3
    ladder = [[0.0, 2.0, 5.0]]
    feed = [("mcm", "c", 1, [("1.1", None, [(ladder, None, None, 1, None, None, None)], None)]),
            ("mcm", "c", 1, [("1.1", None, [(None, ladder, None, 1, None, None, None)], None)]),
            ("mcm", "c", 1, [("1.1", None, [(None, None, None, 1, 3.0, None, None)], None)]),
            ("mcm", "c", 1, [("1.1", None, [(None, None, None, 1, None, None, 3.0)], None)])]
    changes = explode_changes(spark.createDataFrame(feed, FEED_SCHEMA).withColumn("f", F.lit("x")), "f")
    assert changes.select(change_key()).distinct().count() == 4


def _definition(pt, market="1.1", name="M", mtype="MATCH_ODDS", runners=(), **more):
    base = {"marketType": mtype, "name": name, "eventId": "5", "eventName": "E", "runners": [dict(zip(("id", "name", "sortPriority", "status"), r)) for r in runners], "version": pt}
    return {"op": "mcm", "clk": "c", "pt": pt, "mc": [{"id": market, "marketDefinition": {**base, **more}}]}


def _raw(spark, messages):
    feed = spark.createDataFrame([spark_row(m) for m in messages], FEED_SCHEMA).withColumn("f", F.lit("x"))
    return split_lineage(seen_changes(feed, "f"))[0]


def spark_row(message):
    import json

    return json.loads(json.dumps(message))


def test_unknown_status_is_no_winner_and_null_type_stays(spark):
    raw = _raw(spark, [_definition(1, mtype=None, runners=[(11, "A", 1, None)])])
    assert [r.winner for r in clean.market_runners(raw).collect()] == [False]
    assert [r.type for r in clean.market_types(raw).collect()] == [None]
    assert [r.type for r in clean.market_types(raw, key="rank").collect()] == [None]


def test_dimension_has_one_row_after_renames(spark):
    change = {"op": "mcm", "clk": "c", "pt": 5, "mc": [{"id": "1.1", "rc": [{"id": 11, "batb": [[0.0, 2.0, 5.0]], "ltp": 2.0, "tv": 9.0}]}]}
    raw = _raw(spark, [_definition(1, name="old", runners=[(11, "A", 2, "ACTIVE")], openDate="2025-01-01T10:00:00.000Z"),
                       _definition(3, name="new", runners=[(11, "Anna", 1, "WINNER")]),
                       _definition(20, name="new", runners=[(11, "Anna", 1, "WINNER")], inPlay=True), change])
    market, runner = clean.market_state(raw), clean.runners(raw, with_epoch=True)
    assert runner.count() == 2
    dr = present.dim_runner(runner, clean.market_runners(raw, with_epoch=True), market, clean.market_types(raw), clean.event_dim(raw), clean.runner_changes(raw))
    rows = dr.collect()
    assert [(r.name, r.sort_priority, r.winner) for r in rows] == [("Anna", 1, True)]


def test_earlier_years_are_kept(spark):
    old = 1_700_000_000_000
    raw = _raw(spark, [{"op": "mcm", "clk": "c", "pt": old, "mc": [{"id": "1.1", "rc": [{"id": 11, "batb": [[0.0, 2.0, 5.0]]}]}]}])
    assert clean.prices(raw).count() == 1 and clean.prices(raw, since="2025-01-01").count() == 0


def test_append_of_an_unknown_column_is_an_error(spark):
    name = "t_append_extra"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    save_table(spark, spark.range(3).toDF("a"), name)
    with pytest.raises(ValueError, match="extra"):
        save_table(spark, spark.range(3).selectExpr("id as a", "1 as extra"), name)
    assert spark.table(name).count() == 3


def test_failed_replace_keeps_the_table_and_every_cut_recovers(spark):
    name = "t_swap"
    for t in (name, name + STAGED, name + REPLACED):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    save_table(spark, spark.range(5).toDF("a"), name)
    with pytest.raises(Exception, match="stop"):
        save_table(spark, spark.range(5).select(F.raise_error(F.lit("stop")).alias("a")), name, "replace")
    assert spark.table(name).count() == 5
    recover_table(spark, name)
    save_table(spark, spark.table(name).where("a > 1"), name, "replace")  # reads the table it replaces
    assert spark.table(name).count() == 3
    # a stop after the write, after the first rename, and after the second
    spark.range(9).toDF("a").write.saveAsTable(name + STAGED)
    recover_table(spark, name)
    assert spark.table(name).count() == 3 and not spark.catalog.tableExists(name + STAGED)
    spark.range(9).toDF("a").write.saveAsTable(name + STAGED)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{REPLACED}")
    recover_table(spark, name)
    assert spark.table(name).count() == 3 and not spark.catalog.tableExists(name + REPLACED)
    spark.range(9).toDF("a").write.saveAsTable(name + STAGED)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{REPLACED}")
    spark.sql(f"ALTER TABLE {name}{STAGED} RENAME TO {name}")
    recover_table(spark, name)
    assert spark.table(name).count() == 9 and not spark.catalog.tableExists(name + REPLACED)


def test_carry_forward_shuffles_the_big_frame_once(spark):
    path = spark.range(1000).selectExpr("id % 3 as k", "id as t", "if(id % 5 = 0, id, null) as v")
    out = carry_forward(path, ["k"], "t", ["v"], bucket=F.floor(F.col("t") / 100))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "LogicalRDD" not in plan
    plain = carry_forward(path, ["k"], "t", ["v"])
    assert sorted(out.collect()) == sorted(plain.collect())


def test_many_copies_of_a_row(spark):
    one = spark.createDataFrame([(1,)], "a int")
    many = spark.range(200_000).selectExpr("1 as a")
    assert snapshot_diff(one, many).count() == 199_999


def test_minutes_cover_the_range(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 23, 58, 30),), (dt.datetime(2025, 1, 3, 0, 1, 59),)], "ts timestamp")
    got = [r.minute for r in minutes_for(df, "ts").orderBy("minute").collect()]
    assert got[0] == dt.datetime(2025, 1, 1, 23, 58) and got[-1] == dt.datetime(2025, 1, 3, 0, 1) and len(got) == len(set(got)) == 1444
