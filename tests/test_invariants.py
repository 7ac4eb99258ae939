"""SURVEY §5 invariants on the derived feed (sf0.001): one row per key, key round trips."""

import os

import pytest
from pyspark.sql import functions as F

from oddsflow import queries as Q
from oddsflow import standins as S
from oddsflow.functions.time import calendar_dim
from oddsflow.plans import clean, present

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="driver test data not present")


def _dupes(df, keys):
    return df.groupBy(*keys).count().where(F.col("count") > 1).count()


def test_one_row_per_key(spark):
    raw = Q._raw(spark, D)
    market, runner, price = clean.market_state(raw), clean.runners(raw), clean.prices(raw, since=None)
    assert _dupes(market, ["market_id"]) == 0
    assert _dupes(runner, ["market_id", "market_name", "runner_id", "runner_name"]) == 0
    assert _dupes(clean.event_dim(raw), ["id"]) == 0
    assert _dupes(clean.market_runners(raw), ["market_id", "runner_id", "sort_priority"]) == 0
    assert _dupes(clean.market_types(raw), ["type"]) == 0
    stats = clean.match_statistics(market, runner, price)
    assert _dupes(stats, ["event_id", "match_odds_market_id"]) == 0
    m, r, chg, dr = Q._star(spark, D)
    assert _dupes(dr, ["market_id", "runner_id"]) == 0 and _dupes(dr, ["id"]) == 0
    assert _dupes(clean.first_goal_minutes(m, r), ["event_id"]) == 0
    fact = present.fact_runner_odds(chg, m, dr)
    assert _dupes(fact, ["market_id", "runner_id", "epoch", "hc", "ltp", "tv", "type"]) == 0
    assert fact.count() == fact.select("market_id", "runner_id", "epoch", "hc", "ltp", "tv", "type").distinct().count()


def test_date_key_round_trips(spark):
    cal = calendar_dim(spark)
    back = cal.where(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd") != F.col("date"))
    assert back.count() == 0
    assert cal.select(F.min("date_key"), F.max("date_key")).collect()[0] == (20150101, 20300101)


def test_raw_changes_are_distinct_with_sorted_lineage(spark):
    # one raw row per distinct change, each with a non-empty sorted file list
    raw = Q._raw(spark, D)
    bad = raw.where((F.size("source_file_names") < 1)
                    | (F.col("source_file_names") != F.array_sort("source_file_names")))
    assert bad.count() == 0
    assert raw.count() == S.feed_changes(spark, D).select("pt", "mc").distinct().count()
