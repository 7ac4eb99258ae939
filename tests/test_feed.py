"""Feed -> raw -> clean -> presentation on the hand-made bz2 feed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oddsflow.plans import clean, present
from oddsflow.sinks.tables import stored
from tests.feed_fixture import EVENT_ID, MIN, T0


def ts(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None)


def test_read_feed_skips_per_market_files(spark, feed_dir):
    from oddsflow.sources.feed import read_feed

    files = {r[0].rsplit("/", 2)[-2] + "/" + r[0].rsplit("/", 1)[-1]
             for r in read_feed(spark, feed_dir).select("source_file_name").distinct().collect()}
    assert files == {"3/29301.bz2", "copies/29301.bz2"}


def test_ingest_dedupes_and_keeps_lineage(raw):
    assert raw.count() == 20
    rows = raw.where(F.size("source_file_names") == 2).collect()
    assert len(rows) == 1
    assert rows[0]["pt"] == T0 - 10 * MIN
    assert rows[0]["source_file_names"] == sorted(rows[0]["source_file_names"])
    assert raw.where(F.col("mc.id") == "9.9").count() == 0


def test_market_state(raw):
    m = {r["market_id"]: r for r in clean.market_state(raw).collect()}
    assert set(m) == {"1.1", "1.2", "1.3", "1.4", "1.5"}
    mo = m["1.1"]
    assert mo["market_type"] == "MATCH_ODDS" and mo["event_id"] == int(EVENT_ID)
    assert mo["kick_off"] == ts(T0)
    assert mo["settled_time"] == ts(T0 + 110 * MIN)
    assert mo["scheduled_time"] == ts(T0)
    assert m["1.2"]["settled_time"] == ts(T0 + 25 * MIN)
    assert len(mo["source_file_names"]) == 1


def test_event_dim_and_history(raw):
    e = clean.event_dim(raw).collect()
    assert [(r["id"], r["name"], r["country_code"], r["regulators"]) for r in e] == \
        [(int(EVENT_ID), "Home v Away", "GB", ["MR_INT"])]
    h = clean.event_history(raw).collect()
    assert len(h) == 1 and h[0]["since"] == ts(T0 - 60 * MIN)


def test_market_changes_and_types(raw):
    mc = clean.market_changes(raw)
    assert mc.count() == 5 + 5 + 1 + 4
    assert {"bet_delay", "base_rate", "in_play", "open_date"} <= set(mc.columns)
    types = clean.market_types(raw)
    assert types.count() == 5
    again = clean.market_types(raw.repartition(7))
    assert sorted(types.collect()) == sorted(again.collect())
    ranked = {r["type"]: r["id"] for r in clean.market_types(raw, key="rank").collect()}
    assert ranked["CORRECT_SCORE"] == 1 and ranked["OVER_UNDER_25"] == 5


def test_runners_and_bridge(raw):
    r = {(x["market_id"], x["runner_id"]): x for x in clean.runners(raw).collect()}
    assert len(r) == 11
    assert r[("1.2", 22)]["status"] == "WINNER" and r[("1.1", 12)]["status"] == "LOSER"
    assert r[("1.1", 13)]["sort_priority"] == 3
    b = {(x["market_id"], x["runner_id"]): x["winner"] for x in clean.market_runners(raw).collect()}
    assert len(b) == 11 and b[("1.1", 11)] and not b[("1.1", 12)]


def test_runner_changes_and_prices(raw):
    rc = clean.runner_changes(raw)
    # 11: 3 back + 1 lay, 12: 2 back, 13: 2 back + 1 lay, then 1 + 3 single-level changes
    assert rc.count() == 4 + 2 + 3 + 1 + 3
    lay13 = rc.where((F.col("runner_id") == 13) & (F.col("type") == "l")).collect()
    assert lay13[0]["odds"] == 3.6 and lay13[0]["amount"] is None
    p = clean.prices(raw)
    assert p.count() == rc.count()
    assert clean.prices(raw, since="2026-01-01").count() == 0


def _clean_tables(raw):
    return clean.market_state(raw), clean.runners(raw), clean.prices(raw)


def test_match_statistics(raw):
    m, r, p = _clean_tables(raw)
    rows = clean.match_statistics(m, r, p).collect()
    assert len(rows) == 1
    s = rows[0]
    assert s["event_id"] == int(EVENT_ID) and s["match_odds_market_id"] == "1.1"
    assert (s["home_runner_id"], s["away_runner_id"], s["draw_runner_id"]) == (11, 12, 13)
    assert (s["pre_ko_odds_home"], s["pre_ko_odds_away"], s["pre_ko_odds_draw"]) == (1.98, 3.9, 3.45)
    assert (s["pre_ko_volume_home"], s["pre_ko_volume_away"], s["pre_ko_volume_draw"]) == (1000.0, 400.0, 300.0)
    assert s["first_goal_minute"] == 25
    assert (s["final_score_home"], s["final_score_away"]) == (2, 1)
    assert s["total_goals"] == 3 and s["match_result"] == "HOME"


def _presentation(raw):
    m, r, _ = _clean_tables(raw)
    changes = clean.runner_changes(raw)
    dr = present.dim_runner(r, clean.market_runners(raw), m, clean.market_types(raw), clean.event_dim(raw), changes)
    fact = present.fact_runner_odds(changes, m, dr)
    return m, r, dr, fact


def test_dim_runner(raw):
    _, _, dr, _ = _presentation(raw)
    rows = {x["runner_id"]: x for x in dr.collect()}
    assert set(rows) == {11, 12, 13}
    home = rows[11]
    assert home["pre_ko_traded_volume"] == 1100.0 and home["total_traded_volume"] == 2031.0
    assert home["ko_odds"] == 1.99 and home["favourite"]
    assert not rows[12]["favourite"] and not rows[13]["favourite"]
    assert home["kick_off_date_key"] == 20250301 and home["kick_off_time_key"] == 1400
    assert home["market_name"] == "MATCH_ODDS" and home["event_name"] == "Home v Away"
    assert len({x["id"] for x in rows.values()}) == 3


@pytest.mark.parametrize("store", [None, stored])
def test_fact_runner_odds_carries_forward(raw, store):
    m, r, _ = _clean_tables(raw)
    changes = clean.runner_changes(raw)
    dr = present.dim_runner(r, clean.market_runners(raw), m, clean.market_types(raw), clean.event_dim(raw), changes)
    fact = present.fact_runner_odds(changes, m, dr, store=store)
    home = fact.where((F.col("runner_id") == 11) & (F.col("type") == "b")).orderBy("epoch").collect()
    assert [x["minute"] for x in home] == [-10, 0, 27, 29, 31]
    assert [x["first_odds"] for x in home] == [2.0, 2.0, 1.5, 1.45, 1.4]
    assert [x["second_odds"] for x in home] == [1.98, 1.99, 1.99, 1.99, 1.99]
    assert [x["third_odds"] for x in home] == [1.96] * 5


def test_first_goal_facts(raw):
    m, r, dr, fact = _presentation(raw)
    fg = present.dim_first_goal(m, r)
    assert [(x["event_id"], x["first_goal_minute"]) for x in fg.collect()] == [(int(EVENT_ID), 25)]
    mo = present.first_goal_fact(dr, fact, fg, present.MATCH_ODDS_TYPES, stat="avg").collect()
    assert len(mo) == 1
    assert mo[0]["runner_id"] == 11 and abs(mo[0]["first_odds"] - 1.475) < 1e-12
    assert mo[0]["second_odds"] == 1.99 and mo[0]["timestamp"] == dt.date(2025, 3, 1)
    med = present.first_goal_fact(dr, fact, fg, ("MATCH_ODDS",), stat="median").collect()
    assert med[0]["first_odds"] == 1.45
    assert present.first_goal_fact(dr, fact, fg, present.OVER_UNDER_TYPES, stat="median").count() == 0


def test_flattened_definitions(raw):
    d = clean.flattened_definitions(raw)
    assert d.count() == 15 and {"id", "pt", "marketType", "runners"} <= set(d.columns)


def test_ingest_counted_matches_array_lineage(spark, feed_dir, raw):
    from oddsflow.sources.feed import ingest_counted, read_feed

    counted, lineage = ingest_counted(read_feed(spark, feed_dir))
    assert counted.count() == raw.count() == 20
    arr = {(r["pt"], r["mc"]["id"], len(r["source_file_names"]), r["source_file_names"][0])
           for r in raw.collect()}
    cnt = {(r["pt"], r["mc"]["id"], r["n_files"], r["first_file"]) for r in counted.collect()}
    assert arr == cnt
    assert lineage.count() == sum(len(r["source_file_names"]) for r in raw.collect())
    linked = counted.join(lineage, "change_key").groupBy("change_key").count()
    assert sorted(r["count"] for r in linked.collect()) == sorted(r["n_files"] for r in counted.collect())
