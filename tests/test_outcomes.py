"""Match outcomes per event (P-11a-d) on small clean-layer frames."""

import datetime as dt

from oddsflow.plans import clean

KO = dt.datetime(2025, 1, 1, 15, 0)


def _frames(spark, markets, runners):
    m = spark.createDataFrame(
        [(mid, mtype, ev, KO if ko else None, KO + dt.timedelta(minutes=settle)) for mid, mtype, ev, ko, settle in markets],
        "market_id string, market_type string, event_id int, kick_off timestamp, settled_time timestamp")
    r = spark.createDataFrame(runners, "market_id string, runner_id long, runner_name string, status string")
    return m, r


def test_score_falls_back_to_second_correct_score_market(spark):
    m, r = _frames(spark, [
        ("a1", "CORRECT_SCORE", 1, True, 100), ("a2", "CORRECT_SCORE2", 1, True, 100),
        ("b2", "CORRECT_SCORE2", 2, True, 100),
        ("c1", "CORRECT_SCORE", 3, True, 100),
        ("d2", "CORRECT_SCORE2", 4, True, 100),
    ], [
        ("a1", 1, "Any Other Away Win", "WINNER"), ("a2", 7, "0 - 4", "WINNER"),
        ("b2", 8, "3 - 3", "WINNER"),
        ("c1", 9, "1 - 0", "WINNER"),
        ("d2", 5, "Any unquoted", "WINNER"),
    ])
    got = {x["event_id"]: (x["final_score_home"], x["final_score_away"], x["match_result"])
           for x in clean.event_outcomes(m, r).collect()}
    assert got[1] == (0, 4, "AWAY")          # label from CS, both scores from CS2
    assert got[2] == (3, 3, None)            # only CS2: scores, no result (as in the reference)
    assert got[3] == (1, 0, "HOME")
    assert got[4] == (None, None, None)      # "Any unquoted" is not a score


def test_first_goal_and_total_goals(spark):
    m, r = _frames(spark, [
        ("o05", "OVER_UNDER_05", 1, True, 37), ("o25", "OVER_UNDER_25", 1, True, 90),
        ("n05", "OVER_UNDER_05", 2, True, 90), ("p05", "OVER_UNDER_05", 3, False, 10),
    ], [
        ("o05", 1, "Under 0.5 Goals", "LOSER"), ("o05", 2, "Over 0.5 Goals", "WINNER"),
        ("o25", 3, "Under 2.5 Goals", "WINNER"), ("o25", 4, "Over 2.5 Goals", "LOSER"),
        ("n05", 5, "Under 0.5 Goals", "WINNER"), ("n05", 6, "Over 0.5 Goals", "LOSER"),
        ("p05", 7, "Over 0.5 Goals", "WINNER"),
    ])
    got = {x["event_id"]: (x["first_goal_minute"], x["total_goals"]) for x in clean.event_outcomes(m, r).collect()}
    assert got[1] == (37, 1)      # over 0.5 won, over 2.5 lost: one or two goals -> highest won 0 + 1
    assert got[2] == (None, 0)    # goalless: no over market won
    assert 3 not in got           # never kicked off
    fg = {x["event_id"]: x["first_goal_minute"] for x in clean.first_goal_minutes(m, r).collect()}
    assert fg == {1: 37, 2: None}
