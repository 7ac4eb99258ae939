"""Operator tests on small hand-made frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from oddsflow.operators.diff import apply_diff, latest_batch, read_increment, snapshot_diff
from oddsflow.operators.joins import range_join, salted_join
from oddsflow.operators.keys import hash_key, with_hash_key, with_rank_key
from oddsflow.operators.ladder import carry_forward, explode_ladder, pivot_levels
from oddsflow.operators.latest import (any_true_by, asof_before, first_when, latest_state, latest_state_window,
                                       state_history, top1)
from oddsflow.operators.project import snake_case, snake_case_columns


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- WIN-2 / AG-3 / AG-4 / AG-6: latest state -------------------------------------------

def test_latest_state_keeps_nulls_of_the_latest_row(spark):
    df = spark.createDataFrame(
        [("m1", 1, 0, "a", 1.0), ("m1", 2, 0, None, 2.0), ("m2", 5, 0, "z", None), ("m2", 3, 0, "y", 9.0)],
        "id string, pt long, v long, name string, x double")
    out = latest_state(df, ["id"], "pt", ["name", "x"], tiebreak=["v"], extra_aggs=[F.max("pt").alias("last_pt")])
    assert rows(out) == [("m1", None, 2.0, 2), ("m2", "z", None, 5)]


def test_latest_state_tie_break_is_deterministic(spark):
    data = [("k", 10, i, f"v{i}") for i in range(50)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, pt long, seq long, v string")
    results = {rows(latest_state(df.repartition(n), ["k"], "pt", ["v"], tiebreak=["seq"]))[0] for n in (1, 7, 17)}
    assert results == {("k", "v49")}


def test_latest_state_window_form(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, pt long, v string")
    out = latest_state_window(df, ["k"], "pt", ["v"])
    assert rows(out, "k", "pt", "latest_v") == [("a", 1, "y"), ("a", 2, "y"), ("b", 1, "z")]


# --- WIN-1 / AG-2: state history ----------------------------------------------------------

def test_state_history_distinct_states_since(spark):
    df = spark.createDataFrame(
        [("e", 1, 1, "A"), ("e", 2, 1, "B"), ("e", 2, 2, "C"), ("e", 3, 1, "A"), ("f", 1, 1, "Q")],
        "k string, pt long, seq long, v string")
    out = state_history(df, ["k"], "pt", ["v"], tiebreak=["seq"])
    # at pt=2 two rows tie: the later one (seq 2, "C") is the state, as RANGE-frame last() sees it
    assert rows(out) == [("e", "A", 1), ("e", "C", 2), ("f", "Q", 1)]


# --- WIN-4 / CND-1: first when ------------------------------------------------------------

def test_first_when(spark):
    df = spark.createDataFrame([("m", 3, True), ("m", 1, False), ("m", 5, True), ("n", 1, None)],
                               "m string, pt long, in_play boolean")
    out = df.groupBy("m").agg(first_when(F.col("in_play") == True, "pt").alias("ko"))  # noqa: E712
    assert rows(out) == [("m", 3), ("n", None)]


# --- WIN-5 / AG-14: bool OR bridge --------------------------------------------------------

def test_any_true_by(spark):
    df = spark.createDataFrame([("m", 1, 1, "ACTIVE"), ("m", 1, 1, "WINNER"), ("m", 1, 2, "ACTIVE"),
                                ("m", 2, 1, "LOSER")], "m string, r long, sp long, status string")
    out = any_true_by(df, ["m", "r"], ["sp"], F.col("status") == "WINNER", "winner")
    assert rows(out, "m", "r", "sp", "winner") == [("m", 1, 1, True), ("m", 1, 2, True), ("m", 2, 1, False)]


# --- J-11 / J-12 / FLT-10 / FLT-11 / DT-6: as-of ------------------------------------------

def _ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def asof_frames(spark):
    changes = spark.createDataFrame([
        ("m", 1, _ts("2025-01-01 13:59:00"), 1, 2.0),
        ("m", 1, _ts("2025-01-01 13:59:30"), 1, 2.1),   # exactly 30 s before
        ("m", 1, _ts("2025-01-01 13:59:31"), 1, 2.2),   # 29 s before
        ("m", 1, _ts("2025-01-01 14:00:00"), 1, 2.3),   # at kick-off
        ("m", 2, _ts("2025-01-01 14:01:00"), 1, 9.0),   # only after kick-off
    ], "market_id string, runner_id long, ts timestamp, seq long, odds double")
    cut = spark.createDataFrame([("m", _ts("2025-01-01 14:00:00"), "ev")],
                                "market_id string, kick_off timestamp, event string")
    return changes, cut


def test_asof_before_strict(asof_frames):
    changes, cut = asof_frames
    out = asof_before(changes, cut, ["market_id"], "ts", "kick_off", ["market_id", "runner_id"], ["odds"],
                      tiebreak=["seq"], carry=["event"])
    assert rows(out, "market_id", "runner_id", "event", "odds") == [("m", 1, "ev", 2.2)]


def test_asof_before_lag_inclusive(asof_frames):
    changes, cut = asof_frames
    out = asof_before(changes, cut, ["market_id"], "ts", "kick_off", ["market_id", "runner_id"], ["odds"],
                      lag="30 SECOND", inclusive=True)
    assert rows(out, "runner_id", "odds") == [(1, 2.1)]


def test_asof_before_salted_equals_plain(asof_frames):
    changes, cut = asof_frames
    args = dict(on=["market_id"], time_col="ts", cutoff_col="kick_off", by=["market_id", "runner_id"],
                values=["odds"], tiebreak=["seq"])
    assert rows(asof_before(changes, cut, salt=5, **args)) == rows(asof_before(changes, cut, **args))


def test_salted_join_matches_plain_join(spark):
    big = spark.range(0, 2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    plain = rows(big.join(small, "k"))
    for n in (1, 4, 16):
        assert rows(salted_join(big, small, ["k"], salt=n, salt_cols=["v"])) == plain


# --- J-10 / FLT-12: range join ------------------------------------------------------------

def test_range_join_keeps_window(spark):
    fact = spark.createDataFrame([(1, m) for m in (26, 27, 28, 30, 31)] + [(2, 5)], "ev long, minute long")
    fg = spark.createDataFrame([(1, 25), (2, None)], "ev long, fg long")
    out = range_join(fact, fg, ["ev"], F.col("minute"), F.col("fg") + 2, F.col("fg") + 5)
    assert rows(out, "ev", "minute") == [(1, 27), (1, 28), (1, 30)]


# --- WIN-7 / WIN-8 / FLT-13 / SRT-2: top-1 ------------------------------------------------

def test_top1_flag_nulls_last(spark):
    df = spark.createDataFrame([("m", 1, None), ("m", 2, 3.0), ("m", 3, 2.5), ("n", 4, None)],
                               "m string, r long, ltp double")
    out = top1(df, ["m"], [F.col("ltp").asc_nulls_last(), F.col("r")], flag="fav")
    assert rows(out, "m", "r", "fav") == [("m", 1, False), ("m", 2, False), ("m", 3, True), ("n", 4, True)]
    only = top1(df, ["m"], [F.col("ltp").asc_nulls_last(), F.col("r")])
    assert rows(only, "m", "r") == [("m", 3), ("n", 4)]


# --- GEN-2 / ARR-1 / SET-1 / PRJ-9: ladder explode ----------------------------------------

def test_explode_ladder_null_side_and_short_entry(spark):
    df = spark.createDataFrame([
        ("r1", [[0.0, 2.0, 10.0], [1.0, 1.9]], None),
        ("r2", None, [[0.0, 3.0, 5.0]]),
        ("r3", None, None),
    ], "id string, batb array<array<double>>, batl array<array<double>>")
    out = explode_ladder(df, ["id"])
    assert rows(out, "id", "type", "position", "odds", "amount") == [
        ("r1", "b", 0, 2.0, 10.0), ("r1", "b", 1, 1.9, None), ("r2", "l", 0, 3.0, 5.0)]


# --- AG-7 / AG-8 / PRJ-5: pivot -----------------------------------------------------------

def test_pivot_levels(spark):
    df = spark.createDataFrame([
        ("k", 0, 2.0, 10.0, 2), ("k", 0, 1.5, 1.0, 1), ("k", 2, 3.0, 7.0, 1), ("k", 3, 9.0, 9.0, 1),
        ("j", 5, 1.0, 1.0, 1),
    ], "k string, pos int, odds double, amount double, seq long")
    out = pivot_levels(df, ["k"], "pos", ["odds", "amount"], tiebreak=["seq"])
    got = {r["k"]: r.asDict() for r in out.collect()}
    assert (got["k"]["first_odds"], got["k"]["first_amount"]) == (1.5, 1.0)
    assert got["k"]["second_odds"] is None and got["k"]["third_odds"] == 3.0
    assert all(got["j"][c] is None for c in got["j"] if c != "k")


# --- WIN-9: carry forward, bucketed == plain ----------------------------------------------

def test_carry_forward_bucketed_equals_plain(spark):
    rnd = random.Random(7)
    data = []
    for key in range(4):
        for t in range(200):
            v = rnd.random() if rnd.random() < 0.2 else None
            data.append((key % 2, f"s{key}", t, v))
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "m long, side string, epoch long, x double")
    plain = carry_forward(df, ["m", "side"], "epoch", ["x"])
    bucketed = carry_forward(df.repartition(5), ["m", "side"], "epoch", ["x"], bucket=F.floor(F.col("epoch") / 17))
    assert rows(plain) == rows(bucketed)
    # a value once seen never becomes NULL again
    w = Window.partitionBy("m", "side").orderBy("epoch")
    bad = plain.withColumn("prev", F.lag("x").over(w)).where(F.col("prev").isNotNull() & F.col("x").isNull())
    assert bad.count() == 0


# --- KEY-1: keys --------------------------------------------------------------------------

def test_keys_are_stable(spark):
    df = spark.createDataFrame([("A",), ("B",), ("A",), ("C",)], "type string")
    h1 = rows(with_hash_key(df.repartition(1), ["type"]))
    h2 = rows(with_hash_key(df.repartition(3), ["type"]))
    assert h1 == h2 and len(h1) == 3
    assert rows(with_rank_key(df, "type")) == [("A", 1), ("B", 2), ("C", 3)]
    assert df.select(hash_key(["type"])).distinct().count() == 3


# --- SRC-7 / SRC-8 / SRC-9: snapshots -----------------------------------------------------

def test_snapshot_diff_roundtrip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "id long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "C"), (4, "d")], "id long, v string")
    diff = snapshot_diff(old, new)
    assert rows(diff) == [(2, "b", "DELETE"), (3, "C", "INSERT"), (3, "c", "DELETE"), (4, "d", "INSERT")]
    assert rows(apply_diff(old, diff)) == rows(new)


def test_latest_batch_and_increment(spark):
    log = spark.createDataFrame([(1, _ts("2025-01-01 00:00:00")), (3, _ts("2025-01-03 00:00:00")),
                                 (2, _ts("2025-01-02 00:00:00"))], "batch_id long, committed_at timestamp")
    assert latest_batch(log).collect()[0][0] == 3
    data = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "batch_id long, v string")
    assert rows(read_increment(data, 1, 3), "v") == [("y",), ("z",)]


# --- PRJ-3: snake case --------------------------------------------------------------------

def test_snake_case(spark):
    assert snake_case("marketBaseRate") == "market_base_rate" and snake_case("inPlay") == "in_play"
    df = spark.createDataFrame([(1, 2)], "betDelay long, version long")
    assert snake_case_columns(df, {"version": "v"}).columns == ["bet_delay", "v"]
