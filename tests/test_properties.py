"""Operators against brute force in plain Python on random inputs (hypothesis)."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oddsflow.operators.diff import snapshot_diff
from oddsflow.operators.ladder import carry_forward, pivot_levels
from oddsflow.operators.latest import asof_before, latest_state

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 1000),
              st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1, max_size=60, unique_by=lambda r: r[2])


@SETTINGS
@given(rows_st)
def test_latest_state_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, seq int, v int")
    got = {r["k"]: r["v"] for r in latest_state(df.repartition(3), ["k"], "t", ["v"], tiebreak=["seq"]).collect()}
    best = {}
    for k, t, seq, v in rows:
        if k not in best or (t, seq) > best[k][0]:
            best[k] = ((t, seq), v)
    assert got == {k: v for k, (_, v) in best.items()}


@SETTINGS
@given(rows_st, st.dictionaries(st.integers(0, 3), st.integers(0, 20), min_size=1))
def test_asof_before_brute_force(spark, rows, cutoffs):
    df = spark.createDataFrame(rows, "k int, t int, seq int, v int")
    cut = spark.createDataFrame(list(cutoffs.items()), "k int, ko int")
    got = {r["k"]: r["v"] for r in asof_before(df, cut, ["k"], "t", "ko", ["k"], ["v"], tiebreak=["seq"],
                                               salt=3).collect()}
    best = {}
    for k, t, seq, v in rows:
        if k in cutoffs and t < cutoffs[k] and (k not in best or (t, seq) > best[k][0]):
            best[k] = ((t, seq), v)
    assert got == {k: v for k, (_, v) in best.items()}


@SETTINGS
@given(rows_st, st.integers(1, 7))
def test_carry_forward_brute_force(spark, rows, width):
    df = spark.createDataFrame(rows, "k int, t int, seq int, v int")
    out = carry_forward(df.repartition(4), ["k"], "t", ["v"], tiebreak=["seq"],
                        bucket=F.floor(F.col("t") / width))
    got = {(r["k"], r["seq"]): r["v"] for r in out.collect()}
    want, last = {}, {}
    for k, t, seq, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if v is not None:
            last[k] = v
        want[(k, seq)] = last.get(k)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 500),
                          st.floats(1, 10, allow_nan=False)), min_size=1, max_size=40, unique_by=lambda r: r[2]))
def test_pivot_levels_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, pos int, seq int, odds double")
    out = pivot_levels(df, ["k"], "pos", ["odds"], tiebreak=["seq"])
    got = {r["k"]: (r["first_odds"], r["second_odds"], r["third_odds"]) for r in out.collect()}
    pick = defaultdict(dict)
    for k, pos, seq, odds in rows:
        cur = pick[k].get(pos)
        if cur is None or seq < cur[0]:
            pick[k][pos] = (seq, odds)
    want = {k: tuple(lv[p][1] if p in lv else None for p in (0, 1, 2)) for k, lv in pick.items()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None])), max_size=30),
       st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None])), max_size=30))
def test_snapshot_diff_brute_force(spark, old, new):
    o = spark.createDataFrame(old, "id int, v string")
    n = spark.createDataFrame(new, "id int, v string")
    got = Counter((r["id"], r["v"], r["_change_type"]) for r in snapshot_diff(o, n).collect())
    co, cn = Counter(old), Counter(new)
    want = Counter()
    for row in set(co) | set(cn):
        d = cn[row] - co[row]
        if d:
            want[(*row, "INSERT" if d > 0 else "DELETE")] = abs(d)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(0, 300), st.sampled_from("ABC")),
                min_size=1, max_size=40, unique_by=lambda r: r[2]))
def test_state_history_brute_force(spark, rows):
    from oddsflow.operators.latest import state_history

    df = spark.createDataFrame(rows, "k int, t int, seq int, v string")
    got = {(r["k"], r["v"], r["since"]) for r in state_history(df, ["k"], "t", ["v"], tiebreak=["seq"]).collect()}
    # running last value over the default RANGE frame: peers at one t share the
    # state of the last of them; then the distinct states with the first t
    last_at = {}
    for k, t, seq, v in rows:
        if (k, t) not in last_at or seq > last_at[(k, t)][0]:
            last_at[(k, t)] = (seq, v)
    first = {}
    for (k, t), (_, v) in last_at.items():
        first[(k, v)] = min(first.get((k, v), t), t)
    assert got == {(k, v, t) for (k, v), t in first.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 2), st.booleans()), max_size=40))
def test_any_true_by_brute_force(spark, rows):
    from oddsflow.operators.latest import any_true_by

    df = spark.createDataFrame(rows, "m int, r int, sp int, won boolean")
    got = {(x["m"], x["r"], x["sp"], x["w"]) for x in any_true_by(df, ["m", "r"], ["sp"], F.col("won"), "w").collect()}
    anyw = defaultdict(bool)
    for m, r, sp, won in rows:
        anyw[(m, r)] |= won
    assert got == {(m, r, sp, anyw[(m, r)]) for m, r, sp, _ in rows}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 12)), max_size=50),
       st.dictionaries(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 6))), st.integers(1, 4))
def test_range_join_brute_force(spark, facts, goals, salt):
    from oddsflow.operators.joins import range_join

    f = spark.createDataFrame([(e, m, i) for i, (e, m) in enumerate(facts)], "ev int, minute int, i int")
    g = spark.createDataFrame(list(goals.items()), "ev int, fg int")
    out = range_join(f, g, ["ev"], F.col("minute"), F.col("fg") + 2, F.col("fg") + 5, salt=salt, salt_cols=["i"])
    got = sorted((r["ev"], r["minute"], r["i"]) for r in out.collect())
    want = sorted((e, m, i) for i, (e, m) in enumerate(facts)
                  if e in goals and goals[e] is not None and goals[e] + 2 <= m <= goals[e] + 5)
    assert got == want
