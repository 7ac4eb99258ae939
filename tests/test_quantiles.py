"""Sketches of parts, merged, against exact ranks."""

import bisect
import random

from pyspark.sql import functions as F

from oddsflow.operators.quantiles import merge_quantile_states, quantile, quantile_states, rank_error
from oddsflow.plans import clean, present
from oddsflow.sinks.tables import stored


def test_merged_sketches_stay_within_their_error(spark):
    rng = random.Random(4)
    rows = [("hot", rng.lognormvariate(0, 2)) for _ in range(40_000)] + [("tied", float(rng.randrange(5))) for _ in range(9_000)] + [("few", float(k)) for k in range(7)]
    rows += [("none", None), (None, 2.5), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("part", F.pmod(F.xxhash64("k", "v"), F.lit(5)))
    states = stored(quantile_states(df, ["part", "k"], ["v"], k=200)).drop("part")
    asked = [0.01, 0.25, 0.5, 0.9, 0.999]
    got = merge_quantile_states(states, ["k"], ["v"]).select("k", *[quantile("v", q).alias(str(q)) for q in asked])
    for r in got.collect():
        values = sorted(v for k, v in rows if k == r.k and v is not None)
        for q in asked:
            if not values:
                assert r[str(q)] is None
                continue
            lo, hi = bisect.bisect_left(values, r[str(q)]), bisect.bisect_right(values, r[str(q)])
            assert (lo - 1) / len(values) <= q + rank_error(200) and (hi + 1) / len(values) >= q - rank_error(200), (r.k, q)
    assert {r.k for r in got.collect()} == {"hot", "tied", "few", "none", None}


def test_first_goal_medians_of_loads(spark, raw):
    m, r, changes = clean.market_state(raw), clean.runners(raw, with_epoch=True), clean.runner_changes(raw)
    dr = stored(present.dim_runner(r, clean.market_runners(raw, with_epoch=True), m, clean.market_types(raw), clean.event_dim(raw), changes))
    fact, fg = stored(present.fact_runner_odds(changes, m, dr)), present.dim_first_goal(m, r)
    parts = [present.first_goal_states(dr, fact.where(f"pmod(xxhash64(epoch), 2) = {k}"), fg, ("MATCH_ODDS",)) for k in (0, 1)]
    got = present.first_goal_from_states(dr, parts[0].unionByName(parts[1]))
    want = present.first_goal_fact(dr, fact, fg, ("MATCH_ODDS",), stat="median")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and got.count() == 1
