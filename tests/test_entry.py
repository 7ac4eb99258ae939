import importlib.util


def test_entry_runs_on_smoke_data(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 100 and len({r["match_odds_market_id"] for r in rows}) == len(rows)


def test_every_oracle_has_its_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    there = importlib.util.find_spec("oddsflow.llm")
    assert any(q.startswith("op") for q in e.queries()) == bool(there and there.origin)
