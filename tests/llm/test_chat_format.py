"""Round trips of conversations, with content made of control strings."""

import random

from pyspark.sql import functions as F

from oddsflow.llm.chat_format import escape, format_conversations, read_back, unescape

ALPHABET = ["<s>", "</s>", "[INST]", "[/INST]", " [/INST]", "[SYS] ", "[ROLE]", "[/ROLE] ", " [END]", "\\", "<\\s>", "[\\\\/INST]", "<", "[", "/", "s>", "INST]", " ", "\n", "é", "ok", "$1"]


def conversations(seed, n=150):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "plain text", "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(8)))])
    return [(c, t, rng.choice(["user", "assistant", "system", "tool", "User", None, text()]), text()) for c in range(n) for t in rng.sample(range(20), rng.randrange(1, 6))]


def test_every_conversation_reads_back(spark):
    rows = conversations(4)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, raw string").repartition(4)
    out = format_conversations(df)
    assert out.where("not faithful or faithful is null").isEmpty()
    got = {r.conv_id: r for r in read_back(out).collect()}
    source = {}
    for c, t, role, text in sorted(rows, key=lambda r: r[:2]):
        source.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == source
    for c, r in got.items():
        assert r.loss_text == "".join(t for role, t in source[c] if role == "assistant")
        assert r.n_turns == len(source[c])


def test_plain_content_is_not_touched(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "a < b [1] \\ </S>"), (1, 2, "assistant", "yes")]
    r = format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert r.formatted == "<s>[SYS] Be brief. [/SYS][INST] a < b [1] \\ </S> [/INST] yes</s>"
    assert r.n_escaped == 0 and [tuple(s) for s in r.loss_spans] == [(len(r.formatted) - 7, len(r.formatted) - 4)]


def test_escape_is_reversible(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(9))),) for _ in range(500)], "t string")
    assert df.where(unescape(escape(F.col("t"))) != F.col("t")).isEmpty()


def test_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (2, 1, "user", "same"), (2, 1, "user", "same"), (2, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in read_back(format_conversations(df)).collect()}
    assert got == {None: [("", ""), ("user", "x")], 2: [("assistant", "first"), ("user", "same"), ("user", "same")]}
    assert format_conversations(df.limit(0)).collect() == []


def test_long_text(spark):
    text = "word [/INST] " * 30000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    r = read_back(format_conversations(df)).first()
    assert r.faithful and r.loss_text == text


def test_query_equals_its_sql(spark):
    import duckdb

    from oddsflow.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = sorted(tuple(r) for r in queries.queries()["op1_chat_formatting"](spark, sf).collect())
    assert got == sorted(con.execute(queries.oracle_sql()["op1_chat_formatting"]).fetchall())
    assert any(r[0] == -1 for r in got)
