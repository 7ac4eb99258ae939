"""The model against a dictionary version of interpolated Kneser-Ney; held-out accuracy; edge cases."""

import collections
import math
import random

import numpy as np
import pyarrow as pa

from oddsflow.llm import queries
from oddsflow.llm.langid import BITS, ORDER, Model, fit, predict

WORDS = {"aa": ["kata", "kato", "pima", "sula"], "bb": ["tref", "strux", "gref", "blanx"], "cc": ["éloi", "ñaza", "ézé", "loñ"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(5, 60))).capitalize() + ".\n", lang))
    return rows


def pack(codes):
    out = 0
    for c in codes:
        out = out << BITS | c
    return out


def slow_probability(counts, gram, alphabet):
    """p of one language by the textbook recursion."""
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = collections.Counter(g[1:] for g in levels[n + 1])

    def p(g):
        if not g:
            return 1.0 / (alphabet + 3)
        own = levels[len(g)]
        once, twice = (sum(c == k for c in own.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.75
        total = sum(c for h, c in own.items() if h[:-1] == g[:-1])
        kinds = sum(1 for h in own if h[:-1] == g[:-1])
        if not total:
            return p(g[1:])
        return max(own.get(g, 0) - d, 0) / total + d * kinds / total * p(g[1:])

    return p(gram)


def test_probabilities_equal_the_recursion():
    rng = random.Random(3)
    langs = []
    for k in range(2):
        line = [1] * 3 + [rng.choice([1, 3, 4, 5, 6 + k]) for _ in range(120)]
        langs.append(collections.Counter(tuple(line[i:i + 4]) for i in range(len(line) - 3)))
    alphabet = np.arange(97, 102, dtype=np.uint32)
    arrays = [tuple(map(np.array, zip(*sorted((pack(g), float(c)) for g, c in own.items())))) for own in langs]
    model = Model(["x", "y"], alphabet, [(g.astype(np.int64), c) for g, c in arrays])
    grams = [tuple(rng.choice([1, 2, 3, 4, 5, 6, 7]) for _ in range(4)) for _ in range(300)]
    got = model.log_probabilities(np.array([pack(g) for g in grams]))
    for row, g in zip(got, grams):
        for l in range(2):
            assert abs(row[l] - math.log(slow_probability(langs[l], g, len(alphabet)))) < 1e-4


def test_fit_predict_and_reject(spark):
    rows = corpus(200)
    df = spark.createDataFrame([(*r, "z", 1.0) for r in rows], "doc_id long, text string, lang string, row string, score double").repartition(3)
    model = fit(df)
    assert model.languages == ["aa", "bb", "cc"]
    others = [(1000, None), (1001, ""), (1002, "12 !! 34"), (1003, "qwyzzq vxvxjj hhjwqq kkqqww zzxxvv" * 4), (1004, "KATA pima KATO sula kata"), (None, rows[0][1]), (1005, "éloi " * 100000)]
    test = spark.createDataFrame([(i, t, None, "z", 0.5) for i, t in others] + [(i + 5000, t, lang, "z", .1) for i, t, lang in corpus(100, 9)], df.schema)
    out = {r.row.doc_id: r for r in predict(test, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 and out[i].rejected for i in (1000, 1001, 1002))
    assert out[1003].rejected and not out[1004].rejected and out[1004].lang_pred == "aa" and out[1005].lang_pred == "cc"
    fresh = [(r, lang) for i, _, lang in corpus(100, 9) for r in [out[i + 5000]]]
    assert all(r.lang_pred == lang and not r.rejected and 0 < r.score <= 1 for r, lang in fresh)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = fit(df)
    r = predict(df, model).first()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert predict(df.limit(0), model).collect() == []


def test_query_accuracy_on_held_out_documents(spark):
    out = queries.queries()["op3_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = docs.merge(out, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(docs) == len(out) and len(held) > 100
    assert (held.lang == held.lang_pred).mean() > 0.95
