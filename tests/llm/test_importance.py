"""Features, gains and the draw against the definition, word by word."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from oddsflow.llm import importance
from oddsflow.llm.importance import Featurizer, feed, resample
from oddsflow.llm.queries import op11_importance_resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets(text, size=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(f.encode()) % size for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(docs, target, size=10_000):
    """(doc_id, n_features, weight, score, rank) of every document."""
    corpus, wanted = [0] * size, [0] * size
    found = [(i, *buckets(t, size)) for i, t in docs]
    for _, _, f in found:
        for b in f:
            corpus[b] += 1
    for t in target:
        for b in buckets(t, size)[1]:
            wanted[b] += 1
    S, T = sum(corpus), sum(wanted)
    gain = [math.floor(1000 * math.log((t + 1) * (S + size) / ((s + 1) * (T + size)))) for s, t in zip(corpus, wanted)]
    rows = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    drawn = 25 * len(able) // 100
    out = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(able, 1)]
    return sorted(map(str, out + [(*r[:4], None) for r in rows if r[4] < 20]))


def test_crc_of_spans():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + rng.choice([0, 1, 3, 8, 63, 64, 65, 200, 900], 300)
    got = feed(np.full(300, 0xFFFFFFFF, np.uint32), data, starts, ends) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_words_in_blocks(monkeypatch):
    rng = random.Random(1)
    letters = list("aZ09 _-.\n\x00\x7f`{@[/:") + ["é", "中", "😀", "İ", "Σ", "́", "long" * 30, "   "]
    texts = [None, ""] + ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(200)] + ["x" * 500, "é" * 300 + " a b", "a " * 300]
    for block in (3, 17, 64, 1 << 15):
        monkeypatch.setattr(importance, "BLOCK", block)
        row, bucket, words = Featurizer().rows(pa.array(texts, pa.string()))
        for k, t in enumerate(texts):
            n, want = buckets(t)
            assert words[k] == n and sorted(bucket[row == k].tolist()) == sorted(want), (block, t)


def test_draw_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(60)] + ["Ünï", "中文", "X9"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 19, 20, 21, 60])))) for i in range(400)]
    docs += [(None, "null id " * 30), (None, "null id " * 30), (7, "again " * 40), (7, "again " * 40), (-5, None), (10**12, ""), (11, "v" * 70_000 + " z" * 30)]
    target = [None, "", "w1 w2 w3 w1 w2", "Ünï w5"]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rank", "2 as counts", "'x' as buckets").repartition(5)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = resample(d, t)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, target)
    assert resample(d.limit(0), t).collect() == []
    assert sorted(str(tuple(r)) for r in resample(d, t.limit(0)).collect()) == brute(docs, [])


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted(str(tuple(r)) for r in op11_importance_resampling(spark, sf).collect()) == brute(docs, target)
