"""FM-index search against brute force; the index itself against plain search."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from oddsflow.llm import fm_dedup
from oddsflow.llm.fm_dedup import FMIndex, WaveletMatrix, earliest, remove_repeats, repeat_digests

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, docs=120):
    rng = random.Random(seed)
    vocab = ["a", "b", "É", "the", "The"] + ["w%d" % i for i in range(60)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([12, 13, 14, 30, 60]))] for _ in range(8)]
    rows = []
    for i in range(docs):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 12, 13, 40, 150]))]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        if rng.random() < 0.1:
            w = ["same"] * rng.choice([5, 13, 200])
        if rng.random() < 0.1 and rows:
            w = WORD.findall(rng.choice(rows)[1])
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(1, None), (2, ""), (4, " \n"), (None, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [4096, 2])
def test_digests_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(fm_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(fm_dedup, "SHARD_SEGMENTS", 50)
    rows = corpus(hot)
    df = spark.createDataFrame([(i, t, 1, "m", [1]) for i, t in rows], "doc_id long, text string, doc int, mark string, starts array<int>").repartition(4)
    got = sorted((tuple(r) for r in repeat_digests(df).collect()), key=str)
    assert got == brute(rows, 13)


def test_repeated_ids_and_empty_table(spark):
    text = " ".join("w%d" % i for i in range(20))
    rows = [(5, text), (5, text), (5, "x " + text), (3, "only here"), (9, text + " y")]
    got = sorted((tuple(r) for r in repeat_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows, 13)
    assert repeat_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_id_in_another_block(spark):
    text = " ".join("w%d" % i for i in range(20))
    rows = [(7, "another start " + text), (7, text), (3, text)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = sorted((tuple(r) for r in repeat_digests(df).collect()), key=str)
    assert got == brute(rows, 13)


def test_cut_keeps_everything_else(spark):
    shared = " ".join("s%d" % i for i in range(15))
    rows = [(1, "Head\n" + shared + "  tail", "en"), (2, "Other  head\n" + shared + "\nits own\ttail ", "de"), (3, shared, None), (4, "untouched  text\n", "x"), (5, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert [got[i].text for i in (1, 2, 3, 4, 5)] == [rows[0][1], "Other  head\nits own\ttail ", "", "untouched  text\n", None]
    assert got[2].row == "de" and remove_repeats(df).columns == df.columns


def test_wavelet_rank_and_intervals():
    rng = np.random.default_rng(0)
    for symbols in (2, 3, 9, 64, 100):
        seq = rng.integers(0, symbols, 333)
        matrix = WaveletMatrix(seq, symbols)
        c, p = rng.integers(0, symbols, 50), rng.integers(0, 334, 50)
        assert list(matrix.rank(c, p)) == [int((seq[:j] == i).sum()) for i, j in zip(c, p)]
    text = np.concatenate([rng.integers(1, 4, 200), [0]])
    index = FMIndex(text, 4, 5)
    for i in range(190):
        low, high = np.array([index.before[text[i + 4]]]), np.array([index.before[text[i + 4] + 1]])
        for k in (3, 2, 1, 0):
            low, high = index.extend(text[[i + k]], low, high)
        want = [j for j in range(196) if (text[j:j + 5] == text[i:i + 5]).all()]
        assert sorted(index.order[low[0]:high[0]]) == want


def test_earliest_of_one_shard():
    words = [np.array(w, np.uint64) for w in ([1, 2, 3, 4], [9, 1, 2, 3], [2, 3, 4], [7, 7, 7, 7])]
    got = [list(x) for x in earliest(words, np.array([5, 3, 8, 1]), 3)]
    assert got == [[3, 5], [3, 3], [5], [1, 1]]


def test_words_built_alike_are_not_repeats(spark):
    from tests.llm.test_partenum import thue_morse

    one, two = thue_morse(10)
    tail = " ".join("w%d" % i for i in range(12))
    rows = [(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, f"{one} {tail}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeat_digests(docs).collect()), key=str) == brute(rows, 13)
    assert {r.doc_id: r.n_removed for r in repeat_digests(docs).collect()} == {1: 0, 2: 0, 3: 13}


def texts_batch(megabytes):
    rng = random.Random(megabytes)
    vocab = ["w%d" % i for i in range(5000)]
    texts = [" ".join(rng.choices(vocab, k=400)) for _ in range(megabytes * 450)]
    zeros = pa.array([0] * len(texts), pa.int64())
    starts = pa.array([[0, 5] if i % 2 else None for i in range(len(texts))], pa.list_(pa.int32()))
    listed = pa.array([[{"anchor": 1, "span": (k << 8) | 4} for k in range(0, 380, 4)]] * len(texts), pa.list_(pa.struct([("anchor", pa.int64()), ("span", pa.int64())])))
    ids = pa.array(range(len(texts)), pa.int64())
    row = pa.array([{"doc_id": i} for i in range(len(texts))])
    return pa.RecordBatch.from_arrays([ids, ids, zeros, row, pa.array(texts), starts, listed], ["doc", "doc_id", "mark", "row", "text", "starts", "listed"])


def peak(task, batch):
    """MB that a task takes beside its batch while its output is read and dropped."""
    tracemalloc.start()
    for _ in task(iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


@pytest.mark.parametrize("task, most", [(lambda it: fm_dedup._minimisers(it, 13, 5), 60), (lambda it: fm_dedup._segments(it, 13), 70), (lambda it: fm_dedup._digest(it, 13), 50), (lambda it: fm_dedup._cut(it, 13), 30)])
def test_a_task_takes_little_beside_its_batch(task, most):
    assert peak(task, texts_batch(8)) < most


def test_runs_of_any_length_give_equal_rows(monkeypatch):
    batch = texts_batch(1)
    batch = pa.concat_batches([batch.slice(0, 40), batch.slice(0, 3), batch.slice(50, 9)])
    for task in (lambda it: fm_dedup._minimisers(it, 13, 5), lambda it: fm_dedup._segments(it, 13), lambda it: fm_dedup._digest(it, 13), lambda it: fm_dedup._cut(it, 13)):
        got = []
        for at_once in (1, 5000, 1 << 30):
            monkeypatch.setattr(fm_dedup, "AT_ONCE", at_once)
            got.append(pa.Table.from_batches(task(iter([batch]))).to_pylist())
        assert got[0] == got[1] == got[2] and got[0]


def test_batches_for_workers_are_bounded(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    long = spark.range(0, 9000, 1, 1).selectExpr("repeat('some words ', 300) as text")
    assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) < 10 << 20
