"""PartEnum join against brute force over all pairs."""

import random

import pytest

from oddsflow.llm.partenum import band_of, jaccard_components, signatures
from oddsflow.llm.words import gram_hashes, word_hashes, word_spans, utf8

import numpy as np
import pyarrow as pa


def brute(rows, n, num, den):
    sep = " \t\n\v\f\r"
    sets = {}
    for i, t in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))
        for s in sep[1:]:
            words = words.replace(s, " ")
        words = [w for w in words.split(" ") if w]
        sets[i] = {tuple(words[k:k + n]) for k in range(max(len(words) - n, 0) + 1)} if words else set()
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)] + ["É", "the", "THE"]
    rows, i = [], 0
    for _ in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 12, 20, 45, 90, 200]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "\n", "  "]).join(own)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "solo"), (i + 4, "SOLO")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100)])
def test_components_equal_brute_force(spark, n, num, den):
    rows = corpus(n)
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, n long, rep string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, n, num, den).collect()}
    assert got == brute(rows, n, num, den)


def test_signatures_never_miss_a_link():
    """Sets at and just inside the threshold share a signature, at every size."""
    rng = np.random.default_rng(1)
    for size in [*range(7, 60), 100, 333, 1000]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            for drop in range(size // 3):
                b = np.unique(np.concatenate([a[drop // 2:], rng.integers(0, 2**63, drop - drop // 2, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both < 85 * (len(a) + len(b) - both):
                    break
                if drop:
                    assert len(np.intersect1d(signatures(a, 85, 100), signatures(b, 85, 100))), (size, drop)


def test_bands_neighbour():
    for size in range(1, 400):
        band, low, high, below = band_of(size, 85, 100)
        assert below <= low <= size <= high
        smallest = -(-size * 85 // 100)
        assert band_of(smallest, 85, 100)[0] >= band - 1


def test_large_family_without_a_hub(spark):
    """One signature shared by more members than a block, in many components."""
    rng = random.Random(3)
    base = ["b%d" % i for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(2, 9)):
            own[rng.randrange(60)] = "x%d" % rng.randrange(10**6)
        rows.append((i, " ".join(own)))
    import oddsflow.llm.partenum as module
    old, module.BLOCK = module.BLOCK, 16
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 100).collect()}
    finally:
        module.BLOCK = old
    assert got == brute(rows, 4, 85, 100)


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(empty).collect() == []
    rows = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (None, "a b c d e f")]
    got = sorted(tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 6, 1, 1), (2, 6, 1, 1)]


def test_word_hashes_do_not_depend_on_place():
    text = ["a bb  ccc\ta", "", None, "ccc bb É" + "x" * 3_000_000 + " a", "É" + "x" * 3_000_000]
    data, bounds = utf8(pa.array(text))
    starts, ends, first = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    assert list(np.diff(first)) == [4, 0, 0, 4, 1]
    a, bb, ccc, a2, c3, b3, long, a3, long2 = words
    assert a == a2 == a3 and bb == b3 and ccc == c3 and long == long2 and len(set(words)) == 4
    assert len(gram_hashes(words, 4)) == 6


def thue_morse(levels):
    """Two texts of 2**levels letters that every polynomial hash modulo a power of two confuses."""
    one, two = "a", "b"
    for _ in range(levels):
        one, two = one + two, two + one
    return one, two


def test_words_built_alike_do_not_collide(spark):
    for levels in (6, 9, 10, 11, 13):
        one, two = (np.frombuffer(w.encode(), np.uint8) for w in thue_morse(levels))
        ends = np.array([len(one)])
        assert word_hashes(one, ends * 0, ends) != word_hashes(two, ends * 0, ends)
    one, two = thue_morse(10)
    docs = spark.createDataFrame([(1, one), (2, two), (3, " ".join([one] * 9)), (4, " ".join([two] * 9))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
