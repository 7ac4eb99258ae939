"""Token pieces against the tokenizer on whole texts; packing against its constraints and a bound."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from oddsflow.llm import chunks, packing
from oddsflow.llm.packing import CachedTokenizer, best_fit, pack, sequences, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list(" \n\t\r\x0b\x0c\x1c\x85 aZé中😀̸́'.12ßİΣ") + ["'s", "'re", "word ", "Another ", " "]


WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True


def whole(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


def encoded(tokenizer, texts):
    ids, bounds = tokenizer.encode(pa.array(texts))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_cached_ids_equal_whole_text_ids(monkeypatch):
    monkeypatch.setattr(chunks, "CACHE", 40)
    monkeypatch.setattr(chunks, "WORDS", 40)
    tokenizer, rng = CachedTokenizer(PATH), random.Random(2)
    assert tokenizer.by_word
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(600)] + ["<|endoftext|> x<|startoftext|>"]
    got = [row for k in range(0, len(texts), 50) for row in encoded(tokenizer, texts[k:k + 50])]
    assert got == [whole(t) for t in texts] and len(tokenizer.cache.known) <= 40


def test_control_strings_as_by_the_library(spark):
    library, rng = Tokenizer.from_file(PATH), random.Random(4)
    tokenizer = CachedTokenizer(PATH, control=True)
    assert tokenizer.by_word
    parts = ALPHABET + ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>"] * 3
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(20))) for _ in range(1000)] + ["end <|endoftext|> x"]
    assert encoded(tokenizer, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    ids = library.encode(texts[-1], add_special_tokens=False).ids + [1]
    docs = spark.createDataFrame([(1, texts[-1], "en", "x", 19)], "doc_id long, text string, lang string, source string, n_chars long")
    for out in (corpus_pipeline.best_fit_packing(spark, docs, ""), token_pieces(docs, PATH, control=True)):
        assert [(r.length, r.ids_crc32) for r in out.collect()] == [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


def test_memory_of_a_run_of_texts_is_bounded(monkeypatch):
    """Neither unseen chunks nor ids of pieces are handled for a whole run of texts at once."""
    monkeypatch.setattr(chunks, "AT_ONCE", 100)
    monkeypatch.setattr(packing, "OUT_BYTES", 4000)
    rng = random.Random(6)
    texts = [None, ""] + [" ".join("w%dx%d" % (rng.randrange(99), rng.randrange(99)) for _ in range(rng.randrange(80))) for _ in range(300)] + ["x " * 9000]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    tokenizer = CachedTokenizer(PATH)
    monkeypatch.setattr(packing, "_tokenizer", lambda *_: tokenizer)
    asked, encode = [], tokenizer.cache.encode
    tokenizer.cache.encode = lambda some: asked.append(len(some)) or encode(some)
    found = list(packing._pieces([rows], PATH, 4096, 1, False))
    assert len(asked) > 1 and max(asked) <= 100
    assert len(found) > 1 and all(sum(map(len, b.column("ids").to_pylist()[:-1])) < 4000 for b in found[:-1])
    got = {}
    for b in found:
        for r in b.to_pylist():
            got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {i: whole(t or "") + [1] for i, t in enumerate(texts)}


def test_pieces_and_packing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("word%d" % rng.randrange(99) for _ in range(rng.choice([0, 1, 5, 40, 90])))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "x " * 500), (7, rows[7][1])]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, piece int, length long").repartition(3)
    pieces = token_pieces(df, PATH, limit=128)
    assert [tuple(r) for r in pieces.where("doc_id = 300").select("piece", "start", "length", "ids_crc32").collect()] == [(0, 0, 1, zlib.crc32(b"\1\0\0\0"))]
    out = pack(pieces, tokens=128).collect()
    assert len(out) == pieces.count()
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    total = sum(r.length for r in out)
    assert len(by) <= -(-total // 128) * 1.03 + 1
    ids = {r.doc_id: whole(t or "") + [1] for r, (_, t) in ((r, rows[r.doc_id]) for r in out)}
    for r in out:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def test_sequences_hold_the_ids_of_every_row(spark):
    texts = ["a b c", "d e f", None, "a b c", "x " * 300, "y"]
    rows = list(zip([7, 7, None, 7, None, 9], texts))  # repeated and null ids, one row twice
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    packed = pack(token_pieces(docs, PATH, limit=128), tokens=128, with_ids=True)
    pieces = packed.collect()
    got = {s.sequence_id: np.frombuffer(s.ids, "<u4").tolist() for s in sequences(packed).collect()}
    parts = []
    for p in pieces:
        assert got[p.sequence_id][p.offset:p.offset + p.length] == np.frombuffer(p.ids, "<u4").tolist()
        parts.append((p.doc_id, p.start, p.ids_crc32))
    want = []
    for d, t in rows:
        ids = whole(t or "") + [1]
        want += [(d, k, zlib.crc32(np.array(ids[k:k + 128], "<u4").tobytes())) for k in range(0, len(ids), 128)]
    assert sorted(map(str, parts)) == sorted(map(str, want)) and sum(map(len, got.values())) == sum(p.length for p in pieces)


def test_repeated_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rows = [(None, "")] * 300 + [(4, "same text")] * 300 + [(i, "w%d" % i) for i in range(10, 110)]
    pieces = token_pieces(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH)
    out = pack(pieces, tokens=128).collect()
    assert len(out) == len(rows)
    sizes = Counter(r.sequence_id >> 32 for r in out)
    assert len(sizes) == 14 and max(sizes.values()) <= 100, sizes


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 100, 500).astype(float)
    items = np.stack([tokens, np.ones(500), tokens ** 2], axis=1)
    capacity = np.array([120.0, 4.0, 10000.0])
    bins = best_fit(items, capacity, np.array([1.0, 0.2, 0.2]), score)
    sums = np.zeros((bins.max() + 1, 3))
    np.add.at(sums, bins, items)
    assert (sums <= capacity).all() and (sums[:, 1] >= 1).all()
    bound = np.ceil((items.sum(axis=0) / capacity).max())
    assert len(sums) <= bound * 1.35


def test_best_fit_picks_the_tightest():
    items = np.array([[6.0], [5.0], [4.0], [3.0]])
    assert list(best_fit(items, np.array([10.0]), np.ones(1))) == [0, 1, 0, 1]
    with pytest.raises(ValueError):
        best_fit(np.array([[11.0]]), np.array([10.0]), np.ones(1))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack(token_pieces(empty, PATH)).collect() == []
