"""Ids and decoded texts against the tokenizers library; the table against merging by rank."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from oddsflow.llm import bpe_codec, chunks
from oddsflow.llm.bpe_codec import Codec, MergeTable, decode, encode, round_trip
from oddsflow.llm.queries import op13_bpe_codec

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = list(" \n\t\r\x0b\x0c\x1c\x85 aZé中😀̸́'.12ßİΣŉſ") + ["'s", "'re", "word ", "Another ", " ", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>"]


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def test_codec_equals_the_library(monkeypatch):
    monkeypatch.setattr(chunks, "CACHE", 50)
    monkeypatch.setattr(chunks, "WORDS", 50)
    monkeypatch.setattr(bpe_codec, "PAIRS", 300)
    monkeypatch.setattr(bpe_codec, "BLOCK", 7)
    rng, codec = random.Random(3), Codec(PATH)
    texts = [None, "", "the " * 300, "=" * 900, "中" * 200, "x" * 500 + "y"]
    for letters in (ALPHABET, "ab", "aaaae!=", "theinanreering", "0123456789abcdefABCDEF"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    for k in range(0, len(texts), 90):
        ids, bounds = codec.encode(pa.array(texts[k:k + 90], pa.string()))
        for j, text in enumerate(texts[k:k + 90]):
            row = ids[bounds[j]:bounds[j + 1]]
            assert (row.tolist(), codec.decode(row).decode()) == library(text), text
    assert len(codec.chunks.known) <= 50 and len(codec.words.known) <= 50 and len(codec.table.pairs) <= 300


def merged(word, rank):
    """Merging by rank, the leftmost of the best pair first, as defined."""
    parts = list(word)
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if best is None:
            return parts
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_backtracking_equals_merging_for_any_merge_list(seed):
    rng = random.Random(seed)
    vocab, merges = {c: i for i, c in enumerate("abc")}, []
    for _ in range(rng.randrange(25)):
        a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
        if a + b not in vocab and len(a + b) < 9:
            vocab[a + b] = len(vocab)
            merges.append((a, b))
    table, name = MergeTable(vocab, merges), {i: s for s, i in vocab.items()}
    rank = {m: r for r, m in enumerate(merges)}
    for _ in range(60):
        word = "".join(rng.choice("aabc") for _ in range(rng.randrange(1, 25)))
        assert [name[t] for t in table.encode(word)] == merged(word, rank)


def test_query_equals_the_library(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(10**6, None, "en", "x", 0), (10**6, "", None, "x", 0), (None, "Null ID <|endoftext|>", "en", "x", 0), (1, "again", "en", "x", 0), (1, "again", "en", "x", 0),
             (10**6 + 1, "Ωμέγα ΣΑΣ é " * 20_000, "en", "x", 0)]
    docs = source.unionByName(spark.createDataFrame(extra, source.schema)).selectExpr("*", "1 as ids", "2 as decoded")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = [(r.doc_id, *library(r.text)) for r in docs.select("doc_id", "text").collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted(str((d, len(i), sha(np.array(i, "<u4").tobytes()), sha(t.encode()))) for d, i, t in texts)
    got = op13_bpe_codec(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == want
    few = docs.where("doc_id < 20")
    assert sorted(map(str, decode(encode(few, PATH), PATH).collect())) == sorted(
        map(str, round_trip(few, PATH).selectExpr("doc_id", "cast(decoded as string) as text").collect()))
    assert round_trip(docs.limit(0), PATH).collect() == []
