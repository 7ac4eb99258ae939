"""Encoding and decoding against the sentencepiece library; the character map against its normaliser."""

import random

import numpy as np
import public_tokenizers
import sentencepiece

from oddsflow.llm import sp_codec
from oddsflow.llm.sp_codec import Codec, Normalizer, decode, encode, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = list(" ▁\n\t\r aZé中😀 \x00\x1f.12éﬁ") + ["the ", "  ", "<s>", "</s>", "<unk>", "<0x41>"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_ids_and_spans_equal_the_library(monkeypatch):
    monkeypatch.setattr(sp_codec, "CACHE", 100)
    model = Codec(PATH)
    assert model.by_chunk
    for text in [*texts(4000), "", " ", "▁", "\n", "a  ", "word " * 3000]:
        (ids, ends), = model.encode([text])
        ids, ends, raw = np.frombuffer(ids, "<u4").tolist(), np.frombuffer(ends, "<u4").tolist(), text.encode()
        assert ids == LIBRARY.encode(text)
        assert not ids or ends[-1] == len(raw)
        for begin, end, i in zip([0, *ends], ends, ids):
            if i not in model.byte:  # the span holds what the piece shows
                assert raw[begin:end].decode().replace(" ", "▁") in (model.pieces[i], model.pieces[i][1:])
            else:
                assert raw[begin:end] == bytes([model.byte[i]])


def test_decode_equals_the_library():
    model, rng = Codec(PATH), random.Random(3)
    for _ in range(4000):
        ids = [rng.randrange(32000) if rng.random() < .5 else rng.randrange(300) for _ in range(rng.randrange(8))]
        assert model.decode(np.array(ids, int)) == LIBRARY.decode(ids)


def test_character_map_equals_the_library():
    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        model.ParseFromString(library.serialized_model_proto())
        own = Normalizer(model.normalizer_spec.precompiled_charsmap, False, False, False)
        rng = random.Random(rule)
        alphabet = list(" ａＡﬁ①㌀ñé́가각ᄀ　​\tZ中😀Ⅳ½\n") + [" ", "﻿"]
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))
            got, places = own(text.encode())
            assert got.decode() == library.normalize(text), (rule, text)
            assert len(places) == len(got) + 1 and places == sorted(places)


def test_operator(spark):
    rows = list(enumerate([*texts(200, 9), None, ""])) + [(None, "x"), (3, "again")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int").repartition(3)
    got = sorted(((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.text) for r in decode(encode(df, PATH), PATH).collect()), key=str)
    want = [[1, *LIBRARY.encode(t or ""), 2] for _, t in rows]
    assert got == sorted(((i, tuple(w), LIBRARY.decode(w)) for (i, _), w in zip(rows, want)), key=str)
    assert sorted(map(str, round_trip(df, PATH).collect())) == sorted(map(str, decode(encode(df, PATH), PATH).collect()))
    assert encode(df.limit(0), PATH).collect() == []


def test_query_spans_equal_the_library(spark):
    """The ends in the query's rows, against the offsets that the library itself gives."""
    import hashlib

    from oddsflow.llm import queries

    sf = "/root/testdata/sf0.001"
    texts_of = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    compared = 0
    for r in queries.queries()["op6_sentencepiece"](spark, sf).collect():
        text = texts_of[r.doc_id]
        pieces = LIBRARY.encode(text, return_type="proto").pieces  # with byte offsets
        if any(p.begin == p.end for p in pieces):  # the library gives the bytes of one character one span
            continue
        ends = [0, *(p.end for p in pieces), len(text.encode())]
        assert hashlib.sha256(np.array(ends, "<u4").tobytes()).hexdigest() == r.ends_sha256
        compared += 1
    assert compared > 0.8 * len(texts_of)
