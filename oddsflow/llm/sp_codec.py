"""Offset-preserving SentencePiece encoding, and decoding.

A text is normalised by the model's compiled character map: a double-array trie of
source strings, walked for the longest prefix at every place; what no entry covers
is taken as it is.  Each normalised byte records the source byte it comes from, so a
piece projects to the span of original bytes it stands for.  Pieces of the models
meant here never reach over the white-space mark from the left, and none holds a
line feed, so a text is cut there and the pieces of each distinct chunk are looked
up in a bounded cache that the sentencepiece library fills; other models (checked when
the model is loaded) get whole texts.

Null text is empty: begin and end ids only.  Repeated rows are encoded each.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsflow.llm import caches
from oddsflow.llm.words import slices

MARK = "▁"
CACHE = 250_000
_CHUNK = re.compile(f"\n|[ {MARK}]*[^ {MARK}\n]+|[ {MARK}]+")


class CharacterMap:
    """The compiled map: longest-prefix rules from source strings to replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.text = blob[4 + size:] if blob else b""

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes]:
        """(source bytes, replacement) of the longest entry that starts at `at`; (0, b"") if none does."""
        if not self.units:
            return 0, b""
        used, value, unit = 0, 0, self.units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                used, value = i + 1 - at, self.units[node] & 0x7FFFFFFF
        return (used, self.text[value:self.text.index(b"\0", value)]) if used else (0, b"")


class Normalizer:
    """Text to marked, normalised bytes, and for each of them its place in the source."""

    def __init__(self, blob: bytes, dummy_prefix: bool, trim: bool, escape: bool):
        self.map, self.dummy_prefix, self.trim, self.escape = CharacterMap(blob), dummy_prefix, trim, escape

    def __call__(self, raw: bytes) -> tuple[bytes, list[int]]:
        """(normalised, places): places has one entry a byte and one for the end."""
        space = MARK.encode() if self.escape else b" "
        parts, at = [], 0
        while at < len(raw):
            used, new = self.map.longest(raw, at)
            if not used:
                used = 1 + (raw[at] >= 0xC0) + (raw[at] >= 0xE0) + (raw[at] >= 0xF0)
                new = raw[at:at + used]
            parts.append((at, at + used, new))
            at += used
        first, last = 0, len(parts)
        if self.trim:
            while first < last and not parts[first][2].strip(b" "):
                first += 1
            while last > first and not parts[last - 1][2].strip(b" "):
                last -= 1
        if first == last:
            return b"", [len(raw)]
        out, places = bytearray(), []
        if self.dummy_prefix:
            out += space
            places += [parts[first][0]] * len(space)
        blank = self.trim  # a leading space is dropped, as after another one
        for begin, _, new in parts[first:last]:
            for i, byte in enumerate(new):
                if byte == 0x20:
                    if self.trim and blank:
                        continue
                    out += space
                    places += [begin] * len(space)
                    blank = True
                else:
                    out.append(byte)
                    places.append(begin + i if new == raw[begin:begin + len(new)] else begin)
                    blank = False
        end = parts[last - 1][1]
        if self.trim:
            while out.endswith(space):
                del out[-len(space):], places[-len(space):]
        return bytes(out), [*places, end]


class Codec:
    """One model: ids, source spans and decoding of whole texts."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        self.normalize = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        kind = proto.ModelProto.SentencePiece
        self.byte = {i: int(self.pieces[i][1:-1], 16) for i, k in enumerate(self.kinds) if k == kind.BYTE}
        self.control = {i for i, k in enumerate(self.kinds) if k == kind.CONTROL}
        self.surface = [p.replace(MARK, " ") for p in self.pieces]
        self.by_chunk = (model.trainer_spec.model_type == proto.TrainerSpec.BPE and bool(self.byte) and not spec.precompiled_charsmap
                         and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
                         and not model.trainer_spec.treat_whitespace_as_suffix and kind.USER_DEFINED not in self.kinds
                         and not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.pieces))
        self.unknown = self.library.unk_id()
        self.dummy_prefix = spec.add_dummy_prefix
        self.source = np.array([1 if i in self.byte else len(s.encode()) for i, s in enumerate(self.surface)], "<u4")
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def _length(self, i: int) -> int:
        return 1 if i in self.byte else len(self.pieces[i].encode())

    def _ends(self, raw: bytes, ids: list[int]) -> list[int]:
        """Source byte at which each piece ends."""
        normal, places = self.normalize(raw)
        out, at = [], 0
        for k, i in enumerate(ids):
            if i == self.unknown:  # covers what lies before the next known piece
                follow = next((self.pieces[j].encode() for j in ids[k + 1:k + 2] if j != self.unknown), None)
                at = normal.index(follow, at + 1) if follow else len(normal)
            else:
                at += self._length(i)
            out.append(places[at])
        return out

    def _fill(self, chunks: list[str]) -> None:
        """Pieces of each chunk, and the source bytes that each piece stands for."""
        inner = [c[1:] if c[0] in " " + MARK else "\n" + c if c != "\n" else c for c in chunks]
        for chunk, ids in zip(chunks, self.library.encode(inner, num_threads=1)):
            if chunk[0] == " " and MARK not in chunk:  # the common case: a mark is one source byte
                ids = ids or [self.library.piece_to_id(MARK)]
                packed = np.array(ids, "<u4")
                self.cache[chunk] = packed.tobytes(), self.source[packed].tobytes()
                continue
            if chunk[0] in " " + MARK:
                ids = ids or [self.library.piece_to_id(MARK)]
                raw, ends = chunk[1:].encode(), []
                lead = len(chunk[0].encode())
                ends = [e + lead for e in self._ends(raw, ids)] if raw else [lead]
            elif chunk == "\n":
                ids, ends = ids[1:], [1]
            else:
                ids, raw = ids[2:], chunk.encode()
                ends = np.cumsum([self._length(i) for i in ids]).tolist()
            self.cache[chunk] = np.array(ids, "<u4").tobytes(), np.diff(ends, prepend=0).astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, ends) of each text, without begin and end ids."""
        if not self.by_chunk:
            out = []
            for text, ids in zip(texts, self.library.encode(texts, num_threads=1)):
                out.append((np.array(ids, "<u4").tobytes(), np.array(self._ends(text.encode(), ids), "<u4").tobytes()))
            return out
        split = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        unseen = list({c for chunks in split for c in chunks} - self.cache.keys())
        self._fill(unseen)
        get, out = self.cache.__getitem__, []
        for chunks in split:
            found = [get(c) for c in chunks]
            ends = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), "<u4"), dtype=np.int64) - 1  # the added prefix has no source
            out.append((b"".join([f[0] for f in found]), np.maximum(ends, 0).astype("<u4").tobytes()))
        if len(self.cache) > CACHE:  # full: what came first (the common chunks) stays
            for chunk in unseen:
                del self.cache[chunk]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode gives: marks become spaces, byte pieces become characters
        (U+FFFD for each byte that is none), the added prefix and control pieces go."""
        out, held, first = [], bytearray(), True
        for i in ids.tolist():
            if i in self.byte:
                held.append(self.byte[i])
                first = False
                continue
            if held:
                out.append(_characters(held))
                held = bytearray()
            if i in self.control:
                continue
            surface = " ⁇ " if i == self.unknown else self.surface[i]
            out.append(surface[1:] if first and self.dummy_prefix and surface[:1] == " " and i != self.unknown else surface)
            first = False
        return "".join(out) + _characters(held)


def _characters(held: bytearray) -> str:
    """UTF-8 where it is valid, U+FFFD for each other byte."""
    try:
        return held.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(held):
            width = 1 + (held[at] >= 0xC0) + (held[at] >= 0xE0) + (held[at] >= 0xF0)
            try:
                out.append(held[at:at + width].decode())
                at += width
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in caches.only("sp_codec", _codecs):
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode(batches, path: str) -> Iterator[pa.RecordBatch]:
    model = codec(path)
    begin, end = (np.array([i], "<u4").tobytes() for i in (model.library.bos_id(), model.library.eos_id()))
    for batch in batches:
        for run in slices(batch, "text"):
            texts = [t or "" for t in run.column("text").to_pylist()]
            found = model.encode(texts)
            sizes = [np.array([len(t.encode())], "<u4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array([begin + i + end for i, _ in found], pa.binary()),
                                              pa.array([b"\0\0\0\0" + e + s for (_, e), s in zip(found, sizes)], pa.binary())], ["doc_id", "ids", "ends"])


def _decode(batches, path: str) -> Iterator[pa.RecordBatch]:
    model = codec(path)
    for batch in batches:
        texts = [model.library.decode(np.frombuffer(i or b"", "<u4").tolist()) for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), batch.column("ends"), pa.array(texts, pa.string())], ["doc_id", "ids", "ends", "text"])


def _both(batches, path: str) -> Iterator[pa.RecordBatch]:
    for batch in _encode(batches, path):
        yield from _decode([batch], path)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode(encode(docs)) in one pass, so that a task needs one Python worker and one model."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(lambda it: _both(it, path), "doc_id long, ids binary, ends binary, text string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, ends): ids with begin and end ids, and the source byte at which each piece
    ends (it begins where the one before ends), both as little-endian unsigned 32-bit integers."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(lambda it: _encode(it, path), "doc_id long, ids binary, ends binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds text to (doc_id, ids, ends)."""
    return encoded.mapInArrow(lambda it: _decode(it, path), "doc_id long, ids binary, ends binary, text string")
