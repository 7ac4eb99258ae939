"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A merge list that forms each token once, from parts formed earlier, has this property: a
cutting of a word into tokens is what merging by rank gives exactly when every token is what
merging gives for its own text and every two neighbours are compatible, that is, no merge
across their border comes before one of them is complete.  So a word is encoded from left to
right: at each place the longest token that matches there (all matches found in one
Aho-Corasick pass) is taken if it is compatible with its left neighbour, else the next
shorter one; a place from which no token goes on is marked dead, and its left neighbour is
taken back.  A place is marked once, so the work is linear in the word for tokens of bounded
length.

Before that a text is normalised and cut into words as the tokenizer's file says.  White
space never joins two words here, so each distinct chunk between white space is handled once
a run of texts.  Chunks of printable ASCII and of Latin letters that the library is seen to
handle alike are cut by the file's pattern all at once; others one by one by the library's own
normaliser and pre-tokeniser, whose Unicode tables thereby count.

Decoding: the tokenizer has no decoder, for which the library joins the tokens by one space;
token t is content[offsets[t]:offsets[t + 1]] of one buffer, with that space at its end.

Null text is empty: no ids, and an empty decoded text.  Texts are read whole.  Each row is
handled by itself, so repeated rows and null ids stay rows of their own; an empty table
gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsflow.llm import caches
from oddsflow.llm.chunks import ChunkCache, WordCache, gather, symbols
from oddsflow.llm.words import slices

PAIRS = 400_000      # entries of the pair-compatibility table a worker remembers
FINAL = 1 << 12      # added to a word's last symbol, so that tokens of a word's end differ from others
BLOCK = 1 << 16      # tokens decoded at once
NEVER = 1 << 30

_codecs: dict = {}


class MergeTable:
    """Tokens, their parts and the compatibility of neighbours of one merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        import ahocorasick

        size = self.size = max(vocab.values()) + 1
        self.rank, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.merge = {}
        for r, (a, b) in enumerate(merges):
            whole = a + b
            t, a, b = vocab[whole], vocab[a], vocab[b]
            if self.rank[t] >= 0 or max(self.rank[a], self.rank[b]) >= r:
                raise ValueError(f"merge {r} forms {whole!r} a second time, or from parts formed later")
            self.rank[t], self.left[t], self.right[t] = r, a, b
            self.merge[a, b] = r
        self.pairs: dict[int, bool] = {}
        # a token that merging never gives for its own text is no candidate
        own = [True] * size
        by_rank = sorted((r, t) for t, r in enumerate(self.rank) if r >= 0)
        for r, t in by_rank:
            a, b = self.left[t], self.right[t]
            own[t] = own[a] and own[b] and self.first_across(a, b) == r
        marked = lambda s: s[:len(s) - len(suffix) - 1] + chr(ord(s[len(s) - len(suffix) - 1]) + FINAL) if suffix and s.endswith(suffix) and s != suffix else s
        made = {t for _, t in by_rank}
        symbols = {s: t for s, t in vocab.items() if t not in made and (len(s) == 1 or suffix and len(s) == 1 + len(suffix) and s.endswith(suffix))}
        self.token = {marked(s): t for s, t in vocab.items() if own[t] and (t in made or s in symbols)}
        self.length = [0] * size
        self.shorter = [-1] * size   # the longest token that is a proper prefix
        self.search = ahocorasick.Automaton()
        for s, t in self.token.items():
            self.length[t] = len(s)
            self.shorter[t] = next((self.token[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.token), -1)
            self.search.add_word(s, (t, len(s) - 1))
        self.search.make_automaton()
        self.suffix = suffix

    def first_across(self, a: int, b: int) -> int:
        """The rank of the first merge across the border of two complete tokens; NEVER if there is none.

        Undone in time: x and y are what touches the border, until the ranks that complete
        the tokens over them; a merge of equal rank goes left first.
        """
        x, y, x_until, y_until, first = a, b, NEVER, NEVER, NEVER
        while True:
            m = self.merge.get((x, y), NEVER)
            if m < x_until and m <= y_until:
                first = m
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                return first
            if rx > ry:
                x, x_until = self.right[x], rx
            else:
                y, y_until = self.left[y], ry

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves a and b as they are side by side: an entry of the table, made when first asked for."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[a * self.size + b] = self.first_across(a, b) == NEVER
        return known

    def encode(self, word: str) -> list[int]:
        """The tokens of one word of byte symbols."""
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + FINAL)
        whole = self.token.get(word)
        if whole is not None:
            return [whole]
        n, length, shorter, known, size = len(word), self.length, self.shorter, self.pairs.get, self.size
        longest = [-1] * n
        for end, (t, reach) in self.search.iter(word):  # at a start, longer tokens come later
            longest[end - reach] = t
        longest.append(-1)
        dead, out, at, t, last = bytearray(n + 1), [], 0, longest[0], -1
        while at < n:
            if t < 0:  # nothing goes on from here: the left neighbour is taken back
                if last < 0:
                    raise ValueError(f"no tokens for {word!r}")
                dead[at] = 1
                t = out.pop()
                at -= length[t]
                t, last = shorter[t], out[-1] if out else -1
                continue
            end = at + length[t]
            if not dead[end]:
                fits = last < 0 or known(last * size + t)
                if fits or fits is None and self.compatible(last, t):
                    out.append(t)
                    at, last, t = end, t, longest[end]
                    continue
            t = shorter[t]
        return out


class Codec:
    """Encoding and decoding as by the tokenizer of a file (BPE over byte symbols, no decoder)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.table = MergeTable(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        if spec.get("decoder"):
            raise ValueError("the tokenizer has a decoder of its own")
        self.control = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.words = WordCache(Tokenizer.from_file(path), spec, lambda words: [self._ids([symbols(w)]) for w in words], self.text)
        self.chunks = ChunkCache(self.words)
        names = {t: s for s, t in [*model["vocab"].items(), *self.control.items()]}
        table = [(names[t] + " ").encode() if t in names else b"" for t in range(max(names) + 1)]
        self.lengths = np.array([len(x) for x in table], np.int64)
        self.offsets, self.content = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(table), np.uint8)

    def _ids(self, words: list[str]) -> bytes:
        return array("I", [t for w in words for t in self.table.encode(w)]).tobytes()

    def text(self, text: str) -> bytes:
        """The ids of a text without white space, whatever its characters; control strings are one token each."""
        parts = self.words.control.split(text) if self.words.control else [text]
        return b"".join(np.array([self.control[p]], "<u4").tobytes() if k % 2 else self._ids(self.words.library_words(p)) for k, p in enumerate(parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row bounds) of a column of texts."""
        return self.chunks.ids(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text of one row of ids, in UTF-8."""
        parts = [gather(self.content, self.offsets, self.lengths, ids[k:k + BLOCK].astype(np.int64))[0].tobytes() for k in range(0, len(ids), BLOCK)]
        return b"".join(parts)[:-1]


def codec(path: str) -> Codec:
    if path not in caches.only("bpe_codec", _codecs):
        _codecs[path] = Codec(path)
    return _codecs[path]


def _coded(batches, path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        for run in slices(batch, "text", 2 << 20):
            ids, bounds = c.encode(run.column("text"))
            rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary()),
                                              pa.array([c.decode(r) for r in rows], pa.binary())], ["doc_id", "ids", "decoded"])


def _decoded(batches, path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        texts = [c.decode(np.frombuffer(i or b"", "<u4")).decode() for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): token ids as little-endian unsigned 32-bit integers."""
    return round_trip(docs, path, id_col, text_col).select("doc_id", "ids")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    return coded.select("doc_id", "ids").mapInArrow(lambda it: _decoded(it, path), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): each text's ids, and those ids decoded again (UTF-8), in one pass."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(lambda it: _coded(it, path), "doc_id long, ids binary, decoded binary")
