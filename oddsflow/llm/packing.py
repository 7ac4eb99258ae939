"""Token pieces, and vector best-fit packing of them into sequences.

Tokenising: white space never joins two tokens of the vocabularies this is for, so
a text is cut at ASCII white space and the token ids of each distinct piece of text
are looked up in a bounded cache, filled by the tokenizer itself (by its words, where its
pattern cuts them; see chunks).  Tokenisers that tell white space apart are detected by a
probe and get whole texts instead.

Packing: an item has a vector (tokens, documents, attention cost = length squared)
and a sequence a capacity in each.  Items are dealt by a hash of their key, and of a row
number if rows repeat, into groups of bounded size, which are packed independently: the longest first, each into the open
sequence, among those with room in every component, that has the smallest weighted
residual norm afterwards, or the largest weighted dot product of residual and item.
Packing by groups costs at most the last, partly filled sequences of each group.

Null text is empty and yields its end token alone.  Repeated rows are packed as
documents of their own.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsflow.llm import caches
from oddsflow.llm.chunks import ChunkCache, WordCache, symbols
from oddsflow.llm.staging import Stage
from oddsflow.llm.words import slices

GROUP = 32_768    # items packed together
OUT_BYTES = 1 << 20  # of ids in a batch of pieces

_tokenizers: dict = {}


class CachedTokenizer:
    """Ids of whole texts by the library, which is given each distinct word or chunk once if the tokenizer allows it."""

    def __init__(self, path: str, control: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not control  # without control, control strings in a text are ordinary text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = "a\tb\n\x0b\x0c\r c 'd e' 1 2" + "".join(f" {t}\n{t} x{t}" for t in added)
        self.by_word = self._ids([probe])[0] == b"".join(self._ids(probe.split()))
        try:
            with open(path, encoding="utf-8") as f:
                encode = WordCache(self.tokenizer, json.load(f), self._words, lambda t: self._ids([t])[0])
        except ValueError:  # a tokenizer of another kind: whole chunks
            encode = lambda chunks: self._ids([c.decode() for c in chunks])
        self.cache = ChunkCache(encode)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words as the pattern cuts them: these go to the tokenizer's model itself."""
        model = self.tokenizer.model
        return [array("I", [t.id for t in model.tokenize(symbols(w))]).tobytes() for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row bounds) of a column of texts; nulls are empty."""
        if self.by_word:
            return self.cache.ids(texts)
        parts = self._ids([t or "" for t in texts.to_pylist()])
        return np.frombuffer(b"".join(parts), "<u4"), np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)])


def _tokenizer(path: str, control: bool) -> CachedTokenizer:
    if (path, control) not in caches.only("packing", _tokenizers):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path, control] = CachedTokenizer(path, control)
    return _tokenizers[path, control]


def _no_pieces() -> dict[str, list]:
    return {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _pieces(batches, path: str, limit: int, end_id: int, control: bool) -> Iterator[pa.RecordBatch]:
    tokenizer, end = _tokenizer(path, control), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for run in slices(batch, "text", 8 << 20):  # the longer a run, the fewer distinct chunks a text
            out, held = _no_pieces(), 0
            flat, bounds = tokenizer.encode(run.column("text"))
            for doc, a, b in zip(run.column("doc_id").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                ids = flat[a:b].tobytes() + end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    for k, v in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                        out[k].append(v)
                held += len(ids)
                if held >= OUT_BYTES:
                    yield _batch(out)
                    out, held = _no_pieces(), 0
            del flat, bounds
            if held:
                yield _batch(out)


def token_pieces(docs: DataFrame, path: str, limit: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", control: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): each document's token ids and its end id,
    cut into pieces of at most `limit`; ids as little-endian unsigned 32-bit integers.
    With `control` a control string in a text is its one token, as by the library's default."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(lambda it: _pieces(it, path, limit, end_id, control), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def best_fit(items: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> np.ndarray:
    """The bin of each item (rows of `items`, at most `capacity`): vector best fit, largest first."""
    share = items / capacity
    if (share > 1).any():
        raise ValueError("an item exceeds the capacity")
    order = np.lexsort((np.arange(len(items)), *(-share[:, ::-1].T)))
    bins = np.empty(len(items), np.int64)
    room = np.empty((len(items), items.shape[1]))   # of the open bins, in whole units
    label = np.empty(len(items), np.int64)
    opened = made = 0
    least = np.minimum.accumulate(items[order][::-1], axis=0)[::-1]  # smallest component still to come
    for step, i in enumerate(order):
        if step % 256 == 0 and opened:  # bins that no later item fits are closed
            keep = np.flatnonzero((room[:opened] >= least[step]).all(axis=1))
            room[:len(keep)], label[:len(keep)], opened = room[keep], label[keep], len(keep)
        fits = np.flatnonzero((room[:opened] >= items[i]).all(axis=1))
        if len(fits):
            left = (room[fits] - items[i]) / capacity
            value = (weights * left * left).sum(axis=1) if score == "norm" else -(weights * room[fits] / capacity * share[i]).sum(axis=1)
            at = fits[np.argmin(value)]
        else:
            at, room[opened], label[opened] = opened, capacity, made
            opened, made = opened + 1, made + 1
        room[at] -= items[i]
        bins[i] = label[at]
    return bins


def _pack(table: pa.Table, capacity: tuple, weights: tuple, score: str) -> pa.Table:
    length = table.column("length").to_numpy()
    items = np.stack([length, np.ones(len(length)), length.astype(float) ** 2], axis=1)
    bins = best_fit(items, np.array(capacity, float), np.array(weights, float), score)
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(length[order]) - length[order]
    first = np.concatenate([[True], np.diff(bins[order]) > 0])
    offset = np.empty(len(bins), np.int64)
    offset[order] = before - before[np.maximum.accumulate(np.where(first, np.arange(len(bins)), 0))]
    group = table.column("group").to_numpy()
    return table.drop_columns(["group"]).append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offset))


def pack(pieces: DataFrame, tokens: int = 4096, documents: int | None = None, attention: int | None = None,
         weights: tuple = (1.0, 0.05, 0.05), score: str = "norm", with_ids: bool = False) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32), and their ids if asked for.

    Capacities left out are those that `tokens` implies (as many documents as tokens, its
    square as attention cost), which then never bind.  Offsets in a sequence are gapless.
    Each row of pieces is packed for itself: rows that share a document's id, or have none,
    stay apart and keep their own ids.
    """
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    capacity = (tokens, documents or tokens, attention or tokens * tokens)
    stage = Stage(pieces.sparkSession, "packing")
    light = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kept = stage(pieces.select(*light, *(["ids"] if with_ids else []), F.monotonically_increasing_id().alias("row")))
    groups, key = max(1, -(-kept.count() // GROUP)), ["doc_id", "piece", "ids_crc32"]
    if groups > 1 and not kept.groupBy(*key).count().where("count > 1").isEmpty():  # repeated rows are dealt out by their stored number
        key.append("row")
    grouped = kept.select(*light, "row", F.pmod(F.xxhash64(*key), F.lit(groups)).alias("group"))
    packed = grouped.groupBy("group").applyInArrow(
        lambda t: _pack(t, capacity, weights, score), "doc_id long, piece int, start long, length long, ids_crc32 long, row long, sequence_id long, offset long")
    return (packed.join(kept.select("row", "ids"), "row") if with_ids else packed).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids; a sequence is bounded by its capacity."""
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return joined.select("sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
