"""Repeated word windows by sharded FM-indexes.

1.  Every window of ``window`` words is routed by its minimiser, the smallest hash of
    the ``gram``-word runs inside it: equal windows have equal minimisers wherever they
    stand.  Runs of windows with one minimiser form a segment; a minimiser that only one
    document has is dropped there and then.
2.  The distinct segments of the rest are dealt to shards by minimiser.  A minimiser with
    very many distinct segments (the rim of a very common passage) is dealt out window by
    window instead, equal windows once.
3.  Each shard is an FM-index over word numbers: suffixes sorted as deep as a window, the
    Burrows-Wheeler sequence in a wavelet matrix of packed bits with rank counts.  The
    segments are streamed through backward search, all at once; a match that shrinks to
    one suffix (the segment's own) leaves early, and a match that reaches full length
    gets the smallest document id of its suffix interval.
4.  A window is repeated if a document with a smaller id has it; documents lose each word
    that a repeated window covers.

Words are compared by 64-bit hashes.  Null text is an empty document.  Rows with a null
id keep their text and are never the earlier copy.  Rows with equal ids are judged each
by its own text and never count as earlier for each other.  Other columns are kept by
:func:`remove_repeats` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsflow.llm import caches
from oddsflow.llm.staging import Stage
from oddsflow.llm.words import U64, gram_hashes, mix, slices, utf8, word_hashes, word_spans

GRAM = 5
LONGEST = 64          # windows of a segment
SHARD_SEGMENTS = 16_384
AT_ONCE = 1 << 20     # bytes of text handled at once (one text at least): what a task takes does not grow with its batches
HOT_SEGMENTS = 4_096  # distinct segments of one minimiser beyond which it is dealt by window
BROADCAST_ANCHORS = 1_000_000  # such minimisers (16 MB) up to which segments need no shuffle to be told apart
_ROLL = U64(0x9FB21C651E98DF25)
_UNROLL = U64(pow(0x9FB21C651E98DF25, -1, 2**64))


# ---------------------------------------------------------------- FM-index

class WaveletMatrix:
    """Rank of symbols in a sequence: one packed bit vector a level, with counts a 64-bit word."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(int(symbols - 1).bit_length(), 1)
        self.bits, self.counts, self.zeros = [], [], []
        current = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            packed = np.zeros(len(bit) // 64 + 1, U64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            counts = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.bits.append(packed)
            self.counts.append(counts)
            self.zeros.append(len(bit) - int(counts[-1]))
            current = np.concatenate([current[~bit], current[bit]])
        self.start = self._walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word, ones = place >> 6, self.counts[k]
            below = (U64(1) << (place & 63).astype(U64)) - U64(1)
            rank = ones[word] + np.bitwise_count(self.bits[k][word] & below).astype(np.int64)
            place = np.where((symbol >> level) & 1, self.zeros[k] + rank, place - rank)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._walk(symbol, place) - self.start[symbol]


class FMIndex:
    """Backward search for patterns of up to `depth` symbols; 0 is the separator."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.order = self._suffixes(text, depth)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.matrix = WaveletMatrix(text[self.order - 1], symbols)

    @staticmethod
    def _suffixes(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffix order by the first `depth` symbols or more, by prefix doubling."""
        rank, reach, n = text.astype(np.int64), 1, len(text)
        order = np.argsort(rank, kind="stable")
        while reach < depth:
            key = rank * (n + 1)
            key[:n - reach] += rank[reach:] + 1
            order = np.argsort(key, kind="stable")
            ahead = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], ahead[1:] != ahead[:-1]]))
            rank, reach = new, reach * 2
        return order

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of `symbol` followed by what [low, high) matches."""
        first = self.before[symbol]
        return first + self.matrix.rank(symbol, low), first + self.matrix.rank(symbol, high)


def earliest(words: list[np.ndarray], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each window of each word sequence, the smallest document of this shard that has it."""
    if not words:
        return []
    lengths = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    numbers = np.unique(flat, return_inverse=True)[1].astype(np.int64) + 1
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])  # a separator ends each sequence
    text = np.zeros(begin[-1], np.int64)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    text[inside] = numbers
    index = FMIndex(text, int(numbers.max()) + 1, window)
    owner = np.repeat(docs, lengths + 1)[index.order]

    counts = lengths - window + 1
    at = np.repeat(begin[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    found = np.repeat(docs, counts)
    live = np.arange(len(at))
    symbol = text[at + window - 1]
    low, high = index.before[symbol], index.before[symbol + 1]
    for back in range(window - 2, -1, -1):
        shared = high - low > 1  # otherwise only the window itself matches
        live, low, high = live[shared], low[shared], high[shared]
        if not len(live):
            break
        low, high = index.extend(text[at[live] + back], low, high)
    if len(live):
        starts, where = np.unique(low, return_inverse=True)
        ends = np.empty(len(starts), np.int64)
        ends[where] = high
        bounds = np.stack([starts, ends], axis=1).ravel()
        if bounds[-1] == len(owner):
            bounds = bounds[:-1]
        found[live] = np.minimum.reduceat(owner, bounds)[::2][where]
    return np.split(found, np.cumsum(counts)[:-1])


# ---------------------------------------------------------------- tasks

def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum of `width` values."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - reach:]) if reach < width else out


def _anchors(run: pa.RecordBatch, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, doc, mark, span) of the segments of these texts."""
    data, bounds = utf8(run.column("text"))
    starts, ends, first = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    if len(words) < window:
        return (np.empty(0, np.int64),) * 4
    row = np.repeat(np.arange(run.num_rows), np.diff(first))
    anchor = _smallest(gram_hashes(words, gram), window - gram + 1)
    valid = np.flatnonzero(row[:len(anchor)] == row[window - 1:])
    if not len(valid):
        return (np.empty(0, np.int64),) * 4
    anchor, row = anchor[valid], row[valid]
    new = np.concatenate([[True], (np.diff(valid) != 1) | (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])])
    start = np.flatnonzero(new)
    offset = np.arange(len(valid)) - np.repeat(start, np.diff(np.append(start, len(valid))))
    new |= offset % LONGEST == 0
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(valid)))
    anchor, row, place = anchor[start].view(np.int64), row[start], valid[start] - first[row[start]]
    doc = run.column("doc").to_numpy(zero_copy_only=False)[row].astype(np.int64)
    mark = run.column("mark").to_numpy(zero_copy_only=False)[row].astype(np.int64)
    return anchor, doc, mark, (place << 8) | count


def _minimisers(batches, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, salt, doc, mark, span), span = first word and count of windows.

    An anchor that several documents of a block have is known to be shared: its rows are
    dealt out by a salt, and two rows of no windows (salt 0), of the smallest and the largest
    document, tell the other blocks: at least one is not the document that they have."""
    caches.only("fm_dedup", {})
    for batch in batches:
        for block in slices(batch, "text", 8 << 20):
            anchor, doc, mark, span = (np.concatenate(c) for c in zip(*(_anchors(run, window, gram) for run in slices(block, "text", AT_ONCE))))
            if not len(anchor):
                continue
            order = np.argsort(anchor, kind="stable")
            anchor, doc, mark, span = anchor[order], doc[order], mark[order], span[order]
            begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            least, most = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
            many = least < most
            salt = np.where(np.repeat(many, np.diff(np.append(begin, len(anchor)))), 1 + (mix((doc ^ span).view(U64)) % U64(1 << 20)).astype(np.int32), 0)
            tell = np.repeat(begin[many], 2)
            ends = np.stack([least[many], most[many]], axis=1).ravel()
            yield _batch(["anchor", "salt", "doc", "mark", "span"], np.concatenate([anchor, anchor[tell]]), np.concatenate([salt, np.zeros(len(tell))]).astype(np.int32),
                         np.concatenate([doc, ends]), np.concatenate([mark, mark[tell]]), np.concatenate([span, np.zeros(len(tell), np.int64)]))


def _rolls(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each run words[begin:end], wherever it lies."""
    power = np.cumprod(np.concatenate([[U64(1)], np.full(len(words), _ROLL)]))
    inverse = np.cumprod(np.concatenate([[U64(1)], np.full(len(words), _UNROLL)]))
    out = []
    for values in (words, mix(words ^ _ROLL)):
        sums = np.concatenate([[U64(0)], np.cumsum(values * power[:-1])])
        out.append(((sums[end] - sums[begin]) * inverse[begin]).view(np.int64))
    return out[0], out[1]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each begins."""
    lengths = ends - starts
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(begin[-1], 0x20, np.uint8)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[inside + np.repeat(begin[:-1], lengths)] = data[inside + np.repeat(starts, lengths)]
    return out.tobytes(), begin


def _segments(batches, window: int) -> Iterator[pa.RecordBatch]:
    """The words of each listed segment of a document, joined by one space."""
    for batch in batches:
        for run in slices(batch, "text", AT_ONCE):
            data, bounds = utf8(run.column("text"))
            starts, ends, first = word_spans(data, bounds)
            words = word_hashes(data, starts, ends)
            raw, at = _joined(data, starts, ends)
            listed = run.column("listed")
            counts = listed.value_lengths().to_numpy()
            anchor, span = (listed.flatten().field(k).to_numpy() for k in ("anchor", "span"))
            begin = np.repeat(first[:-1], counts) + (span >> 8)
            end = begin + (span & 255) + window - 1
            texts = [raw[i:j - 1] for i, j in zip(at[begin].tolist(), at[end].tolist())]
            doc, mark = (np.repeat(run.column(c).to_numpy(), counts) for c in ("doc", "mark"))
            yield _batch(["doc", "mark", "place", "anchor", "h1", "h2", "segment"], doc, mark, span >> 8, anchor, *_rolls(words, begin, end), pa.array(texts, pa.binary()))


def _windows(batches, window: int) -> Iterator[pa.RecordBatch]:
    """Every window of a segment on its own."""
    for batch in batches:
        segments = batch.column("segment")
        data, bounds = utf8(segments)
        starts, ends, first = word_spans(data, bounds)
        words = word_hashes(data, starts, ends)
        counts = np.diff(first) - window + 1
        i = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.repeat(first[:-1], counts) + i
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(starts[begin].tolist(), ends[begin + window - 1].tolist())]
        h1, h2, doc = (np.repeat(batch.column(c).to_numpy(), counts) for c in ("h1", "h2", "first"))
        yield _batch(["h1", "h2", "i", "k1", "k2", "words", "first"], h1, h2, i, *_rolls(words, begin, begin + window), pa.array(texts, pa.binary()), doc)


def _search(table: pa.Table, window: int) -> pa.Table:
    """One shard: index its segments, stream them through it, report what can repeat."""
    table = table.combine_chunks()
    data, bounds = utf8(table.column("words"))
    starts, ends, first = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    docs, last = table.column("first").to_numpy(), table.column("last").to_numpy()
    found = earliest([words[a:b] for a, b in zip(first[:-1], first[1:])], docs, window)
    keep = np.array([last[i] > docs[i] or bool((m < docs[i]).any()) for i, m in enumerate(found)], bool)
    return pa.table({"k1": table.column("k1").filter(pa.array(keep)), "k2": table.column("k2").filter(pa.array(keep)),
                     "earliest": pa.array([m for m, k in zip(found, keep) if k], pa.list_(pa.int64()))})


def covered(starts: np.ndarray, words: int, window: int) -> np.ndarray:
    """Which words the windows at these starts cover."""
    step = np.zeros(words + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step[:-1]) > 0


def _digest(batches, window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in slices(batch, "text", AT_ONCE):
            total, gone, digest = [], [], []
            data, bounds = utf8(run.column("text"))
            begin, end, first = word_spans(data, bounds)
            raw, at = _joined(data, begin, end)
            for r, starts in enumerate(run.column("starts")):
                a, b = int(first[r]), int(first[r + 1])
                removed, kept = 0, raw[at[a]:max(at[b] - 1, at[a])]
                if starts.is_valid:
                    cut = covered(starts.values.to_numpy(), b - a, window)
                    removed, kept = int(cut.sum()), b" ".join([raw[at[i]:at[i + 1] - 1] for i in (a + np.flatnonzero(~cut)).tolist()])
                total.append(b - a)
                gone.append(removed)
                digest.append(hashlib.sha256(kept).hexdigest())
            yield _batch(["doc_id", "n_words", "n_removed", "kept_sha256"], run.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()))


def _cut(batches, window: int) -> Iterator[pa.RecordBatch]:
    """The text without its covered words; text between two kept words stays as it is, and
    the space after a cut goes with it."""
    for batch in batches:
        for run in slices(batch, "text", AT_ONCE):
            texts = []
            data, bounds = utf8(run.column("text"))
            begin, end, first = word_spans(data, bounds)
            raw = data.tobytes()
            for r, (text, starts) in enumerate(zip(run.column("text"), run.column("starts"))):
                if not starts.is_valid:
                    texts.append(text.as_py())
                    continue
                a, b = first[r], first[r + 1]
                gone = covered(starts.values.to_numpy(), b - a, window)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                out, at = [], bounds[r]
                for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    out.append(raw[at:begin[a + i]])
                    at = begin[a + j] if a + j < b else bounds[r + 1]
                texts.append(b"".join([*out, raw[at:bounds[r + 1]]]).decode())
            yield _batch(["row", "text"], run.column("row"), pa.array(texts, pa.string()))


# ---------------------------------------------------------------- operator

def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, text, a mark that tells rows of one id apart (0 while ids are unique), and the other columns."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc")).where("doc is not null")
    repeated = not ids.groupBy("doc").count().where("count > 1").isEmpty()
    mark = F.xxhash64(text_col) if repeated else F.lit(0).cast("long")
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    return docs.select(F.col(id_col).cast("long").alias("doc"), mark.alias("mark"), F.col(text_col).alias("text"), rest.alias("row"))


def repeated_windows(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, mark, starts): first words of the windows that a document with a smaller id also has;
    mark is xxhash64(text) if ids repeat, else 0.  Documents without any are left out."""
    return _repeated(_marked(docs, id_col, text_col), window)


def _repeated(marked: DataFrame, window: int) -> DataFrame:
    if window < 2:
        raise ValueError("a window has two words at least")
    gram = min(GRAM, window - 1)
    stage = Stage(marked.sparkSession, "fm-dedup")
    base = marked.select("doc", "mark", "text").where("doc is not null and text is not null")

    rows = base.mapInArrow(lambda it: _minimisers(it, window, gram), "anchor long, salt int, doc long, mark long, span long")
    within = Window.partitionBy("anchor", "salt")
    shared = rows.withColumns({"lo": F.min("doc").over(within), "hi": F.max("doc").over(within)})
    shared = shared.where("(salt > 0 or lo < hi) and span % 256 > 0")
    listed = shared.groupBy("doc", "mark").agg(F.collect_list(F.struct("anchor", "span")).alias("listed"))

    texts = base.join(listed, ["doc", "mark"]).select("doc", "mark", "text", "listed")
    held = stage(texts.mapInArrow(lambda it: _segments(it, window), "doc long, mark long, place long, anchor long, h1 long, h2 long, segment binary"))
    shards = max(1, -(-held.count() // SHARD_SEGMENTS))

    distinct = stage(held.groupBy("h1", "h2", "anchor", "segment").agg(F.min("doc").alias("first"), F.max("doc").alias("last")))
    hot = stage(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > HOT_SEGMENTS).select("anchor"))
    if hot.count() <= BROADCAST_ANCHORS:
        hot = F.broadcast(hot)
    cold = distinct.join(hot, "anchor", "left_anti").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("anchor").alias("route"), F.col("segment").alias("words"), "first", "last")
    single = distinct.join(hot, "anchor", "left_semi").select("h1", "h2", "segment", "first", "last")
    single = stage(single.mapInArrow(lambda it: _windows(it, window), "h1 long, h2 long, i long, k1 long, k2 long, words binary, first long"))
    alone = single.groupBy("k1", "k2", "words").agg(F.min("first").alias("first"))
    alone = alone.select("k1", "k2", F.col("k1").alias("route"), "words", "first", F.lit(2**63 - 1).alias("last"))

    sharded = cold.union(alone).withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    found = stage(sharded.groupBy("shard").applyInArrow(lambda t: _search(t, window), "k1 long, k2 long, earliest array<long>"))
    whole = found.join(single.select("k1", "k2").distinct(), ["k1", "k2"], "left_anti").toDF("h1", "h2", "earliest")
    parts = single.select("h1", "h2", "i", "k1", "k2").join(found, ["k1", "k2"]).select("h1", "h2", F.struct("i", F.col("earliest")[0].alias("m")).alias("w"))
    parts = parts.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("w")).alias("ws")).select("h1", "h2", F.col("ws.m").alias("earliest"))

    hits = held.select("doc", "mark", "place", "h1", "h2").join(whole.union(parts), ["h1", "h2"])
    first = F.transform("earliest", lambda m, i: F.when(m < F.col("doc"), F.col("place") + i))
    hits = hits.select("doc", "mark", F.array_compact(first).alias("starts")).where("size(starts) > 0")
    out = stage(hits.groupBy("doc", "mark").agg(F.flatten(F.collect_list("starts")).alias("starts")))
    stage.release(held, distinct, single, found)
    return out


def repeat_digests(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    marked = _marked(docs, id_col, text_col)
    both = marked.select("doc", "mark", "text").join(_repeated(marked, window), ["doc", "mark"], "left")
    return both.select(F.col("doc").alias("doc_id"), "text", "starts").mapInArrow(lambda it: _digest(it, window), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, in its columns, with repeated windows cut from the text; a text
    without any stays byte for byte, and a text that was all repeats becomes empty."""
    marked = _marked(docs, id_col, text_col)
    both = marked.join(_repeated(marked, window), ["doc", "mark"], "left").select("row", "text", "starts")
    kept = T.StructType([both.schema["row"], both.schema["text"]])
    cut = both.mapInArrow(lambda it: _cut(it, window), kept)
    return cut.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))
