"""Importance resampling of a corpus towards a target, by hashed n-gram features.

Texts are lower-cased in ASCII and cut by an untrained pre-tokeniser (a Regex Split of the
tokenizers library), which returns every word with its byte offsets.  A feature is one word,
or two neighbouring words joined by one space; windows of offset pairs feed the bytes of all
features of a run of texts into CRC-32 at once, a byte column at a time.  The CRC modulo the
number of buckets is the feature's bucket.

One pass over the corpus writes each document's sorted buckets and each partition's
histogram; the target is only counted.  A bucket's gain is 1000 ln of how much likelier it
is in the target, floored; a document's weight is the floored mean of its features' gains.
Drawing without replacement in proportion to exp(weight / 1000) is taking the highest
weight + Gumbel noise, with noise from a hash of the document's id.  The draw is by a
distributed row number; nothing but bucket counts and one count a partition leaves the executors.

Null and empty texts have no words: no features, weight 0, and, below the least number of
words, never drawn.  Texts are read whole, in blocks cut between words.  Rows are drawn each
for itself, so repeated ids may be drawn more than once, and tie; a null id is hashed as an
empty one and comes last among ties.  An empty table gives no rows, an empty target the
gains of zero counts.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsflow.llm.staging import Stage
from oddsflow.llm.words import slices, utf8
from oddsflow.operators.ranks import global_row_number

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
BLOCK = 1 << 15        # bytes of text given to the pre-tokeniser at once
COLUMNS = 64           # bytes of a word fed column by column; longer words are finished one by one
STAGED = "doc_id long, n_words long, n_features long, buckets binary, counts array<long>"

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 register of each span after its bytes data[start:end], from the register before."""
    long = ends - starts
    order = np.argsort(-long, kind="stable")
    state, at, left = state[order], starts[order], np.sort(long)
    for k in range(min(int(left[-1]), COLUMNS) if len(left) else 0):
        live = len(left) - int(np.searchsorted(left, k, "right"))
        now = state[:live]
        state[:live] = _CRC[(now ^ data[at[:live] + k]) & 0xFF] ^ (now >> 8)
    for i in range(len(left) - int(np.searchsorted(left, COLUMNS, "right"))):
        rest = data[at[i] + COLUMNS:ends[order[i]]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state
    return out


class Featurizer:
    """Buckets of the features of whole texts."""

    def __init__(self, buckets: int = BUCKETS):
        from tokenizers import Regex, pre_tokenizers

        self.cutter, self.buckets = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True), buckets

    def _blocks(self, data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Spans of about BLOCK bytes that no word crosses."""
        while lo < hi:
            end = min(lo + BLOCK, hi)
            if end < hi and _INSIDE[data[end]]:
                apart = np.flatnonzero(~_INSIDE[data[lo:end]])
                if len(apart):
                    end = lo + int(apart[-1]) + 1
                else:  # one long word
                    while end < hi and not len(apart := np.flatnonzero(~_INSIDE[data[end:min(end + BLOCK, hi)]])):
                        end = min(end + BLOCK, hi)
                    end += int(apart[0]) if end < hi else 0
            yield lo, end
            lo = end

    def words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets (starts, ends) of the words of all rows."""
        from tokenizers import PreTokenizedString

        starts, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
            for a, b in self._blocks(data, lo, hi):
                text = PreTokenizedString(data[a:b].tobytes().decode())
                self.cutter.pre_tokenize(text)
                pairs = [span for _, span, _ in text.get_splits(offset_referential="original", offset_type="byte")]
                if pairs:
                    spans = np.array(pairs, np.int64) + a
                    starts.append(spans[:, 0])
                    ends.append(spans[:, 1])
        return np.concatenate(starts), np.concatenate(ends)

    def rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket) of every feature, and the words of each row."""
        data, bounds = utf8(pc.ascii_lower(column))
        starts, ends = self.words(data, bounds)
        row = np.searchsorted(bounds, starts, "right") - 1
        one = feed(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
        pair = np.flatnonzero(row[1:] == row[:-1])  # windows of two offset pairs of one row
        space = _CRC[(one[pair] ^ 0x20) & 0xFF] ^ (one[pair] >> 8)
        two = feed(space, data, starts[pair + 1], ends[pair + 1])
        crc = np.concatenate([one, two]) ^ np.uint32(0xFFFFFFFF)
        return np.concatenate([row, row[pair]]), (crc % self.buckets).astype(np.int64), np.bincount(row, minlength=len(column))


def _featurize(batches, buckets: int, keep: bool) -> Iterator[pa.RecordBatch]:
    """A row a document (if kept), then one row of this partition's bucket counts."""
    featurizer, total = Featurizer(buckets), np.zeros(buckets, np.int64)
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())
    names = ["doc_id", "n_words", "n_features", "buckets", "counts"]
    for batch in batches:
        for run in slices(batch, "text", 2 << 20):
            row, bucket, words = featurizer.rows(run.column("text"))
            total += np.bincount(bucket, minlength=buckets)
            if not keep:
                continue
            key = np.sort(row * buckets + bucket)
            row, bucket = key // buckets, key % buckets
            bounds = np.searchsorted(row, np.arange(run.num_rows + 1))
            step = np.diff(bucket, prepend=0)
            first = bounds[:-1][np.diff(bounds) > 0]
            step[first] = bucket[first]  # sorted buckets as steps: small numbers, which pack well
            step = step.astype("<u2" if buckets <= 1 << 16 else "<u4")
            cells = [step[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(words, pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(cells, pa.binary()),
                                              pa.nulls(run.num_rows, kinds[4])], names)
    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((None, None, None, None, total.tolist()), kinds)], names)


def features(texts: DataFrame, buckets: int = BUCKETS, keep: bool = True) -> DataFrame:
    """Rows of documents (doc_id, text) and of bucket counts, as STAGED."""
    return texts.mapInArrow(lambda it: _featurize(it, buckets, keep), STAGED)


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features a bucket; as many numbers as buckets, whatever the data."""
    counts = featured.where("counts is not null").select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Of each bucket: 1000 ln of its smoothed share in the target over that in the corpus, floored."""
    total_s, total_t, size = float(sum(corpus)), float(sum(target)), float(len(corpus))
    return [math.floor(1000 * math.log((t + 1.0) * (total_s + size) / ((s + 1.0) * (total_t + size)))) for s, t in zip(corpus, target)]


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches, gain: list[int], seed: int) -> Iterator[pa.RecordBatch]:
    gain = np.array(gain, np.int64)
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    for batch in batches:
        n = batch.column("n_features").to_numpy()
        ends = np.cumsum(n)
        step = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), kind).astype(np.int64)
        run = np.cumsum(step)
        base = np.repeat(np.concatenate([[0], run])[ends - n], n)  # what the steps of earlier rows add up to
        sums = np.concatenate([[0], np.cumsum(gain[run - base])])
        weight = np.where(n > 0, (sums[ends] - sums[ends - n]) // np.maximum(n, 1), 0)
        ids = batch.column("doc_id").to_pylist()
        score = weight + np.array([noise(i, seed) for i in ids], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                                         ["doc_id", "n_words", "n_features", "weight", "score"])


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document; rank is 1, 2, 3... for the
    `percent` of those with at least `least_words` words that are drawn, null for the others."""
    stage = Stage(docs.sparkSession, "importance")
    corpus = stage(features(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), buckets))
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_col).alias("text")), buckets, keep=False)
    gain = gains(histogram(corpus, buckets), histogram(wanted, buckets))
    rows = corpus.where("counts is null").select("doc_id", "n_words", "n_features", "buckets")
    scored = stage(rows.mapInArrow(lambda it: _score(it, gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"))
    out = ["doc_id", "n_features", "weight", "score"]
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features")]
    ranked = global_row_number(able.select(*out), order, "place", stage)
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    rest = scored.where(F.col("n_words") < least_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank).unionByName(rest)
