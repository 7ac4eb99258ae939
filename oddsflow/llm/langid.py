"""Language identification by interpolated Kneser-Ney character models.

Text is lower-cased and everything but letters and marks becomes one space.  Each
language has a model of character 4-grams: absolute discounting, lower orders from the
number of different characters seen before, interpolated down to a uniform distribution.
All languages share sorted hash arrays, one an order, whose rows hold the log probability
in every language, so one binary search serves all.  A document gets the language of
lowest cross-entropy per character.

The classifier is fitted on a bounded sample of labelled rows: DOCS whole documents a
language, by a hash of their id; one in five of them is held back to calibrate rejection: a
document is rejected if its cross-entropy exceeds all that were held back of its language by
a margin, wider for short texts.  ALPHABET characters and GRAMS 4-grams a language are
kept at most, the most frequent ones.  Everything else covers whole texts of all rows.

A null text, or one without a letter, is `und`, score 0, rejected.  If no labelled row
exists every document is `und`.  Equal cross-entropies go to the first language by name.
Rows are judged by their text alone; repeated rows and null ids need no rule.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsflow.llm import caches
from oddsflow.llm.staging import Stage
from oddsflow.llm.words import slices, utf8

ORDER, BITS = 4, 11
DOCS = 300            # sampled documents a language, at most
ALPHABET = 2_000      # characters with a code of their own; others share one
GRAMS = 200_000       # 4-grams a language
MARGIN = 0.5          # nats a character beyond the worst that was held back
AT_ONCE = 1 << 20     # bytes of text judged at once: some dozens of bytes of memory a character
UNKNOWN = "und"
_SPACE, _OTHER = 1, 2  # codes; characters follow from 3
_MASK = (1 << BITS * ORDER) - 1
_SPREAD = 0x9E3779B97F5  # odd: multiplying by it modulo a power of two is a bijection

_tables: dict = {}


def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: its lower case, whether it is a letter, whether it is a letter or mark."""
    if "fold" not in caches.only("langid", _tables):
        size = sys.maxunicode + 1
        kinds = np.array([unicodedata.category(chr(i))[0] for i in range(size)])
        fold = np.arange(size, dtype=np.uint32)
        for i in np.flatnonzero(kinds == "L"):
            low = chr(i).lower()
            fold[i] = ord(low) if len(low) == 1 else i
        _tables["fold"] = fold, kinds == "L", (kinds == "L") | (kinds == "M")
    return _tables["fold"]


def _normalised(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, row of each, whether a row has a letter): letters and marks, runs of others as one space (0)."""
    fold, letter, kept = _characters()
    data, bounds = utf8(batch.column("text"))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
    has = np.zeros(batch.num_rows, bool)
    has[row[letter[points]]] = True
    out = np.where(kept[points], fold[points], 0)
    again = np.concatenate([[True], (out[:-1] == 0) & (row[1:] == row[:-1]) | (row[1:] != row[:-1])]) if len(out) else np.empty(0, bool)
    stay = (out != 0) | ~again  # leading and repeated spaces go
    return out[stay], row[stay], has


def _grams(codes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The packed 4-gram that ends at each character; a row starts after spaces."""
    place = np.arange(len(codes)) + (ORDER - 1) * (row + 1)
    line = np.full((place[-1] + 1) if len(place) else 0, _SPACE, np.int64)
    line[place] = codes
    out = np.zeros(len(codes), np.int64)
    for back in range(ORDER - 1, -1, -1):
        out = (out << BITS) | line[place - back]
    return out


def _hash(grams: np.ndarray, order: int) -> np.ndarray:
    return (grams.astype(np.uint64) * np.uint64(_SPREAD)) & np.uint64((1 << BITS * order) - 1)


class Model:
    """Sorted hash arrays with a column a language."""

    def __init__(self, languages: list[str], alphabet: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts: packed 4-grams and how often they occur, for each language."""
        self.languages, self.alphabet = languages, np.sort(alphabet)
        self.rank = 3 + np.argsort(np.argsort(self.alphabet))
        n = len(languages)
        self.keys, self.values, self.contexts, self.weights = [None] * ORDER, [None] * ORDER, [None] * ORDER, [None] * ORDER
        levels = {ORDER: counts}
        for order in range(ORDER - 1, 0, -1):  # continuation counts: different characters seen before
            levels[order] = [np.unique(g & ((1 << BITS * order) - 1), return_counts=True) for g, _ in levels[order + 1]]
        uniform = 1.0 / (len(alphabet) + 3)
        lower_keys, lower = np.zeros(1, np.int64), np.full((1, n), uniform)
        for order in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([g for g, _ in levels[order]])) if n else np.empty(0, np.int64)
            context = keys >> BITS
            names, at = np.unique(context, return_inverse=True)
            below = lower[np.searchsorted(lower_keys, keys & ((1 << BITS * (order - 1)) - 1))]
            probability, weight = np.empty((len(keys), n)), np.empty((len(names), n))
            for l, (grams, count) in enumerate(levels[order]):
                own = np.zeros(len(keys))
                own[np.searchsorted(keys, grams)] = count
                once, twice = (count == 1).sum(), (count == 2).sum()
                discount = once / (once + 2 * twice) if once and twice else 0.75
                total, kinds = np.bincount(at, own, len(names)), np.bincount(at, own > 0, len(names))
                weight[:, l] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                probability[:, l] = np.maximum(own - discount, 0) / np.maximum(total, 1)[at] + weight[at, l] * below[:, l]
            lower_keys, lower = keys, probability
            self.keys[order - 1], self.values[order - 1] = self._sorted(keys, np.log(probability), order)
            self.contexts[order - 1], self.weights[order - 1] = self._sorted(names, np.log(weight), order - 1)
        self.uniform = np.log(uniform)
        self.limits = np.full(n, np.inf)

    @staticmethod
    def _sorted(keys: np.ndarray, values: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        hashes = _hash(keys, order)
        at = np.argsort(hashes)
        return hashes[at], values[at].astype(np.float32)

    @staticmethod
    def _find(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(hashes):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return at, hashes[at] == wanted

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """log p of the last character of each 4-gram, a column a language."""
        out, left = np.zeros((len(grams), len(self.languages))), np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            grams = grams & ((1 << BITS * order) - 1)
            at, seen = self._find(self.keys[order - 1], _hash(grams, order))
            out[left[seen]] += self.values[order - 1][at[seen]]
            left, grams = left[~seen], grams[~seen]
            at, seen = self._find(self.contexts[order - 1], _hash(grams >> BITS, order - 1))
            out[left[seen]] += self.weights[order - 1][at[seen]]
        out[left] += self.uniform
        return out

    def codes(self, characters: np.ndarray) -> np.ndarray:
        at, seen = self._find(self.alphabet, characters)
        return np.where(characters == 0, _SPACE, np.where(seen, self.rank[at] if len(self.rank) else _OTHER, _OTHER))

    def entropies(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy per character by row and language, characters, whether it has a letter)."""
        characters, row, has = _normalised(batch)
        lengths = np.bincount(row, minlength=batch.num_rows)
        # Equal 4-grams of a row are looked up once, in hash order.
        key = (_hash(_grams(self.codes(characters), row), ORDER) << np.uint64(20)) | row.astype(np.uint64)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        hashes, rows = key[first] >> np.uint64(20), (key[first] & np.uint64((1 << 20) - 1)).astype(np.int64)
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.empty(0, bool)
        inverse = np.uint64(pow(_SPREAD, -1, 1 << BITS * ORDER))
        values = self.log_probabilities(((hashes[new] * inverse) & np.uint64(_MASK)).astype(np.int64))[np.cumsum(new) - 1]
        sums = np.stack([np.bincount(rows, count * values[:, l], batch.num_rows) for l in range(len(self.languages))], axis=1) if self.languages else np.zeros((batch.num_rows, 0))
        return -sums / np.maximum(lengths, 1)[:, None], lengths, has

    def judge(self, batch: pa.RecordBatch) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, cross-entropy, rejected) of each row."""
        entropy, lengths, has = self.entropies(batch)
        if not self.languages:
            return [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        share = 1 / np.exp(-(entropy - least[:, None]) * np.minimum(lengths, 30)[:, None]).sum(axis=1)
        rejected = ~has | (least > self.limits[best] + MARGIN + 8 / np.sqrt(np.maximum(lengths, 1)))
        return [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, share, 0.0), np.where(has, least, 0.0), rejected


def _count_characters(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in slices(batch, "text"):
            found, count = np.unique(_normalised(run)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found[found > 0].astype(np.int64)), pa.array(count[found > 0].astype(np.int64))], ["point", "n"])


def _count_grams(batches, alphabet: np.ndarray) -> Iterator[pa.RecordBatch]:
    coder = Model([], alphabet, [])
    for batch in batches:
        for run in slices(batch, "text"):
            characters, row, _ = _normalised(run)
            langs = run.column("lang").to_numpy(zero_copy_only=False)
            grams = _grams(coder.codes(characters), row)
            names, at = np.unique(langs.astype(str), return_inverse=True)
            for l, name in enumerate(names):
                found, count = np.unique(grams[at[row] == l], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(found), pa.string()), pa.array(found), pa.array(count)], ["lang", "gram", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows with text and a non-null language; only a bounded sample of them is read."""
    stage = Stage(labelled.sparkSession, "langid")
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null and text is not null")
    ids = rows.select("id", "lang").distinct().withColumn("h", F.xxhash64("id"))
    # The first DOCS by hash, in two steps: a common language is cut down in many tasks first.
    part = Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h", "id")
    ids = ids.withColumn("n", F.row_number().over(part)).where(F.col("n") <= DOCS)
    order = Window.partitionBy("lang").orderBy("h", "id")
    chosen = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= DOCS).select("id", "lang", "n")
    sample = stage(rows.join(F.broadcast(chosen), ["id", "lang"]).select("text", "lang", (F.col("n") % 5 == 0).alias("held")))
    learn = sample.where("not held")
    points = learn.select("text").mapInArrow(_count_characters, "point long, n long").groupBy("point").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "point").limit(ALPHABET).toPandas()
    alphabet = points["point"].to_numpy(np.uint32)
    grams = learn.select("text", "lang").mapInArrow(lambda it: _count_grams(it, alphabet), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    common = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    grams = grams.withColumn("r", common).where(F.col("r") <= GRAMS).select("lang", "gram", "n").toPandas()
    languages = sorted(grams["lang"].unique())
    counts = []
    for name in languages:
        own = grams[grams["lang"] == name].sort_values("gram")
        counts.append((own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.float64)))
    model = Model(languages, alphabet, counts)

    def held_back(batches):
        for batch in batches:
            for run in slices(batch, "text"):
                entropy, lengths, has = model.entropies(run)
                for name, e, n, h in zip(run.column("lang").to_pylist(), entropy, lengths, has):
                    if h and n >= 50 and name in languages:
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([float(e[languages.index(name)])])], ["lang", "worst"])

    if languages:
        worst = sample.where("held").select("text", "lang").mapInArrow(held_back, "lang string, worst double").groupBy("lang").agg(F.max("worst").alias("worst")).collect()  # one row a language
        limits = {r.lang: r.worst for r in worst}
        model.limits = np.array([limits.get(name, max(limits.values(), default=np.inf)) for name in languages])
    return model


def _predict(batches, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in slices(batch, "text", AT_ONCE):
            lang, score, entropy, rejected = model.value.judge(run)
            yield pa.RecordBatch.from_arrays([run.column("row"), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected), run.column("text")],
                                             ["row", "lang_pred", "score", "cross_entropy", "rejected", "text"])


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, text, lang_pred, score, cross_entropy, rejected) for every row; row holds its other columns."""
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ALPHABET, GRAMS and the languages
    kind = T.StructType([base.schema["row"], *T._parse_datatype_string("lang_pred string, score double, cross_entropy double, rejected boolean, text string")])
    return base.mapInArrow(lambda it: _predict(it, shared), kind)
