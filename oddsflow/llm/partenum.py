"""Exact Jaccard self-join of word-shingle sets by PartEnum signatures.

Sets are dealt into size bands whose upper end is the lower end divided by the
threshold, so two linked sets lie in the same band or in neighbouring ones, and
every set signs for its own band and the next.  Within a band, linked sets differ
in at most ``k`` features.  The feature domain is hashed into ``n1`` parts of
``n2`` sub-parts; a part with at most ``k2`` differences has ``n2 - k2`` sub-parts
that agree, and every such subset is one signature.  ``n1`` exceeds what the
pigeonhole needs by ``spare`` parts: a set with at most that many empty subsets
may leave those out (they would be shared by unrelated sets) and still share a
filled one with each linked set; a set with more of them signs the empty ones too.
So no link is lost, whatever the data.

Signatures are joined through a leader per signature, never as all pairs of a
bucket: members are first compared with the leader.  Members of a signature that
still lie in different components afterwards are compared by compact sketches, which
rule a pair out only if it cannot link; what they leave forms small clusters of
documents that may link, given as spanning edges, and each cluster is settled on its
full sets in blocks, which yields only the links that join components.  Every link is
verified on the full sets with integer arithmetic.

Null or empty texts, and texts of separators only, have no set and link with
nothing.  Repeated rows of one id make one document (its sets must agree; the
first by order is taken).  Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsflow.llm.staging import Stage, components
from oddsflow.llm.words import U64, gram_hashes, mix, slices, utf8, word_hashes, word_spans

FEATURES = 5.0  # features that a signature should cover, on average: fewer make fewer signatures, and more candidates

AT_ONCE = 1 << 20  # bytes of text split into words, or turned into sets, at once


def band_top(low: int, num: int, den: int) -> int:
    return low * den // num


@lru_cache(maxsize=None)
def band_of(size: int, num: int, den: int) -> tuple[int, int, int, int]:
    """(band, lowest size, highest size, lowest size of the band below)."""
    band, below, low = 0, 1, 1
    while band_top(low, num, den) < size:
        band, below, low = band + 1, low, band_top(low, num, den) + 1
    return band, low, band_top(low, num, den), below


@lru_cache(maxsize=None)
def plan_of(band_low: int, band_high: int, below: int, num: int, den: int, cover: float = FEATURES) -> tuple | None:
    """(n1, n2, k2, spare) of a band, or None if only equal sets link there."""
    k = (den - num) * 2 * band_high // (den + num)
    if k == 0:
        return None
    best = None
    for k2 in range(0, min(k, 4) + 1):
        for n2 in range(k2 + 1, k2 + 6):
            subsets, need, spare = math.comb(n2, k2), k // (k2 + 1) + 1, 0
            for _ in range(6):  # more parts are emptier, and empty ones need spare parts
                empty = (need + spare) * subsets * (1 - (n2 - k2) / ((need + spare) * n2)) ** below
                spare = math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.02 else 0
            if spare > need + 1:
                spare = 0  # small sets: the empty subsets are signed instead
            covered = band_low * (n2 - k2) / ((need + spare) * n2)
            cost = (need + spare) * subsets * max(1.0, cover / covered) ** 4 * (1 + 8 * empty * (spare == 0))
            if best is None or cost < best[0]:
                best = (cost, (need + spare, n2, k2, spare))
    return best[1]


@lru_cache(maxsize=None)
def _subsets(n2: int, k2: int) -> np.ndarray:
    return np.array(list(combinations(range(n2), n2 - k2)))


def signatures(features: np.ndarray, num: int, den: int, cover: float = FEATURES) -> np.ndarray:
    """All signatures of one set of 64-bit features."""
    if not len(features):
        return np.empty(0, U64)
    band, low, high, below = band_of(len(features), num, den)
    spread = mix(features ^ U64(0x9E3779B97F4A7C15))
    place = (spread >> U64(20)) & U64(0xFFFFFFFFFF)
    out = []
    for b, lo, hi, under in ((band, low, high, below), (band + 1, high + 1, band_top(high + 1, num, den), low)):
        plan = plan_of(lo, hi, under, num, den, cover)
        if plan is None:
            continue
        n1, n2, k2, spare = plan
        part = (place % U64(n1 * n2)).astype(np.int64)
        sums = np.zeros(n1 * n2, U64)
        np.add.at(sums, part, spread)
        counts = np.bincount(part, minlength=n1 * n2)
        pick = _subsets(n2, k2)
        sig = sums.reshape(n1, n2)[:, pick].sum(axis=2, dtype=U64)
        filled = counts.reshape(n1, n2)[:, pick].sum(axis=2) > 0
        tag = np.arange(sig.size, dtype=U64).reshape(sig.shape) + U64(b << 32)
        sig = mix(sig ^ mix(tag))
        if (~filled).any(axis=1).sum() <= spare:
            sig = sig[filled]
        out.append(sig.ravel())
    return np.concatenate(out) if out else np.empty(0, U64)


def shingle_sets(batch: pa.RecordBatch, text: str, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-word shingles of each row; fewer words make one shingle."""
    for run in slices(batch, text, AT_ONCE):
        data, bounds = utf8(run.column(text))
        starts, ends, first = word_spans(data, bounds)
        words = word_hashes(data, starts, ends, lower=True)
        for i in range(run.num_rows):
            own = words[first[i]:first[i + 1]]
            yield np.unique(gram_hashes(own, min(n, len(own)))) if len(own) else np.empty(0, U64)


def _identity(features: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, independent of order."""
    spread = mix(features ^ U64(0xD6E8FEB86659FD93))
    return int(features.sum(dtype=U64).view(np.int64)), int(spread.sum(dtype=U64).view(np.int64))


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _sizes(batches, n: int):
    """doc_id, size and identity of each row's set."""
    for batch in batches:
        rows = [(len(s), *_identity(s)) for s in shingle_sets(batch, "text", n)]
        size, h1, h2 = zip(*rows) if rows else ((), (), ())
        yield _batch(["doc_id", "n", "h1", "h2"], batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()))


PER_BLOCK = 1 << 20  # signatures pre-aggregated at once in a task


def _sign(batches, n: int, num: int, den: int, cover: float):
    """Rows (sig, salt, doc, first): the first document of a block that has a signature
    stands for it (salt 0, first null); others of the block point at that first one and
    are dealt out by a salt, so a very common signature is no hot key."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        sigs, docs, held, seen = [], [], 0, set()
        for doc, features in zip(ids, shingle_sets(batch, "text", n)):
            if not len(features) or (key := _identity(features)) in seen:
                continue  # a copy within the block: its class stands for it
            seen.add(key)
            own = signatures(features, num, den, cover)
            sigs.append(own)
            docs.append(np.full(len(own), doc, np.int64))
            held += len(own)
            if held >= PER_BLOCK:
                yield _block(sigs, docs)
                sigs, docs, held, seen = [], [], 0, set()
        if held:
            yield _block(sigs, docs)


def _block(sigs: list, docs: list) -> pa.RecordBatch:
    sig, doc = np.concatenate(sigs).view(np.int64), np.concatenate(docs)
    order = np.argsort(sig, kind="stable")
    sig, doc = sig[order], doc[order]
    new = np.empty(len(sig), bool)
    new[:1] = True
    np.not_equal(sig[1:], sig[:-1], out=new[1:])
    first = doc[np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))]
    keep = new | (first != doc)
    sig, doc, first, new = sig[keep], doc[keep], first[keep], new[keep]
    salt = np.where(new, 0, 1 + (mix(doc.view(U64)) % U64(1 << 20)).astype(np.int32)).astype(np.int32)
    return _batch(["sig", "salt", "doc", "first"], sig, salt, doc, pa.array(first, mask=new))


def _store(batches, n: int):
    for run in (run for batch in batches for run in slices(batch, "text", AT_ONCE)):
        sets = list(shingle_sets(run, "text", n))
        size, h1, h2 = zip(*((len(s), *_identity(s)) for s in sets))
        yield _batch(["doc", "n", "h1", "h2", "features"], run.column("doc_id"), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()))


def _parts(size: int, num: int, den: int) -> int:
    """Parts of the sketch of a set of this size: a power of two, twice the differences or more."""
    _, _, high, _ = band_of(size, num, den)
    return 1 << (2 * max((den - num) * 2 * high // (den + num), 4)).bit_length()


def sketch(features: np.ndarray, parts: int) -> np.ndarray:
    """One byte for each part of the feature domain, additive: it can differ only if the part's
    features do, and the two halves of a sketch add up to the sketch of half as many parts."""
    spread = mix(features ^ U64(0xA0761D6478BD642F))
    sums = np.zeros(parts, U64)
    np.add.at(sums, ((spread >> U64(30)) & U64(parts - 1)).astype(np.int64), spread)
    return sums.astype(np.uint8)


def fold(sketches: np.ndarray, parts: int) -> np.ndarray:
    """Sketches (rows) at a coarser resolution."""
    return sketches.reshape(len(sketches), -1, parts).sum(axis=1, dtype=np.uint8)


def _sketches(batches, num: int, den: int):
    for batch in batches:
        out = [sketch(np.frombuffer(raw.as_buffer(), U64), _parts(n, num, den)).tobytes() for raw, n in zip(batch.column("features"), batch.column("n").to_pylist())]
        yield _batch(["doc", "n", "sketch"], batch.column("doc"), batch.column("n"), pa.array(out, pa.binary()))


def _near(batches, num: int, den: int):
    """Pairs that sizes and sketches do not rule out: no more parts may differ than features of linked sets."""
    for batch in batches:
        keep = []
        for n1, s1, n2, s2 in zip(*(batch.column(c).to_pylist() for c in ("n", "sketch", "n_b", "sketch_b"))):
            fits = min(n1, n2) * den >= num * max(n1, n2)
            if fits:
                parts = min(len(s1), len(s2))
                one, two = (fold(np.frombuffer(s, np.uint8)[None], parts)[0] for s in (s1, s2))
                fits = np.count_nonzero(one != two) <= (den - num) * (n1 + n2) // (den + num)
            keep.append(fits)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(batches, num: int, den: int):
    """Pairs whose sets link, by exact counts."""
    for batch in batches:
        keep = []
        for raw_a, raw_b in zip(batch.column("features"), batch.column("features_b")):
            a, b = np.frombuffer(raw_a.as_buffer(), U64), np.frombuffer(raw_b.as_buffer(), U64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(den * both >= num * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


BROADCAST_IDS = 1_000_000  # candidate ids (16 MB) up to which texts need no shuffle to be looked up
BLOCK = 512  # members of a signature, or of a cluster, compared with each other in one place
BLOCK_BYTES = 16 << 20  # and the size of their sets


def _groups(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by integer keys: a table and where its groups begin.  A group
    that continues in the next batch is carried over (blocks bound its size)."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        values = np.stack([table.column(c).to_numpy() for c in keys])
        starts = np.flatnonzero(np.r_[True, (values[:, 1:] != values[:, :-1]).any(axis=0)])
        rest = table.slice(starts[-1])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
    if rest is not None:
        yield rest, np.zeros(1, int)


class _Forest:
    """Union-find over any labels."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (up := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(up, up)
            x = up
        return x

    def union(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _cross(batches, num: int, den: int):
    """Candidate edges between members of one signature that lie in different components: pairs that
    sizes and sketches do not rule out, as a spanning forest of each block pair (left against right)."""
    for table, starts in _groups(batches, ["sig", "x", "y"]):
        doc, comp, size, side = (table.column(c).to_numpy() for c in ("doc", "comp", "n", "side"))
        raw, edges = table.column("sketch").to_pylist(), set()
        for begin, end in zip(starts, [*starts[1:], len(table)]):
            forest, right = _Forest(), {}
            for i in range(begin, end):
                if side[i] == 1:
                    right.setdefault(len(raw[i]), []).append(i)
            right = {w: (np.array(rows), np.frombuffer(b"".join([raw[i] for i in rows]), np.uint8).reshape(-1, w)) for w, rows in right.items()}
            for i in range(begin, end):
                if side[i] == 1:
                    continue
                own = np.frombuffer(raw[i], np.uint8)[None]
                for width, (rows, matrix) in right.items():
                    fits = np.flatnonzero((comp[rows] != comp[i]) & (np.minimum(size[rows], size[i]) * den >= num * np.maximum(size[rows], size[i])))
                    if len(fits):
                        parts = min(width, own.shape[1])
                        differ = np.count_nonzero(fold(matrix[fits], parts) != fold(own, parts), axis=1)
                        for j in rows[fits[differ <= (den - num) * (size[rows[fits]] + size[i]) // (den + num)]].tolist():
                            if forest.union(int(doc[i]), int(doc[j])):
                                edges.add((min(doc[i], doc[j]), max(doc[i], doc[j])))
        a, b = zip(*edges) if edges else ((), ())
        yield _batch(["a", "b"], pa.array(a, pa.int64()), pa.array(b, pa.int64()))


def _settle(batches, num: int, den: int):
    """Links between blocks x and y of one cluster that join two components not joined before, by
    exact counts on the sets; sketches rule most pairs out first."""
    for table, starts in _groups(batches, ["cluster", "x", "y"]):
        doc, comp, size, block, x, y = (table.column(c).to_numpy() for c in ("doc", "comp", "n", "block", "x", "y"))
        raw, a, b = table.column("features"), [], []
        for begin, end in zip(starts, [*starts[1:], len(table)]):
            forest = _Forest()
            sets = [np.frombuffer(raw[i].as_buffer(), U64) for i in range(begin, end)]
            parts = _parts(int(size[begin:end].max()), num, den)
            sketches = np.stack([sketch(s, parts) for s in sets])
            length, own, place = size[begin:end], comp[begin:end], np.arange(end - begin)
            apart, other = x[begin] != y[begin], block[begin:end] == y[begin]
            for i in range(end - begin):
                if apart and other[i]:
                    continue
                fits = (other if apart else place > i) & (np.minimum(length, length[i]) * den >= num * np.maximum(length, length[i]))
                fits = np.flatnonzero(fits & (own != own[i]))
                if not len(fits):
                    continue
                fits = fits[np.count_nonzero(sketches[fits] != sketches[i], axis=1) <= (den - num) * (length[fits] + length[i]) // (den + num)]
                for k in range(0, len(fits), 32):
                    some = [j for j in fits[k:k + 32].tolist() if forest.root(int(own[j])) != forest.root(int(own[i]))]
                    if not some:
                        continue
                    features = np.concatenate([sets[j] for j in some])
                    at = np.minimum(np.searchsorted(sets[i], features), len(sets[i]) - 1)
                    both = np.add.reduceat((sets[i][at] == features).astype(np.int64), np.concatenate([[0], np.cumsum(length[some])[:-1]]))
                    for j in np.array(some)[den * both >= num * (length[some] + length[i] - both)].tolist():
                        if forest.union(int(own[i]), int(own[j])):
                            a.append(doc[begin + i])
                            b.append(doc[begin + j])
        yield _batch(["a", "b"], pa.array(a, pa.int64()), pa.array(b, pa.int64()))


SKETCH = "doc long, n long, sketch binary"


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", cover: float = FEATURES) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row per document.

    Documents link when ``den * |A and B| >= num * |A or B|`` for their sets of
    lower-cased n-word shingles; ``class_id`` is the smallest id with an equal set and
    ``component_id`` the smallest id reachable by links.  Both are the document's own id
    if its set is empty.  Rows whose id is null are left out: they cannot be referred to.
    """
    if 2 * num < den or num > den:
        raise ValueError("the threshold num / den must lie between 0.5 and 1")
    spark = docs.sparkSession
    stage = Stage(spark, "partenum")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    sizes = stage(base.mapInArrow(lambda it: _sizes(it, n), "doc_id long, n long, h1 long, h2 long"))
    chosen = sizes.groupBy("doc_id").agg(F.min(F.struct("n", "h1", "h2")).alias("s")).select("doc_id", "s.*")
    classes = chosen.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    known = stage(chosen.join(classes, ["n", "h1", "h2"], "left").select("doc_id", "n", "h1", "h2", F.coalesce("rep", "doc_id").alias("rep")))
    repeated = sizes.count() > known.count()

    # Signatures: one shuffle of (signature, document); every member gets a star edge to its leader.
    rows = base.where("text is not null").mapInArrow(lambda it: _sign(it, n, num, den, cover), "sig long, salt int, doc long, first long")
    within = Window.partitionBy("sig", "salt")
    stars = rows.withColumn("leader", F.coalesce("first", F.min("doc").over(within))).where("leader <> doc").select("sig", "doc", "leader")
    rep = known.select("doc_id", "rep")
    shared = stage(
        stars.join(rep.toDF("doc", "b"), "doc").join(rep.toDF("leader", "a"), "leader").where("a <> b").select("sig", "a", "b").distinct())

    def texts_of(ids: DataFrame) -> DataFrame:
        held = stage(ids.select(F.col("doc").alias("doc_id")).distinct())
        few = F.broadcast(held) if held.count() <= BROADCAST_IDS else held
        return base.join(few, "doc_id", "left_semi")

    def sets_of(ids: DataFrame) -> DataFrame:
        """The sets of some documents, from their texts."""
        sets = texts_of(ids).mapInArrow(lambda it: _store(it, n), "doc long, n long, h1 long, h2 long, features binary")
        if repeated:  # an id with several rows: the set that was chosen above, once
            sets = sets.join(known.withColumnRenamed("doc_id", "doc"), ["doc", "n", "h1", "h2"], "left_semi").dropDuplicates(["doc"])
        return sets.select("doc", "n", "features")

    def sketches_of(ids: DataFrame) -> DataFrame:
        """The sketches of some documents; from their texts in one go where an id is one row."""
        if repeated:
            return sets_of(ids).mapInArrow(lambda it: _sketches(it, num, den), SKETCH)
        return texts_of(ids).mapInArrow(lambda it: _sketches(_store(it, n), num, den), SKETCH)

    def ends_of(edges: DataFrame) -> DataFrame:
        return edges.select(F.explode(F.array("a", "b")).alias("doc"))

    # Sketches of all candidate documents; sets only of those that sketches leave.
    pairs = shared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sketches = stage(sketches_of(ends_of(pairs)))

    def near(candidates: DataFrame) -> DataFrame:
        one = sketches.withColumnRenamed("doc", "a")
        two = sketches.toDF("b", "n_b", "sketch_b")
        return candidates.join(one, "a").join(two, "b").mapInArrow(lambda it: _near(it, num, den), "a long, b long")

    def verified(candidates: DataFrame, store: DataFrame) -> DataFrame:
        one = store.select(F.col("doc").alias("a"), "features")
        two = store.select(F.col("doc").alias("b"), F.col("features").alias("features_b"))
        return candidates.join(one, "a").join(two, "b").mapInArrow(lambda it: _verify(it, num, den), "a long, b long")

    tried = stage(near(pairs))
    first = stage(sets_of(ends_of(tried)))
    links = stage(verified(tried, first))
    stage.release(tried, first)
    joined = components(links, stage)

    # What the stars leave open: members of one signature that still lie in different components.
    members = shared.select("sig", F.explode(F.array("a", "b")).alias("doc")).distinct()
    members = members.join(joined.withColumnRenamed("node", "doc"), "doc", "left").select("sig", "doc", F.coalesce("component", "doc").alias("comp"))
    per = members.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("doc")).alias("x1"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("x2"))
    per = per.groupBy("sig").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("main"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    per = per.where("comps > 1").groupBy("m", "x1", "x2").agg(F.min(F.struct("sig", "main")).alias("s"))  # equal buckets once
    per = per.select("s.sig", "s.main", F.ceil(F.col("m") / BLOCK).cast("int").alias("ny"), F.ceil((F.col("m") - F.col("s.main.c")) / BLOCK).cast("int").alias("nx"))
    met = members.join(per, "sig").join(sketches, "doc")
    columns = ["sig", "doc", "comp", "n", "sketch"]
    left = met.where("comp <> main.comp").select(*columns, F.lit(0).alias("side"), F.pmod(F.xxhash64("doc"), "nx").alias("x"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("y"))
    right = met.select(*columns, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("x"), F.pmod(F.xxhash64("doc"), "ny").alias("y"))
    blocks = left.select(*columns, "side", F.col("x").cast("int").alias("x"), "y").union(right.select(*columns, "side", "x", F.col("y").cast("int").alias("y")))
    blocks = blocks.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
    edges = stage(blocks.mapInArrow(lambda it: _cross(it, num, den), "a long, b long").distinct())
    if not edges.isEmpty():
        # Clusters of documents that may link, settled on their sets, block against block.
        store = stage(sets_of(ends_of(edges)))
        cluster = components(edges, stage).select(F.col("node").alias("doc"), F.col("component").alias("cluster"))
        comp = joined.withColumnRenamed("node", "doc")
        own = cluster.join(store, "doc").join(comp, "doc", "left").select("doc", "cluster", "n", "features", F.coalesce("component", "doc").alias("comp"))
        sized = cluster.join(store.select("doc", "n"), "doc").groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
        dealt = own.join(sized, "cluster").withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "doc", "comp", "n", "features")
        dealt = dealt.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")
        late = stage(dealt.mapInArrow(lambda it: _settle(it, num, den), "a long, b long"))
        if not late.isEmpty():
            joined = components(links.union(late), stage)
        stage.release(store)
    stage.release(shared, sketches)
    out = known.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
