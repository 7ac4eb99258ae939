"""Nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample of vectors; every row is indexed, by walking down
to the nearest centre at each level.  A query visits leaves in the order of a priority
queue over centres; the number of visits is widened, on sampled queries with known
neighbours, until their recall reaches the target, and for each query until the visited
leaves hold enough vectors.  Leaves are cut into blocks of bounded size, and so are the
queries that visit a leaf; a block of vectors and a block of queries are scored together
in double precision on the original vectors.

Equal vectors count once: only the k + 1 smallest ids of a vector can be among the k
nearest of anything, and equal queries are searched once, so a very common vector is
neither a hot leaf nor repeated work.  Ties go to the smaller id.

Vectors that are null, zero, hold null or non-finite components, or have another length than
`dim` (the most common length, if not given; the smaller of equally common ones), take no part,
nor do rows with a null id.  Repeated rows of one id are one vector (the first by order).
Other columns are ignored.  An empty table gives no neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsflow.llm.staging import Stage

SAMPLE = 20_000      # vectors that the tree is fitted on, at most
BRANCH, LEAF = 16, 96
CALIBRATION = 400    # sampled queries that set the number of visits
RECALL = 0.95        # their target
BLOCK = 4_096        # vectors of a leaf scored together, at most about
ASKED = 4_096        # queries of a leaf scored together, at most about


class Tree:
    """centres[i] of node i; children[i] is a range of nodes, or a leaf number as (-1, leaf)."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centres, self.children, self.leaves = [np.zeros(vectors.shape[1], np.float32)], [None], 0
        stack = [(0, vectors)]
        while stack:
            node, own = stack.pop()
            groups = _kmeans(own, min(BRANCH, len(own) // 8), rng) if len(own) > LEAF else []
            if len(groups) < 2:
                self.children[node] = (-1, self.leaves)
                self.leaves += 1
                continue
            first = len(self.centres)
            for g in groups:
                centre = own[g].mean(axis=0)
                self.centres.append(centre / max(np.linalg.norm(centre), 1e-12))
                self.children.append(None)
            self.children[node] = (first, len(self.centres))
            stack += [(first + k, own[g]) for k, g in enumerate(groups)]
        self.centres = np.array(self.centres, np.float32)
        self.counts = np.ones(self.leaves, np.int64)  # vectors indexed in each leaf, set after indexing

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector."""
        leaf = np.empty(len(vectors), np.int64)
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            first, last = self.children[node]
            if first < 0:
                leaf[rows] = last
                continue
            nearest = (vectors[rows] @ self.centres[first:last].T).argmax(axis=1)
            stack += [(first + k, rows[nearest == k]) for k in range(last - first) if (nearest == k).any()]
        return leaf

    def visit(self, query: np.ndarray, visits: int, enough: int) -> list[int]:
        """Leaves best first: `visits` of them, and on until they hold `enough` vectors."""
        near = -(self.centres @ query)
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or held < enough):
            _, node = heapq.heappop(queue)
            first, last = self.children[node]
            if first < 0:
                if self.counts[last]:
                    out.append(last)
                    held += int(self.counts[last])
            else:
                for child in range(first, last):
                    heapq.heappush(queue, (float(near[child]), child))
        return out

    def calibrate(self, vectors: np.ndarray, k: int, recall: float) -> int:
        """Visits that find this share of the k nearest others of sampled queries."""
        leaf, needed = self.assign(vectors), []
        self.counts = np.bincount(leaf, minlength=self.leaves)
        for i in range(0, len(vectors), max(1, -(-len(vectors) // CALIBRATION))):
            scores = vectors @ vectors[i]
            scores[i] = -np.inf  # a query finds itself in its own leaf: no evidence of recall
            top = np.argsort(-scores, kind="stable")[:min(k, len(vectors) - 1)]
            order = {l: i for i, l in enumerate(self.visit(vectors[i], self.leaves, 0))}
            needed += [order[l] + 1 for l in leaf[top].tolist()]
        return int(np.quantile(needed, recall, method="higher")) if needed else 1


def _kmeans(vectors: np.ndarray, k: int, rng, rounds: int = 12) -> list[np.ndarray]:
    """Rows of each cluster (spherical k-means); empty ones are left out."""
    if k < 2:
        return []
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return [rows for c in range(k) if len(rows := np.flatnonzero(own == c))]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _assign(batches, tree, dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            leaf = tree.value.assign(_unit(_matrix(batch.column("v"), dim)))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("id"), batch.column("v")], ["leaf", "id", "v"])


def _visit(batches, tree, dim: int, visits: int, enough: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = [tree.value.visit(q, visits, enough) for q in _unit(_matrix(batch.column("v"), dim))]
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("v"), pa.array(found, pa.list_(pa.int64()))], ["q", "v", "leaves"])


def _score(queries: pa.Table, block: pa.Table, dim: int, k: int) -> pa.Table:
    """The k best of one block for each query; ties to the smaller id."""
    out = {"q": [], "id": [], "score": []}
    if queries.num_rows and block.num_rows:
        order = np.argsort(block.column("id").to_numpy())
        ids = block.column("id").to_numpy()[order]
        rows = _matrix(block.column("v").combine_chunks(), dim).astype(np.float64)[order]
        norms = np.sqrt((rows * rows).sum(axis=1))
        keys, wanted = queries.column("q").to_numpy(), _matrix(queries.column("v").combine_chunks(), dim).astype(np.float64)
        k = min(k, len(ids))
        for a in range(0, len(keys), 256):
            part = wanted[a:a + 256]
            lengths = np.sqrt((part * part).sum(axis=1))
            near = part @ rows.T / lengths[:, None] / norms
            floor = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] - 1e-9
            for i in range(len(part)):
                some = np.flatnonzero(near[i] >= floor[i])
                exact = (rows[some] * part[i]).sum(axis=1) / (norms[some] * lengths[i])
                best = np.lexsort((ids[some], -exact))[:k]
                out["q"] += [keys[a + i]] * len(best)
                out["id"] += ids[some[best]].tolist()
                out["score"] += exact[best].tolist()
    return pa.table({"q": pa.array(out["q"], pa.int64()), "id": pa.array(out["id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})


def nearest(vectors: DataFrame, is_query: str, k: int = 5, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding",
            dim: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row for which the SQL condition
    `is_query` over column `id` holds, the row itself excluded."""
    spark = vectors.sparkSession
    stage = Stage(spark, "kmeans-tree")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null and size(v) > 0")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~odd & F.exists("v", lambda x: x != 0))
    if dim is None:
        common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dim = common.n if common else 1
    rows = rows.where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    rows = stage(rows)
    equal = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).select("id", "v")

    sample = kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    units = _unit(_matrix(sample, dim)) if len(sample) else np.zeros((1, dim), np.float32)
    fitted = Tree(units)
    visits = fitted.calibrate(units, k, recall)
    tree = spark.sparkContext.broadcast(fitted)  # bounded by the sample
    kind = rows.schema["v"].dataType.simpleString()
    index = stage(kept.mapInArrow(lambda it: _assign(it, tree, dim), f"leaf long, id long, v {kind}"))
    sizes = index.groupBy("leaf").count().toPandas()  # one row a leaf
    fitted.counts = np.zeros(fitted.leaves, np.int64)
    fitted.counts[sizes["leaf"].to_numpy(np.int64)] = sizes["count"].to_numpy(np.int64)
    counted = spark.sparkContext.broadcast(fitted)
    blocks = spark.createDataFrame([(int(l), int(-(-c // BLOCK))) for l, c in enumerate(fitted.counts) if c], "leaf long, blocks int")

    asked = rows.where(is_query)
    asked = stage(asked.join(asked.groupBy("v").agg(F.min("id").alias("q")), "v").select("id", "q", "v"))  # equal queries: one asks
    visits_of = stage(asked.where("id = q").select("q", "v").mapInArrow(lambda it: _visit(it, counted, dim, visits, k + 1), f"q long, v {kind}, leaves array<long>"))
    parts = visits_of.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("parts"))
    cut = F.broadcast(stage(parts.join(blocks, "leaf")))  # a row a leaf
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    visited = visits_of.select("q", "v", F.explode("leaves").alias("leaf")).join(cut, "leaf").select("leaf", copies("blocks").alias("block"), dealt("q", "parts").alias("part"), "q", "v")
    placed = index.join(cut, "leaf").select("leaf", dealt("id", "blocks").alias("block"), copies("parts").alias("part"), "id", "v")
    task = ["leaf", "block", "part"]
    found = visited.groupBy(*task).cogroup(placed.groupBy(*task)).applyInArrow(lambda q, b: _score(q, b, dim, k + 1), "q long, id long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("q", F.col("id").alias("vec_id"), "score")
    each = asked.select(F.col("id").alias("query_id"), "q").join(found, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
