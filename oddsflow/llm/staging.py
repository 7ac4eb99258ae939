"""Intermediate tables in the cluster's shared folder, and connected components.

A staged table is parquet under ``spark.checkpoint.dir``: it cuts lineage, is read
back with column pruning, and survives the loss of any executor.  ``release``
empties a staged table that nothing reads any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsflow.session import checkpoint_dir


class Stage:
    """Writes intermediate tables and empties those that later steps do not read."""

    def __init__(self, spark, name: str):
        self.spark, self.root = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, tuple[str, DataFrame]] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path, out
        return out

    def release(self, *tables: DataFrame) -> None:
        for df in tables:
            path, out = self.paths[id(df)]
            self.spark.createDataFrame([], out.schema).coalesce(1).write.mode("overwrite").parquet(path)


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, component) of undirected edges (a, b) with a <> b; component is the smallest node.

    Alternating large-star and small-star rounds: each is one minimum per node
    (pre-aggregated) and one equi-join that skew splitting can cut, so a node with
    very many neighbours is never gathered in one place.  The edge list is staged
    after each round and never grows beyond the input.
    """
    current = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        new = stage(small)
        seen = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        stage.release(current)
        current = new
        if seen == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        mark = seen
