"""Surrogate keys that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.tables import stored
from .ranks import dense_rank


def hash_key(cols: Sequence[str | Column]) -> Column:
    """64-bit key from the natural key: same value on every run and append.

    The hash passes over NULLs, so a null mask goes in with the values:
    (NULL, 7) and (7, NULL) are different keys.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*parts, *[p.isNull() for p in parts])


def surrogate_key(df: DataFrame, natural_key: Sequence[str], name: str = "id", method: str = "hash") -> DataFrame:
    """Distinct rows of ``df`` with a key column: ``hash`` (any size, no shuffle
    beyond the distinct) or ``rank`` (dense 1..n in the order of the values)."""
    if method == "rank":
        if len(natural_key) != 1:
            raise ValueError("rank keys take one column")
        return with_rank_key(df, natural_key[0], name)
    return with_hash_key(df, natural_key, name)


def with_hash_key(df: DataFrame, natural_key: Sequence[str], name: str = "id") -> DataFrame:
    """Distinct rows first, then a hash of the natural key (a no-shuffle key)."""
    return df.distinct().withColumn(name, hash_key(natural_key))


def with_rank_key(df: DataFrame, col: str, name: str = "id") -> DataFrame:
    """Dense 1..n key by sorted value, NULL last, for any number of values.

    The distinct values are numbered over range partitions (see :func:`dense_rank`);
    a value's number changes when smaller ones come, so tables that are appended
    to take :func:`with_hash_key`.
    """
    return dense_rank(df, [col], name, stored)
