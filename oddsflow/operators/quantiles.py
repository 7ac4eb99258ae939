"""Quantiles that merge: a sketch a group, so that a load adds to what earlier loads left.

The state of a group is a KLL sketch of bounded size, whatever the rows it has seen.  The rank
of a quantile read from it differs from the asked one by at most ``rank_error(k)`` of the
group's rows (with 99 % confidence, one-sided figure of the sketch); a group that has not
outgrown its sketch (about k values) is exact.  Merging adds rows up, so a load that may be
repeated keeps its states in a partition of its own (see sinks.replace_partitions) and
readers merge the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 800  # about 0.4 % of rank, some 10 kB a sketch that is full


def rank_error(k: int = SKETCH_K) -> float:
    """Largest share of rows by which a rank may be off: the published fit of the sketch's authors."""
    return 2.296 / k ** 0.9021


def quantile_states(df: DataFrame, keys: Sequence[str], cols: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One row a key with a sketch of each column (NULLs are left out); combined where rows are read."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in cols])


def merge_quantile_states(states: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The states of all loads as one row a key."""
    return states.groupBy(*keys).agg(*[F.kll_merge_agg_double(c).alias(c) for c in cols])


def quantile(state: Column | str, q: float) -> Column:
    """A quantile of a sketch: one of the values it has seen; NULL if it has seen none."""
    state = F.col(state) if isinstance(state, str) else state
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_quantile_double(state, F.lit(q)))
