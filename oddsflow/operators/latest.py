"""Latest-by, history, first-when and as-of operators.

All of them are aggregations (``max_by`` / ``min`` over a struct ordering), not
windows: Spark combines them map-side, so a key that holds a third of all rows
is reduced to one partial row per map task before the shuffle, and no task ever
sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import HOT_KEY_SALT, salted_join


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def ordering(order: str | Sequence[str], tiebreak: Sequence[str] = ()) -> Column:
    """Total order used by every latest-by operator: (order..., tiebreak...)."""
    return F.struct(*[F.col(c) for c in _cols(order) + list(tiebreak)])


def latest_of(values: Sequence[str], order: str | Sequence[str], tiebreak: Sequence[str] = (),
              alias: str = "_latest") -> Column:
    """Aggregate: the ``values`` of the row with the greatest (order, tiebreak).

    NULLs inside the winning row are kept, which is what ``last(x)`` over an
    ordered full frame returns.
    """
    payload = F.struct(*[F.col(v).alias(v.split(".")[-1]) for v in values])
    return F.max_by(payload, ordering(order, tiebreak)).alias(alias)


def first_when(cond: Column, value: Column | str) -> Column:
    """Aggregate: smallest ``value`` among rows where ``cond`` holds (NULL if none).

    Same value as ``first(when(cond, value), ignorenulls)`` over a frame
    ordered by ``value``, e.g. the first in-play time of a market.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.min(F.when(cond, value))


def latest_state(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], values: Sequence[str],
                 tiebreak: Sequence[str] = (), extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per key with the latest ``values`` by (order, tiebreak).

    ``extra_aggs`` are further aggregates over the same group (``max`` of a
    column, ``first_when`` ...) so that a whole state row is one aggregation.
    """
    keys = _cols(keys)
    agg = df.groupBy(*keys).agg(latest_of(values, order, tiebreak), *extra_aggs)
    extra_names = [c for c in agg.columns if c not in keys and c != "_latest"]
    return agg.select(*keys, "_latest.*", *extra_names)


def latest_state_window(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
                        values: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Window form of :func:`latest_state`: every input row gets the latest values."""
    w = (Window.partitionBy(*_cols(keys)).orderBy(*[F.col(c) for c in _cols(order) + list(tiebreak)])
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumns({f"latest_{v}": F.last(F.col(v)).over(w) for v in values})


def state_history(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
                  tiebreak: Sequence[str] = (), since: str = "since") -> DataFrame:
    """Distinct running states per key, with the first ``order`` value each held.

    The state at an ``order`` value is the last row among the rows tied at that
    value (what ``last(x)`` over the default RANGE frame sees); rows are then
    reduced to the distinct states.  Two aggregations, no window.
    """
    keys = _cols(keys)
    tb = list(tiebreak) or list(values)
    at_each = df.groupBy(*keys, order).agg(
        F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(c) for c in tb])).alias("_s"))
    flat = at_each.select(*keys, order, *[F.col(f"_s.{v}").alias(v) for v in values])
    return flat.groupBy(*keys, *values).agg(F.min(order).alias(since))


def asof_before(changes: DataFrame, cutoffs: DataFrame, on: Sequence[str], time_col: str,
                cutoff_col: str, by: Sequence[str], values: Sequence[str], tiebreak: Sequence[str] = (),
                lag: str | None = None, inclusive: bool = False, carry: Sequence[str] = (),
                salt: int = HOT_KEY_SALT, time_alias: str | None = None) -> DataFrame:
    """Latest change strictly before (or at, ``inclusive``) each cut-off.

    ``changes`` are joined to ``cutoffs`` (one row per ``on`` key, e.g. a market
    with its kick-off) and kept when ``time_col < cutoff_col - lag``; per ``by``
    key the row with the greatest (time_col, tiebreak) survives.  ``carry`` are
    cut-off columns copied to the output.  ``salt > 1`` spreads a hot ``on`` key
    over that many join tasks (see :func:`salted_join`); the aggregation after
    it is partial, so the hot key is combined before the second shuffle.
    """
    on, by = _cols(on), _cols(by)
    from_right = [c for c in dict.fromkeys([*by, *carry])
                  if c in cutoffs.columns and c not in changes.columns and c != cutoff_col]
    right = cutoffs.select(*on, cutoff_col, *from_right)
    joined = salted_join(changes, right, on, salt=salt, salt_cols=[time_col, *tiebreak])
    bound = F.col(cutoff_col)
    if lag:
        bound = bound - F.expr(f"INTERVAL {lag}")
    keep = F.col(time_col) <= bound if inclusive else F.col(time_col) < bound
    # carried cut-off columns are functions of the `on` key: aggregated, not
    # grouped on, so the shuffled key stays `by`
    extra = [c for c in dict.fromkeys(carry) if c not in by]
    out_values = list(values) + ([time_col] if time_alias else [])
    agg = joined.where(keep).groupBy(*by).agg(latest_of(out_values, time_col, tiebreak),
                                               *[F.max(c).alias(c) for c in extra])
    cols = [*by, *extra, *[F.col(f"_latest.{v}").alias(v) for v in values]]
    if time_alias:
        cols.append(F.col(f"_latest.{time_col}").alias(time_alias))
    return agg.select(*cols)


def top1(df: DataFrame, partition: Sequence[str], order: Sequence[Column], flag: str | None = None,
         rank_col: str = "_rn") -> DataFrame:
    """Top row per partition by ``order`` (``row_number() = 1``).

    With ``flag`` every row is kept and ``flag`` marks the top one (a favourite
    flag); without it only the top rows are returned (Catalyst adds a
    ``WindowGroupLimit`` before the shuffle).  ``order`` must be a total order.
    """
    w = Window.partitionBy(*_cols(partition)).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if flag:
        return ranked.withColumn(flag, F.col(rank_col) == 1).drop(rank_col)
    return ranked.where(F.col(rank_col) == 1).drop(rank_col)


def any_true_by(df: DataFrame, keys: Sequence[str], detail: Sequence[str], cond: Column,
                name: str, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """Distinct (keys, detail) rows with ``name`` = OR of ``cond`` over each key.

    First aggregated on (keys, detail) — partial, skew safe — then the OR is
    spread over the few detail rows of a key with a window.
    """
    keys = _cols(keys)
    per_detail = df.groupBy(*keys, *detail).agg(F.bool_or(cond).alias(name), *extra_aggs)
    w = Window.partitionBy(*keys)
    return per_detail.withColumn(name, F.bool_or(F.col(name)).over(w))
