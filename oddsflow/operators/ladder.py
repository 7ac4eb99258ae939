"""Price-ladder operators: long form, wide form, carry-forward."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The ladder sides of the feed and the side tags kept in the
# tables ("b" = best available to back, "l" = best available to lay).
LADDER_SIDES = {"b": "batb", "l": "batl"}
# Names given to ladder positions 0, 1, 2 in the wide form.
LEVEL_NAMES = {0: "first", 1: "second", 2: "third"}


def ladder_entries(side_tag: str, ladder: Column | str) -> Column:
    """array<array<double>> of [position, odds, amount] -> array of structs.

    Missing elements give NULL (``try_element_at``), a NULL ladder gives an
    empty array so that it does not erase the other side in a concat.
    """
    ladder = F.col(ladder) if isinstance(ladder, str) else ladder
    return F.transform(
        F.coalesce(ladder, F.array().cast("array<array<double>>")),
        lambda e: F.struct(
            F.try_element_at(e, F.lit(1)).cast("int").alias("position"),
            F.try_element_at(e, F.lit(2)).alias("odds"),
            F.try_element_at(e, F.lit(3)).alias("amount"),
            F.lit(side_tag).alias("type"),
        ),
    )


def explode_ladder(df: DataFrame, keep: Sequence[str | Column], sides: Mapping[str, str] | None = None) -> DataFrame:
    """Both ladder sides to long rows (position, odds, amount, type) in one pass.

    The reference explodes each side separately and unions the two scans; here
    one ``inline`` over the concatenated sides reads the input once.
    """
    sides = dict(sides or LADDER_SIDES)
    entries = F.concat(*[ladder_entries(tag, col) for tag, col in sides.items()])
    return df.select(*keep, F.inline(entries))


def pivot_levels(df: DataFrame, keys: Sequence[str], level_col: str, values: Sequence[str],
                 tiebreak: Sequence[str], levels: Mapping[int, str] | None = None,
                 name: str = "{level}_{value}", carry: Sequence[str] = ()) -> DataFrame:
    """Long ladder rows -> one row per key with ``{level}_{value}`` columns.

    Conditional aggregation in one ``groupBy`` (partial + final): for level k the
    values of the row with the smallest tiebreak among rows at level k (NULLs
    last).  With a single tie-break column the aggregation is hash based
    (fixed-width buffers); it must then be unique and not NULL among rows of a
    key at one level.  Levels
    not listed are ignored; missing levels give NULL.  Same result as
    ``pivot(level, [...]).agg(first(...))`` with a deterministic survivor, but
    without the two-stage pivot aggregation.  ``carry`` are columns that are
    functions of ``keys``: kept (by ``max``) without widening the grouping key.
    """
    levels = dict(levels or LEVEL_NAMES)
    carried = [F.max(c).alias(c) for c in carry]
    cols = [F.col(k) for k in [*keys, *carry]]
    if len(tiebreak) == 1:
        # One tie-break column: per-value min_by with a primitive ordering keeps
        # every aggregation buffer fixed-width, so Spark uses hash aggregation.
        tb1 = F.col(tiebreak[0])
        aggs = []
        for k, label in levels.items():
            at_k = F.when(F.col(level_col) == F.lit(k), tb1)
            aggs += [F.min_by(F.col(v), at_k).alias(name.format(level=label, value=v)) for v in values]
        return df.groupBy(*keys).agg(*carried, *aggs)
    tb = F.struct(*[x for c in tiebreak for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))])
    payload = F.struct(*[F.col(v) for v in values])
    aggs = [F.min_by(payload, F.when(F.col(level_col) == F.lit(k), tb)).alias(f"_lvl{k}") for k in levels]
    out = df.groupBy(*keys).agg(*carried, *aggs)
    for k, label in levels.items():
        cols += [F.col(f"_lvl{k}.{v}").alias(name.format(level=label, value=v)) for v in values]
    return out.select(*cols)


def carry_forward(df: DataFrame, partition: Sequence[str], order: str, cols: Sequence[str],
                  tiebreak: Sequence[str] = (), bucket: Column | None = None) -> DataFrame:
    """Last non-NULL value so far (LOCF) per partition, ordered by (order, tiebreak).

    Without ``bucket`` this is one running window.  With ``bucket`` (an
    expression that does not decrease along a series, e.g. ``floor(epoch /
    3600000)``) a long series is split: a pre-aggregation gives the last value of
    each bucket, a window over that small table carries it across buckets, and
    what a bucket starts from is fed into its own window as one extra leading
    row.  The big frame is shuffled once; a task holds one bucket of a series,
    so the bucket's width bounds it.  ``df`` is read twice: pass a stored table.
    """
    partition = list(partition)
    order_by = [F.col(order)] + [F.col(c) for c in tiebreak]
    if bucket is None:
        w = Window.partitionBy(*partition).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})

    b, lead = "_bucket", "_lead"
    data = df.withColumns({b: bucket, lead: F.lit(1)})
    at = F.struct(*order_by)
    ends = data.groupBy(*partition, b).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols])
    wb = Window.partitionBy(*partition).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*partition, b, F.lit(0).alias(lead), *[F.last(F.col(c), ignorenulls=True).over(wb).alias(c) for c in cols])
    w = Window.partitionBy(*partition, b).orderBy(lead, *order_by).rowsBetween(Window.unboundedPreceding, 0)
    both = data.unionByName(starts, allowMissingColumns=True)
    filled = both.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})
    return filled.where(F.col(lead) == 1).select(*df.columns)
