"""Presentation layer: dimensions and facts for charts.

Inputs are the clean tables (new column names: market_id, market_type,
runner_id, runner_name; see SURVEY Q1).  ``changes`` is the long ladder
(runner_change or price) with ``epoch``, ``timestamp``, ``ltp``, ``tv``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import date_key, epoch_ms_to_date, minute_offset, time_key
from ..operators.joins import HOT_KEY_SALT, interval_join, salted_join
from ..operators.keys import hash_key
from ..operators.ladder import carry_forward, pivot_levels
from ..operators.latest import ordering, top1
from ..operators.quantiles import merge_quantile_states, quantile, quantile_states
from ..operators.scan import scan_forward
from ..session import conf_set
from .clean import first_goal_minutes

# Market types of the two first-goal facts.
MATCH_ODDS_TYPES = ("MATCH_ODDS",)
OVER_UNDER_TYPES = ("OVER_UNDER_15", "OVER_UNDER_25")
# The window after the first goal, in minutes (inclusive).
AFTER_GOAL_FROM, AFTER_GOAL_TO = 2, 5
# Changes of one runner at the same epoch: the higher traded volume is the later
# one (volume never decreases).  Rows of one change then go best level first.
SAME_EPOCH_ORDER = ("tv",)


# Columns of the first-goal facts.
FIRST_GOAL_COLUMNS = (
    "event_id", "event_name", "market_id", "market_name", "runner_key", "runner_id", "name", "timestamp",
    "pre_ko_traded_volume", "ko_odds", "favourite", "sort_priority", "winner", "country_code",
    "first_odds", "second_odds", "third_odds", "first_goal_minute")


def dim_first_goal(market: DataFrame, runner: DataFrame) -> DataFrame:
    """P-14: one row per event with a settled 0.5-goals market."""
    return first_goal_minutes(market, runner)


def _before_kickoff(changes: DataFrame, market: DataFrame, salt: int = HOT_KEY_SALT) -> DataFrame:
    """Changes with their market's kick-off; a hot market is salted over ``salt`` tasks."""
    return salted_join(changes, market.select("market_id", "kick_off"), ["market_id"], salt=salt,
                       salt_cols=["runner_id", "epoch"])


def runner_volumes(changes: DataFrame, market: DataFrame, tiebreak: Sequence[str] = SAME_EPOCH_ORDER) -> DataFrame:
    """P-15a: per (market, runner) with a change before kick-off: traded volume
    at the last change before kick-off and at the last change overall."""
    return _runner_stats(changes, market, tiebreak, with_odds=False)


# Optional last column of the runner dimension: how many rows of changes a runner has.
N_CHANGES = "n_changes"


def _runner_stats(changes: DataFrame, market: DataFrame, tiebreak: Sequence[str], with_odds: bool,
                  side: str = "b", with_count: bool = False) -> DataFrame:
    """Volumes (P-15a) and, with ``with_odds``, the last back change before
    kick-off (P-15b) in one aggregation over one scan of the changes."""
    j = _before_kickoff(changes, market)
    order = ordering("epoch", tiebreak)
    before = F.col("timestamp") < F.col("kick_off")
    aggs = [
        F.max_by(F.col("tv"), F.when(before, order)).alias("pre_ko_traded_volume"),
        F.max_by(F.col("tv"), order).alias("total_traded_volume"),
        F.max(before).alias("_any_before"),
    ]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias(N_CHANGES))
    if with_odds:
        # best level first among rows of the same change: position ascending
        last_order = _last_change_order(tiebreak)
        aggs.append(F.max_by(F.struct("ltp", "odds"), F.when(before & (F.col("type") == F.lit(side)), last_order))
                    .alias("_l"))
    agg = j.groupBy("market_id", "runner_id").agg(*aggs).where(F.col("_any_before")).drop("_any_before")
    if not with_odds:
        return agg
    return agg.select("*", F.col("_l.ltp").alias("ko_odds"), F.col("_l.odds").alias("_odds"),
                      F.col("_l").isNotNull().alias("_has_back")).drop("_l")


def _last_change_order(tiebreak: Sequence[str]):
    """Latest change first; inside one change the best ladder level (lowest
    position); odds and ltp settle rows that are otherwise identical."""
    return F.struct(F.col("epoch"), *[F.col(c) for c in tiebreak], (-F.col("position")).alias("_p"),
                    (-F.col("odds")).alias("_o"), F.col("ltp").alias("_l"))


def _favourite(last: DataFrame) -> DataFrame:
    fav = top1(last, ["market_id"], [F.col("ko_odds").asc_nulls_last(), F.col("_odds").asc_nulls_last(),
                                     F.col("runner_id").asc()], flag="favourite")
    return fav.withColumn("favourite", F.col("favourite") & F.col("ko_odds").isNotNull()).drop("_odds")


def kickoff_odds(changes: DataFrame, market: DataFrame, side: str = "b",
                 tiebreak: Sequence[str] = SAME_EPOCH_ORDER) -> DataFrame:
    """P-15b: last back change before kick-off per (market, runner): its ltp as
    ko_odds; favourite = shortest ltp in the market (NULL ltp never favourite;
    ties by odds, then runner id)."""
    j = (_before_kickoff(changes.where(F.col("type") == F.lit(side)), market)
         .where(F.col("timestamp") < F.col("kick_off")))
    order = _last_change_order(tiebreak)
    last = j.groupBy("market_id", "runner_id").agg(
        F.max_by(F.struct("ltp", "odds"), order).alias("_l")).select(
        "market_id", "runner_id", F.col("_l.ltp").alias("ko_odds"), F.col("_l.odds").alias("_odds"))
    return _favourite(last)


def dim_runner(runner: DataFrame, market_runner: DataFrame, market: DataFrame, market_type: DataFrame,
               event: DataFrame, changes: DataFrame, tiebreak: Sequence[str] = SAME_EPOCH_ORDER,
               with_count: bool = False) -> DataFrame:
    """P-15: runner dimension of the star schema, one row per (market, runner).

    Key ``id`` is a hash of (market_id, runner_id): stable across runs and
    appends.  A runner that was renamed, or whose market was, or that changed its
    sort priority, has several rows in ``runner`` or ``market_runner``: the latest
    (column last_epoch, where the tables have it) counts.  A market's type and
    event are joined to the market, which has fewer rows than its runners; the
    market types, a handful of names, are broadcast (dealt by type, a few tasks
    would hold all markets); other joins are left to the optimizer.  ``with_count``
    adds the number of a runner's changes (N_CHANGES), which tells the fact the long series.
    """
    # volumes and kick-off odds come from one aggregation; the favourite is
    # ranked among runners with a back change before kick-off only
    stats = _favourite(_runner_stats(changes, market, tiebreak, with_odds=True, with_count=with_count).where(F.col("_has_back"))
                       .drop("_has_back"))
    m = market.select("market_id", "market_type", "event_id", "scheduled_time", "kick_off")
    mt = market_type.select(F.col("type").alias("market_type"), F.col("id").alias("market_type_id"))
    e = event.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"), "country_code")
    # the figures lie by market, after the ranking of its favourite: they are joined to it as
    # they lie, and then to names and priorities, which share one partitioning
    star = (m.join(F.broadcast(mt), "market_type").join(e, "event_id")
            .join(stats, "market_id")
            .join(_one_name(runner).join(_one_priority(market_runner), ["market_id", "runner_id"]), ["market_id", "runner_id"]))
    return star.select(
        hash_key(["market_id", "runner_id"]).alias("id"),
        "runner_id", "name", "sort_priority", "winner", "market_id", "market_type_id",
        F.col("market_type").alias("market_name"), "event_id", "event_name",
        date_key("scheduled_time").alias("scheduled_date_key"),
        time_key("scheduled_time").alias("scheduled_time_key"),
        date_key("kick_off").alias("kick_off_date_key"),
        time_key("kick_off").alias("kick_off_time_key"),
        "country_code", "pre_ko_traded_volume", "ko_odds", "favourite", "total_traded_volume",
        *([N_CHANGES] if with_count else []),
    )


def _age(df: DataFrame) -> list:
    return [F.col("last_epoch")] if "last_epoch" in df.columns else []


def _one_name(runner: DataFrame) -> DataFrame:
    """The latest name of each (market, runner)."""
    return runner.groupBy("market_id", "runner_id").agg(
        F.max_by("runner_name", F.struct(*_age(runner), *[F.col(c) for c in ("market_name", "runner_name") if c in runner.columns]))
        .alias("name"))


def _one_priority(market_runner: DataFrame) -> DataFrame:
    """The latest sort priority of each (market, runner), and whether it ever won."""
    return market_runner.groupBy("market_id", "runner_id").agg(
        F.max_by("sort_priority", F.struct(*_age(market_runner), F.col("sort_priority"))).alias("sort_priority"),
        F.bool_or("winner").alias("winner"))


def wide_odds(changes: DataFrame, market: DataFrame, dim_runner_df: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """P-16 before the carry-forward: top-3 ladder per change of the dimension's runners, in
    wide form, with the minute from kick-off.  Markets and runners are joined first, so only
    their changes are pivoted, on keys that the joins' partitioning already serves (see
    PARTITIONED_BY_MARKET)."""
    keys = ["market_id", "runner_id", "type", "epoch", "hc", "ltp", "tv"]  # in the order of the carry-forward
    dr = dim_runner_df.select(*FACT_RUNNER_COLUMNS).withColumnRenamed("id", "runner_key")
    salt_by = ["epoch", "type", "hc", "ltp", "tv"]
    j = salted_join(_before_kickoff(changes, market), dr, ["market_id", "runner_id"], salt=HOT_KEY_SALT, salt_cols=salt_by)
    wide = pivot_levels(j, keys, "position", ["odds", "amount"], tiebreak=list(tiebreak) or ["odds", "amount"],
                        carry=["runner_key", "kick_off", "market_type_id"])
    return wide.withColumn("minute", minute_offset("epoch", "kick_off")).drop("kick_off")


# While the wide odds are written: changes that lie by market, after the join to it, are joined
# to the market's runners as they lie, not dealt once more by (market, runner).  If AQE splits a
# hot market, it deals them anew.
PARTITIONED_BY_MARKET = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# Columns of the runner dimension that the fact takes.
FACT_RUNNER_COLUMNS = ("id", "market_id", "runner_id", "market_type_id")

# The fact's columns; stored tables are partitioned by the last one.
FACT_COLUMNS = (
    "market_id", "runner_id", "epoch", "hc", "ltp", "tv", "type", "first_odds", "second_odds", "third_odds",
    "first_amount", "second_amount", "third_amount", "minute", "runner_key", "market_type_id")
FACT_PARTITION = ("market_type_id",)


# A runner with more rows of changes than this is a long series: no task sorts it whole.
LONG_SERIES = 1_000_000


def fact_runner_odds(changes: DataFrame, market: DataFrame, dim_runner_df: DataFrame, tiebreak: Sequence[str] = (), store=None,
                     long_series: int = LONG_SERIES) -> DataFrame:
    """P-16: top-3 ladder per change in wide form, minute from kick-off,
    levels carried forward per (market, runner, side).

    With ``store``, which writes a frame and reads it back, no task holds a whole long series:
    see :func:`fact_runner_odds_parts`.  Without it, the carry-forward is one window.
    """
    if not store:
        return _carried(wide_odds(changes, market, dim_runner_df, tiebreak))
    short, long = fact_runner_odds_parts(changes, market, dim_runner_df, tiebreak, store, long_series)
    if short is None:
        return long
    with conf_set(short.sparkSession, PARTITIONED_BY_MARKET):
        short = store(short)
    return short if long is None else short.unionByName(long)


def fact_runner_odds_parts(changes: DataFrame, market: DataFrame, dim_runner_df: DataFrame, tiebreak: Sequence[str], store,
                           long_series: int = LONG_SERIES) -> tuple[DataFrame | None, DataFrame | None]:
    """The fact of the runners with short series, and of those with long ones; None where there are none.

    Short series are carried forward by one window, where the joins to the market left them
    (write it with PARTITIONED_BY_MARKET): no row is dealt once more.  Long ones go through a
    prefix scan over range partitions (see :func:`scan_forward`), however many of their changes
    fall in one minute.  Which are long is told by the dimension's N_CHANGES; where it has no
    such column any may be, and all are scanned.
    """
    if N_CHANGES not in dim_runner_df.columns:
        return None, _scanned(wide_odds(changes, market, dim_runner_df, tiebreak), store)
    is_long = F.col(N_CHANGES) > long_series
    short = _carried(wide_odds(changes, market, dim_runner_df.where(~is_long), tiebreak))
    long = dim_runner_df.where(is_long)
    return short, None if long.isEmpty() else _scanned(wide_odds(changes, market, long, tiebreak), store)


_LEVELS = [f"{lvl}_{v}" for lvl in ("first", "second", "third") for v in ("odds", "amount")]
_SERIES, _SERIES_ORDER = ["market_id", "runner_id", "type"], ["epoch", "hc", "ltp", "tv"]


def _carried(wide: DataFrame) -> DataFrame:
    return carry_forward(wide, _SERIES, _SERIES_ORDER[0], _LEVELS, tiebreak=_SERIES_ORDER[1:]).select(*FACT_COLUMNS)


def _scanned(wide: DataFrame, store) -> DataFrame:
    """The rows come by market type (a market has one), so that a table partitioned by it gets few files a type."""
    with conf_set(wide.sparkSession, PARTITIONED_BY_MARKET):
        return scan_forward(wide, ["market_type_id", *_SERIES], _SERIES_ORDER, _LEVELS, store).select(*FACT_COLUMNS)


def first_goal_fact(dim_runner_df: DataFrame, fact: DataFrame, first_goal: DataFrame,
                    market_types: Sequence[str], stat: str = "avg") -> DataFrame:
    """P-17 / P-18: odds 2-5 minutes after the first goal per runner.

    ``stat`` is ``avg`` (match odds) or ``median`` (over/under, approximate).  A fact table
    partitioned by market type is read for the wanted types only (dynamic partition pruning);
    the minutes after a goal are joined as (runner, minute) pairs; the odds are aggregated by
    runner, and the runner's attributes joined to that small result.
    """
    dr, j = _odds_after_goal(dim_runner_df, fact, first_goal, market_types)
    agg = [F.avg(c).alias(c) if stat == "avg" else F.percentile_approx(c, 0.5).alias(c) for c in ODDS_LEVELS]
    figures = j.groupBy(*RUNNER_KEY, "first_goal_minute").agg(epoch_ms_to_date(F.min("epoch")).alias("timestamp"), *agg)
    return figures.join(dr, RUNNER_KEY).select(*FIRST_GOAL_COLUMNS)


# The natural key goes with the hash, so no collision can mix two runners.
RUNNER_KEY = ["runner_key", "market_id", "runner_id"]
ODDS_LEVELS = ("first_odds", "second_odds", "third_odds")


def _odds_after_goal(dim_runner_df: DataFrame, fact: DataFrame, first_goal: DataFrame, market_types: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The runners of the wanted types, and their fact rows in the minutes after the first goal."""
    wanted = dim_runner_df.where(F.col("market_name").isin(*market_types))
    key = RUNNER_KEY
    dr = wanted.withColumnRenamed("id", "runner_key")
    goals = dr.select(*key, "event_id").join(first_goal, "event_id").select(*key, "first_goal_minute")
    types = dr.select("market_type_id").distinct()  # no more than the names asked for
    f = fact.join(F.broadcast(types), "market_type_id", "left_semi").select(*key, "minute", "epoch", "first_odds", "second_odds", "third_odds")
    minutes = [(F.col("first_goal_minute") + d).cast(f.schema["minute"].dataType) for d in (AFTER_GOAL_FROM, AFTER_GOAL_TO)]
    return dr, interval_join(f, goals, key, "minute", *minutes)


def first_goal_states(dim_runner_df: DataFrame, fact: DataFrame, first_goal: DataFrame, market_types: Sequence[str]) -> DataFrame:
    """P-18 for a part of the fact (a load): a state a runner that merges with those of other parts."""
    _, j = _odds_after_goal(dim_runner_df, fact, first_goal, market_types)
    keys = [*RUNNER_KEY, "first_goal_minute"]
    begun = j.groupBy(*keys).agg(F.min("epoch").alias("epoch"))
    return begun.join(quantile_states(j, keys, ODDS_LEVELS), keys)


def first_goal_from_states(dim_runner_df: DataFrame, states: DataFrame) -> DataFrame:
    """P-18 from the states of all parts; medians within the sketches' rank error."""
    keys = [*RUNNER_KEY, "first_goal_minute"]
    begun = states.groupBy(*keys).agg(epoch_ms_to_date(F.min("epoch")).alias("timestamp"))
    merged = begun.join(merge_quantile_states(states, keys, ODDS_LEVELS), keys)
    figures = merged.withColumns({c: quantile(c, 0.5) for c in ODDS_LEVELS})
    return figures.join(dim_runner_df.withColumnRenamed("id", "runner_key"), RUNNER_KEY).select(*FIRST_GOAL_COLUMNS)


__all__ = [
    "dim_first_goal", "runner_volumes", "kickoff_odds", "dim_runner", "fact_runner_odds", "first_goal_fact",
    "MATCH_ODDS_TYPES", "OVER_UNDER_TYPES",
]


def first_goal_fact_sql(spark, dim_runner_table: str, fact_table: str, first_goal_table: str,
                        market_types: Sequence[str], stat: str = "avg") -> DataFrame:
    """SRC-6: :func:`first_goal_fact` as SQL text over tables or views.

    The odds in the window are aggregated per runner key first; the runner's
    attributes are joined to that small result, so they need no grouping.
    """
    how = {"avg": "avg", "median": "approx_percentile"}[stat]
    levels = ("first_odds", "second_odds", "third_odds")
    figures = ", ".join(f"{how}({c}{'' if stat == 'avg' else ', 0.5'}) AS {c}" for c in levels)
    wanted = ", ".join("'" + t.replace("'", "''") + "'" for t in market_types)
    columns = ", ".join(FIRST_GOAL_COLUMNS)
    return spark.sql(f"""
        WITH wanted AS (
            SELECT id AS runner_key, * EXCEPT (id) FROM {dim_runner_table} WHERE market_name IN ({wanted})),
        goals AS (
            SELECT runner_key, market_id, runner_id, first_goal_minute
            FROM wanted JOIN {first_goal_table} USING (event_id)),
        types AS (SELECT DISTINCT market_type_id FROM wanted),
        figures AS (
            SELECT /*+ BROADCAST(types) */ runner_key, market_id, runner_id, first_goal_minute, {figures}, CAST(timestamp_millis(min(epoch)) AS DATE) AS timestamp
            FROM goals JOIN {fact_table} USING (runner_key, market_id, runner_id) JOIN types USING (market_type_id)
            WHERE minute - first_goal_minute BETWEEN {AFTER_GOAL_FROM} AND {AFTER_GOAL_TO}
            GROUP BY runner_key, market_id, runner_id, first_goal_minute)
        SELECT {columns} FROM figures JOIN wanted USING (runner_key, market_id, runner_id)""")
