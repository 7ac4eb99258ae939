"""Clean layer: raw feed changes -> normalised tables.

Each function is ``DataFrame(s) -> DataFrame`` with no I/O.  Input ``raw`` is
the output of :func:`oddsflow.sources.feed.ingest` (pt, timestamp, mc,
source_file_names).  Latest-by values use a full ordering (pt, version) so that
the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.time import epoch_ms_to_ts, minutes_between
from ..operators.joins import HOT_KEY_SALT
from ..operators.keys import with_hash_key, with_rank_key
from ..operators.ladder import explode_ladder, pivot_levels
from ..operators.latest import any_true_by, asof_before, first_when, latest_state, state_history
from ..sources.feed import definitions

# Market types, runner names and statuses the statistics read.
MATCH_ODDS = "MATCH_ODDS"
OVER_UNDER_05 = "OVER_UNDER_05"
OVER_UNDER_PREFIX = "OVER_UNDER"
CORRECT_SCORE = "CORRECT_SCORE"
CORRECT_SCORE_2 = "CORRECT_SCORE2"
OVER_05_RUNNER = "Over 0.5 Goals"
OVER_PREFIX = "Over"
ANY_UNQUOTED = "Any unquoted"
WINNER = "WINNER"
# Changes of one runner at the same time: traded volume never decreases, so the
# higher volume is the later change; odds settle the rest.
SAME_TIME_ORDER = ("total_volume", "odds")


def flattened_definitions(raw: DataFrame) -> DataFrame:
    """P-2: one row per market definition: id, pt, timestamp, all definition fields."""
    return definitions(raw)


def event_dim(raw: DataFrame) -> DataFrame:
    """P-3: one row per event with its latest name, country and regulators."""
    d = definitions(raw)
    # several markets of one event can change at the same pt: market id breaks the tie
    latest = latest_state(d, ["eventId"], "pt", ["eventName", "countryCode", "regulators"],
                          tiebreak=["version", "id"])
    return event_columns(latest)


def event_columns(states: DataFrame) -> DataFrame:
    """The event table's columns from the latest values of each event."""
    return states.select(
        F.col("eventId").try_cast("int").alias("id"),
        F.col("eventName").alias("name"),
        F.col("countryCode").alias("country_code"),
        "regulators",
    )


def event_history(raw: DataFrame) -> DataFrame:
    """P-3, history form: every distinct running state of an event and since when."""
    d = definitions(raw)
    hist = state_history(d, ["eventId"], "pt", ["eventName", "countryCode", "regulators"],
                         tiebreak=["version", "id"])
    return hist.select(
        F.col("eventId").try_cast("int").alias("id"),
        F.col("eventName").alias("name"),
        F.col("countryCode").alias("country_code"),
        "regulators",
        epoch_ms_to_ts("since").alias("since"),
    )


def market_state(raw: DataFrame) -> DataFrame:
    """P-4: one row per market: latest definition values, latest of the ISO
    times, first in-play time as kick-off, lineage of the latest change."""
    lineage = lineage_column(raw.columns)
    d = definitions(raw, extra=[lineage])
    latest = ["name", "marketType", "eventId", "eventName", "countryCode", "numberOfWinners", lineage]
    agg = latest_state(
        d, ["id"], "pt", latest, tiebreak=["version"],
        extra_aggs=[
            F.max("openDate").alias("_open"),
            F.max("marketTime").alias("_start"),
            F.max("settledTime").alias("_settled"),
            first_when(F.col("inPlay") == F.lit(True), "pt").alias("_first_inplay"),
        ],
    )
    return market_columns(agg, lineage)


def lineage_column(columns: Sequence[str]) -> str:
    """Lineage of the latest definition: the file list, or with a long lineage table
    (ingest_counted) the change key that links into it."""
    return "source_file_names" if "source_file_names" in columns else "change_key"


def market_columns(states: DataFrame, lineage: str) -> DataFrame:
    """The market table's columns from the latest values and the extremes of each market."""
    return states.select(
        F.col("id").alias("market_id"),
        F.col("name").alias("market_name"),
        F.col("marketType").alias("market_type"),
        F.col("eventId").try_cast("int").alias("event_id"),
        F.col("eventName").alias("event_name"),
        F.col("countryCode").alias("country_code"),
        F.col("_open").try_cast("timestamp").alias("scheduled_time"),
        F.col("_start").try_cast("timestamp").alias("start_time"),
        F.col("_settled").try_cast("timestamp").alias("settled_time"),
        epoch_ms_to_ts("_first_inplay").alias("kick_off"),
        F.col("numberOfWinners").alias("num_winners"),
        lineage,
    )


# Definition fields of the change history and their table names.
MARKET_CHANGE_COLUMNS = {
    "betDelay": "bet_delay", "bettingType": "betting_type", "bspMarket": "bsp_market",
    "bspReconciled": "bsp_reconciled", "complete": "complete", "crossMatching": "cross_matching",
    "discountAllowed": "discount_allowed", "inPlay": "in_play", "marketBaseRate": "base_rate",
    "openDate": "open_date", "persistenceEnabled": "persistence_enabled",
    "runnersVoidable": "runners_voidable", "status": "status", "version": "version",
}


def market_changes(raw: DataFrame) -> DataFrame:
    """P-5: every market definition as a history row with snake_case names."""
    d = definitions(raw)
    return d.select(
        F.col("id").alias("market_id"), F.col("pt").alias("epoch"), "timestamp",
        *[F.col(src).alias(dst) for src, dst in MARKET_CHANGE_COLUMNS.items()],
    )


def runner_rows(raw: DataFrame) -> DataFrame:
    d = definitions(raw).select(F.col("id").alias("market_id"), F.col("name").alias("market_name"), "pt",
                                "version", F.col("runners").alias("_runners"))
    return d.select("market_id", "market_name", "pt", "version", F.inline("_runners"))


def market_runners(raw: DataFrame, with_epoch: bool = False) -> DataFrame:
    """P-6: (market, runner, sort priority) with winner = the runner ever won (false if no
    status is known).  ``with_epoch`` adds last_epoch, the latest change that says so."""
    r = runner_rows(raw).select("market_id", F.col("id").alias("runner_id"),
                                 F.col("sortPriority").alias("sort_priority"), "status", "pt")
    won = F.coalesce(F.col("status") == F.lit(WINNER), F.lit(False))
    out = any_true_by(r, ["market_id", "runner_id"], ["sort_priority"], won, "winner",
                      extra_aggs=[F.max("pt").alias("last_epoch")])
    return out.select("market_id", "runner_id", "winner", "sort_priority", *(["last_epoch"] if with_epoch else []))


def market_types(raw: DataFrame, key: str = "hash") -> DataFrame:
    """P-7: distinct market types, an unknown (NULL) one included, with a stable key
    (hash of the type, or dense rank with NULL last)."""
    types = definitions(raw).select(F.col("marketType").alias("type"))
    if key == "rank":
        return with_rank_key(types, "type", "id")
    return with_hash_key(types, ["type"], "id")


def runners(raw: DataFrame, with_epoch: bool = False) -> DataFrame:
    """P-8: one row per (market, market name, runner, runner name) with the latest status and
    sort priority.  ``with_epoch`` adds last_epoch, the latest change under these names."""
    r = runner_rows(raw)
    latest = latest_state(r, ["market_id", "market_name", "id", "name"], "pt", ["status", "sortPriority"],
                          tiebreak=["version"], extra_aggs=[F.max("pt").alias("last_epoch")])
    return runner_columns(latest, with_epoch)


def runner_columns(states: DataFrame, with_epoch: bool = True) -> DataFrame:
    """The runner table's columns from the latest values under each name."""
    return states.select(
        "market_id", "market_name", F.col("id").alias("runner_id"), F.col("name").alias("runner_name"),
        "status", F.col("sortPriority").alias("sort_priority"), *(["last_epoch"] if with_epoch else []),
    )


def _runner_change_rows(raw: DataFrame) -> DataFrame:
    # Project the nested fields first: the scan then reads mc.id and mc.rc only
    # (nested pruning does not look through a generator's input).
    rc = (raw.where(F.col("mc.rc").isNotNull())
          .select(F.col("mc.id").alias("market_id"), F.col("pt").alias("epoch"), "timestamp",
                  F.col("mc.rc").alias("_rc")))
    return rc.select("market_id", "epoch", "timestamp", F.inline("_rc"))


def runner_changes(raw: DataFrame) -> DataFrame:
    """P-9: long ladder of both sides, one scan of the raw changes."""
    rc = _runner_change_rows(raw)
    out = explode_ladder(rc, ["market_id", "epoch", "timestamp", "hc", F.col("id").alias("runner_id"), "ltp", "tv",
                              "batb", "batl"])
    return out.select("market_id", "epoch", "timestamp", "hc", "runner_id", "ltp", "tv",
                      "position", "odds", "amount", "type")


def prices(raw: DataFrame, since: str | None = None) -> DataFrame:
    """P-10: long ladder with handicap and total volume; all of it, or from ``since`` on."""
    src = raw
    if since:
        src = src.where(F.col("timestamp") >= F.to_timestamp(F.lit(since)))
    rc = _runner_change_rows(src)
    out = explode_ladder(rc, ["epoch", "timestamp", "market_id", F.col("id").alias("runner_id"),
                              F.col("hc").cast("double").alias("handicap"),
                              F.col("tv").cast("double").alias("total_volume"), "batb", "batl"])
    return out.select("epoch", "timestamp", "market_id", "runner_id", "handicap", "position", "odds", "amount",
                      "type", "total_volume")


# --------------------------------------------------------------------------
# P-11 match statistics
# --------------------------------------------------------------------------

def event_outcomes(market: DataFrame, runner: DataFrame) -> DataFrame:
    """P-11a-d in one aggregation per event over (runner join market).

    first_goal_minute: minutes from kick-off to settlement of the 0.5-goals
    market when "Over 0.5 Goals" won; final score and result from the
    CORRECT_SCORE winner, and from CORRECT_SCORE2 except "Any unquoted";
    total goals = highest won "Over N.5" + 1.  One row per event; where the
    reference could return several rows, the lowest (market id, runner id) wins.
    """
    m = market.where(F.col("kick_off").isNotNull()).select(
        "market_id", "market_type", "event_id", "kick_off", "settled_time")
    mr = runner.select("market_id", "runner_id", "runner_name", "status").join(m, "market_id")
    won = F.col("status") == F.lit(WINNER)
    mtype, name = F.col("market_type"), F.col("runner_name")
    home, away = scores.score_part(name, 0), scores.score_part(name, 1)
    cs = mtype == F.lit(CORRECT_SCORE)
    cs2 = (mtype == F.lit(CORRECT_SCORE_2)) & (name != F.lit(ANY_UNQUOTED))
    ou_over = mtype.startswith(OVER_UNDER_PREFIX) & name.startswith(OVER_PREFIX)
    runner_order = F.struct("market_id", "runner_id")
    agg = mr.groupBy("event_id").agg(
        first_when((mtype == F.lit(OVER_UNDER_05)) & won & (name == F.lit(OVER_05_RUNNER)),
                   minutes_between("settled_time", "kick_off")).alias("first_goal_minute"),
        F.min_by(F.struct(home.alias("h"), away.alias("a"),
                          scores.match_result(home, away, scores.label_from_name(name)).alias("r")),
                 F.when(cs & won, runner_order)).alias("_cs"),
        F.min_by(F.struct(home.alias("h"), away.alias("a")), F.when(cs2 & won, runner_order)).alias("_cs2"),
        F.max(F.when(ou_over, F.when(won, scores.goal_threshold(name)).otherwise(F.lit(-1)))).alias("_max_won"),
    )
    return agg.select(
        "event_id",
        "first_goal_minute",
        F.coalesce(F.col("_cs.h"), F.col("_cs2.h")).alias("final_score_home"),
        F.coalesce(F.col("_cs.a"), F.col("_cs2.a")).alias("final_score_away"),
        (F.col("_max_won") + 1).alias("total_goals"),
        F.col("_cs.r").alias("match_result"),
    )


def first_goal_minutes(market: DataFrame, runner: DataFrame) -> DataFrame:
    """P-11a / P-14: first-goal minute per event that has a settled 0.5-goals winner."""
    m = market.where((F.col("kick_off").isNotNull()) & (F.col("market_type") == F.lit(OVER_UNDER_05)))
    w = runner.where(F.col("status") == F.lit(WINNER)).select("market_id", "runner_id", "runner_name")
    j = w.join(m.select("market_id", "event_id", "kick_off", "settled_time"), "market_id")
    return j.groupBy("event_id").agg(
        first_when(F.col("runner_name") == F.lit(OVER_05_RUNNER),
                   minutes_between("settled_time", "kick_off")).alias("first_goal_minute"))


def pre_kickoff_prices(price: DataFrame, market: DataFrame, position: int = 1, side: str = "b",
                       lag: str = "30 SECOND", tiebreak: tuple[str, ...] = SAME_TIME_ORDER,
                       salt: int = HOT_KEY_SALT) -> DataFrame:
    """P-11e, first half: last back price at least ``lag`` before kick-off per
    (match-odds market, runner), with the volume of that same change."""
    p = price.where((F.col("type") == F.lit(side)) & (F.col("position") == F.lit(position)))
    m = market.where((F.col("kick_off").isNotNull()) & (F.col("market_type") == F.lit(MATCH_ODDS)))
    return asof_before(
        p, m, on=["market_id"], time_col="timestamp", cutoff_col="kick_off",
        by=["event_id", "market_id", "runner_id"], values=["odds", "total_volume"], tiebreak=list(tiebreak),
        lag=lag, inclusive=True, carry=["event_name", "scheduled_time", "kick_off"], salt=salt,
    ).withColumnsRenamed({"odds": "pre_ko_odds", "total_volume": "pre_ko_volume"})


# Sort priorities 1, 2, 3 of a match-odds market are home, away, draw.
OUTCOMES = {1: "home", 2: "away", 3: "draw"}


def outcome_pivot(pre_ko: DataFrame, runner: DataFrame) -> DataFrame:
    """P-11e, second half: one row per market with home/away/draw columns."""
    j = pre_ko.join(runner.select("market_id", "runner_id", "sort_priority"), ["market_id", "runner_id"])
    keys = [c for c in ["event_id", "market_id"] if c in j.columns]
    carry = [c for c in ["event_name", "kick_off", "scheduled_time"] if c in j.columns]
    wide = pivot_levels(j, keys, "sort_priority", ["runner_id", "pre_ko_odds", "pre_ko_volume"],
                        tiebreak=["runner_id"], levels=OUTCOMES, name="{value}_{level}", carry=carry)
    return wide.withColumnsRenamed({f"runner_id_{o}": f"{o}_runner_id" for o in OUTCOMES.values()})


def match_statistics(market: DataFrame, runner: DataFrame, price: DataFrame, position: int = 1,
                     lag: str = "30 SECOND", tiebreak: tuple[str, ...] = SAME_TIME_ORDER,
                     salt: int = HOT_KEY_SALT) -> DataFrame:
    """P-11: one wide row per (event, match-odds market)."""
    pk = outcome_pivot(pre_kickoff_prices(price, market, position, lag=lag, tiebreak=tiebreak, salt=salt), runner)
    outcomes = event_outcomes(market, runner)
    ev = pk.join(outcomes, "event_id", "left")
    return ev.select(
        "event_id", "event_name", "kick_off", "scheduled_time",
        F.col("market_id").alias("match_odds_market_id"),
        "home_runner_id", "away_runner_id", "draw_runner_id",
        "pre_ko_odds_home", "pre_ko_odds_away", "pre_ko_odds_draw",
        "pre_ko_volume_home", "pre_ko_volume_away", "pre_ko_volume_draw",
        "first_goal_minute", "final_score_home", "final_score_away", "total_goals", "match_result",
    )


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """AG-13: row count gathered while the result is written (no second job)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
