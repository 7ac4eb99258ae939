"""Clean-layer tables derived from the driver's test tables.

The pipelines read markets, runners and prices.  For the oracle checks these
are derived from ``orders`` and ``lineitem`` by fixed rules, once as Spark
DataFrames and once as SQL text (CTEs) that DuckDB runs on the same parquet
files.  Every rule is a projection or a grouping of the whole tables, so the
work grows with the data.

    market  <- orders:   o_orderkey = market, o_custkey = event,
                         o_orderpriority -> market type, o_orderdate = kick-off
                         (none while o_orderstatus = 'P'), settled a few minutes later
    runner  <- lineitem grouped by (l_orderkey, l_linenumber % 3 + 1): three runners
               per market, sort priority = runner id, won if any of its lines is 'R'
    price   <- lineitem joined to its order, two changes per line: one 1-120
               minutes before kick-off and one 0-119 minutes after it; ladder
               position (l_linenumber - 1) / 3, side 'l' for flag 'N' else 'b'
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.time import ts_millis
from .operators.latest import latest_state


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed stand-in rule: order priority -> market type.
MARKET_TYPES = [
    ("1-URGENT", "MATCH_ODDS"),
    ("2-HIGH", "OVER_UNDER_05"),
    ("3-MEDIUM", "OVER_UNDER_25"),
    ("4-NOT SPECIFIED", "CORRECT_SCORE"),
    ("5-LOW", "CORRECT_SCORE2"),
]


def _market_type_col() -> Column:
    expr = None
    for prio, mtype in MARKET_TYPES:
        cond = F.col("o_orderpriority") == F.lit(prio)
        expr = F.when(cond, F.lit(mtype)) if expr is None else expr.when(cond, F.lit(mtype))
    return expr


def _market_type_sql() -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in MARKET_TYPES)
    return f"CASE o_orderpriority {whens} END"


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("market_id"),
        F.col("o_orderpriority").alias("market_name"),
        _market_type_col().alias("market_type"),
        F.col("o_custkey").alias("event_id"),
        F.concat(F.lit("event "), F.col("o_custkey").cast("string")).alias("event_name"),
        F.col("o_orderstatus").alias("country_code"),
        F.col("o_orderdate").alias("scheduled_time"),
        F.when(F.col("o_orderstatus") != F.lit("P"), F.col("o_orderdate")).alias("kick_off"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 120).cast("int"))).alias("settled_time"),
    )


MARKET_SQL = f"""market AS (
  SELECT o_orderkey AS market_id, o_orderpriority AS market_name, {_market_type_sql()} AS market_type,
         o_custkey AS event_id, 'event ' || CAST(o_custkey AS VARCHAR) AS event_name,
         o_orderstatus AS country_code, o_orderdate AS scheduled_time,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS kick_off,
         o_orderdate + to_minutes(CAST(o_orderkey % 120 AS BIGINT)) AS settled_time
  FROM orders)"""


# Fixed stand-in rule: runner name chosen by (l_orderkey + runner id) % 9, as
# (spark, sql).  Spark sides are functions: no Column is built at import time.
def _txt(c: Column) -> Column:
    return c.cast("string")


RUNNER_NAME_RULES = [
    (lambda o, r: F.lit("Over 0.5 Goals"), "'Over 0.5 Goals'"),
    (lambda o, r: F.lit("Under 0.5 Goals"), "'Under 0.5 Goals'"),
    (lambda o, r: F.concat(F.lit("Over "), _txt(o % 4), F.lit(".5 Goals")),
     "'Over ' || CAST(l_orderkey % 4 AS VARCHAR) || '.5 Goals'"),
    (lambda o, r: F.concat(_txt(o % 4), F.lit(" - "), _txt(r)),
     "CAST(l_orderkey % 4 AS VARCHAR) || ' - ' || CAST(runner_id AS VARCHAR)"),
    (lambda o, r: F.concat(_txt(r), F.lit(" - "), _txt(o % 3)),
     "CAST(runner_id AS VARCHAR) || ' - ' || CAST(l_orderkey % 3 AS VARCHAR)"),
    (lambda o, r: F.lit("Any Other Home Win"), "'Any Other Home Win'"),
    (lambda o, r: F.lit("Any Other Away Win"), "'Any Other Away Win'"),
    (lambda o, r: F.lit("Any Other Draw"), "'Any Other Draw'"),
    (lambda o, r: F.lit("Any unquoted"), "'Any unquoted'"),
]


def _runner_name_col() -> Column:
    o, r = F.col("l_orderkey"), F.col("runner_id")
    k = (o + r) % len(RUNNER_NAME_RULES)
    expr = None
    for i, (build, _) in enumerate(RUNNER_NAME_RULES):
        expr = F.when(k == i, build(o, r)) if expr is None else expr.when(k == i, build(o, r))
    return expr


def _runner_name_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN {sql}" for i, (_, sql) in enumerate(RUNNER_NAME_RULES))
    return f"CASE (l_orderkey + runner_id) % {len(RUNNER_NAME_RULES)} {whens} END"


def _runner_id() -> Column:
    return (F.col("l_linenumber") % 3 + 1).cast("bigint")


def runner(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").withColumn("runner_id", _runner_id())
    g = li.groupBy("l_orderkey", "runner_id").agg(F.bool_or(F.col("l_returnflag") == F.lit("R")).alias("_won"))
    return g.select(
        F.col("l_orderkey").alias("market_id"),
        "runner_id",
        _runner_name_col().alias("runner_name"),
        F.when(F.col("_won"), F.lit("WINNER")).otherwise(F.lit("LOSER")).alias("status"),
        F.col("runner_id").alias("sort_priority"),
    )


RUNNER_SQL = f"""runner AS (
  SELECT l_orderkey AS market_id, runner_id, {_runner_name_sql()} AS runner_name,
         CASE WHEN bool_or(l_returnflag = 'R') THEN 'WINNER' ELSE 'LOSER' END AS status,
         runner_id AS sort_priority
  FROM (SELECT *, CAST(l_linenumber % 3 + 1 AS BIGINT) AS runner_id FROM lineitem)
  GROUP BY l_orderkey, runner_id)"""


def market_runner(runner_df: DataFrame) -> DataFrame:
    return runner_df.select("market_id", "runner_id", (F.col("status") == F.lit("WINNER")).alias("winner"),
                            "sort_priority")


MARKET_RUNNER_SQL = """market_runner AS (
  SELECT market_id, runner_id, status = 'WINNER' AS winner, sort_priority FROM runner)"""


def _spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` dealt over ``tasks`` tasks, for work that takes more than reading; as it is read, if None."""
    return df.repartition(tasks) if tasks else df


def write_tasks(spark: SparkSession) -> int:
    """Tasks for work that takes much longer than reading: a small table has few splits."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def price(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    li = _spread(read(spark, sf_dir, "lineitem"), tasks)
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).withColumn("tick", F.explode(F.array(F.lit(0), F.lit(1))))
    before = -((F.col("l_partkey") % 120) + 1)
    after = (F.lit(37) * F.col("l_linenumber") + F.col("l_partkey")) % 120
    offset_min = F.when(F.col("tick") == 0, before).otherwise(after)
    epoch = ts_millis("o_orderdate") + offset_min * F.lit(60000)
    odds = F.when(F.col("tick") == 0, F.col("l_extendedprice") / F.col("l_quantity")).otherwise(
        F.col("l_extendedprice") / (F.col("l_quantity") + 1))
    return j.select(
        epoch.alias("epoch"),
        F.timestamp_millis(epoch).cast("timestamp_ntz").alias("timestamp"),
        F.col("l_orderkey").alias("market_id"),
        _runner_id().alias("runner_id"),
        ((F.col("l_partkey") * 2 + F.col("tick")) * 100000 + F.col("l_suppkey")).alias("seq"),
        F.col("l_tax").alias("handicap"),
        ((F.col("l_linenumber") - 1) / 3).cast("int").alias("position"),
        odds.alias("odds"),
        F.col("l_quantity").alias("amount"),
        F.when(F.col("l_returnflag") == F.lit("N"), F.lit("l")).otherwise(F.lit("b")).alias("type"),
        (F.col("l_extendedprice") * (F.col("tick") + 1)).alias("total_volume"),
        F.when(F.col("l_discount") > 0, odds).alias("ltp"),
    )


PRICE_SQL = """price AS (
  SELECT epoch, epoch_ms(epoch) AS timestamp, market_id, runner_id, seq, handicap, position, odds, amount, type,
         total_volume, CASE WHEN l_discount > 0 THEN odds END AS ltp
  FROM (
    SELECT epoch_ms(o_orderdate) + (CASE WHEN tick = 0 THEN -((l_partkey % 120) + 1)
                                         ELSE (37 * l_linenumber + l_partkey) % 120 END) * 60000 AS epoch,
           l_orderkey AS market_id, CAST(l_linenumber % 3 + 1 AS BIGINT) AS runner_id,
           (l_partkey * 2 + tick) * 100000 + l_suppkey AS seq, l_tax AS handicap,
           CAST((l_linenumber - 1) // 3 AS INTEGER) AS position,
           CASE WHEN tick = 0 THEN l_extendedprice / l_quantity ELSE l_extendedprice / (l_quantity + 1) END AS odds,
           l_quantity AS amount, CASE WHEN l_returnflag = 'N' THEN 'l' ELSE 'b' END AS type,
           l_extendedprice * (tick + 1) AS total_volume, l_discount
    FROM (SELECT *, unnest([0, 1]) AS tick FROM lineitem JOIN orders ON l_orderkey = o_orderkey)))"""


def changes(price_df: DataFrame) -> DataFrame:
    """The price table in runner_change naming (hc, tv) for the presentation plans."""
    return price_df.withColumnsRenamed({"handicap": "hc", "total_volume": "tv"})


CHANGES_SQL = """chg AS (
  SELECT epoch, timestamp, market_id, runner_id, seq, handicap AS hc, position, odds, amount, type,
         total_volume AS tv, ltp FROM price)"""


def event(market_df: DataFrame) -> DataFrame:
    """Event dimension: name and country of each event's latest market."""
    e = latest_state(market_df, ["event_id"], "scheduled_time", ["event_name", "country_code"], tiebreak=["market_id"])
    return e.select(F.col("event_id").alias("id"), F.col("event_name").alias("name"), "country_code")


EVENT_SQL = """event AS (
  SELECT event_id AS id, arg_max_null(event_name, (scheduled_time, market_id)) AS name,
         arg_max_null(country_code, (scheduled_time, market_id)) AS country_code
  FROM market GROUP BY event_id)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


DOMAIN_SQL = [MARKET_SQL, RUNNER_SQL, PRICE_SQL]


# ---------------------------------------------------------------------------
# A nested feed derived from the same tables, in the exact feed schema, so the
# clean-layer plans run on whole tables.  Per order: definition versions 1
# (an hour before kick-off, not in play), 2 (kick-off, in play; absent while
# o_orderstatus = 'P') and 3 (settled o_orderkey % 120 + 1 minutes after
# kick-off, winner = runner o_orderkey % 3 + 1).  Per line and tick: one
# runner change with a one-level ladder on its side.  Files are per event.
# ---------------------------------------------------------------------------

def _iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _struct_of(dtype, values: dict) -> Column:
    """Struct of ``dtype`` with the given fields, typed NULL for the others."""
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in dtype.fields])


def feed_changes(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Rows shaped like :func:`oddsflow.sources.feed.explode_changes` output
    (pt, timestamp, mc, _file): one market change per row, made by ``tasks`` tasks
    if given; the definitions, which take most of the work a row, always by several."""
    from .sources.feed import FEED_SCHEMA

    schema = spark.createDataFrame([], FEED_SCHEMA).schema
    mc_type = schema["mc"].dataType.elementType
    def_type = mc_type["marketDefinition"].dataType
    runner_type = def_type["runners"].dataType.elementType
    rc_type = mc_type["rc"].dataType.elementType

    o = read(spark, sf_dir, "orders")
    ko = ts_millis("o_orderdate")
    settle = ko + ((F.col("o_orderkey") % 120) + 1) * F.lit(60000)
    versions = _spread(o, tasks or write_tasks(spark)).select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("version")).where(
        ~((F.col("version") == 2) & (F.col("o_orderstatus") == "P")))
    v = F.col("version")
    pt = F.when(v == 1, ko - F.lit(3600000)).when(v == 2, ko).otherwise(settle)
    closed = v == 3
    winner_rid = F.col("o_orderkey") % 3 + 1

    def runner(rid: int) -> Column:
        name = _runner_name_col_for(F.col("o_orderkey"), F.lit(rid).cast("bigint"))
        status = F.when(~closed, F.lit("ACTIVE")).when(winner_rid == rid, F.lit("WINNER")).otherwise(F.lit("LOSER"))
        return _struct_of(runner_type, {"hc": F.lit(0.0), "id": F.lit(rid), "name": name, "sortPriority": F.lit(rid),
                                        "status": status})

    definition = _struct_of(def_type, {
        "betDelay": v, "bettingType": F.lit("ODDS"), "bspMarket": v == 1, "bspReconciled": v == 3,
        "complete": F.lit(True), "crossMatching": v >= 2, "discountAllowed": F.col("o_orderkey") % 2 == 0,
        "persistenceEnabled": v < 3, "runnersVoidable": F.lit(False), "suspendTime": _iso(ko), "timezone": F.lit("GMT"),
        "turnInPlayEnabled": F.lit(True), "eventTypeId": F.lit("1"), "countryCode": F.col("o_orderstatus"),
        "eventId": F.col("o_custkey").cast("string"),
        "eventName": F.concat(F.lit("event "), F.col("o_custkey").cast("string")),
        "inPlay": v >= 2, "marketBaseRate": F.lit(5.0), "marketTime": _iso(ko),
        "marketType": _market_type_col(),
        "name": F.concat(F.lit("market "), F.col("o_orderkey").cast("string"), F.when(v == 1, F.lit(" pre"))
                         .otherwise(F.lit(""))),
        "numberOfActiveRunners": F.lit(3), "numberOfWinners": F.lit(1), "openDate": _iso(ko),
        "regulators": F.array(F.concat(F.lit("R"), (F.col("o_custkey") % 3).cast("string"))),
        "runners": F.array(runner(1), runner(2), runner(3)),
        "settledTime": F.when(closed, _iso(settle)),
        "status": F.when(closed, F.lit("CLOSED")).otherwise(F.lit("OPEN")),
        "version": v,
    })
    defs = versions.select(
        pt.alias("pt"),
        _struct_of(mc_type, {"id": F.col("o_orderkey").cast("string"), "marketDefinition": definition}).alias("mc"),
        F.concat(F.lit("feed/"), F.col("o_custkey").cast("string"), F.lit(".bz2")).alias("_file"))

    p = price(spark, sf_dir, tasks)
    cust = o.select(F.col("o_orderkey").alias("market_id"), "o_custkey")
    entry = F.array(F.array(F.col("position").cast("double"), F.col("odds"), F.col("amount")))
    change = _struct_of(rc_type, {
        "batb": F.when(F.col("type") == "b", entry), "batl": F.when(F.col("type") == "l", entry),
        "hc": F.col("handicap"), "id": F.col("runner_id"), "ltp": F.col("ltp"), "tv": F.col("total_volume")})
    rcs = p.join(cust, "market_id").select(
        F.col("epoch").alias("pt"),
        _struct_of(mc_type, {"id": F.col("market_id").cast("string"), "rc": F.array(change)}).alias("mc"),
        F.concat(F.lit("feed/"), F.col("o_custkey").cast("string"), F.lit(".bz2")).alias("_file"))
    both = defs.unionByName(rcs)
    return both.select("pt", F.timestamp_millis("pt").alias("timestamp"), "mc", "_file")


def _runner_name_col_for(o: Column, r: Column) -> Column:
    k = (o + r) % len(RUNNER_NAME_RULES)
    expr = None
    for i, (build, _) in enumerate(RUNNER_NAME_RULES):
        expr = F.when(k == i, build(o, r)) if expr is None else expr.when(k == i, build(o, r))
    return expr


def _iso_sql(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


# Flat definition rows (what `definitions(raw)` yields), one per order and version.
DEFS_SQL = f"""defs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey, o_custkey, version, pt,
         version >= 2 AS in_play, o_orderstatus AS country_code,
         CAST(o_custkey AS VARCHAR) AS event_id_text, 'event ' || CAST(o_custkey AS VARCHAR) AS event_name,
         {_market_type_sql()} AS market_type,
         'market ' || CAST(o_orderkey AS VARCHAR) || CASE WHEN version = 1 THEN ' pre' ELSE '' END AS name,
         ko AS open_ms, ko AS start_ms, CASE WHEN version = 3 THEN pt END AS settled_ms,
         CASE WHEN version = 3 THEN 'CLOSED' ELSE 'OPEN' END AS status,
         ['R' || CAST(o_custkey % 3 AS VARCHAR)] AS regulators,
         'feed/' || CAST(o_custkey AS VARCHAR) || '.bz2' AS file
  FROM (
    SELECT *, CASE version WHEN 1 THEN ko - 3600000 WHEN 2 THEN ko ELSE settle END AS pt
    FROM (SELECT *, epoch_ms(o_orderdate) AS ko, epoch_ms(o_orderdate) + (o_orderkey % 120 + 1) * 60000 AS settle,
                 unnest([1, 2, 3]) AS version FROM orders)
    WHERE NOT (version = 2 AND o_orderstatus = 'P')))"""

# Flat runner rows of the definitions.
DEF_RUNNERS_SQL = f"""def_runners AS (
  SELECT id AS market_id, name AS market_name, pt, version, runner_id,
         {_runner_name_sql().replace('l_orderkey', 'o_orderkey')} AS runner_name,
         runner_id AS sort_priority,
         CASE WHEN version < 3 THEN 'ACTIVE' WHEN runner_id = o_orderkey % 3 + 1 THEN 'WINNER' ELSE 'LOSER' END
           AS status
  FROM (SELECT *, CAST(unnest([1, 2, 3]) AS BIGINT) AS runner_id FROM defs))"""
