"""Table-to-table jobs: the layers of the reference as callable functions.

    load_raw            landing files -> <ns>.raw, <ns>.raw_lineage, <ns>.raw_quarantine, <ns>.raw_loads
                        (append only what is new)
    build_clean         <ns>.raw -> market_definition, event, market, market_change, market_runner,
                        market_type, runner, runner_change, price, match_statistics
                        (+ views market_v1, runner_v1 in the older column shapes)
    build_presentation  clean tables -> dim_date, dim_time, dim_first_goal, dim_runner,
                        fact_runner_odds, fact_first_goal_match_odds, fact_first_goal_over_under
    update_clean        <ns>.raw, the batches not merged yet -> <ns>.<table>_states and <ns>.<table>_batches
                        (clean_rows reads a table from them, clean_changes the net changes between batches)
    rewrite_sorted_table  sorted layout of a table (raw by pt, runner_change by
                        market/runner/epoch, ...), written beside it and switched to

Clean and presentation tables are replaced on every run: they are functions of
the whole raw table, so a re-run never appends duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.time import calendar_for, clock_dim
from .operators.diff import CHANGE_TYPE, INSERT, read_increment
from .plans import clean, incremental, present
from .plans.legacy import create_legacy_views
from .sinks.tables import WriteMode, ensure_namespace, partition_columns, recover_table, replace_partitions, save_table, sorted_layout, stored, switch_in, write_beside
from .sources.feed import bad_lines, good_changes, read_feed, seen_lines, split_lineage

# Layout sort keys of the tables that get a sorted rewrite.
SORT_KEYS = {
    "raw": [("batch_id", False), ("pt", False)],
    "runner_change": [("market_id", False), ("runner_id", False), ("epoch", False)],
    "dim_runner": [("id", False), ("market_id", False)],
    "fact_runner_odds": [("market_type_id", True), ("market_id", True), ("runner_id", True), ("epoch", True)],
}


# Tables joined on (market_id, runner_id) are bucketed alike so that the join
# needs no shuffle; size the count to the data (thousands at 100 TB).
RUNNER_BUCKETS = 64
RUNNER_KEYS = ("market_id", "runner_id")


def _t(namespace: str, name: str) -> str:
    return f"{namespace}.{name}"


def new_changes(spark: SparkSession, fresh: DataFrame, raw_table: str) -> DataFrame:
    """Changes of ``fresh`` not yet in ``raw_table`` (compared on pt and the change, NULLs alike).

    Only stored rows inside the pt range of ``fresh`` are read; with the raw
    table sorted by pt, parquet statistics skip the rest.  ``fresh`` is read
    twice: pass a stored table.
    """
    if not spark.catalog.tableExists(raw_table):
        return fresh
    return not_stored(fresh, spark.read.table(raw_table))


def not_stored(fresh: DataFrame, stored_rows: DataFrame) -> DataFrame:
    """Rows of ``fresh`` that are not among the stored ones.

    Where both have a change_key, keys are compared first: of the stored table only its keys
    are read for that, and whole changes are compared for rows whose key is there already.
    """
    bounds = fresh.agg(F.min("pt").alias("lo"), F.max("pt").alias("hi")).first()
    old = stored_rows.where(F.col("pt").isNull() | F.col("pt").between(F.lit(bounds["lo"]), F.lit(bounds["hi"])))
    if "change_key" not in fresh.columns or "change_key" not in old.columns:
        return _not_among(fresh, old)
    keys = stored(fresh.select("change_key").join(old.select("change_key"), "change_key", "left_semi").distinct(), "known-keys")
    maybe = _not_among(fresh.join(keys, "change_key", "left_semi"), old.join(keys, "change_key", "left_semi"))
    return fresh.join(keys, "change_key", "left_anti").unionByName(maybe).select(*fresh.columns)


def _not_among(fresh: DataFrame, old: DataFrame) -> DataFrame:
    old = old.select(F.col("pt").alias("_pt"), F.col("mc").alias("_mc"))
    return fresh.join(old, fresh["pt"].eqNullSafe(old["_pt"]) & fresh["mc"].eqNullSafe(old["_mc"]), "left_anti")


def load_raw(spark: SparkSession, path: str, namespace: str) -> DataFrame:
    """P-1: read the landing files, de-duplicate, append what is new to <ns>.raw.

    The feed is parsed once: its distinct (change, file) rows are stored, and
    the new changes, their time range and the lineage all come from there.
    Lineage goes to <ns>.raw_lineage as (change_key, file) rows, so a change's
    file list is never collected into one value, and a copy that turns up in a
    later load adds its file.  Lines that are no JSON of the feed go to <ns>.raw_quarantine
    with their file; <ns>.raw_loads tells how many changes and bad lines each load brought.
    """
    ensure_namespace(spark, namespace)
    name, lineage_name = _t(namespace, "raw"), _t(namespace, "raw_lineage")
    for table in (name, lineage_name):
        recover_table(spark, table)
    seen = stored(seen_lines(read_feed(spark, path)), "feed-batch")
    fresh, lineage = split_lineage(good_changes(seen))
    if spark.catalog.tableExists(lineage_name):
        lineage = lineage.join(spark.read.table(lineage_name).select("change_key", "file"), ["change_key", "file"], "left_anti")
    save_table(spark, lineage, lineage_name, WriteMode.APPEND)
    loads = _t(namespace, "raw_loads")
    batch = 1 + (spark.table(loads).agg(F.max("batch_id")).first()[0] or 0 if spark.catalog.tableExists(loads) else 0)
    new, added = clean.observed_count(new_changes(spark, fresh, name), "raw")
    save_table(spark, new.withColumn("batch_id", F.lit(batch).cast("long")), name, WriteMode.APPEND, partition_by=("batch_id",))
    save_table(spark, spark.range(1).select(F.lit(batch).cast("long").alias("batch_id"), F.current_timestamp().alias("committed_at"), F.lit(added.get["rows"]).cast("long").alias("changes"),
                                            F.lit(_quarantine(spark, seen, namespace, batch)).cast("long").alias("bad_lines")), loads)
    return spark.read.table(name)


def _quarantine(spark: SparkSession, seen: DataFrame, namespace: str, batch: int) -> int:
    """Keep the bad lines that are not kept yet; returns how many lines those are."""
    name = _t(namespace, "raw_quarantine")
    bad = bad_lines(seen)
    if spark.catalog.tableExists(name):
        bad = bad.join(spark.table(name).select("file", "bad_line"), ["file", "bad_line"], "left_anti")
    observed = Observation("bad")
    counted = bad.observe(observed, F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"))
    save_table(spark, counted.withColumn("batch_id", F.lit(batch).cast("long")), name)
    return observed.get["lines"]


# Clean tables that only grow: their rows of a batch, kept by batch.
APPENDED = {"market_change": clean.market_changes, "runner_change": clean.runner_changes, "price": clean.prices}


def update_clean(spark: SparkSession, namespace: str, buckets: int = incremental.BUCKETS) -> list[int]:
    """Merge the batches of <ns>.raw that the clean layer has not seen, each read by itself;
    returns their ids.  A batch cut off by a failure is merged again from its start, which
    changes nothing that was merged before."""
    raw, done = spark.table(_t(namespace, "raw")), _t(namespace, "clean_loads")
    loads = spark.table(_t(namespace, "raw_loads")).select("batch_id").distinct()
    if spark.catalog.tableExists(done):
        loads = loads.join(spark.table(done), "batch_id", "left_anti")
    batches = [r[0] for r in loads.orderBy("batch_id").collect()]
    for batch in batches:
        changes = raw.where(F.col("batch_id") == F.lit(batch))
        for spec in incremental.specs(raw.columns):
            incremental.apply_batch(spark, spec, changes, _t(namespace, f"{spec.name}_states"), batch, buckets)
        for name, rows in APPENDED.items():
            replace_partitions(spark, rows(changes).withColumn("batch_id", F.lit(batch).cast("long")), _t(namespace, f"{name}_batches"), ("batch_id",))
        save_table(spark, spark.range(1).select(F.lit(batch).cast("long").alias("batch_id")), done)
    return batches


def _spec(spark: SparkSession, namespace: str, name: str) -> incremental.StateSpec:
    return next(s for s in incremental.specs(spark.table(_t(namespace, "raw")).columns) if s.name == name)


def clean_rows(spark: SparkSession, namespace: str, name: str, upto: int | None = None) -> DataFrame:
    """A clean table as update_clean keeps it, now or after a batch."""
    if name in APPENDED:
        rows = spark.table(_t(namespace, f"{name}_batches"))
        return (rows if upto is None else rows.where(F.col("batch_id") <= upto)).drop("batch_id")
    return incremental.live_rows(spark, _spec(spark, namespace, name), _t(namespace, f"{name}_states"), upto)


def clean_changes(spark: SparkSession, namespace: str, name: str, lo: int, hi: int) -> DataFrame:
    """Net changes of a clean table between two batches, read from what the batches wrote."""
    if name in APPENDED:
        rows = read_increment(spark.table(_t(namespace, f"{name}_batches")), lo, hi).drop("batch_id")
        return rows.withColumn(CHANGE_TYPE, F.lit(INSERT))
    return incremental.change_log(spark, _spec(spark, namespace, name), _t(namespace, f"{name}_states"), lo, hi)


def build_clean(spark: SparkSession, namespace: str, price_since: str | None = None, buckets: int = RUNNER_BUCKETS,
                mode: WriteMode | str = WriteMode.REPLACE) -> dict[str, int]:
    """P-2 … P-11 from <ns>.raw; returns the rows written per table, counted while writing.
    runner_change is bucketed on (market_id, runner_id)."""
    raw = spark.read.table(_t(namespace, "raw"))
    t = lambda n: spark.read.table(_t(namespace, n))
    written: dict[str, int] = {}

    def save(name: str, df: DataFrame) -> None:
        bucket = (buckets, RUNNER_KEYS) if name == "runner_change" and buckets else None
        written[name] = _save_counted(spark, df, _t(namespace, name), mode, bucket)

    save("market_definition", clean.flattened_definitions(raw))
    save("event", clean.event_dim(raw))
    save("market", clean.market_state(raw))
    save("market_change", clean.market_changes(raw))
    save("market_runner", clean.market_runners(raw, with_epoch=True))
    save("market_type", clean.market_types(raw))
    save("runner", clean.runners(raw, with_epoch=True))
    save("runner_change", clean.runner_changes(raw))
    save("price", clean.prices(raw, since=price_since))
    save("match_statistics", clean.match_statistics(t("market"), t("runner"), t("price")))
    create_legacy_views(spark, namespace)
    return written


def _save_counted(spark: SparkSession, df: DataFrame, name: str, mode: WriteMode | str, bucket=None, partition_by: Sequence[str] = ()) -> int:
    observed, seen = clean.observed_count(df, name)
    save_table(spark, observed, name, mode, bucket_by=bucket, partition_by=partition_by)
    return seen.get["rows"]


def build_presentation(spark: SparkSession, namespace: str, buckets: int = RUNNER_BUCKETS, mode: WriteMode | str = WriteMode.REPLACE) -> dict[str, int]:
    """P-12 … P-18 from the clean tables; returns the rows written per table.  The date dimension
    covers the days of the markets; dim_runner is bucketed like runner_change, so the fact's join
    of the two needs no shuffle; the fact is partitioned by market type, so the first-goal facts
    read their types only.  ``mode`` is how the tables that exist are treated."""
    t = lambda n: spark.read.table(_t(namespace, n))
    written: dict[str, int] = {}

    def save(name: str, df: DataFrame, bucket=None, partition_by: Sequence[str] = ()) -> None:
        written[name] = _save_counted(spark, df, _t(namespace, name), mode, bucket, partition_by)

    times = t("market").select(F.explode(F.array("scheduled_time", "kick_off")).alias("day"))
    save("dim_date", calendar_for(times, "day"))
    save("dim_time", clock_dim(spark))
    save("dim_first_goal", present.dim_first_goal(t("market"), t("runner")))
    dr = present.dim_runner(t("runner"), t("market_runner"), t("market"), t("market_type"), t("event"), t("runner_change"))
    save("dim_runner", dr, (buckets, RUNNER_KEYS) if buckets else None)
    save("fact_runner_odds", present.fact_runner_odds(t("runner_change"), t("market"), t("dim_runner"), store=stored), partition_by=present.FACT_PARTITION)
    for name, types, stat in (("fact_first_goal_match_odds", present.MATCH_ODDS_TYPES, "avg"),
                              ("fact_first_goal_over_under", present.OVER_UNDER_TYPES, "median")):
        save(name, present.first_goal_fact(t("dim_runner"), t("fact_runner_odds"), t("dim_first_goal"), types, stat))
    return written


def rewrite_sorted_table(spark: SparkSession, table: str, keys: Sequence[tuple[str, bool]] | None = None,
                         partitions: int | None = None) -> None:
    """SNK-6: rewrite ``table`` in sorted layout (NULLS LAST; ``True`` = descending).

    Tables written bucketed (runner_change, dim_runner) are already sorted by
    their bucket keys inside each bucket; rewriting them here would drop the
    bucketing, so this is for the others (raw, fact_runner_odds).

    The sorted copy is written beside the table, which is then pointed at it; a call
    after a failure at any step first recovers the table (see recover_table).
    """
    short = table.split(".")[-1]
    keys = list(keys or SORT_KEYS[short])
    cols: list[Column] = [F.col(k).desc_nulls_last() if desc else F.col(k).asc_nulls_last() for k, desc in keys]
    recover_table(spark, table)
    writer = sorted_layout(spark.read.table(table), cols, partitions).write.format("parquet")
    if by := partition_columns(spark, table):
        writer = writer.partitionBy(*by)
    write_beside(spark, writer, table)
    switch_in(spark, table)
