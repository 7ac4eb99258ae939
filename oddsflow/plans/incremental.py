"""Clean tables kept up to date batch by batch.

A state row holds what a key's table row is made of: the order key and the payload of its
latest change, and the extremes (max, min, or) over all of its changes.  Two states of one
key merge into the state of both their changes, in any order, and merging one twice changes
nothing; so a batch may come late, or again after a failure.

States are kept as a log, a table partitioned by (batch_id, bucket of the key).  A batch

    1. reads its own changes only, and reduces them to one state a key (map-side combined);
    2. reads the states of just these keys: of the buckets they fall in (partition
       pruning), by a semi-join on the key;
    3. appends the merged states under its own batch id.

The table is every key's states merged.  As older states stay, the net changes between
any two batches come from the states written between them and what those keys were before,
not from two snapshots.  ``compact`` rewrites a log without what no reader asks for any more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.diff import snapshot_diff
from ..operators.keys import hash_key
from ..sinks.tables import WriteMode, recover_table, save_table, stored
from ..sources.feed import definitions
from . import clean

BATCH, BUCKET = "batch_id", "bucket"
BUCKETS = 64  # of each log; size it to the keys (thousands at 100 TB), never change it for a written log
_MERGE = {"max": F.max, "min": F.min, "or": F.bool_or}


@dataclass(frozen=True)
class StateSpec:
    """How the rows of one clean table are kept: ``rows`` makes the rows to reduce from raw
    changes, ``keys`` name one table row, ``order`` decides which row's ``latest`` columns
    count, ``extremes`` are name -> (max, min or or, column).  A change of one key rewrites all
    keys that share its ``touch`` columns.  ``finish`` turns states into table rows."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    order: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]
    latest: tuple[str, ...] = ()
    extremes: Mapping[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)
    touch: tuple[str, ...] = ()

    @property
    def touched(self) -> tuple[str, ...]:
        return self.touch or self.keys


def partial_states(raw: DataFrame, spec: StateSpec) -> DataFrame:
    """One state a key of the given changes."""
    payload = F.struct(*[F.col(c) for c in spec.latest]) if spec.latest else F.struct(F.lit(True).alias("_any"))
    rows = spec.rows(raw).select(*spec.keys, F.struct(*spec.order).alias("_at"), payload.alias("_latest"),
                                 *[column().alias(name) for name, (_, column) in spec.extremes.items()])
    return merge_states(rows, spec)


def merge_states(states: DataFrame, spec: StateSpec) -> DataFrame:
    """One state a key, of all states given for it."""
    return states.groupBy(*spec.keys).agg(
        F.max("_at").alias("_at"), F.max_by("_latest", "_at").alias("_latest"),
        *[_MERGE[how](name).alias(name) for name, (how, _) in spec.extremes.items()])


def table_rows(states: DataFrame, spec: StateSpec) -> DataFrame:
    """The clean table's rows of some states."""
    flat = states.select(*spec.keys, *[F.col(f"_latest.`{c}`").alias(c) for c in spec.latest], F.col("_at"), *spec.extremes)
    return spec.finish(flat)


def bucket_of(spec: StateSpec, buckets: int) -> Column:
    return F.pmod(hash_key(spec.touched), F.lit(buckets)).cast("int")


def states_of(log: DataFrame, keys: DataFrame, spec: StateSpec, upto: int) -> DataFrame:
    """The states, after a batch, of what ``keys`` touch: only their buckets are read."""
    found = [r[0] for r in keys.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
    names = {c: f"_k_{c}" for c in spec.touched}
    wanted = keys.select(*[F.col(c).alias(k) for c, k in names.items()]).distinct()
    old = log.where(F.col(BUCKET).isin(found) & (F.col(BATCH) <= F.lit(upto)))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()]
    return merge_states(old.join(wanted, same, "left_semi"), spec)


def apply_batch(spark: SparkSession, spec: StateSpec, changes: DataFrame, log: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """Merge one batch's changes into the log table; returns the states it wrote.

    ``changes`` are the raw changes of this batch alone.  A batch may be applied again, or after
    a later one: readers merge all states of a key, and merging one twice changes nothing.
    """
    fresh = stored(partial_states(changes, spec).withColumn(BUCKET, bucket_of(spec, buckets)), f"{spec.name}-batch")
    recover_table(spark, log)
    states = fresh.drop(BUCKET)
    if spark.catalog.tableExists(log):
        states = merge_states(states.unionByName(states_of(spark.table(log), fresh, spec, batch)), spec)
    written = states.withColumns({BATCH: F.lit(batch).cast("long"), BUCKET: bucket_of(spec, buckets)})
    save_table(spark, written.repartition(BUCKET), log, WriteMode.APPEND, partition_by=(BATCH, BUCKET))  # a bucket's states in one file
    return spark.table(log).where(F.col(BATCH) == F.lit(batch))


def live_rows(spark: SparkSession, spec: StateSpec, log: str, upto: int | None = None) -> DataFrame:
    """The clean table, now or as it was after a batch."""
    states = spark.table(log)
    return table_rows(merge_states(states if upto is None else states.where(F.col(BATCH) <= F.lit(upto)), spec), spec)


def change_log(spark: SparkSession, spec: StateSpec, log: str, lo: int, hi: int) -> DataFrame:
    """Net changes of the clean table from after batch ``lo`` to after batch ``hi``: its columns
    and _change_type.  Rows that end as they began are not in it."""
    states = spark.table(log)
    written = states.where((F.col(BATCH) > F.lit(lo)) & (F.col(BATCH) <= F.lit(hi)))
    before = stored(states_of(states, written, spec, lo), f"{spec.name}-before")
    after = merge_states(before.unionByName(written.select(*before.columns)), spec)
    return snapshot_diff(table_rows(before, spec), table_rows(after, spec))


def compact(spark: SparkSession, spec: StateSpec, log: str, keep_from: int, buckets: int = BUCKETS) -> None:
    """Leave out states that no reading as of batch ``keep_from`` or later returns: of the batches
    up to it one state of each key stays, under that batch's id."""
    states = spark.table(log)
    base = merge_states(states.where(F.col(BATCH) <= F.lit(keep_from)), spec)
    base = base.withColumns({BATCH: F.lit(keep_from).cast("long"), BUCKET: bucket_of(spec, buckets)})
    out = base.unionByName(states.where(F.col(BATCH) > F.lit(keep_from)))
    save_table(spark, out.repartition(BATCH, BUCKET), log, WriteMode.REPLACE, partition_by=(BATCH, BUCKET))


# ---------------------------------------------------------------------------
# the clean tables that are states
# ---------------------------------------------------------------------------

def _any_winner(states: DataFrame) -> DataFrame:
    ever = F.bool_or("winner").over(Window.partitionBy("market_id", "runner_id"))  # few sort priorities a runner
    return states.select("market_id", "runner_id", ever.alias("winner"), "sort_priority", "last_epoch")


def _runner_states(raw: DataFrame) -> DataFrame:
    return clean.runner_rows(raw).select("market_id", F.col("id").alias("runner_id"), F.col("sortPriority").alias("sort_priority"), "status", "pt")


def market_spec(lineage: str = "change_key") -> StateSpec:
    """P-4."""
    return StateSpec(
        "market", lambda raw: definitions(raw, extra=[lineage]), ("id",), ("pt", "version"), lambda s: clean.market_columns(s, lineage),
        latest=("name", "marketType", "eventId", "eventName", "countryCode", "numberOfWinners", lineage),
        extremes={"_open": ("max", lambda: F.col("openDate")), "_start": ("max", lambda: F.col("marketTime")), "_settled": ("max", lambda: F.col("settledTime")),
                  "_first_inplay": ("min", lambda: F.when(F.col("inPlay") == F.lit(True), F.col("pt")))})


EVENT = StateSpec("event", definitions, ("eventId",), ("pt", "version", "id"), clean.event_columns, latest=("eventName", "countryCode", "regulators"))  # P-3
MARKET_RUNNER = StateSpec(  # P-6
    "market_runner", _runner_states, ("market_id", "runner_id", "sort_priority"), ("pt",), _any_winner,
    extremes={"winner": ("or", lambda: F.coalesce(F.col("status") == F.lit(clean.WINNER), F.lit(False))), "last_epoch": ("max", lambda: F.col("pt"))},
    touch=("market_id", "runner_id"))
MARKET_TYPE = StateSpec(  # P-7
    "market_type", lambda raw: definitions(raw).select(F.col("marketType").alias("type"), "pt"), ("type",), ("pt",),
    lambda s: s.select("type", hash_key(["type"]).alias("id")))
RUNNER = StateSpec(  # P-8
    "runner", clean.runner_rows, ("market_id", "market_name", "id", "name"), ("pt", "version"), clean.runner_columns,
    latest=("status", "sortPriority"), extremes={"last_epoch": ("max", lambda: F.col("pt"))})


def specs(raw_columns: Sequence[str]) -> list[StateSpec]:
    """The specs of every clean table that is a state, for raw changes of these columns."""
    return [market_spec(clean.lineage_column(raw_columns)), EVENT, MARKET_RUNNER, MARKET_TYPE, RUNNER]
