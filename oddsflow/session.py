"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes: UTC so that date/time keys do not depend on the
# machine, and AQE for runtime re-planning: coalescing, broadcast by measured
# size, and skew-join splits.  `forceOptimizeSkewedJoin` lets AQE split a hot
# join partition (say one market holding a third of all changes) even when the
# split needs an extra shuffle before the aggregation that follows; the partial
# aggregate then runs in the split tasks, before that shuffle.
# Partitions of tables are found from their folders, so that a table's location says all
# there is to say of its content, and replacing a table is one change of that location.
REQUIRED_CONF = {
    "spark.sql.hive.manageFilesourcePartitions": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "oddsflow",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster the launcher supplies one."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    reach_workers(spark)
    return spark


# Large arrays of a Python worker go back to the system when they are freed, rather than
# staying in the heap of a worker that later stages use again.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}

# Rows go to Python workers in batches of this size at most (and of 10,000 rows, as by default),
# whatever the length of their texts: a batch is held by the executor and by its worker at once.
ARROW_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their
    working folder (a path that executors share or have installed; else ship it as a py-file),
    and bound what they are given at once."""
    for k, v in ARROW_BATCH.items():
        spark.conf.set(k, v)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    for k, v in WORKER_MEMORY.items():
        environment.setdefault(k, v)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def apply_required_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session someone else built."""
    reach_workers(spark)
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime SQL settings for what is run inside the block; as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when none is configured and the master is local (tests, the bench) a
    private folder is created and registered; on a cluster a missing setting is
    an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
               or spark.conf.get("spark.checkpoint.dir", None))
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="oddsflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
