"""Plan properties: pushdown and pruning reach the scan; results do not depend
on partitioning."""

import os
import tempfile

import pytest

from oddsflow.plans import clean
from oddsflow.sources.feed import ingest, read_feed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_filter_and_pruning_reach_the_scan(spark, feed_dir):
    path = os.path.join(tempfile.mkdtemp(prefix="oddsflow-raw-"), "raw")
    ingest(read_feed(spark, feed_dir)).write.parquet(path)
    raw = spark.read.parquet(path)
    plan = _plan(clean.prices(raw, since="2025-01-01"))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "GreaterThanOrEqual(timestamp" in scan and "IsNotNull(mc.rc)" in scan
    # only the runner-change part of the nested change is read
    read_schema = scan.split("ReadSchema:")[1]
    assert "rc:array" in read_schema and "marketDefinition" not in read_schema
    plan = _plan(clean.market_changes(raw))
    read_schema = [line for line in plan.splitlines() if "FileScan parquet" in line][0].split("ReadSchema:")[1]
    assert "rc:" not in read_schema and "source_file_names" not in read_schema


@pytest.mark.parametrize("name", ["q_latest_state", "q_ko_odds_favourite", "q_event_wide", "q_star_dim",
                                  "q_runner_odds_fact", "q_feed_market_state"])
def test_results_do_not_depend_on_partitioning(spark, name):
    import __spark_entry__ as e

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no driver data")
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(str, e.queries()[name](spark, d).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]


def test_per_market_files_are_not_read():
    import json
    import subprocess
    import sys

    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "file_pruning.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    read = json.loads(out.stdout.strip().splitlines()[-1])
    # the large per-market file is skipped before it is opened
    assert read["with_filter"] * 20 < read["no_filter"], read
