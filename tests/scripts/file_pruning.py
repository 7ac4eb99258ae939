"""Print bytes read by read_feed with and without the per-market file exclusion.

Run as its own process: event logging must be on when the session starts.
"""

import bz2
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from oddsflow.session import build_session  # noqa: E402
from oddsflow.sources.feed import read_feed  # noqa: E402
from tests.feed_fixture import msg, write_feed  # noqa: E402


def main() -> None:
    feed = write_feed(tempfile.mkdtemp(prefix="oddsflow-prune-"))
    with bz2.open(os.path.join(feed, "2025", "3", "1.5555.bz2"), "wt") as f:
        for i in range(50_000):
            f.write(json.dumps(msg(i, [{"id": f"9.{i}", "rc": [{"id": i, "ltp": i / 7, "tv": i / 3}]}])) + "\n")
    evdir = tempfile.mkdtemp(prefix="oddsflow-evlog-")
    spark = build_session(master="local[2]", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    for group, exclude in (("with_filter", "default"), ("no_filter", None)):
        spark.sparkContext.setJobGroup(group, group)
        df = read_feed(spark, feed) if exclude == "default" else read_feed(spark, feed, exclude=None)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    stage_group, total = {}, {}
    for path in glob.glob(evdir + "/*"):
        for line in open(path):
            ev = json.loads(line)
            if ev["Event"] == "SparkListenerJobStart":
                for s in ev["Stage IDs"]:
                    stage_group[s] = ev.get("Properties", {}).get("spark.jobGroup.id")
            elif ev["Event"] == "SparkListenerTaskEnd":
                b = ev.get("Task Metrics", {}).get("Input Metrics", {}).get("Bytes Read", 0)
                g = stage_group.get(ev["Stage ID"])
                total[g] = total.get(g, 0) + b
    print(json.dumps(total))


if __name__ == "__main__":
    main()
