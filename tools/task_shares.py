"""Largest and median task of each shuffle stage, of the queries over the skewed feed.

Usage: python tools/task_shares.py [sf_dir]

Prints one JSON line: query -> [[rows read from the shuffle by the largest task, by
the median task, tasks], ...], of stages that read a shuffle of at least ``LEAST``
rows, from Spark's event log.  Thresholds that say what a large partition is are
brought down to the test data's size; nothing is broadcast.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ("fct_skewed", "weekly_watch_skewed", "duplicate_events_skewed")
LEAST = 1000
CONF = {
    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true", "spark.eventLog.rolling.enabled": "false",
    "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "64k",
}


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="repotrend-events-")
    from repotrend.queries import QUERIES as REGISTERED
    from repotrend.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=16, extra_conf=CONF | {"spark.eventLog.dir": f"file:{logs}"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in QUERIES:
        spark.sparkContext.setJobDescription(name)
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    owner: dict[int, str] = {}
    read: dict[int, list[int]] = defaultdict(list)
    for path in glob.glob(f"{logs}/*"):
        with open(path) as lines:
            for line in lines:
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    owner |= {stage: event["Properties"].get("spark.job.description") for stage in event["Stage IDs"]}
                elif event["Event"] == "SparkListenerTaskEnd" and (metrics := event.get("Task Metrics")):
                    read[event["Stage ID"]].append(metrics["Shuffle Read Metrics"]["Total Records Read"])
    shares = {n: [[max(own), median(own), len(own)] for stage, own in sorted(read.items()) if owner.get(stage) == n and sum(own) >= LEAST] for n in QUERIES}
    print(json.dumps(shares))


if __name__ == "__main__":
    main(sys.argv)
